"""Event extraction without a model: sentences that name a known actor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.patterns import strip
from newsloom.operators.entities import ACTOR, LOCATION, first_matches
from newsloom.operators.keyed import salted_join, spread

SENTENCE_END = r"[।.!?\n]+"
EDGES = r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$"
BETWEEN_WORDS = r"[^\p{L}\p{M}\p{N}]*\s[^\p{L}\p{M}\p{N}]*"
ISO_DATE = r"(?<!\d)(\d{4}-\d{2}-\d{2})(?!\d)"
CLOCK = r"(?<!\d)((?:[01]?\d|2[0-3]):[0-5]\d)(?!\d)"


def sentences(articles: DataFrame) -> DataFrame:
    """``pos, sentence_no, sentence`` over the whole content; empty pieces give no row."""
    pieces = F.transform(F.split("content", SENTENCE_END, -1), strip)
    rows = spread(articles.select("pos", "content")).select("pos", F.posexplode(pieces).alias("sentence_no", "sentence"))
    return rows.where(F.col("sentence") != "")


def words(sentence: Column) -> Column:
    """Words without the punctuation around them: cut at white space, together with the marks next to it."""
    return F.filter(F.split(F.regexp_replace(sentence, EDGES, ""), BETWEEN_WORDS, -1), lambda w: w != "")


def word_runs(ws: Column, longest: int) -> Column:
    """``struct(variant, at)`` for every run of one to ``longest`` words."""

    def runs(width: int) -> Column:
        def run(i: Column) -> Column:
            pieces = [F.get(ws, i)]
            for step in range(1, width):
                pieces += [F.lit(" "), F.get(ws, i + step)]
            return F.struct(F.concat(*pieces).alias("variant"), (i + 1).alias("at"))

        starts = F.when(F.size(ws) >= width, F.sequence(F.lit(0), F.size(ws) - width))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), run)

    return F.concat(*[runs(width) for width in range(1, longest + 1)])


def extract_events(articles: DataFrame, aliases: DataFrame, longest: int = 3, **join) -> DataFrame:
    """Flat entity rows from ``articles(pos, url, title, published_date, content)`` and a dictionary table.

    A sentence with at least one actor of the dictionary is an event. Its date is the first ISO date in it, else the
    published date; its time the first clock time. Actors and places are canonical, without repeats, in the order of
    the sentence. The runs of words are looked up by an equi-join, so the dictionary may be large.
    """
    split = sentences(articles).withColumn("words", words(F.col("sentence")))
    runs = split.select("pos", "sentence_no", F.explode(word_runs(F.col("words"), longest)).alias("r"))
    runs = runs.select("pos", "sentence_no", "r.variant", "r.at")
    found = salted_join(runs, first_matches(aliases), ["variant"], spread=["pos", "sentence_no", "at"], **join)
    item = F.struct("at", "canonical")
    lists = found.groupBy("pos", "sentence_no").agg(
        *[
            F.array_distinct(
                F.transform(
                    F.array_sort(F.collect_list(F.when(F.col("kind") == kind, item))), lambda x: x["canonical"]
                )
            ).alias(name)
            for name, kind in (("actors", ACTOR), ("location", LOCATION))
        ]
    )
    heads = articles.select(
        "pos", F.col("url").alias("article_url"), *[c for c in articles.columns if c in ("title", "published_date")]
    )
    date = F.regexp_extract("sentence", ISO_DATE, 1)
    published = F.split_part("published_date", F.lit(" "), F.lit(1))
    clock = F.regexp_extract("sentence", CLOCK, 1)
    events = split.drop("words").join(lists.where(F.size("actors") > 0), ["pos", "sentence_no"]).join(heads, "pos")
    return events.select(
        F.col("pos").alias("article_pos"),
        "article_url",
        *[c for c in heads.columns if c in ("title", "published_date")],
        F.col("sentence_no").alias("entity_pos"),
        F.col("sentence").alias("event"),
        "actors",
        F.when(date != "", date).otherwise(published).alias("event_date"),
        F.when(clock != "", clock).alias("event_time"),
        "location",
        F.col("sentence").alias("details"),
    )
