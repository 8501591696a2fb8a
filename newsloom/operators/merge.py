"""Merging of a date's events about one incident, without a model; and the sources of merged events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.keyed import number_in_group, pack, spread
from newsloom.operators.similar import shingles, similar_groups
from newsloom.session import materialize

KEYS = ["event_date", "merged_id"]


def merge_events(dated: DataFrame, threshold: float = 0.5, width: int = 3, **options) -> dict[str, DataFrame]:
    """Flat tables ``events``, ``members``, ``actors`` of merged events.

    Events of one date merge when their titles and details are near copies. ``merged_id`` is the smallest member id;
    title and details are those of that member; actors come without repeats in the order of the members. Everything
    is kept flat, so a merged event may have any number of members.
    """
    texts = spread(dated.select("event_date", "id", "event", "details"))
    rows = texts.select(
        "event_date",
        F.col("id").cast("bigint").alias("n"),
        shingles(F.concat_ws(" ", "event", "details"), width).alias("tokens"),
    )
    labels = materialize(similar_groups(rows, ["event_date"], "n", "tokens", threshold, **options), "merged")
    labels = labels.withColumnRenamed("component", "merged_id")
    numbered = dated.withColumn("n", F.col("id").cast("bigint"))
    heads = labels.where(F.col("n") == F.col("merged_id"))
    events = numbered.select("event_date", "n", "event", "details").join(heads, ["event_date", "n"]).select(
        *KEYS, "event", "details"
    )
    members = labels.select(*KEYS, F.col("n").alias("member_pos"), F.col("n").cast("string").alias("id"))
    named = numbered.select("event_date", "n", F.posexplode("actors").alias("i", "actor"))
    actors = (
        named.join(labels, ["event_date", "n"])
        .where(F.col("actor").isNotNull())
        .groupBy(*KEYS, "actor")
        .agg(F.min(F.struct("n", "i")).alias("p"))
        .select(*KEYS, F.col("p.n").alias("member_pos"), F.col("p.i").alias("actor_pos"), "actor")
    )
    return {"events": events, "members": members, "actors": actors}


def merged_sources(members: DataFrame, dated: DataFrame) -> DataFrame:
    """Distinct ``(title, article_url, published_date)`` of each merged event, numbered in first-seen order.

    Member ids that no event has are skipped. ``source_pos`` is the place of the first member with that source.
    """
    articles = dated.select("event_date", "id", "title", "article_url", "published_date")
    return (
        members.join(articles, ["event_date", "id"])
        .groupBy(*KEYS, "title", "article_url", "published_date")
        .agg(F.min("member_pos").alias("source_pos"))
    )


def nest_merged(
    events: DataFrame, actors: DataFrame, sources: DataFrame, size: int = 10_000, chunk_bits: int = 16
) -> DataFrame:
    """One row per merged event and chunk, with ordered ``actors`` and ``sources`` lists of at most ``size`` items."""
    order = [c for c in ("member_pos", "actor_pos") if c in actors.columns]
    named = number_in_group(actors, KEYS, order, "n", chunk_bits)
    named = pack(named, KEYS, "n", F.col("actor"), size, "actors")
    linked = number_in_group(sources, KEYS, ["source_pos", "article_url", "title", "published_date"], "n", chunk_bits)
    linked = pack(linked, KEYS, "n", F.struct("title", "article_url", "published_date"), size, "sources")
    lists = named.join(linked, [*KEYS, "chunk"], "full")
    empty_names = F.array().cast("array<string>")
    empty_sources = F.array().cast("array<struct<title:string,article_url:string,published_date:string>>")
    return events.join(lists, KEYS, "left").select(
        *KEYS,
        F.coalesce("chunk", F.lit(0)).alias("chunk"),
        "event",
        "details",
        F.coalesce("actors", empty_names).alias("actors"),
        F.coalesce("sources", empty_sources).alias("sources"),
    )
