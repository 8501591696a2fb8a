"""Merged events as a star schema of six tables.

Keys are the MD5 of the natural key: they need no counter, no lookup and no insert order, are the same in every run,
and make the link tables plain projections. `dense_ids` numbers a table where integers are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import label_to_date
from newsloom.operators.entities import ACTOR
from newsloom.operators.keyed import number_all


def stable_key(*parts: str | Column) -> Column:
    """128-bit key of a natural key; a null part differs from an empty one."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("\u0001", *texts))


def event_key() -> Column:
    return stable_key("event_date", "merged_id")


def dictionary_actors(aliases: DataFrame) -> DataFrame:
    """``label``: the canonical names of the actor dictionary."""
    return aliases.where(F.col("kind") == ACTOR).select(F.col("canonical").alias("label")).distinct()


def new_actors(event_actors: DataFrame, known: DataFrame) -> DataFrame:
    """``label``: actors of events that the dictionary does not have."""
    used = event_actors.select(F.col("actor").alias("label")).where(F.col("label").isNotNull()).distinct()
    return used.join(known, "label", "left_anti")


def actors_dim(aliases: DataFrame, event_actors: DataFrame) -> DataFrame:
    known = dictionary_actors(aliases)
    labels = known.unionByName(new_actors(event_actors, known))
    return labels.select(stable_key("label").alias("actor_key"), "label")


def aliases_dim(aliases: DataFrame) -> DataFrame:
    """``actor_key, alias`` for every variant that is not its own label."""
    rows = aliases.where((F.col("kind") == ACTOR) & (F.col("variant") != F.col("canonical")))
    return rows.select(stable_key("canonical").alias("actor_key"), F.col("variant").alias("alias"))


def sources_dim(merged_sources: DataFrame) -> DataFrame:
    """One row per url; title and date are those seen first in date, event and source order."""
    order = ["event_date", "merged_id", "source_pos", "title", "published_date"]
    first = merged_sources.groupBy(F.col("article_url").alias("url")).agg(F.min(F.struct(*order)).alias("s"))
    return first.select(
        stable_key("url").alias("source_key"),
        F.col("s.title").alias("title"),
        "url",
        label_to_date(F.col("s.published_date")).alias("published_date"),
    )


def split_dated_sources(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): a source must have a url, a title and a date."""
    good = F.col("url").isNotNull() & F.col("title").isNotNull() & F.col("published_date").isNotNull()
    return sources.where(good), sources.where(~good)


def events_dim(merged_events: DataFrame) -> DataFrame:
    return merged_events.select(event_key().alias("event_key"), "event_date", F.col("event").alias("label"), "details")


def event_actor_links(merged_actors: DataFrame) -> DataFrame:
    """One row per actor listed, repeats included."""
    return merged_actors.select(event_key().alias("event_key"), stable_key("actor").alias("actor_key"))


def event_source_links(merged_sources: DataFrame) -> DataFrame:
    """One row per source listed, repeats included."""
    return merged_sources.select(event_key().alias("event_key"), stable_key("article_url").alias("source_key"))


def build_star(parts: dict[str, DataFrame], aliases: DataFrame) -> dict[str, DataFrame]:
    """Six tables from the flat ``events``, ``actors`` and ``sources`` of merged events."""
    good, rejected = split_dated_sources(sources_dim(parts["sources"]))
    return {
        "actors": actors_dim(aliases, parts["actors"]),
        "actor_aliases": aliases_dim(aliases),
        "sources": good,
        "rejected_sources": rejected,
        "events": events_dim(parts["events"]),
        "event_actors": event_actor_links(parts["actors"]),
        "event_sources": event_source_links(parts["sources"]),
    }


def dense_ids(table: DataFrame, order: Sequence[str], out: str = "id") -> DataFrame:
    """``1..n`` in the given order, by a range shuffle and part offsets."""
    return number_all(table, list(order), out, "ids")


def preview(table: DataFrame, rows: int = 3) -> DataFrame:
    return table.limit(rows)
