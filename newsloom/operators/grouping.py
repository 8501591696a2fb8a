"""Dated events: filter, order and numbering by date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.keyed import number_in_group, pack

NARROW = ["event", "details", "actors", "location", "article_url", "title", "published_date"]
MERGE_INPUT = ["id", "event", "details", "actors"]


def drop_undated(entities: DataFrame) -> DataFrame:
    return entities.where(F.col("event_date").isNotNull() & (F.col("event_date") != ""))


def number_events(entities: DataFrame, chunk_bits: int = 16) -> DataFrame:
    """Undated events dropped, and ``id`` = '1'..'n' per date in article, then entity order."""
    dated = number_in_group(
        drop_undated(entities), ["event_date"], ["article_pos", "entity_pos"], out="id", chunk_bits=chunk_bits
    )
    return dated.withColumn("id", F.col("id").cast("string"))


def sort_by_date(dated: DataFrame) -> DataFrame:
    return dated.orderBy("event_date", F.col("id").cast("bigint"))


def group_events_by_date(dated: DataFrame, size: int = 10_000) -> DataFrame:
    """Ordered event lists per date, cut into chunks of ``size`` so that a busy date is several rows.

    A date with at most ``size`` events is one row, ``chunk`` 0.
    """
    fields = [c for c in dated.columns if c not in ("event_date", "article_pos", "entity_pos")]
    rows = dated.withColumn("_number", F.col("id").cast("bigint"))
    return pack(rows, ["event_date"], "_number", F.struct(*fields), size, "events")


def narrow_events(dated: DataFrame) -> DataFrame:
    return dated.select("event_date", *NARROW)


def merge_input(dated: DataFrame) -> DataFrame:
    """The columns a merge stage sees, picked before any Python code since Catalyst cannot prune inside it."""
    return dated.select("event_date", *MERGE_INPUT)
