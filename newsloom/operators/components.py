"""Connected components by alternating star contraction (large-star / small-star)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.keyed import HOT_ROWS, MAX_HOT_KEYS, salted_join
from newsloom.session import discard, materialize, scratch


def star_edges(
    members: DataFrame,
    bucket: Sequence[str],
    node: str,
    group: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """``(group, src, dst)``: every member of a bucket linked to the first and to the last node of the bucket.

    Two edges per member replace the pairs inside a bucket, so the output grows with the members only. Buckets of one
    node, mostly the bulk, leave before the join; the rest is written, so that its size decides how it is joined.
    """
    bucket = list(bucket)
    ends = members.groupBy(*bucket).agg(
        F.min(node).alias("_first"), F.max(node).alias("_last"), F.count(F.lit(1)).alias("_rows")
    )
    ends = materialize(ends.where(F.col("_first") < F.col("_last")), "ends")
    hot = ends.where(F.col("_rows") >= hot_rows).orderBy(F.desc("_rows")).limit(MAX_HOT_KEYS)
    linked = salted_join(members, ends.drop("_rows"), bucket, spread=[node], hot=hot, small_bytes=small_bytes)
    pairs = linked.select(*group, F.col(node).alias("src"), F.explode(F.array("_first", "_last")).alias("dst"))
    return pairs.where(F.col("src") != F.col("dst")).distinct()


def _with_minimum(edges: DataFrame, key: list[str], value: str, hot_rows: int, small_bytes: int | None) -> DataFrame:
    """Each edge with the smallest ``value`` among the edges of its key."""
    least = edges.groupBy(*key).agg(F.min(value).alias("_least"), F.count(F.lit(1)).alias("_degree"))
    hot = least.where(F.col("_degree") >= hot_rows).orderBy(F.desc("_degree")).limit(MAX_HOT_KEYS)
    return salted_join(edges, least.drop("_degree"), key, spread=[value], hot=hot, small_bytes=small_bytes)


def connected_components(
    edges: DataFrame,
    group: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    small_bytes: int | None = None,
    max_rounds: int = 100,
) -> DataFrame:
    """``(group, node, component)`` for every node of ``edges(group, src, dst)``; the component is its smallest node.

    Each round replaces the edges by the edges of the contracted stars, written to the shared folder.
    It ends when only stars around smallest nodes are left.
    """
    group = list(group)
    high, low = F.greatest("src", "dst"), F.least("src", "dst")
    current = edges.select(*group, high.alias("u"), low.alias("v")).where("u <> v").distinct()
    current = materialize(current, "edges")
    for _ in range(max_rounds):
        if _all_stars(current, group):
            break
        with scratch(current.sparkSession) as keep:
            following = keep(materialize(_contracted(current, group, hot_rows, small_bytes), "edges"))
        discard(current)
        current = following
    else:
        raise RuntimeError("components did not settle")
    members = current.select(*group, F.col("u").alias("node"), F.col("v").alias("component"))
    centres = current.select(*group, F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(centres)


def _contracted(current: DataFrame, group: list[str], hot_rows: int, small_bytes: int | None) -> DataFrame:
    """The edges after one large-star and one small-star step."""
    both = current.select(*group, F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        current.select(*group, F.col("v").alias("a"), F.col("u").alias("b"))
    )
    large = (
        _with_minimum(both, [*group, "a"], "b", hot_rows, small_bytes)
        .where(F.col("b") > F.col("a"))
        .select(*group, F.col("b").alias("u"), F.least("_least", "a").alias("v"))
        .distinct()
    )
    small = _with_minimum(large, [*group, "u"], "v", hot_rows, small_bytes)
    pairs = F.array(
        F.struct(F.col("u"), F.col("_least").alias("v")), F.struct(F.col("v").alias("u"), F.col("_least").alias("v"))
    )
    following = small.select(*group, F.explode(pairs).alias("p")).select(*group, "p.u", "p.v")
    return following.where("u <> v").distinct()


def _all_stars(edges: DataFrame, group: list[str]) -> bool:
    """True when every ``u`` has one ``v`` and no ``v`` is a ``u``: then each edge points at its component.

    Both sides of the join are distinct, so a hub is one row here; the driver learns only how many rows are left.
    """
    heads = edges.groupBy(*group, "u").agg(F.count(F.lit(1)).alias("_n"))
    centres = edges.select(*group, F.col("v").alias("u")).distinct().withColumn("_centre", F.lit(True))
    unsettled = heads.join(centres, [*group, "u"], "left").where((F.col("_n") > 1) | F.col("_centre"))
    return unsettled.count() == 0
