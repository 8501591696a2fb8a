"""Joins, numbering and packing that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import materialize

HOT_ROWS = 1_000_000
SALTS = 32
MAX_HOT_KEYS = 1_000


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def spread(df: DataFrame, task_bytes: int = 16 << 20) -> DataFrame:
    """Rows over all cores before heavy per-row work, when the input is too small to give every core a split.

    A file of one row group is one task however many cores wait. Input with a full split for every core stays as it
    is and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) < cores * task_bytes else df


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS, max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """The keys with most rows, at most ``max_keys`` of them, so the list is always small enough to broadcast.

    A key that misses the list holds less than one ``max_keys``-th of the rows and needs no salt.
    """
    counts = df.select(*on).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= hot_rows)
    return counts.orderBy(F.desc("_rows"), *on).limit(max_keys).select(*on)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread: Sequence[str] | None = None,
    hot: DataFrame | None = None,
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    small_bytes: int | None = None,
) -> DataFrame:
    """Equi-join of a skewed left side with a right side of few rows per key; any of inner, left, semi and anti.

    While the right side is below the broadcast limit Spark copies it to every task and nothing is shuffled.
    Beyond it, the rows of hot left keys are spread over ``salts`` tasks by a hash of the ``spread`` columns
    and only the right rows of those keys are repeated. No row is dropped in either form. Hot keys are given in
    ``hot``, or counted in ``hot_from``, a stored table with the keys of the left side, so that a left side that is
    costly to compute is not computed for the count.
    """
    on = list(on)
    limit = broadcast_limit(left) if small_bytes is None else small_bytes
    if estimated_bytes(right) <= limit:
        return left.join(right, on, how)
    hot = hot_keys(left if hot_from is None else hot_from, on, hot_rows) if hot is None else hot.select(*on)
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    spread = spread or [c for c in left.columns if c not in on] or on
    salted = (
        left.join(hot, on, "left")
        .withColumn("_salt", F.when(F.col("_hot") | no_key, F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(0))
        .drop("_hot")
    )
    repeats = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(hot, on, "left").withColumn("_salt", F.explode(repeats)).drop("_hot")
    repeated = repeated.withColumn("_salt", F.col("_salt").cast("bigint"))
    salted = salted.withColumn("_salt", F.col("_salt").cast("bigint"))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def number_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "number", chunk_bits: int = 16
) -> DataFrame:
    """``1..n`` per group in the given order, without one task ever holding a whole group.

    Group columns are not null. The first order column must be a non-negative row position. Its high bits cut every group into chunks of at
    most ``2**chunk_bits`` positions; rows are numbered inside a chunk, and each chunk is moved up by the
    number of rows in the chunks before it, which is a running sum over one row per chunk.
    """
    group = list(group)
    chunk = F.shiftright(F.col(order[0]), chunk_bits)
    sizes = df.select(*group, chunk.alias("_chunk")).groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    moves = sizes.select(*group, "_chunk", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_chunk").orderBy(*order)
    numbered = df.withColumn("_chunk", chunk).withColumn("_inside", F.row_number().over(inside))
    # The join keys are those of the window, so the rows are shuffled once for both.
    return (
        numbered.join(moves, [*group, "_chunk"], "left")
        .withColumn(out, F.col("_inside") + F.coalesce("_before", F.lit(0)))
        .select(*df.columns, out)
    )


def number_all(df: DataFrame, order: Sequence[str | Column], out: str = "number", label: str = "numbered") -> DataFrame:
    """Dense ``1..n`` over the whole table in the given order.

    One range shuffle sorts the rows; a row number is its place in its own part plus the sizes of the parts before.
    The sorted rows are written first, so that both uses see the same parts.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = materialize(parts.withColumn("_place", F.monotonically_increasing_id()), label)
    part = F.shiftright("_place", 33)
    sizes = parts.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part of the range shuffle, so this window and the broadcast are small whatever the table holds.
    moves = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    place = F.col("_place") - F.shiftleft(F.col("_part"), 33)
    return (
        parts.withColumn("_part", part)
        .join(F.broadcast(moves), "_part")
        .withColumn(out, place + F.col("_before") + 1)
        .select(*df.columns, out)
    )


def pack(
    df: DataFrame, keys: Sequence[str], number: str, row: Column, size: int, out: str, chunk: str = "chunk"
) -> DataFrame:
    """Ordered lists of at most ``size`` rows: one output row per key and chunk of consecutive numbers."""
    rows = df.select(
        *keys,
        F.floor((F.col(number) - 1) / size).cast("bigint").alias(chunk),
        F.struct(F.col(number).alias("_n"), row.alias("_row")).alias("_item"),
    )
    packed = rows.groupBy(*keys, chunk).agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    return packed.select(*keys, chunk, F.transform("_items", lambda item: item["_row"]).alias(out))


def chunk_units(df: DataFrame, group: Sequence[str], unit: str, order: Sequence[str], size: int, out: str = "chunk") -> DataFrame:
    """Cuts each group into chunks of at most ``size`` rows that keep units whole, as far as a unit fits.

    A group of up to ``size`` rows is chunk 0. Beyond, rows are ordered by unit: units of up to half of ``size`` go to the
    chunk of the half their first row falls into, so a chunk holds less than two halves; units of up to ``size`` have a
    chunk of their own, larger ones are cut by place. Chunk numbers rise but may leave gaps.
    """
    group = list(group)
    # Null-safe and even: rows are numbered over the whole table, then places are told apart by aggregated starts.
    numbered = materialize(number_all(df, [*group, unit, *order], "_place", "units"), "units")
    units = numbered.groupBy(*group, unit).agg(F.min("_place").alias("_from"), F.count(F.lit(1)).alias("_rows"))
    groups = units.groupBy(*group).agg(F.min("_from").alias("_start"), F.sum("_rows").alias("_all"))
    # Without group columns there is one row of totals.
    units = units.join(groups, group) if group else units.join(F.broadcast(groups))
    half = max(size // 2, 1)
    start = F.col("_from") - F.col("_start")
    # Two numbers for each half: one for the units that share it, one for a larger unit that begins in it.
    base = F.floor(start / half) * 2
    units = materialize(
        units.select(
            *group, unit, "_from", "_rows",
            F.when(F.col("_all") <= size, F.lit(0)).when(F.col("_rows") <= half, base).otherwise(base + 1).cast("bigint").alias("_base"),
            (F.col("_all") > size).alias("_cut"),
        ),
        "units",
    )
    hot = units.where(F.col("_rows") >= HOT_ROWS).orderBy(F.desc("_rows")).limit(MAX_HOT_KEYS)
    met = salted_join(numbered, units.drop("_rows"), [*group, unit], spread=["_place"], hot=hot)
    # A unit over ``size`` covers at least two halves, whose numbers no other unit takes.
    inside = F.when(F.col("_cut"), F.floor((F.col("_place") - F.col("_from")) / size) * 2).otherwise(0)
    return met.select(*df.columns, (F.col("_base") + inside).cast("bigint").alias(out))
