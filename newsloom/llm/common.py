"""What the operators of this folder share: text columns as bytes, batches of bounded size, memoised words, hot-key joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
#: Rows of one Arrow batch, so that a run of very long texts stays small in memory.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Texts reach Python in batches of at most ``BATCH_ROWS`` rows (a setting of the session)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


@contextmanager
def wide_batches(spark: SparkSession, rows: int = 50_000):
    """Rows of a few numbers reach Python in larger batches, for jobs that are run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; none of a null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of a key as text, modulo ``divisor``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def tasks(spark: SparkSession) -> int:
    """How many parts an explicit repartition makes: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches whose texts hold about ``size`` bytes, or one longer text; each with its texts."""
    for batch in batches:
        texts = batch.column(text).to_pylist()
        start = held = 0
        for at, value in enumerate(texts):
            if held and held + len(value) > size:
                yield batch.slice(start, at - start), texts[start:at]
                start, held = at, 0
            held += len(value) + 1
        if start < len(texts):
            yield batch.slice(start), texts[start:]


class Memo(dict):
    """Remembers ``make(key)`` for up to ``limit`` keys, then starts anew."""

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._make(key)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def keyed_schema(rows: DataFrame, columns: str, key: str = "_key") -> T.StructType:
    """The type of the key, whatever it is, followed by ``name type, name type, ...``."""
    return T.StructType([T.StructField(key, rows.schema[key].dataType), *T.StructType.fromDDL(columns).fields])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column has."""
    while name in df.columns:
        name = "_" + name
    return name


def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def hot_join(left: DataFrame, right: DataFrame, on: Sequence[str], rows: str, share: int = 1000) -> DataFrame:
    """Left join with ``right``, which has one row per key and, in ``rows``, the number of left rows of that key.

    Keys with at least one ``share``-th of all left rows are fewer than ``share`` + 1, so they are broadcast and their
    left rows stay where they are; no key of the shuffled rest holds more. ``left`` and ``right`` must be stored.
    Null keys match nothing and are kept.
    """
    on = list(on)
    total = right.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("t")).first()["t"]
    hot = F.col(rows) * F.lit(share) >= F.lit(total)
    few, rest = right.where(hot).drop(rows), right.where(~hot).drop(rows)
    names = [c for c in left.columns] + [c for c in few.columns if c not in on]
    kept = left.join(F.broadcast(few.select(*on)), on, "left_anti").join(rest, on, "left").select(*names)
    return left.join(F.broadcast(few), on, "inner").select(*names).unionByName(kept)
