"""Embedding whitening by polarisation: cov(a, b) = (var(a + b) - var(a) - var(b)) / 2, from exact sums of squares.

Tasks square centred whole numbers only: one sum for every dimension and one for the sum of every pair of dimensions.
The sums are added up by Spark, so the driver receives one row per pair of dimensions, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import bounded_batches, keyed_schema

SCALE, SHIFT = 1024, 100_000
#: Entries are held inside this range of whole numbers, where a double still counts one by one.
REACH = 1 << 50
#: An eigenvalue below this share of the largest, per dimension, is rounding: the vectors do not spread that way.
FLAT = np.finfo(np.float64).eps
EXACT = pa.decimal128(38, 0)


def whole(batch: pa.RecordBatch, vector: str, dimensions: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a batch, and their entries as whole numbers, one row each.

    Null and empty vectors and those with a null or non-finite entry are no usable ones. Vectors of several lengths
    have no covariance: that is an error.
    """
    column = batch.column(vector)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column)
    values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    places = np.flatnonzero((lengths > 0) & (bad[ends] == bad[ends - lengths]))
    sizes = set(lengths[places].tolist()) | ({dimensions} if dimensions else set())
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths have no common covariance: {sorted(sizes)}")
    if not len(places):
        return places, np.empty((0, dimensions or 0), np.int64)
    taken = values if len(places) == len(lengths) else values[np.repeat(np.isin(np.arange(len(lengths)), places), lengths)]
    scaled = np.clip(np.floor(SCALE * taken), -REACH, REACH).astype(np.int64) + SHIFT
    return places, scaled.reshape(len(places), -1)


def exact_squares(values: np.ndarray) -> list[int]:
    """Sum of squares of every column, exact: in 64 bits where they hold it, in whole numbers of any size otherwise."""
    most = int(np.abs(values).max(initial=0))
    if most * most * max(len(values), 1) < 1 << 62:
        return np.einsum("ij,ij->j", values, values).tolist()
    return [sum(v * v for v in column) for column in values.T.tolist()]


@dataclass
class Whitening:
    """What was learned from the vectors of a fit: exact counts and sums, eigenvalues and components.

    Component ``k`` is row ``k`` of ``components``; eigenvalues fall. ``scales`` is 1 / sqrt(eigenvalue), and 0 where
    the vectors do not spread.
    """

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def spreads(self) -> np.ndarray:
        top = self.eigenvalues.max(initial=0.0)
        return self.eigenvalues > max(top, 0.0) * FLAT * len(self.sums)

    @property
    def explained(self) -> np.ndarray:
        return np.where(self.spreads, self.eigenvalues, 0.0) / (self.trace or 1.0)

    def whiten(self, values: np.ndarray) -> np.ndarray:
        """Centred, projected, scaled; NaN for components without spread."""
        middle = np.array([round(s / self.n) if self.n else 0 for s in self.sums], np.int64)
        rest = np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, middle)])
        projected = ((values - middle).astype(np.float64) - rest) @ self.components.T
        return np.divide(projected, np.sqrt(np.where(self.spreads, self.eigenvalues, 1.0))) + np.where(self.spreads, 0.0, np.nan)


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of usable vectors, and the exact sum of every dimension."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            _, values = whole(batch, "_vector", None if total is None else len(total))
            if not len(values):
                continue
            # Halves, so that no sum of a batch leaves 64 bits.
            low, high = (values & 0xFFFF).sum(0).tolist(), (values >> 16).sum(0).tolist()
            sums = [a + (b << 16) for a, b in zip(low, high)]
            total = sums if total is None else [a + b for a, b in zip(total, sums)]
            n += len(values)
        if n:
            size = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()), pa.array(total, EXACT)], names=["d", "n", "s"]
            )

    parts = rows.select("_vector").mapInArrow(part, "d int, n long, s decimal(38,0)")
    found = parts.groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("d").collect()
    if len({r["n"] for r in found}) > 1:
        raise ValueError("vectors of different lengths have no common covariance")
    return (found[0]["n"] if found else 0), [int(r["s"]) for r in found]


def _squares(rows: DataFrame, middle: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of ``(a_i - m_i + a_j - m_j) ** 2`` for every pair i < j, and of ``(a_i - m_i) ** 2`` for i = j."""
    size = len(middle)
    centre = np.array(middle, np.int64)
    left, right = np.triu_indices(size)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * len(left)
        for batch in batches:
            _, values = whole(batch, "_vector", size)
            if not len(values):
                continue
            values = values - centre
            found = []
            for i in range(size):
                found += exact_squares(values[:, i : i + 1])
                found += exact_squares(values[:, i : i + 1] + values[:, i + 1 :])
            total = [a + b for a, b in zip(total, found)]
        if any(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(left)), pa.int32()), pa.array(total, EXACT)], names=["p", "q"])

    parts = rows.select("_vector").mapInArrow(part, "p int, q decimal(38,0)")
    found = parts.groupBy("p").agg(F.sum("q").cast("decimal(38,0)").alias("q")).collect()
    by_pair = {r["p"]: int(r["q"]) for r in found}
    return {(int(i), int(j)): by_pair.get(p, 0) for p, (i, j) in enumerate(zip(left, right))}


def fit(df: DataFrame, vector: str = "embedding") -> Whitening:
    """Two passes over the vectors: exact sums, then exact squares around the whole numbers next to the means.

    With m the whole number, r = S - n m the rest of a sum and Q the sum of squares around m, n**2 times the variance
    is n Q - r**2, exactly; the same holds for the sum of two dimensions. Only the last division is rounded.
    """
    rows = df.select(F.col(vector).alias("_vector"))
    n, sums = _sums(rows)
    if not n:
        return Whitening(0, [], 0.0, np.empty(0), np.empty((0, 0)))
    middle = [round(s / n) for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    squares = _squares(rows, middle)
    size = len(sums)
    variance = {(i, j): n * q - (rest[i] if i == j else rest[i] + rest[j]) ** 2 for (i, j), q in squares.items()}
    covariance = np.empty((size, size))
    for (i, j), value in variance.items():
        exact = 2 * value if i == j else value - variance[i, i] - variance[j, j]
        covariance[i, j] = covariance[j, i] = exact / (2 * n * n)
    values, vectors = np.linalg.eigh(covariance)
    trace = sum(variance[i, i] for i in range(size)) / (n * n)
    return Whitening(n, sums, trace, values[::-1], vectors[:, ::-1].T.copy())


def identity_error(df: DataFrame, model: Whitening, components: int, vector: str = "embedding") -> float | None:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity.

    Over the components with spread; null without any. The vectors are centred before they are multiplied.
    """
    kept = np.flatnonzero(model.spreads[:components])
    if not len(kept):
        return None
    size, count = len(model.sums), len(kept)
    left, right = np.triu_indices(count)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second, seen = np.zeros(count), np.zeros((count, count)), False
        for batch in batches:
            _, values = whole(batch, "_vector", size)
            white = model.whiten(values)[:, kept]
            first, second, seen = first + white.sum(0), second + white.T @ white, True
        if seen:
            sums = np.concatenate([first, second[left, right]])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["p", "v"])

    parts = df.select(F.col(vector).alias("_vector")).mapInArrow(part, "p int, v double")
    found = {r["p"]: r["v"] / model.n for r in parts.groupBy("p").agg(F.sum("v").alias("v")).collect()}
    means = [found[i] for i in range(count)]
    return max(
        abs(found[count + p] - means[i] * means[j] - (i == j)) for p, (i, j) in enumerate(zip(left.tolist(), right.tolist()))
    )


def transform(df: DataFrame, model: Whitening, components: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(key, component, whitened, deviation, deviation_exact)``: a row for each usable vector and component.

    ``deviation`` is null where it is beyond a long; ``deviation_exact`` holds it always. ``whitened`` is null for a
    component without spread.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(vector).alias("_vector"))
    n, sums, size = model.n, model.sums, len(model.sums)
    count = min(components, size)
    columns = keyed_schema(rows, "component int, whitened double, deviation long, deviation_exact decimal(38,0)")
    schema = T.StructType([T.StructField(key, columns["_key"].dataType), *columns.fields[1:]])
    middle = [round(s / n) if n else 0 for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    rest_square = sum(r * r for r in rest)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.array(middle, np.int64)
        for batch in batches:
            places, values = whole(batch, "_vector", size)
            if not len(places) or not count:
                continue
            white = model.whiten(values)[:, :count]
            values = values - centre
            # Sum over dimensions of (n y - r)**2, with y around the whole number next to the mean.
            squares = exact_squares(values.T)
            most = int(np.abs(values).max(initial=0)) * max(map(abs, rest), default=0) * size
            crossed = values @ np.array(rest, np.int64) if most < 1 << 62 else values.astype(object) @ np.array(rest, object)
            deviations = [n * n * q - 2 * n * c + rest_square for q, c in zip(squares, crossed.tolist())]
            again = pa.array(np.repeat(np.arange(len(places)), count))
            keys = batch.column("_key").take(pa.array(places))
            longs = pa.array([d if d < 1 << 63 else None for d in deviations], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(again), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(places))),
                    pa.array(white.ravel(), from_pandas=True), longs.take(again), pa.array(deviations, EXACT).take(again),
                ],
                names=[key, "component", "whitened", "deviation", "deviation_exact"],
            )

    return rows.mapInArrow(part, schema)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """Whitened coordinates on the first ``components`` principal components, with the measures of the fit.

    The vectors are read four times (sums, squares, check, output), nothing is written, and only sums are shuffled.
    Vectors that are null or empty or hold a null or non-finite entry are left out; other columns are not read; a null
    or repeated key is a row like any other. Without usable vectors there are no rows. Components without spread (few
    or equal vectors) have null ``whitened`` and explain 0. Entries beyond 2**50 after scaling are held at that bound.
    """
    bounded_batches(df.sparkSession)
    model = fit(df, vector)
    error = identity_error(df, model, components, vector)
    share: Column = F.lit(None).cast("double")
    if model.n:
        share = F.get(F.array(*[F.lit(float(e)) for e in model.explained[:components]]), F.col("component") - 1)
    return transform(df, model, components, key, vector).select(
        key, "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"),
        F.lit(error).cast("double").alias("identity_error"), "deviation_exact",
    )
