"""Tokens as packed 64-bit numbers: word runs of texts, and the tokens that several sets share.

Tokens of many sets travel together in one binary value, so a shuffle moves few rows however many tokens there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
#: Tokens that a task holds at a time.
HELD = 1 << 19
#: Place in the order for tokens that were known to be hot before the count: behind all others.
LAST = np.uint32(0xFFFFFFFF)

DEALT = "bucket long, docs binary, sizes binary, tokens binary"
COUNTED = "block long, docs binary, sizes binary, tokens binary, counts binary"
UNPACKED = "g long, t long"
LISTED = "doc long, n int, need int, shared array<bigint>"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def mixed_with(tokens: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Numbers of tokens inside groups, without two tokens of a group under one number."""
    return mixed(tokens ^ mixed(groups))


@contextmanager
def batch_rows(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Large rows reach Python in batches of at most so many, for jobs that are run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(usual)) if int(usual) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def _powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64."""
    steps = np.full(n, base % (1 << 64), U64)
    steps[:1] = 1
    return np.cumprod(steps)


def packed_sets(numbers: np.ndarray, sizes: np.ndarray, null: pa.BooleanArray) -> pa.BinaryArray:
    """The numbers of each set as bytes; the sets lie one after the other."""
    offsets = np.concatenate([[0], np.cumsum(8 * sizes)]).astype(np.int32)
    valid = pa.array(~null.to_numpy(zero_copy_only=False), pa.bool_()).buffers()[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [valid, pa.py_buffer(offsets), pa.py_buffer(numbers)])


class WordRuns:
    """Numbers of the words of UTF-8 texts and of their runs, many texts at a time.

    A word's number is that of its bytes as a polynomial, so sums over a whole chunk give those of all its words.
    """

    #: Bytes of the texts taken at a time; a larger text is taken alone.
    CHUNK = 1 << 18
    _base = int(GOLDEN)
    _letters = mixed(np.arange(1, 257, dtype=U64) * GOLDEN)
    #: The blanks of the JVM's pattern \s.
    _blank = np.isin(np.arange(256), list(b" \t\n\v\f\r"))

    def __init__(self, width: int):
        self._width = width
        self._up = self._down = np.empty(0, U64)

    def _words(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words, and the number of words before each end of a text."""
        inside = ~self._blank[data]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        # A text that ends in a word may lie before one that begins with a word.
        border = ends[(ends > 0) & (ends < len(data))]
        opens[border] = inside[border]
        closes[border - 1] = inside[border - 1]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        if len(data) > len(self._up):
            self._up = _powers(self._base, max(len(data), self.CHUNK))
            self._down = _powers(pow(self._base, -1, 1 << 64), len(self._up))
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(self._letters[data] * self._up[: len(data)])])
        numbers = (sums[last] - sums[first]) * self._down[first]
        return mixed(numbers + (last - first).astype(U64) * GOLDEN), np.searchsorted(first, ends)

    def _joined(self, numbers: np.ndarray, width: int) -> np.ndarray:
        """The number of each run of ``width`` words, also of those that reach into the next text."""
        n = len(numbers) - width + 1
        runs = np.full(n, U64(width))
        for step in range(width):
            runs = mixed(runs * GOLDEN + numbers[step : step + n])
        return runs

    def _chunk(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct runs of the texts of a chunk, one text after the other, and how many each has."""
        numbers, at = self._words(data, ends)
        words = np.diff(at)
        sizes = np.where(words < self._width, np.minimum(words, 1), words - self._width + 1)
        to = np.concatenate([[0], np.cumsum(sizes)])
        runs = np.empty(to[-1], U64)
        if len(numbers) >= self._width:
            full = np.where(words < self._width, 0, sizes)
            # The place of a run among the words is its place in its text behind the words before that text.
            place = np.arange(full.sum()) + np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(full)[:-1]]), full)
            runs[np.repeat(words >= self._width, sizes)] = self._joined(numbers, self._width)[place]
        for i in np.flatnonzero((words > 0) & (words < self._width)):
            runs[to[i]] = self._joined(numbers[at[i] : at[i + 1]], int(words[i]))[0]
        runs = runs.view(np.int64)
        for i, j in zip(to[:-1].tolist(), to[1:].tolist()):
            runs[i:j].sort()
        new = np.concatenate([np.ones(min(len(runs), 1), bool), runs[1:] != runs[:-1]])
        new[to[:-1][sizes > 0]] = True
        return runs[new], np.diff(np.concatenate([[0], np.cumsum(new)])[to])

    def sets(self, texts: pa.BinaryArray) -> pa.BinaryArray:
        """The packed sets of a column of texts; a null stays one."""
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
        found, sizes, start = [np.empty(0, np.int64)], [], 0
        while start < len(texts):
            stop = max(int(np.searchsorted(ends, ends[start] + self.CHUNK, "right")) - 1, start + 1)
            runs, counts = self._chunk(data[ends[start] : ends[stop]], ends[start : stop + 1] - ends[start])
            found.append(runs)
            sizes.append(counts)
            start = stop
        return packed_sets(np.concatenate(found), np.concatenate([np.empty(0, np.int64), *sizes]), texts.is_null())


def run_numbers(text: Column, width: int) -> Column:
    """Sorted numbers of the distinct runs of ``width`` words, packed; a shorter text is one run, a null has none at all."""

    @F.arrow_udf("binary")
    def numbers(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        runs = WordRuns(width)
        for texts in batches:
            yield runs.sets(texts.cast(pa.binary()))

    return numbers(text.cast("binary"))


def packed_numbers(numbers: Column) -> Column:
    """An array of 64-bit numbers, packed."""

    @F.arrow_udf("binary")
    def pack(lists: pa.Array) -> pa.Array:
        sizes = np.diff(lists.offsets.to_numpy().astype(np.int64))
        return packed_sets(lists.flatten().to_numpy(), np.where(lists.is_null(), 0, sizes), lists.is_null())

    return pack(numbers)


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``g, set`` to one row ``g, t`` for each token of the packed sets."""
    for batch in batches:
        for g, numbers in zip(batch.column("g").to_pylist(), batch.column("set").to_pylist()):
            t = np.frombuffer(numbers, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), g, np.int64)), pa.array(t)], names=["g", "t"])


def _packed(cuts: np.ndarray, *columns: np.ndarray) -> list[list[bytes]]:
    """Each column cut at the given places."""
    ends = [*cuts[1:], len(columns[0])]
    return [[c[a:b].tobytes() for a, b in zip(cuts, ends)] for c in columns]


def _starts(x: np.ndarray) -> np.ndarray:
    """Places where a run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)


def _row_chunks(batch: pa.RecordBatch, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of rows with up to ``HELD`` tokens, or one larger row."""
    start = 0
    while start < batch.num_rows:
        stop = max(int(np.searchsorted(ends, ends[start] + HELD, "right")) - 1, start + 1)
        yield start, stop
        start = stop


def deal(buckets: int, hot: list[tuple[int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``doc, g, set`` to ``DEALT``: the tokens of some packed sets at a time, by ranges of their numbers.

    ``g`` is the number of the set's group, and a token of two groups is two tokens. Tokens of ``hot`` (group, token) go
    to buckets of their own, many for each, from ``buckets`` on.
    """
    pairs = np.array(hot, np.int64).reshape(-1, 2)
    known = np.sort(mixed_with(pairs[:, 1].copy().view(U64), pairs[:, 0].copy().view(U64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, groups = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "g"))
            sets = batch.column("set")
            _, offsets, data = sets.buffers()
            ends = np.frombuffer(offsets, np.int32, len(sets) + 1, 4 * sets.offset).astype(np.int64) // 8
            numbers = np.frombuffer(data, U64, ends[-1])
            for start, stop in _row_chunks(batch, ends):
                sizes = np.diff(ends[start : stop + 1])
                tokens = mixed_with(numbers[ends[start] : ends[stop]], np.repeat(groups[start:stop].view(U64), sizes))
                # The upper half of a token, as a share of its range.
                bucket = ((tokens >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    bucket[known[at] == tokens] = buckets + int(docs[start]) % buckets
                # Sixteen bits are sorted by counting.
                order = np.argsort(bucket.astype(np.uint16) if 2 * buckets <= 1 << 16 else bucket, kind="stable")
                owner = np.repeat(np.arange(stop - start), sizes)[order]
                bucket = bucket[order]
                cuts = _starts(bucket)
                packed = _packed(cuts, docs[start:stop][owner], sizes[owner].astype(np.uint32), tokens[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts]), *(pa.array(p, pa.binary()) for p in packed)],
                    names=["bucket", "docs", "sizes", "tokens"],
                )

    return run


def _gathered(batches: Iterator[pa.RecordBatch], key: str, types: dict[str, type]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns of all consecutive rows with one key, joined."""
    held, of = [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in types]
        for now, row in zip(batch.column(key).to_pylist(), zip(*columns)):
            if held and now != of:
                yield of, [np.frombuffer(b"".join(c), t) for c, t in zip(zip(*held), types.values())]
                held = []
            of = now
            held.append(row)
    if held:
        yield of, [np.frombuffer(b"".join(c), t) for c, t in zip(zip(*held), types.values())]


def count(buckets: int, block_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``DEALT`` in the order of buckets to ``COUNTED``: tokens that several sets hold, by blocks of sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, (docs, sizes, tokens) in _gathered(batches, "bucket", {"docs": np.int64, "sizes": np.uint32, "tokens": U64}):
            if bucket >= buckets:
                counts = np.full(len(docs), LAST)
            else:
                order = np.argsort(tokens)
                cuts = _starts(tokens[order])
                lengths = np.diff(np.append(cuts, len(order))).astype(np.uint32)
                counts = np.repeat(lengths, lengths)
                order, counts = order[counts > 1], counts[counts > 1]
                docs, sizes, tokens = docs[order], sizes[order], tokens[order]
            blocks = docs >> block_bits
            order = np.argsort(blocks, kind="stable")
            blocks = blocks[order]
            cuts = _starts(blocks)
            packed = _packed(cuts, docs[order], sizes[order], tokens[order], counts[order])
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks[cuts]), *(pa.array(p, pa.binary()) for p in packed)],
                names=["block", "docs", "sizes", "tokens", "counts"],
            )

    return run


def listed(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``COUNTED`` in the order of blocks to ``LISTED``: sets with enough shared tokens to be like another, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"docs": np.int64, "sizes": np.uint32, "tokens": U64, "counts": np.uint32}
        for _, (docs, sizes, tokens, counts) in _gathered(batches, "block", types):
            order = np.argsort(docs, kind="stable")
            starts = _starts(docs[order])
            heads = docs[order][starts]
            shared = np.diff(np.append(starts, len(order)))
            n = sizes[order][starts].astype(np.int64)
            # The small step back keeps a product that is whole but for rounding from being raised to the next number.
            need = shared - np.ceil(n * threshold - 1e-9).astype(np.int64) + 1
            stays = need > 0
            order = order[np.repeat(stays, shared)]
            owner = np.repeat(np.arange(int(stays.sum())), shared[stays])
            order = order[np.lexsort((tokens[order], counts[order], owner))]
            ends = np.concatenate([[0], np.cumsum(shared[stays])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads[stays]), pa.array(n[stays], pa.int32()), pa.array(need[stays], pa.int32()), lists],
                names=["doc", "n", "need", "shared"],
            )

    return run
