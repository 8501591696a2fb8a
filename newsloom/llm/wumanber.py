"""Wu-Manber search of benchmark passages in documents, over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, chunks, keyed_schema, text_bytes
from newsloom.session import materialize

WINDOW = 10
#: Windows of the test set that one pass over the documents searches; more are searched in further passes.
BLOCK_WINDOWS = 200_000

# Bytes 0-9, a-z and those of other scripts make words; A-Z count as a-z; any other byte stands between words.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Table:
    """Patterns of one length: shifts by the last two words of the search window, and buckets by their suffix.

    ``shift[block]`` says how far the window may move on without missing a pattern: the distance from the right-most
    place of the block in any pattern to the pattern's end, or the whole length but one for a block that is in none.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], tuple], length: int):
        self.length = length
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for words in patterns:
            for end in range(self.block, length + 1):
                block = words[end - 1] if self.block == 1 else words[end - 2 : end]
                self.shift[block] = min(self.shift.get(block, self.default), length - end)
            suffix = words[-1] if self.block == 1 else words[-2:]
            self.buckets.setdefault(suffix, []).append(words)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """``(end, pattern)`` of every occurrence."""
        shift, default, length, n = self.shift, self.default, self.length, len(words)
        at = length - 1
        single = self.block == 1
        while at < n:
            block = words[at] if single else (words[at - 1], words[at])
            move = shift.get(block, default)
            if move:
                at += move
                continue
            window = words[at - length + 1 : at + 1]
            for pattern in self.buckets.get(block, ()):
                if pattern[0] == window[0] and list(pattern) == window:
                    yield at + 1, pattern
            at += 1


def windows_of(words: list[bytes], window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Every run of ``window`` words; a shorter item is one run, an item without words has none."""
    if not words:
        return []
    if len(words) <= window:
        return [tuple(words)]
    return [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]


def _cut(items: list[tuple], window: int, block_windows: int) -> Iterator[dict[tuple[bytes, ...], set]]:
    """Blocks of about ``block_windows`` windows, each with the ids of its items."""
    block: dict[tuple[bytes, ...], set] = {}
    for item, text in items:
        for run in windows_of(words_of(text), window):
            block.setdefault(run, set()).add(item)
        if len(block) >= block_windows:
            yield block
            block = {}
    if block:
        yield block


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``(key, n_words, n_hit, n_items, items_sha256, contaminated)`` of every document row.

    The test set is the stated query set. It is read item by item and searched in blocks of ``block_windows`` windows:
    only one block is on the driver and in a broadcast at a time, and each block is one pass over the documents,
    without a shuffle of texts. In the usual case there is one block, and the result comes straight from that pass.
    With more blocks, each pass writes the hit words of the rows it hit, and these are joined.
    Null and empty texts have no words; an item that is null or without words has no window; a null item id takes part
    under the empty name; items that repeat an id are one; rows that repeat a key are judged each for itself.
    Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(key).alias("_key"), text_bytes(F.col(text)).alias("_text"))
    questions = benchmark.select(F.col(item).cast("string").alias("_item"), text_bytes(F.col(item_text)).alias("_text"))
    items = ((r["_item"] or "", bytes(r["_text"])) for r in questions.toLocalIterator())
    blocks = _cut(items, window, block_windows)
    first, second = next(blocks, {}), next(blocks, None)
    if second is None:
        return _searched(rows, first, key)
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "documents")
    parts = [materialize(_spans(rows, block), "hits") for block in _chained(first, second, blocks)]
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return _joined(rows, found, key)


def _chained(first, second, rest):
    yield first
    yield second
    yield from rest


def _tables(block: dict[tuple[bytes, ...], set]) -> list[Table]:
    lengths = sorted({len(p) for p in block})
    return [Table({p: () for p in block if len(p) == n}, n) for n in lengths]


_built: dict = {}


def _search(words: list[bytes], tables: list[Table], block: dict) -> tuple[list[tuple[int, int]], set]:
    spans, items = [], set()
    for table in tables:
        for end, pattern in table.search(words):
            spans.append((end - table.length, end))
            items |= block[pattern]
    return spans, items


def _covered(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _prepared(shared) -> tuple[dict, list[Table]]:
    """The tables of a block, built once in each worker."""
    if shared.value["id"] not in _built:
        _built.clear()
        block = shared.value["block"]
        _built[shared.value["id"]] = (block, _tables(block))
    return _built[shared.value["id"]]


def _shared(spark, block: dict):
    import uuid

    return spark.sparkContext.broadcast({"id": uuid.uuid4().hex, "block": block})


def _searched(rows: DataFrame, block: dict, key: str) -> DataFrame:
    shared = _shared(rows.sparkSession, block)
    schema = keyed_schema(rows, "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, tables = _prepared(shared)
        for batch, texts in chunks(batches, "_text"):
            n_words, n_hit, n_items, digests = [], [], [], []
            for text in texts:
                words = words_of(text)
                spans, items = _search(words, tables, patterns)
                n_words.append(len(words))
                n_hit.append(sum(b - a for a, b in _covered(spans)))
                n_items.append(len(items))
                digests.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array(n_items, pa.int64()), pa.array(digests, pa.string()), pa.array(np.array(n_hit) > 0, pa.bool_()),
                ],
                names=["_key", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return rows.mapInArrow(run, schema).withColumnRenamed("_key", key)


def _spans(rows: DataFrame, block: dict) -> DataFrame:
    """``(_row, _spans, _items)`` of the rows that a block hits."""
    shared = _shared(rows.sparkSession, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, tables = _prepared(shared)
        for batch, texts in chunks(batches, "_text"):
            out = {"_row": [], "_spans": [], "_items": []}
            for row, text in zip(batch.column("_row").to_pylist(), texts):
                spans, items = _search(words_of(text), tables, patterns)
                if spans:
                    out["_row"].append(row)
                    out["_spans"].append([{"a": a, "b": b} for a, b in _covered(spans)])
                    out["_items"].append(sorted(items))
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            schema = pa.schema([("_row", pa.int64()), ("_spans", kind), ("_items", pa.list_(pa.string()))])
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return rows.mapInArrow(run, "_row long, _spans array<struct<a: bigint, b: bigint>>, _items array<string>")


def _joined(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Hit words and items over all blocks: spans of a row are merged, items of a row are sorted."""
    merged = found.groupBy("_row").agg(
        F.array_sort(F.flatten(F.collect_list("_spans"))).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_items"),
    )
    # A span counts from where those before it have ended.
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    covered = F.aggregate(
        "_spans",
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["to"]))).alias("n"),
            F.greatest(acc["to"], s["b"]).alias("to"),
        ),
    )["n"]
    hits = merged.select("_row", covered.alias("n_hit"), "_items")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "_text"):
            n = pa.array([len(words_of(t)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_row"), n], names=["_key", "_row", "n_words"])

    counted = rows.select("_key", "_row", "_text").mapInArrow(count, keyed_schema(rows, "_row long, n_words long"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return counted.join(hits, "_row", "left").select(
        F.col("_key").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("_items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("_items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
