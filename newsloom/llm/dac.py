"""Directly addressable codes: token ids cut into byte levels, so that any id is found without decoding those before it."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, chunks, tasks, text_bytes
from newsloom.llm.encoding import encoder
from newsloom.session import materialize

#: Ids are below 2**32 and a chunk is one byte, so there are at most four levels.
LEVELS = 4
#: Positions per entry of a rank directory.
BLOCK = 512
MAGIC = b"DAC1"


def encode_file(ids: np.ndarray, documents: list[tuple[int | None, int]]) -> bytes:
    """One file: ids by levels, and a directory of ``(doc_id, ids)`` in file order.

    Level 0 holds the low byte of every id; the next level holds the next byte of those ids that go on, and so forth.
    Each level has a bitmap of the ids that go on and, for every ``BLOCK`` positions, the number of set bits before.
    """
    left = ids.astype(np.uint32)
    body = []
    for _ in range(LEVELS):
        chunk, left = (left & np.uint32(255)).astype(np.uint8), left >> np.uint32(8)
        goes_on = left > 0
        padded = np.zeros(-(-len(chunk) // BLOCK) * BLOCK, dtype=bool)
        padded[: len(chunk)] = goes_on
        ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, BLOCK).sum(axis=1))]).astype("<u8")
        body += [struct.pack("<Q", len(chunk)), chunk.tobytes(), np.packbits(padded, bitorder="little").tobytes(), ranks.tobytes()]
        left = left[goes_on]
        if not len(left):
            break
    keys = np.array([0 if d is None else d for d, _ in documents], dtype="<i8")
    named = np.packbits(np.array([d is not None for d, _ in documents], dtype=bool), bitorder="little")
    starts = np.concatenate([[0], np.cumsum([n for _, n in documents])]).astype("<u8")
    head = MAGIC + struct.pack("<QI", len(documents), len(body) // 4)
    return head + keys.tobytes() + named.tobytes() + starts.tobytes() + b"".join(body)


class File:
    """Random access to the ids of one file."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        documents, levels = struct.unpack_from("<QI", data, 4)
        at = 16

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(data, kind, count, at)
            at += values.nbytes
            return values

        keys = take("<i8", documents)
        named = np.unpackbits(take("u1", -(-documents // 8)), bitorder="little")
        self.documents = [int(k) if n else None for k, n in zip(keys, named)]
        self.starts = take("<u8", documents + 1).astype(np.int64)
        self._levels = []
        for _ in range(levels):
            count = int(take("<u8", 1)[0])
            blocks = -(-count // BLOCK)
            self._levels.append((take("u1", count), take("u1", blocks * BLOCK // 8), take("<u8", blocks + 1)))

    def __len__(self) -> int:
        return len(self._levels[0][0]) if self._levels else 0

    def _rank(self, level: int, position: int) -> int:
        """How many ids before ``position`` go on: one directory entry and the bits of one block."""
        _, bits, ranks = self._levels[level]
        block = position // BLOCK
        inside = np.unpackbits(bits[block * BLOCK // 8 : -(-position // 8)], bitorder="little", count=position - block * BLOCK)
        return int(ranks[block]) + int(inside.sum())

    def get(self, position: int) -> int:
        """The id at a position, through as many levels as it has bytes."""
        value = 0
        for level, (chunk, bits, _) in enumerate(self._levels):
            value |= int(chunk[position]) << (8 * level)
            if not (bits[position // 8] >> (position % 8)) & 1:
                break
            position = self._rank(level, position)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range; each level is entered by rank, and only this range is read."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        chunk, bits, _ = self._levels[0]
        ids = chunk[start:stop].astype(np.uint32)
        places = np.arange(stop - start)
        for level in range(1, len(self._levels)):
            first = start // 8
            flags = np.unpackbits(bits[first : -(-stop // 8)], bitorder="little")[start - first * 8 :][: stop - start]
            places = places[flags.astype(bool)]
            if not len(places):
                break
            start = self._rank(level - 1, start)
            stop = start + len(places)
            chunk, bits, _ = self._levels[level]
            ids[places] |= chunk[start:stop].astype(np.uint32) << np.uint32(8 * level)
        return ids


FILE_SCHEMA = "part long, file long, n_ids long, data binary"


def write_files(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", file_ids: int = 1 << 16) -> DataFrame:
    """``(part, file, n_ids, data)``: files of about ``file_ids`` ids, ascending by key over parts and files.

    Rows are dealt to parts by quantiles of the key and sorted inside a part, so texts are shuffled once; a part is
    written file by file and never held whole. Every document lies in one file. A null text has only the end id; a
    null key comes first; rows that repeat a key stand together, ordered by text. Other columns are not read. The
    files are stored as rows in the shared folder, so a lost executor costs no more than its running tasks.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = tasks(spark)
    rows = docs.select(F.col(key).cast("long").alias("_key"), text_bytes(F.col(text)).alias("_text"))
    dealt = rows.withColumn("_part", part_of(rows, "_key", parts))
    ordered = dealt.repartition(parts, "_part").sortWithinPartitions("_part", "_key", "_text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        part, number, held, ids, count = None, 0, [], [], 0

        def flush():
            nonlocal number, held, ids, count
            data = encode_file(np.frombuffer(b"".join(ids), "<u4"), held)
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "file": [number], "n_ids": [count], "data": [data]},
                schema=pa.schema([("part", pa.int64()), ("file", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())]),
            )
            number, held, ids, count = number + 1, [], [], 0
            return row

        for batch, texts in chunks(batches, "_text"):
            keys, places = batch.column("_key").to_pylist(), batch.column("_part").to_pylist()
            for doc, place, found in zip(keys, places, tokens.many(texts)):
                if held and (place != part or count + len(found) // 4 > file_ids):
                    yield flush()
                if place != part:
                    part, number = place, 0
                held.append((doc, len(found) // 4))
                ids.append(found)
                count += len(found) // 4
        if held:
            yield flush()

    return materialize(ordered.mapInArrow(pack, FILE_SCHEMA), "dac")


def part_of(rows: DataFrame, key: str, parts: int) -> F.Column:
    """The part, 0 and up, that a key belongs to: ascending parts hold ascending keys, about equally many each.

    The driver learns one quantile per part. Nulls belong to the first part.
    """
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted(set(rows.approxQuantile(key, shares, 0.25 / parts))) if shares else []
    if not bounds:
        return F.lit(0).cast("long")
    # How many bounds a key reaches, found by halving rather than by one comparison for each bound.
    stored = F.array(*[F.lit(int(b)) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def reach(place: F.Column, step: F.Column) -> F.Column:
        next_ = place + step
        return F.when((next_ <= len(bounds)) & (F.get(stored, next_ - 1) <= F.col(key)), next_).otherwise(place)

    return F.aggregate(steps, F.lit(0), reach).cast("long")


READ_SCHEMA = "part long, file long, doc_id long, at long, n_tokens long, ids_crc32 long"


def read_documents(files: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the files.

    ``start`` counts the ids of all documents before; it is a running sum over one row per part, then over the files
    of a part, and the place inside the file.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, data in zip(*(batch.column(c).to_pylist() for c in ("part", "file", "data"))):
                file = File(data)
                starts = file.starts
                ids = file.slice(0, len(file)).astype("<u4", copy=False)
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), starts[1:].tolist())]
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part)), pa.array(np.full(n, number)), pa.array(file.documents, pa.int64()),
                        pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(sums, pa.int64()),
                    ],
                    names=["part", "file", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    bounded_batches(files.sparkSession)
    found = files.select("part", "file", "data").mapInArrow(unpack, READ_SCHEMA)
    running = Window.rowsBetween(Window.unboundedPreceding, -1)
    sizes = files.select("part", "file", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per part: as many as the session has shuffle partitions.
    parts = parts.select("part", F.coalesce(F.sum("n").over(running.orderBy("part")), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("n_ids").over(running.partitionBy("part").orderBy("file")), F.lit(0))
    moves = sizes.select("part", "file", inside.alias("_inside")).join(F.broadcast(parts), "part")
    return found.join(moves, ["part", "file"]).select(
        "doc_id", (F.col("_before") + F.col("_inside") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )

