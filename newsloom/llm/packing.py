"""Bounded-space online packing of documents into fixed windows of token ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, chunks, text_bytes
from newsloom.llm.encoding import encoder
from newsloom.session import materialize

SIZE = 2048
#: Windows that a task keeps open.
OPEN = 16
#: Tasks whose leftovers meet in one task of the next merging round.
FAN_IN = 32

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "left_ids binary, part long"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("left_ids", pa.binary()), ("part", pa.int64())]
)


class Packer:
    """Places pieces into at most ``open_windows`` open windows, best fit first.

    When a piece fits nowhere, the fullest window is topped up with the head of the piece and emitted; so a window
    leaves only when it is full, and what pads is left to the windows that are open at the end.
    """

    def __init__(self, size: int = SIZE, open_windows: int = OPEN):
        self.size, self.open_windows = size, open_windows
        self.windows: list[list] = []  # [used, [(doc, start, ids, doc_tokens), ...]]

    def add(self, doc, start: int, ids: memoryview, total: int) -> Iterator[list]:
        """Yields the pieces of every window that this piece fills; ids are four bytes each."""
        while len(ids) // 4 >= self.size:
            yield [(doc, start, ids[: self.size * 4], total)]
            start, ids = start + self.size, ids[self.size * 4 :]
        while len(ids):
            n = len(ids) // 4
            fitting = [w for w in self.windows if w[0] + n <= self.size]
            if fitting:
                window = max(fitting, key=lambda w: w[0])
                taken = n
            elif len(self.windows) < self.open_windows:
                window = [0, []]
                self.windows.append(window)
                taken = n
            else:
                window = max(self.windows, key=lambda w: w[0])
                taken = self.size - window[0]
            window[1].append((doc, start, ids[: taken * 4], total))
            window[0] += taken
            if window[0] == self.size:
                self.windows.remove(window)
                yield window[1]
            start, ids = start + taken, ids[taken * 4 :]

    def rest(self, last: bool) -> list[list]:
        """The open windows; if ``last``, joined into full ones and one that is not."""
        left, self.windows = [w[1] for w in sorted(self.windows, key=lambda w: -w[0])], []
        if not last:
            return left
        joined, out = Packer(self.size, 1), []
        for window in left:
            for piece in window:
                out += joined.add(*piece)
        return out + [w[1] for w in joined.windows]


def _rows(windows: list[tuple[int, list, bool]], part: int) -> pa.RecordBatch:
    columns = {name: [] for name in _ARROW.names}
    for sequence, pieces, left in windows:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            row = (doc, start, n, zlib.crc32(ids), total, sequence, offset, bytes(ids) if left else None, part)
            for name, value in zip(_ARROW.names, row):
                columns[name].append(value)
            offset += n
    return pa.RecordBatch.from_pydict(columns, schema=_ARROW)


def _packed(pieces: Iterator[list[tuple]], level: int, size: int, open_windows: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Arrow rows of all windows that the groups of ``pieces`` fill, then of the windows left open."""
    part = TaskContext.get().partitionId()
    packer = Packer(size, open_windows)
    base = (level << 56) | (part << 32)
    number = 0
    for group in pieces:
        done = []
        for piece in group:
            for window in packer.add(*piece):
                done.append((base | number, window, False))
                number += 1
        if done:
            yield _rows(done, part)
    left = packer.rest(last)
    if left:
        yield _rows([(base | (number + i), window, not last) for i, window in enumerate(left)], part)


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    open_windows: int = OPEN,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, one row per piece.

    Documents are encoded and packed where they are read, without a shuffle. A window of ``size`` ids leaves when it is
    full. The windows that a task has open at its end (at most ``open_windows``, so a few ids for each task whatever it
    read) are merged by tasks of ``fan_in`` such parts, again and again, until one task joins the last of them; in
    all, one sequence at most needs padding. A null or empty text is its end id alone. Null and repeated keys are
    packed like others; other columns are not read. Each round is written, so its pieces stay as they are when an
    executor is lost.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("_key"), text_bytes(F.col(text)).alias("_text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)

        def pieces():
            for batch, texts in chunks(batches, "_text"):
                keys = batch.column("_key").to_pylist()
                yield [(k, 0, memoryview(ids), len(ids) // 4) for k, ids in zip(keys, tokens.many(texts))]

        yield from _packed(pieces(), 0, size, open_windows, False)

    def merge(level: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def pieces():
                for batch in batches:
                    columns = [batch.column(c).to_pylist() for c in ("doc_id", "start", "left_ids", "doc_tokens")]
                    yield [(k, s, memoryview(i), n) for k, s, i, n in zip(*columns)]

            yield from _packed(pieces(), level, size, open_windows, last)

        return run

    written = materialize(rows.mapInArrow(first, SCHEMA), "packed")
    done = [written.where(F.col("left_ids").isNull())]
    left = written.where(F.col("left_ids").isNotNull())
    level, parts = 1, (left.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        last = parts <= fan_in
        tasks = -(-parts // fan_in)
        grouped = left.withColumn("_group", F.floor(F.col("part") / fan_in)).repartition(tasks, "_group")
        ordered = grouped.sortWithinPartitions("part", "sequence_id", "offset").drop("_group")
        written = materialize(ordered.mapInArrow(merge(level, last), SCHEMA), "packed")
        done.append(written.where(F.col("left_ids").isNull()))
        left = written.where(F.col("left_ids").isNotNull())
        if last:
            break
        level, parts = level + 1, tasks
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("left_ids", "part")
