"""Chat formatting by columnar byte assembly.

Rows of turns arrive sorted, as Arrow columns. The bytes of a batch are laid out in numpy: lengths of all segments, their
cumulative offsets, and scatter indices that copy marks, roles and contents into one buffer made beforehand, which becomes
the text column as it is. The loss mask is a list of byte ranges, known from the same offsets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import bounded_batches, keyed_schema, lists

#: A conversation with more formatted bytes goes on in a further row.
PIECE = 1 << 20


@dataclass(frozen=True)
class Template:
    """Marks around the turns, and the strings that no content may hold as they are.

    A content is escaped in two steps: ``escape`` is doubled, then every control string gets one after its first
    character. A single ``escape`` is therefore always an inserted one, and ``plain`` gives the content back.
    """

    start: str = "<|turn|>"
    middle: str = "<|text|>"
    end: str = "<|end|>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    escape: str = "\x1b"
    loss_role: str = "assistant"

    def __post_init__(self) -> None:
        strings = self.strings
        if len(self.escape) != 1 or any(len(s) < 2 or self.escape in s for s in strings):
            raise ValueError("control strings need two characters and none of the escape")
        for a in strings:
            for b in strings:
                ties = any(a.endswith(b[:i]) for i in range(1, len(b)))
                if ties or (a != b and a in b):
                    raise ValueError(f"control strings overlap: {a!r} and {b!r}")

    @property
    def strings(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((self.start, self.middle, self.end, *self.controls)))

    def escaped(self, text: Column) -> Column:
        text = F.replace(text, F.lit(self.escape), F.lit(self.escape * 2))
        for string in self.strings:
            text = F.replace(text, F.lit(string), F.lit(string[0] + self.escape + string[1:]))
        return text

    def plain(self, text: str) -> str:
        if self.escape not in text:
            return text
        mark = re.escape(self.escape)
        return re.sub(f"{mark}({mark}?)", r"\1", text)


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column without nulls, and the offsets of its values in them."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held, offsets


def assemble(segments: list[bytes | tuple[np.ndarray, np.ndarray]], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with the segments of every row in turn, and the offsets of all segments, ``rows`` x segments + 1.

    A segment is a constant, or the bytes and offsets of a column.
    """
    count = len(segments)
    lengths = np.empty((rows, count), np.int64)
    for at, segment in enumerate(segments):
        lengths[:, at] = len(segment) if isinstance(segment, bytes) else np.diff(segment[1])
    offsets = np.zeros(rows * count + 1, np.int64)
    np.cumsum(lengths.ravel(), out=offsets[1:])
    buffer = np.empty(int(offsets[-1]), np.uint8)
    starts = offsets[:-1].reshape(rows, count)
    for at, segment in enumerate(segments):
        if isinstance(segment, bytes):
            buffer[starts[:, at, None] + np.arange(len(segment))] = np.frombuffer(segment, np.uint8)
        else:
            data, places = segment
            source = np.arange(int(places[0]), int(places[-1]))
            # Where a byte goes: its place in the column, moved by as much as its row is moved.
            buffer[source + np.repeat(starts[:, at] - places[:-1], lengths[:, at])] = data[places[0] : places[-1]]
    return buffer, offsets


def _runs(keys: pa.Array) -> np.ndarray:
    """True where a row has another key than the row before; nulls are equal."""
    codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.concatenate([[True], codes[1:] != codes[:-1]])


def _pieces(rows: pa.Table, first: np.ndarray, template: Template) -> pa.RecordBatch:
    """Formatted pieces of whole rows; ``first`` marks the row that begins a piece."""
    columns = {name: rows.column(name).combine_chunks() for name in rows.column_names}
    begins = np.flatnonzero(first)
    segments: list = [template.start.encode(), string_bytes(columns["_role"]), template.middle.encode()]
    segments += [string_bytes(columns["_text"]), template.end.encode()]
    buffer, offsets = assemble(segments, rows.num_rows)
    bounds = offsets[:: len(segments)]
    ends = np.append(begins[1:], rows.num_rows)
    text_offsets = np.append(bounds[begins], bounds[-1])
    text = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(text_offsets), pa.py_buffer(buffer))
    masked = columns["_loss"].to_numpy(zero_copy_only=False).astype(bool)
    piece = np.cumsum(first) - 1
    held = np.append(0, np.cumsum(np.bincount(piece[masked], minlength=len(begins))))
    inside = np.flatnonzero(masked)
    origin = text_offsets[piece[inside]]
    spans = [lists(held, pa.array(offsets[inside * len(segments) + at] - origin)) for at in (3, 4)]
    return pa.RecordBatch.from_arrays(
        [columns["_key"].take(pa.array(begins)), text.cast(pa.string()), *spans, pa.array(ends - begins)],
        names=["_key", "text", "loss_starts", "loss_ends", "n_turns"],
    )


def format_turns(
    df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    template: Template = Template(), piece: int = PIECE,
) -> DataFrame:
    """``(key, part, place, open, text, loss_starts, loss_ends, n_turns)``: formatted conversations.

    Turns are ordered by number (null first), those of one number by role and a hash of the text. A null role or text
    is empty; rows of a null key are one conversation. Other columns are not read. A conversation is one row, or several
    of about ``piece`` bytes that follow each other by ``(part, place)``: rows are dealt by ranges of conversation *and*
    turn, so one that holds a third of all rows is formatted by many tasks. ``open`` marks rows whose conversation may
    have other rows. The loss mask is the byte range of each content of the loss role.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = df.select(
        F.col(key).alias("_key"), F.col(turn).alias("_turn"), role_.alias("_name"), text_.alias("_plain"),
        F.xxhash64(text_).alias("_hash"),
    )
    order = ["_key", "_turn", "_name", "_hash"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "_key", F.spark_partition_id().alias("_part"), (F.col("_name") == template.loss_role).alias("_loss"),
        template.escaped(F.col("_name")).alias("_role"), template.escaped(F.col("_plain")).alias("_text"),
    )
    bounded_batches(df.sparkSession)
    columns = keyed_schema(rows, "part int, place long, open boolean, text string, loss_starts array<long>, loss_ends array<long>, n_turns long")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, part, before = 0, 0, None

        def finish(found: pa.RecordBatch, closed: np.ndarray) -> pa.RecordBatch:
            nonlocal place
            size = found.num_rows
            places = pa.array(np.arange(place, place + size))
            place += size
            arrays = [found.column(0), pa.array([part] * size, pa.int32()), places, pa.array(~closed), *found.columns[1:]]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        def cut(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch | pa.Table]:
            """Formats the whole conversations and, of the last one, whole pieces; the rest is handed back."""
            nonlocal before
            keys = rows.column("_key").combine_chunks()
            run = _runs(keys)
            sizes = np.cumsum(_bytes(rows))
            # A piece ends where its conversation does, or when it holds ``piece`` bytes.
            begun = np.flatnonzero(run)
            since = sizes - np.repeat(np.append(0, sizes)[begun], np.diff(np.append(begun, len(run))))
            level = since // piece
            first = run.copy()
            first[1:] |= level[1:] != level[:-1]
            stop = rows.num_rows if last else int(np.flatnonzero(first)[-1])
            if stop:
                starts = np.flatnonzero(first[:stop])
                number = np.cumsum(run)[starts]
                several = np.bincount(number)[number] > 1
                closed = ~several
                # The first and the last conversation of a task, and one cut by the end of what is held, may go on.
                closed[number == number[-1]] &= stop < rows.num_rows and bool(run[stop])
                if before is None:
                    closed[number == 1] = False
                elif before == keys[0].as_py():
                    closed[number == 1] = False
                before = keys[stop - 1].as_py()
                yield finish(_pieces(rows.slice(0, stop), first[:stop], template), closed)
            yield rows.slice(stop)

        target, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("_part")[0].as_py()
            table = pa.Table.from_batches([batch])
            if target is None:
                kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
                target = pa.schema(list(zip(["_key", *columns.names[1:]], [batch.schema.field("_key").type, *kinds])))
            table = table if held is None else pa.concat_tables([held, table])
            held = None
            for found in cut(table, False):
                if isinstance(found, pa.Table):
                    held = found
                else:
                    yield found
        if held is not None and held.num_rows:
            for found in cut(held, True):
                if not isinstance(found, pa.Table):
                    yield found

    found = rows.mapInArrow(made, columns)
    return found.select(F.col("_key").alias(key), *columns.names[1:])


def _bytes(rows: pa.Table) -> np.ndarray:
    parts = [pc.binary_length(rows.column(c)).to_numpy() for c in ("_role", "_text")]
    return np.sum(parts, axis=0, dtype=np.int64)


def read_back(formatted: DataFrame, key: str = "conv_id", template: Template = Template()) -> DataFrame:
    """Per conversation, parsed from the formatted rows: turns, their digest, and the digest of all text under the mask.

    A conversation in one row is finished where that row is read. Rows of the others (at most two conversations for each
    task, and very long ones) are brought together and hashed one after the other, without ever being held together.
    """
    bounded_batches(formatted.sparkSession)
    rows = formatted.select(F.col(key).alias("_key"), *[c for c in formatted.columns if c != key])
    measures = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    parsed_type = keyed_schema(rows, f"part int, place long, {measures}, turns binary, loss binary")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            names = ("text", "open", "loss_starts", "loss_ends")
            for text, is_open, starts, ends in zip(*(batch.column(c).to_pylist() for c in names)):
                turns = []
                for turn in text.split(template.end)[:-1]:
                    name, content = turn.removeprefix(template.start).split(template.middle)
                    turns += [template.plain(name), "\n", template.plain(content), "\n"]
                raw = text.encode()
                loss = "".join(template.plain(raw[a:b].decode()) for a, b in zip(starts, ends))
                turns_raw, loss_raw = "".join(turns).encode(), loss.encode()
                digests = (None, None) if is_open else (hashlib.sha256(turns_raw).hexdigest(), hashlib.sha256(loss_raw).hexdigest())
                blobs = (turns_raw, loss_raw) if is_open else (None, None)
                for column, value in zip(out, (len(turns) // 4, digests[0], len(loss), digests[1], len(text), *blobs)):
                    column.append(value)
            arrays = [pa.array(v, t) for v, t in zip(out, kinds[2:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("part"), batch.column("place"), *arrays], names=["_key", *parsed_type.names[1:]]
            )

    parsed = rows.mapInArrow(parse, parsed_type)
    dealt = parsed.repartition("_key").sortWithinPartitions("_key", "part", "place")
    result_type = keyed_schema(rows, measures)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        held, state, kind = None, None, None

        def close() -> list:
            turns, digest, loss, loss_digest, chars = state
            return [held[0], turns, digest.hexdigest(), loss, loss_digest.hexdigest(), chars]

        def batch_of(found: list[list]) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 6
            arrays = [pa.array(c, t) for c, t in zip(columns, [kind, *kinds])]
            return pa.RecordBatch.from_arrays(arrays, names=["_key", *result_type.names[1:]])

        for batch in batches:
            kind, out = batch.schema.field("_key").type, []
            names = ("_key", *result_type.names[1:], "turns", "loss")
            for doc, n, digest, chars, loss_digest, size, turns, loss in zip(*(batch.column(c).to_pylist() for c in names)):
                if held is not None and (digest is not None or held != (doc,)):
                    out.append(close())
                    held = None
                if digest is not None:
                    out.append([doc, n, digest, chars, loss_digest, size])
                    continue
                if held is None:
                    held, state = (doc,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1].update(turns)
                state[3].update(loss)
                state = [state[0] + n, state[1], state[2] + chars, state[3], state[4] + size]
            yield batch_of(out)
        if held is not None:
            yield batch_of([close()])

    result = dealt.mapInArrow(join, result_type)
    return result.select(F.col("_key").alias(key), *result_type.names[1:])


def with_conversation(df: DataFrame, number: int, turns: list[tuple[str, str]]) -> DataFrame:
    """The turns of a table and one conversation more."""
    names = ["conv_id", "turn", "role", "text"]
    kinds = T.StructType([T.StructField(c, df.schema[c].dataType) for c in names])
    more = df.sparkSession.createDataFrame([(number, at, role, text) for at, (role, text) in enumerate(turns)], kinds)
    return df.select(*names).unionByName(more)
