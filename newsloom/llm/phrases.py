"""Document fingerprints by locally consistent parsing: deterministic coin tossing names phrases, level by level."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import GOLDEN, U64, bounded_batches, mixed, tasks
from newsloom.llm.dac import part_of

#: Slots of a fingerprint; each gives four hexadecimal digits.
SLOTS = 64
#: Phrases of this level and above take part: about 3**2 characters and more.
FIRST_LEVEL = 2
_EMPTY = np.iinfo(np.uint64).max


def parse(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: names of the phrases of each owner's symbols, and their owners.

    Runs of one symbol become one symbol. Then each symbol is told from the one before by the lowest bit in which they
    differ, three times over, which leaves labels below eight that differ between neighbours. A phrase starts at each
    local maximum of the labels. So where a phrase starts depends on a few symbols around it only, not on its offset.
    ``symbols`` are code points (32 bits, the upper eleven free for the length of a run) or names (64 bits).
    """
    kind = symbols.dtype.type
    new = np.empty(len(symbols), bool)
    new[0] = True
    new[1:] = (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])
    if not new.all():
        at = np.flatnonzero(new)
        runs = np.diff(np.append(at, len(symbols)))
        symbols, owner = symbols[at], owner[at]
        long = np.flatnonzero(runs > 1)
        lengths = mixed(runs[long].astype(U64))
        symbols[long] ^= (lengths >> U64(53) << U64(21)).astype(kind) if kind is np.uint32 else mixed(lengths + symbols[long])

    opens = np.empty(len(symbols), bool)
    opens[0] = True
    opens[1:] = owner[1:] != owner[:-1]
    labels = symbols
    for _ in range(3):
        one = labels.dtype.type(1)
        differ = np.empty_like(labels)
        differ[1:] = labels[1:] ^ labels[:-1]
        differ[opens] = one
        low = np.bitwise_count((differ & (~differ + one)) - one)
        labels = (low << np.uint8(1)) | ((labels >> low) & one).astype(np.uint8)
    peak = np.zeros(len(symbols), bool)
    peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # The last symbol of an owner has no right neighbour to be compared with.
    peak[:-1] &= ~opens[1:]
    starts = np.flatnonzero(peak | opens)
    place = np.arange(len(symbols), dtype=np.int32) - np.repeat(starts.astype(np.int32), np.diff(np.append(starts, len(symbols))))
    names = mixed(np.add.reduceat(symbols.astype(U64) * _WEIGHTS[place & 63], starts))
    return names, owner[starts]


#: An odd number for each place of a phrase.
_WEIGHTS = mixed(np.arange(1, 65, dtype=U64) * GOLDEN) | U64(1)


def phrase_names(texts: list[str], first_level: int = FIRST_LEVEL) -> tuple[np.ndarray, np.ndarray]:
    """``(names, owner)``: the phrases of all levels from ``first_level`` on, and the top name of each text."""
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    symbols = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4") + np.uint32(1)
    names, owners, level = [], [], 0
    while len(symbols):
        symbols, owner = parse(symbols, owner)
        level += 1
        top = np.bincount(owner, minlength=len(texts))[owner] == 1
        taken = slice(None) if level >= first_level else top
        names.append(symbols[taken])
        owners.append(owner[taken])
        symbols, owner = symbols[~top], owner[~top]
    if not names:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(names), np.concatenate(owners).astype(np.int64)


def sketches(texts: list[str], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` 16-bit numbers for each text: the least phrase name of each slot, empty slots borrowed."""
    names, owner = phrase_names(texts)
    least = np.full(len(texts) * slots, _EMPTY, U64)
    np.minimum.at(least, owner * slots + (names >> U64(32)).astype(np.int64) % slots, names << U64(32) >> U64(1))
    least = least.reshape(len(texts), slots)
    filled = least.copy()
    for step in range(1, slots):
        if (filled != _EMPTY).all():
            break
        other = np.roll(least, -step, axis=1)
        take = (filled == _EMPTY) & (other != _EMPTY)
        filled[take] = mixed(other[take] + U64(step))
    return (mixed(filled) >> U64(48)).astype("<u2")


def likeness(one: np.ndarray, two: np.ndarray, empty_one: np.ndarray, empty_two: np.ndarray) -> np.ndarray:
    """Share of equal slots; two empty texts are alike, an empty and another are not."""
    same = (one == two).mean(axis=1)
    return np.where(empty_one | empty_two, (empty_one & empty_two).astype(float), same)


def fingerprint(row: np.ndarray, text: str) -> str:
    return row.tobytes().hex() if text else ""


SCHEMA = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def compared(texts: list[str], following: list[str]) -> list[pa.Array]:
    """The result columns of texts, each with the text that follows it."""
    edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following)]
    n = len(texts)
    # What follows is mostly a text of this list itself.
    rows = sketches(texts + edited + following[-1:])
    own, changed = rows[:n], rows[n : 2 * n]
    after = np.concatenate([rows[1:n], rows[2 * n :]])
    blank = np.array([not t for t in texts + following[-1:]], bool)
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array([fingerprint(r, t) for r, t in zip(own, texts)]),
        pa.array([fingerprint(r, t) for r, t in zip(changed, edited)]),
        pa.array(likeness(own, changed, blank[:-1], np.array([not t for t in edited], bool))),
        pa.array(likeness(own, after, blank[:-1], blank[1:])),
    ]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = 1 << 18) -> DataFrame:
    """``(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every row.

    A row is compared with an edited form of its text, whose last half is replaced by as many characters from the next
    row in ascending key order, and with that next row; after the last comes the first. Rows are dealt to parts by
    quantiles of the key and sorted there, in one shuffle; the first row of each part also goes to the part before.
    Texts are parsed ``chunk`` characters at a time.
    Null texts count as empty; an empty text has an empty fingerprint. Null keys come first; rows that repeat a key
    stand side by side, ordered by text. A single row is followed by itself. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = tasks(spark)
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_part", part_of(rows, "_key", parts))
    # One row per part: its first key.
    firsts = sorted((r["_part"], r["k"]["_key"]) for r in rows.groupBy("_part").agg(F.min(F.struct("_key")).alias("k")).collect())
    if not firsts:
        return rows.select(F.col("_key").alias(key), *_empty_columns()).where(F.lit(False))
    opening, before = [None] * parts, [None] * parts
    for (part, first), previous in zip(firsts, [firsts[-1][0]] + [p for p, _ in firsts[:-1]]):
        opening[part], before[part] = first, previous
    at = F.col("_part").cast("int")
    home = F.struct(F.col("_part").alias("part"), F.lit(False).alias("border"))
    guest = F.struct(F.get(_longs(before), at).alias("part"), F.lit(True).alias("border"))
    opens = F.get(_longs(opening), at).eqNullSafe(F.col("_key"))
    places = F.when(opens, F.array(home, guest)).otherwise(F.array(home))
    dealt = rows.select("_key", "_text", F.explode(places).alias("_to")).select("_key", "_text", "_to.part", "_to.border")
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "border", "_key", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held):
            texts = [t for _, t, _, _ in held]
            # A row is complete when the next row of its part is there; a border row only follows.
            full = [i for i in range(len(held) - 1) if not held[i][3] and held[i + 1][2] == held[i][2]]
            if not full:
                return
            columns = compared([texts[i] for i in full], [texts[i + 1] for i in full]) if full == list(range(len(full))) else None
            if columns is None:
                for group in _runs(full):
                    yield batch_of(held, group, compared([texts[i] for i in group], [texts[i + 1] for i in group]))
            else:
                yield batch_of(held, full, columns)

        def batch_of(held, group, columns):
            return pa.RecordBatch.from_arrays([pa.array([held[i][0] for i in group], pa.int64()), *columns], names=["_key", *_NAMES])

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("_key", "_text", "part", "border"))):
                held.append(row)
                size += len(row[1])
                if size >= chunk and len(held) > 1:
                    yield from emit(held)
                    held, size = held[-1:], len(row[1])
        yield from emit(held)

    return ordered.mapInArrow(run, "_key long, " + SCHEMA).withColumnRenamed("_key", key)


def _runs(places: list[int]) -> Iterator[list[int]]:
    """Stretches of consecutive places: where one ends, another part begins."""
    held: list[int] = []
    for place in places:
        if held and place != held[-1] + 1:
            yield held
            held = []
        held.append(place)
    if held:
        yield held


def _longs(values: list) -> F.Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _empty_columns() -> list:
    return [F.lit(None).cast(kind).alias(name) for name, kind in (column.split() for column in SCHEMA.split(", "))]
