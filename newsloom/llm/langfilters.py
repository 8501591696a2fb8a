"""Language identification by bit-sliced Bloom filters of n-grams: one look-up tells all languages that hold an n-gram."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import GOLDEN, U64, bounded_batches, keyed_schema, mixed
from newsloom.session import materialize

#: Letters and blanks of one n-gram; of scripts of many letters (those from WIDE on) one letter makes one.
GRAM, WIDE_GRAM, WIDE = 4, 1, 0x2E80
#: A language holds the n-grams that most of its texts hold, as many as make up this share of all of theirs, at any size.
MASS = 0.95
#: Rows of the filter per n-gram of the largest language, and rows that each n-gram sets.
ROWS_PER_GRAM, PROBES = 16, 3
UNKNOWN = "und"
_BLANK = 32


def _folding() -> np.ndarray:
    """For each code point the small letter, or a blank if it is no letter."""
    table = np.full(0x110000, _BLANK, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            table[point] = ord(letter.lower()[0])
    return table


_fold: list[np.ndarray] = []


def grams_of(texts: list[str], size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """``(grams, owner)``: hashed n-grams of each text's letters, words apart by one blank, blanks around the text."""
    if not _fold:
        _fold.append(_folding())
    # A text is one blank, its letters, and as many blanks as give a single letter one n-gram.
    tail = size - 2
    lengths = np.array([len(t) for t in texts])
    joined = " " + (" " * (tail + 1)).join(texts) + " " * tail
    letters = _fold[0][np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")]
    owner = np.repeat(np.arange(len(texts)), lengths + 1 + tail)
    ends = np.cumsum(lengths + 1 + tail)
    # Blanks inside a text shrink to one; those at its borders stay.
    keep = letters != _BLANK
    keep[1:] |= letters[:-1] != _BLANK
    inner = np.zeros(len(letters), bool)
    inner[ends - lengths - 1 - tail] = True
    for back in range(1, tail + 1):
        inner[ends - back] = True
    keep |= inner
    letters, owner = letters[keep], owner[keep]
    n = len(letters) - size + 1
    grams, some = np.zeros(n, U64), np.zeros(n, bool)
    wide = letters[:n] >= WIDE
    for i in range(size):
        part = letters[i : i + n]
        if i >= WIDE_GRAM:
            part = np.where(wide, 0, part)
        grams = grams * GOLDEN + part
        some |= part != _BLANK
    valid = some & (owner[:n] == owner[size - 1 :])
    return mixed(grams[valid]), owner[:n][valid]


def count_grams(rows: DataFrame, size: int) -> DataFrame:
    """``(lang, gram, n)``: how many training texts hold an n-gram, added up inside each task first.

    A text counts an n-gram once, so a long text of few words does not outweigh the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        total = 0

        def merged(parts):
            keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
            by = np.argsort(keys)
            keys, counts = keys[by], counts[by]
            first = np.concatenate([[True], keys[1:] != keys[:-1]])
            return keys[first], np.add.reduceat(counts, np.flatnonzero(first))

        def batch_of(lang, keys, counts):
            langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(keys), np.int32)), pa.array([lang])).cast(pa.string())
            return pa.RecordBatch.from_arrays([langs, pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])

        for texts, langs in _text_chunks(batches, "lang", 1 << 20):
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(texts, langs):
                by_lang.setdefault(lang, []).append(text)
            for lang, some in by_lang.items():
                grams, owner = grams_of(some, size)
                by = np.lexsort((grams, owner))
                grams, owner = grams[by], owner[by]
                once = np.ones(len(grams), bool)
                once[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
                keys, counts = np.unique(grams[once], return_counts=True)
                if len(keys):
                    held.setdefault(lang, []).append((keys, counts.astype(np.int64)))
                    total += len(keys)
            if total > 3_000_000:
                held = {lang: [merged(parts)] for lang, parts in held.items()}
                total = sum(len(parts[0][0]) for parts in held.values())
                if total > 1_500_000:
                    for lang, parts in held.items():
                        yield batch_of(lang, *parts[0])
                    held, total = {}, 0
        for lang, parts in held.items():
            yield batch_of(lang, *merged(parts))

    counted = rows.select("lang", "_text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _text_chunks(batches: Iterator[pa.RecordBatch], other: str, size: int) -> Iterator[tuple[list[str], list]]:
    for batch in batches:
        texts, others = batch.column("_text").to_pylist(), batch.column(other).to_pylist()
        start = held = 0
        for at, text in enumerate(texts):
            if held and held + len(text) > size:
                yield texts[start:at], others[start:at]
                start, held = at, 0
            held += len(text) + 1
        if start < len(texts):
            yield texts[start:], others[start:]


class Filters:
    """All languages in one filter: row ``r`` has bit ``l`` if an n-gram of language ``l`` sets row ``r``."""

    def __init__(self, langs: list[str], grams: list[np.ndarray]):
        self.id = uuid.uuid4().hex
        self.langs = langs
        most = max([len(g) for g in grams], default=0)
        self.bits = max(10, (ROWS_PER_GRAM * most).bit_length())
        self.rows = np.zeros((-(-max(1, len(langs)) // 64), 1 << self.bits), U64)
        for at, found in enumerate(grams):
            for slot in self._slots(found):
                self.rows[at // 64, slot] |= U64(1 << (at % 64))
        filled = [((self.rows[at // 64] >> U64(at % 64)) & U64(1)).mean() for at in range(len(langs))]
        #: How often an n-gram that a language does not hold passes for one.
        self.false = np.array(filled) ** PROBES

    def _slots(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        step = mixed(grams) | U64(1)
        for probe in range(PROBES):
            yield ((grams + U64(probe) * step) >> U64(64 - self.bits)).astype(np.int64)

    def rates(self, texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
        """``(rates, letters)``: for each text and language the share of n-grams it holds, corrected for false ones."""
        grams, owner = grams_of(texts, size)
        n = np.bincount(owner, minlength=len(texts))
        slots = list(self._slots(grams))
        out = np.zeros((len(texts), len(self.langs)))
        for word, rows in enumerate(self.rows):
            masks = rows[slots[0]]
            for slot in slots[1:]:
                masks &= rows[slot]
            for bit in range(min(64, len(self.langs) - 64 * word)):
                held = owner[(masks & U64(1 << bit)) != 0]
                out[:, 64 * word + bit] = np.bincount(held, minlength=len(texts))
        rates = out / np.maximum(n, 1)[:, None]
        return np.clip((rates - self.false) / np.maximum(1 - self.false, 1e-9), 0, 1), n > 0


def train(rows: DataFrame, size: int = GRAM, mass: float = MASS) -> Filters:
    """Filters from all rows ``(lang, _text)``; what reaches the driver are the n-grams that make up ``mass`` of a language.

    They are found by a count that an n-gram must have, from a histogram of the counts; ties are all kept. Their number
    is bounded by the letters of a script, not by the corpus.
    """
    counts = materialize(count_grams(rows, size), "grams")
    histogram = counts.groupBy("lang", "n").agg(F.sum("n").alias("held"))
    # One row for each language and distinct count.
    above = Window.partitionBy("lang").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("held").over(above), F.lit(0))
    needed = histogram.select("lang", "n", (before < F.lit(mass) * F.sum("held").over(Window.partitionBy("lang"))).alias("needed"))
    least = needed.where("needed").groupBy("lang").agg(F.min("n").alias("least"))
    found = counts.join(F.broadcast(least), "lang").where("n >= least").select("lang", "gram").toArrow()
    names, grams = np.array(found["lang"].to_pylist(), object), found["gram"].to_numpy().view(U64)
    langs = sorted(set(names))
    return Filters(langs, [np.sort(grams[names == lang]) for lang in langs])


def predict(
    docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", size: int = GRAM, mass: float = MASS
) -> DataFrame:
    """``(key, held_out, lang_pred, score)`` of every row.

    Filters are learned from the text and language of the rows that ``learns`` marks and whose language is not null;
    predictions read the text only. The language with the highest corrected share of n-grams wins, the first by name in
    a tie; ``score`` is that share. A text that is null or has no letter, and any text if nothing was learned, is
    ``und`` with score 0. Null and repeated keys are rows like others; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit("")).alias("_text")
    training = docs.where(learns & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), whole)
    shared = docs.sparkSession.sparkContext.broadcast(train(training, size, mass))
    rows = docs.select(F.col(key).alias("_key"), (~learns).alias("held_out"), whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for batch in batches:
            langs, scores = [], []
            for texts, _ in _text_chunks(iter([batch]), "held_out", 1 << 18):
                rates, letters = filters.rates(texts, size)
                if not filters.langs:
                    rates = np.zeros((len(texts), 1))
                best = rates.argmax(axis=1)
                known = letters & bool(filters.langs)
                langs += [filters.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
                scores.append(np.where(known, rates[np.arange(len(texts)), best], 0.0))
            columns = [batch.column("_key"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "held_out", "lang_pred", "score"])

    schema = keyed_schema(rows, "held_out boolean, lang_pred string, score double")
    return rows.mapInArrow(run, schema).withColumnRenamed("_key", key)
