"""Prediction by partial matching over bytes: a pretrained context trie gives the code length of every document."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import U64, bounded_batches, chunks, keyed_schema, lists, text_bytes, wide_batches
from newsloom.session import materialize

#: Longest context, in bytes. A context and its next byte fit into one 64-bit number.
ORDER = 6
#: The most used grams are broadcast, at most 2**GRAM_BITS of them.
GRAM_BITS = 22
#: Grams that are worked out together; a context with more of them is split by its next byte.
PART_ROWS = 1 << 19
#: The most used words are broadcast, at most 2**WORD_BITS of them.
WORD_BITS = 18
#: Stands before and behind a text; UTF-8 has no such byte.
EDGE = 255


def grams_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, starts)``: each symbol with the ``order`` bytes before it, for all texts and the end of each.

    A key holds the symbol in its lowest byte and the nearest byte of the context in its highest, so grams with the same last bytes
    of context lie together. ``starts`` says where a text's keys begin.
    """
    edge = bytes([EDGE]) * order
    data = edge + edge.join(texts) + edge
    lengths = np.array([len(t) for t in texts])
    n = len(data) - order
    # The eight bytes from each place on as one number, the first byte lowest.
    eight = np.ndarray(n, "<u8", data + bytes(8), strides=(1,))
    keys = ((eight & U64((1 << (8 * order)) - 1)) << U64(8)) | np.frombuffer(data, np.uint8)[order:]
    # One edge follows a text as its end; the other edges only open the next text.
    ends = np.cumsum(lengths + order)
    keep = np.zeros(n + 1, np.int32)
    np.add.at(keep, ends - lengths - order, 1)
    np.add.at(keep, np.minimum(ends - order + 1, n), -1)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    return keys[np.cumsum(keep[:-1]) > 0], starts


def count_grams(rows: DataFrame, order: int) -> DataFrame:
    """``(key, n, uses)``: how often each symbol follows each context of ``order`` bytes, in training rows and in all rows.

    Occurrences are added up inside each task first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The lowest bit of a mark says that it is of training rows.
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = symbols = 0

        def added(values: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
            first = np.concatenate([[True], values[1:] != values[:-1]])
            return [values[first], *[np.add.reduceat(c, np.flatnonzero(first)) for c in counts]]

        def merged() -> list[np.ndarray]:
            marks = np.concatenate([m for m, _ in held])
            by = np.argsort(marks, kind="stable")
            return added(marks[by], np.concatenate([c for _, c in held])[by])

        def batch_of(marks: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            keys, n, uses = added(marks >> U64(1), np.where(marks & U64(1), counts, 0), counts)
            both = (uses << 32) | n
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(both)], names=["key", "both"])

        # A model that this worker has scored with is not needed while it counts.
        _models.clear()
        for batch, texts in chunks(batches, "_text"):
            keys, starts = grams_of([t.lower() for t in texts], order)
            learns = ~batch.column("_held").to_numpy(zero_copy_only=False).astype(bool)
            marks = (keys << U64(1)) | np.repeat(learns, np.diff(starts)).astype(U64)
            marks, counts = np.unique(marks, return_counts=True)
            held.append((marks, counts.astype(np.int64)))
            size += len(marks)
            symbols += len(keys)
            # Two counts below 2**31 share a number.
            if size > 4_000_000 or symbols > 1 << 30:
                one = merged()
                if len(one[0]) > 2_000_000 or symbols > 1 << 30:
                    yield batch_of(*one)
                    held, size, symbols = [], 0, 0
                else:
                    held, size = [tuple(one)], len(one[0])
        if held:
            yield batch_of(*merged())

    partial = rows.select("_held", "_text").mapInArrow(run, "key long, both long")
    n, uses = F.col("both").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright("both", 32)
    # A task has a key about once, so Spark need not add up before the shuffle.
    return partial.repartition("key").groupBy("key").agg(F.sum(n).alias("n"), F.sum(uses).alias("uses"))


def count_words(rows: DataFrame) -> DataFrame:
    """``(word, c)``: tokens of the training texts; the empty word is the end of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _models.clear()
        counts: Counter = Counter()
        schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

        def flush():
            return pa.RecordBatch.from_pydict({"word": list(counts.keys()), "c": list(counts.values())}, schema=schema)

        for _, texts in chunks(batches, "_text"):
            for text in texts:
                counts.update(text.lower().split())
            counts[b""] += len(texts)
            if len(counts) > 300_000:
                yield flush()
                counts.clear()
        if counts:
            yield flush()

    return rows.select("_text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _context(keys, depth: int, order: int):
    """The ``depth`` bytes before the symbol of each key, as a number."""
    return keys >> U64(8 * (order + 1 - depth))


def split_contexts(grams: DataFrame, order: int, part_rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth from 0: ``(node, n)`` of the contexts that too many grams share, sorted; a node is a context and its symbol.

    A context with more than ``part_rows`` grams is split by its next byte, so each depth has at most one of them for every
    ``part_rows`` grams, with 256 symbols at most. Contexts of depth ``order`` are never split.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    inside = grams.select("key", "n") if grams.count() > part_rows else None
    while inside is not None and len(found) < order:
        depth = len(found)
        context = F.shiftright("key", 8 * (order + 1 - depth))
        nodes = inside.groupBy((F.shiftleft(context, 8) + F.col("key").bitwiseAND(F.lit(255))).alias("node")).agg(F.sum("n").alias("n"))
        table = nodes.orderBy("node").toArrow()
        found.append((table["node"].to_numpy().astype(U64), table["n"].to_numpy().astype(np.float64)))
        longer = F.shiftright("key", 8 * (order - depth))
        sizes = inside.groupBy(longer.alias("context")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > part_rows)
        hot = [r["context"] for r in sizes.select("context").collect()]
        inside = inside.where(longer.isin(hot)) if hot else None
    return found


def _part_depths(keys: np.ndarray, split: list[tuple[np.ndarray, np.ndarray]], order: int) -> np.ndarray:
    """How many bytes of context make up the part of each key: the first context that is not split."""
    depths = np.zeros(len(keys), np.int64)
    for depth, (nodes, _) in enumerate(split):
        inside = np.isin(_context(keys, depth, order), np.unique(nodes >> U64(8))) & (depths == depth)
        depths[inside] = depth + 1
    return depths


def _node_figures(nodes: np.ndarray, counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Per sorted node: its count, and of its context the total, the kinds, and what its symbols count at the next shorter one."""
    context = nodes >> U64(8)
    first = np.concatenate([[True], context[1:] != context[:-1]])
    starts, of = np.flatnonzero(first), np.cumsum(first) - 1
    seen = counts > 0
    sums = [np.add.reduceat(column, starts)[of] for column in (counts, seen.astype(np.float64), np.where(seen, shorter, 0.0))]
    return np.stack([counts, *sums])


def gram_logs(keys: np.ndarray, n: np.ndarray, split: list[tuple[np.ndarray, np.ndarray]], depth: int, order: int) -> np.ndarray:
    """The logarithms of the probabilities of sorted grams that hold whole parts of ``depth`` bytes.

    Counts of shorter contexts come from ``split``. Up the depths, ``value`` is that of a gram whose longer contexts are unknown
    and ``after`` that of one which has escaped from the context of this depth.
    """
    symbols = keys & U64(255)
    value = after = before = None
    for at in range(order + 1):
        node = (_context(keys, at, order) << U64(8)) | symbols
        if at < depth:
            nodes, counts = split[at]
            shorter = np.zeros(len(nodes))
            if at:
                above, sums = split[at - 1]
                shorter = sums[np.searchsorted(above, ((nodes >> U64(16)) << U64(8)) | (nodes & U64(255)))]
            where = np.searchsorted(nodes, node)
        else:
            nodes, index, where = np.unique(node, return_index=True, return_inverse=True)
            counts = np.bincount(where, weights=n, minlength=len(nodes))
            shorter = before[0][index] if at else np.zeros(len(nodes))
        count, total, kinds, excluded = _node_figures(nodes, counts, shorter)[:, where]
        with np.errstate(divide="ignore", invalid="ignore"):
            if at:
                b_count, b_total, b_kinds = before
                left = b_total - excluded
                escaped = np.where(left > 0, np.log((b_kinds - kinds) / 2 / left), 0.0)
                after = np.where(b_count > 0, np.log(b_count - 0.5) - np.log(left), escaped + after)
            else:
                after = value = -np.log(256 - kinds)
            missed = np.where(total > 0, np.log(kinds / 2 / total) + after, value)
            value = np.where(count > 0, np.log((count - 0.5) / total), missed)
        before = count, total, kinds
    return value


def log_probabilities(grams: DataFrame, order: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``(key, uses, value)``: the logarithm of the probability of each gram of the stored ``(key, n, uses)``.

    A gram holds all that its probability depends on, so each distinct one is worked out once. Grams are dealt by the last bytes of
    their context, as many bytes as keep a part below ``part_rows``, so a task sees all longer contexts of its parts; the
    counts of the few shorter ones are broadcast. All depths are worked out there at once. A symbol weighs its count
    less one half; each kind of symbol gives its half to the escape. Every counted node takes part. An empty corpus gives a
    trie without nodes.
    """
    spark = grams.sparkSession
    split = split_contexts(grams, order, part_rows)
    shared = spark.sparkContext.broadcast(split)
    part = F.lit(None).cast("long")
    for depth in range(len(split), -1, -1):
        bits = 8 * (order + 1 - depth)
        context = F.shiftright("key", bits)
        here = F.shiftleft(context, bits)
        if depth < len(split):
            part = F.when(context.isin([int(c) for c in np.unique(split[depth][0] >> U64(8))]), part).otherwise(here)
        else:
            part = here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _models.clear()
        split = shared.value
        held, size, limit = [], 0, part_rows

        def valued(rows: list[np.ndarray]) -> pa.RecordBatch:
            keys, n, uses = rows
            depths, values = _part_depths(keys, split, order), np.zeros(len(keys), np.float32)
            for depth in np.unique(depths):
                at = depths == depth
                values[at] = gram_logs(keys[at], n[at], split, depth, order)
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(uses), pa.array(values)], names=["key", "uses", "value"])

        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("key", "n", "uses")])
            size += batch.num_rows
            if size > limit:
                rows = [np.concatenate(c) for c in zip(*held)]
                rows[0] = rows[0].astype(U64)
                # The last part may go on in the next batch.
                last = _part_depths(rows[0][-1:], split, order)[0]
                context = _context(rows[0], last, order)
                cut = int(np.searchsorted(context, context[-1]))
                if cut:
                    yield valued([c[:cut] for c in rows])
                held, size = [[c[cut:] for c in rows]], len(rows[0]) - cut
                limit = size + part_rows
        if size:
            rows = [np.concatenate(c) for c in zip(*held)]
            yield valued([rows[0].astype(U64), *rows[1:]])

    dealt = grams.withColumn("_part", part).repartition("_part").sortWithinPartitions("key").select("key", "n", "uses")
    with wide_batches(spark):
        return materialize(dealt.mapInArrow(run, "key long, uses long, value float"), "values")


def _size(uses: Column) -> Column:
    """Sixteen sizes for every doubling, so there are less than 1,024 of them."""
    return F.floor(F.log2(uses) * 16)


def _least_size(rows: DataFrame, uses: str, most: int) -> int:
    """The least size from which on there are at most ``most`` rows."""
    sizes = rows.groupBy(_size(F.col(uses)).alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()
    least = 1 << 20
    for row in sizes:
        most -= row["n"]
        if most < 0:
            break
        least = row["size"]
    return least


class Lookup:
    """Values of 64-bit keys by open addressing; at most half of the slots is taken."""

    #: No gram is this number.
    NONE = U64((1 << 64) - 1)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (2 * len(keys) - 1).bit_length())
        self._shift, self._mask = U64(64 - bits), (1 << bits) - 1
        place = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = place[slot] < 0
            place[slot[free]] = left[free]
            taken = place[slot] == left
            left, slot = left[~taken], (slot[~taken] + 1) & self._mask
        used = place >= 0
        self._keys, self._values = np.full(1 << bits, self.NONE), np.zeros(1 << bits, values.dtype)
        self._keys[used], self._values[used] = keys[place[used]], values[place[used]]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(hit, value)``: whether each key is there, and its value or 0."""
        slot = self._slot(keys)
        found = self._keys[slot]
        hit = found == keys
        on = np.flatnonzero(~hit & (found != self.NONE))
        while len(on):
            slot[on] = (slot[on] + 1) & self._mask
            found = self._keys[slot[on]]
            hit[on] = found == keys[on]
            on = on[(found != keys[on]) & (found != self.NONE)]
        return hit, np.where(hit, self._values[slot], 0)


class Model:
    """The logarithms of the most used grams."""

    def __init__(self, arrays: dict, order: int):
        self._lookup, self._order = Lookup(arrays["keys"], arrays["values"]), order

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
        """The sum over the most used grams of each text with its end, and the list of its other grams."""
        keys, starts = grams_of(texts, self._order)
        hit, logs = self._lookup.find(keys)
        others = np.concatenate([[0], np.cumsum(~hit)])[starts]
        sums = np.add.reduceat(logs.astype(np.float64), starts[:-1])
        return sums, lists(others, pa.array(keys[~hit].astype(np.int64)))


_models: dict = {}


def _prepared(shared) -> tuple[Model, dict]:
    """The model of a broadcast, its tables built once in each worker."""
    arrays, words, order = shared.value
    if arrays["id"] not in _models:
        _models.clear()
        known = {w: math.log10(c + 1) for w, c in zip(words["word"], words["c"])}
        _models[arrays["id"]] = (Model(arrays, order), known)
    return _models[arrays["id"]]


def score_documents(
    docs: DataFrame,
    learns: Column,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    word_bits: int = WORD_BITS,
    gram_bits: int = GRAM_BITS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    ``learns`` says which rows the model is trained on; all rows are scored. Training counts every text in full: each
    task adds up its contexts and words, Spark adds up the tasks. The trie keeps every counted node, whatever the corpus holds. The
    logarithms of the most used grams (``gram_bits``) and the most used words (``word_bits``) are broadcast, which bounds what
    each worker holds; other grams and words of a text are looked up by joins. ``base_score`` is the word model with
    one added to each count.
    Null and empty texts hold only their end; null and repeated keys are rows like others; with nothing to learn from,
    every byte is equally likely. Other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(key).alias("_key"), (~learns).alias("_held"), text_bytes(F.col(text)).alias("_text"))
    training = rows.where(~F.col("_held"))
    values = log_probabilities(materialize(count_grams(rows, order), "grams"), order, part_rows)
    common = F.col("_size") >= F.lit(_least_size(values, "uses", 1 << gram_bits))
    values = values.withColumn("_size", _size(F.col("uses")))
    top = values.where(common).select("key", "value").toArrow()
    arrays = {"id": uuid.uuid4().hex, "keys": top["key"].to_numpy().astype(U64), "values": top["value"].to_numpy()}
    counts = materialize(count_words(training), "words")
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = sums["n"] or 0, sums["v"]
    frequent = _size(F.col("c")) >= F.lit(_least_size(counts, "c", 1 << word_bits))
    words = counts.where(frequent).toArrow().to_pydict()
    shared = spark.sparkContext.broadcast((arrays, words, order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = _prepared(shared)
        schema = pa.schema(
            [("_row_tokens", pa.int64()), ("_found", pa.int64()), ("_logs", pa.float64())]
            + [("_rare", pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())])))]
        )
        names = ["_key", "_held", *schema.names, "_score", "_grams"]
        for batch, texts in chunks(batches, "_text", 1 << 19):
            texts = [t.lower() for t in texts]
            out = {name: [] for name in schema.names}
            for t in texts:
                tokens = t.split()
                tokens.append(b"")
                logs = [known[w] for w in tokens if w in known]
                out["_row_tokens"].append(len(tokens))
                out["_found"].append(len(logs))
                out["_logs"].append(sum(logs))
                rare = Counter(w for w in tokens if w not in known) if len(logs) < len(tokens) else {}
                out["_rare"].append([{"word": w, "times": c} for w, c in rare.items()])
            found = pa.RecordBatch.from_pydict(out, schema=schema)
            sums, grams = model.score(texts)
            columns = [batch.column("_key"), batch.column("_held"), *found.columns, pa.array(sums), grams]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    columns = "_held boolean, _row_tokens long, _found long, _logs double, _rare array<struct<word: binary, times: bigint>>"
    columns += ", _score double, _grams array<bigint>"
    schema = keyed_schema(rows, columns)
    scored = materialize(rows.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("_row", F.explode("_rare").alias("r")).select("_row", "r.word", "r.times")
    known = rare.join(counts.where(~frequent), "word").groupBy("_row")
    known = known.agg(F.sum("times").alias("_more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("_more_logs"))
    base = F.col("_logs") + F.coalesce("_more_logs", F.lit(0.0)) - F.col("_row_tokens") * F.lit(math.log10(n + v + 1))
    others = scored.select("_row", F.explode("_grams").alias("key"))
    others = others.join(values.where(~common).select("key", "value").hint("shuffle_hash"), "key").groupBy("_row")
    others = others.agg(F.sum("value").alias("_more_score"))
    score = (F.col("_score") + F.coalesce("_more_score", F.lit(0.0))) / F.lit(math.log(10))
    return scored.join(known, "_row", "left").join(others, "_row", "left").select(
        F.col("_key").alias(key),
        F.col("_held").alias("held_out"),
        F.col("_row_tokens").alias("n_tokens"),
        (F.col("_found") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
    )
