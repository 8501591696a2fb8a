"""SuperMinHash near-duplicate groups: signatures, bands, verification on full sets, union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import GOLDEN, U64, Memo, bounded_batches, chunks, hot_join, lists, mixed, text_bytes
from newsloom.operators.components import connected_components
from newsloom.operators.keyed import salted_join
from newsloom.session import discard, materialize, scratch

#: Slots of a signature, a power of two so that odd steps walk through all of them.
SLOTS = 128
#: A pair of likeness 0.85 shares no band of five slots out of 25 with a probability of 4e-7.
BAND = 5
WORDS = 5
PERCENT = 80
#: Heads of a bucket that its members meet in one round, at first and at most; rounds go on until none is left.
FIRST_HEADS, MOST_HEADS = 32, 256
#: A text that is the reference of more members is joined to them in several tasks.
HOT_REFERENCE = 100_000


class Shingler:
    """Hashed word shingles; word hashes are remembered."""

    def __init__(self, words: int):
        self._words = words
        self._hashes = Memo(xxhash.xxh3_64_intdigest)

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text, ASCII capitals as small letters.

        A text of fewer words is one shingle, its whole word sequence; a text without words has none.
        """
        get = self._hashes.__getitem__
        out = []
        for text in texts:
            words = text.lower().split()
            hashes = np.fromiter(map(get, words), U64, len(words))
            width = min(self._words, len(words))
            if not width:
                out.append(hashes)
                continue
            n = len(words) - width + 1
            runs = np.full(n, U64(width))
            for step in range(width):
                runs = mixed(runs * GOLDEN + hashes[step : step + n])
            out.append(np.unique(runs))
        return out


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set, one row of ``slots`` 64-bit numbers.

    An element walks through the slots in an order of its own, an arithmetic walk whose start and odd step come from
    its hash: its rank ``j`` falls into one slot with the value ``j`` and a random fraction, so within an element all
    slots get different ranks. A slot keeps the least value. Ranks are taken one after the other for all elements of
    all sets; a set stops as soon as each of its slots is filled, since later ranks are larger.
    """
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, U64)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    if not len(owner):
        return out
    elements = np.concatenate(sets)
    seed = mixed(elements + GOLDEN)
    start, step = (seed & U64(slots - 1)).astype(np.int64), ((seed >> U64(20)) | U64(1)).astype(np.int64) & (slots - 1)
    flat = out.reshape(-1)
    for rank in range(slots):
        salt = U64(int(GOLDEN) * (rank + 2) % (1 << 64))
        value = (mixed(elements + salt) >> U64(8)) | (U64(rank) << U64(56))
        np.minimum.at(flat, owner * slots + ((start + rank * step) & (slots - 1)), value)
        open_sets = out.max(axis=1) == np.iinfo(np.uint64).max
        going = open_sets[owner]
        if not going.any():
            break
        if not going.all():
            owner, elements, start, step = owner[going], elements[going], start[going], step[going]
    return out


def band_keys(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """One number for each band of each signature."""
    bands = signature.shape[1] // band
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=U64), (len(signature), bands)).copy()
    for i in range(band):
        keys = mixed(keys * GOLDEN + signature[:, i : bands * band : band])
    return keys


SIGNED = "_node long, n_shingles long, _d1 long, _d2 long, _bands array<long>"


def signed_rows(rows: DataFrame, words: int, slots: int, band: int) -> DataFrame:
    """Each row with the size and a 128-bit digest of its set, and its band keys; texts go no further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch, texts in chunks(batches, "_text", 1 << 19):
            sets = shingler.sets(texts)
            keys = band_keys(signatures(sets, slots), band)
            sizes = np.array([len(s) for s in sets])
            d1 = np.array([np.bitwise_xor.reduce(mixed(s)) if len(s) else 0 for s in sets], U64)
            d2 = np.array([np.add.reduce(mixed(s ^ GOLDEN)) if len(s) else 0 for s in sets], U64)
            full = sizes > 0
            offsets = np.concatenate([[0], np.cumsum(np.where(full, keys.shape[1], 0))])
            bands = lists(offsets, pa.array(keys[full].reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_node"), pa.array(sizes, pa.int64()),
                    pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), bands,
                ],
                names=["_node", "n_shingles", "_d1", "_d2", "_bands"],
            )

    return rows.select("_node", "_text").mapInArrow(run, SIGNED)


def full_sets(rows: DataFrame, words: int) -> DataFrame:
    """``(_node, _set)``: the whole hashed sets, made again for the few rows that need one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch, texts in chunks(batches, "_text"):
            sets = shingler.sets(texts)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            values = np.concatenate(sets) if sets else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_node"), lists(offsets, pa.array(values.view(np.int64)))], names=["_node", "_set"]
            )

    return rows.select("_node", "_text").mapInArrow(run, "_node long, _set array<long>")


def _alike(small: Column, large: Column, percent: int) -> Column:
    """Whether sets of these sizes can be alike at all."""
    return F.least(small, large) * 100 >= F.greatest(small, large) * percent


def _order(node: Column) -> Column:
    """A random but fixed order of nodes, the same in every bucket, so that buckets of one group choose the same head."""
    return F.xxhash64(node, F.lit(17))


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets have ``100 * intersection >= percent * union``."""
    one = sets.select(F.col("_node").alias("_a"), F.col("_set").alias("_set_a"))
    two = sets.select(F.col("_node").alias("_b"), F.col("_set").alias("_set_b"))
    both = pairs.join(one, "_a").join(two, "_b")
    shared = F.size(F.array_intersect("_set_a", "_set_b"))
    union = F.size("_set_a") + F.size("_set_b") - shared
    return both.where(shared * 100 >= union * percent).select("_a", "_b")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    slots: int = SLOTS,
    band: int = BAND,
) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` of every row.

    Two documents are linked if their sets of ``words``-word shingles have ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest key that links reach. Rows of equal sets are one class from the start. Candidates
    are classes that share a band of their SuperMinHash; a bucket's members are compared with its head, then, as long
    as a bucket holds members of several components, with more and more heads, each once. Members that have
    too many shingles of their own to be like anyone leave before. So a group of like members costs one pair per
    member, and no candidate pair of different components that could be a link stays unseen: left out are pairs whose
    changes against the head of their bucket are too many to be alike. All links are confirmed
    on whole sets.
    Null, empty and blank texts have no set and are linked with nothing. A row with a null key is linked with nothing:
    its ``component_id`` is null and it is kept. Rows that repeat a key are one document. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("_node"), text_bytes(F.col(text)).alias("_text"))
    with scratch(docs.sparkSession) as keep:
        signed = keep(materialize(signed_rows(rows, words, slots, band), "signed"))
        usable = F.col("_node").isNotNull() & (F.col("n_shingles") > 0)
        classes = signed.where(usable).groupBy("_d1", "_d2", "n_shingles").agg(
            F.min("_node").alias("_node"), F.count(F.lit(1)).alias("_rows"), F.first("_bands").alias("_bands")
        )
        classes = materialize(classes, "classes")
        buckets = classes.select("_node", F.col("n_shingles").alias("_n"), F.explode("_bands").alias("_band"))
        labels = _grouped(buckets, rows, words, percent)
        named = classes.select("_d1", "_d2", "n_shingles", "_rows", "_node")
        if labels is not None:
            named = named.join(labels, "_node", "left").withColumn("_node", F.coalesce("component", "_node")).drop("component")
        named = keep(materialize(named.withColumnRenamed("_node", "_component"), "named"))
    found = hot_join(signed.drop("_bands"), named, ["_d1", "_d2", "n_shingles"], "_rows")
    component = F.when(F.col("_node").isNotNull(), F.coalesce("_component", "_node"))
    return found.select(
        F.col("_node").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("_node"), F.lit(True)).alias("kept"),
    )


def _grouped(buckets: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame | None:
    """``(_node, component)`` of the nodes that have a link; None if there is none."""
    # A bucket of one member leaves at once. Of the rest, a node weighs as much as the buckets it is in: the text that a
    # group's copies were made from is in the largest bucket of every band, and so heads them all.
    sizes = buckets.groupBy("_band").agg(F.min("_node").alias("_least"), F.max("_node").alias("_most"), F.count(F.lit(1)).alias("_rows"))
    open_ = materialize(buckets.join(sizes.where("_least < _most").select("_band", "_rows"), "_band"), "buckets")
    if open_.isEmpty():
        return None
    weights = open_.groupBy("_node").agg(F.sum("_rows").alias("_w"))
    members = materialize(open_.drop("_rows").join(weights, "_node").select("_band", "_node", "_n", "_w"), "members")
    sets = materialize(full_sets(rows.join(weights.select("_node"), "_node", "left_semi"), words).dropDuplicates(["_node"]), "sets")
    discard(open_)

    # First, each member is compared with one head only: the weightiest of its buckets.
    place = F.struct(F.col("_w"), _order(F.col("_node")).alias("o"), F.col("_node").alias("node"), F.col("_n").alias("n"))
    heads = members.groupBy("_band").agg(F.max(place).alias("_head"))
    fitting = members.join(heads, "_band").where(_alike(F.col("_n"), F.col("_head.n"), percent) & (F.col("_head.node") != F.col("_node")))
    first = fitting.groupBy("_node").agg(F.max("_head").alias("_head"))
    pairs = first.select(F.least("_node", "_head.node").alias("_a"), F.greatest("_node", "_head.node").alias("_b")).distinct()
    tested = materialize(pairs, "pairs")
    links = materialize(linked_pairs(tested, sets, percent), "links")
    labels = _components(links)

    refs = materialize(heads.select("_band", F.col("_head.node").alias("_ref")), "references")
    changes = None
    count = FIRST_HEADS
    while True:
        # Buckets that hold more than one component stay, without the members that can have no link there.
        named = _replaced(members, _unsettled(_named(members, labels)))
        if named.isEmpty():
            return labels
        named = _replaced(named, _unsettled(_possible(named, sets, percent)))
        if named.isEmpty():
            return labels
        referred = named.join(refs, "_band")
        if changes is None:
            changes = _changes(referred, sets)
        named = _replaced(named, referred.join(changes, ["_node", "_ref"]))
        # Members of a bucket's small components go first: when they have met all others, one component is left.
        sizes = named.groupBy("_band", "_component").agg(F.count(F.lit(1)).alias("_size"))
        ranked = Window.partitionBy("_band").orderBy("_size", F.desc("_w"), _order(F.col("_node")), "_node")
        heads = named.join(sizes, ["_band", "_component"]).withColumn("_place", F.row_number().over(ranked))
        heads = materialize(heads.where(F.col("_place") <= count), "heads")
        entry = F.struct(*[F.col("_" + c).alias(c) for c in ("node", "n", "common", "component", "lacks", "adds", "shared")])
        lists = heads.groupBy("_band").agg(F.collect_list(entry).alias("_heads"))

        def may_link(head: Column) -> Column:
            common = F.least(F.col("_common"), head["common"])
            bound = common * 100 >= (F.col("_n") + head["n"] - common) * percent
            # What two members change of their bucket's reference, they cannot have changed alike beyond these counts.
            apart = F.abs(F.col("_lacks") - head["lacks"]) + F.col("_adds") + head["adds"] - 2 * F.least(F.col("_shared"), head["shared"])
            near = apart * (100 + percent) <= (F.col("_n") + head["n"]) * (100 - percent)
            return (F.col("_component") != head["component"]) & bound & near

        # The heads of a bucket are a short list, so a member stays one row for each of its bands, and a pair is made once.
        met = named.join(lists, "_band").select("_node", F.transform(F.filter("_heads", may_link), lambda h: h["node"]).alias("_met"))
        met = met.where(F.size("_met") > 0).groupBy("_node").agg(F.array_distinct(F.flatten(F.collect_list("_met"))).alias("_met"))
        met = met.select("_node", F.explode("_met").alias("_head"))
        pairs = met.select(F.least("_node", "_head").alias("_a"), F.greatest("_node", "_head").alias("_b")).distinct()
        pairs = materialize(pairs.join(tested, ["_a", "_b"], "left_anti"), "pairs")
        more = materialize(linked_pairs(pairs, sets, percent), "links")
        if not more.isEmpty():
            links = links.unionByName(more)
            discard(labels)
            labels = _components(links)
        tested = tested.unionByName(pairs)
        # The heads have met all members of their buckets.
        members = named.join(heads.select("_band", "_node"), ["_band", "_node"], "left_anti").select("_band", "_node", "_n", "_w")
        count = min(2 * count, MOST_HEADS)


def _replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """``new``, stored; the tables of ``old``, which nothing else reads, go."""
    stored = materialize(new, "members")
    discard(old)
    return stored


def _unsettled(named: DataFrame) -> DataFrame:
    """The rows of buckets whose members belong to more than one component."""
    bands = named.groupBy("_band").agg(F.min("_component").alias("_x"), F.max("_component").alias("_y")).where("_x < _y")
    return named.join(bands.select("_band"), "_band", "left_semi")


def _possible(named: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The members that may still have a link, with ``_common``: how many shingles of the set are in any other set here.

    A link shares common shingles only, so ``common / (n + m - common)`` bounds the likeness to a set of ``m``; the
    smallest set of the bucket, but no smaller than the common part, gives the largest bound. Copies with many changes of
    their own leave here, without being compared with anyone.
    """
    nodes = named.select("_node").distinct()
    single = sets.join(nodes, "_node", "left_semi").select("_node", F.explode("_set").alias("_shingle")).groupBy("_shingle")
    single = single.agg(F.count(F.lit(1)).alias("_times"), F.min("_node").alias("_node")).where("_times = 1")
    own = single.groupBy("_node").agg(F.count(F.lit(1)).alias("_own"))
    least = named.groupBy("_band").agg(F.min("_n").alias("_smallest"))
    found = named.join(own, "_node", "left").join(least, "_band").withColumn("_common", F.col("_n") - F.coalesce("_own", F.lit(0)))
    union = F.col("_n") + F.greatest("_smallest", "_common") - F.col("_common")
    return found.where(F.col("_common") * 100 >= union * percent).drop("_own", "_smallest")


def _changes(named: DataFrame, sets: DataFrame) -> DataFrame:
    """``(_node, _ref, _lacks, _adds, _shared)``, stored: how a member's set differs from the reference of its bucket.

    ``_lacks`` shingles of the reference are missing, ``_adds`` are new, and ``_shared`` of the new ones are new in another
    member too. Two sets differ by what they lack differently and by what they add differently, so these counts bound
    their difference from below: members with many changes of their own are like none of the others.
    """
    with scratch(named.sparkSession) as keep:
        pairs = materialize(named.select("_node", "_ref").distinct(), "references")
        own = pairs.join(sets, "_node")
        reference = sets.select(F.col("_node").alias("_ref"), F.col("_set").alias("_ref_set"))
        # One text may be the reference of most members.
        both = salted_join(own, reference, ["_ref"], spread=["_node"], hot_from=pairs, hot_rows=HOT_REFERENCE)
        found = both.select(
            "_node", "_ref", F.size(F.array_except("_ref_set", "_set")).alias("_lacks"), F.array_except("_set", "_ref_set").alias("_new")
        )
        found = materialize(found, "changes")
        single = found.select("_node", "_ref", F.explode("_new").alias("_shingle")).groupBy("_ref", "_shingle")
        single = single.agg(F.count(F.lit(1)).alias("_times"), F.min("_node").alias("_node")).where("_times = 1")
        alone = single.groupBy("_node", "_ref").agg(F.count(F.lit(1)).alias("_alone"))
        counted = found.select("_node", "_ref", "_lacks", F.size("_new").alias("_adds")).join(alone, ["_node", "_ref"], "left")
        shared = F.col("_adds") - F.coalesce("_alone", F.lit(0))
        return keep(materialize(counted.select("_node", "_ref", "_lacks", "_adds", shared.alias("_shared")), "changes"))


def _components(links: DataFrame) -> DataFrame:
    with scratch(links.sparkSession) as keep:
        found = connected_components(links.select(F.col("_a").alias("src"), F.col("_b").alias("dst")))
        return keep(materialize(found.select(F.col("node").alias("_node"), "component"), "labels"))


def _named(members: DataFrame, labels: DataFrame) -> DataFrame:
    found = members.drop("_component").join(labels, "_node", "left")
    return found.select("_band", "_node", "_n", "_w", F.coalesce("component", "_node").alias("_component"))
