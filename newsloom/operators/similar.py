"""Which token sets of one group are near copies: a complete similarity join by prefixes of rare tokens.

Two sets of likeness t or more share a token among the rarest ``n - ceil(t * n) + 1`` of either, so only these tokens
are indexed. Sets that meet under a token are compared in full. No pair of that likeness is missed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.components import connected_components, star_edges
from newsloom.operators.keyed import HOT_ROWS, MAX_HOT_KEYS, salted_join
from newsloom.operators.tokens import COUNTED, DEALT, HELD, LISTED, UNPACKED, batch_rows, count, deal, listed, packed_numbers, run_numbers, unpacked
from newsloom.session import materialize

# A token with more members than this is split by a second token; up to this many, members meet in pairs.
SMALL = 32
# Members of a larger bucket that meet all others at a time, at most.
MOST_HEADS = 1_024


def shingles(text: Column, width: int = 3) -> Column:
    """The distinct runs of ``width`` lower-case words as 64-bit numbers, sorted and packed in one binary value.

    A shorter text is one run, an empty one has none. Equal runs have equal numbers.
    """
    return run_numbers(F.lower(text), width)


def hashed_sets(rows: DataFrame, group: Sequence[str], node: str, tokens: str) -> DataFrame:
    """``(group, node, doc, digest, n, set)``, stored: packed 64-bit tokens in order, and a digest equal for equal sets only.

    ``doc`` is a number of the row. Tokens come packed, as from `shingles`, or as an array of strings.
    Rows without tokens are stored too. A filter on tokens in this plan would work all of them out once more, before any
    shuffle of the rows, and a second plan over ``rows`` once again.
    """
    packed = rows.schema[tokens].dataType == T.BinaryType()
    sets = F.col(tokens) if packed else packed_numbers(F.array_sort(F.transform(tokens, lambda t: F.xxhash64(t))))
    hashed = rows.select(*group, F.col(node).alias("node"), F.monotonically_increasing_id().alias("doc"), sets.alias("set"))
    size = (F.octet_length("set") / 8).cast("int")
    with batch_rows(rows.sparkSession):
        return materialize(hashed.select(*group, "node", "doc", F.md5("set").alias("digest"), size.alias("n"), "set"), "sets")


def shared_tokens(stored: DataFrame, units: DataFrame, group: Sequence[str], threshold: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(group, node, n, shared, need)``, stored: tokens that other sets hold too, rarest first, of the sets of ``units``.

    A token of one set alone takes a place of its prefix but links nothing, so the first ``need`` shared tokens are
    what remains of the prefix. Sets without any leave here: they are like no other.

    Tokens are dealt by ranges of their numbers, counted, and those of several sets dealt back by set, many in one row.
    Tokens of a great many sets are known before (a list from some of the sets) and come last without being counted, so
    that no task holds them all; the order of the others is by count, and it is one order for all sets.
    """
    group = list(group)
    total = units.agg(F.count(F.lit(1)).alias("sets"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    buckets = total["tokens"] // HELD + 1
    # Sets of one block have about as many tokens as a task holds at a time.
    block_bits = max(HELD * total["sets"] // max(total["tokens"], 1), 1).bit_length() - 1
    # The shorter list of copies and of sets that stay is the one looked up; the sets stay where they are when it is small.
    full, stay = stored.where("n > 0"), units.select("doc")
    copies = materialize(full.select("doc").join(stay, "doc", "left_anti"), "copies")
    few = copies.count() <= total["sets"]
    sets = full.join(copies, "doc", "left_anti") if few else full.join(materialize(stay, "docs"), "doc", "left_semi")
    sets = sets.select("doc", (F.xxhash64(*group) if group else F.lit(0).cast("bigint")).alias("g"), "set")
    hot = []
    if total["sets"] >= hot_rows:
        share = max(hot_rows // 1_000, 1)
        some = sets.where(F.pmod(F.xxhash64("doc"), F.lit(share)) == 0).select("g", "set").mapInArrow(unpacked, UNPACKED)
        often = some.groupBy("g", "t").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= max(hot_rows // share, 2))
        hot = [(r["g"], r["t"]) for r in often.orderBy(F.desc("f"), "g", "t").limit(MAX_HOT_KEYS).collect()]
    parts = min(buckets, 10_000)
    dealt = sets.mapInArrow(deal(buckets, hot), DEALT).repartition(parts, "bucket").sortWithinPartitions("bucket")
    counted = dealt.mapInArrow(count(buckets, block_bits), COUNTED).repartition(parts, "block").sortWithinPartitions("block")
    # A row of the set has one number, so this join has no hot keys.
    named = counted.mapInArrow(listed(threshold), LISTED).join(units.select("doc", *group, "node"), "doc")
    with batch_rows(stored.sparkSession):
        return materialize(named.select(*group, "node", "n", "shared", "need"), "shared")


def similar_pairs(pairs: DataFrame, sets: DataFrame, group: Sequence[str], threshold: float, **join) -> DataFrame:
    """The pairs ``(group, src, dst)`` whose Jaccard similarity over the whole sets is at least ``threshold``, stored."""
    group = list(group)
    pairs = stored = materialize(pairs, "pairs")
    for end, other in (("src", "dst"), ("dst", "src")):
        side = sets.select(*group, F.col("node").alias(end), F.col("n").alias(f"_n_{end}"), F.col("shared").alias(f"_{end}"))
        pairs = salted_join(pairs, side, [*group, end], spread=[other], hot_from=stored, **join)
    # Tokens of one set alone are in no intersection, so the shared ones are enough for it.
    both = F.size(F.array_intersect("_src", "_dst"))
    jaccard = both / (F.col("_n_src") + F.col("_n_dst") - both)
    return materialize(pairs.where(jaccard >= threshold).select(*group, "src", "dst"), "links")


def _joined(labels: DataFrame, links: DataFrame, group: list[str], **join) -> DataFrame:
    """The components with those that further links bring together; only the ends of the links are worked on."""
    ends = links
    for end in ("src", "dst"):
        of = labels.select(*group, F.col("node").alias(end), F.col("component").alias("_of"))
        ends = ends.join(of, [*group, end], "left").withColumn(end, F.coalesce("_of", end)).drop("_of")
    moved = materialize(connected_components(ends, group, **join), "moved")
    to = moved.select(*group, F.col("node").alias("component"), F.col("component").alias("_to"))
    known = labels.join(to, [*group, "component"], "left").select(*group, "node", F.coalesce("_to", "component").alias("component"))
    fresh = moved.join(labels.select(*group, "node"), [*group, "node"], "left_anti")
    return materialize(known.unionByName(fresh), "labels")


def _labelled(members: DataFrame, labels: DataFrame, group: list[str]) -> DataFrame:
    """The members with the component that the links found so far put them in."""
    found = members.drop("label").join(labels, [*group, "node"], "left")
    return found.withColumn("label", F.coalesce("component", "node")).drop("component")


def _open(members: DataFrame, bucket: list[str], **join) -> DataFrame:
    """Members of buckets that hold more than one component, with the number of members, stored."""
    members = materialize(members, "members")
    sizes = members.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("_a"), F.max("label").alias("_b"))
    sizes = materialize(sizes.where("_a < _b").drop("_a", "_b"), "open")
    hot = sizes.where(F.col("size") >= join.get("hot_rows", HOT_ROWS)).orderBy(F.desc("size")).limit(MAX_HOT_KEYS)
    return materialize(salted_join(members, sizes, bucket, spread=["node"], hot=hot, **join), "members")


def _near(pairs: DataFrame, group: list[str], threshold: float) -> DataFrame:
    """Pairs of different components whose sizes allow the likeness, each once."""
    sizes = F.least("src.n", "dst.n") >= F.greatest("src.n", "dst.n") * F.lit(threshold) - F.lit(1e-9)
    pairs = pairs.where((F.col("src.label") != F.col("dst.label")) & sizes)
    ends = F.least("src.node", "dst.node").alias("src"), F.greatest("src.node", "dst.node").alias("dst")
    return pairs.select(*group, *ends).distinct()


def _within(members: DataFrame, bucket: list[str], group: list[str], threshold: float) -> DataFrame:
    """All pairs inside buckets of at most ``SMALL`` members: at most half of ``SMALL`` for each member."""
    listed = members.groupBy(*bucket).agg(F.collect_list(F.struct("node", "n", "label")).alias("m"))
    one = listed.select(*group, "m", F.posexplode("m").alias("i", "src"))
    two = one.select(*group, "src", F.explode(F.slice("m", F.col("i") + 2, F.lit(SMALL))).alias("dst"))
    return _near(two, group, threshold)


def complete_labels(sets: DataFrame, group: Sequence[str], threshold: float, **join) -> DataFrame:
    """``(group, node, component)`` of all sets that are like another; components are those of all like pairs.

    Members of a token are first compared with its first and last member, which joins near copies at once. Pairs are
    left only where a token still holds several components: all of them under up to ``SMALL`` members; above, members
    must share a second token as well; and where still more share both, some members at a time meet all others, twice as
    many each time.
    """
    group = list(group)
    bucket = [*group, "t"]
    prefix = F.slice("shared", 1, F.col("need"))
    index = sets.select(*group, "node", "n", F.explode(prefix).alias("t"))
    index = materialize(index, "index")
    links = similar_pairs(star_edges(index, bucket, "node", group, **join), sets, group, threshold, **join)
    labels = materialize(connected_components(links, group, **join), "labels")
    members = _open(_labelled(index, labels, group), bucket, **join)

    def met(pairs: DataFrame) -> DataFrame:
        """The components with the links among further pairs."""
        found = similar_pairs(pairs, sets, group, threshold, **join)
        return labels if found.isEmpty() else _joined(labels, found, group, **join)

    labels = met(_within(members.where(F.col("size") <= SMALL), bucket, group, threshold))
    large = members.where(F.col("size") > SMALL)
    if large.isEmpty():
        return labels
    # Like sets share two tokens, the second one within one place more of the order, unless together they are tiny;
    # tiny sets keep to the bucket of the one token.
    wider = sets.select(*group, "node", F.slice("shared", 1, F.col("need") + 1).alias("_wide"))
    placed = large.drop("size").join(wider, [*group, "node"])
    at = F.array_position("_wide", F.col("t")).cast("int")
    rest = F.slice("_wide", at + 1, F.size("_wide"))
    double = placed.select(*bucket, "node", "n", F.explode(rest).alias("u"))
    tiny = F.col("n") <= F.lit(1 / threshold + 1e-9)
    double = double.unionByName(large.where(tiny).select(*bucket, "node", "n", F.col("t").alias("u")))
    bucket = [*bucket, "u"]
    members = _open(_labelled(double, labels, group), bucket, **join)
    heads_each = SMALL
    while True:
        labels = met(_within(members.where(F.col("size") <= SMALL), bucket, group, threshold))
        members = members.where(F.col("size") > SMALL)
        if members.isEmpty():
            return labels
        # The largest component of a bucket comes last, so it never has to be compared with itself.
        share = members.groupBy(*bucket, "label").agg(F.count(F.lit(1)).alias("_share"))
        ranked = members.join(share, [*bucket, "label"])
        order = Window.partitionBy(*bucket).orderBy("_share", "label", "node")
        heads = materialize(ranked.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= heads_each), "heads")
        by_bucket = heads.groupBy(*bucket).agg(F.collect_list(F.struct("node", "n", "label")).alias("heads"))
        facing = salted_join(members, by_bucket, bucket, spread=["node"], **join)
        pairs = facing.select(*group, F.struct("node", "n", "label").alias("src"), F.explode("heads").alias("dst"))
        labels = met(_near(pairs, group, threshold))
        left = members.join(heads.select(*bucket, "node"), [*bucket, "node"], "left_anti").drop("size")
        members = _open(_labelled(left, labels, group), bucket, **join)
        heads_each = min(2 * heads_each, MOST_HEADS)


def similar_groups(
    rows: DataFrame,
    group: Sequence[str],
    node: str,
    tokens: str,
    threshold: float = 0.5,
    hot_rows: int = HOT_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """``(group, node, component)`` for every row: the smallest node of its connected near copies.

    ``tokens`` is a column of distinct strings. A row without tokens is alone. Complete: any two rows of a group whose
    Jaccard similarity is at least ``threshold`` are in one component.
    """
    group = list(group)
    join = {"hot_rows": hot_rows, "small_bytes": small_bytes}
    stored = hashed_sets(rows, group, node, tokens)
    hashed = stored.select(*group, "node", "doc", "digest", "n").where("n > 0")
    # One row per distinct set, under its smallest node: copies of one text take part as one.
    first = materialize(hashed.groupBy(*group, "digest").agg(F.min("node").alias("node")), "first")
    units = hashed.join(first.select(*group, "node"), [*group, "node"], "left_semi")
    units = units.groupBy(*group, "node", "digest", "n").agg(F.min("doc").alias("doc"))
    sets = shared_tokens(stored, materialize(units, "units"), group, threshold, hot_rows)
    labels = complete_labels(sets, group, threshold, **join)
    roots = first.join(labels, [*group, "node"], "left").select(*group, "digest", F.coalesce("component", "node").alias("component"))
    # Copies of one text may be a large share of all rows, hence the salt.
    found = salted_join(hashed.select(*group, "node", "digest"), roots, [*group, "digest"], spread=["node"], **join)
    found = found.select(*group, F.col("node").alias(node), "component")
    alone = stored.where(F.coalesce("n", F.lit(0)) <= 0)
    alone = alone.select(*group, F.col("node").alias(node), F.col("node").alias("component"))
    return found.unionByName(alone)
