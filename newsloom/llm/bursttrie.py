"""Trie of conversation prefixes, built as burst tries.

A conversation is a path of turn ids (32 hex digits each). All suffixes below one trie head are a container. A container
that holds too many bytes bursts: its head becomes a node of its own and its suffixes move, by their next turn id, to
containers one turn further down. What is left are containers of bounded size; Spark sorts them and a task sweeps each
into nodes. Equal paths are one suffix with a count, so a group of copies never makes a container large.

Long conversations are cut into layers of ``LAYER`` turns, each a suffix of its own under the head that all turns before
it lead to, so a single conversation may hold any number of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches
from newsloom.operators.keyed import HOT_ROWS, MAX_HOT_KEYS, number_in_group, salted_join
from newsloom.session import materialize

ID = 32
LAYER = 4096
#: A container with more bytes of suffixes than this bursts.
CONTAINER = 1 << 20
#: Members of a digest are joined in runs of at most 2**12 neighbouring ids.
RUN_BITS = 12
NO_ENDS = hashlib.sha256().hexdigest()
LEAST_LONG = -(1 << 63)


def turn_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, pos, id, len)``: the turns of each conversation numbered from 1, without their texts.

    A null turn stands first, a null role or text is empty; turns of one number are ordered by their id, the MD5 of
    role and text. Rows without a conversation are left out. Numbering never holds a whole conversation in a task.
    """
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.coalesce(F.col(turn).cast("long"), F.lit(LEAST_LONG)).alias("_turn"),
        F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)).alias("id"),
        F.length(text_).alias("len"),
    )
    return number_in_group(rows, ["conv"], ["_turn", "id"], "pos").select("conv", "pos", "id", "len")


def own_turns(turns: DataFrame) -> DataFrame:
    """``(conv, total, pos, id, len)`` of conversations as they are; see ``paths``."""
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))
    start = sizes.select("conv", "total", F.lit(0).cast("long").alias("pos"), F.lit("").alias("id"), F.lit(0).alias("len"))
    return start.unionByName(turns.join(sizes, "conv"))


def with_shared_heads(turns: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """Conversations rebuilt: the first h turns come from the first conversation of the family, the others are their own.

    The family of c begins at c - c % family; h is crc32 of the decimal c, modulo ``most`` + 1. ``turns`` is stored.
    Same columns as ``own_turns``; every conversation has a row at place 0, also if no turn is left.
    """
    conv = F.col("conv")
    h = (F.crc32(conv.cast("string").cast("binary")) % (most + 1)).cast("int")
    top = (
        turns.where((conv % family == 0) & (F.col("pos") <= most))
        .groupBy(conv.alias("_base"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "id", "len"))).alias("_top"))
    )
    # A family has at most 2 * family - 1 members, so this join is even.
    members = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("_own")).withColumn("_base", conv - conv % family)
    taken = F.when(h > 0, F.slice(F.coalesce("_top", F.expr("array()")), 1, F.greatest(h, F.lit(1)))).otherwise(F.expr("array()"))
    info = members.join(top, "_base", "left").select("conv", h.alias("_h"), taken.alias("_taken"), "_own")
    total = F.size("_taken") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0))
    info = info.select("conv", "_h", "_taken", total.cast("long").alias("total"), F.size("_taken").alias("_copied"))
    start = F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit("").alias("id"), F.lit(0).alias("len")))
    copied = info.select("conv", "total", F.explode(F.concat(start, "_taken")).alias("t")).select("conv", "total", "t.*")
    own = turns.where(F.col("pos") > h).join(info.select("conv", "total", "_h", "_copied"), "conv")
    own = own.select("conv", "total", (F.col("pos") - F.col("_h") + F.col("_copied")).alias("pos"), "id", "len")
    return copied.unionByName(own)


def paths(rows: DataFrame, layer: int = LAYER) -> DataFrame:
    """``(conv, layer, h1, h2, path, lens, goes_on)``: one row for each layer of each conversation.

    ``h1`` and ``h2`` name all turns of the layers before: sums of hashes, so they need no walk along the conversation.
    """
    place = F.floor(F.greatest(F.col("pos") - 1, F.lit(0)) / layer).cast("long")
    found = (
        rows.groupBy("conv", place.alias("layer"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "id", "len"))).alias("t"), F.max("total").alias("total"))
        .select(
            "conv", "layer", F.array_join("t.id", "").alias("path"),
            F.transform(F.filter("t", lambda x: x["pos"] > 0), lambda x: x["len"]).alias("lens"),
            (F.col("total") > (F.col("layer") + 1) * layer).alias("goes_on"),
        )
    )
    found = materialize(found, "paths")
    none = F.lit(0).cast("long")
    flat = found.where("layer = 0").select("*", none.alias("h1"), none.alias("h2"))
    # Only conversations of several layers take part: one row for every ``layer`` turns.
    before = Window.partitionBy("conv").orderBy("layer").rowsBetween(Window.unboundedPreceding, -1)
    deep = found.where("goes_on or layer > 0")
    for name, value in zip(("h1", "h2"), _names("layer", "path")):
        deep = deep.withColumn(name, F.coalesce(F.bit_xor(value).over(before), none))
    return flat.unionByName(deep.where("layer > 0").select(*flat.columns))


def _names(layer: str, path: str) -> tuple[Column, Column]:
    digest = F.md5(F.col(path).cast("binary"))
    return F.xxhash64(F.col(layer), digest), F.xxhash64(digest, F.col(layer), F.lit(1))


def suffixes(layered: DataFrame) -> DataFrame:
    """Equal paths as one suffix: ``(layer, h1, h2, path, lens, n, least, goes_on, ends)``, stored.

    ``ends`` is the SHA-256 of the ids that end with the suffix, ascending, joined by commas. Runs of neighbouring ids
    are joined by an aggregation; the runs of a suffix are then hashed one after the other, as the digest demands.
    """
    label = F.md5(F.concat_ws("/", "layer", "h1", "h2", "path").cast("binary")).alias("label")
    classes = layered.groupBy("layer", "h1", "h2", "path", "lens").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"), F.max(F.col("goes_on").cast("int")).alias("goes_on")
    )
    runs = (
        layered.where(~F.col("goes_on"))
        .groupBy(label, F.shiftright("conv", RUN_BITS).alias("run"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    )
    ordered = runs.repartition("label").sortWithinPartitions("label", "run").select("label", "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, out = None, None, ([], [])
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != held:
                    if held is not None:
                        out[0].append(held)
                        out[1].append(state.hexdigest())
                    held, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in out], names=["label", "ends"])
            out = ([], [])
        if held is not None:
            yield pa.RecordBatch.from_pydict({"label": [held], "ends": [state.hexdigest()]})

    digests = ordered.mapInArrow(digest, "label string, ends string")
    return materialize(classes.withColumn("label", label).join(digests, "label", "left").drop("label"), "suffixes")


NODES = (
    "node string, above string, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def sweep_container(depth: int, up: int | None, top_len: int, rows: list[tuple]) -> list[list]:
    """Nodes of one container, top first: ``[depth, least, parent's least, n, children, leaves, saved, ends]``.

    ``rows`` are sorted suffixes ``(path, lens, n, least, ends, children, leaves, saved)``; the last three stand for
    what lies below the end of a suffix in the next layer.
    """
    parent, level, length = [-1], [depth], [top_len]
    n, least, children, leaves, saved, ends = [0], [None], [0], [0], [0], [NO_ENDS]
    stack, held = [0], ""
    for path, lens, count, first, digest, below, below_leaves, below_saved in rows:
        shared, most = 0, min(len(path), len(held))
        while shared < most and path[shared : shared + ID] == held[shared : shared + ID]:
            shared += ID
        del stack[shared // ID + 1 :]
        for at in range(shared // ID, len(path) // ID):
            top = stack[-1]
            children[top] += 1
            stack.append(len(parent))
            parent.append(top)
            level.append(depth + at + 1)
            length.append(lens[at])
            n.append(0)
            least.append(first)
            children.append(0)
            leaves.append(0)
            saved.append(0)
            ends.append(NO_ENDS)
        for node in stack:
            n[node] += count
            if least[node] is None or first < least[node]:
                least[node] = first
        end = stack[-1]
        ends[end] = digest or NO_ENDS
        children[end] += below
        leaves[end] += below_leaves
        saved[end] += below_saved
        held = path
    for node in range(len(parent) - 1, -1, -1):
        if not children[node]:
            leaves[node] = 1
        saved[node] += (n[node] - 1) * length[node]
        if node:
            leaves[parent[node]] += leaves[node]
            saved[parent[node]] += saved[node]
    ups = [up] + [least[p] for p in parent[1:]]
    return [list(column) for column in (level, least, ups, n, children, leaves, saved, ends)]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.string(), *[pa.int64()] * 7, pa.string()]
    names = [part.split()[0] for part in NODES.split(", ")]
    held, rows = None, []
    out: list[list] = [[] for _ in names]

    def close() -> None:
        node, above, depth, up, top_len = held
        found = sweep_container(depth, up, top_len, rows)
        size = len(found[0])
        for column, values in zip(out, [[node] + [None] * (size - 1), [above] + [None] * (size - 1), *found]):
            column += values

    def flush() -> pa.RecordBatch:
        nonlocal out
        batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names=names)
        out = [[] for _ in names]
        return batch

    for batch in batches:
        values = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*values):
            if held is None or row[0] != held[0]:
                if held is not None:
                    close()
                held, rows = row[:5], []
                if len(out[0]) > 10_000:
                    yield flush()
            rows.append(row[5:])
    if held is not None:
        close()
    yield flush()


def _layer_nodes(current: DataFrame, container: int) -> DataFrame:
    """Nodes of one layer, with the columns of ``NODES``; ``node`` and ``above`` are set for the tops of containers."""
    settled, heads = [], []
    while True:
        sizes = current.groupBy("node").agg(
            F.sum(F.length("path") + 4 * F.size("lens")).alias("_bytes"), F.min("least").alias("_least"), F.count(F.lit(1)).alias("_rows")
        )
        big = materialize(sizes.where(F.col("_bytes") > container), "burst")
        if big.isEmpty():
            settled.append(current)
            break
        hot = big.where(F.col("_rows") >= HOT_ROWS).orderBy(F.desc("_rows")).limit(MAX_HOT_KEYS)
        join = {"spread": ["path"], "hot": hot}
        settled.append(salted_join(current, big.select("node"), ["node"], "left_anti", **join))
        moved = salted_join(current, big.select("node", "_least"), ["node"], **join).withColumn("_next", F.substring("path", 1, ID))
        top = ["node", "above", "depth", "up", "top_len"]
        here = F.col("_next") == ""
        by_next = moved.groupBy(*top, "_next").agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.max(F.when(here, F.col("ends"))).alias("ends"),
            *[F.sum(F.when(here, F.col(c)).otherwise(0)).alias(c) for c in ("below", "below_leaves", "below_saved")],
        )
        found = by_next.groupBy(*top).agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), F.max("ends").alias("ends"),
            (F.count_if(~here) + F.sum("below")).alias("children"), F.sum("below_leaves").alias("leaves"),
            F.sum("below_saved").alias("saved"),
        )
        heads.append(materialize(found, "heads"))
        children = moved.where(~here).select(
            F.md5(F.concat("node", "_next").cast("binary")).alias("node"), F.col("node").alias("above"),
            (F.col("depth") + 1).alias("depth"), F.col("_least").alias("up"), F.get("lens", F.lit(0)).cast("long").alias("top_len"),
            F.expr(f"substring(path, {ID + 1})").alias("path"), F.slice("lens", F.lit(2), F.size("lens")).alias("lens"),
            "n", "least", "ends", "below", "below_leaves", "below_saved",
        )
        current = materialize(children, "containers")
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionByName(more)
    ordered = rows.repartition("node").sortWithinPartitions("node", "path")
    columns = ["node", "above", "depth", "up", "top_len", "path", "lens", "n", "least", "ends", "below", "below_leaves", "below_saved"]
    nodes = ordered.select(*columns).mapInArrow(_sweep, NODES)
    if not heads:
        return nodes
    nodes = materialize(nodes, "nodes")
    sums = [F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")]
    under = materialize(nodes.where("above is not null").groupBy("above").agg(*sums), "under")
    finished = nodes
    for found in reversed(heads):
        totals = found.join(under, F.col("node") == under["above"], "left").select(found["*"], "_leaves", "_saved")
        leaves, saved = (F.col(a) + F.coalesce(b, F.lit(0)) for a, b in (("leaves", "_leaves"), ("saved", "_saved")))
        done = totals.select(
            "node", "above", "depth", F.col("least").alias("conv_id"), F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"), leaves.alias("n_leaves"),
            (saved + (F.col("n") - 1) * F.col("top_len")).alias("saved_tokens"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
        done = materialize(done, "heads")
        finished = finished.unionByName(done)
        more = done.where("above is not null").groupBy("above").agg(*sums)
        under = under.unionByName(more).groupBy("above").agg(F.sum("_leaves").alias("_leaves"), F.sum("_saved").alias("_saved"))
    return finished


def trie(layered: DataFrame, container: int = CONTAINER, layer: int = LAYER) -> DataFrame:
    """The nodes of the trie over ``paths``, one layer after the other from the deepest.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``; no rows without
    conversations.
    """
    bounded_batches(layered.sparkSession)
    classes = suffixes(layered)
    last = classes.agg(F.max("layer").alias("m")).first()["m"]
    none, result, below = F.lit(0).cast("long"), None, None
    head = F.concat_ws("/", "h1", "h2")
    for number in range(last if last is not None else 0, -1, -1):
        rows = classes.where(F.col("layer") == number)
        if below is None:
            rows = rows.select("*", none.alias("below"), none.alias("below_leaves"), none.alias("below_saved"))
        else:
            one, two = _names("layer", "path")
            following = F.concat_ws("/", F.col("h1").bitwiseXOR(one), F.col("h2").bitwiseXOR(two))
            rows = rows.withColumn("_head", F.when(F.col("goes_on") == 1, following)).join(below, "_head", "left")
            rows = rows.na.fill(0, ["below", "below_leaves", "below_saved"])
        start = rows.select(
            head.alias("node"), F.lit(None).cast("string").alias("above"), F.lit(number * layer).cast("long").alias("depth"),
            F.lit(None).cast("long").alias("up"), none.alias("top_len"), "path", "lens", "n", "least", "ends",
            "below", "below_leaves", "below_saved",
        )
        if number:
            # Conversations that end at the head have no suffix here, yet one may be its smallest member.
            one, two = _names("layer", "path")
            through = classes.where((F.col("layer") == number - 1) & (F.col("goes_on") == 1)).select(
                F.concat_ws("/", F.col("h1").bitwiseXOR(one), F.col("h2").bitwiseXOR(two)).alias("node"), "least"
            )
            blank = {"depth": F.lit(number * layer).cast("long"), "path": F.lit(""), "lens": F.expr("array()").cast("array<int>")}
            blank |= {name: none for name in ("top_len", "n", "below", "below_leaves", "below_saved")}
            kinds = {f.name: f.dataType for f in start.schema.fields}
            empty = {name: F.lit(None).cast(kinds[name]) for name in ("above", "up", "ends")}
            made = blank | empty | {"node": F.col("node"), "least": F.col("least")}
            start = start.unionByName(through.select(*[made[c].alias(c) for c in start.columns]))
        nodes = _layer_nodes(start, container)
        if number:
            nodes = materialize(nodes, "layer")
            # The top of a deeper layer is the last node of the layer above; here it only carries what lies below it.
            at_top = F.col("node").isNotNull() & (F.col("depth") == number * layer)
            below = nodes.where(at_top).select(
                F.col("node").alias("_head"), F.col("n_children").alias("below"),
                F.col("n_leaves").alias("below_leaves"), F.col("saved_tokens").alias("below_saved"),
            )
            nodes = nodes.where(F.col("depth") > number * layer)
        result = nodes if result is None else result.unionByName(nodes)
    return result.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(df: DataFrame, shared_heads: bool = False, container: int = CONTAINER, layer: int = LAYER, **columns: str) -> DataFrame:
    """Nodes of the trie over all conversations of a table, as they are or rebuilt with shared heads."""
    turns = materialize(turn_rows(df, **columns), "turns")
    rows = with_shared_heads(turns) if shared_heads else own_turns(turns)
    return trie(paths(rows, layer), container, layer)
