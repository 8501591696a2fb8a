"""Burst trie against a trie of plain dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

from newsloom.llm import bursttrie

SCHEMA = "conv_id long, turn long, role string, text string, id string, conv string, pos int, path string, node int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1, "c", 2) for r in rows], SCHEMA)


def brute(rows, shared):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, name, role, text))
    own = {c: [(t[3], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    members, kids, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6 if shared else 0
        base = conv - conv % 100 if conv >= 0 else conv + -conv % 100
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
            if d:
                kids[path[: d - 1]].add(path[:d])
        ends[path].append(conv)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += not kids[node]
    return sorted(
        repr((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        ))
        for node, convs in members.items()
    )


def check(spark, rows, **options):
    found = sorted(repr(tuple(r)) for r in bursttrie.prefix_trie(table(spark, rows), **options).collect())
    assert found == brute(rows, options.get("shared_heads", False))
    return len(found)


def mixed(seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(0, 130), -5, -150, 100_000_007]:
        for turn in range(rng.choice([1, 2, 3, 6])):
            rows.append((conv, rng.choice([turn, turn, None, turn // 2]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", None, "é😀"])))
    return [*rows, (None, 0, "u", "lost"), (None, None, None, None), rows[0], rows[0]]


def test_rebuilt_conversations(spark):
    assert check(spark, mixed(3), shared_heads=True) > 100


def test_bursting_changes_nothing(spark):
    assert check(spark, mixed(4), shared_heads=True, container=2_000) > 100


def test_layers_and_bursts(spark):
    rows = [(c, t, "u", f"t{t}" if t < 5 or c % 2 else f"t{t}-{c}") for c in range(6) for t in range(11)]
    # One ends where a layer ends, and is the smallest there.
    rows += [(-1, t, "u", f"t{t}") for t in range(4)] + [(50, 0, "u", "t0"), (51, None, None, None), (52, 0, "u", "long " * 50_000)]
    assert check(spark, rows, layer=4) == check(spark, rows, layer=4, container=150)


def test_copies_are_one_suffix(spark):
    rows = [(c, t, "u", f"same {t}") for c in range(9_000, 14_000) for t in range(2)]
    assert check(spark, rows, container=500) == 3


def test_no_conversations(spark):
    assert check(spark, []) == 0
