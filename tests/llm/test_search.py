"""Near copies, benchmark passages and line spread against brute force."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from newsloom.llm import linespread, superminhash, wumanber

from .helpers import EXTRA, SCHEMA, by, no_documents, odd_documents


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def components(rows, width, percent):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, shingles(text, width))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows, number = [], 100
    for size in (1, 2, 9, 40, 70):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(60)] = rng.choice(words)
            rows.append((number, " ".join(copy)))
            number += 7
    # A ladder: each step is like the next, its ends are not alike.
    ladder = [rng.choice(words) for _ in range(80)]
    for _ in range(30):
        ladder = list(ladder)
        ladder[rng.randrange(80)] = rng.choice(words)
        rows.append((number, " ".join(ladder)))
        number += 1
    rng.shuffle(rows)
    return rows


def test_near_copies_equal_brute_force(spark):
    rows = [(d, t, "en", "a") for d, t in corpus()]
    docs = odd_documents(spark, rows).repartition(4)
    for width, percent, band in ((3, 85, 5), (5, 80, 4)):
        got = superminhash.near_duplicates(docs, words=width, percent=percent, band=band)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == docs.count()
        expected = components([tuple(r) for r in docs.select("doc_id", "text").collect()], width, percent)
        for doc, n, component, kept in by(got, "doc_id", "n_shingles", "component_id", "kept"):
            if doc is None:
                assert component is None and kept
            else:
                assert (n, component) == expected[doc] and kept == (component == doc)


def test_near_copies_of_nothing(spark):
    assert superminhash.near_duplicates(no_documents(spark)).count() == 0


def test_signature_estimates_likeness():
    import numpy as np

    rng = np.random.default_rng(2)
    errors = []
    for _ in range(150):
        all_ = rng.integers(0, 2**63, 400).astype(np.uint64)
        one, two = superminhash.signatures([np.unique(all_[:340]), np.unique(all_[60:])])
        errors.append((one == two).mean() - 280 / 400)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045
    small = superminhash.signatures([np.array([3], np.uint64), np.zeros(0, np.uint64)])
    assert len(np.unique(small[0])) == superminhash.SLOTS and (small[1] == np.iinfo(np.uint64).max).all()


def test_many_members_like_none(spark):
    """600 copies of one text with so many changes that few are alike, some of them changed alike, among closer copies."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for number in range(600):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 3, 5, 6, 7, 9, 12])):
            copy[rng.randrange(120)] = rng.choice(words)
        if number % 10 == 0:
            for at in range(20, 27):
                copy[at] = f"v{number % 3}"
        rows.append((1_000 + number, " ".join(copy)))
    docs = odd_documents(spark, [(n, t, "en", "a") for n, t in rows]).where("doc_id >= 1000").repartition(4)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in superminhash.near_duplicates(docs, words=3, percent=85).collect()}
    true = components(rows, 3, 85)
    assert found == true and len({c for _, c in true.values()}) > 100


def windows(words, n=10):
    return [tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(doc, items):
    words, hit, found = plain_words(doc), set(), set()
    for item, text in items:
        for w in windows(plain_words(text)):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_passages_equal_brute_force(spark):
    rng = random.Random(4)
    letters = ["a", "b", "c", "é", "d9"]
    line = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(i, line(n)) for i, n in enumerate([1, 2, 5, 9, 10, 11, 14, 30])]
    items = [(i, f"q{i} " + t) if i < 6 else (i, t) for i, t in items] + [(20, None), (21, " ... "), (22, items[7][1]), (3, "A b-C")]
    texts = [line(rng.randrange(1, 200)) for _ in range(40)]
    texts += [x[1][: len(x[1]) * 2 // 3].upper() + "! " + (x[1] or "") for x in items if x[1]]
    docs = odd_documents(spark, [(1000 + i, t, "en", "a") for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("_text", F.lit("x"))
    expected = sorted(((d, *contaminated(t, items)) for d, t in docs.select("doc_id", "text").collect()), key=repr)
    for block in (200_000, 7):
        got = wumanber.contamination(docs.repartition(3), benchmark, block_windows=block)
        assert by(got, *got.columns) == expected
    assert wumanber.contamination(no_documents(spark), benchmark).count() == 0
    nothing = wumanber.contamination(docs, benchmark.limit(0))
    assert nothing.where("contaminated").count() == 0 and nothing.count() == docs.count()


def test_lines_by_hand(spark):
    page = [(100 + i, f"own line {i} with words of its own here\n Share this \n\nmore of {i}", "en", f"s{i % 9}") for i in range(20)]
    copies = [(200 + i, "The same story\nTold on every site\nShare this", "en", f"s{i % 9}") for i in range(20)]
    few = [(300 + i, f"text {i} that stands alone on this page\nSeven sites only", "en", f"s{i % 7}") for i in range(30)]
    docs = odd_documents(spark, [*page, *copies, *few])
    got = linespread.remove_boilerplate(docs.repartition(4), sites=8, counts=("n", "gone"))
    assert got.columns == [*docs.columns, "n", "gone"] and got.count() == docs.count()
    found = {r.doc_id: r for r in got.where("doc_id >= 100").collect()}
    for doc, text, _, _ in page:
        assert found[doc].text == text.replace(" Share this \n", "") and (found[doc].n, found[doc].gone) == (3, 1)
    # The lines of a copied page stay, but not those that other pages have too.
    for doc, text, _, _ in copies:
        assert found[doc].text == text.removesuffix("\nShare this") and found[doc].gone == 1
    for doc, text, _, _ in few:
        assert found[doc].text == text and found[doc].gone == 0
    # Short pages of own words under a long shared block, with other blanks at its ends: the block goes from all.
    block = [f"menu entry {i} of the long block" for i in range(9)]
    short = [(400 + i, "\r\n".join(["\t" + x for x in block]) + "\n" + " ".join(f"own{i}x{k}" for k in range(25)), "en", f"s{i % 9}") for i in range(20)]
    alike = [(500 + i, "\n".join(f"sentence {k} of one story that is told everywhere" for k in range(12)) + f"\nseen {i}", "en", f"s{i % 9}") for i in range(20)]
    more = linespread.remove_boilerplate(odd_documents(spark, [*short, *alike]).repartition(3), counts=("n", "gone")).where("doc_id >= 400")
    for r in more.collect():
        if r.doc_id < 500:
            assert (r.n, r.gone, r.text) == (10, 9, short[r.doc_id - 400][1].split("\n")[-1])
        else:
            assert (r.n, r.gone, r.text) == (13, 0, alike[r.doc_id - 500][1])
    same = by(got.where("doc_id < 100 or doc_id is null"), *docs.columns)
    assert same == by(docs.where("doc_id < 100 or doc_id is null"), *docs.columns)
    assert linespread.remove_boilerplate(no_documents(spark)).count() == 0


def test_exact_counts_decide_near_the_threshold(spark):
    rows = [(i, f"line {n}", "en", f"s{s}", 0, *EXTRA) for i, (n, s) in enumerate((n, s) for n in range(6, 11) for s in range(n))]
    docs = spark.createDataFrame(rows, SCHEMA).select("text", F.col("source").alias("site"))
    lines = docs.select(F.xxhash64("text").alias("_h"), F.hash("text").alias("_g"), "site", "text")
    spread = linespread.spread_lines(lines.cache(), sites=8).join(lines, ["_h", "_g"]).select("text").distinct()
    assert by(spread, "text") == [("line 10",), ("line 8",), ("line 9",)]
