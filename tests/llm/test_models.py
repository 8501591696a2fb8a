"""Language model, language filters, classifier chain, fingerprints and the link graph against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import chains, langfilters, linkgraph, phrases, ppm
from newsloom.llm.common import remainder

from .helpers import EXTRA, SCHEMA, by, no_documents, odd_documents


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


class PlainModel:
    """The same model with dictionaries, symbol by symbol."""

    def __init__(self, texts, order, least):
        self.order, self.counts = order, defaultdict(Counter)
        for text in texts:
            data = b"\xff" * order + text + b"\xff"
            for at in range(order, len(data)):
                for n in range(order + 1):
                    self.counts[data[at - n : at]][data[at]] += 1
        self.kept = {c: {s: n for s, n in found.items() if n >= least} for c, found in self.counts.items()}

    def distribution(self, context):
        """Probability of every symbol after a context."""
        out, mass, seen = np.zeros(256), 1.0, set()
        for n in range(self.order, -1, -1):
            part = context[len(context) - n :]
            kept = self.kept.get(part)
            if not kept:
                continue
            total = sum(self.counts[part].values()) - sum(kept.get(s, 0) for s in seen)
            new = {s: c for s, c in kept.items() if s not in seen}
            if total <= 0:
                continue
            for s, c in new.items():
                out[s] = mass * (c - 0.5) / total
            mass *= (total - sum(new.values()) + len(new) / 2) / total
            seen |= set(kept)
        rest = [s for s in range(256) if s not in seen]
        out[rest] = mass / len(rest)
        return out

    def score(self, text):
        data = b"\xff" * self.order + text + b"\xff"
        return sum(math.log10(self.distribution(data[at - self.order : at])[data[at]]) for at in range(self.order, len(data)))


@pytest.mark.parametrize("order, part_rows, word_bits, gram_bits", [(3, 1 << 19, 19, 22), (2, 7, 4, 3), (6, 40, 2, 6), (6, 1, 2, 22)])
def test_scores_equal_plain_counting(spark, order, part_rows, word_bits, gram_bits):
    rng = random.Random(1)
    rows = [(50 + i, " ".join(rng.choice(["tha", "the", "Then", "ñ", "aaa", "x"]) for _ in range(rng.randrange(60))), "en", "a") for i in range(40)]
    docs = odd_documents(spark, rows).where("doc_id is null or doc_id <> 7").repartition(4)
    options = {"order": order, "part_rows": part_rows, "word_bits": word_bits, "gram_bits": gram_bits}
    got = ppm.score_documents(docs, remainder(F.col("doc_id"), 7) != 2, **options)
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    data = [(r.doc_id, r.text, lowered(r.text).encode()) for r in docs.select("doc_id", "text").collect()]
    training = [t for d, _, t in data if not held(d)]
    plain = PlainModel(training, order, 1)
    assert plain.distribution(b"the th"[-order:]).sum() == pytest.approx(1) and plain.distribution(b"\xff" * order).sum() == pytest.approx(1)
    words = Counter(w for t in training for w in [*t.split(), b""])
    n, v = sum(words.values()), len(words)
    expected = []
    for doc, _, text in data:
        tokens = [*text.split(), b""]
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens)
        expected.append((doc, held(doc), len(tokens), sum(words[w] > 0 for w in tokens), n, base, plain.score(text)))
    found = by(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    expected.sort(key=lambda r: (repr(r[:5]), r[5]))
    found.sort(key=lambda r: (repr(r[:5]), r[5]))
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    np.testing.assert_allclose([r[5:] for r in found], [r[5:] for r in expected], rtol=1e-4, atol=1e-4)


@pytest.mark.parametrize("options", [{}, {"gram_bits": 3}])
def test_scores_keep_rare_contexts_of_large_corpora(spark, options):
    often, rare = "lang " * 3000, "zyxwvut qpo\u00e9"
    repeated = spark.range(300).select(F.lit(1).alias("doc_id"), F.lit(often).alias("text"))
    docs = repeated.unionByName(spark.createDataFrame([(2, rare), (3, rare + " lanzyx")], "doc_id int, text string"))
    plain = PlainModel([], 6, 1)
    for text, times in ((often, 300), (rare, 1)):
        for context, found in PlainModel([text.encode()], 6, 1).counts.items():
            for symbol, n in found.items():
                plain.counts[context][symbol] += n * times
    assert sum(plain.counts[b""].values()) > 1 << 22
    plain.kept = plain.counts
    got = {r.doc_id: r.score for r in ppm.score_documents(docs, F.col("doc_id") < 3, **options).where("doc_id > 1").collect()}
    assert got == pytest.approx({2: plain.score(rare.encode()), 3: plain.score((rare + " lanzyx").encode())}, abs=1e-4)


def test_scores_without_training(spark):
    docs = odd_documents(spark)
    row = ppm.score_documents(docs, F.lit(False)).where("doc_id = 3").first()
    assert row.score == pytest.approx(5 * math.log10(1 / 256)) and (row.n_known, row.train_tokens) == (0, 0)
    assert ppm.score_documents(no_documents(spark), F.lit(True)).count() == 0


SYLLABLES = {"en": "the and ing tion ly er", "fr": "le eau ez oi que à", "de": "der sch ung ß ich ein"}


def prose(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def test_languages(spark):
    rng = random.Random(8)
    rows = [(100 + i, prose(rng, lang, rng.randrange(3, 80)), lang, "a") for i, lang in enumerate(["en", "fr", "de"] * 60)]
    docs = odd_documents(spark, rows).repartition(4)
    got = langfilters.predict(docs, remainder(F.col("doc_id"), 3) != 1)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.count() == docs.count()
    assert got.where("doc_id in (0, 1, 2, 8) and lang_pred <> 'und'").count() == 0
    assert got.where("score < 0 or score > 1 or score is null").count() == 0
    names = {doc: lang for doc, _, lang, _ in rows}
    held = [(r.doc_id, r.lang_pred) for r in got.where("held_out and doc_id >= 100").collect()]
    assert len(held) > 40 and sum(names[d] == p for d, p in held) >= 0.95 * len(held)
    assert by(got.where("held_out"), "doc_id") == by(docs.where("pmod(crc32(coalesce(cast(doc_id as string), '')), 3) = 1"), "doc_id")
    nothing = langfilters.predict(docs, F.lit(False))
    assert by(nothing.select("lang_pred", "score").distinct(), "lang_pred", "score") == [("und", 0.0)]
    assert langfilters.predict(no_documents(spark), F.lit(True)).count() == 0


def many_letters(rng, start, n):
    """Prose of a script of 3,000 letters, the k-th used like 1 / k."""
    letters = [chr(start + i) for i in range(3_000)]
    weights = [1 / (k + 5) for k in range(3_000)]
    return "".join(rng.choices(letters, weights, k=n))


def test_scripts_of_many_letters_at_two_sizes(spark):
    rng = random.Random(31)
    scores = []
    for count in (30, 600):
        rows = [(1000 + i, [many_letters(rng, 0x4E00, 400), many_letters(rng, 0xAC00, 400), prose(rng, "en", 60)][i % 3], ["zh", "ko", "en"][i % 3], "s") for i in range(count)]
        held = [(5000 + i, many_letters(rng, [0x4E00, 0xAC00][i % 2], 300), None, "s") for i in range(20)]
        got = langfilters.predict(odd_documents(spark, [*rows, *held]), F.col("doc_id") < 5000).where("doc_id >= 5000").collect()
        assert [r.lang_pred for r in sorted(got)] == ["zh", "ko"] * 10
        scores.append(min(r.score for r in got))
    # More text can only fill the filter: no clean text falls below the least score of the pipeline.
    assert scores[0] > 0.05 and scores[1] > scores[0]


def test_ties_of_languages(spark):
    rows = [(1000 + i, "same words for both", ["xx", "aa"][i % 2], "s") for i in range(8)]
    got = langfilters.predict(odd_documents(spark, rows), F.col("lang").isin("xx", "aa"))
    assert {(r.lang_pred, r.score) for r in got.where("doc_id >= 1000").collect()} == {("aa", 1.0)}


def test_filters_equal_sets():
    rng = random.Random(3)
    texts = {f"l{i:03d}": prose(rng, lang, 200) for i, lang in enumerate(["en", "fr", "de"] * 30)}
    grams = {lang: set(langfilters.grams_of([t])[0].tolist()) for lang, t in texts.items()}
    filters = langfilters.Filters(sorted(grams), [np.array(sorted(grams[x]), np.uint64) for x in sorted(grams)])
    asked = [prose(rng, "en", 50), "a", "été"]
    rates, letters = filters.rates(asked, langfilters.GRAM)
    assert letters.all() and rates.shape == (3, 90)
    for at, text in enumerate(asked):
        own = langfilters.grams_of([text])[0].tolist()
        exact = [sum(g in grams[x] for g in own) / len(own) for x in sorted(grams)]
        np.testing.assert_allclose(rates[at], exact, atol=0.03)


def test_grams_do_not_depend_on_neighbours():
    texts = ["Ab  c!", "", "…", "x", "日本 語", "ÀÉ"]
    together, owner = langfilters.grams_of(texts)
    for at, text in enumerate(texts):
        assert langfilters.grams_of([text])[0].tolist() == together[owner == at].tolist()
    assert langfilters.grams_of(["ab C"])[0].tolist() == langfilters.grams_of([" AB ,; c"])[0].tolist()


def test_chain_finds_planted_words(spark):
    rng = random.Random(9)
    words = [f"wort{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        toxic = i % 5 == 0
        if toxic:
            text += [rng.choice(["vileish", "vilelike", "rotten"]) for _ in range(2)]
        poor = rng.random() < (0.8 if toxic else 0.2)
        if poor:
            text += ["clickbait"] * 2
        rows.append((1000 + i, " ".join(text), "en", "a"))
        if i % 3:
            labels.append((1000 + i, int(not poor), int(toxic)))
    docs = odd_documents(spark, rows).repartition(4)
    odd = [(1000, None, 1), (None, 1, 1), (77, 1, 0), labels[0]]
    table = spark.createDataFrame(labels + odd, "doc_id long, quality int, toxic int").withColumn("_key", F.lit("x"))
    got = chains.toxicity(docs, table)
    assert got.columns == ["doc_id", "p_quality", "p_toxic", "toxic"] and got.count() == docs.count()
    for r in got.where("doc_id >= 1000").collect():
        assert r.toxic == ((r.doc_id - 1000) % 5 == 0)
    assert got.where("doc_id in (0, 1, 2) and toxic").count() == 0
    bare = chains.toxicity(docs, table.limit(0))
    assert bare.where("toxic").count() == 0 and bare.count() == docs.count()
    assert chains.toxicity(no_documents(spark), table).count() == 0


def test_threshold_covers_all_labels(spark):
    rng = random.Random(4)
    rows = [(i, "doubtful word" if i % 3 == 0 else "clean word", i % 3 == 0 and rng.random() < 0.15) for i in range(3000)]
    rows += [(3000 + i, "vile word", True) for i in range(300)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(toxic)) for i, _, toxic in rows], "doc_id long, quality int, toxic int")
    # Of all rows, 85 in 100 doubtful ones are clean; of a sample with as many toxic as clean rows, far fewer.
    small = chains.toxicity(docs, labels, sample=200).join(docs, "doc_id").groupBy("text").agg(F.max("toxic").alias("t")).collect()
    assert {r.text: r.t for r in small} == {"clean word": False, "doubtful word": False, "vile word": True}


def test_later_models_are_fed_by_earlier_ones():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(np.arange(10, 60, dtype=np.uint32), 5, replace=False)) for _ in range(400)]
    first = (rng.random(400) < 0.5).astype(int)
    rows = [np.append(r, np.uint32(99)) if f else r for r, f in zip(rows, first)]
    chain = chains.fit_chain(rows, np.column_stack([first, first]), np.arange(400) % 4)
    assert [len(c["weights"]) - 1 - len(c["pieces"]) for c in chain] == [0, 1] and chain[1]["weights"][-2] > 0


def test_fingerprints(spark):
    rng = random.Random(6)
    rows = [(100 + 3 * i, prose(rng, "en", rng.randrange(1, 300)), "en", "a") for i in range(60)]
    docs = odd_documents(spark, rows).repartition(5)
    got = phrases.fingerprints(docs)
    assert got.columns[0] == "doc_id" and got.count() == docs.count()
    texts = sorted(
        ((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())
    )
    expected = []
    for (doc, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        sketch = phrases.sketches([text, edited, after])
        empty = np.array([not text, not edited, not after])
        near = [float(phrases.likeness(sketch[:1], sketch[i : i + 1], empty[:1], empty[i : i + 1])[0]) for i in (1, 2)]
        prints = [phrases.fingerprint(s, t) for s, t in zip(sketch, (text, edited))]
        expected.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), *prints, *near))
    assert by(got, *got.columns) == sorted(expected, key=repr)
    assert phrases.fingerprints(no_documents(spark)).count() == 0
    alone = phrases.fingerprints(docs.where("doc_id = 5")).first()
    assert alone.near_next == 1.0


def test_equal_substrings_share_phrases():
    rng = random.Random(2)
    shared = prose(rng, "en", 400)
    one, owner_one = phrases.phrase_names([prose(rng, "en", 30) + shared])
    two, owner_two = phrases.phrase_names([shared + prose(rng, "en", 17)])
    other, _ = phrases.phrase_names([prose(rng, "en", 430)])
    assert len(set(one) & set(two)) > 0.8 * min(len(set(one)), len(set(two)))
    assert len(set(one) & set(other)) < 0.3 * len(set(one))
    many = ["", "a", "aaaa", "abab" * 50, "b" * 5000, shared, "😀é" * 9]
    names, owner = phrases.phrase_names(many)
    for at, text in enumerate(many):
        assert sorted(phrases.phrase_names([text])[0]) == sorted(names[owner == at])
    assert len({phrases.sketches([t])[0].tobytes() for t in many[1:]}) == len(many) - 1


def plain_host(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lowered(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    fits = [(h + p, v) for v, h, p in linkgraph.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def plain_verdicts(pages, rounds):
    rows = [(page, *plain_host(url), html or "") for page, url, html in pages]
    said = {i: plain_rule(h, p) for i, (_, h, p, _) in enumerate(rows)}
    edges, hosts = Counter(), {h for _, h, _, _ in rows if h}
    for _, host, _, html in rows:
        for to in re.findall(linkgraph._LINK.replace("(?i)", ""), html, re.I):
            if host and lowered(to) != host:
                edges[host, lowered(to)] += 1
    under = set()
    for host in hosts:
        while host.count(".") >= 2:
            above = host.split(".", 1)[1]
            under |= {(host, above), (above, host)}
            host = above
    for pair in under:
        edges[pair] += 1
    out, into = Counter(), Counter()
    for (a, b), n in edges.items():
        out[a] += n
        into[b] += n
    own = lambda h, v: [said[i][1] == v for i, r in enumerate(rows) if r[1] == h]
    seeds = {v: {h: sum(own(h, v)) / len(own(h, v)) for h in hosts} for v in ("allow", "block")}
    ranks = {v: dict(s) for v, s in seeds.items()}
    for _ in range(rounds):
        new = {v: Counter({h: 0.15 * x for h, x in s.items()}) for v, s in seeds.items()}
        for (a, b), n in edges.items():
            new["allow"][b] += 0.85 * ranks["allow"].get(a, 0) * n / out[a]
            new["block"][a] += 0.85 * ranks["block"].get(b, 0) * n / into[b]
        ranks = new
    found = []
    for i, (page, host, path, _) in enumerate(rows):
        good, bad = ranks["allow"].get(host, 0.0), ranks["block"].get(host, 0.0)
        verdict = "block" if host and bad > 0 and bad >= linkgraph.BLOCKED * (good + bad) else "allow"
        found.append((page, host, path, said[i][0], said[i][1] or verdict, round(good, 9), round(bad, 9)))
    return sorted(found, key=repr)


def test_link_graph_equals_brute_force(spark):
    rng = random.Random(12)
    hosts = ["a.example.com", "b.example.com", "x.y.example.net", "m.example.org", "z.net", "Bad.Example.COM", "example.net"]
    pages = []
    for i in range(120):
        host = rng.choice(hosts)
        links = [f'<a href="{rng.choice(["https:", "http:", ""])}//{rng.choice(hosts)}/p?q">' for _ in range(rng.randrange(4))]
        links += ["<a HREF = '//t.net'>", '<a href="/own">', "<a href=mailto:x@y.z>"] if i % 7 == 0 else []
        lang = rng.choice(["fr", "de", "de", "en", "es"])
        pages.append((i, f"http://{host}/{lang}/{i}?x=//no#y", "".join(links)))
    pages += [(None, None, None), (500, "no scheme", "x"), (501, "://", None), (502, "ftp://org", ""), (502, "ftp://org/", ""), (503, "a://b.example.org/en/1://c", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("_key", F.lit(1)).repartition(3)
    for rounds in (1, 10):
        got = linkgraph.judge(df, rounds=rounds)
        rounded = got.withColumns({c: F.round(c, 9) for c in ("trust", "distrust")})
        assert by(rounded, *got.columns) == plain_verdicts(pages, rounds)
    assert {r.verdict for r in got.where("rule is null and host <> ''").collect()} == {"allow", "block"}
    assert linkgraph.judge(df.limit(0)).count() == 0
    assert linkgraph.judge(df, rules=()).where("verdict <> 'allow' or rule is not null").count() == 0


def test_distrust_reaches_far_hosts(spark):
    """A host that comes to a blocked one by fifteen links is blocked, in pages with a single seed."""
    pages = [(0, "http://h0.test/", "")] + [(i, f"http://h{i}.net/", f'<a href="//h{i - 1}.{"net" if i > 1 else "test"}/">') for i in range(1, 16)]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    got = {r.page_id: r for r in linkgraph.judge(df, rules=(("block", "test", "/"),)).collect()}
    assert {r.verdict for r in got.values()} == {"block"}
    for i in (0, 1, 15):
        assert got[i].distrust == pytest.approx(0.15 * 0.85**i)
