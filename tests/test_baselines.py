import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from newsloom.operators import baseline, merge, resolve, similar

from .conftest import rows


def grams(text, width=3):
    words = text.lower().split()
    return {" ".join(words)} if 0 < len(words) <= width else {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def texts():
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(random.choices(vocabulary, k=40)) for _ in range(25)]
    out = []
    for text in base:
        out += [text] * random.choice([1, 1, 5])
        words = text.split()
        for _ in range(random.choice([0, 2])):
            copy = list(words)
            copy[random.randrange(40)] = "edit"
            out.append(" ".join(copy))
    # A third of all rows are copies of one text, each with an edit of its own.
    out += [base[0].replace(base[0].split()[k % 40], f"new{k}", 1) for k in range(60)]
    return out + ["", "one two", "one two"]


def brute_force(sets, threshold=0.5):
    """The smallest member of each one's component, over all pairs."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(sets)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def components_of(spark, groups, **options):
    """Found and true components of ``{group: list of token sets}``."""
    data = [(g, n, sorted(s)) for g, sets in groups.items() for n, s in enumerate(sets)]
    df = spark.createDataFrame(data, "g string, n long, tokens array<string>")
    found = {(r.g, r.n): r.component for r in similar.similar_groups(df, ["g"], "n", "tokens", **options).collect()}
    return found, {(g, n): c for g, sets in groups.items() for n, c in enumerate(brute_force(sets, options.get("threshold", 0.5)))}


@pytest.mark.parametrize("options", [{}, {"small_bytes": 0, "hot_rows": 3}])
def test_groups_equal_brute_force_jaccard(spark, options):
    found, true = components_of(spark, {"d": [grams(t) for t in texts()]}, **options)
    assert found == true


def test_no_pair_of_random_groups_is_lost(spark):
    rng = random.Random(8)
    groups = {}
    for g in range(100):
        words = [f"w{i}" for i in range(rng.choice([6, 12, 40]))]
        groups[f"g{g}"] = [set(rng.choices(words, k=rng.randrange(0, 9))) for _ in range(rng.randrange(1, 25))]
    found, true = components_of(spark, groups)
    assert found == true and sum(c != n for (_, n), c in true.items()) > 300


def test_tokens_are_worked_out_once(spark):
    worked = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def tokens(text):
        worked.add(1)
        return None if text is None else text.split()

    data = [("d", 1, "a b c"), ("d", 2, "a b c"), ("d", 3, ""), ("d", 4, None), (None, 5, "a b"), ("e", 6, "a b c")]
    df = spark.createDataFrame(data, "g string, n long, text string").repartition(2)
    df = df.select("g", "n", tokens("text").alias("tokens"))
    found = similar.similar_groups(df, ["g"], "n", "tokens")
    assert rows(found) == [("d", 1, 1), ("d", 2, 1), ("d", 3, 3), ("d", 4, 4), ("e", 6, 6)]
    assert worked.value == len(data)


@pytest.mark.parametrize("threshold", [0.5, 0.3, 0.8])
def test_tokens_of_many_sets(spark, threshold):
    """Hot tokens: sets that share one or two with hundreds like none, tiny ones, and chains between them."""
    rng = random.Random(int(threshold * 10))
    one = [{"hot", *(f"a{k}-{i}" for i in range(3))} for k in range(90)]
    two = [{"hot", "warm", f"b{k}", f"b{k // 2}x"} for k in range(90)]
    tiny = [{"hot"}, *({"hot", f"c{k}"} for k in range(60))]
    chain = [{"hot", "warm", *(f"d{(k + i) % 50}" for i in range(7))} for k in range(50)]
    sets = one + two + tiny + chain
    rng.shuffle(sets)
    found, true = components_of(spark, {"d": sets}, threshold=threshold)
    assert found == true


def test_merge_events(spark):
    storm = "heavy storm hits the western hills and closes three roads near the river"
    data = [
        ("2024-01-01", "1", "storm", storm, ["A", "B"], "T1", "u1", "p"),
        ("2024-01-01", "2", "storm", storm + " today", ["B", "C"], "T2", "u2", "p"),
        ("2024-01-01", "10", "storm", storm, ["D"], "T1", "u1", "p"),
        ("2024-01-01", "3", "match", "the home side wins the final by two goals", ["E", "E"], "T3", "u3", "p"),
        ("2024-01-02", "1", "storm", storm, ["A"], "T4", "u4", "p"),
    ]
    dated = spark.createDataFrame(data, "event_date string, id string, event string, details string, actors array<string>, title string, article_url string, published_date string")
    parts = merge.merge_events(dated)
    assert rows(parts["members"].select("event_date", "merged_id", "id")) == [("2024-01-01", 1, "1"), ("2024-01-01", 1, "10"), ("2024-01-01", 1, "2"), ("2024-01-01", 3, "3"), ("2024-01-02", 1, "1")]
    sources = merge.merged_sources(parts["members"], dated)
    assert rows(sources.select("event_date", "merged_id", "source_pos", "article_url")) == [("2024-01-01", 1, 1, "u1"), ("2024-01-01", 1, 2, "u2"), ("2024-01-01", 3, 3, "u3"), ("2024-01-02", 1, 1, "u4")]
    nested = {(r.event_date, r.merged_id): r for r in merge.nest_merged(parts["events"], parts["actors"], sources).collect()}
    assert nested["2024-01-01", 1].actors == ["A", "B", "C", "D"] and nested["2024-01-01", 3].actors == ["E"]
    assert [s.article_url for s in nested["2024-01-01", 1].sources] == ["u1", "u2"]
    assert nested["2024-01-01", 1].details == storm


@pytest.mark.parametrize("options", [{}, {"small_bytes": 0, "hot_rows": 2}])
def test_resolve(spark, options):
    uses = ["Hill Rangers"] * 3 + ["Hill  rangers"] + ["Hill Rangars", "Hlil Rangers"] + ["user 12", "user 13"] + ["Ulla", "Ulle"] + ["", None]
    df = spark.createDataFrame([(u,) for u in uses], "value string")
    got = {r.variant: (r.canonical, r.uses) for r in resolve.resolve_aliases(df, "actor", **options).collect()}
    assert got == {
        "Hill Rangers": ("Hill Rangers", 3),
        "Hill  rangers": ("Hill Rangers", 1),
        "Hill Rangars": ("Hill Rangers", 1),
        "Hlil Rangers": ("Hill Rangers", 1),
        "user 12": ("user 12", 1),
        "user 13": ("user 13", 1),
        "Ulla": ("Ulla", 1),
        "Ulle": ("Ulle", 1),
    }


def test_names_one_letter_apart_stay_apart(spark):
    uses = ["Maria", "Marie", "Mario", "Marko"] * 2 + ["विमला"] * 5 + ["विमल"] + ["Katarina"] * 4 + ["KATARINA", "Katarinna", "Catarinna"]
    df = spark.createDataFrame([(u,) for u in uses], "value string")
    got = {r.variant: r.canonical for r in resolve.resolve_aliases(df, "actor").collect()}
    assert {v: c for v, c in got.items() if v != c} == {"KATARINA": "Katarina", "Katarinna": "Katarina"}


@pytest.mark.parametrize("options", [{}, {"small_bytes": 0, "hot_rows": 2, "salts": 3}])
def test_extract(spark, options):
    aliases = spark.createDataFrame([("actor", "Hill Rangers", "Ranger Corps", 0), ("actor", "Ulla", "Ulla", 1), ("location", "Ostwick", "Ostwick", 2)], "kind string, canonical string, variant string, rank long")
    text = "On 2024-05-06 at 14:30 the (Ranger Corps), Ulla and Ranger Corps met in Ostwick. Nothing here! Ulla left।  Ostwick is calm"
    articles = spark.createDataFrame([(7, "u", "T", "2024-06-01 (Saturday)", text)], "pos long, url string, title string, published_date string, content string")
    got = baseline.extract_events(articles, aliases, **options)
    assert rows(got.select("article_pos", "entity_pos", "actors", "location", "event_date", "event_time", "event")) == [
        (7, 0, ["Hill Rangers", "Ulla"], ["Ostwick"], "2024-05-06", "14:30", "On 2024-05-06 at 14:30 the (Ranger Corps), Ulla and Ranger Corps met in Ostwick"),
        (7, 2, ["Ulla"], [], "2024-06-01", None, "Ulla left"),
    ]
