import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.operators import similar, tokens
from tests.test_baselines import components_of


def plain_runs(text, width):
    words = text.split()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


@pytest.mark.parametrize("width", [1, 3])
def test_word_runs_equal_plain_ones(width, monkeypatch):
    """Chunks of few bytes, so that texts lie side by side in a chunk, alone in one, and across none."""
    monkeypatch.setattr(tokens.WordRuns, "CHUNK", 64)
    rng = random.Random(width)
    texts = [bytes(rng.choice(b"ab\xc3 \t\n\v\f\r") for _ in range(rng.choice([0, 1, 2, 9, 40, 300]))) for _ in range(600)]
    found = tokens.WordRuns(width).sets(pa.array([b"left out", None, *texts], pa.binary()).slice(1)).to_pylist()
    assert found[0] is None
    number_of = {}
    for text, packed in zip(texts, found[1:]):
        numbers = memoryview(packed).cast("q").tolist()
        assert numbers == sorted(set(numbers)) and len(numbers) == len(plain_runs(text, width))
        if len(numbers) == 1:
            assert number_of.setdefault(plain_runs(text, width).pop(), numbers[0]) == numbers[0]
    assert len(set(number_of.values())) == len(number_of) > 10
    for (a, x), (b, y) in zip(zip(texts, found[1:]), zip(texts[1:], found[2:])):
        both = set(memoryview(x).cast("q")) & set(memoryview(y).cast("q"))
        assert len(both) == len(plain_runs(a, width) & plain_runs(b, width))


def test_shingles_of_odd_texts(spark):
    data = [(1, "Ä b\tc"), (2, " ä  B c "), (3, "ä b c"), (4, ""), (5, None), (6, " \n"), (7, "ä b"), (8, "ä b c d")]
    df = spark.createDataFrame(data, "n long, text string").select("n", similar.shingles(F.col("text")).alias("t"))
    got = {r.n: r.t for r in df.collect()}
    assert got[1] == got[2] and len(got[1]) == 8 and len({got[1], bytes(got[3]), bytes(got[7])}) == 3
    assert got[4] == got[6] == b"" and got[5] is None and len(got[8]) == 16 and bytes(got[1]) in (bytes(got[8])[:8], bytes(got[8])[8:])


def test_sets_of_one_bucket_meet_in_few_rounds(spark, monkeypatch):
    """250 sets share two tokens and are like none but for one chain; rounds of 32 members took eight."""
    stored = []
    write = similar.materialize
    monkeypatch.setattr(similar, "materialize", lambda df, label="stage": (stored.append(label), write(df, label))[1])
    sets = [{"hot", "warm", f"a{k}", f"b{k}"} for k in range(250)]
    sets += [{"hot", "warm", f"x{k}", f"x{k + 1}"} for k in range(20)]
    found, true = components_of(spark, {"d": sets})
    assert found == true
    assert stored.count("heads") <= 5


def test_tokens_known_to_be_hot_are_not_dealt_to_one_part(spark):
    sets = [(i, 7, b"".join(t.to_bytes(8, "little") for t in sorted([5, 1_000 + i, 2_000 + i // 2]))) for i in range(40)]
    df = spark.createDataFrame(sets, "doc long, g long, set binary").repartition(20, "doc")
    dealt = df.mapInArrow(tokens.deal(4, [(7, 5)]), tokens.DEALT)
    own = dealt.where("bucket >= 4").collect()
    assert sum(len(r.docs) // 8 for r in own) == 40 and len({r.bucket for r in own}) > 1
    plain = df.mapInArrow(tokens.deal(4, []), tokens.DEALT)
    assert plain.where("bucket >= 4").count() == 0
    for rows in (dealt, plain):
        lists = rows.coalesce(1).sortWithinPartitions("bucket").mapInArrow(tokens.count(4, 3), tokens.COUNTED)
        lists = lists.coalesce(1).sortWithinPartitions("block").mapInArrow(tokens.listed(0.5), tokens.LISTED)
        got = {r.doc: (r.n, r.need, len(r.shared)) for r in lists.collect()}
        # The hot token and the one of each pair of sets; the hot token comes last.
        assert got == {i: (3, 1, 2) for i in range(40)}
        assert len({r.shared[-1] for r in lists.collect()}) == 1
