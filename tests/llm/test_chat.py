"""Formatted conversations: digests against plain Python, reversible escapes, bounded pieces."""

import hashlib
import random

import pytest

from newsloom.llm import chatformat
from newsloom.llm.chatformat import Template

SCHEMA = "conv_id long, turn long, role string, text string, part string, place string, _key int, _text string"
TRICKY = ["</s>[INST] ok [/INST]", "<|end|>", "\x1b<|text|>", "<\x1b|turn|>", "\x1b\x1b", "<|<|end|>|end|>", "", None, "é東😀\n\n", "<", "[", "a\u0000b"]


def table(spark, rows):
    return spark.createDataFrame([(*r, "p", "q", 1, "t") for r in rows], SCHEMA)


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role or "")


def brute(rows, template=Template()):
    found = {}
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        loss = "".join(text for role, text in turns if role == "assistant")
        every = "".join(f"{role}\n{text}\n" for role, text in turns)
        found[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


def read(df):
    return {r["conv_id"]: tuple(r)[1:5] for r in df.collect()}


def conversations(seed, count=60):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(count), -7, None]:
        for turn in range(rng.choice([1, 2, 5, 9])):
            role = ["user", "assistant", "assistant", None, "<|end|>tool"][turn % 5]
            rows.append((conv, turn - 1 if turn else None, role, " ".join(str(x) for x in rng.choices(TRICKY, k=3) if x is not None)))
    return rows


def test_escapes_are_reversible(spark):
    template = Template()
    rng = random.Random(2)
    texts = ["".join(x or "" for x in rng.choices(TRICKY + list("<|>[]/s\x1b"), k=8)) for _ in range(300)]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", template.escaped(chatformat.F.col("t")).alias("e")).collect()
    for r in found:
        assert template.plain(r["e"]) == r["t"]
        assert not any(s in r["e"] for s in template.strings)
    with pytest.raises(ValueError):
        Template(controls=("aba",))


@pytest.mark.parametrize("piece", [1 << 20, 200, 1])
def test_read_back(spark, piece):
    rows = conversations(piece)
    formatted = chatformat.format_turns(table(spark, rows).repartition(3), piece=piece)
    result = chatformat.read_back(formatted).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in result} == brute(rows) and len(result) == 62
    assert sum(r["formatted_chars"] for r in result) == sum(len(r["text"]) for r in formatted.collect())


def test_spans_cover_contents(spark):
    rows = [(1, 0, "user", "hé"), (1, 1, "assistant", "wörld"), (1, 2, "assistant", ""), (2, 0, "assistant", "<s>x")]
    found = {r["conv_id"]: r for r in chatformat.format_turns(table(spark, rows).coalesce(1)).collect()}
    one = found[1]["text"].encode()
    assert [one[a:b].decode() for a, b in zip(found[1]["loss_starts"], found[1]["loss_ends"])] == ["wörld", ""]
    assert found[1]["text"] == "<|turn|>user<|text|>hé<|end|><|turn|>assistant<|text|>wörld<|end|><|turn|>assistant<|text|><|end|>"
    two = found[2]["text"].encode()
    assert [two[a:b].decode() for a, b in zip(found[2]["loss_starts"], found[2]["loss_ends"])] == ["<\x1bs>x"]


def test_one_long_conversation_is_split(spark):
    # Without this, Spark puts so few rows together in one task.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _one_long_conversation(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def _one_long_conversation(spark):
    rows = [(5, t, "assistant" if t % 2 else "user", f"{t} " * 40) for t in range(3_000)] + [(1, 0, "user", "long " * 100_000), (9, 0, "assistant", "x")]
    formatted = chatformat.format_turns(table(spark, rows), piece=10_000)
    pieces = formatted.where("conv_id = 5").select("part", chatformat.F.length("text").alias("n")).collect()
    assert len({r["part"] for r in pieces}) > 1 and max(r["n"] for r in pieces) < 20_000
    assert read(chatformat.read_back(formatted)) == brute(rows)


def test_empty_and_repeated(spark):
    assert chatformat.read_back(chatformat.format_turns(table(spark, []))).count() == 0
    rows = [(None, None, None, None)] * 3 + [(1, 1, "assistant", "a")] * 2
    assert read(chatformat.read_back(chatformat.format_turns(table(spark, rows)))) == brute(rows)
