import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import entities, inference

from .conftest import rows

GOOD = {"event": "E", "actors": ["A", ["B", 3], 4], "event_date": "2024-01-02", "event_time": None, "location": "X", "details": "D"}


def parsed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, response string")
    return {r.pos: r for r in inference.parse_event_responses(df).collect()}


def test_parse(spark):
    got = parsed(spark, [json.dumps([GOOD, GOOD]), " \n" + json.dumps(GOOD), "Sorry.", "[1", None, "[]", '["junk", 5]', json.dumps([{"event": "F", "event_date": "soon", "actors": None}])])
    entity = got[0].entities[0]
    assert (entity.event, entity.actors, entity.location, entity.event_time, entity.missing_fields, entity.bad_date) == ("E", ["A", "B"], ["X"], None, [], False)
    assert [len(got[i].entities) for i in range(8)] == [2, 1, 0, 0, 0, 0, 0, 1]
    assert [got[i].parse_ok for i in range(8)] == [True, True, False, False, True, True, True, True]
    assert [got[i].raw_response for i in range(8)] == [None, None, "Sorry.", "[1", None, None, None, None]
    assert got[7].entities[0].missing_fields == ["actors", "details", "location"] and got[7].entities[0].bad_date


def test_split(spark):
    df = spark.createDataFrame([(0, json.dumps([GOOD, {**GOOD, "event_date": "2024-02-31"}]))], "pos long, response string")
    good, bad = inference.split_conforming(entities.unnest_entities(inference.parse_event_responses(df).select("pos", "entities")))
    assert good.count() == 1 and bad.first().event_date == "2024-02-31"


def test_infer_keeps_rows_of_failed_calls(spark):
    def model(prompts: pd.Series) -> pd.Series:
        if prompts.str.contains("bad").any():
            raise RuntimeError("refused")
        return prompts.str.upper()

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "pos long, prompt string").coalesce(1)
    expected = [(1, "a", "A", None), (2, "bad", None, "RuntimeError: refused"), (3, "c", "C", None)]
    assert rows(inference.infer(df, model)) == expected
    assert inference.infer(df, model, calls_in_flight=3, store=False).rdd.getNumPartitions() == 3


def test_many_failures_cost_little_more_than_a_call_each(spark, tmp_path):
    calls = tmp_path / "calls"

    def model(prompts):
        with calls.open("a") as file:
            file.write("x")
        if prompts.str.contains("6").any():
            raise RuntimeError("refused")
        return prompts.str.upper().tolist()

    data = [(i, f"p{i * 7919 % 100_000}") for i in range(2_000)] + [(None, None)]
    df = spark.createDataFrame(data, "pos long, prompt string").coalesce(1)
    expected = [(i, None if p is None or "6" in p else p.upper(), "RuntimeError: refused" if p and "6" in p else None) for i, p in data]
    assert rows(inference.infer(df, model).drop("prompt")) == sorted(expected, key=repr)
    # Halves alone, over the 813 prompts that fail, are 3,211 calls.
    assert len(calls.read_text()) < 2_100


def test_prompts(spark):
    articles = spark.createDataFrame([(1, "t", "d", "body"), (2, "t", "d", None)], "pos long, title string, published_date string, content string")
    assert rows(inference.extraction_prompts(articles, "Do.")) == [(1, "Do.\n\nbody"), (2, "Do.\n\n")]
    names = spark.createDataFrame([("b",), ("a",), ("c",)], "value string")
    assert rows(inference.alias_prompts(names, "Do.")) == [(0, "Do.\na\nb\nc")]
    # Units of up to half a prompt share one; names that are no neighbours are units of one.
    assert rows(inference.alias_prompts(names.union(names.selectExpr("value || 'x'")), "Do.", size=4).select("prompt")) == [
        ("Do.\na\nax",), ("Do.\nb\nbx",), ("Do.\nc\ncx",)
    ]
    events = spark.createDataFrame([("2024-01-01", "2", "E2", None, ["A"]), ("2024-01-01", "1", "E1", "d", [])], "event_date string, id string, event string, details string, actors array<string>")
    prompt = inference.merge_prompts(events, "Do.").first().prompt
    body = json.loads(prompt.removeprefix("Do.\n\n"))
    assert [e["id"] for e in body["Events"]] == ["1", "2"] and body["Events"][1]["details"] is None


def test_dictionary(spark):
    text = json.dumps({"Zeta": ["z", "Zeta"], "Alpha": ["z", "a"], "Flat": "string"}, ensure_ascii=False)
    df = spark.createDataFrame([(text,), ("no json",), ('["list"]',)], "response string")
    got = inference.dictionary_rows(df, "actor")
    assert rows(got) == [("actor", "Alpha", "a", 1), ("actor", "Alpha", "z", 1), ("actor", "Zeta", "Zeta", 0), ("actor", "Zeta", "z", 0)]
    assert rows(entities.first_matches(got)) == [("actor", "Zeta", "Zeta"), ("actor", "a", "Alpha"), ("actor", "z", "Zeta")]
    empty = got.limit(0)
    assert rows(entities.first_matches(inference.latest_dictionary(empty, got))) == rows(entities.first_matches(got))


def test_merge_responses(spark):
    item = {"event": "M", "details": "D", "actors": ["A"], "source_event_indices": [2, 1]}
    data = [("2024-01-01", 0, json.dumps([item, item])), ("2024-01-01", 1, json.dumps([item])), ("2024-01-02", 0, None), ("2024-01-03", 0, "text")]
    good, bad = inference.parse_merge_responses(spark.createDataFrame(data, "event_date string, chunk long, response string"))
    assert rows(good.select("event_date", "merged_id", "members")) == [("2024-01-01", i, ["2", "1"]) for i in (1, 2, 3)]
    assert rows(bad.select("event_date")) == [("2024-01-02",), ("2024-01-03",)]
    parts = inference.merge_parts(good)
    assert parts["members"].count() == 6 and parts["actors"].count() == 3


def test_infer_goes_on_where_it_broke_off(spark, tmp_path):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(40)], "pos long, prompt string")
    asked, broken = tmp_path / "asked", tmp_path / "broken"
    asked.mkdir(), broken.mkdir()

    def model(prompts):
        import uuid

        if len(list(asked.iterdir())) >= 10 and not (broken / "once").exists():
            (broken / "once").write_text("")
            raise SystemExit("worker lost")
        for prompt in prompts:
            (asked / f"{prompt}-{uuid.uuid4().hex}").write_text("")
        return prompts.str.upper()

    work = str(tmp_path / "work")
    with pytest.raises(Exception):  # noqa: B017
        inference.infer(df, model, work=work, buckets=8, calls_in_flight=1)
    before = len(list(asked.iterdir()))
    assert rows(inference.infer(df, model, work=work, buckets=8, calls_in_flight=1).select("pos", "response")) == rows(
        df.selectExpr("pos", "upper(prompt)")
    )
    assert 10 <= before < 40 and len(list(asked.iterdir())) == 40


def test_wrong_number_of_responses(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "pos long, prompt string").coalesce(1)
    got = inference.infer(df, lambda prompts: prompts.iloc[:0])
    assert rows(got.select("pos", "response", "error")) == [(i, None, "ValueError: 0 responses to 1 prompts") for i in (1, 2)]


def test_repeated_keys_and_odd_items(spark):
    df = spark.createDataFrame([('{"A": ["x"], "A": ["y"], "B": ["z"]}',), ("no json",), ("[1]",), (None,)], "response string")
    assert rows(inference.dictionary_rows(df, "actor").drop("kind")) == [("A", "y", 0), ("B", "z", 1)]
    assert rows(inference.dictionary_rejects(df)) == [("[1]",), ("no json",)]
    event = spark.createDataFrame([(0, '[{"event": "a", "event": "b"}]')], "pos long, response string")
    parsed = inference.parse_event_responses(event).first()
    assert parsed.parse_ok and parsed.entities[0].event == "b"
    data = [("2024-01-01", 0, '[null, 7, {"event": "M", "actors": "Ana", "source_event_indices": 3}]')]
    good, bad = inference.parse_merge_responses(spark.createDataFrame(data, "event_date string, chunk long, response string"))
    assert rows(good.select("event", "actors", "members")) == [("M", ["Ana"], ["3"])]
    assert rows(bad.select("response")) == [("7",), ("null",)]


def test_odd_items_are_rejects(spark):
    texts = ['[{"event": "a"}, "junk", null, 7]', "no json", None, '{"event": "b"}', "[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "pos long, response string")
    assert rows(inference.odd_items(df)) == [(0, 1, '"junk"'), (0, 2, "null"), (0, 3, "7")]
    parsed = {r.pos: (len(r.entities), r.parse_ok) for r in inference.parse_event_responses(df).collect()}
    assert parsed == {0: (1, True), 1: (0, False), 2: (0, True), 3: (1, True), 4: (0, True)}
