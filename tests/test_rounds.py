"""Prompts along candidates, and rounds of a model over more rows than a prompt holds."""

import json
import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsloom.operators import inference, resolve, rounds
from newsloom.operators.keyed import chunk_units

from .conftest import rows

EVENTS = "event_date string, id string, event string, details string, actors array<string>"


def merges_equal(prompts: pd.Series) -> pd.Series:
    """A model that merges events of one title and keeps the rest."""

    def answer(prompt: str) -> str:
        found = {}
        for e in json.loads(prompt.split("\n\n", 1)[1])["Events"]:
            item = found.setdefault(e["event"], {"event": e["event"], "details": e["details"], "actors": [], "source_event_indices": []})
            item["actors"] = sorted({*item["actors"], *e["actors"]})
            item["source_event_indices"].append(int(e["id"]))
        return json.dumps(list(found.values()))

    return prompts.map(answer)


def merged(parts):
    events = {(r.event_date, r.merged_id): r.event for r in parts["events"].collect()}
    members, actors = defaultdict(set), defaultdict(set)
    for r in parts["members"].collect():
        assert r.id not in members[r.event_date, r.merged_id]
        members[r.event_date, r.merged_id].add(r.id)
    for r in parts["actors"].collect():
        actors[r.event_date, r.merged_id].add(r.actor)
    return sorted((date, events[date, n], sorted(members[date, n]), sorted(actors[date, n])) for date, n in events)


def many_events():
    rng = random.Random(4)
    data = []
    for i in range(1, 701):
        topic = rng.randrange(60)
        title = f"case {topic} alpha{topic} beta{topic}" if i not in (20, 620) else "far pair about one storm"
        # All are near copies of each other by their details, so the one component is larger than a prompt.
        data.append(("2024-01-01", str(i), title, "common words of all events here", [f"A{i % 5}"]))
    return data + [("2024-01-02", str(i), f"other {i % 3}", "d", []) for i in range(1, 8)]


def test_merge_does_not_depend_on_prompt_size(spark):
    events = spark.createDataFrame(many_events(), EVENTS)
    results = [merged(rounds.merge_rounds(events, merges_equal, size=size)) for size in (5_000, 50)]
    assert results[0] == results[1]
    assert ["20", "620"] in [members for _, event, members, _ in results[0] if event.startswith("far pair")]
    assert len(results[0]) == len({(e[0], e[2]) for e in many_events()}) and {m for _, _, ms, _ in results[0] for m in ms} == {str(i) for i in range(1, 701)}


def test_prompts_of_a_small_date_are_one(spark):
    events = spark.createDataFrame(many_events(), EVENTS)
    prompts = inference.merge_prompts(events, "Do.", size=100).collect()
    sizes = [(r.event_date, len(json.loads(r.prompt.removeprefix("Do.\n\n"))["Events"])) for r in prompts]
    assert [n for d, n in sizes if d == "2024-01-02"] == [7]
    assert sum(n for d, n in sizes if d == "2024-01-01") == 700 and max(n for _, n in sizes) <= 100


def test_unread_answers(spark):
    def refuses(prompts):
        return prompts.map(lambda p: "no" if '"2024' in p or "beta3" in p else merges_equal(pd.Series([p])).iloc[0])

    events = spark.createDataFrame(many_events(), EVENTS)
    parts = rounds.merge_rounds(events, refuses, size=5_000)
    assert [r.event_date for r in parts["rejects"].collect()] == ["2024-01-01"]
    assert {r.event_date for r in parts["events"].collect()} == {"2024-01-02"}


def unifies(prompts: pd.Series) -> pd.Series:
    """A model that takes names that are equal but for their first letter for one."""

    def answer(prompt: str) -> str:
        found = defaultdict(list)
        for name in prompt.split("\n")[1:]:
            found[name[1:]].append(name)
        return json.dumps({min(names): names for names in found.values()})

    return prompts.map(answer)


def test_spellings_of_many_names_meet(spark):
    rng = random.Random(9)
    names = ["".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(2_500)]
    names += ["z" + n[1:] for n in names[:1_000]] + ["Karmila", "Zarmila"]
    df = spark.createDataFrame([(n,) for n in names], "value string")
    prompts = [r.prompt.split("\n")[1:] for r in inference.alias_prompts(df, "Do.", size=100).collect()]
    assert max(map(len, prompts)) <= 100 and sorted(sum(prompts, [])) == sorted(set(names))
    assert any("Karmila" in p and "Zarmila" in p for p in prompts)
    whole, cut = (rows(rounds.unify_rounds(df, "actor", unifies, size=size)) for size in (100_000, 100))
    assert whole == cut and ("actor", "Karmila", "Zarmila", 0) in cut and len(cut) == len(set(names))


@pytest.mark.parametrize("size", [1, 4, 5, 1_000])
def test_chunks_keep_units_whole(spark, size):
    rng = random.Random(size)
    data, n = [], 0
    for g in ("a", "b", "c"):
        for unit in range(rng.randrange(2, 14)):
            for _ in range(rng.choice([1, 1, 2, 3, 5, 11])):
                data.append((g, unit, n := n + 1))
    df = spark.createDataFrame(data, "g string, u long, n long")
    found = chunk_units(df, ["g"], "u", ["n"], size).collect()
    assert sorted((r.g, r.u, r.n) for r in found) == sorted(data)
    chunks, places = defaultdict(list), defaultdict(set)
    for r in found:
        chunks[r.g, r.chunk].append(r.u)
        places[r.g, r.u].add(r.chunk)
    units = {(g, u): sum(1 for d in data if d[:2] == (g, u)) for g, u, _ in data}
    assert max(map(len, chunks.values())) <= size
    for key, rows_ in units.items():
        assert len(places[key]) == (1 if rows_ <= size else -(-rows_ // size))


def test_head_per_form(spark):
    uses = ["Karmila"] * 10 + ["Karmilo"] * 9 + ["Karmilox"] * 2 + ["Garmila"] * 3 + ["Garmilax"]
    df = spark.createDataFrame([(u,) for u in uses], "value string")
    got = {r.variant: r.canonical for r in resolve.resolve_aliases(df, "actor").collect()}
    # Garmilax is near Garmila only, which is a misspelling itself.
    assert {v: c for v, c in got.items() if v != c} == {"Karmilox": "Karmilo", "Garmila": "Karmila"}
    assert sorted(r.uses for r in resolve.resolve_aliases(df, "actor").collect()) == [1, 2, 3, 9, 10]
    empty = resolve.resolve_aliases(df.limit(0), "actor")
    assert empty.count() == 0 and empty.columns == ["kind", "canonical", "variant", "rank", "uses"]
    assert rows(resolve.spelling_neighbours(df.select(F.upper("value").alias("value")).distinct()).select("component").distinct()) == [("garmila",)]
