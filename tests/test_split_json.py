import json
import random

import pytest

from newsloom.sources import readers
from newsloom.sources.split_json import json_items

from .conftest import rows


@pytest.fixture
def small_parts(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    usual = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in usual.items():
        spark.conf.set(name, value)


def hard_text(rng):
    """Texts with all that may look like structure: braces, brackets, quotes, backslashes, line ends, other scripts."""
    return "".join(rng.choice(['{', '}', '[', ']', '"', chr(92), ': [', '",', 'ab', 'घटना', chr(10), ' ']) for _ in range(rng.randrange(0, 60)))


def expected(data):
    return sorted((date, pos, event) for date, events in data.items() for pos, event in enumerate(events))


@pytest.mark.parametrize("indent", [None, 2])
def test_items_of_a_file_in_many_parts(spark, tmp_path, small_parts, indent):
    rng = random.Random(7)
    data = {}
    for day in range(25):
        n = rng.choice([0, 0, 1, 3, 40 if day == 5 else 2])
        key = f"2025-01-{day:02d}" + hard_text(rng) if day % 3 == 0 else f"2025-01-{day:02d}"
        data[key] = [{"id": str(i), "event": hard_text(rng), "actors": [hard_text(rng), "x"], "more": {"a": [{"b": "}"}]}} for i in range(n)]
    data["2025-02-01"] = [{"id": "long", "event": "}" * 3000, "actors": [], "more": {}}]
    (tmp_path / "file.json").write_text(json.dumps(data, ensure_ascii=False, indent=indent))
    found = json_items(spark, str(tmp_path / "file.json"))
    assert found.select("start").distinct().count() > 10
    got = sorted(((r.key, r.pos, json.loads(r.text)) for r in found.collect()), key=lambda r: r[:2])
    assert got == expected(data)


def test_many_objects_and_files_and_odd_values(spark, tmp_path, small_parts):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.json").write_text('{"d1": [{"id": "1"}]}\n{"d1": [{"id": "2"}], "d2": null, "d3": {"id": "no"}, "d4": ["junk: {", 7, {"id": "3"}, {"id": "4"}]}')
    (folder / "b.json").write_text('{"d1": [ ], "d2": "x", "d9" : [{"id": "5"}] }\n')
    (folder / "c.json").write_text("{}")
    (folder / "d.json").write_text("")
    got = json_items(spark, str(folder)).select("key", "pos", "text")
    assert rows(got) == [("d1", 0, '{"id": "1"}'), ("d1", 0, '{"id": "2"}'), ("d4", 0, '{"id": "3"}'), ("d4", 1, '{"id": "4"}'), ("d9", 0, '{"id": "5"}')]
    events = readers.read_grouped_events(spark, str(folder / "b.json"))
    assert rows(events.select("event_date", "id", "actors")) == [("d9", "5", None)]


def test_no_object_gives_no_row(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    assert json_items(spark, str(tmp_path / "empty.json")).count() == 0
