import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import entities, grouping

from .conftest import rows

ENTITY = schemas.ENTITY.simpleString()
# Three variants each, and a canonical name that is none of them.
COUNCIL = {"Harbour Council": ["harbour board", "H.C.", "council of the harbour"]}
LINDEBY = {"Lindeby": ["old Lindeby", "Lindeby (north)", "लिन्डेबी"]}


def entity(event, actors, date, location, details="d"):
    return (event, actors, date, None, location, details)


@pytest.fixture
def articles(spark):
    data = [
        (0, "u1", "t1", "2024-01-01", "c", [entity("E1", ["harbour board", "B", "B"], "2024-01-02", ["लिन्डेबी"]), entity("E2", ["B", "C", ""], "", ["Y"])]),
        (1, "u2", "t2", "2024-01-02", "c", [entity("E3", [None, "H.C."], "2024-01-01", None), entity("E4", [], "2024-01-02", ["X"])]),
        (2, "u3", "t3", "2024-01-03", "c", []),
        (3, "u4", "t4", "2024-01-03", "c", None),
    ]
    return spark.createDataFrame(data, f"pos long, url string, title string, published_date string, content string, entities array<{ENTITY}>")


@pytest.fixture
def aliases(spark):
    data = [("actor", c, v, 5) for c, vs in COUNCIL.items() for v in vs] + [("location", c, v, 5) for c, vs in LINDEBY.items() for v in vs]
    data += [("actor", "Later", "harbour board", 9), ("location", "L", "B", 0)]
    return spark.createDataFrame(data, schemas.ALIASES.simpleString().removeprefix("struct<").removesuffix(">"))


def test_unnest(articles):
    got = entities.unnest_entities(articles).select("article_pos", "entity_pos", "article_url", "title", "published_date", "event")
    assert rows(got) == [(0, 0, "u1", "t1", "2024-01-01", "E1"), (0, 1, "u1", "t1", "2024-01-01", "E2"), (1, 0, "u2", "t2", "2024-01-02", "E3"), (1, 1, "u2", "t2", "2024-01-02", "E4")]


def test_entity_fields_win(spark):
    df = spark.createDataFrame([(0, "u", "outer", [("inner",)])], "pos long, url string, title string, entities array<struct<title:string>>")
    assert entities.unnest_entities(df).first().title == "inner"


def test_unique_values(articles):
    assert [r.value for r in entities.sorted_values(entities.unique_values(articles, "actors")).collect()] == ["B", "C", "H.C.", "harbour board"]
    assert rows(entities.unique_values(articles, "event")) == [("E1",), ("E2",), ("E3",), ("E4",)]


@pytest.mark.parametrize("options", [{}, {"small_bytes": 0, "hot_rows": 1, "salts": 3}])
def test_canonicalize(articles, aliases, options):
    flat = entities.unnest_entities(articles)
    got = entities.canonicalize(flat, aliases, **options)
    assert got.columns == flat.columns
    expected = [
        (0, 0, ["Harbour Council", "B", "B"], ["Lindeby"]),
        (0, 1, ["B", "C", ""], ["Y"]),
        (1, 0, ["Harbour Council"], None),
        (1, 1, [], ["X"]),
    ]
    assert rows(got.select("article_pos", "entity_pos", "actors", "location")) == expected
    long = {**COUNCIL, **{f"n{i}": [f"n{i} one", f"n{i} two"] for i in range(300)}}
    for actors in (COUNCIL, long):
        small = entities.canonicalize_with(flat, actors, LINDEBY)
        assert small.columns == flat.columns
        assert rows(small.select("article_pos", "entity_pos", "actors", "location")) == expected


def test_canonical_nested(articles, aliases):
    got = entities.with_canonical_entities(articles, aliases)
    assert got.columns == articles.columns
    by_pos = {r.pos: r.entities for r in got.collect()}
    assert [e.actors for e in by_pos[0]] == [["Harbour Council", "B", "B"], ["B", "C", ""]]
    assert by_pos[2] == [] and by_pos[3] is None


def test_canonicalize_is_idempotent(articles, aliases):
    once = entities.canonicalize(entities.unnest_entities(articles), aliases)
    assert rows(entities.canonicalize(once, aliases)) == rows(once)


def test_values_and_small_dictionary(spark, aliases):
    names = spark.createDataFrame([("council of the harbour",), ("Unlisted",)], "value string")
    assert rows(entities.canonicalize_values(names, aliases, "actor")) == [("Unlisted", "Unlisted"), ("council of the harbour", "Harbour Council")]
    assert names.select(entities.canonical_column(F.col("value"), {})).first()[0] == "council of the harbour"
    with pytest.raises(TypeError):
        entities.canonical_column(F.col("value"), {"a": "abc"})
    with pytest.raises(ValueError):
        entities.canonical_column(F.col("value"), {"a": [str(i) for i in range(1000)]})


def test_dated_events(articles):
    dated = grouping.number_events(entities.unnest_entities(articles), chunk_bits=0)
    assert rows(dated.select("event_date", "id", "event")) == [("2024-01-01", "1", "E3"), ("2024-01-02", "1", "E1"), ("2024-01-02", "2", "E4")]
    assert [r.event for r in grouping.sort_by_date(dated).collect()] == ["E3", "E1", "E4"]
    lists = {(r.event_date, r.chunk): [e.event for e in r.events] for r in grouping.group_events_by_date(dated).collect()}
    assert lists == {("2024-01-01", 0): ["E3"], ("2024-01-02", 0): ["E1", "E4"]}
    cut = {(r.event_date, r.chunk): [e.id for e in r.events] for r in grouping.group_events_by_date(dated, size=1).collect()}
    assert cut == {("2024-01-01", 0): ["1"], ("2024-01-02", 0): ["1"], ("2024-01-02", 1): ["2"]}
    assert grouping.merge_input(dated).columns == ["event_date", "id", "event", "details", "actors"]
    assert grouping.narrow_events(dated).columns == ["event_date", "event", "details", "actors", "location", "article_url", "title", "published_date"]
