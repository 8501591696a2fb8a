import datetime
import random

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import graph, star

from .conftest import rows

DAY = datetime.date
JOIN_ROW = "actor_key int, actor_label string, event_key int, event_label string, event_details string, source_key int, source_title string, source_url string, published_date date"


def test_one_row_graph(spark):
    df = spark.createDataFrame([(1, "Actor A", 2, "Event B", "Some details", 3, "Source X", "http://example.com", DAY(2025, 7, 31))] * 2, JOIN_ROW)
    nodes, edges = graph.build_nodes(df), graph.build_edges(df)
    assert rows(nodes) == [
        ("actor_1", "actor", "Actor A", None, None, None),
        ("event_2", "event", "Event B", "Some details", None, None),
        ("source_3", "source", "Source X", None, "http://example.com", "2025-07-31"),
    ]
    assert rows(edges) == [("actor_1", "event_2"), ("event_2", "source_3")]
    assert graph.has_edge(edges, "actor_1", "event_2") and not graph.has_edge(edges, "actor_1", "source_3")
    assert rows(graph.graph_counts(nodes, edges)) == [("actor", 1), ("edges", 2), ("event", 1), ("nodes", 3), ("source", 1)]


def random_star(spark, seed):
    random.seed(seed)
    link = lambda n: [(random.choice([0, 0, 0, *range(1, 12)]), random.choice([0, 0, *range(1, 9)])) for _ in range(n)]
    return {
        "actors": spark.createDataFrame([(i, f"a{i}") for i in range(7)], "actor_key int, label string"),
        "sources": spark.createDataFrame([(i, f"s{i}", f"u{i}", DAY(2025, 1, 1 + i)) for i in range(7)], "source_key int, title string, url string, published_date date"),
        "events": spark.createDataFrame([(i, f"e{i}", f"d{i}") for i in range(10)], "event_key int, label string, details string"),
        "event_actors": spark.createDataFrame(link(30), "event_key int, actor_key int"),
        "event_sources": spark.createDataFrame(link(20), "event_key int, source_key int"),
    }


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"small_bytes": 0, "hot_rows": 3, "salts": 4})])
def test_pruned_graph_equals_product_join(spark, seed, options):
    tables = random_star(spark, seed)
    joined = graph.star_join(tables, "2025-01-04", **options)
    plain = (
        tables["sources"].alias("s").where("published_date >= '2025-01-04'")
        .join(tables["event_sources"], "source_key").join(tables["events"].alias("e"), "event_key")
        .join(tables["event_actors"], "event_key").join(tables["actors"].alias("a"), "actor_key")
    )
    assert rows(joined.select("actor_key", "event_key", "source_key")) == rows(plain.select("actor_key", "event_key", "source_key"))
    assert rows(graph.graph_nodes(tables, "2025-01-04", **options)) == rows(graph.build_nodes(joined))
    assert rows(graph.graph_edges(tables, "2025-01-04", **options)) == rows(graph.build_edges(joined))


def test_hot_events_are_not_counted(spark):
    """A count of the links of each event shuffles both link tables; only actors and sources are counted, where they are large."""
    tables = random_star(spark, 3)
    for frame in (graph.graph_nodes, graph.graph_edges):
        text = frame(tables, "2025-01-04", small_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
        counted = [line for line in text.splitlines() if "Aggregate [event_key" in line and "count(1)" in line]
        assert "count(1)" in text and not counted


def test_stored_links_give_the_same_graph(spark):
    tables = random_star(spark, 4)
    links = graph.stored_links(tables, "2025-01-04")
    for frame in (graph.graph_nodes, graph.graph_edges):
        given = frame(tables, "2025-01-04", links)
        assert rows(given) == rows(frame(tables, "2025-01-04"))
        # Every link is read as stored and never joined with the date range again.
        assert "published_date >=" not in given._jdf.queryExecution().optimizedPlan().toString()


def parts_and_aliases(spark, merged):
    events = spark.createDataFrame([(d, m, e, "x") for d, m, e, _, _ in merged], "event_date string, merged_id long, event string, details string")
    actors = spark.createDataFrame([(d, m, i, a) for d, m, _, names, _ in merged for i, a in enumerate(names)], "event_date string, merged_id long, actor_pos int, actor string")
    sources = spark.createDataFrame(
        [(d, m, i, *s) for d, m, _, _, found in merged for i, s in enumerate(found)],
        "event_date string, merged_id long, source_pos int, title string, article_url string, published_date string",
    )
    return {"events": events, "actors": actors, "sources": sources}


def test_star_from_merged_events(spark):
    merged = [
        ("2025-07-02", 1, "late", ["New", "Known"], [("T2", "u1", "2025-07-29 (Tuesday)")]),
        ("2025-07-01", 2, "first", ["Known", "Known"], [("T1", "u1", "2025-07-28 (Monday)"), ("T2", "u1", "2025-07-28 (Monday)"), ("No date", "u2", "")]),
        ("2025-07-01", 3, "no source", ["Known"], []),
    ]
    aliases = spark.createDataFrame([("actor", "Known", "Known", 0), ("actor", "Known", "K.", 0), ("actor", "Unused", "U", 1), ("location", "L", "l", 0)], "kind string, canonical string, variant string, rank long")
    tables = star.build_star(parts_and_aliases(spark, merged), aliases)
    assert rows(tables["actors"].select("label")) == [("Known",), ("New",), ("Unused",)]
    assert rows(tables["actor_aliases"].select("alias")) == [("K.",), ("U",)]
    assert rows(tables["sources"].select("url", "title", "published_date")) == [("u1", "T1", DAY(2025, 7, 28))]
    assert rows(tables["rejected_sources"].select("url")) == [("u2",)]
    assert (tables["event_actors"].count(), tables["event_sources"].count()) == (5, 4)
    for name, schema in schemas.STAR.items():
        assert tables[name].dtypes == [(f.name, f.dataType.simpleString()) for f in schema]
    nodes, edges = graph.graph_nodes(tables, "2025-01-01"), graph.graph_edges(tables, "2025-01-01")
    assert rows(graph.graph_counts(nodes, edges)) == [("actor", 2), ("edges", 5), ("event", 2), ("nodes", 5), ("source", 1)]
    assert graph.graph_nodes(tables, "2025-08-01").count() == 0


def test_golden_counts(spark):
    """The size of the known sample: 10 merged events, 70 actor links to 53 actors, 38 links to 13 sources; one actor
    is spelt otherwise in the dictionary of 60 and so comes as the 61st."""
    names = [f"actor {i}" for i in range(53)]
    order = names + names[:17]
    merged = []
    for e in range(10):
        actors = order[e * 7 : e * 7 + 7]
        found = [(f"T{s}", f"u{s}", "2025-07-28 (Monday)") for s in sorted({(e * 4 + k) % 13 for k in range(4 if e < 8 else 3)})]
        merged.append((f"2025-07-{20 + e % 7}", e + 1, f"event {e}", actors, found))
    known = names[:52] + [f"other {i}" for i in range(8)]
    aliases = spark.createDataFrame([("actor", n, n, i) for i, n in enumerate(known)] + [("actor", known[i], f"alias {i}", i) for i in range(20)], "kind string, canonical string, variant string, rank long")
    tables = star.build_star(parts_and_aliases(spark, merged), aliases)
    assert {name: t.count() for name, t in tables.items()} == {"actors": 61, "actor_aliases": 20, "sources": 13, "rejected_sources": 0, "events": 10, "event_actors": 70, "event_sources": 38}
    got = dict(rows(graph.graph_counts(graph.graph_nodes(tables, "2025-01-01"), graph.graph_edges(tables, "2025-01-01"))))
    assert got == {"actor": 53, "event": 10, "source": 13, "nodes": 76, "edges": 108}


def test_keys_and_previews(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    assert df.select(star.stable_key("x", "y").alias("k")).distinct().count() == 3
    assert star.preview(spark.range(10)).count() == 3
    assert rows(star.dense_ids(spark.createDataFrame([("b",), ("a",)], "x string"), ["x"])) == [("a", 1), ("b", 2)]
