import json

import pandas as pd

from newsloom.functions.html import PageLayout
from newsloom.operators import graph
from newsloom.plans import pipeline

from .conftest import rows

L = PageLayout()
PAGE = (
    f'<html><{L.title_tag} class="{L.title_class}">{{title}}</{L.title_tag}>'
    f'<{L.date_tag} class="{L.date_class}"><{L.date_inner_tag}>{{date}}</{L.date_inner_tag}></{L.date_tag}>'
    f'<{L.content_tag} class="{L.content_class}"><p>{{first}}</p><p>{{second}}</p></{L.content_tag}></html>'
)
STORM = "The ferry guild closed three piers near the lighthouse of Ostwick after the heavy storm on २०८२ साउन १० गते"
ALIASES = [("actor", "Ferry Union", "ferry guild", 0), ("actor", "Ferry Union", "ferrymen", 0), ("actor", "Ulla", "Ulla", 1), ("location", "Ostwick Bay", "Ostwick", 2)]


def inputs(spark):
    pages = [
        ("u1", PAGE.format(title="T1", date="२०८२ साउन १२ गते १२:३०", first=STORM, second="Ulla came home at 7:15")),
        ("u2", PAGE.format(title="T2", date="2025-07-29", first=STORM + " too", second="nobody")),
        ("u9", PAGE.format(title="T9", date="2025-07-29", first="Ulla is not on the list", second="")),
    ]
    return (
        spark.createDataFrame([("u1", 0), ("u2", 1), ("gone", 2)], "url string, pos long"),
        spark.createDataFrame(pages, "url string, html string"),
        spark.createDataFrame(ALIASES, "kind string, canonical string, variant string, rank long"),
    )


def test_pages_to_graph(spark):
    urls, pages, aliases = inputs(spark)
    out = pipeline.run(urls, pages, aliases, reference_year=2082, date_from="2025-01-01")
    assert rows(out["articles"].select("pos", "title", "published_date")) == [(0, "T1", "2025-07-28 (Monday)"), (1, "T2", "2025-07-29 (Tuesday)"), (2, "", "")]
    dated = out["dated_events"].select("event_date", "id", "article_url", "actors", "event_time")
    assert rows(dated) == [
        ("2025-07-26", "1", "u1", ["Ferry Union"], None),
        ("2025-07-26", "2", "u2", ["Ferry Union"], None),
        ("2025-07-28", "1", "u1", ["Ulla"], "7:15"),
    ]
    assert rows(out["merged_members"].select("event_date", "merged_id", "id")) == [("2025-07-26", 1, "1"), ("2025-07-26", 1, "2"), ("2025-07-28", 1, "1")]
    counts = dict(rows(graph.graph_counts(out["nodes"], out["edges"])))
    assert counts == {"actor": 2, "event": 2, "source": 2, "nodes": 6, "edges": 5}


def test_with_models(spark):
    urls, pages, aliases = inputs(spark)

    def extract(prompts: pd.Series) -> pd.Series:
        event = {"event": "Storm", "actors": ["ferrymen"], "event_date": "2025-07-26", "location": ["Ostwick"], "details": "d"}
        return prompts.map(lambda p: json.dumps([event, {"event": "bad"}]) if "storm" in p else "nothing")

    def merge(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: json.dumps([{"event": "One storm", "details": "d", "actors": ["Ferry Union"], "source_event_indices": [1, 2, 7]}]))

    out = pipeline.run(urls, pages, aliases, 2082, "2025-01-01", extract_model=extract, merge_model=merge)
    assert out["rejected_entities"].count() == 2
    assert rows(out["unparsed"]) == [(2, "nothing")]
    assert rows(out["merged_sources"].select("merged_id", "article_url")) == [(1, "u1"), (1, "u2")]
    assert out["merged_rejects"].count() == 0
    assert dict(rows(graph.graph_counts(out["nodes"], out["edges"])))["edges"] == 3


def test_dictionary_from_uses(spark):
    flat = spark.createDataFrame([(["Ferry Union", "Fery Union", "Ferry Union"], ["Ostwick"])], "actors array<string>, location array<string>")
    got = pipeline.resolved_dictionary(flat)
    assert rows(got) == [("actor", "Ferry Union", "Ferry Union", 0), ("actor", "Ferry Union", "Fery Union", 0), ("location", "Ostwick", "Ostwick", 0)]
