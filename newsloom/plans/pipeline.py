"""The whole way from urls and pages to the graph, as compositions of operators.

Every step is lazy but for the places where work is costly to repeat: model responses, extracted events and merged
labels are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import CALENDAR, BSCalendar, published_label
from newsloom.functions.html import LAYOUT, PageLayout, extract_page
from newsloom.functions.text import rewrite_text
from newsloom.operators import baseline, entities, graph, grouping, inference, merge, resolve, rounds, star
from newsloom.session import materialize
from newsloom.sources.readers import attach_extracted

Model = Callable[[pd.Series], pd.Series]


def build_articles(
    urls: DataFrame, pages: DataFrame, reference_year: int, layout: PageLayout = LAYOUT, calendar: BSCalendar = CALENDAR
) -> DataFrame:
    """``pos, url, title, published_date, content`` of every url; dates read, and rewritten inside the text."""
    read = attach_extracted(urls, pages, layout)
    return read.select(
        "pos",
        "url",
        "title",
        published_label(F.col("published_raw"), calendar).alias("published_date"),
        rewrite_text(F.col("content"), reference_year, calendar).alias("content"),
    )


def model_entities(articles: DataFrame, model: Model, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Events by a model: (flat conforming entities, rejected entities, unparsed articles)."""
    answered = inference.infer(inference.extraction_prompts(articles), model, **options).drop("prompt")
    parsed = materialize(inference.parse_event_responses(answered), "parsed")
    rows = articles.select("pos", "url", "title", "published_date").join(parsed.select("pos", "entities"), "pos")
    good, rejected = inference.split_conforming(entities.unnest_entities(rows))
    return good, rejected, parsed.where(~F.col("parse_ok")).select("pos", "raw_response")


def baseline_entities(articles: DataFrame, aliases: DataFrame, **options) -> DataFrame:
    return materialize(baseline.extract_events(articles, aliases, **options), "entities")


def name_uses(flat: DataFrame, column: str) -> DataFrame:
    """One row per use of a name, as ``value``."""
    return flat.select(F.explode(column).alias("value"))


def resolved_dictionary(flat: DataFrame) -> DataFrame:
    """Dictionary table of the actors and locations of flat entities, without a model."""
    actors = resolve.resolve_aliases(name_uses(flat, "actors"), entities.ACTOR)
    places = resolve.resolve_aliases(name_uses(flat, "location"), entities.LOCATION)
    return actors.unionByName(places).drop("uses")


def dated_events(flat: DataFrame, aliases: DataFrame) -> DataFrame:
    """Canonical names, undated events dropped, numbered per date."""
    return grouping.number_events(entities.canonicalize(flat, aliases))


def merged_parts(dated: DataFrame, model: Model | None = None, **options) -> dict[str, DataFrame]:
    """Merged events as flat tables ``events, members, actors, sources``, by a model or by similarity."""
    if model is None:
        parts = merge.merge_events(dated, **options)
    else:
        parts = rounds.merge_rounds(grouping.merge_input(dated), model, **options)
    return {**parts, "sources": merge.merged_sources(parts["members"], dated)}


def events_to_graph(parts: dict[str, DataFrame], aliases: DataFrame, date_from: str) -> tuple[dict, DataFrame, DataFrame]:
    """(star tables, nodes, edges). The tables are written before they are joined."""
    tables = {name: materialize(table, name) for name, table in star.build_star(parts, aliases).items()}
    return tables, graph.graph_nodes(tables, date_from), graph.graph_edges(tables, date_from)


def run(
    urls: DataFrame,
    pages: DataFrame,
    aliases: DataFrame,
    reference_year: int,
    date_from: str,
    layout: PageLayout = LAYOUT,
    extract_model: Model | None = None,
    merge_model: Model | None = None,
) -> dict[str, DataFrame]:
    """Pages to graph in one program. Without models the deterministic stand-ins do their work."""
    articles = materialize(build_articles(urls, pages, reference_year, layout), "articles")
    out = {"articles": articles}
    if extract_model is None:
        flat = baseline_entities(articles, aliases)
    else:
        flat, out["rejected_entities"], out["unparsed"] = model_entities(articles, extract_model)
        flat = materialize(flat, "entities")
    out["entities"] = flat
    dated = materialize(dated_events(flat, aliases), "dated")
    out["dated_events"] = dated
    parts = merged_parts(dated, merge_model)
    tables, out["nodes"], out["edges"] = events_to_graph(parts, aliases, date_from)
    out.update({f"merged_{name}": part for name, part in parts.items()})
    out.update(tables)
    return out
