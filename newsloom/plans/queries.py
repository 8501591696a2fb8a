"""One query per operator over the driver tables, by name. The SQL twins are in `plans.oracles`."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import (
    dev_to_ascii,
    gregorian_date,
    month_number,
    parse_gregorian_date,
    parse_nepali_date,
    published_label,
)
from newsloom.functions.html import drop_noise, extract_page, extract_title
from newsloom.functions.text import rename_time_words, rename_weekdays, rewrite_text
from newsloom.operators import baseline, entities, graph, grouping, inference, merge, resolve, similar
from newsloom.operators import star as starry
from newsloom.operators.components import connected_components
from newsloom.operators.keyed import spread
from newsloom.plans import adapters as a
from newsloom.plans import pipeline
from newsloom.session import materialize, new_path
from newsloom.sources import readers, writers
from newsloom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def joined(names: Column | str) -> Column:
    return F.array_join(names, "|", "NULL")


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def flat(spark: SparkSession, sf: str) -> DataFrame:
    return entities.unnest_entities(a.articles(spark, sf))


def canonical(spark: SparkSession, sf: str) -> DataFrame:
    return entities.canonicalize(flat(spark, sf), a.user_aliases(spark, sf))


def dated(spark: SparkSession, sf: str) -> DataFrame:
    # A small chunk makes the numbering of the test data go through several chunks.
    return grouping.number_events(flat(spark, sf), chunk_bits=6)


def merged_parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Events of the event adapter merged by date and hour, as flat tables."""
    rows = materialize(dated(spark, sf), "dated")
    members = a.hourly_members(rows)
    keyed = rows.join(members.select("event_date", "id", "merged_id", "member_pos"), ["event_date", "id"])
    events = keyed.groupBy("event_date", "merged_id").agg(
        F.min_by("event", "member_pos").alias("event"), F.min_by("details", "member_pos").alias("details")
    )
    named = keyed.select("event_date", "merged_id", "member_pos", F.posexplode("actors").alias("actor_pos", "actor"))
    actors = named.groupBy("event_date", "merged_id", "actor").agg(F.min(F.struct("member_pos", "actor_pos")).alias("p"))
    return {
        "events": events,
        "members": members,
        "actors": actors.select("event_date", "merged_id", "p.*", "actor"),
        "sources": merge.merged_sources(members, rows),
    }


# Star schema and graph -------------------------------------------------------------------------------------------


@query
def star_join(spark, sf):
    return as_text(graph.star_join(a.star(spark, sf), a.DATE_FROM), "published_date")


@query
def graph_role_counts(spark, sf):
    return graph.role_counts(graph.graph_nodes(a.star(spark, sf), a.DATE_FROM))


@query
def graph_nodes(spark, sf):
    return graph.graph_nodes(a.star(spark, sf), a.DATE_FROM)


@query
def graph_edges(spark, sf):
    return graph.graph_edges(a.star(spark, sf), a.DATE_FROM)


@query
def graph_pruned_nodes(spark, sf):
    return graph.graph_nodes(a.star(spark, sf), a.DATE_FROM)


@query
def graph_pruned(spark, sf):
    return graph.graph_edges(a.star(spark, sf), a.DATE_FROM)


@query
def graph_counts(spark, sf):
    tables = a.star(spark, sf)
    return graph.graph_counts(graph.graph_nodes(tables, a.DATE_FROM), graph.graph_edges(tables, a.DATE_FROM))


@query
def actors_dim(spark, sf):
    return starry.actors_dim(a.user_aliases(spark, sf), merged_parts(spark, sf)["actors"])


@query
def actors_new(spark, sf):
    known = starry.dictionary_actors(a.user_aliases(spark, sf))
    return starry.new_actors(merged_parts(spark, sf)["actors"], known)


@query
def aliases_dim(spark, sf):
    return starry.aliases_dim(a.user_aliases(spark, sf))


@query
def sources_dim(spark, sf):
    good, _ = starry.split_dated_sources(starry.sources_dim(merged_parts(spark, sf)["sources"]))
    return as_text(good, "published_date")


@query
def events_dim(spark, sf):
    return starry.events_dim(merged_parts(spark, sf)["events"])


@query
def event_actor_links(spark, sf):
    return starry.event_actor_links(merged_parts(spark, sf)["actors"])


@query
def event_source_links(spark, sf):
    return starry.event_source_links(merged_parts(spark, sf)["sources"])


@query
def narrative_graph(spark, sf):
    """Merged events to star to graph in one plan; counts per role and of edges."""
    _, nodes, edges = pipeline.events_to_graph(merged_parts(spark, sf), a.user_aliases(spark, sf), "2024-01-10")
    return graph.graph_counts(nodes, edges)


@query
def dense_ids(spark, sf):
    suppliers = a.table(spark, sf, "customer").select("c_name")
    return starry.dense_ids(suppliers, ["c_name"])


@query
def table_previews(spark, sf):
    """Three rows of each table, counted, since which three is open."""
    tables = a.star(spark, sf)
    counts = [
        starry.preview(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, t in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


# Entities --------------------------------------------------------------------------------------------------------


@query
def entities_unnest(spark, sf):
    rows = grouping.drop_undated(flat(spark, sf))
    return rows.withColumns({"actors": joined("actors"), "location": joined("location")})


@query
def unique_actors(spark, sf):
    return entities.sorted_values(entities.unique_values(a.articles(spark, sf), "actors"))


@query
def unique_locations(spark, sf):
    return entities.unique_values(a.articles(spark, sf), "location")


@query
def unique_event_labels(spark, sf):
    return entities.unique_values(a.articles(spark, sf), "event")


def _names(rows: DataFrame) -> DataFrame:
    return rows.select("article_pos", "entity_pos", joined("actors").alias("actors"), joined("location").alias("location"))


@query
def canonical_names(spark, sf):
    return _names(canonical(spark, sf))


@query
def canonical_nested(spark, sf):
    out = entities.with_canonical_entities(a.articles(spark, sf), a.user_aliases(spark, sf))
    return _names(entities.unnest_entities(out))


@query
def canonical_locations(spark, sf):
    """Small dictionary held in the plan: no join, no shuffle."""
    places = {f"place_{k}": [f"loc_{k}"] for k in range(7) if k != 3}
    return _names(entities.canonicalize_with(flat(spark, sf), {}, places))


@query
def canonical_actors(spark, sf):
    """Lookup of single names, one row per use."""
    uses = flat(spark, sf).select("article_pos", F.explode("actors").alias("value"))
    found = entities.canonicalize_values(uses, a.user_aliases(spark, sf), "actor")
    return found.groupBy("value", "canonical").agg(F.count(F.lit(1)).alias("uses"))


# Dates of events -------------------------------------------------------------------------------------------------


@query
def per_date_ids(spark, sf):
    return dated(spark, sf).select("event_date", "id", "article_pos", "entity_pos")


@query
def events_by_date(spark, sf):
    lists = grouping.group_events_by_date(dated(spark, sf), size=100)
    items = F.transform("events", lambda e: F.concat_ws(":", e["id"], e["event"], e["article_url"]))
    return lists.select("event_date", "chunk", F.size("events").cast("bigint").alias("n"), joined(items).alias("events"))


@query
def events_sorted(spark, sf):
    return grouping.sort_by_date(dated(spark, sf)).select("event_date", "id", "event", "event_time")


@query
def narrow_events(spark, sf):
    rows = grouping.narrow_events(grouping.drop_undated(canonical(spark, sf)))
    return rows.withColumns({"actors": joined("actors"), "location": joined("location")})


@query
def merge_input(spark, sf):
    return grouping.merge_input(dated(spark, sf)).withColumn("actors", joined("actors"))


@query
def merged_sources(spark, sf):
    return merged_parts(spark, sf)["sources"]


@query
def merged_nested(spark, sf):
    parts = merged_parts(spark, sf)
    rows = merge.nest_merged(parts["events"], parts["actors"], parts["sources"], size=20, chunk_bits=4)
    source = F.transform("sources", lambda s: F.concat_ws("~", s["title"], s["article_url"], s["published_date"]))
    return rows.withColumns({"actors": joined("actors"), "sources": joined(source)})


# Date and text functions -----------------------------------------------------------------------------------------


@query
def dates_gregorian(spark, sf):
    rows = spread(a.gregorian_lines(spark, sf))
    line = F.col("line")
    return rows.select(
        "o_orderkey", "line", parse_gregorian_date(line).cast("string").alias("date"), published_label(line).alias("label")
    )


@query
def dates_bs(spark, sf):
    rows = spread(a.bs_lines(spark, sf)).withColumn("p", parse_nepali_date(F.col("line")))
    return rows.select(
        "event_id",
        F.col("p.bs.year").cast("bigint").alias("bs_year"),
        F.col("p.bs.month").cast("bigint").alias("bs_month"),
        F.col("p.bs.day").cast("bigint").alias("bs_day"),
        F.col("p.greg").cast("string").alias("greg"),
        F.col("p.day_name").alias("day_name"),
        gregorian_date(F.col("line")).cast("string").alias("date"),
        published_label(F.col("line")).alias("label"),
    )


@query
def digits_and_months(spark, sf):
    rows = spread(a.bs_lines(spark, sf))
    return rows.select(
        "event_id", dev_to_ascii(F.col("line")).alias("line"), month_number(F.col("month")).cast("bigint").alias("month")
    )


@query
def text_dates(spark, sf):
    rows = spread(a.dated_sentences(spark, sf))
    return rows.select("event_id", rewrite_text(F.col("sentence"), a.REFERENCE_YEAR).alias("sentence"))


@query
def text_words(spark, sf):
    rows = spread(a.dated_sentences(spark, sf))
    days = rename_weekdays(F.col("sentence"))
    return rows.select(
        "event_id",
        days.alias("weekdays"),
        rename_time_words(days).alias("time_words"),
        rename_time_words(days, word_boundary=True).alias("whole_words"),
    )


# Pages -----------------------------------------------------------------------------------------------------------


@query
def page_titles(spark, sf):
    clean = drop_noise(F.col("html"))
    return spread(a.table(spark, sf, "pages")).select("page_id", extract_title(clean, a.PAGE_LAYOUT).alias("title"))


@query
def page_by_classes(spark, sf):
    """Title, published line and text of pages whose parts are found by class."""
    return spread(a.classed_pages(spark, sf)).select("page_id", extract_page(F.col("html")).alias("p")).select("page_id", "p.*")


@query
def page_content(spark, sf):
    page = extract_page(F.col("html"), a.PAGE_LAYOUT)
    rows = spread(a.table(spark, sf, "pages")).select("page_id", page.alias("p"))
    return rows.select("page_id", "p.content", F.col("p.published_raw").alias("published_raw"))


@query
def page_paragraphs_fallback(spark, sf):
    """A container no page has: every paragraph of the page."""
    layout = type(a.PAGE_LAYOUT)(title_class=None)
    rows = spread(a.table(spark, sf, "pages")).select("page_id", extract_page(F.col("html"), layout).alias("p"))
    return rows.select("page_id", "p.content")


@query
def page_attach(spark, sf):
    rows = readers.attach_pages(a.url_list(spark, sf), a.crawled_pages(spark, sf))
    return rows.select("url", "pos", "html")


@query
def page_articles(spark, sf):
    return pipeline.build_articles(a.url_list(spark, sf), a.crawled_pages(spark, sf), a.REFERENCE_YEAR, a.PAGE_LAYOUT)


# Inference stages ------------------------------------------------------------------------------------------------


@query
def parse_responses(spark, sf):
    parsed = inference.parse_event_responses(a.model_responses(spark, sf))
    text = F.transform(
        "entities",
        lambda e: F.concat_ws(
            ";", e["event"], joined(e["actors"]), e["event_date"], joined(e["location"]), e["details"],
            joined(e["missing_fields"]), e["bad_date"].cast("string"),
        ),
    )
    return parsed.select("event_id", F.array_join(text, "#").alias("entities"), "raw_response", "parse_ok")


@query
def conforming_events(spark, sf):
    parsed = inference.parse_event_responses(a.model_responses(spark, sf)).withColumnRenamed("event_id", "pos")
    good, bad = inference.split_conforming(entities.unnest_entities(parsed.select("pos", "entities")))
    count = F.count(F.lit(1)).alias("n")
    return good.groupBy("event").agg(count).withColumn("good", F.lit(True)).unionByName(
        bad.groupBy("event").agg(count).withColumn("good", F.lit(False))
    )


@query
def parse_dictionary(spark, sf):
    return inference.dictionary_rows(a.dictionary_responses(spark, sf), "actor")


@query
def dictionary_fallback(spark, sf):
    new = inference.dictionary_rows(a.dictionary_responses(spark, sf), "actor")
    last = a.table(spark, sf, "supplier").select(
        F.lit("actor").alias("kind"),
        F.concat(F.lit("old "), "s_name").alias("canonical"),
        F.concat(F.lit("S"), "s_suppkey").alias("variant"),
        F.col("s_suppkey").alias("rank"),
    )
    return entities.first_matches(inference.latest_dictionary(new, last))


@query
def prompts_extraction(spark, sf):
    return inference.extraction_prompts(a.text_articles(spark, sf), "Find events.")


@query
def prompts_merge(spark, sf):
    """Events of a date with the same words lie in one prompt."""
    rows = materialize(grouping.merge_input(dated(spark, sf)), "events")
    alike = inference.candidate_groups(rows.withColumn("n", F.col("id").cast("bigint")), threshold=0.9)
    return inference.merge_prompts(rows, "Merge events.", size=50, candidates=alike)


@query
def prompts_aliases(spark, sf):
    return inference.alias_prompts(entities.unique_values(a.articles(spark, sf), "actors"), "Unify names.", size=40)


@query
def infer_stage(spark, sf):
    def model(prompts: pd.Series) -> list[str | None]:
        # Most calls hold one prompt, so nothing here makes or works on whole series, which costs far more for each call.
        texts = prompts.tolist()
        if len(texts) > 1 and any(text is not None and "6" in text for text in texts):
            raise RuntimeError("batch refused")
        if any(text is not None and "66" in text for text in texts):
            raise RuntimeError("prompt refused")
        return [None if text is None else f"[{text}]" for text in texts]

    rows = a.table(spark, sf, "events").select("event_id", F.concat(F.lit("p"), "event_id").alias("prompt"))
    return inference.infer(rows, model, calls_in_flight=8)


@query
def merge_responses(spark, sf):
    """Answers of a model that merges the events of each prompt pairwise; prompts of one date are refused."""
    rows = grouping.merge_input(dated(spark, sf)).withColumn("n", F.col("id").cast("bigint"))
    item = F.to_json(
        F.struct(
            F.lit("pair").alias("event"),
            F.min("details").alias("details"),
            F.array(F.min("id")).alias("actors"),
            F.array_sort(F.collect_list("n")).alias("source_event_indices"),
        )
    )
    chunk, pair = F.floor((F.col("n") - 1) / 50), F.floor((F.col("n") - 1) / 2)
    pairs = rows.groupBy("event_date", chunk.alias("chunk"), pair.alias("pair")).agg(item.alias("item"))
    answers = pairs.groupBy("event_date", "chunk").agg(F.array_sort(F.collect_list(F.struct("pair", "item"))).alias("items"))
    text = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["item"]), ","), F.lit("]"))
    refused = F.col("event_date") == "2024-01-05"
    answers = answers.select("event_date", "chunk", F.when(refused, "no").otherwise(text).alias("response"))
    good, rejects = inference.parse_merge_responses(answers)
    out = good.select("event_date", "merged_id", "event", joined("members").alias("members"))
    lost = rejects.select("event_date", F.lit(0).cast("bigint").alias("merged_id"), F.col("response").alias("event"), F.lit("").alias("members"))
    return out.unionByName(lost)


# Deterministic stand-ins -----------------------------------------------------------------------------------------


def document_groups(spark, sf):
    rows = spread(a.document_events(spark, sf)).select(
        "event_date", F.col("id").cast("bigint").alias("n"), similar.shingles(F.col("details")).alias("tokens")
    )
    return similar.similar_groups(rows, ["event_date"], "n", "tokens")


@query
def similar_documents(spark, sf):
    return document_groups(spark, sf)


@query
def merge_events(spark, sf):
    parts = merge.merge_events(a.document_events(spark, sf))
    sizes = parts["members"].groupBy("event_date", "merged_id").agg(F.count(F.lit(1)).alias("members"))
    names = parts["actors"].groupBy("event_date", "merged_id").agg(F.count(F.lit(1)).alias("actors"))
    keys = ["event_date", "merged_id"]
    return parts["events"].withColumn("details", F.md5("details")).join(sizes, keys).join(names, keys)


@query
def components(spark, sf):
    """Each customer linked to the one of half its key in its nation: one deep tree per nation."""
    base = F.col("c_nationkey").cast("bigint") * 1_000_000_000
    people = a.table(spark, sf, "customer")
    return connected_components(
        people.select((base + F.col("c_custkey")).alias("src"), (base + F.floor(F.col("c_custkey") / 2)).alias("dst"))
    )


@query
def resolve_aliases(spark, sf):
    return resolve.resolve_aliases(a.misspelt_names(spark, sf), "actor")


@query
def extract_baseline(spark, sf):
    dictionary = materialize(a.word_aliases(spark, sf), "dictionary")
    rows = baseline.extract_events(a.text_articles(spark, sf), dictionary, longest=2)
    return rows.withColumns({"actors": joined("actors"), "location": joined("location"), "event": F.md5("event"), "details": F.md5("details")})


# Sinks, files and streams ----------------------------------------------------------------------------------------


@query
def sink_dated_events(spark, sf):
    path = new_path(spark, "dated")
    writers.write_dated_events(dated(spark, sf), path)
    back = spark.read.parquet(path)
    return back.select(F.col("event_date").cast("string").alias("event_date"), "id", "event", joined("actors").alias("actors"))


@query
def sink_progress(spark, sf):
    """Two runs over dates: the second adds the dates the first did not have and leaves the rest."""
    path = new_path(spark, "progress")
    rows = materialize(grouping.merge_input(dated(spark, sf)).select("event_date", "id", "event"), "progress-in")
    writers.write_by_date(rows.where("event_date < '2024-01-11'"), path, lambda d: d.withColumn("run", F.lit("first")))
    writers.write_by_date(rows, path, lambda d: d.withColumn("run", F.lit("second")))
    back = spark.read.parquet(path)
    return back.select(F.col("event_date").cast("string").alias("event_date"), "id", "event", "run")


@query
def sink_aliases(spark, sf):
    path = new_path(spark, "aliases")
    writers.write_aliases(a.user_aliases(spark, sf), path, size=1)
    back = spark.read.schema("kind string, canonical string, rank bigint, chunk bigint, variants array<string>").json(path)
    return back.select("kind", "canonical", "rank", F.explode("variants").alias("variant"))


@query
def sink_articles(spark, sf):
    path = new_path(spark, "articles")
    writers.write_articles(a.text_articles(spark, sf), path)
    back = readers.read_articles(spark, path, lines=True)
    return back.select("url", "title", "published_date", "content")


@query
def sink_grouped_events(spark, sf):
    path = new_path(spark, "grouped")
    writers.write_grouped_events(dated(spark, sf), path, size=200)
    back = readers.read_grouped_lines(spark, path)
    return back.select("event_date", "id", "event", "article_url", joined("actors").alias("actors"))


@query
def date_keyed_file(spark, sf):
    """Objects ``{date: [event, ...]}`` written from the events and read back in parts."""
    path = new_path(spark, "date-keyed")
    lists = grouping.group_events_by_date(dated(spark, sf), 1_000)
    lists.select(F.to_json(F.create_map("event_date", "events"))).write.text(path)
    back = readers.read_grouped_events(spark, path)
    return back.select("event_date", "id", "event", "article_url", joined("actors").alias("actors"))


@query
def sink_merged_events(spark, sf):
    path = new_path(spark, "narrative")
    parts = merged_parts(spark, sf)
    writers.write_merged_events(merge.nest_merged(parts["events"], parts["actors"], parts["sources"], size=50), path)
    back = readers.read_merged_lines(spark, path)
    return back.select("event_date", "merged_id", "event", "details", F.explode("sources").alias("s")).select(
        "event_date", "merged_id", "event", "details", "s.*"
    )


@query
def sink_star(spark, sf):
    """Six tables written and read again, then the graph from the files."""
    path = new_path(spark, "star")
    tables = starry.build_star(merged_parts(spark, sf), a.user_aliases(spark, sf))
    writers.write_star({name: t for name, t in tables.items() if name != "rejected_sources"}, path)
    back = readers.read_star(spark, path)
    return graph.graph_counts(graph.graph_nodes(back, "2024-01-10"), graph.graph_edges(back, "2024-01-10"))


@query
def sink_graph_xml(spark, sf):
    path = new_path(spark, "graph")
    tables = a.star(spark, sf)
    links = graph.stored_links(tables, a.DATE_FROM)
    nodes, edges = graph.graph_nodes(tables, a.DATE_FROM, links), graph.graph_edges(tables, a.DATE_FROM, links)
    writers.write_graph_xml(nodes, edges, path)
    value = "struct<attvalue:array<struct<_for:string,_value:string>>>"
    nodes = spark.read.format("xml").option("rowTag", "node").schema(f"_id string, _label string, attvalues {value}").load(f"{path}/nodes")
    edges = spark.read.format("xml").option("rowTag", "edge").schema("_source string, _target string").load(f"{path}/edges")
    attributes = F.array_join(F.transform("attvalues.attvalue", lambda v: F.concat_ws("=", v["_for"], v["_value"])), "|")
    shown = nodes.select(F.lit("node").alias("what"), F.col("_id").alias("a"), F.col("_label").alias("b"), attributes.alias("c"))
    return shown.unionByName(
        edges.select(F.lit("edge").alias("what"), F.col("_source").alias("a"), F.col("_target").alias("b"), F.lit("").alias("c"))
    )


def _log(spark: SparkSession, sf: str) -> str:
    """Events as an article log in JSON lines, every fourth record twice."""
    folder = new_path(spark, "log")
    rows = a.table(spark, sf, "events").select(
        F.concat(F.lit("id-"), "event_id").alias("id"),
        F.concat(F.lit("Article "), "event_type").alias("title"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        "event_id",
    )
    again = rows.where("event_id % 4 = 0")
    rows.drop("event_id").write.json(folder)
    again.drop("event_id").write.mode("append").json(folder)
    return folder


def _shown(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    utc = F.to_utc_timestamp("timestamp", F.current_timezone())
    stamp = F.date_format(utc, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")
    return rows.select("id", "title", stamp)


@query
def stream_ingest(spark, sf):
    """Plain append: replays stay."""
    out, state = new_path(spark, "stream"), new_path(spark, "stream-state")
    log = ingest.read_article_log(spark, _log(spark, sf), files_per_batch=4)
    ingest.append(log, out, state).awaitTermination()
    return _shown(spark, out)


@query
def stream_once_per_id(spark, sf):
    out, state = new_path(spark, "stream"), new_path(spark, "stream-state")
    log = ingest.read_article_log(spark, _log(spark, sf), files_per_batch=4)
    ingest.append(ingest.once_per_id(log, "40 days"), out, state).awaitTermination()
    return _shown(spark, out)


@query
def stream_append_once(spark, sf):
    out, state = new_path(spark, "stream"), new_path(spark, "stream-state")
    log = ingest.read_article_log(spark, _log(spark, sf), files_per_batch=4)
    ingest.append_once(log, out, state).awaitTermination()
    return _shown(spark, out)
