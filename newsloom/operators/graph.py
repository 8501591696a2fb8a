"""Star schema to actor -> event -> source graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.keyed import salted_join
from newsloom.session import materialize

NODE_COLUMNS = ["node_id", "role", "label", "details", "url", "published_date"]


def star_join(star: dict[str, DataFrame], date_from: str, **join) -> DataFrame:
    """Five-table inner join with a date filter: every event gives its actors times its sources.

    The filter goes to the scan of ``sources``; each link table is joined with its dimension before the two meet on
    the event, and each of those joins is salted, since one actor, source or event may hold most of the links.
    """
    sources = star["sources"].where(F.col("published_date") >= F.lit(date_from).cast("date")).select(
        "source_key", F.col("title").alias("source_title"), F.col("url").alias("source_url"), "published_date"
    )
    actors = star["actors"].select("actor_key", F.col("label").alias("actor_label"))
    events = star["events"].select("event_key", F.col("label").alias("event_label"), F.col("details").alias("event_details"))
    by_source = salted_join(star["event_sources"], sources, ["source_key"], spread=["event_key"], **join)
    by_actor = salted_join(star["event_actors"], actors, ["actor_key"], spread=["event_key"], **join)
    by_event = {"spread": ["source_key"], "hot_from": star["event_sources"], **join}
    linked = salted_join(by_source, events, ["event_key"], **by_event)
    return salted_join(linked, by_actor, ["event_key"], **by_event).select(
        "actor_key",
        "actor_label",
        "event_key",
        "event_label",
        "event_details",
        "source_key",
        "source_title",
        "source_url",
        "published_date",
    )


def _node(role: str, key: str, **attributes) -> list:
    values = {name: F.lit(None).cast("string") for name in NODE_COLUMNS[2:]}
    values.update({name: F.col(column).cast("string") for name, column in attributes.items()})
    return [
        F.concat(F.lit(role + "_"), F.col(key).cast("string")).alias("node_id"),
        F.lit(role).alias("role"),
        *[values[name].alias(name) for name in NODE_COLUMNS[2:]],
    ]


def _edge(source: str, target: str) -> list:
    """``source`` and ``target`` are roles; their keys are the columns ``<role>_key``."""
    return [
        F.concat(F.lit(f"{role}_"), F.col(f"{role}_key").cast("string")).alias(name)
        for name, role in (("src", source), ("dst", target))
    ]


def build_nodes(rows: DataFrame) -> DataFrame:
    """Distinct nodes of three roles; each key keeps one set of attributes."""
    actor = rows.groupBy("actor_key").agg(F.min("actor_label").alias("label"))
    event = rows.groupBy("event_key").agg(F.min(F.struct("event_label", "event_details")).alias("e"))
    source = rows.groupBy("source_key").agg(F.min(F.struct("source_title", "source_url", "published_date")).alias("s"))
    return (
        actor.select(*_node("actor", "actor_key", label="label"))
        .unionByName(event.select(*_node("event", "event_key", label="e.event_label", details="e.event_details")))
        .unionByName(
            source.select(
                *_node("source", "source_key", label="s.source_title", url="s.source_url", published_date="s.published_date")
            )
        )
    )


def build_edges(rows: DataFrame) -> DataFrame:
    """Distinct actor -> event and event -> source edges."""
    upper = rows.select(*_edge("actor", "event")).distinct()
    return upper.unionByName(rows.select(*_edge("event", "source")).distinct())


def pruned_links(star: dict[str, DataFrame], date_from: str, **join) -> tuple[DataFrame, DataFrame]:
    """``(event_actors, event_sources)`` that take part in the graph, without the actors-times-sources product.

    Kept are links to sources in the date range, and actor links of events that have such a source; each side only
    for events the other side has, and only to rows of the dimension tables.
    """
    inside = star["sources"].where(F.col("published_date") >= F.lit(date_from).cast("date")).select("source_key")
    to_source = salted_join(star["event_sources"], inside, ["source_key"], "left_semi", spread=["event_key"], **join)
    known_actors = star["actors"].select("actor_key")
    to_actor = salted_join(star["event_actors"], known_actors, ["actor_key"], "left_semi", spread=["event_key"], **join)
    # Links are distinct before they meet: repeats of one link fall together on the map side.
    to_source, to_actor = to_source.distinct(), to_actor.distinct()
    known = star["events"].select("event_key")
    both = (
        to_source.select("event_key")
        .distinct()
        .join(to_actor.select("event_key").distinct(), "event_key", "left_semi")
        .join(known, "event_key", "left_semi")
    )
    # A count of hot events would shuffle both link tables twice more. Spark's adaptive joins split an event of very many
    # links where nothing after the join needs its partitions; the distinct events of `graph_nodes` do, so there they do not.
    return to_actor.join(both, "event_key", "left_semi"), to_source.join(both, "event_key", "left_semi")


def stored_links(star: dict[str, DataFrame], date_from: str, **join) -> tuple[DataFrame, DataFrame]:
    """`pruned_links` written once, for nodes and edges that are written one after the other."""
    actor_links, source_links = pruned_links(star, date_from, **join)
    return materialize(actor_links, "actor-links"), materialize(source_links, "source-links")


def graph_edges(
    star: dict[str, DataFrame], date_from: str, links: tuple[DataFrame, DataFrame] | None = None, **join
) -> DataFrame:
    """The edges of `build_edges` over `star_join`, from the pruned links, which may be given."""
    actor_links, source_links = links or pruned_links(star, date_from, **join)
    return actor_links.select(*_edge("actor", "event")).unionByName(source_links.select(*_edge("event", "source")))


def graph_nodes(
    star: dict[str, DataFrame], date_from: str, links: tuple[DataFrame, DataFrame] | None = None, **join
) -> DataFrame:
    """The nodes of `build_nodes` over `star_join`, from the pruned links, which may be given."""
    actor_links, source_links = links or pruned_links(star, date_from, **join)
    actors = star["actors"].join(actor_links.select("actor_key").distinct(), "actor_key", "left_semi")
    events = star["events"].join(source_links.select("event_key").distinct(), "event_key", "left_semi")
    sources = star["sources"].join(source_links.select("source_key").distinct(), "source_key", "left_semi")
    return (
        actors.select(*_node("actor", "actor_key", label="label"))
        .unionByName(events.select(*_node("event", "event_key", label="label", details="details")))
        .unionByName(
            sources.select(
                *_node("source", "source_key", label="title", url="url", published_date="published_date")
            )
        )
    )


def role_counts(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("role").agg(F.count(F.lit(1)).alias("n"))


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``what, n``: nodes per role, all nodes, all edges."""
    per_role = role_counts(nodes).select(F.col("role").alias("what"), "n")
    total = nodes.agg(F.count(F.lit(1)).alias("n")).select(F.lit("nodes").alias("what"), "n")
    links = edges.agg(F.count(F.lit(1)).alias("n")).select(F.lit("edges").alias("what"), "n")
    return per_role.unionByName(total).unionByName(links)


def has_edge(edges: DataFrame, src: str, dst: str) -> bool:
    return not edges.where((F.col("src") == src) & (F.col("dst") == dst)).isEmpty()
