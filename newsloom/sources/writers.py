"""Writers of the tables and JSON files that flow between the stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.grouping import group_events_by_date
from newsloom.operators.keyed import number_in_group, pack
from newsloom.session import read_pointer, remove_folder, write_pointer
from newsloom.sources.readers import STAR_POINTER, STAR_VERSIONS


def write_articles(articles: DataFrame, path: str, form: str = "json") -> None:
    """Overwrites ``path``. JSON output is UTF-8 lines without ASCII escapes; empty fields are kept."""
    writer = articles.write.mode("overwrite").format(form)
    (writer.option("ignoreNullFields", "false") if form == "json" else writer).save(path)


def write_aliases(aliases: DataFrame, path: str, size: int = 10_000) -> None:
    """JSON lines ``{kind, canonical, rank, chunk, variants}``, at most ``size`` variants to a line."""
    keys = ["kind", "canonical", "rank"]
    # Spread by hash, so that one name with very many variants is not numbered in one task.
    ranked = aliases.withColumn("rank", F.coalesce("rank", F.lit(0)))
    rows = ranked.select(*keys, "variant").distinct().withColumn("_h", F.pmod(F.xxhash64("variant"), F.lit(1 << 30)))
    numbered = number_in_group(rows, keys, ["_h", "variant"], "n", chunk_bits=22)
    pack(numbered, keys, "n", F.col("variant"), size, "variants").write.mode("overwrite").json(path)


def write_alias_rows(aliases: DataFrame, path: str) -> None:
    aliases.select("kind", "canonical", "variant", "rank").write.mode("overwrite").parquet(path)


def write_dated_events(dated: DataFrame, path: str, form: str = "parquet") -> None:
    """One folder per date, files sorted by id.

    The rebalance hint gathers a date's rows and, unlike a plain repartition, splits a date that is too large.
    """
    rows = dated.withColumn("_n", F.col("id").cast("bigint")).hint("rebalance", "event_date")
    rows = rows.sortWithinPartitions("event_date", "_n").drop("_n")
    # A date that is gone goes with the rest, whatever the session's mode is.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("event_date").format(form).save(path)


def write_grouped_events(dated: DataFrame, path: str, size: int = 10_000) -> None:
    """JSON lines ``{event_date, chunk, events}`` in date order."""
    lists = group_events_by_date(dated, size)
    lists.orderBy("event_date", "chunk").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_merged_events(nested: DataFrame, path: str) -> None:
    """JSON lines of merged events with their sources, in date order. ``path`` must not be what ``nested`` reads."""
    rows = nested.orderBy("event_date", "merged_id", "chunk")
    rows.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def unfinished(dated: DataFrame, path: str) -> DataFrame:
    """Rows of dates that have no folder under ``path`` yet."""
    spark = dated.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return dated
    done = spark.read.parquet(path).select(F.col("event_date").cast("string").alias("event_date")).distinct()
    return dated.join(done, "event_date", "left_anti")


def write_by_date(dated: DataFrame, path: str, stage: Callable[[DataFrame], DataFrame], dates_per_job: int = 16) -> None:
    """Runs ``stage`` over the dates not finished yet and adds their folders; finished dates stay as they are.

    Dates are worked on in order, ``dates_per_job`` at a time, and each job adds its folders when it ends. So a run that
    broke off goes on after the last job that ended. Only dates, a short list, come to the driver.
    """
    left = unfinished(dated, path).where(F.col("event_date").isNotNull()).select("event_date").distinct().orderBy("event_date")
    dates = [row.event_date for row in left.toLocalIterator()]
    for start in range(0, max(1, len(dates)), dates_per_job):
        some = dated.where(F.col("event_date").isin(dates[start : start + dates_per_job]))
        writer = stage(some).hint("rebalance", "event_date").write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def write_star(star: dict[str, DataFrame], base: str, keep: int = 2) -> None:
    """Full refresh of all tables at once, or of none.

    The tables go to a folder of their own; then a pointer file is switched to it, which readers follow. A run that fails
    leaves the former star as it was, and of two runs at the same time the later switch stands as a whole. The last ``keep``
    versions stay, so tables that were opened before the switch can still be read, also by this very refresh.
    """
    spark = next(iter(star.values())).sparkSession
    version = uuid.uuid4().hex
    folder = f"{base}/{STAR_VERSIONS}"
    try:
        for name, table in star.items():
            table.write.parquet(f"{folder}/{version}/{name}")
    except BaseException:
        remove_folder(spark, f"{folder}/{version}")
        raise
    versions = [version, *read_pointer(spark, f"{base}/{STAR_POINTER}")]
    write_pointer(spark, f"{base}/{STAR_POINTER}", versions[:keep])
    for old in versions[keep:]:
        remove_folder(spark, f"{folder}/{old}")


def write_star_jdbc(star: dict[str, DataFrame], url: str, **options: str) -> None:
    """Full refresh in a database: tables are emptied, not dropped, and filled in one transaction per part."""
    for name, table in star.items():
        writer = table.write.format("jdbc").mode("overwrite").option("truncate", "true").option("url", url)
        writer.options(**options).option("dbtable", name).save()


def write_graph(nodes: DataFrame, edges: DataFrame, base: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{base}/nodes")
    edges.write.mode("overwrite").parquet(f"{base}/edges")


# Numbers of the node attributes in the graph file format.
ATTRIBUTE_NUMBERS = {"role": "0", "details": "1", "url": "2", "published_date": "3"}


def write_graph_xml(nodes: DataFrame, edges: DataFrame, base: str) -> None:
    """``node`` and ``edge`` elements of the graph exchange format, as XML part files under two folders."""
    values = F.array(
        *[
            F.when(F.col(name).isNotNull(), F.struct(F.lit(number).alias("_for"), F.col(name).alias("_value")))
            for name, number in ATTRIBUTE_NUMBERS.items()
        ]
    )
    values = F.filter(values, lambda v: v.isNotNull())
    node = nodes.select(
        F.col("node_id").alias("_id"), F.col("label").alias("_label"), F.struct(values.alias("attvalue")).alias("attvalues")
    )
    edge = edges.select(
        F.concat_ws(">", "src", "dst").alias("_id"), F.col("src").alias("_source"), F.col("dst").alias("_target")
    )
    for name, rows in (("node", node), ("edge", edge)):
        rows.write.mode("overwrite").format("xml").option("rootTag", f"{name}s").option("rowTag", name).save(
            f"{base}/{name}s"
        )
