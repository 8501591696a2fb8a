"""The growing article log as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom import schemas


def read_article_log(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, schema=schemas.ARTICLE_LOG
) -> DataFrame:
    """JSON lines ``{id, title, timestamp}``; ``timestamp`` becomes a TIMESTAMP, null when it is no ISO time."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder).withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))


def once_per_id(articles: DataFrame, replay_window: str = "7 days") -> DataFrame:
    """Each ``id`` once, for replays within ``replay_window`` of event time.

    State is kept for that long only. A row later than the window is dropped by the engine, so choose a window
    longer than any delay, or use `append_once`, which keeps no state and drops nothing.
    """
    return articles.withWatermark("timestamp", replay_window).dropDuplicatesWithinWatermark(["id"])


def append(articles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends everything that has arrived to a parquet table, then stops."""
    writer = articles.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def append_once(articles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends each ``id`` once per day of its time, whatever its delay, to a table with one folder per day.

    The rule is the same inside a batch and between batches, so the result does not depend on where batches end.

    A batch is compared with the stored rows of its own days only; a replay carries the same time and so the same
    day. A batch that runs again finds its rows stored and adds none.
    """

    def store(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        day = F.coalesce(F.date_format("timestamp", "yyyy-MM-dd"), F.lit("none"))
        rows = batch.withColumn("day", day).dropDuplicates(["id", "day"])
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        if location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location):
            # The days of one batch are a short list; with it only their folders are read, not the whole history.
            days = [row.day for row in rows.select("day").distinct().collect()]
            stored = spark.read.schema(rows.schema).parquet(path).where(F.col("day").isin(days)).select("id", "day")
            rows = rows.join(stored, ["id", "day"], "left_anti")
        rows.write.mode("append").partitionBy("day").parquet(path)

    writer = articles.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
