"""Items of large JSON objects ``{key: [{...}, {...}], ...}``, read in parts by byte ranges.

Spark cuts a file at closing braces, wherever its byte ranges begin. What a piece means depends on all text before it:
whether it begins inside a string, and how deep it lies. Both are sums over pieces, so each part is summed by itself,
a running sum over one row per part gives the state at the beginning of each part, and pieces are then judged in their part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.session import materialize

CLOSE = "}"
#: An item is an object in a list in the outer object.
ITEM_DEPTH = 3
ESCAPE = r"\\[\s\S]"
STRING = r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"'
#: Text before an item's own brace: no brace but in strings.
BEFORE = rf'^[^"{{]*+(?:{STRING}[^"{{]*+)*+'
PART = ["file", "start"]


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _depth_change(runs: Column, inside: int) -> Column:
    """Brackets opened less brackets closed, of a text cut at its quotes, that begins inside of a string or not."""
    bare = F.array_join(F.filter(runs, lambda _, i: (i + F.lit(inside)) % 2 == 0), " ")
    return _count(bare, "{[") - _count(bare, "}]")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The texts between closing braces, stored, with the part and place they lie in, and what each adds to the sums.

    No escape is cut, since none ends in a brace.
    """
    rows = spark.read.option("lineSep", CLOSE).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    rows = rows.withColumn("_runs", F.split(F.regexp_replace("value", ESCAPE, ""), '"', -1))
    rows = rows.select(
        "*",
        (F.size("_runs") - 1).alias("quotes"),
        _depth_change(F.col("_runs"), 0).alias("outside"),
        _depth_change(F.col("_runs"), 1).alias("inside"),
    )
    return materialize(rows.drop("_runs"), "pieces")


def _before_parts(value: Column) -> Column:
    """Sum over the parts of the file before this one."""
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def _in_part(value: Column, last: int) -> Column:
    """Sum over the pieces of the part up to the one ``last`` places on."""
    upto = Window.partitionBy(*PART).orderBy("place").rowsBetween(Window.unboundedPreceding, last)
    return F.coalesce(F.sum(value).over(upto), F.lit(0))


def json_items(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, item, key, text, pos`` of every object in a list of the outer object.

    ``key`` is the key of the list, ``pos`` the place in it from 0, ``item`` rises through the file and ``start`` is the
    part the item begins in. Lists of a repeated key, and outer objects that follow each other, are read one after the
    other. What stands in a list and is no object is left out and not counted; so is a value that is no list.
    """
    pieces = _pieces(spark, path)
    state = pieces.withColumn("_quotes", _in_part(F.col("quotes"), -1))

    def closes(begins: Column) -> Column:
        return ((begins + F.col("quotes")) % 2 == 0).cast("int")

    def change(begins: Column) -> Column:
        return F.when(begins == 0, F.col("outside")).otherwise(F.col("inside")) - closes(begins)

    either = [change((F.col("_quotes") + F.lit(h)) % 2) for h in (0, 1)]
    sums = state.groupBy(*PART).agg(F.sum("quotes").alias("_q"), F.sum(either[0]).alias("_d0"), F.sum(either[1]).alias("_d1"))
    parts = sums.withColumn("_begins", _before_parts(F.col("_q")) % 2)
    parts = parts.withColumn("_depth", _before_parts(F.when(F.col("_begins") == 0, F.col("_d0")).otherwise(F.col("_d1"))))

    known = state.join(parts.select(*PART, "_begins", "_depth"), PART)
    known = known.withColumn("_begins", (F.col("_begins") + F.col("_quotes")) % 2)
    known = known.withColumn("_after", F.col("_depth") + _in_part(change(F.col("_begins")), 0))
    # A brace that closes an object at or above the depth of items ends a text; only those at the very depth are items.
    ends = (closes(F.col("_begins")) == 1) & (F.col("_after") < ITEM_DEPTH)
    known = known.withColumn("_ends", ends.cast("int")).withColumn("_number", _in_part(F.col("_ends"), -1))
    counted = known.groupBy(*PART).agg(F.sum("_ends").alias("_e"))
    moves = counted.select(*PART, _before_parts(F.col("_e")).alias("_move"))
    known = known.join(moves, PART).withColumn("item", F.col("_number") + F.col("_move"))

    whole = known.groupBy("file", "item").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "value"))).alias("_pieces"),
        F.max(F.col("_ends") * (F.col("_after") + 1)).alias("_closed"),
    )
    text = F.concat(F.array_join(F.transform("_pieces", lambda p: p["value"]), CLOSE), F.lit(CLOSE))
    # The brace of the outer object comes before the first item.
    whole = whole.select("file", "item", F.col("_pieces")[0]["start"].alias("start"), "_closed", F.regexp_replace(text, r"^\s*+\{", "").alias("_all"))
    before = F.regexp_extract("_all", BEFORE, 0)
    keys = F.regexp_extract_all(before, F.lit(rf"({STRING})\s*+:"), 1)
    named = F.when(F.size(keys) > 0, F.from_json(F.concat(F.lit("["), F.element_at(keys, -1), F.lit("]")), "array<string>")[0])
    found = whole.withColumn("_before", before).withColumn("_key", named)
    text = F.col("_all").substr(F.length("_before") + 1, F.length("_all"))
    found = found.select("file", "item", "start", "_closed", text.alias("text"), "_key")
    return _with_keys(materialize(found, "items"))


def _with_keys(found: DataFrame) -> DataFrame:
    """Each item with the last key before it: in its part, else in the parts before."""
    item = F.when(F.col("_closed") == ITEM_DEPTH, F.lit(1)).otherwise(0)
    head = F.when(F.col("_key").isNotNull(), F.struct(F.col("_key").alias("key"), F.col("item").alias("first")))
    upto = Window.partitionBy(*PART).orderBy("item").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    rows = found.withColumn("_head", head).withColumn("_is", item)
    lasts = rows.groupBy(*PART).agg(F.max_by("_head", F.when(F.col("_head").isNotNull(), F.col("item"))).alias("_last"))
    lasts = lasts.select(*PART, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    rows = rows.withColumn("_own", F.last("_head", ignorenulls=True).over(upto)).join(lasts, PART)
    rows = rows.withColumn("_head", F.coalesce("_own", "_carried")).where("_is = 1")
    # All texts between the first item of a list and this one are items of the list.
    return rows.select(*PART, "item", F.col("_head.key").alias("key"), "text", (F.col("item") - F.col("_head.first")).alias("pos"))
