"""Cross-site line removal: HyperLogLog sketches of the sites of each line, exact counts near the threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import superminhash
from newsloom.llm.common import bounded_batches, chunks, hot_join, keyed_schema, text_bytes
from newsloom.session import materialize, scratch

#: A line on at least this many distinct sites is boilerplate.
SITES = 8
#: log2 of the sketch size; the standard error is about 1.04 / sqrt(2**12) = 1.6 %.
SKETCH = 12
#: Estimates within this share of the threshold, far more than the error, are counted exactly.
NEAR = 0.25


#: Blanks at the ends of a line that do not belong to it.
BLANKS = b" \t\x0b\x0c\r"


def line_rows(rows: DataFrame) -> DataFrame:
    """``(_key, _hash, _total, _pos, _n, site, _h, _g)``: a row for each line that is not blank, without its text.

    ``_n`` and ``_total`` are bytes of the line and of all lines of the text; ``_h`` and ``_g`` name the line.
    """
    columns = keyed_schema(rows, "_hash long, site string, _total long, _pos int, _n int, _h long, _g long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches, "_text"):
            owner, places, sizes, digests, totals = [], [], [], [], np.zeros(len(texts), np.int64)
            for at, text in enumerate(texts):
                for place, line in enumerate(text.split(b"\n")):
                    line = line.strip(BLANKS)
                    if line:
                        owner.append(at)
                        places.append(place)
                        sizes.append(len(line))
                        digests.append(xxhash.xxh3_128_digest(line))
                        totals[at] += len(line)
            names = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            rows_of = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(rows_of) for c in ("_key", "_hash", "site")), pa.array(totals).take(rows_of),
                    pa.array(places, pa.int32()), pa.array(sizes, pa.int32()), pa.array(names[:, 0]), pa.array(names[:, 1]),
                ],
                names=columns.names,
            )

    return rows.select("_key", "_hash", "site", "_text").mapInArrow(run, columns)


def spread_lines(lines: DataFrame, sites: int = SITES, near: float = NEAR) -> DataFrame:
    """``(_h, _g, _rows)``: the lines, by hash, that stand on at least ``sites`` distinct sites.

    ``lines`` is stored and has ``_h``, ``_g`` and ``site``. Each task keeps a sketch per line, and sketches are merged.
    """
    counted = lines.groupBy("_h", "_g").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH))).alias("_sites"), F.count(F.lit(1)).alias("_rows")
    )
    counted = materialize(counted.where(F.col("_sites") >= sites * (1 - near)), "spread")
    unsure = counted.where(F.col("_sites") <= sites * (1 + near)).select("_h", "_g", "_rows", F.lit(True).alias("_unsure"))
    exact = hot_join(lines.select("_h", "_g", "site"), unsure, ["_h", "_g"], "_rows").where("_unsure").groupBy("_h", "_g")
    exact = exact.agg(F.count_distinct("site").alias("_exact"))
    return counted.join(exact, ["_h", "_g"], "left").where(F.coalesce("_exact", "_sites") >= sites).select("_h", "_g", "_rows")


def remove_boilerplate(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    site: str = "source",
    sites: int = SITES,
    near: float = NEAR,
    counts: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """The rows and columns of ``docs`` in their order, the text without boilerplate, and two counts under names of the
    caller's choice: lines that are not blank, and lines removed.

    A line counts without the blanks, tabs and carriage returns around it; it is boilerplate if it stands on at least
    ``sites`` distinct sites. A text that is mostly such lines may be a copy of a page. Such texts are grouped into near
    copies (five-word shingles, likeness 0.8), and each group counts as one page, on a site of its own if it is on several;
    so the lines of a copied page are no boilerplate, but those that pages of other content share are. Boilerplate goes
    from every text.
    Blank lines stay where they are. A null site is one site of its own. A null or empty text has no lines and stays as
    it is. Rows that repeat key and text are treated alike. Lines are told apart by 128 bits of hash.
    """
    bounded_batches(docs.sparkSession)
    names = [F.col(f"`{c}`") for c in docs.columns]
    source = F.coalesce(F.concat(F.lit("="), F.col(f"`{site}`").cast("string")), F.lit(""))
    rows = docs.select(
        F.struct(*names).alias("_doc"), F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"), source.alias("site")
    ).withColumn("_hash", F.xxhash64("_text", F.lit(3)))
    with scratch(docs.sparkSession) as keep:
        lines = materialize(line_rows(rows.withColumn("_text", text_bytes(F.col("_text")))), "lines")
        wide = materialize(spread_lines(lines, sites, near).withColumn("_spread", F.lit(True)), "boilerplate")
        marked = keep(materialize(hot_join(lines, wide, ["_h", "_g"], "_rows").where("_spread").drop("_spread"), "marked"))
    with scratch(docs.sparkSession) as keep:
        spread = _on_many_pages(rows, marked, sites, near)
        if spread is not None:
            keep(spread)
    if spread is not None:
        marked = hot_join(marked, spread.withColumn("_spread", F.lit(True)), ["_h", "_g"], "_rows").where("_spread")
    gone = marked.groupBy(F.col("_key").alias("_k"), F.col("_hash").alias("_x")).agg(F.collect_set("_pos").alias("_gone"))
    joined = rows.join(gone, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_x")), "left")
    whole = F.split(F.col("_text"), "\n", -1)
    rest = F.array_join(F.filter(whole, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    # Lines that are not blank: runs between line ends with something else than blanks.
    counted = F.regexp_count(F.coalesce("_text", F.lit("")), F.lit(r"[^ \t\x0B\f\r\n][^\n]*+")).cast("bigint")
    cleaned = F.when(F.col("_gone").isNotNull(), rest).otherwise(F.col("_text"))
    return joined.select(
        *[cleaned.alias(c) if c == text else F.col("_doc").getField(c).alias(c) for c in docs.columns],
        counted.alias(counts[0]),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias(counts[1]),
    )


def _on_many_pages(rows: DataFrame, marked: DataFrame, sites: int, near: float) -> DataFrame | None:
    """Those of the marked lines that still stand on ``sites`` sites when near copies of a page count once.

    Near copies are looked for among texts with more than half of their bytes on marked lines. None if there are none.
    """
    shares = marked.groupBy("_hash", "_key").agg(
        F.max("_total").alias("_total"), F.sum("_n").alias("_marked"), F.count(F.lit(1)).alias("_all"), F.count_distinct("_pos").alias("_once")
    )
    # Rows that repeat key and text have all their lines as often as there are rows.
    copied = shares.where(F.col("_marked") * F.col("_once") * 2 > F.col("_total") * F.col("_all")).select("_hash").distinct()
    copied = materialize(copied, "copied")
    if copied.isEmpty():
        return None
    texts = rows.join(copied, "_hash").groupBy("_hash").agg(F.first("_text").alias("_text"))
    classes = superminhash.near_duplicates(texts, "_hash", "_text", words=5, percent=80, band=4)
    classes = materialize(classes.select("_hash", F.coalesce("component_id", "_hash").alias("_class")), "classes")
    spared = hot_join(marked, marked.groupBy("_hash").agg(F.count(F.lit(1)).alias("_m")).join(classes, "_hash"), ["_hash"], "_m")
    pages = spared.where("_class is null").select("_h", "_g", "site")
    own = F.concat(F.lit("/"), F.col("_class").cast("string"))
    one = spared.where("_class is not null").groupBy("_class", "_h", "_g").agg(F.min("site").alias("_a"), F.max("site").alias("_b"))
    one = one.select("_h", "_g", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(own).alias("site"))
    counted = spread_lines(materialize(pages.unionByName(one), "pages"), sites, near).select("_h", "_g")
    # The counts of rows are those of the marked lines, for the join with them.
    sizes = marked.groupBy("_h", "_g").agg(F.count(F.lit(1)).alias("_rows"))
    return materialize(sizes.join(counted, ["_h", "_g"]), "boilerplate")
