"""The corpus pipeline: five stages over documents, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import langfilters, linespread, packing, superminhash, wumanber
from newsloom.llm.common import free_name, table
from newsloom.llm.encoding import public_vocabulary
from newsloom.session import materialize, scratch, ship_package

#: A text is rejected if no language holds at least this share of its n-grams.
LEAST_SCORE = 0.05
#: Near copies: five-word shingles, likeness 0.8; four slots to a band miss a pair of that likeness once in 2e7.
WORDS, PERCENT, BAND = 5, 80, 4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts that some language of the corpus holds; those without a letter or of no language go.

    Filters are learned from all rows with a language. A row goes by its own text, also if its key is null or repeated.
    """
    ready = docs.select(F.struct("*").alias("_row"), "text", "lang")
    judged = langfilters.predict(ready, F.lit(True), key="_row")
    return judged.where((F.col("lang_pred") != langfilters.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes boilerplate lines out of the texts; every row stays. ``n_chars`` follows the text where a line went."""
    counts = free_name(docs, "_lines"), free_name(docs, "_removed")
    cleaned = linespread.remove_boilerplate(docs, counts=counts)
    n_chars = F.when(F.col(counts[1]) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars")
    return cleaned.select(*[n_chars if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest key; rows that repeat key and text go.

    Rows with a null key stay.
    """
    with scratch(spark) as keep:
        found = superminhash.near_duplicates(docs, words=WORDS, percent=PERCENT, band=BAND)
        kept = keep(materialize(found.where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct(), "kept"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_kept"), F.xxhash64("text").alias("_text"))
    one = rows.join(kept, "_kept", "left_semi").groupBy("_kept", "_text").agg(F.first("_row").alias("_row"))
    return one.select("_row.*").unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the test set."""
    ready = docs.select(F.struct("*").alias("_row"), "text")
    judged = wumanber.contamination(ready, table(spark, sf_dir, "benchmark"), key="_row")
    return judged.where("not contaminated").select("_row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a packed sequence."""
    return packing.pack_documents(docs, public_vocabulary())


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SQL has neither the trained filters nor the packing; both are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage reads what the one before has written to the shared folder."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs = keep(materialize(stage(spark, docs, sf_dir), name))
    return docs
