"""The five stages over planted rows."""

import importlib
import os
import random

import pytest

import corpus_pipeline
from newsloom.llm import wumanber

from .helpers import by, no_documents, odd_documents
from .test_models import prose


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(21)
    rows = [(100 + i, prose(rng, lang, 60) + f"\n{prose(rng, lang, 50)}\nAll rights reserved.", lang, f"s{i % 10}") for i, lang in enumerate(["en", "fr", "de"] * 20)]
    near = rows[0][1].replace("\n", " end\n", 1)
    rows += [(900, rows[0][1], "en", "s1"), (901, near, "en", "s2"), (902, "12 34 ??", "en", "s3")]
    question = prose(rng, "en", 25)
    rows.append((903, prose(rng, "en", 40) + " " + question + " " + prose(rng, "en", 20), "en", "s4"))
    odd_documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, question), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != "pack":
            assert docs.columns == columns
        docs = docs.persist()
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name == "lines":
            assert docs.where("doc_id between 100 and 159 and text like '%rights%'").count() == 0
            assert docs.where("doc_id between 100 and 159 and n_chars <> length(text)").count() == 0
        if name == "near_copies":
            assert docs.where("doc_id = 4").count() == 1
    language, lines, near, clean, packed = seen
    assert not {0, 1, 2, 8, 902} & language and set(range(100, 160)) <= language
    assert lines == language
    assert lines - near == {900, 901, 9, 5} & lines
    assert near - clean == {903} and packed == clean
    assert wumanber.WINDOW == 10


def test_run_and_empty(spark, sf_dir, tmp_path):
    assert corpus_pipeline.run(spark, sf_dir).columns[0] == "doc_id"
    empty = str(tmp_path)
    no_documents(spark).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_queries_are_registered():
    driver = importlib.import_module("__spark_entry__")
    names = set(driver.queries())
    assert {"pipeline"} | {n for n in names if n.startswith("op")} >= {"pipeline"} and sum(n.startswith("op") for n in names) == 13
    assert "op6_line_spread" in driver.oracle_sql() and os.path.exists(driver.__file__)
