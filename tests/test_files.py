import json

import pytest

from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import grouping
from newsloom.sources import readers, writers
from newsloom.streaming import ingest

from .conftest import rows


def test_urls_keep_file_order(spark, tmp_path):
    (tmp_path / "urls.csv").write_text("url\nhttp://b\nhttp://a\nhttp://c\n")
    got = readers.read_urls(spark, str(tmp_path / "urls.csv"))
    assert [r.url for r in got.orderBy("pos").collect()] == ["http://b", "http://a", "http://c"]
    dense = readers.read_urls(spark, str(tmp_path / "urls.csv"), dense=True)
    assert rows(dense.select("pos", "url")) == [(0, "http://b"), (1, "http://a"), (2, "http://c")]


def test_pages(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([("http://a", bytearray(b"<p>x\xff</p>"))], "url string, html binary").write.parquet(path)
    urls = spark.createDataFrame([("http://a", 0), ("http://gone", 1)], "url string, pos long")
    pages = readers.read_pages(spark, path)
    assert rows(readers.attach_pages(urls, pages).select("pos", "html")) == [(0, "<p>x�</p>"), (1, "")]
    assert rows(readers.attach_extracted(urls, pages).select("pos", "title", "content")) == [(0, "", "x�"), (1, "", "")]


def test_article_and_dictionary_files(spark, tmp_path):
    articles = [{"url": "u1", "title": "शीर्षक", "published_date": "", "content": "c", "entities": [{"event": "E"}]}, {"url": "u2", "title": "t", "published_date": "", "content": "", "entities": []}]
    (tmp_path / "articles.json").write_text(json.dumps(articles, ensure_ascii=False, indent=2))
    got = readers.read_articles(spark, str(tmp_path / "articles.json"), dense=True)
    assert rows(got.select("pos", "url", "title")) == [(0, "u1", "शीर्षक"), (1, "u2", "t")]
    assert {r.pos: json.loads(r.entities) for r in got.collect()} == {0: [{"event": "E"}], 1: []}
    (tmp_path / "actors.json").write_text(json.dumps({"B": ["b", "B"], "A": ["b"]}, indent=2))
    aliases = readers.read_aliases(spark, str(tmp_path / "actors.json"), "actor")
    assert rows(aliases) == [("actor", "A", "b", 1), ("actor", "B", "B", 0), ("actor", "B", "b", 0)]
    writers.write_alias_rows(aliases, str(tmp_path / "rows"))
    assert rows(readers.read_alias_rows(spark, str(tmp_path / "rows"))) == rows(aliases)
    writers.write_aliases(aliases, str(tmp_path / "lines"))
    lines = [json.loads(line) for f in (tmp_path / "lines").glob("*.json") for line in f.read_text().splitlines()]
    assert sorted((x["canonical"], sorted(x["variants"])) for x in lines) == [("A", ["b"]), ("B", ["B", "b"])]


def test_date_keyed_files(spark, tmp_path):
    event = {"id": "1", "title": "T", "article_url": "u", "published_date": "p", "event": "E", "details": "D", "actors": ["A"], "location": "X", "extra": 1}
    grouped = {"2024-01-02": [event, {**event, "id": "2", "location": ["Y", "Z"]}], "2024-01-01": []}
    (tmp_path / "g.json").write_text(json.dumps(grouped))
    got = readers.read_grouped_events(spark, str(tmp_path / "g.json"))
    assert rows(got.select("event_date", "id", "actors", "location")) == [("2024-01-02", "1", ["A"], ["X"]), ("2024-01-02", "2", ["A"], ["Y", "Z"])]
    assert grouping.merge_input(got).columns == ["event_date", "id", "event", "details", "actors"]
    merged = {"2024-01-02": [{"event": "M", "details": "D", "actors": ["A"], "source_event_indices": [1, "2"]}, {"event": "N", "details": "D", "actors": [], "sources": [{"title": "T", "article_url": "u", "published_date": "p"}]}]}
    (tmp_path / "m.json").write_text(json.dumps(merged))
    got = readers.read_merged_events(spark, str(tmp_path / "m.json"))
    assert rows(got.select("event_date", "merged_id", "event", "members")) == [("2024-01-02", 1, "M", ["1", "2"]), ("2024-01-02", 2, "N", None)]
    assert got.where("merged_id = 2").first().sources[0].article_url == "u"


def test_a_run_that_broke_off_goes_on(spark, tmp_path):
    path = str(tmp_path / "dates")
    dated = spark.createDataFrame([("2024-01-01", "1"), ("2024-01-02", "1"), ("2024-01-02", "2")], "event_date string, id string")
    seen = []

    def stage(run):
        def work(df):
            seen.append(rows(df.select("event_date").distinct()))
            return df.withColumn("run", F.lit(run))

        return work

    def breaks_off(df):
        if df.where("event_date = '2024-01-02'").count():
            raise RuntimeError("out of credit")
        return stage("first")(df)

    with pytest.raises(RuntimeError):
        writers.write_by_date(dated, path, breaks_off, dates_per_job=1)
    writers.write_by_date(dated, path, stage("second"))
    writers.write_by_date(dated, path, stage("third"))
    assert seen == [[("2024-01-01",)], [("2024-01-02",)], []]
    back = spark.read.parquet(path).select(F.col("event_date").cast("string"), "id", "run")
    assert rows(back) == [("2024-01-01", "1", "first"), ("2024-01-02", "1", "second"), ("2024-01-02", "2", "second")]


def test_log_stream(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    record = {"id": "a", "title": "T", "timestamp": "2025-07-31T10:00:00.123456+00:00"}
    (log / "1.json").write_text(json.dumps(record) + "\n" + json.dumps({**record, "id": "b"}))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = lambda: ingest.read_article_log(spark, str(log))
    ingest.append_once(stream(), out, state).awaitTermination()
    (log / "2.json").write_text(json.dumps(record) + "\n" + json.dumps({**record, "id": "c", "timestamp": "2020-01-01T00:00:00+00:00"}))
    ingest.append_once(stream(), out, state).awaitTermination()
    assert rows(spark.read.parquet(out).select("id")) == [("a",), ("b",), ("c",)]
    plain, plain_state = str(tmp_path / "plain"), str(tmp_path / "plain-state")
    ingest.append(stream(), plain, plain_state).awaitTermination()
    assert rows(spark.read.parquet(plain).select("id")) == [("a",), ("a",), ("b",), ("c",)]
    once, once_state = str(tmp_path / "once"), str(tmp_path / "once-state")
    ingest.append(ingest.once_per_id(stream(), "3650 days"), once, once_state).awaitTermination()
    assert rows(spark.read.parquet(once).select("id")) == [("a",), ("b",), ("c",)]


def test_dates_that_are_gone_leave_the_table(spark, tmp_path):
    path = str(tmp_path / "gone")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for dates in (("2024-01-01", "2024-01-02"), ("2024-01-02",)):
            df = spark.createDataFrame([(d, "1") for d in dates], "event_date string, id string")
            writers.write_dated_events(df, path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(spark.read.parquet(path).select(F.col("event_date").cast("string"))) == [("2024-01-02",)]


def test_lines_of_events_are_read_back(spark, tmp_path):
    path = str(tmp_path / "grouped")
    columns = "event_date string, article_pos long, entity_pos int, id string, title string, article_url string, published_date string, event string, actors array<string>, event_time string, location array<string>, details string"
    events = [(d, n, 0, str(n), "T", f"u{n}", "p", f"E{n}", ["A", "b\"c"] if n % 2 else [], None, None if n % 3 else ["X"], "D\nd") for d in ("2024-01-02", "2024-01-01") for n in range(1, 8)]
    dated = spark.createDataFrame(events, columns)
    writers.write_grouped_events(dated, path, size=3)
    names = [c for c in dated.columns if not c.endswith("_pos")]
    assert rows(readers.read_grouped_lines(spark, path).select(names)) == rows(dated.select(names))
    path = str(tmp_path / "merged")
    source = "array<struct<title:string,article_url:string,published_date:string>>"
    nested = spark.createDataFrame(
        [("2024-01-01", 1, 0, "E", None, ["A", "B"], [("T", "u", None)]), ("2024-01-01", 1, 1, "E", None, ["C"], []), ("2024-01-02", 1, 0, "", "d", [], [])],
        f"event_date string, merged_id bigint, chunk bigint, event string, details string, actors array<string>, sources {source}",
    )
    writers.write_merged_events(nested, path)
    back = readers.read_merged_lines(spark, path)
    assert back.columns == nested.columns and rows(back) == rows(nested)


def test_a_star_is_refreshed_as_a_whole(spark, tmp_path):
    base = str(tmp_path / "star")

    def star_of(label):
        text = {"string": label, "date": None}
        return {n: spark.createDataFrame([tuple(text[t] for _, t in spark.createDataFrame([], s).dtypes)], s) for n, s in schemas.STAR.items()}

    def labels():
        return {r[0] for table in readers.read_star(spark, base).values() for r in table.collect()}

    writers.write_star(star_of("one"), base)
    assert labels() == {"one"}
    broken = star_of("two")
    broken["events"] = broken["events"].withColumn("label", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        writers.write_star(broken, base)
    assert labels() == {"one"} and len(list((tmp_path / "star" / "versions").iterdir())) == 1
    opened = readers.read_star(spark, base)
    # A refresh may read the star that it replaces.
    writers.write_star({n: t.withColumn(t.columns[0], F.lit("three")) for n, t in opened.items()}, base)
    assert labels() == {"three"} and opened["actors"].first()[0] == "one"
    writers.write_star(star_of("four"), base)
    assert labels() == {"four"} and len(list((tmp_path / "star" / "versions").iterdir())) == 2


def test_a_star_of_plain_tables_is_read(spark, tmp_path):
    for name, schema in schemas.STAR.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
    assert all(t.count() == 0 for t in readers.read_star(spark, str(tmp_path)).values())
