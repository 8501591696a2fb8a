"""Every query against its SQL twin on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as driver

DATA = os.environ.get("NEWSLOOM_TEST_DATA", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_twin():
    from newsloom.plans.queries import QUERIES

    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, sql, name):
    found = driver.queries()[name](spark, DATA)
    relation = sql.sql(driver.oracle_sql()[name])
    columns = sorted(relation.columns)
    assert sorted(found.columns) == columns
    got = sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)
    expected = sorted((tuple(r) for r in relation.project(", ".join(f'"{c}"' for c in columns)).fetchall()), key=repr)
    assert got == expected
