import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from newsloom.operators import keyed

from .conftest import rows


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    random.seed(1)
    left = [(random.choice([1, 1, 1, 1, 2, 3, 4, None]), i) for i in range(600)]
    right = [(1, "a"), (1, "b"), (2, "c"), (None, "n"), (9, "z")]
    l, r = spark.createDataFrame(left, "k int, i int"), spark.createDataFrame(right, "k int, v string")
    got = keyed.salted_join(l, r, ["k"], how, hot_rows=50, salts=5, small_bytes=0)
    assert rows(got) == rows(l.join(r, "k", how))


def test_salted_join_spreads_the_hot_key(spark):
    l = spark.range(4000).select(F.lit(1).alias("k"), "id")
    r = spark.createDataFrame([(1, "a")], "k int, v string")
    got = keyed.salted_join(l, r, ["k"], hot_rows=100, salts=16, small_bytes=0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and got.count() == 4000


def test_hot_keys_are_bounded(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert keyed.hot_keys(df, ["k"], hot_rows=100, max_keys=3).count() == 3
    assert keyed.hot_keys(df, ["k"], hot_rows=101).count() == 0


def test_small_right_side_is_not_shuffled(spark):
    l, r = spark.range(100), spark.range(5)
    assert "_salt" not in keyed.salted_join(l, r, ["id"])._jdf.queryExecution().toString()


@pytest.mark.parametrize("bits", [0, 2, 5, 40])
def test_number_in_group(spark, bits):
    random.seed(2)
    data = [(random.choice("aaab"), pos, sub) for pos in random.sample(range(1000), 200) for sub in range(random.randint(1, 3))]
    df = spark.createDataFrame(data, "g string, pos long, sub int")
    plain = df.withColumn("number", F.row_number().over(Window.partitionBy("g").orderBy("pos", "sub")).cast("long"))
    assert rows(keyed.number_in_group(df, ["g"], ["pos", "sub"], chunk_bits=bits)) == rows(plain)


def test_number_all(spark):
    names = [f"n{random.randint(0, 10**6)}" for _ in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.name for r in keyed.number_all(df, ["name"]).orderBy("number").collect()]
    assert got == sorted(names)
    assert rows(keyed.number_all(df, ["name"]).select("number")) == [(i,) for i in sorted(range(1, 501), key=lambda x: repr((x,)))]


def test_pack(spark):
    df = spark.createDataFrame([("a", i, f"v{i}") for i in range(1, 8)] + [("b", 1, "w")], "k string, n long, v string")
    got = rows(keyed.pack(df, ["k"], "n", F.col("v"), 3, "vs"))
    assert got == [("a", 0, ["v1", "v2", "v3"]), ("a", 1, ["v4", "v5", "v6"]), ("a", 2, ["v7"]), ("b", 0, ["w"])]


def test_spread_leaves_large_input_alone(spark):
    df = spark.range(100)
    assert keyed.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert keyed.spread(df, task_bytes=1) is df
