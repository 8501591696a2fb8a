import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators.components import connected_components, star_edges

from .conftest import rows


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for g, a, b in edges:
        if a != b:
            x, y = find((g, a)), find((g, b))
            parent[max(x, y)] = min(x, y)
    return sorted(((g, n, find((g, n))[1]) for g, n in parent), key=repr)


@pytest.mark.parametrize("options", [{}, {"small_bytes": 0, "hot_rows": 5}])
def test_random_graphs(spark, options):
    random.seed(3)
    edges = [(random.choice("xy"), random.randint(0, 120), random.randint(0, 120)) for _ in range(110)]
    edges += [("x", 500, i) for i in range(501, 540)]  # a hub
    edges += [("y", i, i + 1) for i in range(900, 960)]  # a long chain
    df = spark.createDataFrame(edges, "g string, src long, dst long")
    assert rows(connected_components(df, ["g"], **options)) == union_find(edges)
    again = df.orderBy(F.rand(5)).select("g", F.col("dst").alias("src"), F.col("src").alias("dst"))
    assert rows(connected_components(again, ["g"], **options)) == union_find(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([(1, 1)], "src long, dst long")).count() == 0


def test_star_edges_grow_with_members(spark):
    members = spark.range(1000).select(F.lit("hot").alias("bucket"), F.col("id").alias("node"))
    assert star_edges(members, ["bucket"], "node").count() <= 2 * 1000
