import os

from pyspark.sql import functions as F

from newsloom.operators.components import connected_components
from newsloom.session import SHUFFLE_CLEANUP, discard, materialize, scratch, shared_dir

from .conftest import rows


def stored(spark):
    folder = f"{shared_dir(spark)}/newsloom"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_tables_of_a_block_go_but_for_those_that_are_kept(spark):
    before = stored(spark)
    with scratch(spark):
        with scratch(spark) as keep:
            one = materialize(spark.range(10), "one")
            two = materialize(one.where("id > 3"), "two")
            result = keep(two.groupBy((F.col("id") % 2).alias("k")).count())
        assert {name.split("-")[0] for name in stored(spark) - before} == {"two"}
        assert rows(result) == [(0, 3), (1, 3)]
    assert stored(spark) == before


def test_a_block_that_fails_leaves_nothing(spark):
    before = stored(spark)
    try:
        with scratch(spark):
            materialize(spark.range(3), "lost")
            raise KeyError
    except KeyError:
        pass
    assert stored(spark) == before


def test_empty_tables_are_kept(spark):
    with scratch(spark) as keep:
        empty = keep(materialize(spark.range(3).where("id > 5"), "empty"))
    assert rows(empty) == []
    discard(empty)


def test_component_rounds_leave_one_table(spark):
    before = stored(spark)
    chain = spark.range(200).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = connected_components(chain)
    assert found.where("component <> 0").count() == 0 and found.count() == 201
    left = stored(spark) - before
    assert [name.split("-")[0] for name in left] == ["edges"]


def test_shuffles_of_a_stored_table_go_and_the_setting_stays(spark):
    usual = spark.conf.get(SHUFFLE_CLEANUP, None)
    table = materialize(spark.range(1000).repartition(3), "shuffled")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == usual
    assert table.count() == 1000
