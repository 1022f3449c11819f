"""Block shuffle: each row once an epoch, another order per epoch, no range exchange."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelfold.operators import block_order as bo


def ordered(df):
    """Keys in partition order, as a reader that takes partition after partition sees them."""
    return [r.id for r in df.select("id").collect()]


@pytest.mark.parametrize("side", [1, 2, 3, 7, 20])
def test_permutation_is_one_to_one(spark, side):
    for epoch in (0, 1):
        rows = spark.range(side * side).select(bo.permuted(F.col("id"), side, 42, epoch).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(side * side))


def test_each_row_once_in_the_stated_order(spark):
    df = spark.range(4000).withColumn("other", F.lit("x"))
    for epoch in (0, 1):
        s = bo.shuffle_blocks(df, "id", side=8, epoch=epoch, partitions=5)
        assert s.columns == ["id", "other", "block", "place", "shuffle_key"] and s.rdd.getNumPartitions() == 5
        keys = ordered(s)
        assert sorted(keys) == list(range(4000))
        assert keys == ordered(s.coalesce(1).orderBy("place", "shuffle_key", "id"))


def test_orders_differ_and_are_unrelated(spark):
    df = spark.range(6000)
    a, b = (ordered(bo.shuffle_blocks(df, "id", side=16, epoch=e)) for e in (0, 1))
    assert a == ordered(bo.shuffle_blocks(df.repartition(13), "id", side=16, epoch=0))
    place = np.empty((2, 6000))
    for i, keys in enumerate((a, b)):
        place[i, keys] = np.arange(6000)
    assert abs(np.corrcoef(place[0], np.arange(6000))[0, 1]) < 0.05
    assert abs(np.corrcoef(place[0], place[1])[0, 1]) < 0.2  # blocks of 256 stay together


def test_plan_has_no_range_exchange(spark):
    plan = bo.shuffle_blocks(spark.range(10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange") == 1


def test_odd_rows(spark):
    df = spark.createDataFrame([(None,), (None,), (3,), (3,)], "id long")
    assert sorted(map(str, ordered(bo.shuffle_blocks(df, "id", side=2)))) == ["3", "3", "None", "None"]
    assert ordered(bo.shuffle_blocks(df.limit(0), "id")) == []
