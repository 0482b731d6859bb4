"""Hot shipping accounts."""

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import skew


@pytest.fixture
def shuffled(spark):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_one_account_of_all_countries_fills_no_task(spark, shuffled):
    lines = spark.range(110_000).select("id", F.when(F.col("id") < 100_000, F.lit(7)).otherwise(F.col("id") % 500).alias("k"), (F.col("id") % 25).alias("country"))
    accounts = spark.range(25).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("c")).union(spark.range(500).select(F.col("id").alias("k"), F.lit(0).alias("c")))
    got = skew.spread_join(lines, accounts, "k", bound=10_000)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * sum(sizes) / 8 and len(sizes) == 8
    plain = lines.join(accounts, "k", "left")
    assert got.columns == plain.columns and got.exceptAll(plain).isEmpty() and sum(sizes) == plain.count()
    one = max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    assert one > 6 * sum(sizes) / 8


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_the_plain_one(spark, how):
    left = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "b", 2), (None, "n", 1), (2, "c", 1), (3, "d", 9)] * 5, "k int, v string, x int")
    right = spark.createDataFrame([(1, "p", 1), (1, "q", 2), (2, "r", 1), (None, "s", 1), (4, "t", 1)], "k int, w string, y int")
    for bound in (1, 3, 10**6):
        got = skew.spread_join(left, right, "k", F.col("x") == F.col("y"), how, bound)
        l, r = left.alias("l"), right.alias("r")
        want = l.join(r, (F.col("l.k") == F.col("r.k")) & (F.col("x") == F.col("y")), how).select("l.*", "w", "y")
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    assert skew.spread_join(left.limit(0), right, "k", how=how).count() == 0
    with pytest.raises(ValueError, match="full"):
        skew.spread_join(left, right, "k", how="full")
