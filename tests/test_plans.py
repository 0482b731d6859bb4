"""What the plans look like, and the sources that need a running partner."""

import re

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import sized
from saltmarsh.functions.bounded import small
from saltmarsh.operators import clicks, features, value
from saltmarsh.plans import catalog, dims
from saltmarsh.plans.shared import scratch
from saltmarsh.plans.standins import view
from saltmarsh.sources import layout, tables
from saltmarsh.streaming import clicks as stream

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    text = plan(features.rfm_monthly(view(spark, DATA, "demand"), dims.market_affiliates(spark), 199601))
    assert "l_shipdate" not in text and "o_comment" not in text and "BroadcastHashJoin" in text


def test_markets_are_one_broadcast_join(spark):
    text = plan(clicks.search_terms(view(spark, DATA, "clicks"), dims.markets(spark), "2024-01-20"))
    assert text.count("FileScan") == 1 and "BroadcastHashJoin" in text and "CartesianProduct" not in text


def test_only_small_sides_are_broadcast_and_none_is_cut(spark):
    side, rows = spark.range(50), spark.range(1000).withColumn("id", F.col("id") % 100)
    assert "hint" in small(side, 50)._jdf.queryExecution().logical().toString().lower()
    assert "hint" not in small(side, 49)._jdf.queryExecution().logical().toString().lower()
    assert rows.join(small(side, 49), "id").count() == rows.join(small(side, 50), "id").count() == 500


def test_early_accounts_read_orders_once(spark):
    orders = value.order_stage(view(spark, DATA, "demand"))
    assert plan(value.early_active(orders, 199601, 199712)).count("FileScan") == plan(orders).count("FileScan")


def test_metrics_have_one_window_sort_per_account(spark):
    text = plan(value.demand_metrics(value.order_stage(view(spark, DATA, "demand"))))
    assert "CartesianProduct" not in text and "SinglePartition" not in text


def test_jdbc_reads_in_ranges(spark):
    url = "jdbc:derby:memory:source;create=true"
    try:
        spark.range(100).withColumn("v", F.col("id") * 2).write.jdbc(url, "numbers", mode="overwrite")
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"no embedded database: {type(e).__name__}")
    df = tables.jdbc(spark, url, "numbers", "id", 0, 100, 4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    newer = tables.extract(df, "append", "id", F.lit(89))
    assert newer.count() == 10 and "GreaterThan(ID,89)" in plan(newer).upper().replace("GREATERTHAN", "GreaterThan")


def test_versions_switch_whole(spark):
    t = tables.VersionedTable(spark, scratch(spark))
    t.replace(spark.range(5).toDF("a"))
    old = t.read()
    t.replace(t.read().where("a < 2"))
    assert t.read().count() == 2 and old.count() == 5


def test_stream_restarts_from_its_checkpoint(spark):
    path = scratch(spark)
    spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS ts, 1L AS user_id, 'view' AS event_type").write.parquet(f"{path}/in")
    got = []

    def run():
        events = stream.read_stream(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema)
        stream.run_to_end(stream.daily_counts(events), f"{path}/state", lambda df, _: got.extend((r.user_id, r.n) for r in df.collect()))

    run()
    spark.sql("SELECT timestamp_ntz'2024-01-01 11:00:00' AS ts, 1L AS user_id, 'view' AS event_type").write.mode("append").parquet(f"{path}/in")
    run()
    assert got == [(1, 1), (1, 2)]


def test_stream_counts_all_rows_of_many_files(spark):
    """More files than a batch takes, in an order that has nothing to do with time."""
    path = scratch(spark)
    spark.read.parquet(f"{DATA}/events.parquet").repartition(210).write.parquet(f"{path}/events.parquet")
    events = spark.read.parquet(f"{path}/events.parquet")
    assert len(events.inputFiles()) > 200  # the watermark of a batch drops rows from the second batch after it on
    got = catalog.queries()["stream_daily_counts"](spark, path)
    want = events.groupBy(F.to_date("ts").alias("day"), "user_id", "event_type").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_identities_take_few_batches_of_many_files(spark, tmp_path, monkeypatch):
    """Each batch sends something to the driver, so there are no more of them as the table grows."""
    rows = spark.read.parquet(f"{DATA}/events.parquet")
    rows.repartition(40).write.parquet(f"{tmp_path}/events.parquet")
    batches, plain = [], stream.MarketUpdates.each
    monkeypatch.setattr(stream.MarketUpdates, "each", lambda self, batch, n: batches.append(n) or plain(self, batch, n))
    got = catalog.queries()["stream_daily_identity"](spark, str(tmp_path))
    want = catalog.queries()["click_daily_identity"](spark, DATA)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert 1 < len(batches) <= catalog.IDENTITY_BATCHES


@pytest.mark.parametrize("name", ["award_class", "demand_daily", "demand_metrics", "minmax_scaled", "metrics_joined", "order_base"])
def test_shuffles_follow_the_order_lines(spark, monkeypatch, name):
    monkeypatch.setattr(sized, "FILE_BYTES", 10_000)
    before = dict(spark.conf.getAll)
    text = plan(catalog.queries()[name](spark, DATA))
    assert int(re.search(r"hashpartitioning\([^)]*, (\d+)\)", text).group(1)) > 10
    assert dict(spark.conf.getAll) == before


def test_buckets_follow_the_order_lines(spark, monkeypatch):
    made, plain = [], layout.lay_out
    monkeypatch.setattr(catalog, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(layout, "lay_out", lambda df, path, by, n, *a: made.append(n) or plain(df, path, by, n, *a))
    rows = catalog.queries()["laid_out_spend"](spark, DATA).collect()
    assert len(made) == 2 and made[0] == made[1] > catalog.BUCKETS
    monkeypatch.undo()
    assert sorted(rows) == sorted(catalog.queries()["laid_out_spend"](spark, DATA).collect())
