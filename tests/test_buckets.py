"""Merges by buckets of keys, and the click stream with identities."""

import glob

from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.operators import merge
from saltmarsh.plans import dims
from saltmarsh.sources import buckets, tables
from saltmarsh.streaming import clicks as stream

SCHEMA = T.StructType().add("k", "long").add("at", "integer").add("v", "string")


def files(path):
    return {f.split("/data/")[1]: f for f in glob.glob(f"{path}/data/*/*/part-*")}


def current(t):
    return {f"version={v}/bucket={b}" for b, v in t.versions().items()}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = buckets.BucketTable(spark, str(tmp_path), SCHEMA, ["k"], 16).create()
    assert t.read().count() == 0
    t.update(spark.createDataFrame([], SCHEMA), lambda a, b: a)
    first = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("at"), F.lit("old").alias("v"))
    newer = lambda a, b: merge.merge_newer(a, b, ["k"], "at")
    t.update(first, newer)
    before, names = current(t), files(tmp_path)
    assert len(before) == 16 and t.read().count() == 200
    sent = spark.createDataFrame([(5, 2, "new"), (6, 0, "late"), (1000, 1, "added")], SCHEMA)
    touched = {r.b for r in sent.select(t.bucket().alias("b")).collect()}
    t.update(sent, newer)
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 201 and got[5] == "new" and got[6] == "old" and got[1000] == "added"
    assert len(before & current(t)) == 16 - len(touched)
    assert names.keys() <= files(tmp_path).keys()  # old files keep their names, and stay for whoever reads them
    read = {f.split("/data/")[1] for f in t.read().inputFiles()}
    assert {f for f in read if f.startswith("version=1/")} < names.keys()
    assert t.vacuum() == len(touched) and t.read().count() == 201 and t.vacuum() == 0


def test_rows_without_keys_are_spread_and_a_cut_off_change_is_not_seen(spark, tmp_path):
    t = buckets.BucketTable(spark, str(tmp_path), SCHEMA, ["k"], 4).create()
    rows = spark.range(40).select(F.lit(None).cast("long").alias("k"), F.col("id").cast("int").alias("at"), F.lit("x").alias("v"))
    t.update(rows, lambda a, b: merge.merge_newer(a, b, ["k"], "at"))
    assert len(t.versions()) == 4 and t.read().count() == 40
    rows.withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{tmp_path}/data/version=2")
    assert t.read().count() == 40
    t.update(spark.createDataFrame([(1, 1, "a")], SCHEMA), lambda a, b: merge.merge_newer(a, b, ["k"], "at"))
    assert t.read().count() == 41


def test_stream_merges_into_buckets_as_into_versions(spark, tmp_path):
    for n in range(3):
        spark.range(n * 5, n * 5 + 10).select(F.col("id").alias("k"), F.lit(n).alias("at"), F.lit(f"b{n}").alias("v")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    target = spark.createDataFrame([(3, 1, "t"), (None, 1, "n")], SCHEMA)
    results = []
    for name, t in (("v", tables.VersionedTable(spark, f"{tmp_path}/v")), ("b", buckets.BucketTable(spark, f"{tmp_path}/b", SCHEMA, ["k"], 8).create())):
        t.replace(target) if name == "v" else t.update(target, lambda _, rows: rows)
        stream.merge_stream(t, stream.read_stream(spark, f"{tmp_path}/in", SCHEMA, 1), ["k"], "at", f"{tmp_path}/c{name}")
        results.append(sorted(map(tuple, t.read().collect()), key=repr))
    assert results[0] == results[1] and len(results[0]) == 21


def test_redelivered_clicks_count_once_and_state_is_dropped(spark, tmp_path):
    kinds = "event_id long, user_id long, session_id long, time timestamp_ntz, product_id int, event string, domain string"
    base = [(i, i % 3, 1, f"2024-01-{10 + i % 5:02d} 10:00:00", 7, "product_view_pdp" if i % 4 else "other", "a.example" if i % 2 else "b.example") for i in range(20)]
    for rows in (base[:12], base[4:], base, [base[3]] * 3):
        spark.createDataFrame(rows, kinds.replace("timestamp_ntz", "string")).withColumn("time", F.col("time").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    users = spark.createDataFrame([(0, 100), (0, 101), (0, 101), (1, 102)], "user_id long, identity long")
    counts = stream.daily_identity(stream.read_stream(spark, f"{tmp_path}/in", T.StructType.fromDDL(kinds), 1), users, dims.markets(spark), "product_view_pdp", "2024-01-20", late="30 days")
    updates = stream.MarketUpdates(spark, f"{tmp_path}/out")
    stream.run_to_end(counts, f"{tmp_path}/c", updates.each)
    got = sorted(tuple(r) for r in updates.latest(counts.schema, "product_view_pdp").select("country", "user_id", "identity", "product_view_pdp").collect())
    want = {}
    for _, u, _, t, _, e, site in base:
        if e == "product_view_pdp":
            for i in {0: (100, 101), 1: (102,), 2: (None,)}[u]:
                k = ("alpha" if site[0] == "a" else "beta", u, i, t)
                want[k] = want.get(k, 0) + 1
    assert sorted(map(repr, got)) == sorted(repr((c, u, i, n)) for (c, u, i, _), n in want.items())
    assert glob.glob(f"{tmp_path}/out/batch=*/country=alpha/part-*")
