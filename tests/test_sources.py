"""Zip archives member by member, and relational tables in shares by predicates."""

import datetime
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from saltmarsh.sources import tables, zipped


def archive(*named, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, text in named:
            z.writestr(name, text)
    return out.getvalue()


def test_members_are_read_in_several_tasks(spark):
    data = archive(*[(f"m{i}.csv", "a,b\n" + "".join(f"{i},{k}\n" for k in range(50))) for i in range(60)])
    rows = zipped.records(spark.createDataFrame([("f.zip", data)], "path string, content binary").coalesce(1))
    got = rows.withColumn("task", F.spark_partition_id())
    assert got.select("task").distinct().count() > 2
    assert got.where("error is null").groupBy("member").count().where("count = 50").count() == 60


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2])
def test_large_members_and_repeated_names(spark, method):
    text = "a,b\n" + "".join(f"{i},{'x' * 50}\n" for i in range(40_000))
    data = archive(("d/", ""), ("big.csv", text), ("big.csv", "a,b\n7,y\n"), method=method)
    df = zipped.read_zipped_csv(spark.createDataFrame([("f.zip", data)], "path string, content binary"), "a int, b string")
    assert df.count() == 40_001 and df.agg(F.sum("a")).first()[0] == sum(range(40_000)) + 7


def test_what_is_damaged_costs_its_own_rows(spark):
    whole = archive(("a.csv", "h\n1\n"), ("b.csv", "h\n" + "2\n" * 30_000), ("c.csv", "h\n3\n"))
    place = whole.find(b"b.csv") + 5
    torn = whole[: place + 20] + b"\xff" * 8 + whole[place + 28 :]
    other = archive(("x.csv", "h\n4\n"), method=zipfile.ZIP_LZMA)
    rows = [("ok.zip", whole), ("torn.zip", torn), ("none.zip", b"not a zip"), ("empty.zip", b""), ("lzma.zip", other), ("null.zip", None), ("cut.zip", whole[:-30])]
    df = spark.createDataFrame(rows, "path string, content binary")
    got = zipped.read_zipped_csv(df, "a int", error="error").groupBy("path", "member").agg(F.sum("a").alias("s"), F.max("error").alias("e")).collect()
    by = {(r.path, r.member): (r.s, r.e) for r in got}
    assert by["ok.zip", "a.csv"] == (1, None) and by["ok.zip", "b.csv"] == (60_000, None) and by["torn.zip", "a.csv"] == (1, None) and by["torn.zip", "c.csv"] == (3, None)
    assert "damaged" in by["torn.zip", "b.csv"][1] and "no archive" in by["none.zip", None][1] and "no archive" in by["empty.zip", None][1] and "no archive" in by["cut.zip", None][1]
    assert "method" in by["lzma.zip", "x.csv"][1] and not [k for k in by if k[0] == "null.zip"]
    with pytest.raises(Exception, match="zip: none.zip"):
        zipped.read_zipped_csv(df.where("path = 'none.zip'"), "a int").select("a").collect()


def test_jdbc_shares_cover_the_table_and_are_applied_by_the_source(spark):
    url = "jdbc:derby:memory:shares;create=true"
    rows = spark.range(100).select(F.concat(F.lit("k"), "id").alias("k"), F.when(F.col("id") % 10 > 0, F.timestamp_seconds(F.col("id") * 43_200)).alias("at"))
    try:
        rows.write.option("createTableColumnTypes", "k VARCHAR(20)").jdbc(url, "events", mode="overwrite")
    except Exception as e:  # noqa: BLE001
        pytest.skip(f"no embedded database: {type(e).__name__}")
    first, last = datetime.date(1970, 1, 5), datetime.date(1970, 2, 10)
    by_day = tables.date_ranges('"at"', first, last, 10, "TIMESTAMP('{} 00:00:00')")
    by_key = tables.key_shares('LENGTH("k")', 3)
    for shares in (by_day, by_key, tables.date_ranges('"at"', first, first, 10)):
        df = tables.jdbc_shares(spark, url, "events", shares)
        assert df.rdd.getNumPartitions() == len(shares) and df.count() == 100 == df.distinct().count()
        sizes = df.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()
        assert len(shares) == 1 or max(sizes) < 100
        plan = df.where(F.col("k") > "k5")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(k,k5)" in plan
        assert df.where(F.col("k") > "k5").count() == rows.where(F.col("k") > "k5").count()
    assert len(by_day) == 4
