"""First loads, empty days, stored schemas, observed writes, JSON of any length, laid-out tables, partition files."""

import datetime
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.functions import names
from saltmarsh.functions.bounded import small
from saltmarsh.operators import gates, merge, value
from saltmarsh.plans import catalog, dims
from saltmarsh.plans.standins import view
from saltmarsh.sources import layout, schemas, tables

DATA = "/root/testdata/sf0.001"
KEY = {"source_system": "a", "schema_name": "b", "table_name": "c"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_append_load_takes_all_and_stays_started(spark, tmp_path):
    kinds = "k long, at date"
    marks, t = tables.VersionedTable(spark, f"{tmp_path}/marks"), tables.VersionedTable(spark, f"{tmp_path}/t")
    marks.replace(spark.createDataFrame([], merge.WATERMARKS))
    t.replace(spark.createDataFrame([], kinds))
    for rows, want in (([], 0), ([(1, datetime.date(2024, 1, 2)), (2, None)], 2), ([(1, datetime.date(2024, 1, 1)), (3, datetime.date(2024, 1, 3))], 3)):
        after = merge.get_watermark(marks, KEY, t.read(), "at")
        new = tables.extract(spark.createDataFrame(rows, kinds), "append", "at", after and F.lit(after))
        seen = t.replace(merge.merge_newer(t.read(), new, ["k"], "at"), latest=merge.latest("at"))
        merge.store_watermark(marks, KEY, seen["latest"])
        assert t.read().count() == want == seen["rows"]
    assert merge.get_watermark(marks, KEY, t.read(), "at") == datetime.datetime(2024, 1, 3)
    # A NULL that was stored earlier is none.
    marks.replace(merge.watermark_row(spark, KEY, None))
    assert merge.get_watermark(marks, KEY, t.read(), "at") == datetime.datetime(2024, 1, 3)
    source = spark.createDataFrame([(1, None)], kinds)
    assert tables.extract(source, "append", "at", F.lit(None).cast("timestamp")).count() == 1


def test_observed_watermark_reads_the_table_once_less(spark, tmp_path):
    t = tables.VersionedTable(spark, f"{tmp_path}/t")
    seen = t.replace(spark.range(10).select("id", F.timestamp_seconds("id").alias("at")), latest=merge.latest("at"), even=F.count_if(F.col("id") % 2 == 0))
    assert seen == {"rows": 10, "latest": datetime.datetime(1970, 1, 1, 0, 0, 9), "even": 5}
    assert t.replace(spark.range(0))["rows"] == 0


def test_observed_gate(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (10, 202401, DATE '2024-01-05'), (30, 202401, DATE '2024-01-03'), (30, 202312, DATE '2024-01-09') AS t(oper_aff_id, ord_mo_yr_id, ord_dt)")
    seen = tables.write_observed(rows, f"{tmp_path}/t", **gates.last_orders([10, 30, 70], 202401))
    for day in ("2024-01-03", "2024-01-04"):
        assert gates.demand_complete_of(seen, [10, 30, 70], day) == (not gates.demand_complete(rows, [10, 30, 70], 202401, day).isEmpty())


def test_publishing_a_day_on_which_nothing_came(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, v string, day int")
    schema = T.StructType.fromDDL("id long, v string")
    rows.write.partitionBy("day").parquet(f"{tmp_path}/final")
    os.makedirs(f"{tmp_path}/in/day=1")
    for stored in (None, schema):
        tables.publish_partition(spark, f"{tmp_path}/in", f"{tmp_path}/final", "parquet", "day=1", stored)
        assert [r.id for r in spark.read.schema(rows.schema).parquet(f"{tmp_path}/final").collect()] == [2]
    tables.publish_partition(spark, f"{tmp_path}/in", f"{tmp_path}/final", "parquet", "day=7", schema)
    assert not os.path.exists(f"{tmp_path}/final/day=7")


def test_publishing_several_formats_side_by_side(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(f"{tmp_path}/in/p")
    spark.createDataFrame([(2, "b")], "id long, v string").write.mode("append").option("header", False).csv(f"{tmp_path}/in/p")
    spark.createDataFrame([("junk",)], "v string").write.mode("append").text(f"{tmp_path}/in/p")
    schema = T.StructType.fromDDL("id long, v string")
    for _ in range(2):
        tables.publish_partition(spark, f"{tmp_path}/in", f"{tmp_path}/final", ("avro", "parquet", "csv"), "p", schema)
    kinds = sorted({f.rsplit(".", 1)[-1] for f in glob.glob(f"{tmp_path}/final/p/part-*")})
    assert kinds == ["csv", "parquet"] and len(glob.glob(f"{tmp_path}/final/p/part-*")) == 2
    assert tables._incoming(spark, f"{tmp_path}/final/p", "csv", schema).collect() == [(2, "b")]


def test_partitions_published_in_one_job_and_empty_ones_cleared(spark, tmp_path):
    kinds = "id long, day int"
    schema = T.StructType.fromDDL(kinds)
    spark.createDataFrame([(1, 1), (2, 2), (3, 3)], kinds).write.partitionBy("day").parquet(f"{tmp_path}/final")
    tables.publish_partitions(spark, f"{tmp_path}/none", f"{tmp_path}/final", "parquet", "day", schema, ("3",))
    spark.createDataFrame([(10, 1), (11, 1)], kinds).write.partitionBy("day").parquet(f"{tmp_path}/in")
    tables.publish_partitions(spark, f"{tmp_path}/in", f"{tmp_path}/final", "parquet", "day", schema, ("1", "9"))
    assert sorted(r.id for r in spark.read.schema(schema).parquet(f"{tmp_path}/final").collect()) == [2, 10, 11]


def test_files_of_a_day_do_not_grow_with_tasks(spark, tmp_path):
    rows = spark.range(20_000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"))
    for tasks in (2, 24):
        tables.write_day_partitions(rows.repartition(tasks), f"{tmp_path}/{tasks}", F.col("d"))
        tables.export_market_csv(rows.withColumn("d", F.col("d").cast("string")).repartition(tasks), f"{tmp_path}/csv{tasks}", "d")
        assert len(glob.glob(f"{tmp_path}/{tasks}/*/*/*/part-*")) == len(glob.glob(f"{tmp_path}/csv{tasks}/*/part-*")) == 40
        assert spark.read.parquet(f"{tmp_path}/{tasks}").count() == 20_000
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(tables.by_day(rows, F.col("d")))


def test_large_days_are_written_by_several_tasks(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(200_000).select(F.uuid().alias("v"), F.when(F.col("id") % 10 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("date").alias("d"))
        tables.write_day_partitions(rows.repartition(16), f"{tmp_path}/t", F.col("d"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(glob.glob(f"{tmp_path}/t/*/*/day=01/part-*")) > 4


def test_schema_store_infers_once_and_enforces(spark, tmp_path):
    store = schemas.SchemaStore(spark, f"{tmp_path}/s").create()
    assert store.get(KEY) is None
    first = spark.sql("SELECT CAST(1 AS BIGINT) AS Id, 'x' AS Name, TIMESTAMP '2024-01-01' AS At")
    assert store.enforce(KEY, first).dtypes == [("id", "bigint"), ("name", "string"), ("at", "date")]
    second = spark.sql("SELECT * FROM VALUES ('7', TIMESTAMP '2024-01-02 10:00:00', 1.5D), ('x', NULL, NULL), (NULL, NULL, 2D) AS t(ID, AT, EXTRA)")
    got = store.enforce(KEY, second)
    assert got.dtypes == [("id", "bigint"), ("name", "string"), ("at", "date")]
    assert {tuple(r) for r in got.collect()} == {(7, None, datetime.date(2024, 1, 2)), (None, None, None)}
    rows = {tuple(r) for r in schemas.drift(store.get(KEY), second).collect()}
    assert rows == {("name", "lost", "string", None, 3, 0), ("id", "retyped", "bigint", "string", 3, 1), ("at", "retyped", "date", "timestamp", 3, 0), ("extra", "new", None, "double", 3, 0)}
    assert schemas.drift(store.get(KEY), got).isEmpty() and schemas.drift(store.get(KEY), got).columns == schemas.drift(store.get(KEY), second).columns
    assert [f.name for f in store.evolve(KEY, second, retyped=("id",)).fields] == ["id", "name", "at", "extra"]
    assert store.get(KEY)["id"].dataType == T.StringType() and store.get(KEY, 1)["id"].dataType == T.LongType()
    assert store.get({**KEY, "table_name": "other"}) is None
    store.put({**KEY, "table_name": "other"}, T.StructType())
    assert len(store.get(KEY).fields) == 4


def _json(spark, texts, **kw):
    return [r.j for r in spark.createDataFrame([(t,) for t in texts], "j string").select(names.sanitize_json(F.col("j"), **kw).alias("j")).collect()]


def test_json_of_any_length(spark):
    long = 'x\\"y: \\\\' * 200_000
    text = '{"a b":"' + long + '", "c-d":[' + '{"e f":1},' * 20_000 + "1.50e3]}"
    (got,) = _json(spark, [text])
    assert len(text) > 1_500_000 and got == text.replace('"a b"', '"a_b"').replace('"c-d"', '"c_d"').replace('"e f"', '"e_f"')
    (deep,) = _json(spark, ['{"a b":' * 300 + "1" + "}" * 300])
    assert json.loads(deep)["a_b"]["a_b"]


def test_json_that_breaks_or_collides(spark):
    assert _json(spark, [None, '{"a":"x', '{"a b":1', "[1,", "", "{'a b':1}", "nonsense", '"a b"', "12", '{"\\u0061 b":1, "\\"":2}', '{ "a b" :\n{"c d"  : "e f:"}}']) == [None] * 7 + ['"a b"', "12", '{"a_b":1, "_":2}', '{ "a_b":\n{"c_d": "e f:"}}']
    for bad in ('{"a_b":1,"a b":2}', '{"x":[{"a":1,"a":2}]}'):
        with pytest.raises(Exception, match="MALFORMED_RECORD|VARIANT_DUPLICATE_KEY"):
            _json(spark, [bad])
    with pytest.raises(Exception, match="not JSON"):
        _json(spark, ['{"a":"x'], strict=True)
    one = spark.createDataFrame([('{"a b":{"c d":[1,2]}}',)], "j string").select(names.sanitize_variant(F.col("j")).alias("v"))
    assert one.selectExpr("variant_get(v, '$.a_b.c_d[1]', 'int') x").first().x == 2


def test_laid_out_tables_are_pruned_and_joined_as_they_lie(spark, tmp_path):
    stage = value.order_stage(view(spark, DATA, "demand"))
    orders = spark.table(layout.lay_out(stage, f"{tmp_path}/o", value.ACCOUNT, 3, value.MONTH))
    members = spark.table(layout.lay_out(stage.select(value.ACCOUNT).distinct(), f"{tmp_path}/m", value.ACCOUNT, 3))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = value.spend_of(orders, members, 199701, 199712)
        text = plan(df)
        assert df.count() == stage.where("ord_mo_yr_id between 199701 and 199712").select(value.ACCOUNT).distinct().count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in text.replace("InputAdapter", "") and "SortMergeJoin" in text and "Bucketed: true" in text
    assert "PartitionFilters: [isnotnull(ord_mo_yr_id" in text
    months = spark.read.parquet(f"{tmp_path}/o").inputFiles()
    assert len({os.path.basename(f).split("_")[-1] for f in months}) <= 3
    empty = layout.lay_out(stage.where("false"), f"{tmp_path}/e", value.ACCOUNT, 3, value.MONTH)
    assert spark.table(empty).count() == 0


def test_fixed_dimensions_are_local_and_nothing_is_counted(spark):
    for df in (dims.market_affiliates(spark), dims.schedule_groups(spark), dims.markets(spark)):
        assert "LocalRelation" in df._jdf.queryExecution().optimizedPlan().toString()
        spark.sparkContext.setJobGroup("dims", "dims")
        small(df)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("dims")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert not jobs
    assert [r.url for r in dims.markets(spark, "country,url,months\no'neil,x'y,3").collect()] == ["x'y"]


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(40_000).repartition(2).select(*[F.concat(F.lit("x"), F.col("id")).alias(f"c{k}") for k in range(60)])
    assert "hint" not in small(wide)._jdf.queryExecution().logical().toString().lower()


def test_names_of_the_same_query_are_gone():
    assert not [n for n in catalog.queries() if n.endswith("_all")]
