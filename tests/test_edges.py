"""Hand-made frames for the cases that tables don't show."""

import json
import datetime
import io
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.functions import calendar as cal
from saltmarsh.functions import names, typemap
from saltmarsh.functions.coerce import coerce_col, coerce_to, conform, infer_schema
from saltmarsh.operators import gates, merge, metadata, orders, reconcile, value
from saltmarsh.plans import dims
from saltmarsh.plans.shared import scratch
from saltmarsh.sources import tables, zipped
from saltmarsh.streaming import clicks as stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_epoch_millis(spark):
    df = spark.createDataFrame([(None,), (-9_000_000_000_000,), (-2208988800000,), (0,), (1_700_000_000_000,)], "ms long")
    got = [r[0] for r in df.select(coerce_col(F.col("ms"), T.LongType(), T.DateType())).collect()]
    assert got == [None, datetime.date(1900, 1, 1), datetime.date(1900, 1, 1), datetime.date(1970, 1, 1), datetime.date(2023, 11, 14)]


def test_coerce_matches_by_name_and_nulls_what_fails(spark):
    target = T.StructType.fromDDL("a int, b date, c string")
    df = spark.createDataFrame([("x", "7"), ("2024-01-02", "y")], "B string, A string")
    assert rows(coerce_to(df, target)) == [(7, None, None), (None, datetime.date(2024, 1, 2), None)]
    with pytest.raises(PySparkException):
        coerce_to(df, target, strict=("a",)).collect()


def test_merge_newer(spark):
    schema = "k int, v string, at date"
    d = datetime.date
    target = spark.createDataFrame([(1, "old", d(2024, 1, 1)), (2, "old", d(2024, 1, 5)), (3, "old", None), (4, "old", d(2024, 1, 1)), (5, "old", d(2024, 1, 1))], schema)
    incoming = spark.createDataFrame([(1, "new", d(2024, 1, 2)), (2, "new", d(2024, 1, 1)), (3, "new", d(2024, 1, 1)), (4, "new", None), (5, "new", d(2024, 1, 1)), (6, "new", d(2024, 1, 1)), (None, "new", d(2024, 1, 1)), (None, "more", d(2024, 1, 1))], schema)
    got = {(r.k, r.v) for r in merge.merge_newer(target, incoming, ["k"], "at").collect()}
    assert got == {(1, "new"), (2, "old"), (3, "old"), (4, "old"), (5, "old"), (6, "new"), (None, "new"), (None, "more")}
    once = merge.merge_newer(target, incoming.where("k is not null"), ["k"], "at")
    assert rows(merge.merge_newer(once, incoming.where("k is not null"), ["k"], "at")) == rows(once)
    with pytest.raises(PySparkException):
        merge.merge_upsert(target, incoming.union(incoming.where("k = 1")), ["k"]).collect()


def test_delete_keeps_rows_of_unknown_predicate(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    assert rows(merge.delete_where(df, F.col("a") > 1)) == [(1,), (None,)]


def test_watermark_and_checkpoints(spark):
    assert merge.high_watermark(spark.createDataFrame([], "t timestamp"), "t").first()[0] is None
    c = spark.createDataFrame([("s", "t", "x")], "source_system string, table_name string, last_successful_run string")
    key = {"source_system": "s", "table_name": "t"}
    assert merge.get_checkpoint(merge.set_checkpoint(c, key, F.lit("y")), key).first()[0] == "y"
    assert merge.set_checkpoint(c, {"source_system": "other"}, F.lit("y")).first().last_successful_run == "x"


def test_reconciliation_flags(spark):
    base = [(1, "g", 10, e, t, pv, bv) for e, vs in {1: [5, 5, 5, 5], 2: [5, 5, None, 5], 3: [5, 5, 5, 5]}.items() for t, pv, bv in zip(reconcile.TYPES, vs, [9, 9, 9, 9 if e != 3 else 8], strict=True) if pv is not None]
    df = spark.createDataFrame([(*r[:5], float(r[5]), float(r[6])) for r in base], "bns_per_no int, market_group string, aff_no int, bus_entty_no int, vol_type_cd string, pv double, bv double")
    got = reconcile.reconcile(df)
    assert {r.bus_entty_no: r.all_matching for r in got.collect()} == {1: "MATCHED", 2: "UNMATCHED", 3: "UNMATCHED"}
    assert reconcile.unmatched_entities(got).first().bus_entities == "2,3"
    assert reconcile.status(got).first().status == "UNMATCHED"


def test_gates_on_empty_input(spark):
    empty = spark.createDataFrame([], "oper_aff_id int, ord_mo_yr_id int, ord_dt date")
    assert gates.demand_complete(empty, [10], 200001, "2000-02-01").count() == 1
    assert gates.enough_countries(spark.createDataFrame([], "mo_yr_key_no string, cntry_key_no string"), "200001", 1).count() == 0
    assert not gates.nonempty(empty)


def test_minmax_of_one_value_is_null(spark):
    assert value.minmax_scaled(spark.createDataFrame([(1, 5.0)], "a int, demand_pv double")).first().demand_pv is None


def test_shipping_account_joins(spark):
    demand = spark.createDataFrame([(200107, 20010701, 1, 7, 1, 7, 9, 1, 1, 1, "x", 1.0, 1.0), (200107, 20010701, 2, 8, 1, 8, 9, 1, 1, 1, "x", 1.0, 1.0)], "ord_mo_yr_id int, ord_dt_key_no int, ord_id int, global_account_id int, oper_cntry_id int, ord_account_id int, shp_account_id int, ord_item_cd int, ord_item_base_cd int, ord_qty int, account_type_ord string, catalog_ln_usd_net double, adj_ln_usd_net double")
    ordering = spark.createDataFrame([(1, 7, "A")], "cntry_id int, account_id int, bus_natr_cd string")
    shipping = spark.createDataFrame([(1, 9, "B"), (2, 9, "C")], "cntry_id int, account_id int, bus_natr_cd string")
    place = spark.createDataFrame([(1, "one")], "country_no int, country_short_name string")
    got = orders.order_base(demand, ordering, shipping, place, "2001-08-01")
    assert rows(got.select("ord_id", "ship_bus_natr_cd")) == [(1, "B"), (1, "C"), (2, None)]
    strict = orders.order_base(demand, ordering, shipping, place, "2001-08-01", strict_country=True)
    assert rows(strict.select("ord_id", "ship_bus_natr_cd")) == [(1, "B"), (2, "B")]


def test_calendar(spark):
    def at(day, f):
        return spark.range(1).select(f(cal.day(day))).first()[0]

    assert at("2024-02-29", lambda c: F.add_months(c, 12)) == datetime.date(2025, 2, 28)
    assert at("2024-03-07", cal.bonus_period) == "202402" and at("2024-03-08", cal.bonus_period) == "202403"
    index = lambda y, m: y * 12 + m
    assert at("2024-03-08", cal.last_closed_month) == index(2024, 1) and at("2024-03-09", cal.last_closed_month) == index(2024, 2)
    assert at("2024-08-31", cal.performance_year_start) == datetime.date(2023, 9, 1) and at("2024-09-01", cal.performance_year_start) == datetime.date(2024, 9, 1)
    assert at("2024-02-29", lambda c: cal.performance_year_start(c, 1)) == datetime.date(2022, 9, 1)


def test_names(spark):
    df = spark.createDataFrame([((1, [(2,)]), {"x y": 3})], "`a-b` struct<`c d`: int, `e.f`: array<struct<`g h`: int>>>, m map<string, int>")
    got = names.sanitize(df)
    assert got.schema.simpleString() == "struct<a_b:struct<c_d:int,e_f:array<struct<g_h:int>>>,m:map<string,int>>"
    assert got.first().m == {"x_y": 3}
    with pytest.raises(ValueError, match="collide"):
        names.sanitize(spark.createDataFrame([(1, 2)], "`a-b` int, `a.b` int"))


def test_type_maps(spark):
    schema = "table_name string, column_id int, column_name string, data_type string, data_scale double, data_precision int, nullable string"
    df = spark.createDataFrame([("t", 2, "B", "NUMBER", None, 9, "Y"), ("t", 1, "A", "NUMBER", float("nan"), 10, "N"), ("t", 3, "C", "NUMBER", 0.0, 10, "Y"), ("t", 4, "D", "NUMBER", 2.0, 5, "Y"), ("t", 5, "E", "TIMESTAMP(6)", None, None, "Y")], schema)
    assert {r.column_name: (r.type, r.mode) for r in typemap.oracle(df).collect()} == {"A": ("NUMERIC", "REQUIRED"), "B": ("NUMERIC", "NULLABLE"), "C": ("INT64", "NULLABLE"), "D": ("NUMERIC", "NULLABLE"), "E": ("TIMESTAMP", "NULLABLE")}
    assert typemap.java_columns(df.where("not isnan(data_scale) or data_scale is null")).first().columns == "B=Integer, C=Long, D=Double, E=String"
    assert typemap.as400(spark.createDataFrame([("t", 1, "A", "TIMESTMP", None, None, "N")], schema)).first().type == "TIMESTAMP"


def test_zip_members(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("head.csv", "a,b\n")
        z.writestr("none.csv", "")
        z.writestr("three.csv", "a,b\n1,x\n2,y\n3,\"z, z\"\n")
    df = spark.createDataFrame([("f.zip", out.getvalue())], "path string, content binary")
    assert rows(zipped.read_zipped_csv(df, "a int, b string")) == [("f.zip", "three.csv", 1, "x"), ("f.zip", "three.csv", 2, "y"), ("f.zip", "three.csv", 3, "z, z")]


def test_extract_modes_and_push_down(spark):
    path = scratch(spark)
    spark.range(10).selectExpr("id", "timestampadd(DAY, CAST(id AS INT), timestamp_ntz'2024-01-01 12:00:00') AS at").write.parquet(path)
    source = spark.read.parquet(path)
    assert tables.extract(source, "incremental", "at", day="2024-01-03").count() == 1
    newer = tables.extract(source, "append", "at", F.to_timestamp_ntz(F.lit("2024-01-03 12:00:00")))
    assert newer.count() == 7
    assert "PushedFilters: [IsNotNull(at), GreaterThan(at" in newer._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="no mode"):
        tables.extract(source, "other", "at")


def test_inferred_schema(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS D, timestamp_ntz'2024-01-01 01:00:00' AS T, 1 AS N")
    assert infer_schema(df).simpleString() == "struct<d:date,t:timestamp_ntz,n:int>"


def test_inferred_schema_keeps_times_of_late_rows(spark):
    df = spark.range(100_101, numPartitions=1).selectExpr("IF(id < 100100, timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-01 01:00:00') AS at")
    assert infer_schema(df).simpleString() == "struct<at:timestamp_ntz>"
    assert conform(df, infer_schema(df)).where("hour(at) = 1").count() == 1


def test_snapshot_skips_working_datasets(spark):
    df = spark.createDataFrame([("temp_x", "t", "description", "a"), ("sales", "t", "description", "b"), ("sales", "t", "labels", "c")], "table_schema string, table_name string, option_name string, option_value string")
    assert [r.option_value for r in metadata.table_snapshot(df, "2024-01-01").collect()] == ["b"]
    assert metadata.column_snapshot(df, "2024-01-01").count() == 2


def test_market_lists(spark):
    assert dims.affiliates("RENEWAL") == [100, 130, 180, 200, 430, 500]
    assert {r.url: r.months for r in dims.markets(spark).collect()} == {"a.example": 6, "b.example": 2}


def test_a_day_without_rows_is_cleared(spark, tmp_path):
    rows = spark.createDataFrame([(1, datetime.date(2024, 1, 1)), (2, datetime.date(2024, 1, 2))], "k int, at date")
    tables.write_day_partitions(rows, str(tmp_path), F.col("at"))
    tables.write_day_partition(rows.where("k > 2"), str(tmp_path), "2024-01-01")
    assert [r.k for r in spark.read.schema("k int, at date, year int, month int, day int").parquet(str(tmp_path)).collect()] == [2]


def test_watermarks_are_stored_else_computed(spark, tmp_path):
    target = spark.createDataFrame([(datetime.datetime(2024, 1, 5),), (None,)], "at timestamp")
    marks, key = tables.VersionedTable(spark, str(tmp_path)), {"source_system": "s", "schema_name": "a", "table_name": "t"}
    marks.replace(merge.watermark_row(spark, key | {"table_name": "other"}, None))
    assert merge.get_watermark(marks, key, target, "at") == datetime.datetime(2024, 1, 5)
    assert merge.get_watermark(marks, key, target.limit(0), "at") == datetime.datetime(2024, 1, 5)
    assert merge.set_watermark(marks, key, target.where("at is null"), "at") is None
    # None isn't stored: what is stays, so the next load isn't blocked.
    assert marks.read().count() == 2 and merge.get_watermark(marks, key, target, "at") == datetime.datetime(2024, 1, 5)


def test_quoted_line_breaks_and_members_of_any_name(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("in/data.txt", 'a,b\r\n1,"x\ny"\r\n\r\n2,\r\nbad,z')
        z.writestr("empty", "a,b\n")
    df = spark.createDataFrame([("f.zip", out.getvalue()), ("g.zip", None)], "path string, content binary")
    assert sorted(map(tuple, zipped.read_zipped_csv(df, "a int, b string").collect()), key=repr) == sorted([("f.zip", "in/data.txt", 1, "x\ny"), ("f.zip", "in/data.txt", 2, None), ("f.zip", "in/data.txt", None, "z")], key=repr)


def test_keys_of_nested_maps_and_json(spark):
    row = spark.sql("SELECT named_struct('in ner', array(map('a b', map('c-d', 1)))) AS `out er`, map('k k', named_struct('m m', 2)) AS m")
    got = names.sanitize(row).first()
    assert got.out_er.in_ner == [{"a_b": {"c_d": 1}}] and got.m["k_k"].m_m == 2
    text = '{"a b": {"c-d" : ["x-y: \\"q r\\":", {"e.f":null}]}, "ok":1, "": "a b"}'
    df = spark.createDataFrame([(text,), (None,), ('["p q"]',)], "j string")
    out = [r.j for r in df.select(names.sanitize_json(F.col("j")).alias("j")).collect()]
    assert json.loads(out[0]) == {"a_b": {"c_d": ['x-y: "q r":', {"e_f": None}]}, "ok": 1, "": "a b"}
    assert out[1:] == [None, '["p q"]']


def test_merge_of_rows_without_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    sent = spark.createDataFrame([(1, "c"), (None, "d"), (None, "d"), (2, None)], "k int, v string")
    got = sorted(map(tuple, merge.merge_upsert(target, sent, ["k"]).collect()), key=repr)
    assert got == sorted([(1, "c"), (None, "b"), (None, "d"), (None, "d"), (2, None)], key=repr)
    assert sorted(map(tuple, merge.merge_upsert(target.select("k"), sent.select("k").distinct(), ["k"]).collect()), key=repr) == [(1,), (2,), (None,), (None,)]


def test_stream_merge_of_null_keys_and_filters(spark, tmp_path):
    kinds = "k int, at int, v string"
    spark.createDataFrame([(1, 5, "old"), (1, None, "x"), (2, None, "y"), (None, 1, "p"), (None, 6, "q"), (3, 4, "a"), (3, 4, "b")], kinds).coalesce(1).write.parquet(f"{tmp_path}/in")
    t = tables.VersionedTable(spark, f"{tmp_path}/t")
    t.replace(spark.createDataFrame([(1, 3, "first")], kinds))
    stream.merge_stream(t, stream.read_stream(spark, f"{tmp_path}/in", T.StructType.fromDDL(kinds)), ["k"], "at", f"{tmp_path}/c")
    assert sorted(map(tuple, t.read().collect()), key=repr) == sorted([(1, 5, "old"), (2, None, "y"), (None, 1, "p"), (None, 6, "q"), (3, 4, "b")], key=repr)
