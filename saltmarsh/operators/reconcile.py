"""Reconciliation of four volume measures per business entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.functions.bounded import small

KEYS = ["bns_per_no", "market_group", "aff_no", "bus_entty_no"]
TYPES = {"001": "v001", "017": "v017", "086": "v086", "TX001": "tx001"}
#: The history's columns and types.
HISTORY = T.StructType(
    [T.StructField("bns_per_no", T.IntegerType()), T.StructField("market_group", T.StringType()), T.StructField("aff_no", T.IntegerType()), T.StructField("bus_entty_no", T.IntegerType())]
    + [T.StructField(f"{v}_{m}", T.DoubleType()) for m in ("pv", "bv") for v in TYPES.values()]
    + [T.StructField("pv_all_matching", T.BooleanType()), T.StructField("bv_all_matching", T.BooleanType()), T.StructField("all_matching", T.StringType())]
    + [T.StructField("scheduled_ts", T.StringType()), T.StructField("actual_ts", T.StringType())]
)


def _measured(rows: DataFrame, kind: Column) -> DataFrame:
    named = rows.withColumn("vol_type_cd", kind)
    return named.groupBy(*KEYS, "vol_type_cd").agg(F.sum("pv_qty").cast("double").alias("pv"), F.sum("bns_vol_qty").cast("double").alias("bv"))


def volumes(detail: DataFrame, customers: DataFrame, affiliates: DataFrame, headers: DataFrame, lines: DataFrame, schedule: DataFrame, period: int, statuses: tuple[str, ...] = ("cp", "pn")) -> DataFrame:
    """PV and BV per entity and measure, from sources of their own, for all market groups at once.

    001 and 017: period detail of customers. 086: period detail of the customers that stand for an affiliate. TX001: lines of
    type 001 of transactions in one of the statuses. Filters come before the joins; masters are joined by their key.
    """
    groups = small(schedule.select(F.col("affiliate").alias("aff_no"), "market_group").distinct())
    now = detail.where((F.col("bns_per_no") == period) & F.col("vol_type_cd").isin("001", "017", "086"))
    of_customer = now.join(customers.select("bns_cust_id", "aff_no").join(groups, "aff_no"), "bns_cust_id")
    alias = affiliates.select(F.col("alias_cust_id").alias("bns_cust_id"))
    plain = of_customer.where("vol_type_cd in ('001', '017')")
    of_alias = of_customer.where("vol_type_cd = '086'").join(alias, "bns_cust_id")
    trades = headers.where((F.col("bns_per_no") == period) & F.col("proc_stat_cd").isin(*statuses)).join(groups, "aff_no")
    trades = trades.join(lines.where("vol_type_cd = '001'").select("bns_trx_id", "pv_qty", "bns_vol_qty"), "bns_trx_id")
    parts = [_measured(plain, F.col("vol_type_cd")), _measured(of_alias, F.lit("086")), _measured(trades, F.lit("TX001"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])  # the types differ, so no row is in two


def _all_equal(columns: list[Column]) -> Column:
    """Whether all are equal; a missing one is not."""
    equal = F.lit(True)
    for a, b in zip(columns, columns[1:], strict=False):
        equal = equal & (a == b)
    return F.coalesce(equal, F.lit(False))


def reconcile(volumes: DataFrame) -> DataFrame:
    """One row per entity: the measures side by side and whether they agree."""
    wide = volumes.groupBy(*KEYS).pivot("vol_type_cd", list(TYPES)).agg(F.first("pv").alias("pv"), F.first("bv").alias("bv"))
    for code, name in TYPES.items():
        wide = wide.withColumnRenamed(f"{code}_pv", f"{name}_pv").withColumnRenamed(f"{code}_bv", f"{name}_bv")
    for m in ("pv", "bv"):
        wide = wide.withColumn(f"{m}_all_matching", _all_equal([F.col(f"{v}_{m}") for v in TYPES.values()]))
    verdict = F.when(F.col("pv_all_matching") & F.col("bv_all_matching"), F.lit("MATCHED")).otherwise(F.lit("UNMATCHED"))
    order = [*KEYS, *(f"{v}_{m}" for m in ("pv", "bv") for v in TYPES.values()), "pv_all_matching", "bv_all_matching"]
    return wide.select(*order, verdict.alias("all_matching"))


def stamp(rows: DataFrame, scheduled: str, actual: str) -> DataFrame:
    return rows.withColumn("scheduled_ts", F.lit(scheduled)).withColumn("actual_ts", F.lit(actual)).select(*HISTORY.names)


def unmatched_entities(rows: DataFrame) -> DataFrame:
    """Per market group the failing entities as ascending text."""
    bad = rows.where("all_matching = 'UNMATCHED'").groupBy("market_group").agg(F.sort_array(F.collect_list("bus_entty_no")).alias("e"))
    return bad.select("market_group", F.array_join("e", ",").alias("bus_entities"))


def status(rows: DataFrame) -> DataFrame:
    """Per market group UNMATCHED if any entity is."""
    return rows.groupBy("market_group").agg(F.when(F.bool_or(F.col("all_matching") == "UNMATCHED"), F.lit("UNMATCHED")).otherwise(F.lit("MATCHED")).alias("status"))
