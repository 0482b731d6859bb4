"""Readiness gates: small results that say whether work may start."""

from __future__ import annotations

import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions import calendar as cal

# Transaction statuses that are pending, and those of respawned transactions besides.
PENDING = ("sn", "mg", "ca", "pc", "pk", "rd", "hm")
PENDING_RESPAWN = (*PENDING, "hr", "pn")


def demand_complete(demand: DataFrame, affiliates: list[int], from_month: int, next_month: datetime.date | str) -> DataFrame:
    """One row if no affiliate's latest order is before next_month, else none. Without orders it passes."""
    rows = demand.where((F.col("ord_mo_yr_id") >= from_month) & F.col("oper_aff_id").isin(affiliates))
    last = rows.groupBy("oper_aff_id").agg(F.max("ord_dt").alias("last_order"))
    return last.agg((F.count_if(F.col("last_order") < cal.day(next_month)) == 0).alias("all_last_orders_today_or_later")).where("all_last_orders_today_or_later")


def last_orders(affiliates: list[int], from_month: int) -> dict[str, Column]:
    """Aggregates to be observed while demand is written: each affiliate's latest order since a month."""
    return {f"last_{a}": F.max(F.when((F.col("oper_aff_id") == a) & (F.col("ord_mo_yr_id") >= from_month), F.col("ord_dt"))) for a in affiliates}


def demand_complete_of(observed: dict[str, Any], affiliates: list[int], next_month: datetime.date | str) -> bool:
    """`demand_complete` from what `last_orders` saw: the table isn't read again."""
    day = datetime.date.fromisoformat(str(next_month))
    return all(last is None or last >= day for last in (observed[f"last_{a}"] for a in affiliates))


def enough_countries(revenue: DataFrame, month: str, least: int, month_col: str = "mo_yr_key_no", country_col: str = "cntry_key_no") -> DataFrame:
    """The number of countries with revenue in a month, if there are at least `least`."""
    return revenue.where(F.col(month_col) == month).agg(F.countDistinct(country_col).alias("countries")).where(F.col("countries") >= least)


def none_pending(transactions: DataFrame, affiliates: list[int], period: int, statuses: tuple[str, ...] = PENDING) -> DataFrame:
    """check_val 1 if no transaction of the period is pending, else 0."""
    rows = transactions.where(F.col("aff_no").isin(affiliates) & F.col("proc_stat_cd").isin(*statuses) & (F.col("bns_per_no") == period))
    return rows.agg(F.when(F.count(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(0)).alias("check_val"))


def nonempty(df: DataFrame) -> bool:
    """Whether a query returns rows."""
    return not df.isEmpty()
