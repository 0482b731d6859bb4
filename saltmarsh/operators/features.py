"""Recency, frequency, spend and tenure features of accounts."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions import calendar as cal
from saltmarsh.functions.bounded import small


def of_affiliates(df: DataFrame, market_affiliates: DataFrame, which: str, column: str) -> DataFrame:
    """Rows whose affiliate is in a market list, or in any list for ALL. The list is a small dimension."""
    wanted = market_affiliates if which == "ALL" else market_affiliates.where(F.col("market_list") == which)
    return df.join(small(wanted.select(F.col("affiliate").alias(column)).distinct()), column, "left_semi")


def rfm_monthly(demand: DataFrame, market_affiliates: DataFrame, start_month: int, which: str = "ALL") -> DataFrame:
    """Per account, order type and month: order lines, spend, lines per day of the month, days since the last order.

    The divisor is the month's days less one, so never 0. Sums are decimal, ratios doubles of six places.
    """
    rows = of_affiliates(demand.where(F.col("ord_mo_yr_id") >= start_month), market_affiliates, which, "oper_aff_id")
    keys = ["oper_aff_id", "oper_cntry_id", "global_account_id", "account_type_ord", cal.month_start(F.col("ord_dt")).alias("month_start"), cal.month_end(F.col("ord_dt")).alias("month_end")]
    monthly = rows.groupBy(*keys).agg(
        F.max("ord_dt").alias("last_order_of_month"),
        F.count("ord_id").alias("num_orders"),
        F.sum("adj_ln_usd_net").cast("double").alias("total_month_spend"),
    )
    return monthly.withColumn("frequency", F.round(F.col("num_orders") / F.datediff("month_end", "month_start"), 6)).withColumn("recency_monthly", F.datediff("month_end", "last_order_of_month"))


def monthly_bv(demand: DataFrame, market_affiliates: DataFrame, start_month: int, which: str = "RENEWAL") -> DataFrame:
    rows = of_affiliates(demand.where(F.col("ord_mo_yr_id") >= start_month), market_affiliates, which, "oper_aff_id")
    keys = ["oper_aff_id", "global_vol_account_id", cal.month_start(F.col("ord_dt")).alias("month_start"), cal.month_end(F.col("ord_dt")).alias("month_end")]
    return rows.groupBy(*keys).agg(F.sum("adj_ln_usd_net").cast("double").alias("total_month_bv")).orderBy("global_vol_account_id", "month_end")


def tenure(account: DataFrame, demand: DataFrame, market_affiliates: DataFrame, start: datetime.date | str, start_month: int, which: str = "RENEWAL", kind: str = "ABO") -> DataFrame:
    """Per account: the end of its first year, and days from entry to its last order.

    Orders are reduced to each account's last day before the join, which then is one row to one.
    """
    accounts = of_affiliates(account.where((F.col("current_entry_dt") >= cal.day(start)) & F.col("account_type_desc").contains(kind)), market_affiliates, which, "aff_id")
    last = demand.where(F.col("ord_mo_yr_id") >= start_month).groupBy("global_account_id").agg(F.max("ord_dt").alias("last_dt"))
    keys = ["aff_id", "global_account_id", "current_entry_dt", "auto_renewal_flag", "status_desc", "account_type_desc"]
    joined = accounts.join(last, "global_account_id").withColumn("first_year_end_date", F.add_months("current_entry_dt", 12))
    return joined.groupBy(*keys, "first_year_end_date").agg(F.max(F.datediff("last_dt", "current_entry_dt")).alias("days_to_last_order"))


def sponsor_info(sponsor: DataFrame, market_affiliates: DataFrame, start: datetime.date | str, which: str = "RENEWAL") -> DataFrame:
    rows = of_affiliates(sponsor.where(F.col("app_entry_date") >= cal.day(start)), market_affiliates, which, "aff_id")
    counts = [c for c in sponsor.columns if c.startswith("sponsoring_count_")]
    return rows.select("aff_id", "global_account_id", "app_entry_date", cal.month_start(F.col("app_entry_date")).alias("month_start"), cal.month_end(F.col("app_entry_date")).alias("month_end"), *counts).orderBy("app_entry_date")
