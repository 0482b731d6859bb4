"""Revenue restated at the budget exchange rate of one month."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions import calendar as cal
from saltmarsh.functions.bounded import small


def restated(macro: DataFrame, corp: DataFrame, as_of: datetime.date | str, rate_year: int, first_month: int, excluded: tuple[str, ...], also_excluded: str = "42") -> DataFrame:
    """Closed months from first_month (a month index) on. A country without a rate keeps NULL revenue."""
    today = cal.day(as_of)
    rate = macro.where((F.col("calen_yr4") == rate_year) & (F.col("calen_mo") == F.month(today))).select("cntry_cd", F.col("exchg_bdgt_pct").alias("rate"))
    months = cal.month_index(F.col("calen_yr4"), F.col("calen_mo"))
    rows = macro.where(~F.col("cntry_cd").isin(*excluded) & (F.col("cntry_cd") != also_excluded) & months.between(F.lit(first_month), cal.last_closed_month(today)))
    named = rows.join(small(corp.where(F.right("corp_cd", F.lit(1)) != "1").select("cntry_cd", "corp_nm")), "cntry_cd")
    return named.join(rate, "cntry_cd", "left").select(
        F.concat(F.col("calen_yr4").cast("string"), F.lpad(F.col("calen_mo").cast("string"), 2, "0")).alias("mo_yr_key_no"),
        F.col("cntry_cd").alias("cntry_key_no"), F.col("corp_nm").alias("cntry_nm"), F.round(F.col("rev_dist_sales_amt") * F.col("rate"), 0).cast("double").alias("hyp_rev"),
    )
