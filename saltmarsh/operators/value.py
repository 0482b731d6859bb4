"""The account value feature chain: from order lines to monthly features of chosen cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCOUNT = "global_vol_account_id"
MONTH = "ord_mo_yr_id"
#: What the final table leaves out.
DROPPED = ("silver_month", "account_class_code", "group_pv_normalized_to_10k", "total_downline_pv_normalized_to_10k", "personal_bv", "group_bv", "total_downline_bv", "is_at_15_pct_or_above", "min_value", "max_value")


def order_stage(demand: DataFrame, affiliate: int | None = None, from_month: int = 0) -> DataFrame:
    """Orders that count for the account that placed them, with positive volume."""
    rows = demand.where(~F.col("ord_canc_flag") & (F.col(MONTH) >= from_month) & (F.col(ACCOUNT) == F.col("global_account_id")))
    if affiliate is not None:
        rows = rows.where(F.col("oper_aff_id") == affiliate)
    sums = rows.groupBy(ACCOUNT, "ord_id", MONTH, "ord_dt").agg(F.sum("adj_ln_usd_net").alias("adj_paid"), F.sum("adj_ln_pv").alias("adj_pv"), F.sum("adj_ln_bv").alias("adj_bv"))
    return sums.where("adj_pv > 0 and adj_bv > 0")


def plan_stage(plan: DataFrame, affiliate: int | None = None, from_month: int = 0, to_month: int = 999912) -> DataFrame:
    """Plan months with the highest title and the deepest active leg."""
    rows = plan.where(F.col("year_month").between(from_month, to_month) & ((F.col("business_nature_code") == "1") | (F.col("personal_pv") != 0)))
    if affiliate is not None:
        rows = rows.where(F.col("aff_id") == affiliate)
    award = F.lit("Others")
    for title in ("silver", "gold", "platinum", "emerald", "diamond"):  # the last one set wins
        award = F.when(F.col(f"{title}_title_holder") == 1, F.lit(title.capitalize())).otherwise(award)
    legs = F.lit(0)
    for n in range(1, 8):
        legs = F.when(F.col(f"leg{n}_total_downline_pv") > 0, F.lit(n)).otherwise(legs)
    return rows.select(
        "global_account_id", "year_month", F.round(F.col("account_age_in_months") / 12, 6).alias("tenure_in_years"), "silver_month", "account_class_code",
        "new_percent_level_flag", "producer_flag", "performance_bonus_percent", "personal_pv_normalized_to_10k", "group_pv_normalized_to_10k",
        "total_downline_pv_normalized_to_10k", "personal_bv", "group_bv", "total_downline_bv", "total_bonus_local_currency",
        award.alias("award_class"), "is_at_15_pct_or_above", legs.alias("legs_with_volume"),
    ).distinct()


def early_active(orders: DataFrame, first_from: int, first_to: int, min_orders: int = 8, days: int = 90) -> DataFrame:
    """Accounts whose first month lies in the range and that ordered often enough soon after the first day."""
    # An order counts from its first day on. Days of an account are few, however many orders it has.
    each = orders.groupBy(ACCOUNT, "ord_id").agg(F.min("ord_dt").alias("day"), F.min(MONTH).alias("month"))
    by_day = each.groupBy(ACCOUNT, "day").agg(F.count(F.lit(1)).alias("n"), F.min("month").alias("month"))
    w = Window.partitionBy(ACCOUNT)
    rows = by_day.withColumn("first_month", F.min("month").over(w)).withColumn("first", F.min("day").over(w))
    soon = rows.where(F.col("first_month").between(first_from, first_to) & (F.col("day") <= F.date_add("first", days)))
    return soon.groupBy(ACCOUNT).agg(F.sum("n").alias("n")).where(F.col("n") >= min_orders).select(ACCOUNT)


def daily(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(ACCOUNT, MONTH, "ord_dt")
        .agg(F.countDistinct("ord_id").alias("daily_orders"), F.sum("adj_paid").alias("daily_sales"), F.sum("adj_pv").alias("demand_pv"), F.sum("adj_bv").alias("demand_bv"))
        .where("demand_pv > 1")
    )


def shop_gaps(orders: DataFrame, days: int = 60) -> DataFrame:
    """Per account and day: days since the last one, and their mean over the last `days` days."""
    w = Window.partitionBy(ACCOUNT)
    gaps = daily(orders).withColumn("shp_gap", F.datediff("ord_dt", F.lag("ord_dt").over(w.orderBy("ord_dt"))))
    return gaps.withColumn("avg_shp_gap", F.avg("shp_gap").over(w.orderBy(F.unix_date("ord_dt")).rangeBetween(-days, 0)))


def demand_metrics(orders: DataFrame) -> DataFrame:
    """Per account and month: orders, sales, volumes, the mean gap on its last day, days since it last shopped.

    Days are unique per account, so the last day's values come with the month's aggregation (max_by)
    and no window over months is needed; the last day of each month over all accounts is a second,
    small aggregation.
    """
    monthly = shop_gaps(orders).groupBy(ACCOUNT, MONTH).agg(
        F.sum("daily_orders").alias("monthly_orders"), F.sum("daily_sales").alias("monthly_sales"), F.sum("demand_pv").alias("demand_pv"), F.sum("demand_bv").alias("demand_bv"),
        F.max_by("avg_shp_gap", "ord_dt").alias("avg_shop_gap"), F.max("ord_dt").alias("last_day"),
    )
    ends = monthly.groupBy(MONTH).agg(F.max("last_day").alias("month_day"))  # one row per month
    return monthly.join(F.broadcast(ends), MONTH).select(ACCOUNT, MONTH, "monthly_orders", "monthly_sales", "demand_pv", "demand_bv", "avg_shop_gap", F.datediff("month_day", "last_day").alias("days_since_last_shop"))


def minmax_scaled(metrics: DataFrame, column: str = "demand_pv", top: int = 10000) -> DataFrame:
    """The column scaled to 0..top; NULL where all values are equal. Adds min_value and max_value."""
    ends = metrics.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))
    x = F.col(column).cast("double")
    scaled = F.try_divide(x - F.col("min_value").cast("double"), (F.col("max_value") - F.col("min_value")).cast("double")) * top
    return metrics.crossJoin(F.broadcast(ends)).withColumn(column, scaled)


def metrics_joined(scaled: DataFrame, plan: DataFrame) -> DataFrame:
    """Distinct, as scaled has one row per account and month and plan distinct rows (demand_metrics, plan_stage)."""
    p = plan.withColumnRenamed("global_account_id", ACCOUNT).withColumnRenamed("year_month", MONTH)
    return scaled.join(p, [ACCOUNT, MONTH])


def spend_of(orders: DataFrame, members: DataFrame, first: int, last: int) -> DataFrame:
    """Orders and spend per account that is a member, in the months from first to last."""
    rows = orders.where(F.col(MONTH).between(first, last)).join(members, ACCOUNT, "left_semi")
    return rows.groupBy(ACCOUNT).agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("adj_paid").cast("double"), 6).alias("adj_paid"))


def cohort(joined: DataFrame, until: int | None = None, at: int | None = None) -> DataFrame:
    """Accounts with a month up to `until`, or exactly `at`."""
    return joined.where(F.col(MONTH) <= until if until is not None else F.col(MONTH) == at).select(ACCOUNT).distinct()


def metrics_opt(joined: DataFrame, training: DataFrame, prediction: DataFrame, early: DataFrame, excluded: int | None = None) -> DataFrame:
    """Features of the accounts in all three cohorts."""
    rows = joined if excluded is None else joined.where(F.col(ACCOUNT) != excluded)
    for members in (training, prediction, early):
        rows = rows.join(members, ACCOUNT, "left_semi")
    return rows.drop(*DROPPED)
