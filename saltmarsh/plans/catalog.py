"""All registered queries over the stand-in tables, and the same in SQL for DuckDB."""

from __future__ import annotations

import datetime
import io
import zipfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.functions import calendar as cal
from saltmarsh.functions import names, typemap
from saltmarsh.functions.coerce import coerce_col, conform, infer_schema
from saltmarsh.functions.sized import file_bytes, sized_session
from saltmarsh.operators import (
    clicks,
    features,
    gates,
    merge,
    metadata,
    orders,
    reconcile,
    revenue,
    value,
)
from saltmarsh.plans import dims, standins
from saltmarsh.plans.shared import scratch
from saltmarsh.plans.standins import tables_of, view, with_views
from saltmarsh.sources import buckets, layout, schemas, tables, zipped
from saltmarsh.streaming import clicks as stream

Query = Callable[[SparkSession, str], DataFrame]

CLICK_DAY, ORDER_DAY, REVENUE_DAY = "2024-01-20", "2001-08-01", "2001-07-15"
START_MONTH, START = 199601, "1996-01-01"
RATE_YEAR, FIRST_MONTH, EXCLUDED = 2001, 1995 * 12 + 1, ("07", "12")
PERIOD, GATE_AFFILIATES = 199803, [10, 30, 70]
EARLY_ORDERS, EARLY_DAYS, EARLY_FROM, EARLY_TO = 2, 365, 199001, 200112
TRAIN_UNTIL, PREDICT_AT = 199912, 200103
LOAD_DATE = "2024-02-01"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _input_bytes(spark: SparkSession, d: str) -> int:
    """Bytes of what the order lines are made of."""
    return file_bytes(view(spark, d, n) for n in ("lineitem", "orders", "customer"))


def _over_lines(f: Query) -> Query:
    """A query over order lines: its shuffles follow the lines."""
    return lambda spark, d: f(sized_session(spark, _input_bytes(spark, d)), d)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = _over_lines(f) if sql is not None and "lineitem" in tables_of(sql) else f
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return f

    return keep


def _in(values: list) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


ALL, RENEWAL = _in(dims.affiliates("ALL")), _in(dims.affiliates("RENEWAL"))
_GROUPS = ", ".join(f"({a}, '{g}')" for _, g, members in dims.SCHEDULE for a in members)

# Features of accounts


@register(
    "rfm_monthly",
    f"""
SELECT *, round(num_orders / datediff('day', month_start, month_end), 6) AS frequency, CAST(datediff('day', last_order_of_month, month_end) AS INT) AS recency_monthly
FROM (SELECT oper_aff_id, oper_cntry_id, global_account_id, account_type_ord, CAST(date_trunc('month', ord_dt) AS DATE) AS month_start, last_day(ord_dt) AS month_end,
        max(ord_dt) AS last_order_of_month, count(ord_id) AS num_orders, CAST(sum(adj_ln_usd_net) AS DOUBLE) AS total_month_spend
      FROM {{demand}} WHERE ord_mo_yr_id >= {START_MONTH} AND oper_aff_id IN {ALL} GROUP BY ALL)""",
)
def rfm_monthly(spark: SparkSession, d: str) -> DataFrame:
    return features.rfm_monthly(view(spark, d, "demand"), dims.market_affiliates(spark), START_MONTH)


@register(
    "monthly_bv",
    f"""
SELECT oper_aff_id, global_vol_account_id, CAST(date_trunc('month', ord_dt) AS DATE) AS month_start, last_day(ord_dt) AS month_end, CAST(sum(adj_ln_usd_net) AS DOUBLE) AS total_month_bv
FROM {{demand}} WHERE ord_mo_yr_id >= {START_MONTH} AND oper_aff_id IN {RENEWAL} GROUP BY ALL""",
)
def monthly_bv(spark: SparkSession, d: str) -> DataFrame:
    return features.monthly_bv(view(spark, d, "demand"), dims.market_affiliates(spark), START_MONTH)


@register(
    "tenure",
    f"""
SELECT a.aff_id, a.global_account_id, a.current_entry_dt, a.auto_renewal_flag, a.status_desc, a.account_type_desc,
  CAST(a.current_entry_dt + INTERVAL 1 YEAR AS DATE) AS first_year_end_date, CAST(max(datediff('day', a.current_entry_dt, b.ord_dt)) AS INT) AS days_to_last_order
FROM {{account}} a JOIN {{demand}} b ON a.global_account_id = b.global_account_id
WHERE a.current_entry_dt >= DATE '{START}' AND b.ord_mo_yr_id >= {START_MONTH} AND a.aff_id IN {RENEWAL} AND a.account_type_desc LIKE '%ABO%' GROUP BY ALL""",
)
def tenure(spark: SparkSession, d: str) -> DataFrame:
    return features.tenure(view(spark, d, "account"), view(spark, d, "demand"), dims.market_affiliates(spark), START, START_MONTH)


@register(
    "sponsor_info",
    f"""
SELECT *, CAST(date_trunc('month', app_entry_date) AS DATE) AS month_start, last_day(app_entry_date) AS month_end FROM {{sponsor}}
WHERE app_entry_date >= DATE '{START}' AND aff_id IN {RENEWAL}""",
)
def sponsor_info(spark: SparkSession, d: str) -> DataFrame:
    return features.sponsor_info(view(spark, d, "sponsor"), dims.market_affiliates(spark), START)


@register("affiliate_filter", f"SELECT account_id, aff_id FROM {{account}} WHERE aff_id IN {_in(dims.affiliates('PURCHASE_PREDICTION'))}")
def affiliate_filter(spark: SparkSession, d: str) -> DataFrame:
    return features.of_affiliates(view(spark, d, "account"), dims.market_affiliates(spark), "PURCHASE_PREDICTION", "aff_id").select("account_id", "aff_id")


# Revenue

_INDEX = "calen_yr4 * 12 + calen_mo"
_REVENUE = f"""
SELECT concat(CAST(m.calen_yr4 AS VARCHAR), lpad(CAST(m.calen_mo AS VARCHAR), 2, '0')) AS mo_yr_key_no, m.cntry_cd AS cntry_key_no, c.corp_nm AS cntry_nm,
  CAST(round(m.rev_dist_sales_amt * x.exchg_bdgt_pct, 0) AS DOUBLE) AS hyp_rev
FROM {{macro_rev}} m JOIN {{corp}} c ON m.cntry_cd = c.cntry_cd
LEFT JOIN (SELECT cntry_cd, exchg_bdgt_pct FROM {{macro_rev}} WHERE calen_yr4 = {RATE_YEAR} AND calen_mo = month(DATE '{REVENUE_DAY}')) x ON m.cntry_cd = x.cntry_cd
WHERE m.cntry_cd NOT IN {_in(list(EXCLUDED))} AND right(c.corp_cd, 1) <> '1' AND m.cntry_cd <> '42' AND m.{_INDEX.replace("calen_mo", "m.calen_mo")} BETWEEN {FIRST_MONTH} AND
  CASE WHEN day(DATE '{REVENUE_DAY}') > 8 THEN year(DATE '{REVENUE_DAY}' - INTERVAL 1 MONTH) * 12 + month(DATE '{REVENUE_DAY}' - INTERVAL 1 MONTH)
  ELSE year(DATE '{REVENUE_DAY}' - INTERVAL 2 MONTH) * 12 + month(DATE '{REVENUE_DAY}' - INTERVAL 2 MONTH) END"""


@register("revenue_restated", _REVENUE)
def revenue_restated(spark: SparkSession, d: str) -> DataFrame:
    return revenue.restated(view(spark, d, "macro_rev"), view(spark, d, "corp"), REVENUE_DAY, RATE_YEAR, FIRST_MONTH, EXCLUDED)


# Clicks

_SITES = "(VALUES ('alpha', 'a.example', 6), ('beta', 'b.example', 2)) m(country, url, months)"
_RECENT = f"CAST(time AS DATE) BETWEEN CAST(DATE '{CLICK_DAY}' - to_months(months) AS DATE) AND DATE '{CLICK_DAY}'"


def _click_sql(event: str) -> str:
    return f"""
SELECT country, day, user_id, identity, product_id, session_id, CAST(sum(n) AS BIGINT) AS {event}
FROM (SELECT country, user_id, session_id, CAST(time AS DATE) AS day, product_id, count(*) AS n FROM {{clicks}} JOIN {_SITES} ON domain = url
      WHERE event = '{event}' AND {_RECENT} GROUP BY ALL) LEFT JOIN (SELECT DISTINCT user_id, identity FROM {{users}}) USING (user_id) GROUP BY ALL"""


def _click_query(event: str) -> Query:
    return lambda spark, d: clicks.daily_identity(view(spark, d, "clicks"), view(spark, d, "users"), dims.markets(spark), event, CLICK_DAY)


for _name, _event in (("click_daily_identity", "product_view_pdp"), ("click_add_to_cart", "added_to_cart"), ("click_orders_submitted", "orders_submitted")):
    register(_name, _click_sql(_event))(_click_query(_event))

_TERMS = f"""
SELECT DISTINCT country, user_id, session_id, CAST(time AS DATE) AS day, searchkeyword FROM {{clicks}} JOIN {_SITES} ON domain = url
WHERE event = 'search_view' AND searchkeyword IS NOT NULL AND {_RECENT}"""


@register("search_terms", _TERMS)
def search_terms(spark: SparkSession, d: str) -> DataFrame:
    return clicks.search_terms(view(spark, d, "clicks"), dims.markets(spark), CLICK_DAY)


@register("market_fanout", f"SELECT country, event, count(*) AS n FROM {{clicks}} JOIN {_SITES} ON domain = url GROUP BY ALL")
def market_fanout(spark: SparkSession, d: str) -> DataFrame:
    return clicks.for_markets(view(spark, d, "clicks"), dims.markets(spark), "domain", "url").groupBy("country", "event").agg(F.count(F.lit(1)).alias("n"))


@register("export_market_csv", _TERMS)
def export_market_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    tables.export_market_csv(search_terms(spark, d), path, "country")
    return tables.read_csv(spark, path, "user_id long, session_id long, day date, searchkeyword string, country string", sep=";")


# Orders


def _orders_sql(strict: bool) -> str:
    country = "s.cntry_id" if strict else "o.cntry_id"
    return f"""
SELECT d.ord_dt_key_no, d.ord_id, d.global_account_id, d.oper_cntry_id, d.ord_account_id AS demand_ord_account_id, o.bus_natr_cd AS ord_bus_natr_cd, s.bus_natr_cd AS ship_bus_natr_cd,
  d.ord_item_cd, d.ord_item_base_cd, d.ord_qty, c.country_short_name AS country_name, d.ord_mo_yr_id, d.catalog_ln_usd_net, d.adj_ln_usd_net, d.account_type_ord
FROM {{demand}} d LEFT JOIN {{ord_accounts}} o ON d.oper_cntry_id = o.cntry_id AND d.ord_account_id = o.account_id
LEFT JOIN {{ship_accounts}} s ON d.oper_cntry_id = {country} AND d.shp_account_id = s.account_id
JOIN {{countries}} c ON d.oper_cntry_id = c.country_no
WHERE d.ord_mo_yr_id >= CAST(strftime(DATE '{ORDER_DAY}' - INTERVAL 6 MONTH, '%Y%m') AS INT)"""


def _order_base(spark: SparkSession, d: str, strict: bool = False, spread: int | None = None) -> DataFrame:
    return orders.order_base(*(view(spark, d, n) for n in ("demand", "ord_accounts", "ship_accounts", "countries")), ORDER_DAY, strict_country=strict, spread_above=spread)


register("order_base", _orders_sql(False))(lambda spark, d: _order_base(spark, d))
register("order_base_spread", _orders_sql(False))(lambda spark, d: _order_base(spark, d, spread=20))
register("order_base_strict", _orders_sql(True))(lambda spark, d: _order_base(spark, d, True))
register("orders_by_country", f"SELECT * EXCLUDE (oper_cntry_id, ord_mo_yr_id, demand_ord_account_id), demand_ord_account_id AS ord_account_id FROM ({_orders_sql(False)})")(lambda spark, d: orders.by_country(_order_base(spark, d)))

# The account value chain; each step's SQL is built on those before it

_STAGES = {
    "order_stage": """
SELECT global_vol_account_id, ord_id, ord_mo_yr_id, ord_dt, sum(adj_ln_usd_net) AS adj_paid, sum(adj_ln_pv) AS adj_pv, sum(adj_ln_bv) AS adj_bv FROM {demand}
WHERE ord_canc_flag = FALSE AND global_vol_account_id = global_account_id GROUP BY ALL HAVING sum(adj_ln_pv) > 0 AND sum(adj_ln_bv) > 0""",
    "award_class": """
SELECT DISTINCT global_account_id, year_month, round(account_age_in_months / 12, 6) AS tenure_in_years, silver_month, account_class_code, new_percent_level_flag, producer_flag,
  performance_bonus_percent, personal_pv_normalized_to_10k, group_pv_normalized_to_10k, total_downline_pv_normalized_to_10k, personal_bv, group_bv, total_downline_bv, total_bonus_local_currency,
  CASE WHEN diamond_title_holder = 1 THEN 'Diamond' WHEN emerald_title_holder = 1 THEN 'Emerald' WHEN platinum_title_holder = 1 THEN 'Platinum'
    WHEN gold_title_holder = 1 THEN 'Gold' WHEN silver_title_holder = 1 THEN 'Silver' ELSE 'Others' END AS award_class, is_at_15_pct_or_above,
  CASE """
    + " ".join(f"WHEN leg{n}_total_downline_pv > 0 THEN {n}" for n in range(7, 0, -1))
    + """ ELSE 0 END AS legs_with_volume
FROM {plan_info} WHERE business_nature_code = '1' OR personal_pv <> 0""",
    "early_active_accounts": f"""
SELECT global_vol_account_id FROM (
  SELECT global_vol_account_id, ord_id, ord_dt, min(ord_dt) OVER (PARTITION BY global_vol_account_id) AS frst FROM order_stage
  WHERE global_vol_account_id IN (SELECT global_vol_account_id FROM order_stage GROUP BY 1 HAVING min(ord_mo_yr_id) BETWEEN {EARLY_FROM} AND {EARLY_TO}))
WHERE ord_dt <= frst + {EARLY_DAYS} GROUP BY 1 HAVING count(DISTINCT ord_id) >= {EARLY_ORDERS}""",
    "daily": """
SELECT global_vol_account_id, ord_mo_yr_id, ord_dt, count(DISTINCT ord_id) AS daily_orders, sum(adj_paid) AS daily_sales, sum(adj_pv) AS demand_pv, sum(adj_bv) AS demand_bv
FROM order_stage GROUP BY 1, 2, 3 HAVING sum(adj_pv) > 1""",
    "gaps": """
SELECT *, CAST(datediff('day', lag(ord_dt) OVER (PARTITION BY global_vol_account_id ORDER BY ord_dt), ord_dt) AS INT) AS shp_gap,
  row_number() OVER (PARTITION BY global_vol_account_id, ord_mo_yr_id ORDER BY ord_dt DESC) AS shp_rank FROM daily""",
    "gaps60": """
SELECT *, avg(shp_gap) OVER (PARTITION BY global_vol_account_id ORDER BY ord_dt RANGE BETWEEN INTERVAL 60 DAY PRECEDING AND CURRENT ROW) AS avg_shp_gap FROM gaps""",
    "demand_metrics": """
SELECT global_vol_account_id, ord_mo_yr_id, monthly_orders, monthly_sales, demand_pv, demand_bv, avg_shop_gap, CAST(min(days) AS INT) AS days_since_last_shop FROM (
  SELECT global_vol_account_id, ord_mo_yr_id, CAST(sum(daily_orders) OVER w AS BIGINT) AS monthly_orders, sum(daily_sales) OVER w AS monthly_sales, sum(demand_pv) OVER w AS demand_pv, sum(demand_bv) OVER w AS demand_bv,
    avg(CASE WHEN shp_rank = 1 THEN avg_shp_gap END) OVER w AS avg_shop_gap,
    datediff('day', max(ord_dt) OVER (PARTITION BY global_vol_account_id ORDER BY ord_mo_yr_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), max(ord_dt) OVER (PARTITION BY ord_mo_yr_id)) AS days
  FROM gaps60 WINDOW w AS (PARTITION BY global_vol_account_id, ord_mo_yr_id)) GROUP BY ALL""",
    "minmax_scaled": """
SELECT * EXCLUDE (demand_pv), (CAST(demand_pv AS DOUBLE) - CAST(min_value AS DOUBLE)) / nullif(CAST(max_value - min_value AS DOUBLE), 0) * 10000 AS demand_pv
FROM demand_metrics, (SELECT min(demand_pv) AS min_value, max(demand_pv) AS max_value FROM demand_metrics)""",
    "metrics_joined": """
SELECT DISTINCT a.*, b.* EXCLUDE (global_account_id, year_month) FROM minmax_scaled a JOIN award_class b ON a.global_vol_account_id = b.global_account_id AND a.ord_mo_yr_id = b.year_month""",
    "training_accounts": f"SELECT DISTINCT global_vol_account_id FROM metrics_joined WHERE ord_mo_yr_id <= {TRAIN_UNTIL}",
    "prediction_accounts": f"SELECT DISTINCT global_vol_account_id FROM metrics_joined WHERE ord_mo_yr_id = {PREDICT_AT}",
    "metrics_opt": """
SELECT a.* EXCLUDE (silver_month, account_class_code, group_pv_normalized_to_10k, total_downline_pv_normalized_to_10k, personal_bv, group_bv, total_downline_bv, is_at_15_pct_or_above, min_value, max_value)
FROM metrics_joined a JOIN training_accounts b ON a.global_vol_account_id = b.global_vol_account_id JOIN prediction_accounts c ON b.global_vol_account_id = c.global_vol_account_id
JOIN early_active_accounts e ON c.global_vol_account_id = e.global_vol_account_id""",
}
_MONEY = ("adj_paid", "adj_pv", "adj_bv", "monthly_sales", "demand_pv", "demand_bv", "daily_sales", "min_value", "max_value", "total_bonus_local_currency", "personal_pv_normalized_to_10k", "group_pv_normalized_to_10k", "total_downline_pv_normalized_to_10k", "personal_bv", "group_bv", "total_downline_bv", "avg_shop_gap", "avg_shp_gap")


def _chain_sql(last: str, columns: str = "*") -> str:
    steps = []
    for name, sql in _STAGES.items():
        steps.append(f"{name} AS ({sql})")
        if name == last:
            break
    return f"WITH {', '.join(steps)} SELECT {columns} FROM {last}"


def _rounded_sql(last: str) -> str:
    """Amounts as doubles of six places."""
    return _chain_sql(last, f"COLUMNS(c -> c NOT IN {_in(list(_MONEY))}), round(CAST(COLUMNS(c -> c IN {_in(list(_MONEY))}) AS DOUBLE), 6)").replace("c -> c", "lambda c: c")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) if c in _MONEY else F.col(c) for c in df.columns])


def _stage(spark: SparkSession, d: str) -> DataFrame:
    return value.order_stage(view(spark, d, "demand"))


def _early(stage: DataFrame) -> DataFrame:
    return value.early_active(stage, EARLY_FROM, EARLY_TO, EARLY_ORDERS, EARLY_DAYS)


def _stored(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, for plans that read it several times."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return value.metrics_joined(value.minmax_scaled(value.demand_metrics(_stage(spark, d))), value.plan_stage(view(spark, d, "plan_info")))


register("order_stage", _rounded_sql("order_stage"))(lambda spark, d: _rounded(_stage(spark, d)))
register("award_class", _rounded_sql("award_class"))(lambda spark, d: _rounded(value.plan_stage(view(spark, d, "plan_info"))))
register("early_active_accounts", _chain_sql("early_active_accounts"))(lambda spark, d: _early(_stage(spark, d)))
register("shop_gap_60d", _chain_sql("gaps60", "global_vol_account_id, ord_dt, shp_gap, round(avg_shp_gap, 6) AS avg_shp_gap"))(
    lambda spark, d: value.shop_gaps(_stage(spark, d)).select("global_vol_account_id", "ord_dt", "shp_gap", F.round("avg_shp_gap", 6).alias("avg_shp_gap"))
)
register("latest_in_month", _chain_sql("gaps60", "global_vol_account_id, ord_mo_yr_id, ord_dt, daily_orders") + " WHERE shp_rank = 1")(
    lambda spark, d: value.daily(_stage(spark, d)).groupBy("global_vol_account_id", "ord_mo_yr_id").agg(F.max_by("daily_orders", "ord_dt").alias("daily_orders"), F.max("ord_dt").alias("ord_dt"))
)
register("running_max", _chain_sql("daily", "global_vol_account_id, ord_mo_yr_id, ord_dt, max(ord_dt) OVER (PARTITION BY global_vol_account_id ORDER BY ord_mo_yr_id) AS month_lst_date_acc"))(
    lambda spark, d: value.daily(_stage(spark, d)).selectExpr("global_vol_account_id", "ord_mo_yr_id", "ord_dt", "max(ord_dt) OVER (PARTITION BY global_vol_account_id ORDER BY ord_mo_yr_id) AS month_lst_date_acc")
)
register("demand_daily", _rounded_sql("daily"))(lambda spark, d: _rounded(value.daily(_stage(spark, d))))
register("demand_metrics", _rounded_sql("demand_metrics"))(lambda spark, d: _rounded(value.demand_metrics(_stage(spark, d))))
register("minmax_scaled", _rounded_sql("minmax_scaled"))(lambda spark, d: _rounded(value.minmax_scaled(value.demand_metrics(_stage(spark, d)))))
register("metrics_joined", _rounded_sql("metrics_joined"))(lambda spark, d: _rounded(_joined(spark, d)))
register("training_accounts", _chain_sql("training_accounts"))(lambda spark, d: value.cohort(_joined(spark, d), until=TRAIN_UNTIL))
register("prediction_accounts", _chain_sql("prediction_accounts"))(lambda spark, d: value.cohort(_joined(spark, d), at=PREDICT_AT))


@register("metrics_opt", _rounded_sql("metrics_opt"))
def metrics_opt(spark: SparkSession, d: str) -> DataFrame:
    joined = _stored(_joined(spark, d))  # read three times
    return _rounded(value.metrics_opt(joined, value.cohort(joined, until=TRAIN_UNTIL), value.cohort(joined, at=PREDICT_AT), _early(_stage(spark, d))))


LAID_OUT_FROM, LAID_OUT_TO, BUCKETS = 199701, 199806, 4
#: Bytes of the input's files for each bucket, of which there are `BUCKETS` at least.
BUCKET_BYTES = 32_000_000


@register("laid_out_spend", _chain_sql("award_class")[: -len(" SELECT * FROM award_class")] + f"""
SELECT global_vol_account_id, count(*) AS n_orders, round(CAST(sum(adj_paid) AS DOUBLE), 6) AS adj_paid FROM order_stage
WHERE ord_mo_yr_id BETWEEN {LAID_OUT_FROM} AND {LAID_OUT_TO} AND global_vol_account_id IN (SELECT global_account_id FROM award_class WHERE legs_with_volume > 0) GROUP BY 1""")
def laid_out_spend(spark: SparkSession, d: str) -> DataFrame:
    """Orders and spend of accounts with active legs in some months, from tables partitioned by month and bucketed by account."""
    path = scratch(spark)
    # A bucket is written by one task, so their number follows the input.
    n = max(BUCKETS, -(-_input_bytes(spark, d) // BUCKET_BYTES))
    stage = layout.lay_out(_stage(spark, d), f"{path}/orders", "global_vol_account_id", n, "ord_mo_yr_id")
    plan = value.plan_stage(view(spark, d, "plan_info")).withColumnRenamed("global_account_id", "global_vol_account_id")
    legs = layout.lay_out(plan, f"{path}/plan", "global_vol_account_id", n)
    return value.spend_of(spark.table(stage), spark.table(legs).where("legs_with_volume > 0"), LAID_OUT_FROM, LAID_OUT_TO)


# Reconciliation

_PERIOD_VOLUMES = f"""
groups(aff_no, market_group) AS (VALUES {_GROUPS}),
v AS (SELECT d.*, c.aff_no, market_group FROM {{vol_dtl}} d JOIN {{cust_mst}} c ON d.bns_cust_id = c.bns_cust_id JOIN groups g ON c.aff_no = g.aff_no WHERE bns_per_no = {PERIOD}),
sq AS (
  SELECT bns_per_no, market_group, aff_no, bus_entty_no, vol_type_cd, CAST(sum(pv_qty) AS DOUBLE) AS pv, CAST(sum(bns_vol_qty) AS DOUBLE) AS bv FROM v WHERE vol_type_cd IN ('001', '017') GROUP BY 1, 2, 3, 4, 5
  UNION SELECT bns_per_no, market_group, v.aff_no, bus_entty_no, vol_type_cd, CAST(sum(pv_qty) AS DOUBLE), CAST(sum(bns_vol_qty) AS DOUBLE) FROM v JOIN {{aff_mst}} m ON m.alias_cust_id = v.bns_cust_id WHERE vol_type_cd = '086' GROUP BY 1, 2, 3, 4, 5
  UNION SELECT bns_per_no, market_group, t.aff_no, bus_entty_no, 'TX001', CAST(sum(pv_qty) AS DOUBLE), CAST(sum(bns_vol_qty) AS DOUBLE)
  FROM {{trx_mst}} t JOIN {{trx_dtl}} l ON t.bns_trx_id = l.bns_trx_id JOIN groups g ON t.aff_no = g.aff_no WHERE vol_type_cd = '001' AND proc_stat_cd IN ('cp', 'pn') AND bns_per_no = {PERIOD} GROUP BY 1, 2, 3, 4)"""
_WIDE = ", ".join(f"max(CASE WHEN vol_type_cd = '{c}' THEN {m} END) AS {n}_{m}" for m in ("pv", "bv") for c, n in reconcile.TYPES.items())
_SAME = lambda m: f"coalesce(v001_{m} = v017_{m} AND v017_{m} = v086_{m} AND v086_{m} = tx001_{m}, FALSE)"
_RECONCILED = f"""WITH {_PERIOD_VOLUMES},
wide AS (SELECT bns_per_no, market_group, aff_no, bus_entty_no, {_WIDE} FROM sq GROUP BY 1, 2, 3, 4),
flagged AS (SELECT *, {_SAME("pv")} AS pv_all_matching, {_SAME("bv")} AS bv_all_matching FROM wide),
result AS (SELECT *, CASE WHEN pv_all_matching AND bv_all_matching THEN 'MATCHED' ELSE 'UNMATCHED' END AS all_matching FROM flagged) """


def _volumes(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.volumes(*(view(spark, d, n) for n in ("vol_dtl", "cust_mst", "aff_mst", "trx_mst", "trx_dtl")), dims.schedule_groups(spark), PERIOD)


def _reconciled(spark: SparkSession, d: str) -> DataFrame:
    return reconcile.reconcile(_volumes(spark, d))


register("volume_union", f"WITH {_PERIOD_VOLUMES} SELECT * FROM sq")(_volumes)
register("volume_reconciliation", _RECONCILED + "SELECT * FROM result")(lambda spark, d: _reconciled(spark, d).orderBy("bns_per_no", "market_group", "aff_no"))
register("unmatched_entities", _RECONCILED + "SELECT market_group, string_agg(CAST(bus_entty_no AS VARCHAR), ',' ORDER BY bus_entty_no) AS bus_entities FROM result WHERE all_matching = 'UNMATCHED' GROUP BY 1")(
    lambda spark, d: reconcile.unmatched_entities(_reconciled(spark, d))
)
register("reconciliation_status", _RECONCILED + "SELECT market_group, CASE WHEN bool_or(all_matching = 'UNMATCHED') THEN 'UNMATCHED' ELSE 'MATCHED' END AS status FROM result GROUP BY 1")(
    lambda spark, d: reconcile.status(_reconciled(spark, d))
)


@register("load_csv_append", _RECONCILED + "SELECT *, '1998-04-01 00:40' AS scheduled_ts, '1998-04-01 00:41' AS actual_ts FROM result")
def load_csv_append(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    tables.write_csv(reconcile.stamp(_reconciled(spark, d), "1998-04-01 00:40", "1998-04-01 00:41"), f"{path}/csv")
    tables.load_csv_append(spark, f"{path}/csv", reconcile.HISTORY, f"{path}/history")
    return spark.read.schema(reconcile.HISTORY).parquet(f"{path}/history")


# Gates


def _gate_sql(month: str) -> str:
    return f"""
SELECT * FROM (SELECT count(*) FILTER (last_order < DATE '{month}') = 0 AS all_last_orders_today_or_later FROM
  (SELECT oper_aff_id, max(ord_dt) AS last_order FROM {{demand}} WHERE ord_mo_yr_id >= 200107 AND oper_aff_id IN {_in(GATE_AFFILIATES)} GROUP BY 1)) WHERE all_last_orders_today_or_later"""


register("gate_demand_complete", _gate_sql("2001-07-01"))(lambda spark, d: gates.demand_complete(view(spark, d, "demand"), GATE_AFFILIATES, 200107, "2001-07-01"))
register("gate_demand_incomplete", _gate_sql("2001-08-01"))(lambda spark, d: gates.demand_complete(view(spark, d, "demand"), GATE_AFFILIATES, 200107, "2001-08-01"))
@register("gate_demand_observed", _gate_sql("2001-07-01"))
def gate_demand_observed(spark: SparkSession, d: str) -> DataFrame:
    """The same gate, from what was observed while demand was written: no row is read for it."""
    seen = tables.write_observed(view(spark, d, "demand"), scratch(spark), **gates.last_orders(GATE_AFFILIATES, 200107))
    passes = gates.demand_complete_of(seen, GATE_AFFILIATES, "2001-07-01")
    return spark.sql("SELECT TRUE AS all_last_orders_today_or_later").where(F.lit(passes))


register("gate_country_count", f"SELECT countries FROM (SELECT count(DISTINCT cntry_key_no) AS countries FROM ({_REVENUE}) WHERE mo_yr_key_no = '200105') WHERE countries >= 10")(
    lambda spark, d: gates.enough_countries(revenue_restated(spark, d), "200105", 10)
)


def _pending_sql(statuses: tuple[str, ...]) -> str:
    return f"SELECT CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS INT) AS check_val FROM {{vol}} WHERE aff_no IN {_in(GATE_AFFILIATES)} AND proc_stat_cd IN {_in(list(statuses))} AND bns_per_no = {PERIOD}"


register("gate_pending_transactions", _pending_sql(gates.PENDING))(lambda spark, d: gates.none_pending(view(spark, d, "vol"), GATE_AFFILIATES, PERIOD))
register("gate_pending_respawn", _pending_sql(gates.PENDING_RESPAWN))(lambda spark, d: gates.none_pending(view(spark, d, "vol"), GATE_AFFILIATES, PERIOD, gates.PENDING_RESPAWN))


@register("gate_nonempty", f"SELECT status, 1 = 1 AS passes FROM (SELECT DISTINCT proc_stat_cd AS status FROM {{vol}} WHERE bns_per_no = {PERIOD})")
def gate_nonempty(spark: SparkSession, d: str) -> DataFrame:
    found = view(spark, d, "vol").where(F.col("bns_per_no") == PERIOD).select(F.col("proc_stat_cd").alias("status")).distinct()
    return found.withColumn("passes", F.lit(gates.nonempty(found)))


# Tables


def _shape(*columns: str) -> str:
    return ", ".join(columns or ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))


def _other_case(df: DataFrame) -> DataFrame:
    """The same columns in another order, case and type: what a source might send."""
    return df.select(F.col("o_orderdate").alias("O_ORDERDATE"), F.col("o_totalprice").cast("string").alias("O_TOTALPRICE"), F.col("o_orderstatus").alias("O_ORDERSTATUS"), F.col("o_custkey").cast("string").alias("O_CUSTKEY"), F.col("o_orderkey").alias("O_ORDERKEY"))


_KEYS = ["o_orderkey"]


def _merge_sql(condition: str) -> str:
    take = f"(t.o_orderkey IS NULL OR (i.o_orderkey IS NOT NULL AND {condition}))"
    columns = ", ".join(f"CASE WHEN {take} THEN i.{c} ELSE t.{c} END AS {c}" for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    return f"SELECT coalesce(t.o_orderkey, i.o_orderkey) AS o_orderkey, {columns} FROM {{target}} t FULL JOIN {{incoming}} i ON t.o_orderkey = i.o_orderkey"


register("coerced_append", f"SELECT {_shape()} FROM {{target}} UNION ALL SELECT {_shape()} FROM {{incoming}}")(lambda spark, d: merge.append(view(spark, d, "target"), _other_case(view(spark, d, "incoming"))))


@register("multipart_append", f"SELECT {_shape()} FROM {{target}} UNION ALL SELECT {_shape()} FROM {{incoming}} WHERE o_orderkey % 2 = 1 UNION ALL SELECT {_shape()} FROM {{incoming}} WHERE o_orderkey % 2 = 0")
def multipart_append(spark: SparkSession, d: str) -> DataFrame:
    parts = _other_case(view(spark, d, "incoming"))
    first = merge.append(view(spark, d, "target"), parts.where("O_ORDERKEY % 2 = 1"))
    return merge.append(first, parts.where("O_ORDERKEY % 2 = 0"))


register("full_refresh", f"SELECT {_shape()} FROM {{incoming}}")(lambda spark, d: merge.full_refresh(view(spark, d, "target"), _other_case(view(spark, d, "incoming"))))
register("merge_newer", _merge_sql("i.o_orderdate > t.o_orderdate"))(lambda spark, d: merge.merge_newer(view(spark, d, "target"), _other_case(view(spark, d, "incoming")), _KEYS, "o_orderdate"))


@register("merge_newer_millis", _merge_sql("i.o_orderdate > t.o_orderdate"))
def merge_newer_millis(spark: SparkSession, d: str) -> DataFrame:
    sent = _other_case(view(spark, d, "incoming")).withColumn("O_ORDERDATE", F.unix_millis(F.col("O_ORDERDATE").cast("timestamp")))
    return merge.merge_newer(view(spark, d, "target"), sent, _KEYS, "o_orderdate", millis=True)


register("merge_upsert", _merge_sql("TRUE"))(lambda spark, d: merge.merge_upsert(view(spark, d, "target"), view(spark, d, "incoming"), _KEYS))
register("partial_refresh", f"SELECT {_shape()} FROM {{target}} WHERE NOT coalesce(year(o_orderdate) * 100 + month(o_orderdate) >= 200102, FALSE)")(
    lambda spark, d: merge.delete_since(view(spark, d, "target").withColumn("ym", cal.yearmonth(F.col("o_orderdate"))), "ym", cal.months_ago_yearmonth(cal.day(ORDER_DAY), 6).cast("int")).drop("ym")
)
register("delete_where", f"SELECT {_shape()} FROM {{target}} WHERE NOT coalesce(CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_orderstatus = 'O' END, FALSE)")(
    lambda spark, d: merge.delete_where(view(spark, d, "target"), F.when(F.col("o_custkey") % 7 == 0, F.lit(None).cast("boolean")).otherwise(F.col("o_orderstatus") == "O"))
)
register("high_watermark", "SELECT CAST(max(o_orderdate) AS VARCHAR) AS high_watermark FROM {target}")(
    lambda spark, d: merge.high_watermark(view(spark, d, "target"), "o_orderdate").select(F.date_format("high_watermark", "yyyy-MM-dd").alias("high_watermark"))
)

_CHECKPOINTS = "SELECT 'orders' AS source_system, o_orderstatus AS schema_name, CAST(o_custkey AS VARCHAR) AS table_name, max(CAST(o_orderdate AS DATE)) AS last_run FROM {orders} GROUP BY 1, 2, 3"


@register("checkpoint_update", f"SELECT source_system, schema_name, table_name, CAST(CASE WHEN schema_name = 'F' AND table_name = '7' THEN DATE '2024-01-01' ELSE last_run END AS VARCHAR) AS last_successful_run FROM ({_CHECKPOINTS})")
def checkpoint_update(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "orders").groupBy(F.lit("orders").alias("source_system"), F.col("o_orderstatus").alias("schema_name"), F.col("o_custkey").cast("string").alias("table_name"))
    kept = rows.agg(F.max(F.col("o_orderdate").cast("date")).alias("last_successful_run"))
    done = merge.set_checkpoint(kept, {"source_system": "orders", "schema_name": "F", "table_name": "7"}, F.to_date(F.lit("2024-01-01")))
    return done.withColumn("last_successful_run", F.col("last_successful_run").cast("string"))


_MILLIS = "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN -9000000000000 ELSE epoch_ms(CAST(o_orderdate AS TIMESTAMP)) END"


@register("coerce_epoch_millis", f"SELECT o_orderkey, CAST(make_timestamp(CASE WHEN ms < -2208988800000 THEN -2208988800000 ELSE ms END * 1000) AS DATE) AS d FROM (SELECT o_orderkey, {_MILLIS} AS ms FROM {{orders}})")
def coerce_epoch_millis(spark: SparkSession, d: str) -> DataFrame:
    ms = F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).when(F.col("o_orderkey") % 13 == 0, F.lit(-9000000000000)).otherwise(F.unix_millis(F.col("o_orderdate").cast("timestamp")))
    return view(spark, d, "orders").select("o_orderkey", coerce_col(ms, T.LongType(), T.DateType()).alias("d"))


# Extracts, partitions, files

_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
_SOURCE = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate"


def _as_date(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("date")).select(*_ORDER_COLUMNS)


def _source(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "orders").select(*_ORDER_COLUMNS)


register("extract_full", f"SELECT {_SOURCE} FROM orders")(lambda spark, d: _as_date(tables.extract(_source(spark, d))))
register("extract_append", f"SELECT {_SOURCE} FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'")(
    lambda spark, d: _as_date(tables.extract(_source(spark, d), "append", "o_orderdate", F.to_timestamp_ntz(F.lit("2001-01-01 00:00:00"))))
)
register("extract_incremental", f"SELECT {_SOURCE} FROM orders WHERE o_orderdate >= TIMESTAMP '2000-05-05' AND o_orderdate < TIMESTAMP '2000-05-06'")(
    lambda spark, d: _as_date(tables.extract(_source(spark, d), "incremental", "o_orderdate", day="2000-05-05"))
)


@register("write_day_partition", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders")
def write_day_partition(spark: SparkSession, d: str) -> DataFrame:
    """All orders by day; then a second run of one day, which replaces it."""
    path = scratch(spark)
    rows = _as_date(_source(spark, d))
    tables.write_day_partitions(rows, path, F.col("o_orderdate"))
    tables.write_day_partition(rows.where("o_orderdate = DATE '2000-05-05'"), path, "2000-05-05")
    schema = rows.schema.add("year", "integer").add("month", "integer").add("day", "integer")
    return spark.read.schema(schema).parquet(path)


@register("csv_roundtrip", "SELECT c_custkey, concat(c_name, ', \"', c_mktsegment, '\"') AS c_name, c_mktsegment FROM customer")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("c_name"), "c_mktsegment")
    tables.write_csv(rows, path := scratch(spark))
    return tables.read_csv(spark, path, "c_custkey long, c_name string, c_mktsegment string")


@register("publish_partition", f"SELECT {_SOURCE}, day(o_orderdate) AS day FROM orders")
def publish_partition(spark: SparkSession, d: str) -> DataFrame:
    """All orders, in a partition for each day of the month, published in one job; then one partition again, by itself."""
    path = scratch(spark)
    rows = _as_date(_source(spark, d)).withColumn("day", F.dayofmonth("o_orderdate"))
    rows.write.partitionBy("day").parquet(f"{path}/incoming")
    rows.select("o_orderstatus", "day").write.partitionBy("day").mode("append").text(f"{path}/incoming")  # other files stay behind
    tables.publish_partitions(spark, f"{path}/incoming", f"{path}/final", "parquet", "day", rows.schema)
    tables.publish_partition(spark, f"{path}/incoming", f"{path}/final", ("avro", "parquet", "csv"), "day=5", rows.drop("day").schema)
    return spark.read.schema(rows.schema).parquet(f"{path}/final")


@register("replace_table", f"SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM (SELECT {_SOURCE} FROM orders)")
def replace_table(spark: SparkSession, d: str) -> DataFrame:
    """The second version has all rows of the first, with other prices."""
    t = tables.VersionedTable(spark, scratch(spark))
    t.replace(_as_date(_source(spark, d)))
    t.replace(t.read().withColumn("o_totalprice", F.col("o_totalprice") * 2))
    return t.read()


@register("conform_schema", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def conform_schema(spark: SparkSession, d: str) -> DataFrame:
    stored = T.StructType.fromDDL("o_orderkey long, o_custkey string, o_orderstatus string, o_totalprice double, o_orderdate date")
    return conform(_source(spark, d).toDF(*[c.upper() for c in _ORDER_COLUMNS]), stored)


@register("infer_schema_sample", f"SELECT {_SOURCE} FROM orders")
def infer_schema_sample(spark: SparkSession, d: str) -> DataFrame:
    """All rows, conformed to what all of them show: no time of day, so a date."""
    source = _source(spark, d)
    return conform(source, infer_schema(source))


@register("ingest_roundtrip", _merge_sql("i.o_orderdate > t.o_orderdate"))
def ingest_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Extract after the stored watermark, conform, day partition, publish, merge, advance; a second run finds nothing new."""
    path = scratch(spark)
    sent, key = view(spark, d, "incoming"), {"source_system": "shop", "schema_name": "sales", "table_name": "orders"}
    t, marks = tables.VersionedTable(spark, f"{path}/table"), tables.VersionedTable(spark, f"{path}/watermarks")
    t.replace(view(spark, d, "target"))
    marks.replace(merge.watermark_row(spark, key, datetime.datetime(1900, 1, 1)))
    for day in (1, 2):
        after = merge.get_watermark(marks, key, t.read(), "o_orderdate")
        new = tables.extract(conform(_other_case(sent), sent.schema), "append", "o_orderdate", F.lit(after))
        tables.write_day_partition(new, f"{path}/incoming", f"2024-01-0{day}")
        tables.publish_partition(spark, f"{path}/incoming", f"{path}/final", "parquet", f"year=2024/month=01/day=0{day}")
        loaded = spark.read.schema(sent.schema).parquet(f"{path}/final/year=2024/month=01/day=0{day}")
        seen = t.replace(merge.merge_newer(t.read(), loaded, _KEYS, "o_orderdate"), latest=merge.latest("o_orderdate"))
        merge.store_watermark(marks, key, seen["latest"])
    return t.read()


@register("ingest_first_load", _merge_sql("i.o_orderdate > t.o_orderdate").replace("{incoming} i", "(SELECT * FROM {incoming} WHERE o_orderdate > (SELECT max(o_orderdate) FROM {target})) i"))
def ingest_first_load(spark: SparkSession, d: str) -> DataFrame:
    """Append loads into a table that is empty at first, with no watermark and no schema stored: the first takes all, the second what is later."""
    path, key = scratch(spark), {"source_system": "shop", "schema_name": "sales", "table_name": "orders"}
    t, marks, store = tables.VersionedTable(spark, f"{path}/table"), tables.VersionedTable(spark, f"{path}/watermarks"), schemas.SchemaStore(spark, f"{path}/schemas").create()
    marks.replace(spark.createDataFrame([], merge.WATERMARKS))
    for n, name in enumerate(("target", "incoming")):
        sent = _other_case(view(spark, d, name)).withColumn("O_TOTALPRICE", F.col("O_TOTALPRICE").cast("decimal(14,2)")).withColumn("O_CUSTKEY", F.col("O_CUSTKEY").cast("long"))
        loaded = store.enforce(key, sent if n == 0 else _other_case(view(spark, d, name)))
        if n == 0:
            t.replace(spark.createDataFrame([], loaded.schema))
        after = merge.get_watermark(marks, key, t.read(), "o_orderdate")
        new = tables.extract(loaded, "append", "o_orderdate", after and F.lit(after))
        seen = t.replace(merge.merge_newer(t.read(), new, _KEYS, "o_orderdate"), latest=merge.latest("o_orderdate"))
        merge.store_watermark(marks, key, seen["latest"])
    return t.read()


# The second load sends the customer as text, some of it no number, a note that is new, and no status.
_SECOND = "SELECT o_orderkey AS O_ORDERKEY, CASE WHEN o_orderkey % 4 = 0 THEN concat('C', CAST(o_custkey AS VARCHAR(20))) ELSE CAST(o_custkey AS VARCHAR(20)) END AS O_CUSTKEY, o_totalprice AS O_TOTALPRICE, CAST(o_orderdate AS TIMESTAMP) AS O_ORDERDATE, 'late' AS NOTE FROM {incoming}"
_ORDERS_KEY = {"source_system": "shop", "schema_name": "sales", "table_name": "orders"}


def _loads(spark: SparkSession, d: str) -> tuple[schemas.SchemaStore, DataFrame, DataFrame]:
    store = schemas.SchemaStore(spark, scratch(spark)).create()
    first = view(spark, d, "target").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    second = spark.sql(_SECOND, incoming=view(spark, d, "incoming"))
    return store, store.enforce(_ORDERS_KEY, first), second


@register("schema_store_loads", f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus FROM {{target}}
UNION ALL SELECT O_ORDERKEY, TRY_CAST(O_CUSTKEY AS BIGINT), O_TOTALPRICE, CAST(O_ORDERDATE AS DATE), NULL FROM ({_SECOND})""")
def schema_store_loads(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of one source, the second in other types: both in the schema that the first one stored."""
    store, first, second = _loads(spark, d)
    return first.unionByName(store.enforce(_ORDERS_KEY, second))


@register("schema_drift", f"""SELECT * FROM (VALUES ('o_orderstatus', 'lost', 'string', NULL), ('o_custkey', 'retyped', 'bigint', 'string'), ('o_orderdate', 'retyped', 'date', 'timestamp'), ('note', 'new', NULL, 'string')) v(column_name, change, stored_type, sent_type),
  (SELECT count(*) AS n_rows, count(*) FILTER (TRY_CAST(O_CUSTKEY AS BIGINT) IS NULL AND O_CUSTKEY IS NOT NULL) AS bad FROM ({_SECOND}))""".replace("SELECT * FROM (VALUES", "SELECT column_name, change, stored_type, sent_type, n_rows, CASE WHEN column_name = 'o_custkey' THEN bad ELSE 0 END AS n_unfit FROM (VALUES"))
def schema_drift(spark: SparkSession, d: str) -> DataFrame:
    """What the second load changed against the stored schema, and how many of its values don't fit."""
    store, _, second = _loads(spark, d)
    return schemas.drift(store.get(_ORDERS_KEY), second)


@register("zipped_csv", "SELECT c_custkey, c_mktsegment || chr(10) || 'segment' AS c_mktsegment, c_nationkey FROM customer")
def zipped_csv(spark: SparkSession, d: str) -> DataFrame:
    """One archive per nation and slice of customers, each with a header-only member besides."""

    def zipped_group(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("empty.csv", "c_custkey,c_mktsegment,c_nationkey\n")
            z.writestr("rows.txt", "c_custkey,c_mktsegment,c_nationkey\n" + "".join(f'{a},"{b}\nsegment",{c}\n' for a, b, c in zip(*(t.column(k).to_pylist() for k in ("c_custkey", "c_mktsegment", "c_nationkey")), strict=True)))
        return pa.table({"path": pa.array([f"{key[0].as_py()}-{key[1].as_py()}.zip"]), "content": pa.array([out.getvalue()], pa.binary())})

    rows = view(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey").withColumn("part", F.floor(F.col("c_custkey") / 5000))
    archives = rows.groupBy("c_nationkey", "part").applyInArrow(zipped_group, "path string, content binary")
    return zipped.read_zipped_csv(archives, "c_custkey long, c_mktsegment string, c_nationkey int").select("c_custkey", "c_mktsegment", "c_nationkey")


# Schemas

_KINDS = {
    "oracle": ["NUMBER", "LONG", "BLOB", "FLOAT", "DATE", "DATETIME", "TIMESTAMP(6)", "VARCHAR2"],
    "as400": ["DECIMAL", "NUMERIC", "DATE", "TIMESTMP", "CHAR"],
    "postgres": ["numeric", "bigint", "smallint", "integer", "decimal", "boolean", "double precision", "real", "date", "timestamp without time zone", "text"],
}


def _typed_catalog(spark: SparkSession, d: str, kinds: list[str]) -> DataFrame:
    named = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("kind") % len(kinds) + 1).cast("int"))
    return view(spark, d, "catalog").select("table_name", "column_id", "column_name", named.alias("data_type"), "data_scale", "data_precision", "nullable")


def _catalog_sql(kinds: list[str]) -> str:
    listed = "[" + ", ".join(repr(k) for k in kinds) + "]"
    return f"SELECT table_name, column_id, column_name, {listed}[CAST(kind % {len(kinds)} + 1 AS INT)] AS data_type, data_scale, data_precision, nullable FROM {{catalog}}"


_SCALED = "CASE WHEN data_scale IS NULL OR data_scale > 0 THEN 'NUMERIC' ELSE 'INT64' END"
_MAPS = {
    "oracle": f"CASE WHEN data_type = 'NUMBER' THEN {_SCALED} WHEN data_type = 'LONG' THEN 'INT64' WHEN data_type = 'BLOB' THEN 'BYTES' WHEN data_type = 'FLOAT' THEN 'FLOAT64' WHEN data_type IN ('DATE', 'DATETIME') OR data_type LIKE 'TIMESTAMP%' THEN 'TIMESTAMP' ELSE 'STRING' END",
    "as400": f"CASE WHEN data_type IN ('DECIMAL', 'NUMERIC') THEN {_SCALED} WHEN data_type IN ('DATE', 'TIMESTMP') THEN 'TIMESTAMP' ELSE 'STRING' END",
    "postgres": f"CASE WHEN data_type = 'numeric' THEN {_SCALED} WHEN data_type IN ('bigint', 'smallint', 'integer') THEN 'INT64' WHEN data_type = 'decimal' THEN 'NUMERIC' WHEN data_type = 'boolean' THEN 'BOOLEAN' WHEN data_type IN ('double precision', 'real') THEN 'FLOAT64' WHEN data_type = 'date' THEN 'DATE' WHEN data_type LIKE 'timestamp%' THEN 'TIMESTAMP' ELSE 'STRING' END",
}


def _map_query(dialect: str) -> Query:
    return lambda spark, d: getattr(typemap, dialect)(_typed_catalog(spark, d, _KINDS[dialect]))


for _dialect, _case in _MAPS.items():
    register(f"map_types_{_dialect}", f"SELECT *, {_case} AS type, CASE WHEN nullable IN ('Y', 'YES') THEN 'NULLABLE' ELSE 'REQUIRED' END AS mode FROM ({_catalog_sql(_KINDS[_dialect])})")(_map_query(_dialect))

register(
    "map_types_avro",
    f"""SELECT table_name, string_agg(concat(column_name, '=', CASE WHEN data_type = 'NUMBER' AND data_scale > 0 THEN 'Double' WHEN data_type = 'NUMBER' AND data_precision > 9 THEN 'Long'
  WHEN data_type = 'NUMBER' THEN 'Integer' WHEN data_type = 'FLOAT' THEN 'Double' ELSE 'String' END), ', ' ORDER BY column_id) AS columns FROM ({_catalog_sql(_KINDS["oracle"])}) GROUP BY 1""",
)(lambda spark, d: typemap.java_columns(_typed_catalog(spark, d, _KINDS["oracle"])))


@register("sanitize_names", "SELECT c_custkey AS cust_key, c_name AS in_fo__na_me, c_mktsegment AS tags_0 FROM customer")
def sanitize_names(spark: SparkSession, d: str) -> DataFrame:
    nested = view(spark, d, "customer").select(
        F.col("c_custkey").alias("cust-key"), F.struct(F.col("c_name").alias("na me"), F.array(F.struct(F.col("c_mktsegment").alias("seg.ment"))).alias("t@gs")).alias("in fo")
    )
    clean = names.sanitize(nested)
    return clean.select("cust_key", F.col("in_fo.na_me").alias("in_fo__na_me"), F.col("in_fo.t_gs")[0]["seg_ment"].alias("tags_0"))


@register(
    "sanitize_json",
    r"""SELECT o_orderkey, concat('{"order_key": ', o_orderkey, ', "cust_info":{"cust_key":', o_custkey, ', "st_tus":["', o_orderstatus, '", {"to_tal":"a-b: \"q r\":"}]}, "ok":null}') AS doc,
  'pri_ority' AS map_key, o_orderpriority AS inner_value, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE concat('{"a_b":', o_custkey, '}') END AS whole FROM orders""",
)
def sanitize_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON text and maps, nested, of every order; every other text lacks its last bracket."""
    rows = view(spark, d, "orders")
    text = F.concat(F.lit('{"order key": '), "o_orderkey", F.lit(', "cust.info" :{"cust-key":'), "o_custkey", F.lit(', "st@tus":["'), "o_orderstatus", F.lit('", {"to\\u0020tal":"a-b: \\"q r\\":"}]}, "ok":null}'))
    maps = F.create_map(F.lit("pri ority"), F.create_map(F.lit("o-p"), F.col("o_orderpriority")))
    half = F.concat(F.lit('{"a b":'), "o_custkey", F.when(F.col("o_orderkey") % 2 == 1, F.lit("}")).otherwise(F.lit("")))
    clean = names.sanitize(rows.select("o_orderkey", text.alias("doc"), maps.alias("ma p"), half.alias("whole")))
    key = F.map_keys("ma_p")[0]
    return clean.select("o_orderkey", names.sanitize_json(F.col("doc")).alias("doc"), key.alias("map_key"), F.col("ma_p")[key]["o_p"].alias("inner_value"), names.sanitize_json(F.col("whole")).alias("whole"))


_OPTIONS = """
SELECT CASE p_partkey % 5 WHEN 0 THEN 'incoming_a' WHEN 1 THEN 'staging_b' WHEN 2 THEN 'curated' WHEN 3 THEN 'temp' ELSE 'sales' END AS table_schema, CAST(p_partkey AS VARCHAR(20)) AS table_name,
  CASE WHEN p_size % 2 = 0 THEN 'description' ELSE 'labels' END AS option_name, p_name AS option_value FROM {part}"""
_KEPT = " AND ".join(f"NOT starts_with(table_schema, '{p}')" for p in metadata.SKIPPED)


@register("metadata_snapshot", f"SELECT *, DATE '{LOAD_DATE}' AS load_date FROM ({_OPTIONS}) WHERE {_KEPT} AND option_name = 'description' UNION ALL SELECT *, DATE '{LOAD_DATE}' AS load_date FROM ({_OPTIONS}) WHERE {_KEPT}")
def metadata_snapshot(spark: SparkSession, d: str) -> DataFrame:
    options = spark.sql(_OPTIONS, part=view(spark, d, "part"))
    return metadata.table_snapshot(options, LOAD_DATE).unionByName(metadata.column_snapshot(options, LOAD_DATE))


# Calendar

_DAY = "CAST(o_orderdate AS DATE)"
_BACK = f"CAST({_DAY} - INTERVAL 2 YEAR AS DATE)"


def _calendar(column: Callable[[Column], Column], name: str) -> Query:
    return lambda spark, d: view(spark, d, "orders").select("o_orderkey", column(F.col("o_orderdate").cast("date")).alias(name))


register("performance_year", f"SELECT o_orderkey, CASE WHEN month({_BACK}) >= 9 THEN make_date(year({_BACK}), 9, 1) ELSE make_date(year({_BACK}) - 1, 9, 1) END AS start_date FROM orders")(
    _calendar(lambda c: cal.performance_year_start(c, 2), "start_date")
)
register("performance_year_yearmonth", f"SELECT o_orderkey, strftime(CASE WHEN month({_BACK}) >= 9 THEN make_date(year({_BACK}), 9, 1) ELSE make_date(year({_BACK}) - 1, 9, 1) END, '%Y%m') AS start_month FROM orders")(
    _calendar(lambda c: cal.performance_year_yearmonth(c, 2), "start_month")
)
register("months_ago_yearmonth", f"SELECT o_orderkey, strftime({_DAY} - INTERVAL 5 MONTH, '%Y%m') AS ym FROM orders")(_calendar(lambda c: cal.months_ago_yearmonth(c, 5), "ym"))
register("bonus_period", f"SELECT o_orderkey, strftime(CASE WHEN day({_DAY}) <= 7 THEN {_DAY} - INTERVAL 1 MONTH ELSE {_DAY} END, '%Y%m') AS period FROM orders")(_calendar(cal.bonus_period, "period"))

# Streams


@register("stream_daily_counts", "SELECT CAST(ts AS DATE) AS day, user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of a stream over all events, as the latest update of each day and key leaves them.

    Files come by modification time, not by ts, so there is no watermark: it would drop rows of later batches.
    """
    path = scratch(spark)
    # A stream's path is a folder or a pattern; this pattern takes the table whichever it is.
    events = stream.read_stream(spark, f"{d}/events.parque[t]", view(spark, d, "events").schema)

    def each(batch: DataFrame, n: int) -> None:
        batch.withColumn("_batch", F.lit(n)).write.mode("append").parquet(f"{path}/updates")

    stream.run_to_end(stream.daily_counts(events, late=None), f"{path}/checkpoint", each)
    updates = spark.read.parquet(f"{path}/updates")
    return updates.groupBy("day", "user_id", "event_type").agg(F.max_by("n", "_batch").alias("n"))


#: Batches in which all events come twice.
IDENTITY_BATCHES = 6


@register("stream_daily_identity", _click_sql("product_view_pdp"))
def stream_daily_identity(spark: SparkSession, d: str) -> DataFrame:
    """The daily identity counts as a stream over all events, each of which is delivered twice."""
    path = scratch(spark)
    for n in (1, 2):
        view(spark, d, "events").write.mode("append").parquet(f"{path}/events")
    # As many batches for a large table as for a small one: each sends its tasks' reports, and the identities if they are few, to the driver.
    files = len(spark.read.parquet(f"{path}/events").inputFiles())
    sent = spark.sql(standins.CLICKS_WITH_ID, events=stream.read_stream(spark, f"{path}/events", view(spark, d, "events").schema, -(-files // IDENTITY_BATCHES)))
    users = _stored(view(spark, d, "users").distinct())  # read in each batch
    # The watermark spans the table: its files come by modification time, not by ts.
    counts = stream.daily_identity(sent, users, dims.markets(spark), "product_view_pdp", CLICK_DAY, late="400 days")
    updates = stream.MarketUpdates(spark, f"{path}/updates")
    stream.run_to_end(counts, f"{path}/checkpoint", updates.each)
    return updates.latest(counts.schema, "product_view_pdp")


@register("stream_merge_newer", f"SELECT {_shape()} FROM ({_merge_sql('i.o_orderdate > t.o_orderdate')})")
def stream_merge_newer(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark)
    sent = view(spark, d, "incoming")
    sent.write.parquet(f"{path}/incoming")
    t = buckets.BucketTable(spark, f"{path}/table", sent.schema, _KEYS, 8).create()
    t.update(view(spark, d, "target"), lambda _, rows: rows)
    stream.merge_stream(t, stream.read_stream(spark, f"{path}/incoming", sent.schema), _KEYS, "o_orderdate", f"{path}/checkpoint")
    return t.read()


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
