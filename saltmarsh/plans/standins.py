"""Business tables derived from the driver's star schema.

Each is one SQL text, valid in Spark and DuckDB alike, so that a query and its oracle start from the
same rows. This is the only module that knows the driver's table names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events".split()

VIEWS = {
    "demand": """
SELECT c_nationkey*10 AS oper_aff_id, c_nationkey AS oper_cntry_id, o_custkey AS global_account_id,
  CASE WHEN o_orderkey % 10 = 0 THEN o_custkey + 1 ELSE o_custkey END AS global_vol_account_id,
  o_custkey AS ord_account_id, l_suppkey AS shp_account_id, o_orderkey AS ord_id, CAST(o_orderdate AS DATE) AS ord_dt,
  CAST(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) AS INT) AS ord_dt_key_no,
  CAST(year(o_orderdate)*100+month(o_orderdate) AS INT) AS ord_mo_yr_id, o_orderstatus = 'P' AS ord_canc_flag,
  l_partkey AS ord_item_cd, l_partkey % 50 AS ord_item_base_cd, CAST(l_quantity AS INT) AS ord_qty,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'ABO' ELSE 'CUSTOMER' END AS account_type_ord,
  CAST(l_extendedprice AS DECIMAL(14,2)) AS catalog_ln_usd_net,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS adj_ln_usd_net,
  CAST(l_quantity AS DECIMAL(14,2)) AS adj_ln_pv, CAST(l_quantity * 2 AS DECIMAL(14,2)) AS adj_ln_bv
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey""",
    "account": """
SELECT c_custkey AS account_id, c_custkey AS global_account_id, c_nationkey AS cntry_id, c_nationkey*10 AS aff_id,
  substring(c_mktsegment,1,1) AS bus_natr_cd,
  CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'ABO PRIMARY' ELSE 'CUSTOMER' END AS account_type_desc,
  CASE WHEN c_acctbal >= 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status_desc, c_acctbal > 5000 AS auto_renewal_flag,
  CAST(min_dt AS DATE) AS current_entry_dt
FROM {customer} JOIN (SELECT o_custkey, min(o_orderdate) AS min_dt FROM {orders} GROUP BY o_custkey) f ON c_custkey = o_custkey""",
    "countries": "SELECT n_nationkey AS country_no, n_name AS country_short_name, n_regionkey AS region_no FROM {nation}",
    "clicks": """
SELECT user_id, event_id % 40 AS session_id, ts AS time, CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS product_id,
  CASE event_type WHEN 'view' THEN 'product_view_pdp' WHEN 'click' THEN 'added_to_cart' WHEN 'purchase' THEN 'orders_submitted'
    WHEN 'signup' THEN 'search_view' ELSE 'other' END AS event,
  CASE WHEN user_id % 3 = 0 THEN 'a.example' ELSE 'b.example' END AS domain,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('kw', CAST(event_id % 7 AS VARCHAR(9))) END AS searchkeyword
FROM {events}""",
    "users": """
SELECT DISTINCT user_id, user_id + 1000 AS identity FROM {events} WHERE user_id % 4 <> 0
UNION ALL SELECT DISTINCT user_id, user_id + 2000 AS identity FROM {events} WHERE user_id % 10 = 1""",
    "macro_rev": """
SELECT CAST(year(o_orderdate) AS INT) AS calen_yr4, CAST(month(o_orderdate) AS INT) AS calen_mo,
  CASE WHEN c_nationkey < 10 THEN concat('0', CAST(c_nationkey AS VARCHAR(9))) ELSE CAST(c_nationkey AS VARCHAR(9)) END AS cntry_cd,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS rev_dist_sales_amt,
  CAST(CAST(1 + (c_nationkey + month(o_orderdate)) % 5 AS DECIMAL(6,2)) * CAST(0.25 AS DECIMAL(6,2)) AS DECIMAL(6,2)) AS exchg_bdgt_pct
FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY year(o_orderdate), month(o_orderdate), c_nationkey""",
    "corp": """
SELECT CASE WHEN n_nationkey < 10 THEN concat('0', CAST(n_nationkey AS VARCHAR(9))) ELSE CAST(n_nationkey AS VARCHAR(9)) END AS cntry_cd,
  n_name AS corp_nm, concat('C', CAST(n_nationkey AS VARCHAR(9))) AS corp_cd FROM {nation}""",
    "vol": """
SELECT CAST(year(o_orderdate)*100+month(o_orderdate) AS INT) AS bns_per_no, c_nationkey*10 AS aff_no, c_nationkey AS bus_entty_no, t.vol_type_cd,
  CAST(CASE WHEN t.vol_type_cd = '017' AND c_nationkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(14,2)) AS pv_qty,
  CAST(o_totalprice*2 AS DECIMAL(14,2)) AS bns_vol_qty, o_orderkey AS bns_trx_id,
  CASE o_orderstatus WHEN 'F' THEN 'cp' WHEN 'O' THEN 'pn' ELSE 'pk' END AS proc_stat_cd
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
CROSS JOIN (SELECT '001' AS vol_type_cd UNION ALL SELECT '017' UNION ALL SELECT '086') t
WHERE NOT (t.vol_type_cd = '086' AND c_nationkey % 7 = 3)""",
    # The four measures of the reconciliation, from sources of their own. Each country has a customer that stands for its
    # affiliate (ids below 0); affiliates of countries 4, 14 and 24 have detail that their transactions lack.
    "cust_mst": """
SELECT c_custkey AS bns_cust_id, c_nationkey * 10 AS aff_no FROM {customer}
UNION ALL SELECT -1 - n_nationkey AS bns_cust_id, n_nationkey * 10 AS aff_no FROM {nation}""",
    "aff_mst": "SELECT n_nationkey * 10 AS aff_no, -1 - n_nationkey AS alias_cust_id FROM {nation} WHERE n_nationkey % 7 <> 3",
    "vol_dtl": """
SELECT bns_per_no, CASE WHEN vol_type_cd = '086' THEN -1 - bus_entty_no ELSE bns_cust_id END AS bns_cust_id, bus_entty_no, vol_type_cd, pv_qty, bns_vol_qty FROM (
  SELECT CAST(year(o_orderdate)*100+month(o_orderdate) AS INT) AS bns_per_no, o_custkey AS bns_cust_id, c_nationkey AS bus_entty_no, t.vol_type_cd,
    CAST(CASE WHEN t.vol_type_cd = '017' AND c_nationkey % 4 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(14,2)) AS pv_qty,
    CAST(o_totalprice*2 AS DECIMAL(14,2)) AS bns_vol_qty
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey
  CROSS JOIN (SELECT '001' AS vol_type_cd UNION ALL SELECT '017' UNION ALL SELECT '086') t
  WHERE o_orderstatus IN ('F', 'O') OR (c_nationkey % 10 = 4 AND o_orderkey % 3 = 0)) v""",
    "trx_mst": """
SELECT o_orderkey AS bns_trx_id, CAST(year(o_orderdate)*100+month(o_orderdate) AS INT) AS bns_per_no, c_nationkey*10 AS aff_no, c_nationkey AS bus_entty_no,
  CASE o_orderstatus WHEN 'F' THEN 'cp' WHEN 'O' THEN 'pn' ELSE 'pk' END AS proc_stat_cd
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "trx_dtl": """
SELECT o_orderkey AS bns_trx_id, '001' AS vol_type_cd, CAST(CAST(o_totalprice AS DECIMAL(14,2)) - 1 AS DECIMAL(14,2)) AS pv_qty, CAST(o_totalprice*2 AS DECIMAL(14,2)) AS bns_vol_qty FROM {orders}
UNION ALL SELECT o_orderkey AS bns_trx_id, '001' AS vol_type_cd, CAST(1 AS DECIMAL(14,2)) AS pv_qty, CAST(0 AS DECIMAL(14,2)) AS bns_vol_qty FROM {orders}
UNION ALL SELECT o_orderkey AS bns_trx_id, '017' AS vol_type_cd, CAST(5 AS DECIMAL(14,2)) AS pv_qty, CAST(5 AS DECIMAL(14,2)) AS bns_vol_qty FROM {orders}""",
    "ord_accounts": "SELECT * FROM {account} WHERE account_id % 9 <> 0",
    "ship_accounts": """
SELECT account_id, cntry_id, bus_natr_cd FROM {account}
UNION ALL SELECT account_id, (cntry_id + 1) % 25 AS cntry_id, bus_natr_cd FROM {account} WHERE account_id % 3 = 0""",
    "sponsor": """
SELECT a.aff_id, a.global_account_id, a.current_entry_dt AS app_entry_date,
  count(CASE WHEN age BETWEEN 0 AND 13 THEN 1 END) AS sponsoring_count_0_to_13_days_tenure,
  count(CASE WHEN age BETWEEN 14 AND 30 THEN 1 END) AS sponsoring_count_14_to_30_days_tenure,
  count(CASE WHEN age BETWEEN 31 AND 60 THEN 1 END) AS sponsoring_count_31_to_60_days_tenure,
  count(CASE WHEN age BETWEEN 61 AND 180 THEN 1 END) AS sponsoring_count_61_to_180_days_tenure,
  count(CASE WHEN age > 180 THEN 1 END) AS sponsoring_count_more_than_180_days_tenure
FROM {account} a JOIN (
  SELECT o_custkey, extract(day FROM (o_orderdate - min_dt)) AS age
  FROM (SELECT o_custkey, o_orderdate, min(o_orderdate) OVER (PARTITION BY o_custkey) AS min_dt FROM {orders}) s) o
ON a.global_account_id = o.o_custkey GROUP BY a.aff_id, a.global_account_id, a.current_entry_dt""",
    "plan_info": """
SELECT d.global_account_id, d.ord_mo_yr_id AS year_month, max(d.oper_aff_id) AS aff_id,
  CAST(year(max(d.ord_dt))*12+month(max(d.ord_dt))-year(max(a.current_entry_dt))*12-month(max(a.current_entry_dt)) AS INT) AS account_age_in_months,
  d.global_account_id % 12 AS silver_month, max(a.bus_natr_cd) AS account_class_code,
  CASE WHEN d.global_account_id % 5 = 0 THEN '1' ELSE '2' END AS business_nature_code,
  sum(d.adj_ln_pv) > 250 AS new_percent_level_flag, sum(d.adj_ln_pv) > 100 AS producer_flag,
  CAST(d.global_account_id % 8 * 3 AS INT) AS performance_bonus_percent,
  CASE WHEN d.global_account_id % 7 = 0 THEN CAST(0 AS DECIMAL(24,2)) ELSE CAST(sum(d.adj_ln_pv) AS DECIMAL(24,2)) END AS personal_pv,
  CAST(sum(d.adj_ln_pv) AS DECIMAL(24,2)) AS personal_pv_normalized_to_10k, CAST(sum(d.adj_ln_pv) * 2 AS DECIMAL(24,2)) AS group_pv_normalized_to_10k,
  CAST(sum(d.adj_ln_pv) * 3 AS DECIMAL(24,2)) AS total_downline_pv_normalized_to_10k, CAST(sum(d.adj_ln_bv) AS DECIMAL(24,2)) AS personal_bv,
  CAST(sum(d.adj_ln_bv) * 2 AS DECIMAL(24,2)) AS group_bv, CAST(sum(d.adj_ln_bv) * 3 AS DECIMAL(24,2)) AS total_downline_bv,
  CAST(sum(d.catalog_ln_usd_net) AS DECIMAL(24,2)) AS total_bonus_local_currency, sum(d.adj_ln_pv) > 150 AS is_at_15_pct_or_above,
  CASE WHEN sum(d.adj_ln_pv) > 100 THEN 1 ELSE 0 END AS silver_title_holder, CASE WHEN sum(d.adj_ln_pv) > 200 THEN 1 ELSE 0 END AS gold_title_holder,
  CASE WHEN sum(d.adj_ln_pv) > 300 THEN 1 ELSE 0 END AS platinum_title_holder, CASE WHEN sum(d.adj_ln_pv) > 400 THEN 1 ELSE 0 END AS emerald_title_holder,
  CASE WHEN sum(d.adj_ln_pv) > 500 THEN 1 ELSE 0 END AS diamond_title_holder,
"""
    + ",\n".join(f"  CASE WHEN {n} <= d.global_account_id % 8 THEN CAST(sum(d.adj_ln_pv) AS DECIMAL(24,2)) ELSE CAST(0 AS DECIMAL(24,2)) END AS leg{n}_total_downline_pv" for n in range(1, 8))
    + """
FROM {demand} d JOIN {account} a ON d.global_account_id = a.global_account_id GROUP BY d.global_account_id, d.ord_mo_yr_id""",
    "target": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM {orders} WHERE o_orderkey % 2 = 0""",
    "incoming": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice + 1 AS DECIMAL(14,2)) AS o_totalprice,
  CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE -1 END AS o_orderdate
FROM {orders} WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)), CAST(o_orderdate AS DATE)
FROM {orders} WHERE o_orderkey % 30 = 0""",
    # One row per catalog column: as many tables as there are parts, four columns each.
    "catalog": """
SELECT p_partkey AS table_name, p_partkey % 2 AS parity, c.k AS column_id, concat('C', CAST(c.k AS VARCHAR(9))) AS column_name,
  (p_partkey + c.k) % 14 AS kind, CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size % 3 - 1 AS INT) END AS data_scale,
  CAST(5 + p_size % 12 AS INT) AS data_precision, CASE WHEN p_partkey % 2 = 0 THEN 'Y' ELSE 'N' END AS nullable
FROM {part} CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) c""",
}


#: The clicks with the id by which an event that is delivered again is known.
CLICKS_WITH_ID = VIEWS["clicks"].replace("SELECT user_id,", "SELECT event_id, user_id,", 1)


def names(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def tables_of(text: str) -> set[str]:
    """The driver's tables that a text with {names} is made of."""
    return {t for n in names(text) for t in (tables_of(VIEWS[n]) if n in VIEWS else {n})}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in or a driver's table as a DataFrame."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n) for n in names(VIEWS[name])})


def with_views(query: str) -> str:
    """A DuckDB statement: query with the stand-ins it names (as {name}) put before it."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in VIEWS and name not in order:
            for n in names(VIEWS[name]):
                need(n)
            order.append(name)

    for n in names(query):
        need(n)
    plain = lambda t: re.sub(r"\{(\w+)\}", r"\1", t)
    head = ",\n".join(f"{n} AS ({plain(VIEWS[n])})" for n in order)
    body = plain(query).strip()
    if not head:
        return body
    return f"WITH {head},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {head}\n{body}"
