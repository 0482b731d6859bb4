"""The order base table and its export by country."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions import calendar as cal
from saltmarsh.functions.bounded import small
from saltmarsh.functions.skew import spread_join


def order_base(demand: DataFrame, order_accounts: DataFrame, ship_accounts: DataFrame, countries: DataFrame, as_of: datetime.date | str, months: int = 6, strict_country: bool = False, spread_above: int | None = None) -> DataFrame:
    """Order lines of the last months with the ordering and the shipping account's nature.

    By default the shipping account matches by id in every country, but only where the ordering
    account was found; with strict_country it matches by id and country. A shipping account that makes more than
    `spread_above` rows, as one of many lines does that is known in every country, is joined in shares (`skew.spread_join`).
    """
    since = cal.months_ago_yearmonth(cal.day(as_of), months).cast("int")
    d = demand.where(F.col("ord_mo_yr_id") >= since).alias("d")
    ordering = order_accounts.select(F.col("cntry_id").alias("o_cntry"), F.col("account_id").alias("o_account"), F.col("bus_natr_cd").alias("ord_bus_natr_cd"))
    shipping = ship_accounts.select(F.col("cntry_id").alias("s_cntry"), F.col("account_id").alias("s_account"), F.col("bus_natr_cd").alias("ship_bus_natr_cd"))
    place = countries.select(F.col("country_no").alias("oper_cntry_id"), F.col("country_short_name").alias("country_name"))
    joined = d.join(ordering, (F.col("oper_cntry_id") == F.col("o_cntry")) & (F.col("ord_account_id") == F.col("o_account")), "left")
    country = F.col("s_cntry") if strict_country else F.col("o_cntry")
    if spread_above is None:
        joined = joined.join(shipping, (F.col("shp_account_id") == F.col("s_account")) & (F.col("oper_cntry_id") == country), "left")
    else:
        lines = joined.select("d.*", *[c for c in ordering.columns])
        joined = spread_join(lines, shipping.withColumnRenamed("s_account", "shp_account_id"), "shp_account_id", F.col("oper_cntry_id") == country, bound=spread_above)
    return joined.join(small(place), "oper_cntry_id").select(
        "ord_dt_key_no", "ord_id", "global_account_id", "oper_cntry_id", F.col("ord_account_id").alias("demand_ord_account_id"), "ord_bus_natr_cd", "ship_bus_natr_cd",
        "ord_item_cd", "ord_item_base_cd", "ord_qty", "country_name", "ord_mo_yr_id", "catalog_ln_usd_net", "adj_ln_usd_net", "account_type_ord",
    )


def by_country(base: DataFrame, country: str | None = None) -> DataFrame:
    """The export's columns; of one country, or of all (to be written partitioned by country_name)."""
    rows = base if country is None else base.where(F.col("country_name") == country)
    return rows.drop("oper_cntry_id", "ord_mo_yr_id").withColumnRenamed("demand_ord_account_id", "ord_account_id")
