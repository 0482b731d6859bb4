"""Clickstream activity per day and user, with identities, for all markets in one plan."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.functions import calendar as cal
from saltmarsh.functions.bounded import small


def for_markets(df: DataFrame, markets: DataFrame, key: str, market_key: str) -> DataFrame:
    """df's rows with their market's settings: one broadcast join in place of one query per market."""
    return df.join(small(markets.withColumnRenamed(market_key, key)), key)


def recent(clicks: DataFrame, markets: DataFrame, as_of: datetime.date | str) -> DataFrame:
    """Clicks of the markets, each within its window up to a day; of a stream as of a table."""
    # The longest window of any market bounds what is read; each market's own follows.
    longest = markets.agg(F.max("months")).first()[0] or 0
    today = datetime.date.fromisoformat(str(as_of))
    since = F.add_months(F.lit(today), -int(longest)).cast("timestamp_ntz")
    kind = clicks.schema["time"].dataType
    clicks = clicks.where((F.col("time") >= since.cast(kind)) & (F.col("time") < F.date_add(F.lit(today), 1).cast("timestamp_ntz").cast(kind)))
    rows = for_markets(clicks.withColumn("day", F.to_date("time")), markets, "domain", "url")
    return rows.where(cal.window_to(F.col("day"), cal.day(as_of), F.col("months")))


def daily_identity(clicks: DataFrame, users: DataFrame, markets: DataFrame, event: str, as_of: datetime.date | str) -> DataFrame:
    """Events of one kind per market, day, user, identity, product and session, as a column of the event's name.

    Clicks are counted before identities are joined; a user of several identities counts under each.
    """
    keys = ["country", "user_id", "session_id", "day", "product_id"]
    counted = recent(clicks.where(F.col("event") == event), markets, as_of).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(users.select("user_id", "identity").distinct(), "user_id", "left")
    return joined.groupBy("country", "day", "user_id", "identity", "product_id", "session_id").agg(F.sum("n").alias(event))


def search_terms(clicks: DataFrame, markets: DataFrame, as_of: datetime.date | str, event: str = "search_view") -> DataFrame:
    rows = recent(clicks.where((F.col("event") == event) & F.col("searchkeyword").isNotNull()), markets, as_of)
    return rows.select("country", "user_id", "session_id", "day", "searchkeyword").distinct()
