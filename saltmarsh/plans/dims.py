"""Small fixed dimensions, as DataFrames of known size (each below a hundred rows, so safe to broadcast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Affiliates of each market, and the markets of each list.
MARKETS = {
    "ana": [10],
    "europe": [30, 40, 60, 90, 110, 150, 160, 210, 250, 470, 480, 570],
    "india": [430],
    "japan": [70],
    "korea": [180],
    "latam": [170],
    "msb": [100],
    "taiwan": [130],
    "thailand": [200],
    "vietnam": [500],
}
LISTS = {
    "PURCHASE_PREDICTION": ["ana", "europe", "india", "japan", "korea", "latam", "msb", "taiwan", "thailand"],
    "RENEWAL": ["india", "korea", "msb", "taiwan", "thailand", "vietnam"],
}
# Schedule slot, market group, affiliates.
SCHEDULE = [
    ("0110", "EUR-E", [150]),
    ("0140", "EUR-W", [40, 60, 90, 110, 160, 210, 250, 470, 480, 570]),
    ("0640", "ANA", [10]),
    ("0740", "LATAM", [170]),
    ("1610", "APAC-JPN", [70]),
    ("1640", "APAC-KOR", [180]),
    ("1740", "APAC-SE", [30, 50, 100, 130, 200, 220, 350, 500]),
    ("1940", "Central Asia", [420]),
    ("2040", "India", [430]),
]
# Click markets of the stand-in tables: name, site, months of history.
CLICK_MARKETS_CSV = "country,url,months\nalpha,a.example,6\nbeta,b.example,2"


def affiliates(which: str) -> list[int]:
    """Affiliates of a list, or of all lists, each once."""
    markets = LISTS[which] if which != "ALL" else [m for ms in LISTS.values() for m in ms]
    return sorted({a for m in markets for a in MARKETS[m]})


def local(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """Rows as a local relation: Spark knows its size, and broadcasts it without counting."""
    cell = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else str(v)
    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)} AS t({', '.join(columns)})")


def market_affiliates(spark: SparkSession) -> DataFrame:
    rows = [(name, m, a) for name, ms in LISTS.items() for m in ms for a in MARKETS[m]]
    return local(spark, rows, ["market_list", "market", "affiliate"])


def schedule_groups(spark: SparkSession) -> DataFrame:
    return local(spark, [(s, g, a) for s, g, members in SCHEDULE for a in members], ["slot", "market_group", "affiliate"])


def markets(spark: SparkSession, text: str = CLICK_MARKETS_CSV) -> DataFrame:
    """Market settings given as CSV text with a header."""
    head, *lines = text.strip().split("\n")
    names = [n.strip() for n in head.split(",")]
    schema = ", ".join(f"{n} {'int' if n == 'months' else 'string'}" for n in names)
    df = local(spark, [(line,) for line in lines], ["line"])
    return df.select(F.from_csv("line", schema).alias("m")).select("m.*")
