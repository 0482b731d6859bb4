"""Dated snapshots of table and column descriptions."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKIPPED = ("incoming", "streaming", "staging", "temp")


def kept_datasets(rows: DataFrame, skipped: tuple[str, ...] = SKIPPED) -> DataFrame:
    out = rows
    for prefix in skipped:
        out = out.where(~F.col("table_schema").startswith(prefix))
    return out


def table_snapshot(options: DataFrame, load_date: datetime.date | str, skipped: tuple[str, ...] = SKIPPED) -> DataFrame:
    """Descriptions of tables, stamped with the day."""
    return kept_datasets(options, skipped).where("option_name = 'description'").withColumn("load_date", F.to_date(F.lit(str(load_date))))


def column_snapshot(field_paths: DataFrame, load_date: datetime.date | str, skipped: tuple[str, ...] = SKIPPED) -> DataFrame:
    return kept_datasets(field_paths, skipped).withColumn("load_date", F.to_date(F.lit(str(load_date))))
