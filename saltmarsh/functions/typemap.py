"""Column types of relational catalogs, mapped to warehouse types.

Each function takes a DataFrame of catalog rows, one per source column, of any number of tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _decimal(scale: Column, unset_is_decimal: bool) -> Column:
    fraction = scale > 0
    if unset_is_decimal:
        fraction = fraction | scale.isNull() | F.isnan(scale.cast("double"))
    return F.when(fraction, F.lit("NUMERIC")).otherwise(F.lit("INT64"))


def _mode(nullable: Column) -> Column:
    return F.when(nullable.isin("Y", "YES"), F.lit("NULLABLE")).otherwise(F.lit("REQUIRED"))


def oracle(catalog: DataFrame) -> DataFrame:
    t = F.col("data_type")
    kind = (
        F.when(t == "NUMBER", _decimal(F.col("data_scale"), True))
        .when(t == "LONG", F.lit("INT64"))
        .when(t == "BLOB", F.lit("BYTES"))
        .when(t == "FLOAT", F.lit("FLOAT64"))
        .when(t.isin("DATE", "DATETIME") | t.startswith("TIMESTAMP"), F.lit("TIMESTAMP"))
        .otherwise(F.lit("STRING"))
    )
    return catalog.withColumn("type", kind).withColumn("mode", _mode(F.col("nullable")))


def as400(catalog: DataFrame) -> DataFrame:
    t = F.col("data_type")
    kind = (
        F.when(t.isin("DECIMAL", "NUMERIC"), _decimal(F.col("data_scale"), True))
        .when(t.isin("DATE", "TIMESTMP"), F.lit("TIMESTAMP"))
        .otherwise(F.lit("STRING"))
    )
    return catalog.withColumn("type", kind).withColumn("mode", _mode(F.col("nullable")))


def postgres(catalog: DataFrame) -> DataFrame:
    t = F.col("data_type")
    kind = (
        F.when(t == "numeric", _decimal(F.col("data_scale"), True))
        .when(t.isin("bigint", "smallint", "integer"), F.lit("INT64"))
        .when(t == "decimal", F.lit("NUMERIC"))
        .when(t == "boolean", F.lit("BOOLEAN"))
        .when(t.isin("double precision", "real"), F.lit("FLOAT64"))
        .when(t == "date", F.lit("DATE"))
        .when(t.startswith("timestamp"), F.lit("TIMESTAMP"))
        .otherwise(F.lit("STRING"))
    )
    return catalog.withColumn("type", kind).withColumn("mode", _mode(F.col("nullable")))


def java_columns(catalog: DataFrame, table: str = "table_name") -> DataFrame:
    """Per table one text `COL=Type, COL=Type` in column order, with Double, Long, Integer and String."""
    t = F.col("data_type")
    kind = (
        F.when((t == "NUMBER") & (F.col("data_scale") > 0), F.lit("Double"))
        .when((t == "NUMBER") & (F.col("data_precision") > 9), F.lit("Long"))
        .when(t == "NUMBER", F.lit("Integer"))
        .when(t == "FLOAT", F.lit("Double"))
        .otherwise(F.lit("String"))
    )
    item = F.struct("column_id", F.concat("column_name", F.lit("="), kind).alias("c"))
    return catalog.groupBy(table).agg(F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["c"]), ", ").alias("columns"))
