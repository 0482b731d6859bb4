"""Schemas of sources, inferred once, stored, and enforced on every later load.

A source's first load decides its schema (`coerce.infer_schema`). Each later one is cast to what is stored,
so a column that a source sends as text today and as numbers tomorrow keeps its type in the tables behind
it. What a load has changed is told as rows: columns that are new, lost or retyped, and how many values
didn't fit. Stored schemas only change by `evolve`.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saltmarsh.functions.coerce import coerce_col, conform, infer_schema, lower_names
from saltmarsh.sources.tables import VersionedTable

Key = dict[str, str]
KEYS = ("source_system", "schema_name", "table_name")
STORED = ", ".join(f"{k} string" for k in KEYS) + ", version int, schema_json string"
DRIFT = "column_name string, change string, stored_type string, sent_type string, n_rows long, n_unfit long"


class SchemaStore:
    """One row per source key and version of its schema (JSON); the latest one counts, earlier ones stay to be looked up."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.table = spark, VersionedTable(spark, base)

    def create(self) -> SchemaStore:
        self.table.replace(self.spark.createDataFrame([], STORED))
        return self

    def _rows(self, key: Key) -> DataFrame:
        rows = self.table.read()
        for k in KEYS:
            rows = rows.where(F.col(k) == key[k])
        return rows

    def get(self, key: Key, version: int | None = None) -> T.StructType | None:
        """The schema in force, or of a version; None for a source that hasn't been loaded."""
        rows = self._rows(key) if version is None else self._rows(key).where(F.col("version") == version)
        found = rows.orderBy(F.desc("version")).first()
        return T.StructType.fromJson(json.loads(found.schema_json)) if found else None

    def put(self, key: Key, schema: T.StructType) -> int:
        """Stores a schema as the key's next version, which it returns."""
        last = self._rows(key).agg(F.max("version").alias("v")).first().v or 0
        row = self.spark.createDataFrame([(*(key[k] for k in KEYS), last + 1, schema.json())], STORED)
        self.table.replace(self.table.read().unionByName(row))
        return last + 1

    def of(self, key: Key, source: DataFrame) -> T.StructType:
        """The stored schema; a first load's is inferred from all of its rows, and stored."""
        stored = self.get(key)
        if stored is None:
            stored = infer_schema(source)
            self.put(key, stored)
        return stored

    def enforce(self, key: Key, source: DataFrame) -> DataFrame:
        """source in its stored columns and types: what it lacks is NULL, what is new is left out, what doesn't fit is NULL."""
        return conform(source, self.of(key, source))

    def evolve(self, key: Key, source: DataFrame, retyped: tuple[str, ...] = ()) -> T.StructType:
        """Takes up columns that the source has and the stored schema lacks, behind its own, and the source's types of those named."""
        stored, sent = self.of(key, source), infer_schema(source)
        kinds = {f.name: f.dataType for f in sent.fields}
        own = [T.StructField(f.name, kinds.get(f.name, f.dataType) if f.name in retyped else f.dataType) for f in stored.fields]
        merged = T.StructType(own + [f for f in sent.fields if f.name not in stored.names])
        if merged != stored:
            self.put(key, merged)
        return merged


def changes(stored: T.StructType, sent: T.StructType) -> list[tuple[str, str, T.DataType | None, T.DataType | None]]:
    """(column, new / lost / retyped, stored type, sent type); names count in lower case."""
    have, want = {f.name.lower(): f.dataType for f in sent.fields}, {f.name.lower(): f.dataType for f in stored.fields}
    out: list[tuple[str, str, T.DataType | None, T.DataType | None]] = [(n, "lost", t, None) for n, t in want.items() if n not in have]
    out += [(n, "retyped", want[n], t) for n, t in have.items() if n in want and t != want[n]]
    return out + [(n, "new", None, t) for n, t in have.items() if n not in want]


def unfit(c: Column, sent: T.DataType, stored: T.DataType) -> Column:
    """Whether a value is there and has none in the stored type."""
    return c.isNotNull() & coerce_col(c, sent, stored).isNull()


def drift(stored: T.StructType, source: DataFrame) -> DataFrame:
    """DRIFT: a row per changed column, with the load's rows and those whose value doesn't fit; one pass over the load.

    A load that is as stored gives no rows. Of a new column no value is unfit, of a lost one none is there.
    """
    spark, rows = source.sparkSession, lower_names(source)
    found = changes(stored, rows.schema)
    if not found:
        return spark.createDataFrame([], DRIFT)
    counts = [F.count_if(unfit(F.col(f"`{n}`"), have, want)) if change == "retyped" else F.lit(0).cast("long") for n, change, want, have in found]
    told = [F.struct(F.lit(n).alias("column_name"), F.lit(change).alias("change"), F.lit(want and want.simpleString()).cast("string").alias("stored_type"), F.lit(have and have.simpleString()).cast("string").alias("sent_type"), F.col("n_rows"), F.col(f"c{k}").alias("n_unfit")) for k, (n, change, want, have) in enumerate(found)]
    one = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[c.alias(f"c{k}") for k, c in enumerate(counts)])
    return one.select(F.explode(F.array(*told)).alias("d")).select("d.*")
