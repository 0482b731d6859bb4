"""Tables laid out for the queries that read them: a folder a month, and in it a file a bucket of accounts.

A filter on the month then leaves whole folders unread, and tables with equal buckets are joined and
grouped by account as they lie, without a shuffle. Both are worth it for tables that are written once and joined often.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def lay_out(df: DataFrame, path: str, bucket_by: str, buckets: int, partition_by: str | None = None, name: str | None = None) -> str:
    """Writes df to a table of the session's catalog at the path, and returns its name.

    Rows are dealt to buckets before they are written, so each task writes one bucket: a file for each month and bucket,
    however many tasks there were before. A very large account makes a large file of its bucket, not of a month's all.
    """
    table = name or f"laid_out_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by).sortBy(bucket_by).option("path", path)
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)
    return table
