"""A folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir; a temporary one only where that is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("saltmarsh.scratch.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("saltmarsh.scratch.dir", base)
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"
