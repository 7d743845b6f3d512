"""A new path in the shared folder of ``spark.checkpoint.dir``; only where that is unset (tests), in a temporary one."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-"))
    return f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
