"""A folder for files that a query writes on its way."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def folder(spark: SparkSession) -> str:
    """Below spark.checkpoint.dir, which all executors share; a local folder where that is unset in local mode."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key, None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"{key} must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='lectern-')}"
        spark.conf.set(key, found)
    return found.rstrip("/")
