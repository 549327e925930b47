"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _single_machine_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; below a temporary folder only on a single machine that names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = _single_machine_folder()
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written and read back: computed once, whatever reads them, and kept when executors are lost."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
