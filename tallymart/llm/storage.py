"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import ctypes
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(spark: SparkSession) -> SparkSession:
    """The session, set up for texts.

    Batches of rows for Python workers become smaller than Spark's usual 10,000, since a row is a whole
    text; a number the user has set stays.  Workers of a local session find this package where it lies.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tallymart-llm/{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table and read it back, so that later steps survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def trimmed() -> None:
    """Give memory that a Python worker has freed back to the system, where the C library can do so.

    Workers serve the tasks of many stages, and keep what the largest of them needed.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
