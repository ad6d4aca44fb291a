"""Written intermediate tables, in a folder that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/tallymart/{uuid.uuid4().hex}/{name}"


#: Spark's setting by which a statement's shuffle files go when it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: computed once, whatever reads it, and safe from lost executors.

    The shuffles of the write are of no use to what reads the table, and their files are removed with its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
