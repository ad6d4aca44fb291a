"""One row per key, in forms that reduce on the map side before they shuffle.

A key that holds a large share of all rows reaches the reducer as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    ``row_number() = 1`` is planned with a group limit before the exchange.  ``order`` has to be
    total for the choice to be reproducible.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_position", F.row_number().over(ranked))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def unique_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unique on ``keys``, for lookups: keeps the least remaining row, so reruns agree."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_kept"))
        .select(*keys, *[F.col("_kept").getField(c).alias(c) for c in rest])
        .select(*df.columns)
    )
