"""Join hints that rest on a measured size.

Lookups grow with the data like anything else.  :func:`sized` measures one in a single distributed
aggregate and hints a broadcast only below the bound; above it the hint is a sort-merge join.  Joins
of many rows to a lookup go through ``skew.lookup_join``, which also takes care of hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def measured_bytes(*lookups: DataFrame) -> list[int]:
    """Bytes of each one's rows as JSON text, an upper estimate for rows of mostly strings.

    All are measured in one job.
    """
    sizes = None
    for position, df in enumerate(lookups):
        size = F.octet_length(F.to_json(F.struct(*df.columns))).cast("bigint")
        one = df.select(F.lit(position).alias("lookup"), size.alias("size"))
        sizes = one if sizes is None else sizes.unionByName(one)
    totals = sizes.groupBy("lookup").agg(F.sum("size").alias("n")).collect()
    found = {row["lookup"]: row["n"] for row in totals}
    return [int(found.get(position) or 0) for position in range(len(lookups))]


def sized(
    df: DataFrame, bound: int | None = BROADCAST_BYTES, source: DataFrame | None = None
) -> DataFrame:
    """``df`` with the join hint its size allows; ``bound=None`` leaves the choice to Spark.

    ``source`` is measured instead where it is no smaller than ``df`` and cheaper to compute.
    """
    if bound is None:
        return df
    n_bytes = measured_bytes(df if source is None else source)[0]
    return F.broadcast(df) if n_bytes <= bound else df.hint("merge")
