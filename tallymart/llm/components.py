"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.skew import HOT_ROWS, hot_keys, join_around
from tallymart.llm.storage import landed


def components(links: DataFrame, max_rounds: int = 60, hot_links: int = HOT_ROWS) -> DataFrame:
    """``(id, component)`` for every id that occurs in ``links(a, b)``.

    ``component`` is the smallest id reachable.  Each round points every neighbour at the smallest
    id nearby, first the larger ones, then the smaller ones, until only stars are left.  Minima are
    aggregated before the shuffle and joined back; those of ids with more than ``hot_links`` links, which are
    few, go to the links, so a hub with any number of links is not gathered.  Rounds are written tables.  Links of an id with itself or with null are ignored.
    """
    ends = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    edges = landed(
        links.filter("a is not null and b is not null and a <> b").select(*ends).distinct(), "links"
    )
    for _ in range(max_rounds):
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(
            edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        least = landed(least.withColumn("m", F.least("u", "m")), "least")
        hot = F.broadcast(least.filter(F.col("n") > hot_links))  # at most links / hot_links rows
        cold = both.join(hot.select("u"), "u", "left_anti").join(least.filter(F.col("n") <= hot_links), "u")
        large = (
            cold.unionByName(both.join(hot, "u"))
            .filter("v > u")
            .select(F.col("v").alias("high"), F.col("m").alias("low"))
            .filter("high <> low")
            .distinct()
        )
        large = landed(large, "large")
        lowest = large.groupBy(F.col("high").alias("of")).agg(F.min("low").alias("m"))
        small = (
            join_around(large, lowest, [("high", "of")], hot_keys(large, ["high"], hot_links), "inner")
            .select(F.explode(F.array(F.struct(F.col("low").alias("x"), "m"), F.struct(F.col("high").alias("x"), "m"))).alias("e"))
            .select(F.col("e.x").alias("high"), F.col("e.m").alias("low"))
            .filter("high <> low")
            .distinct()
        )
        after = landed(small, "links")
        # Only stars are left as soon as no low end is itself a high end.
        centres = after.select(F.col("low").alias("high")).distinct()
        done = after.join(centres, "high", "left_semi").isEmpty() and (
            after.groupBy("high").count().filter("count > 1").isEmpty()
        )
        edges = after
        if done:
            return edges.select(F.col("high").alias("id"), F.col("low").alias("component")).unionByName(
                edges.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct()
            )
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
