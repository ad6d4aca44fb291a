"""Months in which nothing was reported, as runs (first, last) per key.

Dense reports need a row for every silent month.  The runs are found from one reported month to the
next, and become rows only where a report asks for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.periods import period_index, period_of_index

#: First and last month that stretch a span.  They also bound how many months :func:`reported_spans`
#: brings to the driver.
PLAUSIBLE = ("190001", "210012")
#: Months without any report after which a later report begins a span of its own.
MAX_GAP = 24

#: First and last month of a span, as indexes.
Span = tuple[int, int]


def month_index(period: Column) -> Column:
    """The month's index; null unless the period is a month written as ``yyyyMM``."""
    index = period_index(period)
    return F.when(period_of_index(index) == period, index)


def reported_spans(
    rows: DataFrame,
    period: str = "period",
    max_gap: int = MAX_GAP,
    plausible: tuple[str, str] = PLAUSIBLE,
) -> list[Span]:
    """The stretches of months of ``rows`` without a gap above ``max_gap`` months.

    One pass over the period column, reduced on the map side.  A stray month far from all others is a
    span of one month, and one that is not plausible is none, so neither fills the years between.
    """
    if max_gap < 1:
        raise ValueError("max_gap has to be at least 1")
    there = rows.filter(F.col(period).between(*plausible))
    months = there.select(month_index(F.col(period)).alias("m")).distinct().filter("m is not null")
    spans: list[Span] = []
    for m in sorted(r["m"] for r in months.collect()):
        if spans and m - spans[-1][1] - 1 <= max_gap:
            spans[-1] = (spans[-1][0], m)
        else:
            spans.append((m, m))
    return spans


def _marked(
    rows: DataFrame, everyone: DataFrame, keys: Sequence[str], spans: Sequence[Span]
) -> DataFrame:
    """``rows`` with ``_first`` and ``_last`` of the silent run after them, null where there is none.

    Besides them, with ``_edge`` true, a row of each key of ``everyone`` for the months just outside of
    each span, which runs begin after or end before.
    """
    index = month_index(F.col("period"))
    within = reduce(lambda a, b: a | b, [index.between(*s) for s in spans], F.lit(False))
    edges = F.array(
        *[
            F.struct(F.lit(i).cast("int").alias("index"), F.lit(ends).alias("ends"))
            for first, last in spans
            for i, ends in ((first - 1, False), (last + 1, True))
        ]
    ).cast("array<struct<index: int, ends: boolean>>")
    sides = (
        everyone.select(*keys)
        .distinct()
        .select(*keys, F.explode(edges).alias("_e"))
        .select(*keys, F.col("_e.index").alias("_index"), F.col("_e.ends").alias("_ends"))
        .withColumn("_edge", F.lit(True))
    )
    both = rows.withColumns(
        {"_index": F.when(within, index), "_ends": F.lit(False), "_edge": F.lit(False)}
    ).unionByName(sides, allowMissingColumns=True)
    key = Window.partitionBy(*keys)
    here = F.col("_index")
    # What lies between two spans is no run, nor is anything of a key that only ``rows`` has.
    run = F.col("_known") & ~F.col("_ends") & (F.col("_next") > here + 1)
    return (
        both.withColumns({"_next": F.lead(here).over(key.orderBy(here)), "_known": F.max("_edge").over(key)})
        .withColumns({"_first": F.when(run, here + 1), "_last": F.when(run, F.col("_next") - 1)})
        .drop("_index", "_ends", "_next", "_known")
    )


def with_silent_months(
    rows: DataFrame, everyone: DataFrame, keys: Sequence[str], spans: Sequence[Span]
) -> DataFrame:
    """``rows`` and, for each key of ``everyone`` and each month of the spans that it has no row of, a
    row with these, null in the other columns.

    Rows of unreadable periods, of months outside of the spans and of other keys stay as they are.  A
    null key is a key like others.  One shuffle by key; a key's rows meet in one task, so ``rows``
    should be aggregated by key and period.
    """
    none = F.array().cast("array<int>")
    own = F.when(F.col("_edge"), none).otherwise(F.array(F.lit(None).cast("int")))
    silent = F.when(F.col("_first").isNotNull(), F.sequence("_first", "_last")).otherwise(none)
    each = _marked(rows, everyone, keys, spans).withColumn("_month", F.explode(F.concat(own, silent)))
    added = F.col("_month").isNotNull()
    return each.select(
        *[
            F.when(added, period_of_index(F.col("_month"))).otherwise(F.col(c)).alias(c)
            if c == "period"
            else F.col(c) if c in keys else F.when(~added, F.col(c)).alias(c)
            for c in rows.columns
        ]
    )


def silent_runs(
    values: DataFrame,
    facilities: DataFrame,
    max_gap: int = MAX_GAP,
    plausible: tuple[str, str] = PLAUSIBLE,
) -> DataFrame:
    """Facilities' runs of months without a value: ``first_period``, ``last_period``, ``months``.

    A facility that never reported has a run for each span.  Runs stay runs, whatever their length.
    """
    reported = values.filter(F.col("value").isNotNull()).select(
        F.col("orgUnit").alias("facility_uid"), "period"
    )
    spans = reported_spans(values, "period", max_gap, plausible)
    return (
        _marked(reported.distinct(), facilities, ["facility_uid"], spans)
        .filter(F.col("_first").isNotNull())
        .select(
            "facility_uid",
            period_of_index(F.col("_first")).alias("first_period"),
            period_of_index(F.col("_last")).alias("last_period"),
            (F.col("_last") - F.col("_first") + 1).alias("months"),
        )
    )
