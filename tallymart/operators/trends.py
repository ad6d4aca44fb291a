"""Programme reports over the fact: change, rolling mean, reporting rate, under-reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.periods import (
    period_index,
    period_month,
    period_quarter,
    period_year,
)
from tallymart.functions.scratch import written
from tallymart.functions.sizing import BROADCAST_BYTES, sized
from tallymart.functions.skew import HOT_ROWS, hot_keys, join_around
from tallymart.operators.framing import with_row_frame
from tallymart.operators.gaps import MAX_GAP, reported_spans, with_silent_months


def percent(part: Column, whole: Column) -> Column:
    """Rounded to two places; null where ``whole`` is null or 0."""
    return F.round(F.try_divide(part, whole) * 100, 2)


def mom_pct_change(
    fact: DataFrame,
    series: Sequence[str] = ("de_uid", "country_name", "region_name", "district_name"),
    gap_aware: bool = False,
) -> DataFrame:
    """Month-over-month change of the summed value per indicator and district.

    Rows without a number are left out, zeros are not.  "Previous" is the previous row of the
    series; with ``gap_aware=True`` it has to be the month before.  The series includes country and
    region, so that equal district names of two of them stay apart.  The window runs over
    sums, a few hundred per series however many rows went into them.
    """
    place = ["district_name", "region_name", "country_name"]
    by = ["de_uid", "health_area", *place, "period", "year_month"]
    # The name is a key at first: the least of several strings takes a sort, best of sums.
    totals = (
        fact.filter(F.col("numeric_value").isNotNull())
        .groupBy(*by, "de_name")
        .agg(F.sum("numeric_value").alias("_sum"))
        .groupBy(*by)
        .agg(F.sum("_sum").alias("total_value"), F.min("de_name").alias("de_name"))
    )
    along = Window.partitionBy(*series).orderBy("period", "health_area")
    previous = F.lag("total_value").over(along)
    if gap_aware:
        index = period_index(F.col("period"))
        previous = F.when(index - F.lag(index).over(along) == 1, previous)
    return totals.withColumn("prev_total", previous).withColumn(
        "mom_pct_change",
        percent(F.col("total_value") - F.col("prev_total"), F.col("prev_total")),
    )


def rolling_avg(
    fact: DataFrame,
    months: int = 3,
    by_calendar: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Rolling mean of the value per facility and indicator; every row is kept.

    The frame is the row and the ``months - 1`` rows before it, by period and option combo.  With
    ``by_calendar=True`` it is all rows of the last ``months`` calendar months, so gaps count.
    """
    keys = ["ou_uid", "de_uid"]
    name = f"rolling_avg_{months}m"
    columns = ["de_uid", "ou_uid", "period", "health_area", "country_name", "district_name", "facility_name", "numeric_value"]
    if by_calendar:
        framed = _calendar_mean(fact, keys, months, name, hot_rows)
    else:
        # The rows of hot groups move and are written, so only what is read of them goes along.
        framed = with_row_frame(
            fact.select(*columns, "coc_uid"),
            keys,
            order=["period", "coc_uid"],
            frame=(-(months - 1), 0),
            inputs=["numeric_value"],
            aggregates={name: F.avg("numeric_value")},
            hot_rows=hot_rows,
        )
    return framed.select(*columns, F.round(name, 4).alias(name))


def _calendar_mean(
    fact: DataFrame, keys: list[str], months: int, name: str, hot_rows: int | None
) -> DataFrame:
    """All rows of a month share the frame, so the window runs over monthly sums, whatever the size
    of a group; means go back to the rows by a join in which null keys match."""
    # Rows of unreadable periods form a month of their own.
    indexed = fact.withColumn("_index", F.coalesce(period_index(F.col("period")), F.lit(-1)))
    by = [*keys, "_index"]
    window = Window.partitionBy(*keys).orderBy("_index").rangeBetween(-(months - 1), 0)
    monthly = indexed.groupBy(*by).agg(
        F.sum("numeric_value").alias("_sum"), F.count("numeric_value").alias("_n")
    )
    means = monthly.select(
        *[F.col(k).alias(f"_m_{k}") for k in by],
        F.try_divide(F.sum("_sum").over(window), F.sum("_n").over(window)).alias(name),
    )
    hot = hot_keys(indexed, by, hot_rows)
    return join_around(indexed, means, [(k, f"_m_{k}") for k in by], hot, null_safe=True)


def reporting_rate(
    fact: DataFrame,
    facilities: DataFrame,
    densify: bool = False,
    broadcast_bytes: int | None = BROADCAST_BYTES,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """Share of a country's facilities that reported a number, or an explicit zero, per period.

    A country without any report in a period has no row there; ``densify=True`` adds it with
    rate 0, for every month from the first to the last; months beyond a gap of more than ``max_gap``
    months, and implausible ones, stretch no span.
    """
    expected = facilities.groupBy("country_name").agg(
        F.countDistinct("facility_uid").alias("expected_facilities")
    )
    by = ["country_name", "period", "year_month", "quarter", "year", "month"]
    actual = (
        fact.filter(F.col("numeric_value").isNotNull() | F.col("is_explicit_zero"))
        .groupBy(*by)
        .agg(F.countDistinct("ou_uid").alias("actual_facilities"))
    )
    if densify:
        p = F.col("period")
        spans = reported_spans(fact, max_gap=max_gap)
        dense = with_silent_months(actual, expected, ["country_name"], spans)
        calendar = {
            "year_month": p, "quarter": period_quarter(p), "year": period_year(p), "month": period_month(p)
        }
        added = F.col("actual_facilities").isNull()
        actual = dense.withColumns(
            {c: F.when(added, made).otherwise(F.col(c)) for c, made in calendar.items()}
        ).fillna(0, ["actual_facilities"])
    return actual.join(sized(expected, broadcast_bytes), "country_name", "left").withColumn(
        "reporting_rate_pct",
        percent(
            F.col("actual_facilities").cast("double"), F.col("expected_facilities").cast("double")
        ),
    )


def top_underreporting(fact: DataFrame, top: int = 5) -> DataFrame:
    """Facilities with the most periods of nothing but zero or missing values, per health area.

    Ties share a rank, so more than ``top`` rows may come out.  The rank of a count is one more
    than the number of facilities above it, which takes a table of one row per area and count;
    no area's facilities have to meet in one task.
    """
    facility = ["ou_uid", "facility_name", "country_name", "health_area"]
    value = F.col("numeric_value")
    silent = (
        fact.groupBy(*facility, "period")
        .agg(F.count_if(F.coalesce(value != 0, F.lit(False))).alias("_active"))
        .filter(F.col("_active") == 0)
    )
    # Written, since it is read for the ranks, for their size, and for the report.
    counted = written(silent.groupBy(*facility).agg(F.count(F.lit(1)).alias("zero_periods")), "silent")
    above = (
        Window.partitionBy("_area").orderBy(F.col("_periods").desc()).rowsBetween(
            Window.unboundedPreceding, -1
        )
    )
    ranks = (
        counted.groupBy(
            F.col("health_area").alias("_area"), F.col("zero_periods").alias("_periods")
        )
        .agg(F.count(F.lit(1)).alias("_facilities"))
        .withColumn(
            "rank_in_health_area",
            (F.coalesce(F.sum("_facilities").over(above), F.lit(0)) + 1).cast("int"),
        )
        .filter(F.col("rank_in_health_area") <= top)
        .select("_area", "_periods", "rank_in_health_area")
    )
    same = F.col("health_area").eqNullSafe(F.col("_area")) & (
        F.col("zero_periods") == F.col("_periods")
    )
    # At most ``top`` counts per area have such a rank.
    return counted.join(sized(ranks), same).drop("_area", "_periods")
