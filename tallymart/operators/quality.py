"""Deduplication, typed values, data-quality flags, completeness and the quality gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions import periods as P
from tallymart.functions.casting import typed_number
from tallymart.functions.keys import first_per_key, unique_by
from tallymart.functions.scratch import written
from tallymart.functions.sizing import BROADCAST_BYTES, measured_bytes
from tallymart.functions.skew import BROADCAST_KEYS, HOT_ROWS, Hot, hot_keys, join_around, lookup_join, split_hot
from tallymart.operators.gaps import MAX_GAP, reported_spans, with_silent_months
from tallymart.schemas import VALUE_KEY

# Fixed values.
LATE_DAYS = 60
MAX_QUARANTINE_RATE = 0.10


def dedup_latest(
    values: DataFrame,
    tie_break: Sequence[Column],
    keys: Sequence[str] = tuple(VALUE_KEY),
    stamp: str = "lastUpdated",
) -> DataFrame:
    """The row with the latest ``stamp`` per natural key, for exact and corrected copies alike.

    ``tie_break`` orders rows of equal stamp.  It has to leave no ties among differing rows, or a
    rerun may keep another one.  "Latest" is by stamp: a correction stamped earlier than what it
    corrects does not win.
    """
    return first_per_key(values, keys, [F.col(stamp).desc_nulls_last(), *tie_break])


def cast_values(values: DataFrame) -> DataFrame:
    """``numeric_value`` from the raw text by the row's value type; the text stays as it is."""
    return values.withColumn("numeric_value", typed_number(F.col("value"), F.col("value_type")))


def add_calendar(values: DataFrame, period: str = "period") -> DataFrame:
    p = F.col(period)
    return values.withColumns(
        {
            "year": P.period_year(p),
            "month": P.period_month(p),
            "year_month": p,
            "quarter": P.period_quarter(p),
            "period_end_date": P.period_end(p),
        }
    )


def add_dq_flags(values: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """Four flags and the calendar columns.

    Zero and missing are kept apart: ``is_explicit_zero`` is for the text ``0`` only,
    ``is_missing_value`` for no value at all.  ``is_late_reported`` is null where the stamp or the
    period cannot be read.
    """
    delay = F.datediff(P.stamp_date(F.col("lastUpdated")), P.period_end(F.col("period")))
    orphan = F.col("is_orphaned_coc") if "is_orphaned_coc" in values.columns else F.lit(False)
    flagged = values.withColumns(
        {
            "is_late_reported": delay > late_days,
            "is_explicit_zero": F.coalesce(F.col("value") == "0", F.lit(False)),
            "is_missing_value": F.col("value").isNull(),
            "is_orphaned_coc": F.coalesce(orphan, F.lit(False)),
        }
    )
    return add_calendar(flagged)


def dq_summary(flagged: DataFrame) -> DataFrame:
    """One row: totals, and the share in percent of late, zero, missing and orphaned rows."""
    flags = {
        "late": "is_late_reported",
        "zero": "is_explicit_zero",
        "missing": "is_missing_value",
        "orphaned_coc": "is_orphaned_coc",
    }
    counted = flagged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c)).alias(f"{name}_rows") for name, c in flags.items()],
    )
    base = F.greatest(F.col("total_rows"), F.lit(1))
    return counted.select(
        "*",
        *[F.round(100 * F.col(f"{n}_rows") / base, 1).alias(f"{n}_pct") for n in flags],
    )


def expected_indicators(programs: DataFrame) -> DataFrame:
    """Distinct (country, indicator) pairs over the programmes of a country."""
    return programs.select(
        "country", F.explode("dataElements").alias("expected_element")
    ).distinct()


def _expected_by_facility(programs: DataFrame, facilities: DataFrame) -> DataFrame:
    """Facility, country and number of indicators expected there; small joined to small."""
    expected = (
        expected_indicators(programs)
        .groupBy("country")
        .agg(F.count("expected_element").alias("expected_count"))
    )
    facility = unique_by(facilities.select("facility_uid", "country_name"), ["facility_uid"])
    counted = facility.join(expected, F.col("country_name") == F.col("country"), "left")
    return counted.select(
        F.col("facility_uid").alias("_facility"),
        F.col("country_name").alias("_country"),
        "expected_count",
    )


def _join_expected(
    rows: DataFrame, programs: DataFrame, facilities: DataFrame, broadcast_bytes: int | None
) -> DataFrame:
    """Adds the unit's ``expected_count`` and ``_country``."""
    n_bytes = None
    if broadcast_bytes is not None:
        alike = facilities.select("facility_uid", "country_name", F.lit(0).alias("expected_count"))
        n_bytes = measured_bytes(alike)[0]
    return lookup_join(
        rows,
        _expected_by_facility(programs, facilities),
        [("orgUnit", "_facility")],
        n_bytes=n_bytes,
        bound=broadcast_bytes,
    ).drop("_facility")


def _expected_only(
    rows: DataFrame, programs: DataFrame, broadcast_bytes: int | None
) -> DataFrame:
    """Adds ``expected_element``: the row's indicator if its country expects it, else null."""
    return lookup_join(
        rows,
        expected_indicators(programs),
        [("_country", "country"), ("dataElement", "expected_element")],
        bound=broadcast_bytes,
    ).drop("country")


def _score(actual: Column, expected: Column) -> Column:
    ratio = actual.cast("double") / expected.cast("double")
    return F.when(expected > 0, F.least(ratio, F.lit(1.0)))


def completeness_scores(
    values: DataFrame,
    programs: DataFrame,
    facilities: DataFrame,
    strict: bool = False,
    densify: bool = False,
    broadcast_bytes: int | None = BROADCAST_BYTES,
    max_gap: int = MAX_GAP,
) -> DataFrame:
    """(orgUnit, period, completeness_score): indicators reported over indicators expected.

    Reported are the distinct indicators with a value; expected those of the country's programmes.
    The score is capped at 1 and null where the country has no programme.  By default indicators
    outside the expected set count too; ``strict=True`` leaves them out.  ``densify=True`` adds
    score 0 for every facility and month, from first to last, in which nothing was reported; months
    beyond a gap of more than ``max_gap`` months, and implausible ones, stretch no span.
    """
    reported = values.filter(F.col("value").isNotNull()).select("orgUnit", "period", "dataElement")
    if strict:
        placed = _join_expected(reported.distinct(), programs, facilities, broadcast_bytes)
        reported = _expected_only(placed, programs, broadcast_bytes).select("orgUnit", "period", F.col("expected_element").alias("dataElement"))
    actual = reported.groupBy("orgUnit", "period").agg(
        F.countDistinct("dataElement").alias("_actual")
    )
    if densify:
        everyone = facilities.select(F.col("facility_uid").alias("orgUnit"))
        spans = reported_spans(values, max_gap=max_gap)
        actual = with_silent_months(actual, everyone, ["orgUnit"], spans).fillna(0, ["_actual"])
    return _join_expected(actual, programs, facilities, broadcast_bytes).select(
        "orgUnit",
        "period",
        _score(F.col("_actual"), F.col("expected_count")).alias("completeness_score"),
    )


def completeness(
    values: DataFrame,
    programs: DataFrame,
    facilities: DataFrame,
    strict: bool = False,
    hot_rows: int | None = HOT_ROWS,
    broadcast_bytes: int | None = BROADCAST_BYTES,
    only: Hot | None = None,
) -> DataFrame:
    """Value rows with the ``completeness_score`` of their unit and period.

    The score side is one row per unit and period.  Units and periods with more than ``hot_rows``
    rows are joined by broadcasting their few scores, the others as Spark sees fit.  ``only`` are those that
    ``values`` have rows of, where these are known: then nothing is counted, and all scores are joined alike.
    """
    place = ["orgUnit", "period"]
    scores = completeness_scores(
        values, programs, facilities, strict=strict, broadcast_bytes=broadcast_bytes
    ).withColumnsRenamed({k: f"_{k}" for k in place})
    on = [(k, f"_{k}") for k in place]
    if only is not None:
        same = [F.col(k).eqNullSafe(F.col(theirs)) for k, theirs in on]
        joined = values.join(only.hinted(scores), same[0] & same[1], "left")
    else:
        joined = join_around(values, scores, on, hot_keys(values, place, hot_rows), null_safe=True)
    return joined.drop(*[f"_{k}" for k in place])


def with_expected(
    values: DataFrame,
    programs: DataFrame,
    facilities: DataFrame,
    strict: bool = False,
    broadcast_bytes: int | None = BROADCAST_BYTES,
) -> DataFrame:
    """Value rows with ``expected_count`` of their facility and, in ``expected_element``, the
    indicator to count: with ``strict=True`` only where the facility's country expects it."""
    rows = _join_expected(values, programs, facilities, broadcast_bytes)
    if strict:
        rows = _expected_only(rows, programs, broadcast_bytes)
    else:
        rows = rows.withColumn("expected_element", F.col("dataElement"))
    return rows.drop("_country")


def score_in_place(values: DataFrame) -> DataFrame:
    """The score of :func:`completeness`, for rows of :func:`with_expected` that are already
    partitioned by unit and period.

    A window instead of a join with an aggregate of the same rows: no further shuffle, but the
    rows of a unit and period are in one task.  Indicators with a value are kept in a set, which has as many as
    there are indicators at most, so the work is linear in the rows.
    """
    there = Window.partitionBy("orgUnit", "period")
    has_value = F.col("value").isNotNull()
    of_value = F.when(has_value, F.col("expected_element"))
    # Nothing reported at all gives no score, as it gives no row to the aggregate.
    return (
        values.withColumns(
            {"_any": F.max(has_value).over(there), "_actual": F.size(F.collect_set(of_value).over(there))}
        )
        .withColumn(
            "completeness_score",
            F.when(F.col("_any"), _score(F.col("_actual"), F.col("expected_count"))),
        )
        .drop("expected_count", "expected_element", "_any", "_actual")
    )


def run_dq(
    values: DataFrame,
    programs: DataFrame,
    facilities: DataFrame,
    tie_break: Sequence[Column],
    strict: bool = False,
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
    broadcast_bytes: int | None = BROADCAST_BYTES,
) -> DataFrame:
    """Deduplicate, cast, flag, score; in this order.

    All copies of a natural key belong to one unit and period, so one shuffle by these two serves
    the deduplication and the score.  Units and periods with more than ``hot_rows`` rows go
    another way: copies are reduced before their shuffle, and the score is aggregated and joined.
    They are counted in ``counted``, if given: rows that include ``values`` and are cheaper to scan.
    """
    return settled(
        values,
        programs,
        facilities,
        [F.col("lastUpdated").desc_nulls_last(), *tie_break],
        lambda rows: rows.transform(cast_values).transform(add_dq_flags),
        strict,
        hot_rows,
        counted,
        broadcast_bytes,
    )


def settled(
    values: DataFrame,
    programs: DataFrame,
    facilities: DataFrame,
    order: Sequence[Column],
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    strict: bool = False,
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
    broadcast_bytes: int | None = BROADCAST_BYTES,
) -> DataFrame:
    """The first row of each natural key under ``order``, what ``prepare`` adds to it, and the score.

    As in :func:`run_dq`: one shuffle by unit and period.  Of the hot ones, the ``BROADCAST_KEYS`` largest at most, the
    rows left by the deduplication are written, since they are aggregated and joined; so all rows are told apart by
    a broadcast, and a unit and period that goes the common way has no more than rows / ``BROADCAST_KEYS`` or ``hot_rows``.
    """
    place = ["orgUnit", "period"]

    def together(rows: DataFrame) -> DataFrame:
        rows = rows.transform(with_expected, programs, facilities, strict, broadcast_bytes)
        if strict:
            rows = rows.repartition(*place)
        else:  # the row's own indicator, which need not move twice
            rows = rows.drop("expected_element").repartition(*place).withColumn("expected_element", F.col("dataElement"))
        return (
            rows.transform(first_per_key, [*place, "dataElement", "categoryOptionCombo"], order)
            .transform(prepare)
            .transform(score_in_place)
        )

    def spread(rows: DataFrame) -> DataFrame:
        return (
            written(first_per_key(rows, VALUE_KEY, order), "hot_rows")
            .transform(prepare)
            .transform(completeness, programs, facilities, strict, hot_rows, broadcast_bytes, only=keys)
        )

    keys = hot_keys(values if counted is None else counted, place, hot_rows, most=BROADCAST_KEYS, many=True)
    cold, hot = split_hot(values, place, keys)
    return together(cold) if hot is None else together(cold).unionByName(spread(hot))


def dq_gate(
    fact: DataFrame,
    quarantine_rate: float,
    ghost_rate: float | None = None,
    max_quarantine_rate: float = MAX_QUARANTINE_RATE,
    max_ghost_rate: float | None = None,
    lost_documents: int | None = None,
) -> DataFrame:
    """Checks as rows (check_name, observed, threshold, passed).

    ``quarantine_rate`` is of structural rejects among the data values.  Rows rejected for unknown
    keys are a rate of their own and are checked where ``max_ghost_rate`` is given.  Documents that
    could not be read count for no row; where their number is given, any is a failure.
    """
    checks = [("quarantine_rate", F.lit(float(quarantine_rate)), float(max_quarantine_rate))]
    if max_ghost_rate is not None:
        checks.append(("ghost_rate", F.lit(float(ghost_rate or 0.0)), float(max_ghost_rate)))
    if lost_documents is not None:
        checks.append(("lost_documents", F.lit(float(lost_documents)), 0.0))
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            observed.alias("observed"),
            F.lit(limit).alias("threshold"),
            (observed <= F.lit(limit)).alias("passed"),
        )
        for name, observed, limit in checks
    ]
    rows.append(
        F.struct(
            F.lit("fact_rows").alias("check_name"),
            F.col("n").cast("double").alias("observed"),
            F.lit(1.0).alias("threshold"),
            (F.col("n") >= 1).alias("passed"),
        )
    )
    return fact.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*rows)))


def gate_failures(gate: DataFrame) -> list[str]:
    """Messages of the failed checks; empty when all passed.  The gate has a handful of rows."""
    return [
        f"{r.check_name}: {r.observed:g} against {r.threshold:g}"
        for r in gate.filter(~F.col("passed")).collect()
    ]
