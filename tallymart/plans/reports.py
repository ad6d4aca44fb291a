"""The two sets of reports, written as CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallymart.functions.skew import HOT_ROWS
from tallymart.operators import states as merged
from tallymart.operators.crosscut import (
    completeness_comparison,
    coverage_matrix,
    low_runs,
    volumes_by_quarter,
)
from tallymart.operators.trends import (
    mom_pct_change,
    reporting_rate,
    rolling_avg,
    top_underreporting,
)
from tallymart.sources.sinks import write_report


def run_analytics(
    fact: DataFrame,
    facilities: DataFrame,
    output_dir: str,
    hot_rows: int | None = HOT_ROWS,
    states: merged.States | None = None,
) -> None:
    """Programme reports.  The rolling mean has a row per fact row and is written unsorted.

    With ``states`` the others are merged from them, and the fact is read for the rolling mean alone.
    """
    out = f"{output_dir.rstrip('/')}/analytics"
    write_report(
        mom_pct_change(fact) if states is None else merged.mom_pct_change(states),
        f"{out}/mom_pct_change",
        order=["de_uid", "country_name", "district_name", "period"],
    )
    write_report(rolling_avg(fact, hot_rows=hot_rows), f"{out}/rolling_avg_3m")
    write_report(
        reporting_rate(fact, facilities) if states is None else merged.reporting_rate(states, facilities),
        f"{out}/reporting_rate",
        order=["country_name", "period"],
        single_file=True,
    )
    write_report(
        top_underreporting(fact) if states is None else merged.top_underreporting(states),
        f"{out}/top5_underreporting",
        order=["health_area", "rank_in_health_area", "ou_uid"],
    )


def run_aggregation(
    fact: DataFrame, output_dir: str, states: merged.States | None = None, countries: Sequence[str] | None = None
) -> None:
    """Reports across countries: all are one row per country, area or indicator and period.

    With ``states`` they are merged from them, and the fact is not read.  ``countries`` are the columns of the
    coverage matrix, those reported in by default.
    """
    out = f"{output_dir.rstrip('/')}/cross_country"
    rows = fact if states is None else states
    reports = {
        "volumes_by_quarter": (volumes_by_quarter, merged.volumes_by_quarter, ["health_area", "year", "quarter"]),
        "completeness_comparison": (
            completeness_comparison, merged.completeness_comparison, ["country_name", "period"]
        ),
        "coverage_matrix": (coverage_matrix, merged.coverage_matrix, ["health_area", "de_uid"]),
        "low_completeness_countries": (low_runs, merged.low_runs, ["country_name", "run_start_period"]),
    }
    for name, (of_rows, of_states, order) in reports.items():
        options = {"countries": countries} if name == "coverage_matrix" else {}
        df = (of_rows if states is None else of_states)(rows, **options)
        write_report(df, f"{out}/{name}", order=order, single_file=True)
