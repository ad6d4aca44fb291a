"""From export documents to the written mart and its reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.sizing import sized
from tallymart.functions.skew import HOT_ROWS
from tallymart.operators.anomaly import sigma_anomalies
from tallymart.operators.contract import (
    FACT_CONTRACT,
    ContractReport,
    ContractViolation,
    ObservedContract,
)
from tallymart.operators.hierarchy import enrich_with_hierarchy, flatten_hierarchy
from tallymart.operators.incremental import (
    load_incremental,
    loaded_partitions,
    merge_late,
    read_fact,
)
from tallymart.operators.quality import dq_gate, gate_failures, run_dq
from tallymart.operators.resolve import resolve_keys
from tallymart.operators.star import (
    build_fact,
    dim_data_element,
    dim_org_unit,
    dim_period,
    dim_program,
)
from tallymart.plans.reports import run_aggregation, run_analytics
from tallymart.sources.commits import publish_fact
from tallymart.sources.documents import LOST
from tallymart.sources.exports import ingest_all
from tallymart.sources.sinks import write_dims, write_rejects, write_report
from tallymart.sources.states import read_states


class Mart(NamedTuple):
    fact: DataFrame
    facilities: DataFrame
    quarantine_rate: float
    ghost_rate: float
    contract: ContractReport
    failures: list[str]  # of the gate; reports are written only when empty
    is_incremental: bool
    skipped: int  # rows of periods loaded before


# Copies of equal stamp are ordered by everything else they can differ in.
VALUE_TIE_BREAK = ("created", "value", "storedBy", "attributeOptionCombo", "followup")


def build_mart(
    spark: SparkSession,
    data_dir: str,
    output_dir: str,
    incremental: bool = False,
    contract: Mapping[str, Any] = FACT_CONTRACT,
    on_violation: str = "warn",
    tie_break: Sequence[str] = VALUE_TIE_BREAK,
    layouts: Mapping[str, str] | None = None,
    hot_rows: int | None = HOT_ROWS,
    late: str = "aside",
) -> Mart | None:
    """Ingest, resolve, enrich, score, write the star schema, check it, and write the reports.

    The fact is staged, and its contract counted as it is, before the target is touched; with
    ``on_violation="raise"`` a violation ends the run there, ``"warn"`` goes on and reports it.  Copies of
    equal stamp are ordered by the ``tie_break`` columns, descending.  The fact is published in one
    commit.  Reports merge the states of its partitions, of which only those written are computed; the rolling
    mean and the anomalies read the rows.  An incremental run loads the periods the fact does not have yet.
    Rows of the others are kept ``"aside"``, or with ``late="merge"`` put to the stored ones: the fact is then
    as if all had been loaded at once, but that of copies of equal stamp and value the stored one stays.
    Without rows to load the result is ``None``.
    """
    if late not in ("aside", "merge"):
        raise ValueError("late must be 'aside' or 'merge'")
    if on_violation not in ("warn", "raise"):
        raise ValueError("on_violation must be 'warn' or 'raise'")
    out = output_dir.rstrip("/")
    staging, target = f"{out}/staging", f"{out}/fact_service_delivery"
    source = ingest_all(spark, data_dir, out, layouts)

    values, is_incremental = source.values, False
    n_values = source.counts["data_values"]["clean"]
    n_skipped = 0
    loaded = None
    if incremental and late == "merge":
        loaded = _landed(loaded_partitions(spark, target), f"{staging}/loaded")
        is_incremental = not loaded.isEmpty()
        if not n_values:
            return None
    elif incremental:
        values, is_incremental, skipped = load_incremental(spark, target, values)
        # Landed: "not loaded yet" has to mean before this run also once the target is written.
        values = _landed(values, f"{staging}/increment")
        n_values = values.count()
        # Late rows of loaded periods are kept aside and counted.
        skipped = _landed(skipped, f"{out}/quarantine/loaded_before")
        n_skipped = skipped.count()
        if not n_values:
            return None

    resolved, unresolvable = resolve_keys(
        values,
        source.elements,
        source.option_combos,
        source.org_units,
        path=f"{staging}/resolved",
    )
    ghosts = Observation()
    write_rejects(
        unresolvable.observe(ghosts, F.count(F.lit(1)).alias("n")),
        f"{out}/quarantine/unresolved",
    )
    ghost_rate = (ghosts.get["n"] or 0) / max(n_values, 1)

    facilities = _landed(flatten_hierarchy(source.org_units), f"{staging}/facilities")
    flagged = run_dq(
        resolved,
        source.programs,
        facilities,
        [F.desc_nulls_last(c) for c in tie_break],
        hot_rows=hot_rows,
        counted=values,
    )
    # Ancestors' names are attached after the shuffle of the values, which need not carry them.
    named = enrich_with_hierarchy(flagged, facilities)
    built = build_fact(named, source.programs, unique_input=True)
    checked = ObservedContract(built, contract)
    built = _landed(checked.rows, f"{staging}/fact")
    report = checked.report()
    if on_violation == "raise" and not report.passed:
        raise ContractViolation(str(report))
    if is_incremental and loaded is not None:
        months = sized(loaded.select("year_month").distinct().withColumnRenamed("year_month", "_month"))
        known = F.col("year_month").eqNullSafe(F.col("_month"))
        order = [F.desc_nulls_last("raw_value"), F.desc_nulls_last("stored_by")]
        merge = merge_late(
            read_fact(spark, target), built.join(months, known, "left_semi"), source.programs, facilities, order, hot_rows=hot_rows
        )
        new = built.join(months, known, "left_anti").unionByName(merge.rows)
        publish_fact(new, target, ended=merge.partitions)
    else:
        publish_fact(built, target, replace="partitions" if incremental else "table")

    fact = read_fact(spark, target)
    fresh = fact
    if is_incremental:
        # One name per month, so that only their partitions are read.
        months = [r.year_month for r in built.select("year_month").distinct().collect()]
        fresh = fact.filter(F.col("year_month").isin([m for m in months if m is not None]))
        if None in months:
            fresh = fact.filter(F.col("year_month").isNull()).unionByName(fresh)

    write_dims(
        {
            "dim_data_element": dim_data_element(source.elements),
            "dim_org_unit": dim_org_unit(facilities),
            # From the target, so that periods of earlier loads stay.
            "dim_period": dim_period(loaded_partitions(spark, target), "year_month"),
            "dim_program": dim_program(source.programs),
        },
        out,
    )

    lost = sum(counts[LOST] for counts in source.counts.values())
    failures = gate_failures(dq_gate(fresh, source.quarantine_rate, ghost_rate, lost_documents=lost))
    if not failures:
        states = read_states(spark, target)
        run_analytics(fact, facilities, out, hot_rows, states)
        run_aggregation(fact, out, states)
        write_report(
            sigma_anomalies(fact, hot_rows=hot_rows),
            f"{out}/anomalies",
            order=[F.desc("z_score")],
        )
    return Mart(
        fact,
        facilities,
        source.quarantine_rate,
        ghost_rate,
        report,
        failures,
        is_incremental,
        n_skipped,
    )


def _landed(df: DataFrame, path: str) -> DataFrame:
    """Written once and read back: later steps neither recompute it nor depend on its lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
