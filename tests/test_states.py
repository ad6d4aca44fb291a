import random

import pytest
from pyspark.sql import functions as F

import frames
from tallymart import schemas
from tallymart.operators.incremental import _signatures
from tallymart.operators import crosscut, states, trends
from tallymart.sources.commits import publish_fact, read_committed
from tallymart.sources.states import read_states, refresh_states


def some_fact(spark, seed, months):
    """Rows with nulls in every key, no values, zeros, and names that differ within an indicator."""
    rng = random.Random(seed)
    made = []
    for _ in range(160):
        month = rng.choice(months)
        unit, element = rng.choice("uvwxy"), rng.choice("abc")
        made.append(
            {
                "health_area": rng.choice(["HIV", "Malaria", None]), "year_month": month, "period": month, "year": 2024,
                "month": int(month[4:]), "quarter": f"2024Q{(int(month[4:]) + 2) // 3}", "de_uid": rng.choice([element, None]),
                "de_name": rng.choice([element.upper(), "name", None]), "ou_uid": rng.choice([unit, unit, None]),
                "facility_name": unit, "country_name": {"u": "K", "v": "K", "w": "U"}.get(unit),
                "district_name": rng.choice(["d", "e"]), "numeric_value": rng.choice([None, 0.0, 2.0, 5.0]),
                "is_explicit_zero": rng.choice([True, False, None]), "completeness_score": rng.choice([None, 0.5, 1 / 3, 1.0]),
            }
        )
    return frames.fact(spark, *made)


def reports(fact, found, facilities):
    yield trends.mom_pct_change(fact), states.mom_pct_change(found)
    yield trends.reporting_rate(fact, facilities), states.reporting_rate(found, facilities)
    yield trends.reporting_rate(fact, facilities, densify=True), states.reporting_rate(found, facilities, densify=True)
    yield trends.top_underreporting(fact, 2), states.top_underreporting(found, 2)
    yield crosscut.volumes_by_quarter(fact), states.volumes_by_quarter(found)
    for weight in (crosscut.BY_ROW, crosscut.BY_FACILITY):
        yield crosscut.completeness_comparison(fact, weight), states.completeness_comparison(found, weight)
    yield crosscut.coverage_matrix(fact, unknown="none"), states.coverage_matrix(found, unknown="none")
    for gaps in (False, True):
        yield crosscut.low_runs(fact, 0.7, 1, gaps), states.low_runs(found, 0.7, 1, gaps)


def test_reports_of_states_are_those_of_the_fact(spark, out):
    facilities = spark.createDataFrame([("u", "K"), ("v", "K"), ("w", "U")], "facility_uid string, country_name string")
    publish_fact(some_fact(spark, 1, ["202401", "202402", "202405"]), out)
    read_states(spark, out)
    # One month anew, which ends nothing, and new ones.
    publish_fact(some_fact(spark, 2, ["202402", "202406"]), out)
    fact = read_committed(spark, out)
    for whole, merged in reports(fact, read_states(spark, out), facilities):
        assert sorted(whole.columns) == sorted(merged.columns)
        assert {f.name: f.dataType for f in whole.schema} == {f.name: f.dataType for f in merged.schema}
        assert frames.rows(merged, *whole.columns) == frames.rows(whole)
        assert whole.count()


def test_only_partitions_without_a_state_are_read(spark, out, monkeypatch):
    from tallymart.sources import states as module

    read, real = [], module.read_runs

    def seen(spark, path, partitions):
        df = real(spark, path, partitions)
        read.append({(r.health_area, r.year_month) for r in df.select("health_area", "year_month").distinct().collect()})
        files = {f.split("/run=")[1].split("/")[0] for f in df.inputFiles()}
        assert files <= {run for *_, run in partitions}
        return df

    monkeypatch.setattr(module, "read_runs", seen)
    publish_fact(frames.fact(spark, *[{"year_month": m, "period": m} for m in ("202401", "202402")]), out)
    assert refresh_states(spark, out) == 2
    assert refresh_states(spark, out) == 0  # nothing new
    publish_fact(frames.fact(spark, *[{"year_month": m, "period": m} for m in ("202402", "202403")]), out)
    found = read_states(spark, out)
    assert read == [{("Malaria", "202401"), ("Malaria", "202402")}, {("Malaria", "202402"), ("Malaria", "202403")}]
    assert frames.rows(found.units.select("year_month")) == [("202401",), ("202402",), ("202403",)]
    # The reports' plans scan states alone.
    assert not any("/_data/" in f for df in found for f in df.inputFiles())
    # A whole table of other months ends all states.
    publish_fact(frames.fact(spark, {"year_month": "202409", "period": "202409"}), out, replace="table")
    assert frames.rows(read_states(spark, out).sums.select("year_month")) == [("202409",)]


def test_a_failed_refresh_leaves_no_state(spark, out, monkeypatch):
    from tallymart.sources import states as module

    publish_fact(frames.fact(spark, {"year_month": "202401"}, {"year_month": "202402"}), out)
    real = module.states_of

    def broken(fact, *by):
        found = real(fact, *by)
        return found._replace(units=found.units.withColumn("n_values", F.raise_error(F.lit("lost")).cast("long")))

    monkeypatch.setattr(module, "states_of", broken)
    with pytest.raises(Exception, match="lost"):
        refresh_states(spark, out)
    monkeypatch.setattr(module, "states_of", real)
    assert refresh_states(spark, out) == 2
    assert read_states(spark, out).units.count() == 2


def test_no_rows_and_no_repeated_input(spark, out):
    found = read_states(spark, out)
    assert found.sums.isEmpty() and found.units.isEmpty()
    assert states.volumes_by_quarter(found).isEmpty() and states.low_runs(found).isEmpty()
    publish_fact(some_fact(spark, 3, ["202401"]), out)
    found = read_states(spark, out)
    for report in (states.volumes_by_quarter(found), states.completeness_comparison(found)):
        assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()


def test_signatures_are_sums_of_whole_numbers(spark):
    one, other = {"raw_value": "1"}, {"raw_value": "2"}
    signed = [_signatures(frames.fact(spark, *rows)) for rows in ((one, other), (other, one), (one, one))]
    same, again, differs = [frames.rows(df) for df in signed]
    assert same == again != differs
    assert {f.dataType.simpleString() for f in signed[0].schema if f.name not in schemas.FACT_PARTITIONS} == {"bigint"}
