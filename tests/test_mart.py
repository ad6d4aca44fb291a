import json
from pathlib import Path

import pytest

import frames
from tallymart import schemas
from tallymart.operators.contract import ContractViolation
from tallymart.operators.incremental import (
    filter_new,
    load_incremental,
    loaded_partitions,
    merge_late,
    read_fact,
)
from tallymart.plans.mart import build_mart
from tallymart.sources import commits
from tallymart.sources.commits import publish_fact
from tallymart.sources.sinks import write_fact

CONTRACT = {
    "columns": {"de_uid": {"type": "string", "nullable": False}},
    "checks": [{"name": "year", "type": "range", "column": "year", "min": 2000, "max": 2100}],
}


def test_missing_fact_reads_empty(spark, out):
    assert loaded_partitions(spark, out).isEmpty()
    values = frames.values(spark, ("e", "202401", "u", "c", "1", None))
    got = load_incremental(spark, out, values)
    assert got.values.count() == 1 and got.is_incremental is False


def test_later_load_keeps_earlier_partitions(spark, out):
    january = frames.fact(spark, {"period": "202401"}, {"period": "202401", "health_area": "HIV"})
    february = frames.fact(spark, {"period": "202402"})
    write_fact(january, out)
    write_fact(february, out)
    write_fact(february, out)  # twice is once
    fact = read_fact(spark, out)
    assert frames.rows(fact) == frames.rows(january.unionByName(february))
    assert fact.schema["year_month"].dataType.simpleString() == "string"
    assert frames.rows(loaded_partitions(spark, out)) == [
        ("HIV", "202401"),
        ("Malaria", "202401"),
        ("Malaria", "202402"),
    ]
    write_fact(february, out, replace="table")
    assert read_fact(spark, out).count() == 1


def test_filter_new_by_period_or_by_area_and_period(spark, out):
    write_fact(frames.fact(spark, {"period": "202401", "health_area": "HIV"}), out)
    loaded = loaded_partitions(spark, out)
    offered = frames.fact(
        spark,
        {"period": "202401", "health_area": "HIV"},
        {"period": "202401", "health_area": "Malaria"},
        {"period": "202402", "health_area": "HIV"},
    )
    assert frames.rows(filter_new(offered, loaded), "period") == [("202402",)]
    by_both = [("health_area", "health_area"), ("period", "year_month")]
    assert frames.rows(filter_new(offered, loaded, on=by_both), "health_area", "period") == [
        ("HIV", "202402"),
        ("Malaria", "202401"),
    ]


def test_oversized_partition_is_split_over_files(spark, out):
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    try:
        for name, value in sizes.items():
            spark.conf.set(name, value)
        df = spark.range(200_000).selectExpr(
            "uuid() as v", "'A' as health_area", "if(id % 100 = 0, '202402', '202401') as year_month"
        )
        write_fact(df, out, replace="table")
    finally:
        for name in sizes:
            spark.conf.unset(name)
    hot = list(Path(f"{out}/health_area=A/year_month=202401").glob("*.parquet"))
    assert len(hot) > 1
    assert spark.read.parquet(out).count() == 200_000


def exports(folder, periods):
    folder.mkdir(parents=True, exist_ok=True)
    units = [
        ("K", "Kenya", "/K", 1),
        ("R", "Coast", "/K/R", 2),
        ("D", "Kilifi", "/K/R/D", 3),
        ("F1", "One", "/K/R/D/F1", 4),
        ("F2", "Two", "/K/R/D/F2", 4),
    ]
    elements = [
        {
            "id": e,
            "name": f"Indicator {e}",
            "valueType": "INTEGER",
            "dataElementGroups": [{"id": "g", "name": "HIV"}],
        }
        for e in "ab"
    ]
    values = [
        {
            "dataElement": e,
            "period": p,
            "orgUnit": f,
            "categoryOptionCombo": c,
            "value": v,
            "storedBy": "me",
            "lastUpdated": f"{p[:4]}-{p[4:]}-28T00:00:00.{n:03d}",
        }
        for p in periods
        for e in ["a", "b", "ghost"][: 3 if p.endswith("1") else 2]
        for f in ("F1", "F2")
        for n, (c, v) in enumerate([("c", "1"), ("c", "2"), ("d", None)])
    ]
    documents = {
        "metadata": {
            "dataElements": elements,
            "categoryOptionCombos": [{"id": "c", "name": "Combo"}],
        },
        "org_units": {
            "organisationUnits": [
                {"id": i, "name": n, "path": p, "level": level} for i, n, p, level in units
            ]
        },
        "programs": {
            "programs": [
                {"id": "p", "healthArea": "HIV", "country": "Kenya", "dataElements": ["a", "b"]}
            ]
        },
        "data_values": {"dataValues": values},
    }
    for name, doc in documents.items():
        (folder / f"{name}.json").write_text(json.dumps(doc))
    return str(folder)


def test_mart_from_documents(spark, tmp_path, out):
    months = ["202401", "202402", "202403"]
    whole = build_mart(spark, exports(tmp_path / "all", months), f"{out}/whole", contract=CONTRACT)
    assert whole.failures == [] and whole.contract.passed
    assert whole.ghost_rate == 6 / 42 and whole.quarantine_rate == 0.0
    assert whole.fact.count() == 3 * 2 * 2 * 2
    assert whole.fact.columns == schemas.FACT.names
    assert frames.rows(whole.fact.select("raw_value", "completeness_score").distinct()) == [
        ("2", 1.0),
        (None, 1.0),
    ]
    for name in (
        "analytics/mom_pct_change",
        "analytics/rolling_avg_3m",
        "analytics/reporting_rate",
        "analytics/top5_underreporting",
        "cross_country/volumes_by_quarter",
        "cross_country/completeness_comparison",
        "cross_country/coverage_matrix",
        "cross_country/low_completeness_countries",
        "anomalies",
    ):
        assert list(Path(f"{out}/whole/{name}").glob("*.csv")), name
    assert spark.read.parquet(f"{out}/whole/quarantine/unresolved").count() == 6

    # Loaded in two steps: the same fact, and the same dimension of periods.
    step = f"{out}/steps"
    first = build_mart(
        spark, exports(tmp_path / "first", months[:1]), step, incremental=True, contract=CONTRACT
    )
    assert first.is_incremental is False and first.fact.count() == 8
    second = build_mart(
        spark, exports(tmp_path / "all", months), step, incremental=True, contract=CONTRACT
    )
    assert second.is_incremental is True
    assert frames.rows(read_fact(spark, f"{step}/fact_service_delivery")) == frames.rows(
        read_fact(spark, f"{out}/whole/fact_service_delivery")
    )
    assert frames.rows(spark.read.parquet(f"{step}/dim_period")) == frames.rows(
        spark.read.parquet(f"{out}/whole/dim_period")
    )
    assert build_mart(spark, str(tmp_path / "all"), step, incremental=True) is None


def test_violated_contract_stops_before_the_write(spark, tmp_path, out):
    data = exports(tmp_path / "old", ["199001"])
    with pytest.raises(ContractViolation, match="year"):
        build_mart(spark, data, out, contract=CONTRACT, on_violation="raise")
    assert loaded_partitions(spark, f"{out}/fact_service_delivery").isEmpty()


def test_commits_are_what_readers_follow(spark, out):
    rows = [{"period": p, "health_area": a, "raw_value": v} for p in ("202401", "202402") for a in ("HIV", "TB: x/y%", None) for v in "12"]
    whole = frames.fact(spark, *[{**r, "de_uid": f"e{k}"} for k, r in enumerate(rows)])
    assert publish_fact(whole, out, replace="table") == 1
    before = read_fact(spark, out)
    assert frames.rows(before) == frames.rows(whole) and before.columns == schemas.FACT.names
    files = set(Path(out).rglob("*.parquet"))

    january = frames.fact(spark, {"period": "202401", "health_area": "HIV", "de_uid": "new"})
    assert publish_fact(january, out) == 2
    after = read_fact(spark, out)
    rest = whole.filter("not (period = '202401' and health_area <=> 'HIV')")
    assert frames.rows(after) == frames.rows(rest.unionByName(january))
    assert files <= set(Path(out).rglob("*.parquet"))  # no file of the first commit was touched
    assert frames.rows(before) == frames.rows(whole)  # a reader of the table as it was
    live = commits.live(spark, out)
    assert live.agg({"rows": "sum"}).first()[0] == after.count() == 11
    assert frames.rows(loaded_partitions(spark, out)) == frames.rows(after.select("health_area", "year_month").distinct())

    publish_fact(whole.limit(0), out, ended=whole.filter("health_area is null"))
    assert read_fact(spark, out).filter("health_area is null").isEmpty() and read_fact(spark, out).count() == 7
    publish_fact(january, out, replace="table")
    assert frames.rows(read_fact(spark, out)) == frames.rows(january)
    with pytest.raises(ValueError):
        publish_fact(january, out, replace="rows")


def test_a_failed_run_leaves_the_table(spark, out):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    good = frames.fact(spark, {"period": "202401"})
    publish_fact(good, out)
    broken = good.withColumn("raw_value", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(PySparkException):
        publish_fact(broken, out, replace="table")
    assert frames.rows(read_fact(spark, out)) == frames.rows(good) and loaded_partitions(spark, out).count() == 1


def test_month_filters_reach_the_files_of_the_fact(spark, out):
    for period in ("202401", "202402", "202402", "202403"):
        publish_fact(frames.fact(spark, {"period": period}), out)
    month = read_fact(spark, out).filter("year_month = '202402'")
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year_month" in plan.split("PartitionFilters")[1]
    assert month.count() == 1 and read_fact(spark, out).count() == 3


def test_loading_the_log_reads_no_data(spark, out):
    publish_fact(frames.fact(spark, {"period": "202401"}), out)
    for file in Path(out, "_data").rglob("*.parquet"):
        file.write_bytes(b"not read")
    assert loaded_partitions(spark, out).count() == 1


def correction(value, element="a", unit="F1", stamp="2024-09-01T00:00:00.000", period="202401"):
    return {
        "dataElement": element, "period": period, "orgUnit": unit, "categoryOptionCombo": "c", "value": value,
        "storedBy": "later", "lastUpdated": stamp,
    }


def with_values(folder, months, more):
    path = exports(folder, months)
    file = folder / "data_values.json"
    doc = json.loads(file.read_text())
    file.write_text(json.dumps({"dataValues": doc["dataValues"] + more}))
    return path


def test_late_rows_are_merged_as_if_all_had_been_loaded_at_once(spark, tmp_path, out):
    months = ["202401", "202402", "202403"]
    late = [
        correction("9"),  # a correction
        correction("8", stamp="2001-01-01T00:00:00.000"),  # older than what is stored
        correction("7", element="b", unit="F2", period="202402"),
    ]
    whole = build_mart(spark, with_values(tmp_path / "all", months, late), f"{out}/whole", contract=CONTRACT)
    step, fact = f"{out}/steps", f"{out}/steps/fact_service_delivery"
    build_mart(spark, exports(tmp_path / "first", months[:2]), step, incremental=True, contract=CONTRACT)
    third = [v for v in json.loads((tmp_path / "all/data_values.json").read_text())["dataValues"] if v["period"] == "202403"]
    offered = tmp_path / "second"
    exports(offered, months)
    (offered / "data_values.json").write_text(json.dumps({"dataValues": third + late}))
    got = build_mart(spark, str(offered), step, incremental=True, contract=CONTRACT, late="merge")
    assert got.is_incremental and got.skipped == 0
    assert frames.rows(read_fact(spark, fact)) == frames.rows(whole.fact)
    assert read_fact(spark, fact).filter("raw_value = '9' or raw_value = '7'").count() == 2

    # Offered again, nothing changes, and no partition is written.
    runs = {r.run for r in commits.live(spark, fact).collect()}
    again = build_mart(spark, str(offered), step, incremental=True, contract=CONTRACT, late="merge")
    assert frames.rows(again.fact) == frames.rows(whole.fact)
    assert {r.run for r in commits.live(spark, fact).collect()} == runs
    with pytest.raises(ValueError):
        build_mart(spark, str(offered), step, late="maybe")


def test_merging_leaves_other_partitions_and_ends_emptied_ones(spark, out):
    stored = [{"period": p, "de_uid": e, "last_updated": "2024-05-01"} for p in ("202401", "202402") for e in ("x", "y")]
    publish_fact(frames.fact(spark, *stored), out)
    moved = frames.fact(
        spark,
        {"period": "202401", "de_uid": "x", "last_updated": "2024-06-01", "health_area": "TB"},
        {"period": "202401", "de_uid": "y", "last_updated": "2024-06-01", "health_area": "TB"},
    )
    programs = spark.createDataFrame([], "country string, dataElements array<string>")
    facilities = spark.createDataFrame([], "facility_uid string, country_name string")
    merge = merge_late(read_fact(spark, out), moved, programs, facilities)
    assert frames.rows(merge.partitions) == [("Malaria", "202401"), ("TB", "202401")]
    publish_fact(merge.rows, out, ended=merge.partitions)
    got = read_fact(spark, out)
    assert frames.rows(got, "health_area", "year_month", "de_uid") == [
        ("Malaria", "202402", "x"), ("Malaria", "202402", "y"), ("TB", "202401", "x"), ("TB", "202401", "y"),
    ]
    versions = frames.rows(commits.live(spark, out), "year_month", "version")
    assert versions == [("202401", 2), ("202402", 1)]
