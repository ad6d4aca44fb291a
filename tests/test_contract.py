import pytest
from pyspark.sql import functions as F

import frames
from tallymart.operators.contract import (
    FACT_CONTRACT,
    ContractViolation,
    ObservedContract,
    assert_contract,
    contract_checks,
    validate_contract,
)


def violations(spark, **change):
    return validate_contract(frames.fact(spark, change), FACT_CONTRACT).violations


def test_contract_is_complete():
    assert FACT_CONTRACT["table"] == "fact_service_delivery"
    assert len(FACT_CONTRACT["columns"]) == 24 and len(FACT_CONTRACT["checks"]) == 6


def test_valid_rows_pass(spark):
    report = validate_contract(frames.fact(spark, {}, {"month": 3}), FACT_CONTRACT)
    assert report.passed, str(report)


@pytest.mark.parametrize(
    "change",
    [
        {"de_uid": None},
        {"ou_uid": None},
        {"period": None},
        {"completeness_score": 1.5},
        {"month": 0},
        {"year": 1990},
        {"health_area": "Diabetes"},
        {"quarter": "2024Q5"},
        {"year_month": "2024-1"},
    ],
)
def test_each_violation_names_its_column(spark, change):
    (column,) = change
    found = violations(spark, **change)
    assert found and all(column in v for v in found)


def test_zero_and_missing_exclude_each_other(spark):
    found = violations(spark, is_explicit_zero=True, is_missing_value=True)
    assert found == ["zero_null_distinction: 1 x is_explicit_zero and is_missing_value"]
    bare = {"columns": {}}
    both = frames.fact(spark, {"is_explicit_zero": True, "is_missing_value": True})
    assert not validate_contract(both, bare).passed


def test_missing_column(spark):
    report = validate_contract(frames.fact(spark, {}).drop("month"), FACT_CONTRACT)
    assert any("month" in v and "missing" in v for v in report.violations)


def test_wrong_type_and_near_names(spark):
    df = frames.fact(spark, {}).withColumn("year", F.col("year").cast("string"))
    assert any("expected integer" in v for v in validate_contract(df, {"columns": {"year": {"type": "integer"}}}).violations)
    array = frames.fact(spark, {}).withColumn("stored_by", F.array("stored_by"))
    assert not validate_contract(array, {"columns": {"stored_by": {"type": "string"}}}).passed
    wide = frames.fact(spark, {}).withColumn("year", F.col("year").cast("bigint"))
    assert validate_contract(wide, {"columns": {"year": {"type": "integer"}}}).passed


def test_pattern_is_checked_on_all_rows(spark):
    df = spark.range(20_001).select(
        F.when(F.col("id") == 20_000, "late").otherwise("202401").alias("period")
    )
    spec = {"columns": {"period": {"type": "string", "pattern": "^[0-9]{6}$"}}}
    assert validate_contract(df, spec).violations == [
        "period.pattern (period): 1 x no match of ^[0-9]{6}$"
    ]


def test_undeclared_columns(spark):
    df = frames.fact(spark, {})
    assert validate_contract(df, FACT_CONTRACT).passed
    found = validate_contract(df, FACT_CONTRACT, strict_columns=True).violations
    assert [v.split(".")[0] for v in found] == ["de_name"]


def test_all_rules_in_one_job(spark):
    checks = contract_checks(frames.fact(spark, {}, {"month": 13}), FACT_CONTRACT)
    rows = checks.collect()
    assert len(rows) > 60
    assert {r.rule_name for r in rows if not r.passed} == {"month.range", "valid_month"}
    detail = next(r.detail for r in rows if r.rule_name == "month.range")
    assert detail == "1..13 outside 1..12"


def test_raise_or_not(spark):
    assert_contract(frames.fact(spark, {}), FACT_CONTRACT)
    with pytest.raises(ContractViolation, match="de_uid"):
        assert_contract(frames.fact(spark, {"de_uid": None}), FACT_CONTRACT)


def test_a_rule_without_a_condition_is_no_pass(spark):
    contract = {"table": "t", "columns": {}, "checks": [{"name": "prose", "type": "custom"}]}
    row = contract_checks(spark.createDataFrame([(1,)], "a int"), contract).first()
    assert (row.violations, row.passed) == (None, None) and row.detail.startswith("not evaluated")
    report = validate_contract(spark.createDataFrame([(1,)], "a int"), contract)
    assert not report.passed


@pytest.mark.parametrize("n", [0, 1, 50])
def test_counted_in_the_write_as_from_the_rows(spark, tmp_path, n):
    changes = [{"month": i % 15, "health_area": "HIV" if i % 2 else "x", "de_uid": None} for i in range(n)]
    rules = {
        "columns": {**FACT_CONTRACT["columns"], "gone": {"type": "string"}},
        "checks": [*FACT_CONTRACT["checks"], {"name": "vague", "type": "custom"}],
    }
    fact = frames.fact(spark, *changes).repartition(3)
    counted = ObservedContract(fact, rules)
    counted.rows.write.parquet(str(tmp_path / "fact"))
    assert counted.counts()["_rows"] == n
    assert frames.rows(counted.checks()) == frames.rows(contract_checks(fact, rules))
    assert counted.report().violations == validate_contract(fact, rules).violations


def test_a_plan_known_to_be_empty_is_counted_too(spark, tmp_path):
    fact = frames.fact(spark, {})
    empty = fact.filter("1 = 0")
    counted = ObservedContract(empty, FACT_CONTRACT)
    counted.rows.write.parquet(str(tmp_path / "fact"))
    assert frames.rows(counted.checks()) == frames.rows(contract_checks(empty, FACT_CONTRACT))


def test_the_report_reads_no_written_row(spark, tmp_path):
    counted = ObservedContract(frames.fact(spark, {"month": 99}), FACT_CONTRACT)
    counted.rows.write.parquet(str(tmp_path / "fact"))
    plan = counted.checks()._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" not in plan.replace("LocalRelation", "") and not counted.report().passed
