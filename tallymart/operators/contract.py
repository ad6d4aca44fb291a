"""Data contracts: declared columns and checks, evaluated in one aggregate over the data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Contract type names and the types that satisfy them.
TYPES = {
    "string": (T.StringType,),
    "integer": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "double": (T.DoubleType, T.FloatType, T.DecimalType),
    "boolean": (T.BooleanType,),
}

# The contract of the fact table.
FACT_CONTRACT: dict[str, Any] = {
    "table": "fact_service_delivery",
    "version": "1.0",
    "columns": {
        "de_uid": {"type": "string", "nullable": False},
        "ou_uid": {"type": "string", "nullable": False},
        "period": {"type": "string", "nullable": False, "pattern": "^[0-9]{6}$"},
        "program_id": {"type": "string", "nullable": True},
        "coc_uid": {"type": "string", "nullable": False},
        "coc_name": {"type": "string", "nullable": False},
        "raw_value": {"type": "string", "nullable": True},
        "numeric_value": {"type": "double", "nullable": True},
        "is_late_reported": {"type": "boolean", "nullable": False},
        "is_explicit_zero": {"type": "boolean", "nullable": False},
        "is_missing_value": {"type": "boolean", "nullable": False},
        "is_orphaned_coc": {"type": "boolean", "nullable": False},
        "completeness_score": {"type": "double", "nullable": True, "min": 0.0, "max": 1.0},
        "stored_by": {"type": "string", "nullable": True},
        "last_updated": {"type": "string", "nullable": True},
        "health_area": {
            "type": "string",
            "nullable": False,
            "allowed_values": [
                "Malaria",
                "HIV",
                "Tuberculosis",
                "Reproductive Health",
                "Child Health",
            ],
        },
        "year_month": {"type": "string", "nullable": False, "pattern": "^[0-9]{6}$"},
        "year": {"type": "integer", "nullable": False, "min": 2000, "max": 2100},
        "month": {"type": "integer", "nullable": False, "min": 1, "max": 12},
        "quarter": {"type": "string", "nullable": False, "pattern": "^[0-9]{4}Q[1-4]$"},
        "country_name": {"type": "string", "nullable": True},
        "region_name": {"type": "string", "nullable": True},
        "district_name": {"type": "string", "nullable": True},
        "facility_name": {"type": "string", "nullable": True},
    },
    "checks": [
        {
            "name": "no_null_primary_key",
            "type": "not_null",
            "columns": ["de_uid", "ou_uid", "period"],
        },
        {
            "name": "zero_null_distinction",
            "type": "custom",
            "violated_if": "is_explicit_zero and is_missing_value",
        },
        {
            "name": "completeness_range",
            "type": "range",
            "column": "completeness_score",
            "min": 0.0,
            "max": 1.0,
        },
        {
            "name": "valid_health_area",
            "type": "allowed_values",
            "column": "health_area",
            "values": ["Malaria", "HIV", "Tuberculosis", "Reproductive Health", "Child Health"],
        },
        {"name": "valid_month", "type": "range", "column": "month", "min": 1, "max": 12},
        {"name": "valid_year", "type": "range", "column": "year", "min": 2000, "max": 2100},
    ],
}

_ZERO_AND_MISSING = ("is_explicit_zero", "is_missing_value")


class ContractViolation(Exception):
    """The data break their contract; the message lists every violation."""


@dataclass(frozen=True)
class Rule:
    """``violated`` counts rows when it is an expression; a bool is settled by the schema."""

    name: str
    kind: str
    column: str
    violated: Column | bool | None  # None: cannot be evaluated
    detail: Column


@dataclass(frozen=True)
class ContractReport:
    violations: list[str]

    @property
    def passed(self) -> bool:
        return not self.violations

    def __str__(self) -> str:
        if self.passed:
            return "Contract holds."
        return "\n".join(["Contract violated:", *[f"  - {v}" for v in self.violations]])


def _null_rule(name: str, column: str) -> Rule:
    return Rule(name, "not_null", column, F.col(column).isNull(), F.lit("null values"))


def _range_rule(name: str, column: str, spec: Mapping[str, Any]) -> Rule:
    value = F.col(column)
    outside = F.lit(False)
    if spec.get("min") is not None:
        outside = outside | (value < F.lit(spec["min"]))
    if spec.get("max") is not None:
        outside = outside | (value > F.lit(spec["max"]))
    bounds = f" outside {spec.get('min', '')}..{spec.get('max', '')}"
    seen = F.concat_ws("..", F.min(value).cast("string"), F.max(value).cast("string"))
    return Rule(name, "range", column, outside, F.concat(seen, F.lit(bounds)))


def _enum_rule(name: str, column: str, allowed: list[Any]) -> Rule:
    listed = ", ".join(str(v) for v in sorted(allowed))
    return Rule(
        name,
        "allowed_values",
        column,
        ~F.col(column).isin(list(allowed)),
        F.lit(f"values outside: {listed}"),
    )


def _pattern_rule(name: str, column: str, pattern: str) -> Rule:
    return Rule(
        name, "pattern", column, ~F.col(column).rlike(pattern), F.lit(f"no match of {pattern}")
    )


def _column_rules(
    column: str, spec: Mapping[str, Any], actual: T.DataType | None
) -> list[Rule]:
    if actual is None:
        return [Rule(f"{column}.present", "present", column, True, F.lit("missing column"))]
    rules = [Rule(f"{column}.present", "present", column, False, F.lit("missing column"))]
    declared = spec.get("type")
    if declared:
        fits = isinstance(actual, TYPES[declared]) if declared in TYPES else (
            actual.simpleString() == declared
        )
        detail = f"expected {declared}, found {actual.simpleString()}"
        rules.append(Rule(f"{column}.type", "type", column, not fits, F.lit(detail)))
    if spec.get("nullable") is False:
        rules.append(_null_rule(f"{column}.not_null", column))
    if "min" in spec or "max" in spec:
        rules.append(_range_rule(f"{column}.range", column, spec))
    if "allowed_values" in spec:
        rules.append(_enum_rule(f"{column}.allowed_values", column, spec["allowed_values"]))
    if "pattern" in spec:
        rules.append(_pattern_rule(f"{column}.pattern", column, spec["pattern"]))
    return rules


def _check_rules(check: Mapping[str, Any], present: Mapping[str, T.DataType]) -> list[Rule]:
    name, kind = check["name"], check["type"]
    if kind == "custom":
        if "violated_if" not in check:
            return [Rule(name, kind, "", None, F.lit("not evaluated: the check has no condition"))]
        condition = F.expr(check["violated_if"])
        return [Rule(name, kind, "", condition, F.lit(check["violated_if"]))]
    columns = check.get("columns") or [check["column"]]
    absent = [c for c in columns if c not in present]
    rules = [
        Rule(name, kind, c, True, F.lit("missing column")) for c in absent
    ]
    for c in columns:
        if c in absent:
            continue
        if kind == "not_null":
            rules.append(_null_rule(name, c))
        elif kind == "range":
            rules.append(_range_rule(name, c, check))
        elif kind == "allowed_values":
            rules.append(_enum_rule(name, c, check["values"]))
        elif kind == "pattern":
            rules.append(_pattern_rule(name, c, check["pattern"]))
        else:
            raise ValueError(f"unknown check type {kind!r}")
    return rules


def contract_rules(
    df: DataFrame, contract: Mapping[str, Any], strict_columns: bool = False
) -> list[Rule]:
    """Rules of ``contract`` for the schema of ``df``.

    ``contract`` has ``columns`` (name to type, nullable, min, max, allowed_values, pattern) and
    ``checks`` (not_null, range, allowed_values, pattern, custom).  Zero and missing at once is a
    violation wherever both flags are there.  ``strict_columns`` reports undeclared columns.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = contract.get("columns", {})
    rules: list[Rule] = []
    for column, spec in columns.items():
        rules += _column_rules(column, spec, present.get(column))
    for check in contract.get("checks", []):
        rules += _check_rules(check, present)
    if all(c in present for c in _ZERO_AND_MISSING) and not any(
        c.get("name") == "zero_null_distinction" and "violated_if" in c
        for c in contract.get("checks", [])
    ):
        both = F.col(_ZERO_AND_MISSING[0]) & F.col(_ZERO_AND_MISSING[1])
        rules.append(
            Rule(
                "zero_null_distinction",
                "custom",
                "",
                both,
                F.lit("is_explicit_zero and is_missing_value"),
            )
        )
    if strict_columns:
        for column in present:
            if column not in columns:
                rules.append(
                    Rule(f"{column}.declared", "declared", column, True, F.lit("undeclared column"))
                )
    return rules


def contract_checks(
    df: DataFrame, contract: Mapping[str, Any], strict_columns: bool = False
) -> DataFrame:
    """One row per rule: rule_name, kind, column_name, violations, passed, detail.

    One pass over the data whatever the number of rules, and all rows are checked.
    ``violations`` is the number of rows, or 1 for a rule about the schema.  A rule that cannot be
    evaluated has null in ``violations`` and ``passed``; it is not a pass.
    """
    measures, rows = _measured(contract_rules(df, contract, strict_columns))
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def _measured(rules: list[Rule]) -> tuple[list[Column], list[Column]]:
    """(aggregates over the data, a row for each rule from their results)."""
    measures, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, rule in enumerate(rules):
        detail = rule.detail
        if rule.violated is None:
            count = F.lit(None).cast("bigint")
        elif isinstance(rule.violated, bool):
            count = F.lit(int(rule.violated)).cast("bigint")
        else:
            count = F.col(f"n{i}")
            measures.append(F.count_if(rule.violated).alias(f"n{i}"))
            if rule.kind == "range":  # tells the values seen
                detail = F.col(f"seen{i}")
                measures.append(rule.detail.alias(f"seen{i}"))
        rows.append(
            F.struct(
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.kind).alias("kind"),
                F.lit(rule.column).alias("column_name"),
                count.alias("violations"),
                (count == 0).alias("passed"),
                F.when(count.isNull() | (count > 0), detail).alias("detail"),
            )
        )
    return measures, rows


class ObservedContract:
    """A contract counted in a write that happens anyway.

    Write ``rows``, once, and ask for ``checks()`` or ``report()`` afterwards: the rules have seen every
    row that the write did, and no job reads the data again.  ``rows`` has to go straight into the write,
    since a shuffle in between could run, and count, a lost task's rows twice.
    """

    def __init__(self, df: DataFrame, contract: Mapping[str, Any], strict_columns: bool = False):
        self._measures, self._rules = _measured(contract_rules(df, contract, strict_columns))
        self._seen = Observation()
        self._none = df.sparkSession.createDataFrame([], df.schema).agg(*self._measures)
        self.rows = df.observe(self._seen, *self._measures)

    def counts(self) -> dict[str, Any]:
        """The aggregates' results, ``_rows`` among them; waits for the write."""
        # A plan known to be empty counts nothing.
        return self._seen.get or self._none.first().asDict()

    def checks(self) -> DataFrame:
        """As :func:`contract_checks`."""
        counted = self._none.sparkSession.createDataFrame([self.counts()], self._none.schema)
        return counted.select(F.inline(F.array(*self._rules)))

    def report(self) -> ContractReport:
        """As :func:`validate_contract`."""
        return _report(self.checks())


def validate_contract(
    df: DataFrame, contract: Mapping[str, Any], strict_columns: bool = False
) -> ContractReport:
    """Report of the violated rules.  Never raises over data."""
    return _report(contract_checks(df, contract, strict_columns))


def _report(checks: DataFrame) -> ContractReport:
    broken = checks.filter(~F.coalesce("passed", F.lit(False))).collect()
    return ContractReport(
        [
            f"{r.rule_name}"
            + (f" ({r.column_name})" if r.column_name else "")
            + (f": {r.detail}" if r.violations is None else f": {r.violations:,} x {r.detail}")
            for r in broken
        ]
    )


def assert_contract(
    df: DataFrame, contract: Mapping[str, Any], strict_columns: bool = False
) -> None:
    report = validate_contract(df, contract, strict_columns)
    if not report.passed:
        raise ContractViolation(str(report))
