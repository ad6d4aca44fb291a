"""Registered queries: each operator over the whole test tables, through the fixture."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart import schemas
from tallymart.functions.skew import HOT_ROWS
from tallymart.operators import (
    anomaly,
    contract,
    crosscut,
    gaps,
    hierarchy,
    incremental,
    quality,
    resolve,
    star,
    states,
    trends,
)
from tallymart.plans import fixture, reports
from tallymart.plans.oracle import CUTOFF
from tallymart.functions.casting import typed_number
from tallymart.functions.scratch import scratch_path, written
from tallymart.sources import commits, documents, exports, sinks
from tallymart.sources.states import read_states

Query = Callable[[SparkSession, str], DataFrame]

# Small enough for many groups of the test tables to count as hot.
FEW_ROWS = 20
FEW_ROWS_PER_PLACE = 8

# Rules of each kind, most of them violated by the fixture.
FIXTURE_CONTRACT = {
    "table": "fact",
    "columns": {
        "reviewed_by": {"type": "string"},
        "program_id": {"type": "string", "nullable": False},
        "numeric_value": {"type": "double", "min": 1, "max": 49},
        "health_area": {"type": "string", "allowed_values": ["A", "B", "C", "D"]},
        "quarter": {"type": "string", "pattern": "^199[2-6]Q[1-4]$"},
        "year": {"type": "string"},
    },
    "checks": [
        {
            "name": "late_zero",
            "type": "custom",
            "violated_if": "is_late_reported and is_explicit_zero",
        },
        {"name": "key_there", "type": "not_null", "columns": ["de_uid", "ou_uid"]},
        {"name": "plausible", "type": "custom"},
    ],
}


# --- the steps of the mart over the fixture ---------------------------------------------------


_landed: dict[tuple[str, str, str], DataFrame] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build: Query) -> DataFrame:
    """A lookup written once per session and read from there, as after ingestion."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = scratch_path(spark, name)
        build(spark, sf_dir).write.parquet(path)
        _landed[key] = spark.read.parquet(path)
    return _landed[key]


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "elements", fixture.elements)


def option_combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "option_combos", fixture.option_combos)


def org_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "org_units", fixture.org_units)


def programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "programs", fixture.programs)


def flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.flatten_hierarchy(org_units(spark, sf_dir))


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "facilities", flattened)


def resolved(spark: SparkSession, sf_dir: str) -> resolve.Resolved:
    return resolve.resolve_keys(
        fixture.reports(spark, sf_dir),
        elements(spark, sf_dir),
        option_combos(spark, sf_dir),
        org_units(spark, sf_dir),
        path=scratch_path(spark, "resolved"),
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.enrich_with_hierarchy(
        resolved(spark, sf_dir).rows, facilities(spark, sf_dir)
    )


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedup_latest(resolved(spark, sf_dir).rows, fixture.tie_break())


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        enriched(spark, sf_dir)
        .transform(quality.dedup_latest, fixture.tie_break())
        .transform(quality.cast_values)
        .transform(quality.add_dq_flags)
    )


def fact(
    spark: SparkSession,
    sf_dir: str,
    hot_rows: int | None = HOT_ROWS,
    values: DataFrame | None = None,
) -> DataFrame:
    """The fact of ``values``, else of all that resolve: these are read once, so they are not written, and hot units and
    periods are counted before their keys are resolved."""
    known = programs(spark, sf_dir)
    leaves = facilities(spark, sf_dir)
    counted = None
    if values is None:
        counted = fixture.reports(spark, sf_dir)
        lookups = elements(spark, sf_dir), option_combos(spark, sf_dir), org_units(spark, sf_dir)
        values = resolve.resolve_keys(counted, *lookups).rows
    scored = quality.run_dq(values, known, leaves, fixture.tie_break(), hot_rows=hot_rows, counted=counted)
    # Names are attached after the shuffle, so that it does not carry them.
    named = hierarchy.enrich_with_hierarchy(scored, leaves)
    return star.build_fact(named, known, unique_input=True)


# --- sources ----------------------------------------------------------------------------------


def _packed(spark: SparkSession, rows: DataFrame) -> str:
    """Path of the value rows written as documents, one per line."""
    path = scratch_path(spark, "data_values")
    fixture.packed_documents(
        rows, {"responseType": "DataValueSet", "version": "1"}, "dataValues"
    ).write.text(path)
    return path


def ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _packed(spark, fixture.reports(spark, sf_dir).select(*schemas.DATA_VALUE.names))
    read = documents.read_documents(spark, path, schemas.DATA_VALUE_DOCUMENT, layout="line")
    return documents.parse_and_explode(read, "dataValues")


def ingest_split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one large document each, read in pieces."""
    path = scratch_path(spark, "data_values")
    rows = fixture.reports(spark, sf_dir).select(*schemas.DATA_VALUE.names)
    fixture.packed_documents(
        rows, {"responseType": "DataValueSet", "version": "1"}, "dataValues", 50_000
    ).write.option("maxRecordsPerFile", 1).text(path)
    tagged = exports.tagged_export(spark, exports.DATA_VALUES, path, layout="split")
    return tagged.filter(F.col("status") == documents.CLEAN).select(*schemas.DATA_VALUE.names)


def ingest_split_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with objects and arrays inside the elements, and braces and quotes inside the values."""
    path = scratch_path(spark, "nested_values")
    odd = F.when(F.col("ok") % 3 == 0, F.concat("storedBy", F.lit(' a}b\\"]{"dataValues":[{')))
    inner = F.struct(F.lit("}{").alias("note"), F.array(F.struct(F.col("ok"), F.lit('\\"').alias("mark"))).alias("dataValues"))
    rows = fixture.reports(spark, sf_dir).withColumn("storedBy", F.coalesce(odd, "storedBy"))
    rows = rows.select(inner.alias("detail"), *schemas.DATA_VALUE.names, F.array("ln", "ok").alias("numbers"))
    fixture.packed_documents(
        rows, {"responseType": "dataValues", "version": '"}]'}, "dataValues", 50_000
    ).write.option("maxRecordsPerFile", 1).text(path)
    tagged = exports.tagged_export(spark, exports.DATA_VALUES, path, layout="split")
    return tagged.filter(F.col("status") == documents.CLEAN).select(*schemas.DATA_VALUE.names)


def ingest_split_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested export of one document a file, every column of it, nested ones too."""
    path = scratch_path(spark, "split_units")
    fixture.packed_documents(org_units(spark, sf_dir), {"date": "x", "version": "1"}, "organisationUnits", 100_000).write.option(
        "maxRecordsPerFile", 1
    ).text(path)
    rows = exports.load_export(spark, exports.ORG_UNITS, path, layout="split").rows
    group = F.transform("groups", lambda g: F.concat_ws(":", g["id"], g["name"]))
    return rows.select(
        "id", "name", "level", "path", F.col("parent.id").alias("parent"), F.array_join(group, ",").alias("groups")
    )


def ingest_file_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one document each, every one read whole by one task."""
    path = scratch_path(spark, "data_values")
    rows = fixture.reports(spark, sf_dir).select(*schemas.DATA_VALUE.names)
    fixture.packed_documents(
        rows, {"responseType": "DataValueSet", "version": "1"}, "dataValues", 5_000
    ).write.option("maxRecordsPerFile", 1).text(path)
    read = documents.read_documents(spark, path, schemas.DATA_VALUE_DOCUMENT, layout="file")
    return documents.parse_and_explode(read, "dataValues")


def _incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        fixture.reports(spark, sf_dir)
        .withColumn("dataElement", F.when(F.col("ok") % 37 != 0, F.col("dataElement")))
        .withColumn("period", F.when(F.col("ok") % 41 != 0, F.col("period")))
        .withColumn("orgUnit", F.when(F.col("ln") != 6, F.col("orgUnit")))
    )


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _incomplete(spark, sf_dir)
    columns = ["ok", "ln", "px", "dataElement", "period", "orgUnit", "value"]
    critical = exports.DATA_VALUES.critical
    clean, rejected = documents.split_quarantine(rows.select(*columns), critical)
    return (
        clean.withColumn("quarantine_reason", F.lit(None).cast("string"))
        .withColumn("status", F.lit(documents.CLEAN))
        .unionByName(rejected.withColumn("status", F.lit(documents.REJECTED)))
    )


def ingest_lost_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order; some cut off, some without the array, some without a unit."""
    key = F.col("o_orderkey")
    unit = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    item = F.struct(
        F.col("o_orderpriority").alias("dataElement"),
        F.date_format("o_orderdate", "yyyyMM").alias("period"),
        F.when(key % 7 != 0, unit).alias("orgUnit"),
    )
    whole = F.to_json(F.struct(F.lit("1").alias("version"), F.array(item).alias("dataValues")))
    text = (
        F.when(key % 97 == 0, whole.substr(F.lit(1), F.length(whole) - 3))
        .when(key % 89 == 0, F.lit('{"version":"1"}'))
        .otherwise(whole)
    )
    path = scratch_path(spark, "orders")
    fixture.table(spark, sf_dir, "orders").select(text.alias("value")).write.text(path)
    tagged = exports.tagged_export(spark, exports.DATA_VALUES, path, layout="line")
    return tagged.groupBy(
        "status", "quarantine_reason", F.col("dataElement").alias("item")
    ).agg(F.count(F.lit(1)).alias("documents"))


def ingest_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by status of the four documents, from the written staging tables."""
    path = scratch_path(spark, "exports")
    values = fixture.reports(spark, sf_dir).withColumn(
        "orgUnit", F.when(F.col("ok") % 37 != 0, F.col("orgUnit"))
    )
    fixture.write_exports(spark, sf_dir, path, values)
    names = [e.file for e in (exports.ELEMENTS, exports.ORG_UNITS, exports.PROGRAMS)]
    layouts = dict.fromkeys([*names, exports.DATA_VALUES.file], "line")
    exports.ingest_all(spark, path, f"{path}/out", layouts)
    staged = []
    for name in ("elements", "option_combos", "org_units", "programs", "data_values"):
        rows = spark.read.parquet(f"{path}/out/staging/{name}")
        staged.append(
            rows.agg(
                F.count_if(F.col("status") == documents.CLEAN).alias("clean"),
                F.count_if(F.col("status") == documents.REJECTED).alias("rejected"),
            ).select(F.lit(name).alias("dataset"), "clean", "rejected")
        )
    out = staged[0]
    for part in staged[1:]:
        out = out.unionByName(part)
    return out


def exports_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the three lookup exports, as loaded from their documents."""
    path = scratch_path(spark, "exports")
    fixture.write_exports(spark, sf_dir, path)
    metadata = exports.load_metadata(spark, path, "line")
    text = F.lit(None).cast("string")
    parts = {
        "element": metadata.elements.select("id", "name", F.col("valueType").alias("detail")),
        "combo": metadata.option_combos.select("id", "name", text.alias("detail")),
        "program": exports.load_programs(spark, path, "line").rows.select(
            "id", "name", F.col("country").alias("detail")
        ),
        "unit": exports.load_org_units(spark, path, "line").rows.select(
            "id", "name", F.col("path").alias("detail")
        ),
    }
    rows = [df.select(F.lit(kind).alias("kind"), "*") for kind, df in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


def events_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = T.StructType([T.StructField("k", T.IntegerType())])
    return fixture.table(spark, sf_dir, "events").select(
        "event_id", "event_type", *documents.json_column("props", shape, "k")
    )


# --- keys, hierarchy, quality -----------------------------------------------------------------


def metadata_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.element_lookup(elements(spark, sf_dir))


def resolve_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir).rows.select(
        *schemas.DATA_VALUE.names,
        *fixture.TIE_BREAK,
        "de_name",
        "value_type",
        "health_area",
        "coc_name",
        "is_orphaned_coc",
    )


def resolve_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved(spark, sf_dir).rejects


def hierarchy_leaves_without_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All units; a nation without suppliers is a leaf too, with nulls below its level."""
    return hierarchy.flatten_hierarchy(
        org_units(spark, sf_dir), leaf_rule=hierarchy.LEAF_WITHOUT_CHILDREN
    )


def hierarchy_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    ancestry = [
        c for c in facilities(spark, sf_dir).columns if c != "facility_uid"
    ]
    return enriched(spark, sf_dir).select(
        "dataElement", "orgUnit", *fixture.TIE_BREAK, *ancestry, "is_non_leaf"
    )


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).select(
        *schemas.DATA_VALUE.names, *fixture.TIE_BREAK, "de_name"
    )


def cast_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.cast_values(latest(spark, sf_dir)).select(
        "dataElement", *fixture.TIE_BREAK, "value", "value_type", "numeric_value"
    )


def cast_values_odd_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with what a cast alone would take as part of them: exponents, type suffixes, words."""
    suffixes = F.array(*[F.lit(s) for s in ("", ".0", "e2", "d", " NaN")])
    whole = F.col("l_quantity").cast("int").cast("string")
    text = F.concat(whole, F.get(suffixes, F.col("l_linenumber").cast("int") % 5))
    return fixture.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", text.alias("text"),
        typed_number(text, F.lit("NUMBER")).alias("numeric_value"),
    )


def dq_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.add_dq_flags(latest(spark, sf_dir)).select(
        "dataElement",
        "period",
        "orgUnit",
        "categoryOptionCombo",
        "value",
        "is_late_reported",
        "is_explicit_zero",
        "is_missing_value",
        "is_orphaned_coc",
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.add_calendar(latest(spark, sf_dir)).select(
        "dataElement",
        "orgUnit",
        "categoryOptionCombo",
        "period",
        "year",
        "month",
        "year_month",
        "quarter",
        "period_end_date",
    )


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_summary(quality.add_dq_flags(latest(spark, sf_dir)))


def _scores(**options: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.completeness_scores(
            latest(spark, sf_dir),
            programs(spark, sf_dir),
            facilities(spark, sf_dir),
            **options,
        )

    return query


def _strayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of which two months lie far off, one of them in no plausible year."""
    p = F.col("period")
    off = F.when(p == "199503", "999912").when(p == "199504", "198001").otherwise(p)
    return latest(spark, sf_dir).withColumn("period", off)


def completeness_dense_stray(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = facilities(spark, sf_dir)
    return quality.completeness_scores(
        _strayed(spark, sf_dir), programs(spark, sf_dir), units, densify=True
    )


def silent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.silent_runs(latest(spark, sf_dir), facilities(spark, sf_dir))


def silent_runs_stray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gaps.silent_runs(_strayed(spark, sf_dir), facilities(spark, sf_dir))


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates from one aggregate each: of the rows with gaps, and of the rows by status of their keys."""
    gaps = documents.missing_reason(exports.DATA_VALUES.critical)
    quarantined = _incomplete(spark, sf_dir).agg(F.avg(gaps.isNotNull().cast("int"))).first()[0]
    tagged = resolve.tag_keys(
        fixture.reports(spark, sf_dir),
        elements(spark, sf_dir),
        option_combos(spark, sf_dir),
        org_units(spark, sf_dir),
    )
    tagged = written(tagged, "tagged")
    known = F.col("status") == resolve.RESOLVED
    ghosts = tagged.agg(F.count_if(~known) / F.count("*")).first()[0]
    return quality.dq_gate(
        fact(spark, sf_dir, values=resolve.parted(tagged).rows),
        quarantine_rate=quarantined or 0.0,
        ghost_rate=ghosts,
        max_ghost_rate=0.09,
        lost_documents=0,
    )


# --- star schema ------------------------------------------------------------------------------


def dim_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_data_element(elements(spark, sf_dir))


def dim_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_org_unit(facilities(spark, sf_dir))


def dim_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_period(latest(spark, sf_dir))


def dim_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_program(programs(spark, sf_dir)).withColumn(
        "expected_de_uids", F.array_join("expected_de_uids", "|")
    )


def fact_split_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of hot groups are read apart from the others, so what resolves is written."""
    return fact(spark, sf_dir, FEW_ROWS_PER_PLACE, resolved(spark, sf_dir).rows)


def _fact_null_periods(hot_rows: int | None) -> Query:
    """The rows of every February come without a period."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        period = F.when(F.col("period").substr(5, 2) != "02", F.col("period"))
        values = resolved(spark, sf_dir).rows.withColumn("period", period)
        return fact(spark, sf_dir, hot_rows, values)

    return query


def _rolling_null_keys(hot_rows: int | None) -> Query:
    """Some years' rows lose their unit, some months' rows their indicator."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        keyless = written(fact(spark, sf_dir), "fact").withColumns(
            {
                "ou_uid": F.when(F.col("year") % 3 != 0, F.col("ou_uid")),
                "de_uid": F.when(F.col("month") % 4 != 0, F.col("de_uid")),
            }
        )
        return trends.rolling_avg(keyless, by_calendar=True, hot_rows=hot_rows)

    return query


# --- reports ----------------------------------------------------------------------------------


def _on_fact(operator: Callable[..., DataFrame], **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(fact(spark, sf_dir), **options)

    return query


def _on_written_fact(operator: Callable[..., DataFrame], **options) -> Query:
    """For operators that read the fact more than once: it is written first, as in the mart."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(written(fact(spark, sf_dir), "fact"), **options)

    return query


def _rate(densify: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return trends.reporting_rate(
            fact(spark, sf_dir), facilities(spark, sf_dir), densify=densify
        )

    return query


def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosscut.coverage_matrix(fact(spark, sf_dir), _countries(spark, sf_dir))


def _countries(spark: SparkSession, sf_dir: str) -> list[str]:
    top = org_units(spark, sf_dir).filter(F.col("level") == 1).select("name")
    return sorted(row["name"] for row in top.collect())


def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.contract_checks(fact(spark, sf_dir), FIXTURE_CONTRACT)


def contract_report_in_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the fact is written."""
    counted = contract.ObservedContract(fact(spark, sf_dir), FIXTURE_CONTRACT)
    written(counted.rows, "fact")
    return counted.checks()


# --- sinks and increments ---------------------------------------------------------------------


def fact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    sinks.write_fact(fact(spark, sf_dir), path, replace="table")
    return incremental.read_fact(spark, path)


def report_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "volumes")
    report = crosscut.volumes_by_quarter(fact(spark, sf_dir))
    sinks.write_report(report, path, order=["health_area", "quarter"], single_file=True)
    return spark.read.schema(report.schema).csv(path, header=True)


def _together(tables: dict[str, DataFrame]) -> DataFrame:
    """All rows of all tables by name of column, with the table's name in ``report``."""
    named = [df.withColumn("report", F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def dims_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the four dimensions' files."""
    dims = {
        "dim_element": dim_element(spark, sf_dir),
        "dim_unit": dim_unit(spark, sf_dir),
        "dim_period": dim_period(spark, sf_dir),
        "dim_program": dim_program(spark, sf_dir),
    }
    out = scratch_path(spark, "dims")
    sinks.write_dims(dims, out)
    return _together({name: spark.read.parquet(f"{out}/{name}") for name in dims})


def analytics_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the files of all programme reports, from one run over the fact."""
    out, rows, units = scratch_path(spark, "mart"), written(fact(spark, sf_dir), "fact"), facilities(spark, sf_dir)
    reports.run_analytics(rows, units, out)
    none = rows.limit(0)
    alike = {
        "mom_pct_change": trends.mom_pct_change(none),
        "rolling_avg_3m": trends.rolling_avg(none, hot_rows=None),
        "reporting_rate": trends.reporting_rate(none, units),
        "top5_underreporting": trends.top_underreporting(none),
    }
    return _read_reports(spark, f"{out}/analytics", alike)


def aggregation_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the files of all reports across countries, from one run over the fact."""
    out, rows = scratch_path(spark, "mart"), written(fact(spark, sf_dir), "fact")
    countries = _countries(spark, sf_dir)
    reports.run_aggregation(rows, out, countries=countries)
    none = rows.limit(0)
    alike = {
        "volumes_by_quarter": crosscut.volumes_by_quarter(none),
        "completeness_comparison": crosscut.completeness_comparison(none),
        "coverage_matrix": crosscut.coverage_matrix(none, countries),
        "low_completeness_countries": crosscut.low_runs(none),
    }
    return _read_reports(spark, f"{out}/cross_country", alike)


def _read_reports(spark: SparkSession, folder: str, alike: dict[str, DataFrame]) -> DataFrame:
    """The reports below a folder; a header that does not name the columns expected is an error."""
    return _together(
        {
            name: spark.read.schema(df.schema).csv(
                f"{folder}/{name}", header=True, escape='"', enforceSchema=False
            )
            for name, df in alike.items()
        }
    )


def rejects_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested columns come back as JSON text."""
    path = scratch_path(spark, "rejects")
    units = org_units(spark, sf_dir)
    sinks.write_rejects(units.select("id", "level", "groups"), path, fmt="csv")
    return spark.read.schema("id string, level int, groups string").csv(
        path, header=True, escape='"'
    )


def loaded_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "fact")
    commits.publish_fact(fact(spark, sf_dir), path, replace="table")
    return incremental.loaded_partitions(spark, path)


def commit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live partitions after a whole load, a second load of half its months without zeros, and a third of one area."""
    path = scratch_path(spark, "fact")
    commits.publish_fact(fact(spark, sf_dir), path, replace="table")
    whole = incremental.read_fact(spark, path)  # files of this commit, which later ones leave as they are
    commits.publish_fact(whole.filter((F.col("month") > 6) & ~F.col("is_explicit_zero")), path)
    commits.publish_fact(whole.filter("health_area = 'A'").limit(0), path, ended=whole.filter("health_area = 'A'"))
    counted = incremental.read_fact(spark, path).groupBy("health_area", "year_month").agg(F.count("*").alias("n_read"))
    live = commits.live(spark, path).select("health_area", "year_month", "version", "rows")
    return live.join(counted, ["health_area", "year_month"], "left")


def incremental_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows stamped on every third day come in a second load, late and as corrections, for the same months."""
    return incremental.read_fact(spark, _corrected(spark, sf_dir, with_states=False))


_OF_VALUES = [
    *schemas.VALUE_KEY,
    *["value", "storedBy", "lastUpdated", "de_name", "value_type", "health_area", "coc_name", "is_orphaned_coc"],
]


def _corrected(spark: SparkSession, sf_dir: str, with_states: bool) -> str:
    """The path of a fact loaded in two steps; with its states computed in between."""
    path = scratch_path(spark, "fact")
    second = F.substring("lastUpdated", 9, 2).cast("int") % 3 == 0
    lookups = elements(spark, sf_dir), option_combos(spark, sf_dir), org_units(spark, sf_dir)
    values = resolve.resolve_keys(fixture.reports(spark, sf_dir), *lookups).rows
    # Both loads read them, so they are written, with what a fact takes from a value.
    values = written(values.select(*_OF_VALUES, *fixture.TIE_BREAK), "resolved")
    commits.publish_fact(fact(spark, sf_dir, values=values.filter(~second)), path, replace="table")
    if with_states:
        read_states(spark, path)
    late = written(fact(spark, sf_dir, values=values.filter(second)), "late")
    stored = incremental.read_fact(spark, path)
    merge = incremental.merge_late(stored, late, programs(spark, sf_dir), facilities(spark, sf_dir), path=path)
    commits.publish_fact(merge.rows, path, ended=merge.partitions, run=merge.run)
    return path


_states_of: dict[tuple[str, str], str] = {}


def _on_states(operator: Callable[..., DataFrame], **options) -> Query:
    """A report merged from states, part of them of the first load and part of the partitions that the second changed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _states_of:
            _states_of[key] = _corrected(spark, sf_dir, with_states=True)
        extra = {k: v(spark, sf_dir) if callable(v) else v for k, v in options.items()}
        return operator(read_states(spark, _states_of[key]), **extra)

    return query


def filter_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = fact(spark, sf_dir).filter(F.col("year_month") < CUTOFF).select("year_month")
    return incremental.filter_new(fixture.reports(spark, sf_dir), loaded.distinct()).select(
        *schemas.DATA_VALUE.names, *fixture.TIE_BREAK
    )


def filter_new_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookups = elements(spark, sf_dir), option_combos(spark, sf_dir), org_units(spark, sf_dir)
    values = resolve.resolve_keys(fixture.reports(spark, sf_dir), *lookups).rows
    loaded = fact(spark, sf_dir).filter(F.col("year_month") < CUTOFF)
    on = [("health_area", "health_area"), ("period", "year_month")]
    return incremental.filter_new(values, loaded, on=on).select(
        *fixture.TIE_BREAK, "dataElement", "period"
    )


def incremental_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early periods first, then everything again from another clerk: only the rest is loaded."""
    path = scratch_path(spark, "fact")
    _load_twice(spark, sf_dir, path)
    return incremental.read_fact(spark, path)


def incremental_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the second offer whose periods were loaded before, by period."""
    skipped = _load_twice(spark, sf_dir, scratch_path(spark, "fact"))
    return skipped.groupBy("period").agg(F.count("*").alias("skipped"))


def _load_twice(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    whole = written(fact(spark, sf_dir), "offered")
    commits.publish_fact(whole.filter(F.col("period") < CUTOFF), path)
    offered = whole.withColumn("stored_by", F.lit("second"))
    increment = incremental.load_incremental(spark, path, offered)
    if not increment.is_incremental:
        raise RuntimeError("the first load is not seen")
    commits.publish_fact(increment.values, path)
    return increment.skipped


def queries() -> dict[str, Query]:
    return {
        "ingest_documents": ingest_documents,
        "ingest_split_documents": ingest_split_documents,
        "ingest_split_nested": ingest_split_nested,
        "ingest_split_units": ingest_split_units,
        "ingest_file_documents": ingest_file_documents,
        "ingest_quarantine": ingest_quarantine,
        "ingest_lost_documents": ingest_lost_documents,
        "ingest_all_counts": ingest_all_counts,
        "exports_rows": exports_rows,
        "events_props_json": events_props_json,
        "metadata_lookup": metadata_lookup,
        "resolve_ok": resolve_ok,
        "resolve_rejects": resolve_rejects,
        "hierarchy_flat": flattened,
        "hierarchy_leaves_without_children": hierarchy_leaves_without_children,
        "hierarchy_enrich": hierarchy_enrich,
        "dedup_latest": dedup_latest,
        "cast_values": cast_values,
        "cast_values_odd_text": cast_values_odd_text,
        "dq_flags": dq_flags,
        "calendar": calendar,
        "dq_summary": dq_summary,
        "completeness": _scores(),
        "completeness_strict": _scores(strict=True),
        "completeness_dense": _scores(densify=True),
        "completeness_dense_stray": completeness_dense_stray,
        "silent_runs": silent_runs,
        "silent_runs_stray": silent_runs_stray,
        "dq_gate": dq_gate,
        "dim_element": dim_element,
        "dim_unit": dim_unit,
        "dim_period": dim_period,
        "dim_program": dim_program,
        "fact": fact,
        "fact_split_groups": fact_split_groups,
        "fact_null_periods": _fact_null_periods(HOT_ROWS),
        "fact_null_periods_split_groups": _fact_null_periods(FEW_ROWS_PER_PLACE),
        "mom_pct_change": _on_fact(trends.mom_pct_change),
        "mom_pct_change_gap_aware": _on_fact(trends.mom_pct_change, gap_aware=True),
        "rolling_avg_3m": _on_written_fact(trends.rolling_avg),
        "rolling_avg_split_groups": _on_written_fact(trends.rolling_avg, hot_rows=FEW_ROWS),
        "rolling_avg_calendar": _on_written_fact(trends.rolling_avg, by_calendar=True),
        "rolling_avg_calendar_split_groups": _on_written_fact(
            trends.rolling_avg, by_calendar=True, hot_rows=FEW_ROWS
        ),
        "rolling_avg_calendar_null_keys": _rolling_null_keys(None),
        "rolling_avg_calendar_null_keys_split_groups": _rolling_null_keys(FEW_ROWS),
        "reporting_rate": _rate(densify=False),
        "reporting_rate_dense": _rate(densify=True),
        "top_underreporting": _on_fact(trends.top_underreporting),
        "volumes_by_quarter": _on_fact(crosscut.volumes_by_quarter),
        "completeness_comparison": _on_fact(crosscut.completeness_comparison),
        "completeness_comparison_by_facility": _on_fact(
            crosscut.completeness_comparison, weight=crosscut.BY_FACILITY
        ),
        "coverage_matrix": coverage_matrix,
        "low_runs": _on_fact(crosscut.low_runs, threshold=0.36),
        "low_runs_gap_aware": _on_fact(crosscut.low_runs, threshold=0.33, gap_aware=True),
        "low_runs_by_facility": _on_fact(
            crosscut.low_runs, threshold=0.33, weight=crosscut.BY_FACILITY
        ),
        "contract_report": contract_report,
        "contract_report_in_write": contract_report_in_write,
        "sigma_anomalies_3": _on_written_fact(anomaly.sigma_anomalies),
        "sigma_anomalies_2_5": _on_written_fact(anomaly.sigma_anomalies, sigmas=2.5),
        "sigma_anomalies_excluding_current": _on_written_fact(
            anomaly.sigma_anomalies, include_current=False
        ),
        "sigma_anomalies_split_groups": _on_written_fact(
            anomaly.sigma_anomalies, sigmas=2.05, hot_rows=FEW_ROWS
        ),
        "fact_roundtrip": fact_roundtrip,
        "report_csv_roundtrip": report_csv_roundtrip,
        "dims_written": dims_written,
        "analytics_written": analytics_written,
        "aggregation_written": aggregation_written,
        "rejects_csv_roundtrip": rejects_csv_roundtrip,
        "loaded_partitions": loaded_partitions,
        "commit_log": commit_log,
        "incremental_corrections": incremental_corrections,
        "states_mom_pct_change": _on_states(states.mom_pct_change),
        "states_reporting_rate": _on_states(states.reporting_rate, facilities=facilities),
        "states_top_underreporting": _on_states(states.top_underreporting),
        "states_volumes_by_quarter": _on_states(states.volumes_by_quarter),
        "states_completeness_comparison": _on_states(states.completeness_comparison),
        "states_coverage_matrix": _on_states(states.coverage_matrix, countries=_countries),
        "states_low_runs": _on_states(states.low_runs, threshold=0.36),
        "filter_new": filter_new,
        "filter_new_by_area": filter_new_by_area,
        "incremental_union": incremental_union,
        "incremental_skipped": incremental_skipped,
    }
