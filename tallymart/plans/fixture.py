"""An indicator mart's inputs derived from the test tables.

Brands stand for indicators, suppliers for facilities below nations and regions, line items for
reported values.  The defects the operators handle (unknown keys, missing and zero values, late
reports, copies) follow from fixed rules on the keys.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart import schemas
from tallymart.functions.periods import STAMP_FORMAT

STAMP = "2024-01-01T00:00:00.000"
AREAS = ["A", "B", "C", "D", "E"]

# Order among copies of equal stamp.
TIE_BREAK = ["ok", "ln", "px"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tie_break() -> list[Column]:
    return [F.col(c).desc() for c in TIE_BREAK]


def _stamp(day: Column) -> Column:
    return F.date_format(day, STAMP_FORMAT)


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data values, one per line item, with the columns that order copies."""
    items = table(spark, sf_dir, "lineitem").withColumn("_day", F.col("l_shipdate").cast("date"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    whole = F.col("l_quantity").cast("int").cast("string")
    value = (
        F.when(F.col("l_linenumber") == 7, None)
        .when(F.col("l_discount") < 0.005, F.lit("0"))
        .when(F.col("p_size") % 10 == 9, F.concat(whole, F.lit(".5")))
        .otherwise(whole)
    )
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("dataElement"),
        F.date_format("_day", "yyyyMM").alias("period"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("orgUnit"),
        F.concat("l_returnflag", "l_linestatus").alias("categoryOptionCombo"),
        F.lit("default").alias("attributeOptionCombo"),
        value.alias("value"),
        F.concat(F.lit("clerk"), (F.col("l_orderkey") % 11).cast("string")).alias("storedBy"),
        _stamp(F.col("_day")).alias("created"),
        _stamp(F.date_add("_day", (F.col("l_orderkey") % 120).cast("int"))).alias("lastUpdated"),
        F.lit("false").alias("followup"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_extendedprice").alias("px"),
    )


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int")
    return (
        table(spark, sf_dir, "part")
        .select("p_brand")
        .distinct()
        .withColumn("_n", number)
        .withColumn("_area", F.chr(F.lit(65) + F.col("_n") % 5))
    )


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators; ``Brand#25`` is left out, so its rows are ghosts."""
    n = F.col("_n")
    kinds = F.array(*[F.lit(k) for k in ("INTEGER", "NUMBER", "PERCENTAGE", "INTEGER_POSITIVE")])
    combo = (n % 3).cast("string")
    return (
        _brands(spark, sf_dir)
        .filter(F.col("p_brand") != "Brand#25")
        .select(
            F.col("p_brand").alias("id"),
            F.concat(F.lit("Indicator "), "p_brand").alias("name"),
            F.col("p_brand").alias("shortName"),
            F.concat(F.lit("C"), n.cast("string")).alias("code"),
            F.get(kinds, n % 4).alias("valueType"),
            F.lit("AGGREGATE").alias("domainType"),
            F.lit("SUM").alias("aggregationType"),
            (n % 2 == 0).alias("zeroIsSignificant"),
            F.struct(
                F.concat(F.lit("CC"), combo).alias("id"),
                F.concat(F.lit("Combo "), combo).alias("name"),
            ).alias("categoryCombo"),
            F.array(
                F.struct(F.concat(F.lit("G"), "_area").alias("id"), F.col("_area").alias("name"))
            ).alias("dataElementGroups"),
            F.lit(STAMP).alias("created"),
            F.lit(STAMP).alias("lastUpdated"),
        )
    )


def option_combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag and status of the line items; ``RO`` is left out, so its rows are orphans."""
    code = F.concat("l_returnflag", "l_linestatus")
    return (
        table(spark, sf_dir, "lineitem")
        .select(code.alias("id"))
        .distinct()
        .filter(F.col("id") != "RO")
        .select(
            "id",
            F.concat(F.lit("combo "), "id").alias("name"),
            F.lit(STAMP).alias("created"),
            F.lit(STAMP).alias("lastUpdated"),
        )
    )


def org_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region, half of a region, nation, supplier; some suppliers are left out, as ghosts."""

    def key(prefix: str, column: str) -> Column:
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    region = key("R", "r_regionkey")
    half_no = (F.col("n_nationkey") % 2).cast("string")
    half = F.concat(region, F.lit("G"), half_no)
    nation, supplier = key("N", "n_nationkey"), key("S", "s_suppkey")
    regions = table(spark, sf_dir, "region")
    nations = table(spark, sf_dir, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    suppliers = (
        table(spark, sf_dir, "supplier")
        .filter(F.col("s_suppkey") % 25 != 7)
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )

    def units(
        rows: DataFrame, level: int, name: Column, steps: list[Column], groups: Column
    ) -> DataFrame:
        parent = (
            F.struct(steps[-2].alias("id"), F.lit(None).cast("string").alias("name"))
            if level > 1
            else F.lit(None).cast(schemas.NAMED)
        )
        path = F.concat(*[part for s in steps for part in (F.lit("/"), s)])
        return rows.select(
            steps[-1].alias("id"),
            name.alias("name"),
            name.alias("shortName"),
            steps[-1].alias("code"),
            F.lit(level).alias("level"),
            path.alias("path"),
            parent.alias("parent"),
            groups.alias("groups"),
            F.lit(STAMP).alias("created"),
            F.lit(STAMP).alias("lastUpdated"),
        )

    def group(uid: Column, name: Column) -> Column:
        return F.struct(uid.alias("id"), name.alias("name"))

    kind = (F.col("s_suppkey") % 3).cast("string")
    facility = group(F.lit("L4"), F.lit("Facility"))
    typed = group(F.concat(F.lit("T"), kind), F.concat(F.lit("Type "), kind))
    return (
        units(
            regions,
            1,
            F.col("r_name"),
            [region],
            F.array(group(F.lit("L1"), F.lit("Country"))),
        )
        .unionByName(
            units(
                nations,
                2,
                F.concat("r_name", F.lit(" half "), half_no),
                [region, half],
                F.array(group(F.lit("L2"), F.lit("Region"))),
            ).distinct()
        )
        .unionByName(
            units(
                nations,
                3,
                F.col("n_name"),
                [region, half, nation],
                F.array(group(F.lit("L3"), F.lit("District"))),
            )
        )
        .unionByName(
            units(
                suppliers,
                4,
                F.col("s_name"),
                [region, half, nation, supplier],
                F.when(F.col("s_suppkey") % 5 == 0, F.array(facility)).otherwise(
                    F.array(facility, typed)
                ),
            )
        )
    )


def programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programmes by region and area, for two out of three of these; their indicators are the
    brands of the area."""
    by_area = (
        _brands(spark, sf_dir)
        .groupBy("_area")
        .agg(F.sort_array(F.collect_list("p_brand")).alias("dataElements"))
    )
    region_id = F.concat(F.lit("R"), F.col("r_regionkey").cast("string"))
    return (
        table(spark, sf_dir, "region")
        .withColumn("_rid", region_id)
        .withColumn("_area", F.explode(F.array(*[F.lit(a) for a in AREAS])))
        .filter((F.ascii(F.col("_rid").substr(2, 1)) + F.ascii("_area")) % 3 != 0)
        .join(by_area, "_area")
        .select(
            F.concat("_rid", "_area").alias("id"),
            F.concat(F.lit("Programme "), "_area").alias("name"),
            F.col("_area").alias("shortName"),
            F.col("_area").alias("healthArea"),
            F.col("r_name").alias("country"),
            F.lit("Monthly").alias("reportingFrequency"),
            "dataElements",
            F.lit(STAMP).alias("created"),
            F.lit(STAMP).alias("lastUpdated"),
        )
    )


def packed_documents(
    rows: DataFrame, head: dict[str, str], array: str, per_document: int = 1000
) -> DataFrame:
    """Rows as JSON documents of at most ``per_document`` rows each, one document per line.

    Rows become JSON in the JVM; a task strings those it has together, batch by batch.  Nothing is
    shuffled, so no document grows with the data or a frequent key, and a task can be repeated.
    """
    lead = json.dumps(head).removesuffix("}") + f', "{array}": ['

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [*range(0, batch.num_rows, per_document), batch.num_rows]
            items = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), batch.column(0))
            texts = pc.binary_join_element_wise(lead, pc.binary_join(items, ", "), "]}", "")
            yield pa.RecordBatch.from_arrays([texts], ["value"])

    items = rows.select(F.to_json(F.struct(*rows.columns)).alias("item"))
    return items.mapInArrow(pack, "value string")


def write_exports(
    spark: SparkSession, sf_dir: str, out: str, values: DataFrame | None = None
) -> None:
    """The four export documents of the fixture under ``out``, with one document per line."""
    if values is None:
        values = reports(spark, sf_dir)
    head = {"date": STAMP, "version": "1"}
    whole = 100_000
    metadata = packed_documents(
        elements(spark, sf_dir), head, "dataElements", whole
    ).unionByName(
        packed_documents(
            option_combos(spark, sf_dir), head, "categoryOptionCombos", whole
        )
    )
    # A metadata document has both arrays; an array it lacks is written empty.
    text = F.col("value")
    filled = F.when(
        text.contains('"categoryOptionCombos":'),
        F.regexp_replace(text, r"\}$", ',"dataElements":[]}'),
    ).otherwise(F.regexp_replace(text, r"\}$", ',"categoryOptionCombos":[]}'))
    documents = {
        "metadata.json": metadata.select(filled.alias("value")),
        "org_units.json": packed_documents(
            org_units(spark, sf_dir), head, "organisationUnits", whole
        ),
        "programs.json": packed_documents(programs(spark, sf_dir), head, "programs", whole),
        "data_values.json": packed_documents(
            values.select(*schemas.DATA_VALUE.names),
            {"responseType": "DataValueSet", "version": "1", "exportDate": STAMP},
            "dataValues",
        ),
    }
    for name, df in documents.items():
        df.write.mode("overwrite").text(f"{out}/{name}")
