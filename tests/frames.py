"""Small frames shared by the tests."""

from pyspark.sql import functions as F

from tallymart import schemas

FACT_ROW = {
    "de_uid": "ABC1234567X",
    "ou_uid": "DEF1234567Y",
    "period": "202401",
    "program_id": "PROG001",
    "coc_uid": "COC001",
    "coc_name": "default",
    "de_name": "Cases",
    "raw_value": "42",
    "numeric_value": 42.0,
    "is_late_reported": False,
    "is_explicit_zero": False,
    "is_missing_value": False,
    "is_orphaned_coc": False,
    "completeness_score": 0.85,
    "stored_by": "reporter1",
    "last_updated": "2024-02-10T10:00:00.000",
    "health_area": "Malaria",
    "year_month": "202401",
    "year": 2024,
    "month": 1,
    "quarter": "2024Q1",
    "country_name": "Kenya",
    "region_name": "Nairobi Region",
    "district_name": "Westlands District",
    "facility_name": "City Health Centre",
}


def fact(spark, *changes):
    """A fact frame with one row per change of the valid row."""
    rows = []
    for change in changes:
        row = {**FACT_ROW, **change}
        if "period" in change and row["period"]:
            p = row["period"]
            row.setdefault("year_month", p)
            row = {
                **row,
                "year_month": p,
                "year": int(p[:4]),
                "month": int(p[4:]),
                "quarter": f"{p[:4]}Q{(int(p[4:]) + 2) // 3}",
                **{k: v for k, v in change.items() if k in ("year", "month", "quarter")},
            }
        rows.append(tuple(row[name] for name in schemas.FACT.names))
    return spark.createDataFrame(rows, schemas.FACT)


def elements(spark, *rows):
    """(id, name, valueType, area)"""
    frame = spark.createDataFrame(rows, "id string, name string, valueType string, area string")
    return frame.select(
        "id",
        "name",
        F.col("name").alias("shortName"),
        F.col("id").alias("code"),
        "valueType",
        F.lit("AGGREGATE").alias("domainType"),
        F.lit("SUM").alias("aggregationType"),
        F.lit(True).alias("zeroIsSignificant"),
        F.struct(F.lit("cc").alias("id"), F.lit("Combo").alias("name")).alias("categoryCombo"),
        F.when(
            F.col("area").isNotNull(),
            F.array(F.struct(F.lit("g").alias("id"), F.col("area").alias("name"))),
        )
        .otherwise(F.array().cast(schemas.ELEMENT["dataElementGroups"].dataType))
        .alias("dataElementGroups"),
        F.lit("x").alias("created"),
        F.lit("x").alias("lastUpdated"),
    )


def combos(spark, *ids):
    return spark.createDataFrame([(i, f"combo {i}") for i in ids], "id string, name string")


def units(spark, *rows):
    """(id, name, path, group names); level and parent follow from the path"""
    full = []
    for uid, name, path, groups in rows:
        steps = path.strip("/").split("/")
        parent = (steps[-2], None) if len(steps) > 1 else None
        full.append(
            (uid, name, name, uid, len(steps), path, parent, [("g", g) for g in groups], "x", "x")
        )
    return spark.createDataFrame(full, schemas.ORG_UNIT)


def programs(spark, *rows):
    """(id, area, country, elements)"""
    return spark.createDataFrame(
        [(i, f"P {i}", i, area, country, "Monthly", items, "x", "x") for i, area, country, items in rows],
        schemas.PROGRAM,
    )


def values(spark, *rows):
    """(element, period, unit, combo, value, lastUpdated)"""
    return spark.createDataFrame(
        [(e, p, u, c, "default", v, "me", "x", t, "false") for e, p, u, c, v, t in rows],
        schemas.DATA_VALUE,
    )


def rows(df, *columns):
    frame = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in frame.collect()], key=repr)
