"""Schemas of the export documents, the value rows and the mart tables.

Field names and types below are fixed values of the data model.  Everything is read with these
schemas; nothing is inferred.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T



_TEXT, _INT, _REAL, _FLAG = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _texts(*names: str) -> dict[str, T.DataType]:
    return {name: _TEXT for name in names}


NAMED = _struct(**_texts("id", "name"))

ELEMENT = _struct(
    **_texts("id", "name", "shortName", "code", "valueType", "domainType", "aggregationType"),
    zeroIsSignificant=_FLAG,
    categoryCombo=NAMED,
    dataElementGroups=T.ArrayType(NAMED),
    **_texts("created", "lastUpdated"),
)

OPTION_COMBO = _struct(**_texts("id", "name", "created", "lastUpdated"))

ORG_UNIT = _struct(
    **_texts("id", "name", "shortName", "code"),
    level=_INT,
    path=_TEXT,
    parent=NAMED,
    groups=T.ArrayType(NAMED),
    **_texts("created", "lastUpdated"),
)

PROGRAM = _struct(
    **_texts("id", "name", "shortName", "healthArea", "country", "reportingFrequency"),
    dataElements=T.ArrayType(_TEXT),
    **_texts("created", "lastUpdated"),
)

# All text: the raw value stays text until it is cast by its indicator's value type.
DATA_VALUE = _struct(
    **_texts("dataElement", "period", "orgUnit", "categoryOptionCombo", "attributeOptionCombo"),
    **_texts("value", "storedBy", "created", "lastUpdated", "followup"),
)

METADATA_DOCUMENT = _struct(
    **_texts("date", "version"),
    dataElements=T.ArrayType(ELEMENT),
    categoryOptionCombos=T.ArrayType(OPTION_COMBO),
)
ORG_UNIT_DOCUMENT = _struct(
    **_texts("date", "version"), organisationUnits=T.ArrayType(ORG_UNIT)
)
PROGRAM_DOCUMENT = _struct(**_texts("date", "version"), programs=T.ArrayType(PROGRAM))
DATA_VALUE_DOCUMENT = _struct(
    **_texts("responseType", "version", "exportDate"), dataValues=T.ArrayType(DATA_VALUE)
)

FACT = _struct(
    **_texts("de_uid", "ou_uid", "period", "program_id", "coc_uid", "coc_name", "de_name"),
    raw_value=_TEXT,
    numeric_value=_REAL,
    is_late_reported=_FLAG,
    is_explicit_zero=_FLAG,
    is_missing_value=_FLAG,
    is_orphaned_coc=_FLAG,
    completeness_score=_REAL,
    **_texts("stored_by", "last_updated", "health_area", "year_month"),
    year=_INT,
    month=_INT,
    **_texts("quarter", "country_name", "region_name", "district_name", "facility_name"),
)

FACT_PARTITIONS = ["health_area", "year_month"]
FACT_KEY = ["de_uid", "ou_uid", "period", "coc_uid"]
VALUE_KEY = ["dataElement", "period", "orgUnit", "categoryOptionCombo"]


def org_unit_dimension(labels: Sequence[str]) -> T.StructType:
    """Declared shape of the unit dimension for a tree whose levels above the leaves have ``labels``."""
    shape = T.StructType.fromDDL(
        "facility_uid string, facility_name string, facility_type string, facility_level int, path string"
    )
    for label in labels:
        shape = shape.add(f"{label}_uid", "string").add(f"{label}_name", "string")
    return shape
