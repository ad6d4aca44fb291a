"""Text to number under ANSI mode: what does not parse becomes null, it never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The value types that carry numbers.
WHOLE_TYPES = ["INTEGER_ZERO_OR_POSITIVE", "INTEGER", "INTEGER_POSITIVE"]
REAL_TYPES = ["NUMBER", "PERCENTAGE"]
TRUTH_TYPE = "BOOLEAN"

# Digits with an optional fraction, which is cut off: "12.5" is 12, "12abc" is null.
_WHOLE = r"^[\s\x00]*([+-]?[0-9]+)(?:[.][0-9]*)?[\s\x00]*$"
_REAL = r"^[\s\x00]*[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?[\s\x00]*$"
_FRACTION_ONLY = r"^[\s\x00]*[+-]?[.][0-9]+[\s\x00]*$"


def whole_number(text: Column) -> Column:
    """bigint from text, truncating a decimal fraction; null if not a number or out of range."""
    return F.when(text.rlike(_FRACTION_ONLY), F.lit(0).cast("bigint")).otherwise(
        F.regexp_extract(text, _WHOLE, 1).try_cast("bigint")
    )


def real_number(text: Column) -> Column:
    """double from decimal text; null for words such as NaN and Infinity, and for type suffixes."""
    return F.when(text.rlike(_REAL), text.try_cast("double"))


def truth_number(text: Column) -> Column:
    """1.0 for true and 0.0 for false in any letter case, else null."""
    word = F.lower(text)
    return F.when(word == "true", F.lit(1.0)).when(word == "false", F.lit(0.0))


def typed_number(text: Column, value_type: Column) -> Column:
    """double chosen per row by ``value_type``; types without a numeric reading give null."""
    return (
        F.when(value_type.isin(WHOLE_TYPES), whole_number(text).cast("double"))
        .when(value_type.isin(REAL_TYPES), real_number(text))
        .when(value_type == TRUTH_TYPE, truth_number(text))
    )
