"""Monthly periods held as ``yyyyMM`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how the exports write timestamps.
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def period_year(period: Column) -> Column:
    return period.substr(1, 4).try_cast("int")


def period_month(period: Column) -> Column:
    return period.substr(5, 2).try_cast("int")


def period_start(period: Column) -> Column:
    return F.try_to_date(period, "yyyyMM")


def period_end(period: Column) -> Column:
    return F.last_day(period_start(period))


def period_quarter(period: Column) -> Column:
    """``yyyyQn``"""
    number = F.ceil(period_month(period) / F.lit(3)).cast("string")
    return F.concat(period.substr(1, 4), F.lit("Q"), number)


def period_index(period: Column) -> Column:
    """Months as consecutive integers, so that ranges and gaps can be computed."""
    return period_year(period) * 12 + period_month(period) - 1


def period_of_index(index: Column) -> Column:
    """Inverse of :func:`period_index`."""
    year = F.floor(index / F.lit(12)).cast("int").cast("string")
    month = (F.pmod(index, F.lit(12)) + 1).cast("string")
    return F.concat(F.lpad(year, 4, "0"), F.lpad(month, 2, "0"))


def stamp_date(text: Column) -> Column:
    return F.to_date(F.try_to_timestamp(text, F.lit(STAMP_FORMAT)))
