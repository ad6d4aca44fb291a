"""Keys that hold a large share of the rows: finding them, and joining around them.

AQE splits oversized partitions of a sort-merge join only where both sides come straight from an
exchange, which a lookup made unique by an aggregate does not.  So hot keys are taken apart here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.scratch import written
from tallymart.functions.sizing import BROADCAST_BYTES, measured_bytes

HOT_ROWS = 1_000_000
#: Hot keys up to which they, and a lookup row for each, are broadcast.
BROADCAST_KEYS = 100_000
#: Buckets that many-valued keys are counted in first, and the limit from which that pays.
BUCKETS, BUCKETS_FROM = 1 << 14, 100_000


class Hot(NamedTuple):
    """Keys with many rows: a written table with ``_hot_<key>`` columns, how many there are, and
    how many rows they have together."""

    keys: DataFrame
    count: int
    rows: int

    def hinted(self, df: DataFrame) -> DataFrame:
        """A table of at most one row for each hot key, with the join hint that its size allows."""
        return F.broadcast(df) if self.count <= BROADCAST_KEYS else df.hint("merge")


def _hot(key: str) -> str:
    return f"_hot_{key}"


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def hot_keys(
    df: DataFrame, keys: Sequence[str], limit: int | None = HOT_ROWS, most: int | None = None, many: bool = False
) -> Hot | None:
    """Keys with more than ``limit`` rows, or ``None`` if there are none.

    There are at most rows / limit of them; ``most`` keeps that many of the largest.  Counting is one pass over the
    key columns, reduced on the map side, whose result is written; ``limit=None`` skips it.  With ``many``, for keys
    which are nearly as many as the rows, buckets of keys are counted before: a key above the limit lies in such a
    bucket, so keys are shuffled only where there are any.
    """
    if limit is None:
        return None
    if many and limit >= BUCKETS_FROM:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
        full = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
        buckets = [r.b for r in full.collect()]
        if not buckets:
            return None
        df = df.filter(bucket.isin(buckets))
    counted = df.groupBy(*[F.col(k).alias(_hot(k)) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    found = written(counted.filter(F.col("n") > limit), "hot_keys")
    if most is not None and found.count() > most:
        found = written(found.orderBy(F.desc("n")).limit(most), "hot_keys")
    n, rows = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    return Hot(found.drop("n"), n, rows) if n else None


def split_hot(
    df: DataFrame, keys: Sequence[str], hot: Hot | None
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of the keys in ``hot`` or ``None``)."""
    if hot is None:
        return df, None
    same = _all([F.col(k).eqNullSafe(F.col(_hot(k))) for k in keys])
    known = hot.hinted(hot.keys)
    return df.join(known, same, "left_anti"), df.join(known, same, "left_semi")


def join_around(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str, str]],
    hot: Hot | None,
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join to a lookup unique on its columns, the rows of ``hot`` keys by broadcast.

    A hot key has one row in the lookup, so what is broadcast has no more rows than ``hot``.  A null
    key matches nothing, as a foreign key should; with ``null_safe=True`` it matches null, as the key
    of a group should that is joined back to its rows.
    """
    ours = [r for r, _ in on]

    def same(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)

    match = [same(r, theirs) for r, theirs in on]
    cold_rows, hot_rows = split_hot(rows, ours, hot)
    joined = cold_rows.join(lookup, match, how)
    if hot_rows is None:
        return joined
    wanted = _all([same(theirs, _hot(r)) for r, theirs in on])
    few = lookup.join(hot.hinted(hot.keys), wanted, "left_semi")
    return joined.unionByName(hot_rows.join(hot.hinted(few), match, how))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    n_bytes: int | None = None,
    bound: int | None = BROADCAST_BYTES,
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of many ``rows`` to a ``lookup`` that is unique on its columns of ``on``.

    A lookup measured (or known, by ``n_bytes``) to be within ``bound`` is broadcast.  A larger one
    is joined by sort-merge, around the hot keys of ``rows``, counted in ``counted`` if given: rows
    that include ``rows`` and are cheaper to scan.  ``bound=None`` leaves all to Spark.
    """
    match = [F.col(r) == F.col(theirs) for r, theirs in on]
    if bound is None:
        return rows.join(lookup, match, how)
    if n_bytes is None:
        n_bytes = measured_bytes(lookup)[0]
    if n_bytes <= bound:
        return rows.join(F.broadcast(lookup), match, how)
    hot = hot_keys(rows if counted is None else counted, [r for r, _ in on], hot_rows)
    return join_around(rows, lookup.hint("merge"), on, hot, how)
