"""Which periods the fact already holds, and loading only the others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.scratch import written
from tallymart.functions.sizing import BROADCAST_BYTES, sized
from tallymart.functions.skew import HOT_ROWS, lookup_join
from tallymart.operators.quality import settled
from tallymart.schemas import FACT, FACT_PARTITIONS
from tallymart.sources.commits import live, log, read_committed, read_staged, stage_fact


_PARTITIONS = T.StructType([FACT[name] for name in FACT_PARTITIONS])


class Increment(NamedTuple):
    values: DataFrame
    is_incremental: bool
    skipped: DataFrame  # rows of periods that were loaded before; they are not loaded again


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact with its declared schema, so that ``year_month`` stays text.

    Where ``publish_fact`` has written it, the rows of the last commit.  A path that does not exist reads as an
    empty fact.
    """
    committed = read_committed(spark, path)
    if committed is not None:
        return committed
    try:
        return spark.read.schema(FACT).parquet(path).select(*FACT.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FACT)


def loaded_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (health_area, year_month) in the fact, from its log of commits.

    A fact written without a log is told by the names of its files, which all come to the driver.
    """
    if log(spark, path) is not None:
        return live(spark, path).select(*FACT_PARTITIONS)
    found = set()
    for name in read_fact(spark, path).inputFiles():
        steps = dict(step.split("=", 1) for step in name.split("/") if "=" in step)
        found.add(tuple(_named(steps[column]) for column in FACT_PARTITIONS))
    return spark.createDataFrame(sorted(found, key=str), _PARTITIONS)


def _named(step: str) -> str | None:
    # A file name is escaped twice: once as a partition value, once as a URI.
    value = unquote(unquote(step))
    return None if value == "__HIVE_DEFAULT_PARTITION__" else value


def filter_new(
    values: DataFrame,
    loaded: DataFrame,
    on: Sequence[tuple[str, str]] = (("period", "year_month"),),
    broadcast_bytes: int | None = BROADCAST_BYTES,
) -> DataFrame:
    """Rows not covered by the loaded partitions; all rows if there are none.

    A period counts as loaded when any health area has it.  To go by area and period, pass
    ``on=[("health_area", "health_area"), ("period", "year_month")]`` and values with an area.
    """
    keys = loaded.select(*[F.col(theirs).alias(f"_loaded_{theirs}") for _, theirs in on]).distinct()
    # Written, since it is measured and joined: ``loaded`` may be dear.
    keys = written(keys, "loaded")
    pairs = [(ours, f"_loaded_{theirs}") for ours, theirs in on]
    return lookup_join(values, keys, pairs, "left_anti", bound=broadcast_bytes)


def load_incremental(
    spark: SparkSession,
    fact_path: str,
    values: DataFrame,
    broadcast_bytes: int | None = BROADCAST_BYTES,
) -> Increment:
    """Values of periods not yet in the fact, whether there was anything before, and the other rows.

    Write the result with ``publish_fact(..., replace="partitions")``: the default replaces only
    the partitions written, so what was loaded earlier stays.  The other rows may be late ones and corrections:
    :func:`merge_late` puts them to the stored ones.  What counts as loaded is written down here, so both sets stay
    as they are once the increment is in the fact.
    """
    loaded = written(loaded_partitions(spark, fact_path), "loaded")
    if loaded.isEmpty():
        return Increment(values, False, values.limit(0))
    periods = loaded.select(F.col("year_month").alias("_loaded_year_month")).distinct()
    on = [("period", "_loaded_year_month")]
    skipped = lookup_join(values, periods, on, "left_semi", bound=broadcast_bytes)
    return Increment(filter_new(values, loaded, broadcast_bytes=broadcast_bytes), True, skipped)


class Merge(NamedTuple):
    rows: DataFrame  # the changed partitions, whole
    partitions: DataFrame  # their names; one without rows has lost them all
    run: str | None = None  # where the rows are staged, to be published as they are


_SUMS = ["a", "b", "c", "d"]


def _signatures(fact: DataFrame) -> DataFrame:
    """Per partition what tells two sets of rows apart: their number and sums of the parts of two hashes.

    Parts of 32 bits, so that sums are whole numbers that hold the rows of a partition, not decimals.
    """
    first, second = F.xxhash64(*FACT.names), F.xxhash64(F.lit(1), *FACT.names)
    hashed = fact.select(*FACT_PARTITIONS, first.alias("a"), second.alias("b"))
    parts = [f(F.col(c)) for c in ("a", "b") for f in (lambda h: F.shiftright(h, 32), lambda h: h.bitwiseAND(0xFFFFFFFF))]
    sums = [F.sum(part).alias(name) for name, part in zip(_SUMS, parts)]
    return hashed.groupBy(*FACT_PARTITIONS).agg(F.count("*").alias("n"), *sums)


def merge_late(
    stored: DataFrame,
    late: DataFrame,
    programs: DataFrame,
    facilities: DataFrame,
    tie_break: Sequence[Column] = (),
    strict: bool = False,
    hot_rows: int | None = HOT_ROWS,
    path: str | None = None,
) -> Merge:
    """What rows for months already loaded make of the stored fact: as if all had been loaded at once.

    Of the months that occur in ``late`` all stored rows are read, no others.  Per natural key the latest stamp wins,
    be it the stored one; equal stamps go by ``tie_break``, columns of the fact, and then the stored row stays.
    Scores of units and periods are taken anew, since they count all rows.  Partitions that come out as they
    were are left out, so their files stay.  One with a late row, a new score or another number of rows has changed; only
    where there is none of these are all columns of the rows before and after held against each other.

    With the ``path`` of the fact that ``stored`` was read from, the merged months are written once, as a run that
    ``publish_fact(merge.rows, path, ended=merge.partitions, run=merge.run)`` then publishes without another copy of them;
    files of partitions that have not changed stay in it unused.  Names of partitions come to the driver.
    """
    months = [r.year_month for r in late.select("year_month").distinct().collect()]  # a name a month
    wanted = F.col("year_month").isin([m for m in months if m is not None])
    old = stored.filter(wanted | F.col("year_month").isNull() if None in months else wanted)
    both = old.withColumn("_late", F.lit(0)).unionByName(late.select(*FACT.names).withColumn("_late", F.lit(1)))
    order = [F.desc_nulls_last("last_updated"), *tie_break, F.asc("_late")]
    names = {"ou_uid": "orgUnit", "de_uid": "dataElement", "coc_uid": "categoryOptionCombo", "raw_value": "value"}
    # Copies and scores meet by unit and period, in one shuffle of these rows.
    values = both.withColumnsRenamed({**names, "completeness_score": "_score"})
    rows = settled(
        values.withColumns({c: F.col(n) for c, n in names.items()}), programs, facilities, order, strict=strict, hot_rows=hot_rows
    )
    rows = rows.drop(*names).withColumnsRenamed({new: name for name, new in names.items()})
    # A late row that stays differs from all stored ones of its key, since of equal rows the stored one stays.
    moved = (F.col("_late") == 1) | ~F.col("completeness_score").eqNullSafe(F.col("_score"))
    marked = rows.select(*FACT.names, moved.alias("_moved"))
    run = None
    if path is None:
        marked = written(marked, "merged")
        merged = marked.select(*FACT.names)
        counted = marked.groupBy(*FACT_PARTITIONS).agg(F.count("*").alias("n"), F.bool_or("_moved").alias("moved"))
    else:
        seen, place = Observation(), F.struct(*FACT_PARTITIONS)
        run = stage_fact(marked.observe(seen, F.collect_set(F.when(F.col("_moved"), place)).alias("moved")).drop("_moved"), path)
        merged = read_staged(stored.sparkSession, path, run)
        names = stored.sparkSession.createDataFrame([tuple(r) for r in seen.get["moved"] or []], _PARTITIONS)
        names = names.select(*[F.col(c).alias(f"_{c}") for c in FACT_PARTITIONS], F.lit(True).alias("moved"))
        counted = merged.groupBy(*FACT_PARTITIONS).agg(F.count("*").alias("n")).join(names, _same_partition(), "left")
        counted = counted.select(*FACT_PARTITIONS, "n", F.coalesce("moved", F.lit(False)).alias("moved"))
    counts = old.groupBy(*FACT_PARTITIONS).agg(F.count("*").alias("n"))
    told = written(_compared(counted, counts, F.coalesce("moved", F.lit(True)) | ~F.col("n").eqNullSafe(F.col("_n"))), "told")
    alike = told.filter(~F.col("differs")).select(*FACT_PARTITIONS)
    changed = told.filter("differs").select(*FACT_PARTITIONS)
    if not alike.isEmpty():
        sums = [_signatures(_of_partitions(df, alike)) for df in (merged, old)]
        differs = ~reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("n", *_SUMS)])
        changed = changed.unionByName(_compared(*sums, differs).filter("differs").select(*FACT_PARTITIONS))
        changed = written(changed, "changed")
    return Merge(_of_partitions(merged, changed), changed, run)


def _same_partition() -> Column:
    """Columns of a partition against those of another table, which begin with ``_``."""
    area, month = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FACT_PARTITIONS]
    return area & month


def _compared(after: DataFrame, before: DataFrame, differs: Column) -> DataFrame:
    """``(health_area, year_month, differs)`` of the partitions of either table; columns of ``before`` begin with ``_``."""
    before = before.withColumnsRenamed({c: f"_{c}" for c in before.columns})
    either = [F.when(F.col("n").isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in FACT_PARTITIONS]
    return after.join(before, _same_partition(), "full").select(*either, differs.alias("differs"))


def _of_partitions(rows: DataFrame, partitions: DataFrame) -> DataFrame:
    """Rows of the partitions of a written table."""
    few = sized(partitions.select(*[F.col(c).alias(f"_{c}") for c in FACT_PARTITIONS]))
    return rows.join(few, _same_partition(), "left_semi")
