"""A partitioned fact behind a log of commits.

Every commit writes its rows to a folder of its own, ``<path>/_data/run=<id>``, and then appends one small file to
``<path>/_log``: the partitions it has written, with their rows and files, and those it has ended.  That file
appears at once or not at all, and it is what readers follow.  So a reader sees the table before a commit or after
it, a run that fails leaves the table as it was, and which partitions there are is read from the log alone.

The state is the last entry of each partition.  Data files are never changed; those of replaced partitions stay
until ``<path>/_data`` is cleared of runs that :func:`live` no longer names.  One writer at a time: of two that overlap
each partition keeps the entry with the higher version, then run.  An entry of version ``UNUSED`` is of a partition that
a run has written but that came out as it was: it is older than any other, so what was there stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.scratch import written
from tallymart.schemas import FACT, FACT_PARTITIONS
from tallymart.sources.sinks import write_fact

ADDED, ENDED = "added", "ended"
UNUSED = 0

LOG = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("run", T.StringType()),
        T.StructField("action", T.StringType()),
        *[FACT[name] for name in FACT_PARTITIONS],
        T.StructField("rows", T.LongType()),
        T.StructField("files", T.LongType()),
    ]
)


def found(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def log(spark: SparkSession, path: str) -> DataFrame | None:
    """All entries, or ``None`` where there is no log."""
    return found(spark, f"{path.rstrip('/')}/_log", LOG)


def _last(entries: DataFrame) -> DataFrame:
    newest = F.max(F.struct("version", "run", "action", "rows", "files")).alias("last")
    return entries.groupBy(*FACT_PARTITIONS).agg(newest).select(*FACT_PARTITIONS, "last.*")


def live(spark: SparkSession, path: str) -> DataFrame:
    """``(health_area, year_month, version, run, action, rows, files)`` of the partitions there are."""
    entries = log(spark, path)
    if entries is None:
        return spark.createDataFrame([], LOG)
    return _last(entries).filter(F.col("action") == ADDED)


def _key(*columns: str) -> Column:
    return F.concat_ws("\u0001", *[F.coalesce(F.col(c), F.lit("\u0000")) for c in columns])


def read_committed(spark: SparkSession, path: str) -> DataFrame | None:
    """The fact as of the last commit, or ``None`` where there is no log.

    One scan of the live runs' folders.  Partitions that were replaced are left out by a condition on the
    partition columns, so their files are not opened.  The driver gets the log's entries of live runs.
    """
    entries = log(spark, path)
    if entries is None:
        return None
    last = _last(entries).select(*FACT_PARTITIONS, F.col("version").alias("_version"), F.col("run").alias("_run"), F.col("action").alias("_action"))
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"l.{c}")) for c in FACT_PARTITIONS]
    state = entries.filter(F.col("action") == ADDED).alias("e").join(last.alias("l"), same[0] & same[1])
    current = (F.col("_run") == F.col("run")) & (F.col("_version") == F.col("version")) & (F.col("_action") == ADDED)
    state = state.select("run", _key("run", *[f"e.{c}" for c in FACT_PARTITIONS]).alias("key"), current.alias("current"))
    rows = state.collect()
    runs = sorted({r.run for r in rows if r.current})
    if not runs:
        return spark.createDataFrame([], FACT)
    dead = sorted({r.key for r in rows if r.run in set(runs)} - {r.key for r in rows if r.current})
    data = f"{path.rstrip('/')}/_data"
    schema = T.StructType([*FACT.fields, T.StructField("run", T.StringType())])
    fact = spark.read.schema(schema).option("basePath", data).parquet(*[f"{data}/run={run}" for run in runs])
    if dead:
        fact = fact.filter(~_key("run", *FACT_PARTITIONS).isin(dead))
    return fact.select(*FACT.names)


def read_runs(spark: SparkSession, path: str, partitions: Sequence[tuple[str | None, str | None, str]]) -> DataFrame:
    """Rows, with their ``run``, of these ``(health_area, year_month, run)`` alone; no other files are opened."""
    data = f"{path.rstrip('/')}/_data"
    schema = T.StructType([*FACT.fields, T.StructField("run", T.StringType())])
    runs = sorted({run for *_, run in partitions})
    rows = spark.read.schema(schema).option("basePath", data).parquet(*[f"{data}/run={run}" for run in runs])
    keys = sorted("\u0001".join([run, *["\u0000" if c is None else c for c in names]]) for *names, run in partitions)
    return rows.filter(_key("run", *FACT_PARTITIONS).isin(keys))


def stage_fact(fact: DataFrame, path: str) -> str:
    """Write ``fact`` as a run of its own, which readers do not see before it is published; the name of the run."""
    run = uuid.uuid4().hex
    write_fact(fact, _folder(path, run), replace="table")
    return run


def read_staged(spark: SparkSession, path: str, run: str) -> DataFrame:
    """All rows of a run, published or not."""
    return spark.read.schema(FACT).parquet(_folder(path, run)).select(*FACT.names)


def _folder(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/_data/run={run}"


def publish_fact(
    fact: DataFrame, path: str, replace: str = "partitions", ended: DataFrame | None = None, run: str | None = None
) -> int:
    """Write ``fact`` and switch readers over to it; the number of the commit.

    ``replace="partitions"`` replaces the partitions that occur in ``fact``, and ends those of ``ended`` that do not;
    ``"table"`` ends all others.  Rows and files are counted from the files just written.  With ``run``, the name of a
    staged one, nothing is written: ``fact`` are its rows of the partitions of ``ended``, and its others are not used.
    """
    if replace not in ("partitions", "table"):
        raise ValueError("replace must be 'partitions' or 'table'")
    if run is not None and (replace == "table" or ended is None):
        raise ValueError("of a staged run the partitions in ended are replaced")
    spark, path = fact.sparkSession, path.rstrip("/")
    staged = run is not None
    run = run or stage_fact(fact, path)
    folder = _folder(path, run)
    there = live(spark, path)
    version = (log(spark, path).agg(F.max("version")).first()[0] or 0) + 1 if log(spark, path) is not None else 1
    each = spark.read.schema(FACT).parquet(folder).groupBy(*FACT_PARTITIONS, F.col("_metadata.file_path").alias("file"))
    counted = each.agg(F.count("*").alias("n")).groupBy(*FACT_PARTITIONS).agg(F.sum("n").alias("rows"), F.count("*").alias("files"))
    # Written, since the entries and what they end both ask for it.
    counts = written(counted, "counts")
    entries = counts.withColumns({"action": F.lit(ADDED), "version": F.lit(version).cast("long")})
    if staged:
        used = ended.select(*[F.col(c).alias(f"_{c}") for c in FACT_PARTITIONS], F.lit(True).alias("_used")).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FACT_PARTITIONS]
        entries = entries.join(used, same[0] & same[1], "left").withColumn(
            "version", F.when(F.col("_used"), F.col("version")).otherwise(F.lit(UNUSED).cast("long"))
        ).select(*entries.columns)
    gone = there if replace == "table" else ended
    if gone is not None:
        new = counts.select(*[F.col(c).alias(f"_{c}") for c in FACT_PARTITIONS])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FACT_PARTITIONS]
        gone = gone.select(*FACT_PARTITIONS).distinct().join(new, same[0] & same[1], "left_anti")
        zero = F.lit(0).cast("long")
        ends = {"rows": zero, "files": zero, "action": F.lit(ENDED), "version": F.lit(version).cast("long")}
        entries = entries.unionByName(gone.withColumns(ends))
    entries = entries.select("version", F.lit(run).alias("run"), "action", *FACT_PARTITIONS, "rows", "files")
    # One file, a row per partition: its rename into the folder is the switch.
    entries.coalesce(1).write.mode("append").parquet(f"{path}/_log")
    return version
