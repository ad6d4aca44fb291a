"""Report states beside a committed fact, one set for each partition as a run wrote it.

``<fact>/_states/refresh=<id>/sums`` and ``units`` hold the states that one refresh computed.  After both are written,
one small file in ``<fact>/_states/_log`` names the partitions they are of.  A refresh that fails leaves folders
which the log does not name; a partition that is written anew has a new run, so its old state is passed over.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.sizing import sized
from tallymart.operators.states import States, states_of
from tallymart.schemas import FACT, FACT_PARTITIONS
from tallymart.sources.commits import found, live, read_runs

_KEY = [*FACT_PARTITIONS, "run"]

LOG = T.StructType(
    [*[FACT[name] for name in FACT_PARTITIONS], T.StructField("run", T.StringType()), T.StructField("refresh", T.StringType())]
)


def _known(spark: SparkSession, path: str) -> DataFrame:
    """``(health_area, year_month, run, refresh)`` of the states there are, one a partition and run."""
    entries = found(spark, f"{path}/_states/_log", LOG)
    if entries is None:
        entries = spark.createDataFrame([], LOG)
    return entries.groupBy(*_KEY).agg(F.max("refresh").alias("refresh"))


def _same(left: str, right: str):
    area, month = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in FACT_PARTITIONS]
    return area & month & (F.col(f"{left}.run") == F.col(f"{right}.run"))


def refresh_states(spark: SparkSession, path: str) -> int:
    """Compute the states of live partitions that have none, from the rows of these alone; how many they were.

    The driver gets the names of the partitions to be read.
    """
    path = path.rstrip("/")
    there, known = live(spark, path).select(*_KEY).alias("t"), _known(spark, path).alias("k")
    missing = there.join(known, _same("t", "k"), "left_anti").collect()
    if not missing:
        return 0
    refresh = uuid.uuid4().hex
    states = states_of(read_runs(spark, path, [tuple(r) for r in missing]), "run")
    for name, df in states._asdict().items():
        df.write.parquet(f"{path}/_states/refresh={refresh}/{name}")
    entries = spark.createDataFrame([(*r, refresh) for r in missing], LOG)
    entries.coalesce(1).write.mode("append").parquet(f"{path}/_states/_log")
    return len(missing)


def read_states(spark: SparkSession, path: str) -> States:
    """The states of all live partitions, after computing those that are missing.

    No file of the fact is read for partitions whose state is there.
    """
    path = path.rstrip("/")
    refresh_states(spark, path)
    there, known = live(spark, path).select(*_KEY).alias("t"), _known(spark, path).alias("k")
    wanted = known.join(there, _same("k", "t"), "left_semi")
    folders = sorted(r.refresh for r in wanted.select("refresh").distinct().collect())
    empty = states_of(spark.createDataFrame([], FACT).withColumn("run", F.lit("")), "run")
    if not folders:
        return States(*[df.drop("run") for df in empty])
    wanted = sized(wanted)

    def read(name: str, schema: T.StructType) -> DataFrame:
        files = [f"{path}/_states/refresh={folder}/{name}" for folder in folders]
        schema = T.StructType([*schema.fields, T.StructField("refresh", T.StringType())])
        rows = spark.read.schema(schema).option("basePath", f"{path}/_states").parquet(*files).alias("s")
        same = _same("s", "w") & (F.col("s.refresh") == F.col("w.refresh"))
        return rows.join(wanted.alias("w"), same, "left_semi").drop("run", "refresh")

    return States(*[read(name, df.schema) for name, df in empty._asdict().items()])
