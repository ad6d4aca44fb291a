"""Writers: rejects, the partitioned fact, dimensions and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.schemas import FACT_PARTITIONS

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def flat_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which is what CSV can hold."""
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_rejects(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Rejects as Parquet, or as CSV with header and nested columns as JSON text.

    An empty set is written too: it replaces what an earlier run left there.
    """
    if fmt == "csv":
        flat_text(df).write.mode("overwrite").csv(path, header=True, escape='"')
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def write_fact(
    fact: DataFrame,
    path: str,
    partitions: Sequence[str] = tuple(FACT_PARTITIONS),
    replace: str = "partitions",
) -> None:
    """Partitioned Parquet.

    ``replace="partitions"`` overwrites only the partitions that occur in ``fact``, so earlier
    loads stay; ``"table"`` overwrites all.  Rows are rebalanced by partition columns: small
    partitions come out as one file each, an oversized one is split over several tasks and files.
    """
    mode = {"partitions": "dynamic", "table": "static"}[replace]
    (
        fact.hint("rebalance", *[F.col(c) for c in partitions])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_dims(dims: Mapping[str, DataFrame], output_dir: str) -> None:
    for name, dim in dims.items():
        dim.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/{name}")


def write_report(
    df: DataFrame,
    path: str,
    order: Sequence[str | Column] = (),
    single_file: bool = False,
) -> None:
    """CSV with header.  ``single_file`` is for reports known to be small: one task writes them.

    ``order`` sorts the output: across files by range, or within the single file.
    """
    out = flat_text(df)
    if single_file:
        out = out.coalesce(1)
        out = out.sortWithinPartitions(*order) if order else out
    elif order:
        out = out.orderBy(*order)
    out.write.mode("overwrite").csv(path, header=True, escape='"')
