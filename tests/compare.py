"""Run registered queries and their SQL on the same tables and compare them value by value.

    python tests/compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def differences(df, connection, sql: str) -> list[str]:
    """Empty if columns, types and the multiset of rows agree."""
    arrow = connection.execute(sql).to_arrow_table()
    columns = sorted(df.columns)
    if columns != sorted(arrow.column_names):
        return [f"columns {columns} against {sorted(arrow.column_names)}"]
    ours = df.select(*columns).toArrow()
    theirs = arrow.select(columns)
    found = [
        f"type of {a.name}: {a.type} against {b.type}"
        for a, b in zip(ours.schema, theirs.schema, strict=True)
        if a.type != b.type and not {str(a.type), str(b.type)} <= {"string", "large_string"}
    ]
    left = Counter(zip(*[c.to_pylist() for c in ours.columns], strict=True))
    right = Counter(zip(*[c.to_pylist() for c in theirs.columns], strict=True))
    if left != right:
        found.append(f"rows {left.total()} against {right.total()}")
        found += [f"only ours   {r}" for r, _ in zip((left - right), range(3))]
        found += [f"only theirs {r}" for r, _ in zip((right - left), range(3))]
    return found


def main(sf_dir: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(sf_dir)
    sql = spark_entry.oracle_sql()
    bad = 0
    for name, query in spark_entry.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            found = differences(df, connection, sql[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - started:.1f}s", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
