"""Queries over tables of a test's own."""

import datetime

import pytest

import frames
from tallymart.plans import catalogue


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = {
        "region": ([(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "KENYA", 0), (1, "INDIA", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(i, f"S{i}", i % 2) for i in range(9)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(i, f"Brand#{20 + i}", i) for i in range(12)], "p_partkey long, p_brand string, p_size int"),
        "lineitem": (
            [
                (i // 5, i % 12, i * 7 % 9, i % 7 + 1, float(i % 40), i * 1.5, i % 3 / 100, "ARN"[i % 3], "OF"[i % 2],
                 datetime.datetime(1994, 1 + i % 6, 1 + i % 28))
                for i in range(200)
            ],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_rows_that_a_fact_reads_once_are_not_written_before(spark, tables):
    fact = catalogue.fact(spark, tables)
    assert not [f for f in fact.inputFiles() if "/resolved/" in f]
    written = catalogue.fact(spark, tables, values=catalogue.resolved(spark, tables).rows)
    assert frames.rows(fact) == frames.rows(written) and fact.count() > 20
    split = catalogue.fact_split_groups(spark, tables)
    assert frames.rows(split) == frames.rows(fact)


def test_new_rows_by_area_are_told_without_writing_all_rows(spark, tables):
    new = catalogue.filter_new_by_area(spark, tables)
    assert not [f for f in new.inputFiles() if "/resolved/" in f]
