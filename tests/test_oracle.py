"""A cross-section of the registered queries against their SQL, over the whole smallest tables.

``python tests/compare.py <folder>`` does the same for all of them.
"""

from pathlib import Path

import pytest

import compare
from tallymart.plans import catalogue, oracle

SF_DIR = "/root/testdata/sf0.001"

NAMES = [
    "ingest_documents",
    "ingest_lost_documents",
    "ingest_split_documents",
    "resolve_rejects",
    "completeness_dense",
    "completeness_dense_stray",
    "silent_runs_stray",
    "fact_split_groups",
    "mom_pct_change_gap_aware",
    "rolling_avg_split_groups",
    "coverage_matrix",
    "low_runs_gap_aware",
    "contract_report",
    "contract_report_in_write",
    "incremental_union",
    "incremental_skipped",
    "filter_new_by_area",
    "fact_null_periods_split_groups",
    "rolling_avg_calendar_null_keys_split_groups",
    "cast_values_odd_text",
    "dims_written",
    "analytics_written",
    "aggregation_written",
    "dq_gate",
    "states_volumes_by_quarter",
]


@pytest.fixture(scope="module")
def connection():
    return compare.oracle(SF_DIR)


def test_every_query_has_its_sql():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())
    assert set(compare.spark_entry.oracle_sql()) <= set(compare.spark_entry.queries())


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not there")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    df = compare.spark_entry.queries()[name](spark, SF_DIR)
    assert compare.differences(df, connection, compare.spark_entry.oracle_sql()[name]) == []
