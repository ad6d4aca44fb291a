import random

import pytest
from pyspark.sql import functions as F

import frames
from tallymart.functions import skew
from tallymart.functions.skew import hot_keys, lookup_join, split_hot


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    keys = ["hot"] * 60 + [None] * 30 + list("abcdx")
    rows = [(i, rng.choice(keys), rng.choice([1, 1, 2])) for i in range(400)]
    left = spark.createDataFrame(rows, "id int, k string, n int")
    lookup = [(k, n, f"{k}{n}") for k in ["hot", "a", "b", "c", "d", "unused"] for n in (1, 2)]
    return left, spark.createDataFrame(lookup, "lk string, ln int, name string")


def test_hot_keys(sides):
    left, _ = sides
    assert frames.rows(hot_keys(left, ["k"], 40).keys, "_hot_k") == [("hot",), (None,)]
    assert hot_keys(left, ["k"], 400) is None and hot_keys(left, ["k"], None) is None
    cold, hot = split_hot(left, ["k"], hot_keys(left, ["k"], 40))
    assert frames.rows(cold.unionByName(hot)) == frames.rows(left)
    assert cold.filter("k = 'hot' or k is null").count() == 0


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti", "inner"])
def test_all_ways_to_join_agree(sides, how):
    left, lookup = sides
    on = [("k", "lk"), ("n", "ln")]
    plain = frames.rows(lookup_join(left, lookup, on, how, bound=None))
    assert frames.rows(lookup_join(left, lookup, on, how)) == plain
    assert frames.rows(lookup_join(left, lookup, on, how, bound=0)) == plain
    assert frames.rows(lookup_join(left, lookup, on, how, bound=0, hot_rows=20)) == plain


def test_hot_rows_are_not_shuffled_by_their_key(spark, capsys):
    rows = spark.range(10_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id"
    )
    lookup = spark.range(2000).select(F.col("id").alias("lk"), F.lit("name" * 9).alias("name"))
    joined = lookup_join(rows, lookup, [("k", "lk")], bound=10_000, hot_rows=1000)
    # 3334 multiples of three, and the row with id 7
    assert joined.filter("k = 7 and name is not null").count() == 3335
    joined.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan
    assert "Union" in plan and plan.count("BroadcastHashJoin") >= 4


def test_keys_nearly_as_many_as_the_rows_are_counted_in_buckets_first(sides, monkeypatch):
    left, _ = sides
    exact = frames.rows(hot_keys(left, ["k", "n"], 20).keys)
    monkeypatch.setattr(skew, "BUCKETS_FROM", 1)
    monkeypatch.setattr(skew, "BUCKETS", 8)  # fewer than the keys, so that cold ones share a bucket with hot ones
    assert frames.rows(hot_keys(left, ["k", "n"], 20, many=True).keys) == exact and len(exact) > 1
    monkeypatch.setattr(skew, "written", None)  # where no bucket is full, keys are not counted
    assert hot_keys(left, ["k", "n"], 400, many=True) is None


def test_the_largest_keys_are_kept(sides):
    left, _ = sides
    got = hot_keys(left, ["k"], 1, most=1)
    assert frames.rows(got.keys) == [("hot",)] and got.count == 1
    assert got.rows == left.filter("k = 'hot'").count()
