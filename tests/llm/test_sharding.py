import random
import zlib

import numpy as np
import pytest

from tallymart.llm import sharding


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours(dimensions, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
    cells = np.stack(axes, -1).reshape(-1, dimensions)
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[index.argsort()], axis=0)).sum(1) == 1).all()


def test_law_of_bytes(spark):
    rng = random.Random(12)
    rows = [(k, "é" * rng.randrange(200), rng.choice(["en", "de", None])) for k in range(3000)]
    rows += [(5000 + k, "copied text", "en") for k in range(1500)] + [(9000, None, None), (1, "again", "en"), (1, "again", "en")]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, size long, part string")
    got = sharding.shards(table, count=16).collect()
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == want
    total = sum(r.size for r in got)
    for shard in range(16):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 16) <= 0.01 * total / 16 + 802
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_small_groups_stay_whole(spark):
    rows = [(k, f"text {k // 3} " * 40) for k in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    shards = {}
    texts = dict(rows)
    for r in sharding.shards(table, count=4, tolerance=0.01).collect():
        shards.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_runs_are_narrow_in_every_dimension(spark):
    rng = random.Random(13)
    rows = [(k, "x" * rng.choice([10, 1000]), rng.choice(["en", "de"])) for k in range(2000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kinds = {r.doc_id: (r.lang, len(r.text)) for r in table.collect()}
    seen = {}
    for r in sharding.shards(table, count=16).collect():
        seen.setdefault(r.shard, set()).add(kinds[r.doc_id])
    assert np.mean([len(s) for s in seen.values()]) <= 2


def test_few_and_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert sharding.shards(empty).collect() == []
    one = spark.createDataFrame([(3, None, None)], "doc_id long, text string, lang string")
    assert [(r.size, r.slot) for r in sharding.shards(one).collect()] == [(1, 0)]
