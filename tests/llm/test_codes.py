"""Codes against plain assignments and means, and against their SQL."""

import hashlib

import duckdb
import numpy as np
import pytest

from tallymart.llm import codes, oracle

SCHEMA = "vec_id long, embedding array<float>, label int"
QUERY = "op12_vector_code_compression"


def plain(rows):
    """Assign all parts to all entries, twice replace entries by means, assign again."""
    good = [(i, label, np.floor(np.array(v, np.float32).astype(float) * 256).astype(int)) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    if not good:
        return []
    parts = np.array([r[2] for r in good]).reshape(len(good), 16, -1)
    books = parts[:64].transpose(1, 0, 2).copy()

    def assigned():
        far = ((parts[:, :, None] - books[None]) ** 2).sum(3)
        return far.argmin(2), far.min(2)

    for _ in range(2):
        owner, _ = assigned()
        for p in range(16):
            for e in range(books.shape[1]):
                own = parts[owner[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(0) // len(own)
    owner, far = assigned()
    errors = far.sum(1).tolist()
    of_label = {label: sum(e for e, r in zip(errors, good) if r[1] == label) for label in {r[1] for r in good}}
    digest = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    texts = ["".join(f"{x:02x}" for x in row) for row in owner.tolist()]
    return ordered((r[0], t, e, of_label[r[1]], digest) for r, t, e in zip(good, texts, errors))


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x if x is not None else 0) for x in r])


def vectors(n, seed, size=64, copies=0):
    rng = np.random.default_rng(seed)
    out = [(k, rng.normal(0, 0.2, size).astype(np.float32).tolist(), k % 5 if k % 11 else None) for k in range(n)]
    return out + [(n + k, out[3][1], 1) for k in range(copies)]


V = vectors(3, 9)[0][1]
CASES = {
    "plain": vectors(700, 1),
    "third is one vector": vectors(400, 2, copies=200),
    "fewer rows than entries": vectors(20, 3),
    "wide parts": vectors(150, 4, size=96),
    "equal entries": [(k, V, 1) for k in range(70)] + vectors(200, 5)[100:],
    "ties and odd rows": [
        (5, V, 1), (5, V, 1), (None, V, None), (7, None, 1), (8, [None] + V[1:], 1), (9, [float("nan")] + V[1:], 1),
        (10, [float("inf")] + V[1:], 2), (11, [0.0] * 64, 3), (11, [-0.0] * 64, 3), (12, [-1 / 512] * 64, None), (4, [1 / 512] * 64, 2),
    ],
    "nothing kept": [(1, None, 1), (2, [float("nan")] * 64, None)],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_plain_codes_and_sql(spark, name, tmp_path):
    rows = CASES[name]
    frame = spark.createDataFrame([(*r, 0, None) for r in rows], SCHEMA + ", code int, error string").repartition(3)
    got = codes.compress(frame)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    got = ordered(map(tuple, got.collect()))
    assert got == plain(rows)
    frame.coalesce(1).write.parquet(str(tmp_path / "embeddings"))
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as from '{tmp_path}/embeddings/*.parquet'")
    assert ordered(connection.execute(oracle.oracle_sql()[QUERY]).fetchall()) == got


@pytest.mark.parametrize("spread", [1, 20, 5000])
def test_trees_give_the_nearest_entries(spread):
    rng = np.random.default_rng(spread)
    parts = np.floor(rng.normal(0, spread, (5000, 4))).astype(np.int64)
    entries = np.concatenate([parts[:50], parts[:10], np.floor(rng.normal(0, spread, (4, 4))).astype(np.int64)])
    found = codes.tree(parts)
    far = ((parts[:, None] - entries[None]) ** 2).sum(2)
    owner, error = codes.nearest(found, entries)
    assert (owner == far.argmin(1)).all() and (error == far.min(1)).all()
    total = np.zeros((64, 5), np.int64)
    np.add.at(total, owner, np.column_stack([parts, np.ones(5000, np.int64)]))
    assert (codes.sums(found, entries) == total).all()


def test_balls_hold_their_points_and_cache_their_sums():
    parts = np.random.default_rng(1).integers(-100, 100, (3000, 4))
    found = codes.tree(parts)
    assert (found.points[found.member] == parts).all()
    for (_, _, a, b), ball, total in zip(found.nodes, found.balls, found.sums):
        own = found.points[a:b]
        assert np.sqrt(((own - ball[:-1]) ** 2).sum(1)).max() <= ball[-1] + 1e-6
        assert total.tolist() == np.append((own * found.weight[a:b, None]).sum(0), found.weight[a:b].sum()).tolist()


def test_a_ball_is_wholly_owned_without_its_points():
    near = np.random.default_rng(2).integers(-5, 5, (2000, 4))
    found = codes.tree(np.concatenate([near, near + 1000]))
    entries = np.array([[0] * 4, [1000] * 4, [5000] * 4])
    whole = [owner for _, owner, _, _ in codes._owned(found, entries)]
    assert all(isinstance(owner, int) for owner in whole) and len(whole) <= 4
    assert codes.nearest(found, entries)[0].tolist() == [0] * 2000 + [1] * 2000


def test_large_values_and_other_lengths(spark):
    rows = [(1, [1e38] * 64, 1), (2, [-1e38] * 64, 1), (3, [1.0] * 32, 1), (4, [], 1)]
    got = codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.vec_id, r.code, r.error) for r in sorted(got)] == [(1, "00" * 16, 0), (2, "01" * 16, 0)]
    odd = codes.compress(spark.createDataFrame([(k, [float(k)] * 19, None) for k in range(3)], SCHEMA)).collect()
    assert sorted(r.code for r in odd)[1] == "01" * 10 + "00" * 6
    assert len(codes.compress(spark.createDataFrame([(1, [], 1), (2, [], None)], SCHEMA)).collect()) == 2


def test_many_labels_are_joined_around_hot_ones(spark, monkeypatch):
    rows = [(k, v, None if k % 3 else k) for k, v, _ in vectors(120, 6)]
    monkeypatch.setattr(codes, "_BROADCAST_LABELS", 3)
    assert ordered(map(tuple, codes.compress(spark.createDataFrame(rows, SCHEMA)).collect())) == plain(rows)
