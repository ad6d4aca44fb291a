"""The manifest against a plain tree per source, and against its SQL."""

import hashlib
import zlib

import duckdb
import pytest

from tallymart.llm import merkle, oracle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """Top digest, and per node the siblings left and right of it on every level."""
    paths = [[] for _ in nodes]
    level = [(node, [k]) for k, node in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for a in range(0, len(level), 16):
            run = [node for node, _ in level[a : a + 16]]
            below = [own for _, own in level[a : a + 16]]
            for place, own in enumerate(below):
                for k in own:
                    paths[k].append(("".join(run[:place]), "".join(run[place + 1 :])))
            above.append((digest(*run), sum(below, [])))
        level = above
    return level[0][0], paths


def plain(rows):
    sources = {}
    for i, text, lang, source, n in rows:
        own = leaf(i, source, lang, n, text)
        changed = i is not None and text is not None and zlib.crc32(str(i).encode()) % 5 == 0
        sources.setdefault(source, []).append((i, own, leaf(i, source, lang, n, text.translate(LOWER)) if changed else own))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = [tree([own for _, own, _ in sources[name]]) for name in names]
    root, tops = tree([top for top, _ in trees]) if trees else ("", [])
    out = []
    for name, (top, paths), rest in zip(names, trees, tops):
        for (i, own, now), path in zip(sources[name], paths):
            for left, right in path + rest:
                now = digest(left, now, right)
            proof = digest(*[left + right for left, right in path + rest])
            out.append((i, own, top, root, proof, now, now == root))
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, x if x is not None else 0) for x in r])


ODD = [
    (1, "Ab", "de", "s", 2), (1, "Ab", "de", "s", 2), (1, "Ba", "de", "s", 2), (None, "X", "de", "s", 1), (None, "X", None, "s", 1),
    (5, None, None, None, None), (6, None, None, None, 0), (7, "", "en", None, 0), (9, "É Z", "en", "ß", 3),
    (10, "É z", "en", "ß", 3), (2**40, "Q word " * 100_000, "en", "alone", None), (-3, "1:A", "-", "-", 3), (8, "x", "", "", 1),
]
CASES = {
    "odd": ODD,
    "one hot source": [(k, f"Text {k}", "en", "hot" if k % 3 else f"s{k % 40}", k) for k in range(900)],
    "sources only": [(k, "A", "en", f"s{k}", 1) for k in range(290)],
    "exact runs": [(k, "A", "en", "s", 1) for k in range(256)] + [(k, "A", "en", "t", 1) for k in range(17)],
    "one row": [(0, "A", "en", "s", 1)],
    "equal rows": [(3, "Same", "en", "s", 1)] * 40,
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_plain_trees_and_sql(spark, name, tmp_path):
    rows = CASES[name]
    frame = spark.createDataFrame([(*r, 1, None, None) for r in rows], SCHEMA + ", leaf int, g long, path string")
    got = merkle.manifest(frame)
    assert got.columns == COLUMNS
    got = ordered(map(tuple, got.collect()))
    assert got == plain(rows)
    frame.coalesce(1).write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"create view documents as from '{tmp_path}/documents/*.parquet'")
    assert ordered(connection.execute(oracle.oracle_sql()["op13_merkle_manifest"]).fetchall()) == got


def test_tampering_is_found_where_it_changes_the_text(spark):
    rows = [(k, "Upper" if k % 2 else "lower", "en", f"s{k % 3}", 5) for k in range(200)]
    got = {r.doc_id: r.verified for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: not (k % 2 and zlib.crc32(str(k).encode()) % 5 == 0) for k in range(200)}


def test_numbers_do_not_depend_on_the_pieces(spark, monkeypatch):
    rows = [(k // 2, f"t{k}", "en", f"s{min(k % 7, 2)}", 1) for k in range(500)]
    want = plain(rows)
    monkeypatch.setattr(merkle, "_PIECE_ROWS", 20)
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert ordered(map(tuple, got.collect())) == want
