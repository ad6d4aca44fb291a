import corpus_pipeline
from tallymart.llm import queries

SMALL = "/root/testdata/sf0.001"


def run(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    """Documents after each stage but the last, and the pieces."""
    docs = spark.createDataFrame(rows, schema)
    after = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        after.append([r.asDict() for r in docs.collect()])
    return after


def test_stages_decide(spark):
    item = queries.table(spark, SMALL, "benchmark").first().text
    words = [f"word{k}" for k in range(120)]
    text = " ".join(words)
    near = " ".join(["other", *words[1:]])
    rows = [
        (1, text, "en", "a", 1), (2, near, "en", "a", 1), (1, text, "en", "a", 1), (3, None, "en", "a", 1), (4, "12 !?", "en", None, 1),
        (5, f"before {item} after", "en", "a", 1), (6, "write to joe@mail.example.com about this", "en", "a", 1), (7, "alone here", "en", "a", 1),
    ]
    lang, dedup, clean, masked, packed = run(spark, rows)
    ids = lambda docs: sorted(d["doc_id"] for d in docs)
    assert ids(lang) == [1, 1, 2, 5, 6, 7]
    assert ids(dedup) == [1, 5, 6, 7]
    assert ids(clean) == [1, 6, 7]
    assert {d["doc_id"]: d["text"] for d in masked}[6] == "write to [EMAIL] about this"
    assert all(d["n_chars"] == len(d["text"]) for d in masked)
    assert all(list(d) == ["doc_id", "text", "lang", "source", "n_chars"] for docs in (lang, dedup, clean, masked) for d in docs)
    assert sorted({p["doc_id"] for p in packed}) == [1, 6, 7] and len({p["sequence_id"] for p in packed}) == 1


def test_empty_table(spark):
    assert run(spark, []) == [[]] * 5


def test_run_equals_its_stages(spark):
    docs = queries.table(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
    kept = {r.doc_id for r in docs.collect()}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == kept
    assert sum(r.length for r in got) > 0


def test_unlike_texts_of_one_id_stay_and_equal_rows_go(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, t long, rest string"
    rivers = " ".join(f"river{k}" for k in range(40))
    law = " ".join(f"law{k}" for k in range(40))
    rows = [
        (1, rivers, "en", "b", 1), (1, law, "en", "a", 1), (1, rivers, "en", "a", 1), (2, rivers + " more", "en", "a", 1), (2, "quite another text of its own", "en", "a", 1),
        (3, law + " end", "en", "a", 1), (None, rivers, "en", "a", 1), (None, rivers, "en", "a", 1), (4, None, "en", "a", 1), (4, None, "en", "a", 1),
    ]
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], schema)
    got = corpus_pipeline.near_dedup(spark, docs, SMALL)
    assert got.columns == docs.columns
    kept = sorted((r.doc_id or 0, r.text or "", r.source) for r in got.collect())
    want = [(0, rivers, "a")] * 2 + [(1, law, "a"), (1, rivers, "a"), (2, "quite another text of its own", "a")] + [(4, "", "a")] * 2
    assert kept == sorted(want)
