import hashlib
import random
import re

from tallymart.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    windows = {}
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).update([] if i is None else [str(i)])
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in windows:
                    hit |= set(range(k, k + m))
                    found |= windows[tuple(w[k : k + m])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def same(spark, rows, items, **how):
    documents = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, w long, win string")
    benchmark = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, n long")
    got = decontaminate.contamination(documents, benchmark, **how).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, items)
    clean = decontaminate.uncontaminated(documents, benchmark)
    assert clean.columns == documents.columns
    assert sorted((r.doc_id, r.text) for r in clean.filter("doc_id is not null").collect()) == sorted(
        (r[0], t) for r, (_, t) in zip(brute_in_order(rows, items), rows) if not r[5] and r[0] is not None
    )


def brute_in_order(rows, items):
    return [brute([row], items)[0] for row in rows]


def test_windows_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["a", "b", "c", "dé", "e1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randrange(1, 16))) for k in range(14)] + [(99, text(11))] * 2
    rows = [(k, f"{text(30)}, {rng.choice(items)[1]}. {text(9)}") for k in range(40)] + [(50, text(200))]
    same(spark, rows, items)


def test_odd_rows(spark):
    passage = "It was the best of times it was the worst of times"
    items = [(1, passage), (10, passage.upper()), (2, None), (3, "..."), (4, "lone"), (None, "no id")]
    rows = [
        (1, None), (2, ""), (3, "?!"), (4, f"{passage} {passage}"), (4, f"{passage} {passage}"), (5, "a lone word"),
        (6, " ".join(passage.split()[:9])), (None, passage), (7, "no id here"), (7, "another text"), (8, "Lone"),
    ]
    same(spark, rows, items)


def test_empty_tables(spark):
    same(spark, [], [(1, "a b c")])
    same(spark, [(1, "a b c")], [])
