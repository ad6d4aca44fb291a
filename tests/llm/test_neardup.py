import random
import re
import time
from collections import defaultdict

from tallymart.llm.components import components
from tallymart.llm.neardup import classes, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    sets = defaultdict(set)
    for i, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = WORD.findall(lowered)
        sets[i] |= {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def texts(seed, n=140):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((i, " ".join(words)))
        else:
            rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(6, 60)))))
    return rows


def test_links_equal_brute_force(spark, docs):
    rows = texts(1)
    assert got(near_duplicates(docs(rows))) == brute(rows)


def test_nodes_are_branched_and_cut_into_blocks(spark, docs):
    rows = texts(2)
    assert got(near_duplicates(docs(rows), small=4, depth=2)) == brute(rows)


def test_odd_rows(spark, docs):
    base = "one two three four five six seven eight"
    rows = [(5, base), (3, base.upper()), (9, None), (8, ""), (7, " \t\n"), (6, "a b"), (4, "A\tB"), (2, "a c"), (1, "É é")]
    out = got(near_duplicates(docs(rows)))
    assert out == brute(rows)
    assert out[9] == (0, 9, True) and out[6] == (1, 4, False) and out[5] == (4, 3, False)


def test_repeated_rows_and_null_ids(spark, docs):
    base = "one two three four five six"
    out = near_duplicates(docs([(1, base), (1, base), (None, base), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in out if r.doc_id) == [(1, 2, 1, True)] * 2
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, False)] * 2


def test_empty_table(spark, docs):
    assert near_duplicates(docs([])).collect() == []


def test_long_text_over_segments(spark, docs):
    rng = random.Random(3)
    words = [f"word{rng.randrange(10**6)}" for _ in range(90_000)]
    other = words.copy()
    other[17] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, "x" * 1_200_000)]
    assert got(near_duplicates(docs(rows))) == brute(rows)


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(k, k + 1) for k in range(40)]
    hub = [(100, k) for k in range(101, 160)]
    links = spark.createDataFrame([*chain, *hub, (7, 7), (None, 3)], "a long, b long")
    found = {r.id: r.component for r in components(links).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}


def test_a_hub_goes_around(spark):
    links = [(100, k) for k in range(101, 200)] + [(k, k + 1) for k in range(40)] + [(k, 500) for k in range(300, 340)]
    found = components(spark.createDataFrame(links, "a long, b long"), hot_links=5).collect()
    want = {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 200)}, **{k: 300 for k in [*range(300, 340), 500]}}
    assert {r.id: r.component for r in found} == want


def test_unlike_texts_of_one_id_are_documents_of_their_own(spark, docs):
    rows = texts(5, 60)
    want = brute(rows)
    shared = near_duplicates(docs([(0, t) for _, t in rows] + [(0, rows[0][1])] * 30)).collect()
    assert len(shared) == 90 and all(r.component_id == 0 and r.kept for r in shared)
    groups = defaultdict(set)
    for i, (_, component, _) in want.items():
        groups[component].add(rows[i][1])
    component = {}
    for r in classes(docs([(7, t) for _, t in rows])).collect():
        component.setdefault(r.component, set()).add(r.t)
    assert sorted(map(len, component.values())) == sorted(len(g) for g in groups.values())


def test_many_unlike_texts_of_one_id_cost_what_others_do(spark, docs):
    rng = random.Random(8)
    text = [" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(4000)]
    seconds = []
    for ids in (range(4000), [0] * 4000):
        started = time.time()
        assert near_duplicates(docs(list(zip(ids, text)))).count() == 4000
        seconds.append(time.time() - started)
    assert seconds[1] < 2 * seconds[0] + 5
