import random

import numpy as np

from tallymart.llm import toxicity


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(40)]
        bad = rng.random() < 0.3
        if bad:
            for _ in range(2):
                words[rng.randrange(40)] = rng.choice(["Vile!", "NASTY", "rotten,"])
        out.append((k, " ".join(words), int(bad)))
    return out


def test_a_word_list_is_learnt(spark):
    data = rows(1500, 6)
    documents = spark.createDataFrame([(i, t, 1.0) for i, t, _ in data], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in data if i < 1000] + [(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(documents, labels)
    assert len(model.features) < 2000
    got = {r.doc_id: r for r in toxicity.score(documents, model).collect()}
    right = [got[i].predicted == y for i, _, y in data if i >= 1000]
    assert np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_scores_equal_plain_sums():
    import math

    import pyarrow as pa

    texts = ["Vile vile nasty w1", "", "x", "Ünïcode é w1 w2 w3 w4"]
    ((a, b, kinds),) = toxicity._features(pa.array(texts))
    assert (a, b) == (0, 4)
    sizes = [np.bincount(doc, minlength=4).tolist() for doc, _ in kinds]
    n = [4, 0, 1, 6]
    assert sizes == [[max(0, x - reach) for x in n] for reach in (0, 1, 2, 2, 3)]
    state = toxicity.Ftrl(alpha=1.0, l1=0.0)
    state.learn(np.array([3, 5]), 1)
    # one step from zero: g = -0.5, n = 0.25, z = -0.5, so w = 0.5 / (1 + 0.5)
    assert math.isclose(state.weights(np.array([3]))[0], 0.5 / 1.5) and state.weights(np.array([4]))[0] == 0


def test_odd_texts_and_no_labels(spark):
    odd = [(1, None), (2, ""), (3, "?!"), (4, "word " * 50_000), (1, None)]
    documents = spark.createDataFrame(odd, "doc_id long, text string")
    model = toxicity.train(documents, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.score(documents, model).collect()
    assert len(got) == 5 and all(r.predicted == 0 and r.score < 1e-9 for r in got)
    assert toxicity.score(documents.filter("false"), model).collect() == []


def test_sample_is_bounded(spark):
    data = rows(600, 8)
    documents = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    assert toxicity.train(documents, labels, max_rows=50).bias != toxicity.train(documents, labels).bias
