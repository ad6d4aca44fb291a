"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the hashed words, pairs and triples of neighbouring words, and pairs with one or
two words between, each present or not.  Training is one pass or more over labelled rows: every
coordinate has its own learning rate, alpha / (beta + sqrt(sum of squared gradients)), and weights whose
accumulated gradient stays below ``l1`` are exactly zero.  What is left is a short table of weights,
which every scoring task gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import words

BITS = 20
#: Distances from a word to the others of its gram.
GRAMS = ((), (1,), (1, 2), (2,), (3,))
_PART = 1 << 20


def _features(column: pa.Array) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, end row, [(row, feature) of every gram, kind by kind])."""
    data, offsets = words.column_bytes(pc.utf8_lower(column.fill_null("")))
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _PART, "right")) - 1)
        part = offsets[a : b + 1] - offsets[a]
        hashes, _, _, counts = words.word_hashes(data[offsets[a] : offsets[b]], part, words.ALNUM)
        doc = np.repeat(np.arange(b - a), counts)
        kinds = []
        for kind, steps in enumerate(GRAMS):
            reach = steps[-1] if steps else 0
            size = max(0, len(hashes) - reach)
            inside = doc[:size] == doc[reach:] if size else np.zeros(0, bool)
            tag = np.full(size, kind, np.uint64)
            gram = words.combine(tag, hashes[:size], *[hashes[s : s + size] for s in steps])
            kinds.append((doc[:size][inside], (gram[inside] >> np.uint64(64 - BITS)).astype(np.int64)))
        yield a, b, kinds
        a = b


@dataclass
class Ftrl:
    """The state of one training run; ``bias`` is a coordinate of its own without ``l1``."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.0

    def __post_init__(self) -> None:
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def bias(self) -> float:
        return float(-self.z[-1] / ((self.beta + np.sqrt(self.n[-1])) / self.alpha))

    def learn(self, features: np.ndarray, label: int) -> None:
        """One example; ``features`` are distinct."""
        w, b = self.weights(features), self.bias()
        p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
        g = p - label
        at = np.append(features, len(self.z) - 1)
        n = self.n[at]
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - step * np.append(w, b)
        self.n[at] = n + g * g


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float


def train(
    documents: DataFrame, labels: DataFrame, max_rows: int = 12_000, epochs: int = 5, l1: float = 6.0
) -> Model:
    """Fit on about ``max_rows`` labelled documents, those with the smallest hashes of their ids.

    ``labels(doc_id, toxic)``: rows with a null in either column teach nothing; of repeated ids the
    larger label counts.  The bound holds in expectation, whatever the size of the tables: the ids of
    the sample are broadcast, and one task learns from its rows, in an order drawn anew each epoch.  What
    comes to the driver is the weights, 2^20 at most.  The task holds the sample's features, about 10 kB
    a row.
    """
    known = labels.filter("toxic is not null and doc_id is not null").select(
        F.col("doc_id").cast("string").alias("id"), F.col("toxic").cast("int").alias("label")
    )
    total = known.count()
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    sample = known.filter(place < int(1_000_000 * min(1.0, max_rows / max(1, total))))
    sample = F.broadcast(sample.groupBy("id").agg(F.max("label").alias("label")))
    rows = documents.select(F.col("doc_id").cast("string").alias("id"), "text").join(sample, "id")

    def features(batches):
        for batch in batches:
            for a, b, kinds in _features(batch.column("text")):
                key = np.unique(np.concatenate([doc << BITS | feature for doc, feature in kinds]))
                feature = (key & ((1 << BITS) - 1)).astype(np.int32)
                ends = np.searchsorted(key >> BITS, np.arange(b - a + 1)) * 4
                binary = pa.Array.from_buffers(
                    pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(feature.tobytes())]
                )
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("label"), binary.cast(pa.binary())], ["id", "label", "features"]
                )

    def learn(batches):
        state, examples = Ftrl(l1=l1), []
        for batch in batches:
            binary = zip(batch.column("label").to_pylist(), batch.column("features").to_pylist())
            examples += [(label, np.frombuffer(own, np.int32)) for label, own in binary]
        for epoch in range(epochs):
            for k in np.random.default_rng(epoch).permutation(len(examples)):
                state.learn(examples[k][1].astype(np.int64), examples[k][0])
        kept = np.append(np.flatnonzero(state.weights(slice(0, -1))), -1)
        value = np.append(state.weights(kept[:-1]), state.bias())
        yield pa.record_batch({"feature": kept.astype(np.int64), "weight": value})

    examples = rows.mapInArrow(features, "id string, label int, features binary")
    ordered = examples.repartition(1).sortWithinPartitions("id", "features")
    got = ordered.mapInArrow(learn, "feature long, weight double").toArrow()
    feature, weight = got.column("feature").to_numpy(), got.column("weight").to_numpy()
    bias = float(weight[feature == -1][0]) if len(feature) else -35.0
    return Model(feature[feature >= 0], weight[feature >= 0], bias)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``score``, the probability of label 1, and ``predicted``, score >= 0.5.

    Null and empty texts, and texts without a known gram, have the score of the bias alone; so have
    all texts under a model without labelled rows, where it is next to 0.  Other columns pass
    through; columns of the two names are replaced.
    """
    taken = [c for c in documents.columns if c not in ("score", "predicted")]
    rows = documents.select(*taken)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        frozen = shared.value
        dense = np.zeros(1 << BITS)
        dense[frozen.features] = frozen.weights
        for batch in batches:
            value = np.full(batch.num_rows, frozen.bias)
            for a, b, kinds in _features(batch.column("text")):
                hits = [(doc, feature, dense[feature]) for doc, feature in kinds]
                key = np.concatenate([(doc << BITS | feature)[w != 0] for doc, feature, w in hits])
                key = np.unique(key)
                value[a:b] += np.bincount(key >> BITS, dense[key & ((1 << BITS) - 1)], b - a)
            p = 1 / (1 + np.exp(-np.clip(value, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in taken], pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                [*taken, "score", "predicted"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, score double, predicted int")
