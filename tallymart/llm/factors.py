"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata.

Every feature i has a weight w_i and a vector v_i of ``RANK`` factors; a text with feature values x_i scores

    bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,

whose last sum is half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2, summed over the factors: time linear in the
number of features.  Features are in three fields, each scaled to unit length so that none drowns the others:

- hashed distinct words of the lower-cased text;
- statistics of the text's structure, each one of ``STEPS`` steps of its value;
- metadata: the declared number of characters as steps, and whether there is one and whether it is right.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm import words

BITS = 15
RANK = 8
STEPS = 16
STATISTICS = (
    "words", "mean word", "repeated neighbours", "distinct words", "capitals", "digits", "marks within words", "lone marks",
    "line words", "bytes beyond ASCII", "other marks",
)
_WORDS = 1 << BITS
_META = _WORDS + STEPS * len(STATISTICS)
#: Steps of the declared number of characters, none declared, wrong, right.
SIZE = _META + STEPS + 3
_PART = 1 << 20

_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_HIGH = np.arange(256) >= 128
#: Marks of plain prose: full stop, comma, colon, semicolon, quotes, hyphen, brackets, question and exclamation mark.
_PROSE = np.isin(np.arange(256), np.frombuffer(b".,:;'\"-()?!", np.uint8))
_MARK = words.NOT_SPACE & ~words.ALNUM & ~_CAPITAL & (np.arange(256) > 32)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, ``STATISTICS``) of values from 0 to 1; a text without words has zeros."""
    hashes, firsts, ends, counts = words.word_hashes(data, offsets, words.NOT_SPACE, lower=False)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(counts)), counts)
    n = np.maximum(counts, 1)
    size = np.maximum(np.diff(offsets), 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    ordered = np.lexsort((hashes, doc))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[ordered][1:] != hashes[ordered][:-1]) | (doc[1:] != doc[:-1])
    marks = np.concatenate([[0], np.cumsum(_MARK[data])])
    odd = np.concatenate([[0], np.cumsum((_MARK & ~_PROSE)[data])])
    own = marks[ends] - marks[firsts]
    letters = np.maximum(_per_text(words.ALNUM[data] | _CAPITAL[data], offsets), 1)
    lines = _per_text(data == 10, offsets) + 1
    found = [
        np.log2(n) / 20,
        np.diff(np.concatenate([[0], np.cumsum(ends - firsts)])[bounds]) / n / 32,
        _per_text(same, bounds) / n,
        _per_text(fresh, bounds) / n,
        _per_text(_CAPITAL[data], offsets) / letters,
        _per_text(_DIGIT[data], offsets) / letters,
        _per_text((own > 1) & (own < ends - firsts), bounds) / n,
        _per_text(own == ends - firsts, bounds) / n,
        np.log2(n / lines + 1) / 12,
        _per_text(_HIGH[data], offsets) / size,
        _per_text(odd[ends] > odd[firsts], bounds) / n,
    ]
    return np.where(counts[:, None] > 0, np.clip(np.stack(found, axis=1), 0, 1), 0)


def _steps(values: np.ndarray) -> np.ndarray:
    """Shares fall into steps that are finer near 0, where most texts lie."""
    return np.minimum(np.sqrt(values) * STEPS, STEPS - 1).astype(np.int64)


def _features(text: pa.Array, declared: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, row of every feature, feature, value), rows ascending."""
    text = text.fill_null("")
    lower = pc.utf8_lower(text)
    length = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.float64)
    said = declared.cast(pa.float64()).to_numpy(zero_copy_only=False)
    data, offsets = words.column_bytes(text)
    small, at = words.column_bytes(lower)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _PART, "right")) - 1)
        hashes, _, _, counts = words.word_hashes(small[at[a] : at[b]], at[a : b + 1] - at[a], words.ALNUM)
        doc = np.repeat(np.arange(b - a), counts)
        key = np.unique(doc << BITS | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
        distinct = np.bincount(key >> BITS, minlength=b - a)
        rows, ids = [key >> BITS], [key & (_WORDS - 1)]
        values = [np.repeat(1 / np.sqrt(np.maximum(distinct, 1)), distinct)]

        step = _steps(statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        step += _WORDS + STEPS * np.arange(len(STATISTICS))
        rows.append(np.repeat(np.arange(b - a), len(STATISTICS)))
        ids.append(step.ravel())
        values.append(np.full(step.size, 1 / np.sqrt(len(STATISTICS))))

        known = ~np.isnan(said[a:b])
        size = np.minimum(np.log2(np.maximum(np.where(known, said[a:b], 0), 1)), STEPS - 1).astype(np.int64)
        right = np.where(known & (said[a:b] == length[a:b]), 2, 1)
        for own in (_META + np.where(known, size, STEPS), _META + STEPS + np.where(known, right, 0)):
            rows.append(np.arange(b - a))
            ids.append(own)
            values.append(np.full(b - a, 1 / np.sqrt(2)))
        order = np.argsort(np.concatenate(rows), kind="stable")
        yield a, b, *[np.concatenate(x)[order] for x in (rows, ids, values)]
        a = b


@dataclass
class Machine:
    """Weights and factors, and the sums of squared gradients that set each one's step."""

    w: np.ndarray
    v: np.ndarray
    bias: float = 0.0

    @classmethod
    def fresh(cls, seed: int = 1) -> Machine:
        return cls(np.zeros(SIZE), np.random.default_rng(seed).normal(0, 0.05, (SIZE, RANK)))

    def score(self, rows: np.ndarray, ids: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(score before the logistic function, sum of v x per factor) of ``n`` texts."""
        part = self.v[ids] * values[:, None]
        total = np.stack([np.bincount(rows, part[:, f], n) for f in range(self.v.shape[1])], axis=1)
        squares = np.bincount(rows, (part * part).sum(1), n)
        linear = np.bincount(rows, self.w[ids] * values, n)
        return self.bias + linear + 0.5 * ((total * total).sum(1) - squares), total


def probability(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -35, 35)))


def fitted(
    examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 12, batch: int = 32, rate: float = 0.15, decay: float = 1e-5
) -> Machine:
    """A machine fitted to (label, features, values) by AdaGrad on the logistic loss, in an order drawn anew each epoch.

    Both labels have the same say in all: an example counts by the inverse of its label's share.
    """
    machine = Machine.fresh()
    labels = np.array([label for label, _, _ in examples], np.float64)
    ones = labels.sum()
    share = np.where(labels > 0, 0.5 * len(labels) / max(ones, 1), 0.5 * len(labels) / max(len(labels) - ones, 1))
    spent_w, spent_v, spent_b = np.full(SIZE, 1e-6), np.full((SIZE, RANK), 1e-6), 1e-6
    for epoch in range(epochs):
        order = np.random.default_rng(epoch).permutation(len(examples))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            sizes = [len(examples[k][1]) for k in own]
            rows = np.repeat(np.arange(len(own)), sizes)
            ids = np.concatenate([examples[k][1] for k in own])
            x = np.concatenate([examples[k][2] for k in own])
            score, total = machine.score(rows, ids, x, len(own))
            slope = (probability(score) - labels[own]) * share[own] / len(own)
            each = slope[rows] * x
            used, place = np.unique(ids, return_inverse=True)
            step_w = np.bincount(place, each) + decay * machine.w[used]
            # d score / d v_if = x_i (sum_j v_jf x_j - v_if x_i)
            inner = each[:, None] * (total[rows] - machine.v[ids] * x[:, None])
            step_v = np.stack([np.bincount(place, inner[:, f]) for f in range(RANK)], axis=1) + decay * machine.v[used]
            spent_w[used] += step_w**2
            spent_v[used] += step_v**2
            spent_b += slope.sum() ** 2
            machine.w[used] -= rate * step_w / np.sqrt(spent_w[used])
            machine.v[used] -= rate * step_v / np.sqrt(spent_v[used])
            machine.bias -= rate * slope.sum() / np.sqrt(spent_b)
    return machine


def _declared(documents: DataFrame) -> Column:
    return F.col("n_chars").cast("double") if "n_chars" in documents.columns else F.lit(None).cast("double")


def train(documents: DataFrame, labels: DataFrame, max_rows: int = 8_000, epochs: int = 12) -> Machine:
    """Fit on at most ``max_rows`` labelled documents: of the ids, those with the smallest hashes.

    ``labels(doc_id, quality)``: rows with a null in either column teach nothing; of repeated ids the larger
    label counts.  Of documents that repeat an id one counts, chosen by its features, so the bound is one
    of rows, whatever an id's share of the table.  The ids are broadcast, at most ``max_rows``; one task learns
    from their features, some 4 kB a row, and the machine comes to the driver: 33,000 features of nine numbers.
    Without both labels among the rows all scores are the share of 1, or 0.5 without rows.
    """
    known = labels.filter("quality is not null and doc_id is not null").select(
        F.col("doc_id").cast("string").alias("id"), F.col("quality").cast("int").alias("label")
    )
    each = known.groupBy("id").agg(F.max("label").alias("label"))
    sample = F.broadcast(each.orderBy(F.xxhash64("id"), "id").limit(max_rows))
    rows = documents.select(F.col("doc_id").cast("string").alias("id"), "text", _declared(documents).alias("declared"))
    rows = rows.join(sample, "id")

    def features(batches):
        for batch in batches:
            for a, b, row, ids, values in _features(batch.column("text"), batch.column("declared")):
                cuts = np.searchsorted(row, np.arange(1, b - a))
                own = [np.stack([i, v]).T.tobytes() for i, v in zip(np.split(ids.astype(float), cuts), np.split(values, cuts))]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), pa.array(own, pa.binary())], ["id", "label", "features"]
                )

    def learn(batches):
        examples = []
        for batch in batches:
            for label, own in zip(batch.column("label").to_pylist(), batch.column("features").to_pylist()):
                pairs = np.frombuffer(own).reshape(-1, 2)
                examples.append((label, pairs[:, 0].astype(np.int64), pairs[:, 1].copy()))
        of_labels = {label for label, _, _ in examples}
        if len(of_labels) == 2:
            machine = fitted(examples, epochs)
        else:
            machine = Machine(np.zeros(SIZE), np.zeros((SIZE, RANK)), {0: -35.0, 1: 35.0}[of_labels.pop()] if of_labels else 0.0)
        number = np.append(np.arange(SIZE), -1)
        table = np.vstack([np.column_stack([machine.w, machine.v]), np.append(machine.bias, np.zeros(RANK))])
        yield pa.record_batch({"feature": number, "weights": pa.array(list(table), pa.list_(pa.float64()))})

    examples = rows.mapInArrow(features, "id string, label int, features binary")
    one = examples.groupBy("id").agg(F.min(F.struct("label", "features")).alias("own")).select("id", "own.*")
    ordered = one.repartition(1).sortWithinPartitions("id")
    got = ordered.mapInArrow(learn, "feature long, weights array<double>").toArrow()
    table = np.zeros((SIZE + 1, RANK + 1))
    weights = got.column("weights").combine_chunks().flatten().to_numpy().reshape(-1, RANK + 1)
    table[got.column("feature").to_numpy()] = weights  # -1 is the last row: the bias
    return Machine(table[:-1, 0].copy(), table[:-1, 1:].copy(), float(table[-1, 0]))


def score(documents: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """``documents`` with ``score``, from 0 to 1, and ``predicted``, score >= ``threshold``.

    A null text is an empty one, whose score is that of its statistics and metadata, all at their lowest
    step.  Without a column ``n_chars``, or with a null in it, none is declared.  Other columns pass through;
    columns of the two names are replaced.
    """
    taken = [c for c in documents.columns if c not in ("score", "predicted")]
    rows = documents.select(*taken, _declared(documents).alias("_declared"))
    shared = documents.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        frozen = shared.value
        for batch in batches:
            value = np.zeros(batch.num_rows)
            for a, b, row, ids, values in _features(batch.column("text"), batch.column("_declared")):
                value[a:b] = frozen.score(row, ids, values, b - a)[0]
            p = probability(value)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in taken], pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                [*taken, "score", "predicted"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*taken).schema)
    return rows.mapInArrow(run, f"{schema}, score double, predicted int")
