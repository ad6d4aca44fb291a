"""Language identification by prediction by partial matching over bytes.

Every language has a context tree of orders 0 to 3 with the counts of the bytes that followed each
context.  After training the counts are frozen.  A byte x after context c costs

    -log2 n(cx) / (n(c) + u(c))                     if x was seen after c (u: distinct bytes after c),
    -log2 u(c) / (n(c) + u(c)) + cost one order down  if c was seen without x: the escape,
    the cost one order down                           if c was never seen,

down to 8 bits, a plain byte.  A text's code length in a language is the sum over its bytes, after three
null bytes; the shortest code wins.  Texts are lower-cased first.

Training counts n-grams in Spark, on a bounded sample of rows of each language.  The trees become
sorted tables of costs for all languages at once, so that scoring is a few lookups a byte in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.words import column_bytes

ORDER = 3
UNKNOWN = "und"
_PART = 1 << 18


def learnable(documents: DataFrame) -> Column:
    """Rows that may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(documents["doc_id"].cast("string").cast("binary")) % 5 != 0


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column_bytes(pc.utf8_lower(column.fill_null("")))


def _grams(data: np.ndarray, offsets: np.ndarray, a: int, b: int) -> np.ndarray:
    """For bytes a to b, each with the three before it, as one number; null bytes before a text."""
    lo = max(0, a - ORDER)
    part = data[lo:b].astype(np.uint32)
    starts = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, b)] - lo
    gram = part.copy()
    reach = np.arange(len(part))
    at = np.zeros(len(part), np.int64)
    at[starts[starts < len(part)]] = starts[starts < len(part)]
    since = reach - np.maximum.accumulate(at) if lo == 0 or len(starts) else reach + ORDER
    if lo and len(starts):
        since[: starts[0]] = ORDER
    for back in range(1, ORDER + 1):
        past = np.zeros_like(part)
        past[back:] = part[:-back]
        past[since < back] = 0
        gram |= past << np.uint32(8 * back)
    return gram[a - lo :]


@dataclass
class Places:
    trigrams: np.ndarray
    grams: np.ndarray


@dataclass
class Model:
    """Costs in bits, for all languages: by bigram, and for contexts and grams that were seen."""

    languages: list[str]
    bigram: np.ndarray  # 65536 x languages: cost of a byte after one byte
    escape2: np.ndarray  # 65536 x languages: what an unseen byte costs on top after two bytes
    trigrams: np.ndarray  # sorted
    trigram_cost: np.ndarray
    escape3: np.ndarray  # for the trigrams as contexts
    grams: np.ndarray  # sorted
    gram_cost: np.ndarray
    _places: Places | None = None

    def places(self) -> Places:
        """Hashed places of trigrams and grams, built once in each worker."""
        if self._places is None:
            self._places = Places(_hashed(self.trigrams), _hashed(self.grams))
        return self._places


def _level(grams: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, their n + u, their u) of grams with counts by language, and each gram's context."""
    contexts, of = np.unique(grams >> 8, return_inverse=True)
    total, distinct = np.zeros((2, len(contexts), n.shape[1]))
    np.add.at(total, of, n)
    np.add.at(distinct, of, n > 0)
    return contexts, total + distinct, distinct, of


def build(languages: list[str], grams: np.ndarray, counts: np.ndarray) -> Model:
    """The frozen model from the counts (rows: grams, columns: languages) of the longest grams."""
    wide = len(languages)
    cost = np.full((1, wide), 8.0)  # order -1
    known: dict[int, tuple] = {}
    for order in range(ORDER + 1):
        ended = grams & ((1 << 8 * (order + 1)) - 1)
        # Three bytes that only began a text stand among the trigrams too, as a context.
        own = np.union1d(ended, grams >> 8) if order == 2 else np.unique(ended)
        n = np.zeros((len(own), wide))
        np.add.at(n, np.searchsorted(own, ended), counts)
        contexts, total, distinct, ctx = _level(own.astype(np.uint64), n)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(distinct > 0, -np.log2(distinct / total), 0.0)
            seen = -np.log2(n / total[ctx])
        known[order] = (own, n, contexts, escape, seen, ctx)
    own, n, _, escape, seen, _ = known[0]
    single = np.repeat(8.0 + escape, 256, axis=0)
    single[own] = np.where(n > 0, seen, 8.0 + escape[0])
    own, n, contexts, escape, seen, ctx = known[1]
    after = np.zeros((256, wide))
    after[contexts.astype(np.int64)] = escape
    bigram = (after[:, None, :] + single[None, :, :]).reshape(65536, wide)
    bigram[own] = np.where(n > 0, seen, bigram[own])
    own2, n, contexts, escape, seen, ctx = known[2]
    escape2 = np.zeros((65536, wide))
    escape2[contexts.astype(np.int64)] = escape
    cost2 = np.where(n > 0, seen, escape[ctx] + bigram[own2 & 0xFFFF])
    own3, n, contexts, escape, seen, ctx = known[3]
    escape3 = np.zeros((len(own2), wide))
    escape3[np.searchsorted(own2, contexts.astype(own2.dtype))] = escape
    cost3 = np.where(n > 0, seen, escape[ctx] + cost2[np.searchsorted(own2, own3 & 0xFFFFFF)])
    costs = [x.astype(np.float32) for x in (bigram, escape2, cost2, escape3, cost3)]
    return Model(languages, costs[0], costs[1], own2.astype(np.uint32), *costs[2:4], own3.astype(np.uint32), costs[4])


def train(documents: DataFrame, rows_per_language: int = 1500) -> Model:
    """Learn from ``text`` and non-null ``lang`` of about ``rows_per_language`` rows of each language.

    The rows are those with the smallest id hashes, a share that makes the expected number the
    bound.  The counts come to the driver: at most the distinct four-byte grams of the sample.
    """
    rows = documents.filter(learnable(documents)).filter("lang is not null and text is not null")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        empty = np.zeros((0, 0), np.float32)
        return Model([], empty, empty, np.zeros(0, np.uint32), empty, empty, np.zeros(0, np.uint32), empty)
    place = F.pmod(F.xxhash64(rows["doc_id"].cast("string")), F.lit(1_000_000))
    chosen = None
    for name in languages:
        one = (F.col("lang") == name) & (place < int(1_000_000 * min(1.0, rows_per_language / sizes[name])))
        chosen = one if chosen is None else chosen | one
    number = {name: k for k, name in enumerate(languages)}

    def count(batches):
        for batch in batches:
            data, offsets = _lowered(batch.column("text"))
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            of_byte = np.repeat(lang, np.diff(offsets))
            for a in range(0, len(data), 1 << 20):
                b = min(a + (1 << 20), len(data))
                key = _grams(data, offsets, a, b).astype(np.int64) | of_byte[a:b] << 32
                key, n = np.unique(key, return_counts=True)
                yield pa.record_batch({"key": key, "n": n.astype(np.int64)})

    counted = (
        rows.filter(chosen).select("text", "lang").mapInArrow(count, "key long, n long")
        .groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    )
    key, n = counted.column("key").to_numpy(), counted.column("n").to_numpy()
    grams, of = np.unique(key & 0xFFFFFFFF, return_inverse=True)
    counts = np.zeros((len(grams), len(languages)))
    counts[of, key >> 32] = n
    return build(languages, grams, counts)


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of every text in every language."""
    n = len(offsets) - 1
    bits = np.zeros((n, len(model.languages)))
    places = model.places()
    for a in range(0, len(data), _PART):
        b = min(a + _PART, len(data))
        gram = _grams(data, offsets, a, b)
        at = _lookup(places.grams, model.grams, gram)
        cost = model.gram_cost[np.maximum(at, 0)] if len(model.grams) else np.zeros((b - a, len(model.languages)), np.float32)
        miss = np.flatnonzero(at < 0)
        if len(miss):
            rest = gram[miss]
            low = _lookup(places.trigrams, model.trigrams, rest & np.uint32(0xFFFFFF))
            part = model.escape2[(rest >> np.uint32(8)) & np.uint32(0xFFFF)] + model.bigram[rest & np.uint32(0xFFFF)]
            known = low >= 0
            part[known] = model.trigram_cost[low[known]]
            context = _lookup(places.trigrams, model.trigrams, rest >> np.uint32(8))
            known = context >= 0
            part[known] += model.escape3[context[known]]
            cost[miss] = part
        first, last = np.searchsorted(offsets, a, "right") - 1, np.searchsorted(offsets, b)
        cuts = np.maximum(offsets[first:last], a) - a
        full = np.flatnonzero(np.diff(np.append(cuts, b - a)))
        bits[first + full] += np.add.reduceat(cost.astype(np.float64), cuts[full], axis=0)
    return bits


def _hashed(keys: np.ndarray) -> np.ndarray:
    """Open-addressed places of ``keys``: a power of two of slots, each with an index or -1."""
    size = 1 << max(4, (4 * len(keys)).bit_length())
    slots = np.full(size, -1, np.int32)
    left, at = np.arange(len(keys)), _slot(keys, size)
    while len(left):
        free = slots[at] < 0
        slots[at[free]] = left[free]
        lost = slots[at] != left
        left, at = left[lost], (at[lost] + np.uint32(1)) & np.uint32(size - 1)
    return slots


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    return (keys * np.uint32(0x9E3779B1)) >> np.uint32(33 - size.bit_length())


def _lookup(slots: np.ndarray, known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of every key among ``known``, or -1."""
    if not len(known):
        return np.full(len(keys), -1, np.int32)
    at = _slot(keys, len(slots))
    index = slots[at]
    open_ = np.flatnonzero((index >= 0) & (known[index] != keys))
    while len(open_):
        at[open_] = (at[open_] + np.uint32(1)) & np.uint32(len(slots) - 1)
        index[open_] = slots[at[open_]]
        open_ = open_[(index[open_] >= 0) & (known[index[open_]] != keys[open_])]
    return index


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``lang_pred``, ``score`` and ``bits_per_byte``.

    ``score`` is the posterior of the predicted language under equal priors, at least 1 / languages.
    Null texts, texts without a letter, and all texts under a model without languages: ``und``, score 0
    and null bits.  Ties go to the first language in order of name.  Other columns pass through;
    columns of the three names are replaced.
    """
    taken = [c for c in documents.columns if c not in ("lang_pred", "score", "bits_per_byte")]
    rows = documents.select(*taken, documents["text"].rlike(r"\p{L}").alias("__letters"))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batches):
        frozen = shared.value
        for batch in batches:
            data, offsets = _lowered(batch.column("text"))
            ok = batch.column("__letters").fill_null(False).to_numpy(zero_copy_only=False)
            if frozen.languages:
                bits = code_lengths(frozen, data, offsets)
                best = bits.argmin(axis=1)
                least = bits[np.arange(len(best)), best]
                score = 1 / np.exp2(least[:, None] - bits).sum(axis=1)
                size = np.maximum(np.diff(offsets), 1)
            else:
                best, least, score, size, ok = *np.zeros((3, len(ok))), 1, np.zeros(len(ok), bool)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in taken],
                    pa.array(names[np.where(ok, best, len(names) - 1).astype(int)], pa.string()),
                    pa.array(np.where(ok, score, 0.0)),
                    pa.array(least / size, mask=~ok),
                ],
                [*taken, "lang_pred", "score", "bits_per_byte"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*taken).schema)
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, bits_per_byte double")
