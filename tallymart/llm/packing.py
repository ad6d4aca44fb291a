"""Token sequences packed by vector best-fit.

A piece of a document takes three resources of a sequence: tokens, a place among its documents, and
attention cost (the square of its length).  Pieces go in order of decreasing length; each goes to the
open sequence, among those in which all three fit, with the best score:

    ``dot``   the largest weighted dot product of the piece's and the sequence's residual resources
    ``norm``  the smallest weighted squared norm of what would be left over

Resources are shares of the capacity.  Without room anywhere, a new sequence is opened.

Pieces are dealt to groups by a hash of their id, checksum and place in the table; groups are packed
apart, each in one task, and hold about ``group_tokens`` tokens whatever the size of the corpus and
however often an id occurs.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm import words
from tallymart.llm.grouped import groups
from tallymart.llm.storage import trimmed

#: Chunks whose ids a worker keeps between tasks; about 45 MB.
_CACHE = 700_000
_SLOT_BITS = 21
_SLOTS = 1 << _SLOT_BITS
_PART = 1 << 21
#: New chunks that go to the tokenizer as one text; what it returns takes some 100 bytes a token.
_ONCE = 20_000


class WordTokenizer:
    """Ids of whole texts by a tokenizer that never joins across white space.

    Every distinct chunk between ASCII white space is encoded once by the tokenizer and kept under
    its hash, in an open-addressed table of ``_CACHE`` chunks; what does not fit is encoded again each
    time.  New chunks go to the tokenizer in long texts, parted by one of its special tokens.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [(k, t.content) for k, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not t.normalized]
        self.mark = max(special, default=None)
        self.keys = np.zeros(_SLOTS, np.uint64)
        self.places = np.full(_SLOTS, -1, np.int32)
        self.first, self.size = np.zeros((2, _CACHE), np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.held = self.used = 0

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each chunk among those held, or -1."""
        at = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        place = self.places[at]
        other = np.flatnonzero((place >= 0) & (self.keys[at] != hashes))
        while len(other):
            at[other] = (at[other] + 1) & (_SLOTS - 1)
            place[other] = self.places[at[other]]
            other = other[(place[other] >= 0) & (self.keys[at[other]] != hashes[other])]
        return place

    def _encoded(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, number of each chunk's)."""
        texts = [c.decode() for c in chunks]
        if self.mark is None or any("<" in t for t in texts):  # may hold a special token of its own
            found = [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            sizes = np.array([len(f) for f in found], np.int64)
            return np.concatenate([np.zeros(0, np.uint32), *[np.array(f, np.uint32) for f in found]]), sizes
        whole = self.tokenizer.encode_batch_fast([self.mark[1].join(texts)], add_special_tokens=False)[0]
        ids = np.array(whole.ids, np.uint32)
        marks = np.flatnonzero(ids == self.mark[0])
        sizes = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
        return np.delete(ids, marks), sizes

    def _new(self, hashes: np.ndarray, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes in another order, ids one after another, number of each chunk's)."""
        odd = np.array([b"<" in c for c in chunks], bool)
        order = np.argsort(odd, kind="stable")
        cut = len(chunks) - int(odd.sum())
        steps = [own[a : a + _ONCE] for own in (order[:cut], order[cut:]) for a in range(0, len(own), _ONCE)]
        parts = [self._encoded([chunks[k] for k in own]) for own in steps]
        return hashes[order], np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        own = np.arange(len(hashes)) + self.held
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.first[own] = self.used + np.cumsum(sizes) - sizes
        self.size[own] = sizes
        self.held += len(hashes)
        self.used += len(ids)
        at = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        while len(own):
            free = self.places[at] < 0
            self.places[at[free]], self.keys[at[free]] = own[free], hashes[free]
            lost = self.places[at] != own
            own, hashes, at = own[lost], hashes[lost], (at[lost] + 1) & (_SLOTS - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another; number of each text's)."""
        hashes, first, end, counts = words.word_hashes(data, offsets, words.NOT_SPACE, lower=False)
        place = self._find(hashes)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new, at = np.unique(hashes[missing], return_index=True)
            at = missing[at]
            chunks = [data[a:b].tobytes() for a, b in zip(first[at].tolist(), end[at].tolist())]
            new, own, own_sizes = self._new(new, chunks)
            if self.held + len(new) <= _CACHE:
                self._keep(new, own, own_sizes)
                place[missing] = self._find(hashes[missing])
                missing = missing[:0]
        known = np.flatnonzero(place >= 0)
        sizes = np.zeros(len(hashes), np.int64)
        sizes[known] = self.size[place[known]]
        if len(missing):  # the table is full of chunks seen earlier, mostly frequent ones; these serve this once
            order = np.argsort(new)
            used = order[np.searchsorted(new[order], hashes[missing])]
            sizes[missing] = own_sizes[used]
        starts = np.cumsum(sizes) - sizes
        ids = np.empty(int(sizes.sum()), np.uint32)
        ids[_spread(starts[known], sizes[known])] = self.ids[_spread(self.first[place[known]].astype(np.int64), sizes[known])]
        if len(missing):
            ids[_spread(starts[missing], sizes[missing])] = own[_spread((np.cumsum(own_sizes) - own_sizes)[used], sizes[missing])]
        doc = np.repeat(np.arange(len(counts)), counts)
        return ids, np.bincount(doc, sizes, minlength=len(counts)).astype(np.int64)


@lru_cache(1)
def _tokenizer(path: str) -> WordTokenizer:
    """One for all tasks of a worker, so that what it has learnt serves them all."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordTokenizer(path)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the ids of every document and ``end_id``, cut to ``capacity``.

    Only a document of more than ``capacity`` ids is cut.  ``ids`` holds little-endian unsigned 32-bit
    numbers.  A null or empty text is its end id alone.  Other columns are ignored; repeated rows are
    documents of their own.
    """

    def run(batches):
        from tallymart.llm import packing

        trimmed()  # of what other tasks of this worker left
        tokenizer = packing._tokenizer(tokenizer_path)  # that of the worker's own module
        for batch in batches:
            data, offsets = words.column_bytes(batch.column("text"))
            a, n = 0, len(offsets) - 1
            while a < n:
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _PART, "right")) - 1)
                part = data[offsets[a] : offsets[b]]
                ids, sizes = tokenizer.encode(part, offsets[a : b + 1] - offsets[a])
                at = np.cumsum(sizes)
                ids = np.insert(ids, at, end_id).astype("<u4")
                sizes = sizes + 1
                number = -(-sizes // capacity)
                doc = np.repeat(np.arange(b - a), number)
                piece = _spread(np.zeros(b - a, np.int64), number)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                ends = np.concatenate([[0], np.cumsum(length)]) * 4
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(a, b - a).take(pa.array(doc)),
                        "piece": pa.array(piece.astype(np.int32)),
                        "start": pa.array(start),
                        "length": pa.array(length),
                        "ids": pa.Array.from_buffers(
                            pa.large_binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(ids.tobytes())]
                        ).cast(pa.binary()),
                    }
                )
                a = b

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids binary"
    )


def best_fit(
    lengths: np.ndarray,
    capacity: int,
    max_documents: int,
    max_attention: int,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    score: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece, for pieces that each fit an empty sequence."""
    limit = np.array([capacity, max_documents, max_attention], float)
    weight = np.array(weights)
    sequence, offset = np.zeros((2, len(lengths)), np.int64)
    room = np.zeros((max(1, len(lengths)), 3))  # residuals of open sequences
    name = np.zeros(max(1, len(lengths)), np.int64)
    open_, made = 0, 0
    least = lengths.min(initial=capacity)
    for k in np.argsort(-lengths, kind="stable"):
        size = int(lengths[k])
        need = np.array([size, 1, size * size]) / limit
        if (need > 1 + 1e-12).any():
            raise ValueError(f"a piece of {size} tokens does not fit an empty sequence")
        left = room[:open_] - need
        value = (left * left) @ weight if score == "norm" else -(room[:open_] * need) @ weight
        value[(left < -1e-12).any(axis=1)] = np.inf
        at = int(value.argmin()) if open_ else -1
        if at < 0 or value[at] == np.inf:
            at = open_
            room[at], name[at] = 1.0, made
            open_, made = open_ + 1, made + 1
        sequence[k] = name[at]
        offset[k] = round((1 - room[at, 0]) * capacity)
        room[at] -= need
        full = room[at, 0] * capacity < least - 0.5 or room[at, 1] * max_documents < 0.5
        if full:  # nothing fits any more: the last open one takes its row
            open_ -= 1
            room[at], name[at] = room[open_], name[open_]
    return sequence, offset


def pack(
    rows: DataFrame,
    capacity: int = 4096,
    max_documents: int = 4096,
    max_attention: int = 4096 * 4096,
    group_tokens: int = 4_000_000,
    score: str = "norm",
) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``: pieces with a ``length`` packed into sequences.

    A sequence holds at most ``capacity`` tokens, ``max_documents`` pieces and ``max_attention``
    squared tokens; by default the last two never bind, as pieces have a token at least.  Rows need ``doc_id``, ``piece`` and ``length``, and should be a written table, as
    they are read twice; other columns pass through.  Repeated rows are packed each for itself; ties
    of length go by ``doc_id``, ``piece`` and arrival.  Sequence ids are unique, not consecutive.
    """
    total = rows.agg(F.sum("length")).first()[0] or 0
    count = max(1, -(-int(total) // group_tokens))
    taken = [c for c in rows.columns if c not in ("sequence_id", "offset")]
    # The row's place in the table parts rows that are alike in all else.
    known = [c for c in ("doc_id", "piece", "ids_crc32") if c in rows.columns]
    group = F.pmod(F.xxhash64(*known, F.monotonically_increasing_id()), F.lit(count))

    def run(batches):
        for table in groups(batches, "__group"):
            lengths = table.column("length").to_numpy()
            sequence, offset = best_fit(lengths, capacity, max_documents, max_attention, score=score)
            own = int(table.column("__group")[0].as_py()) << 32
            out = table.select(taken).append_column("sequence_id", pa.array(sequence + own))
            yield from out.append_column("offset", pa.array(offset)).to_batches()

    dealt = rows.select(*taken, group.alias("__group")).repartition("__group")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*taken).schema)
    ordered = dealt.sortWithinPartitions("__group", "doc_id", "piece")
    return ordered.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def with_checksum(rows: DataFrame) -> DataFrame:
    """``ids`` of pieces replaced by ``ids_crc32``."""
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
