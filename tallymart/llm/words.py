"""Word and shingle hashes of whole Arrow columns of text, with numpy.

Texts are taken as UTF-8 bytes.  A null text is an empty one.  Work arrays cover one segment of
bytes at a time, so a very long text costs memory for its word hashes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 19
_SEED = np.random.default_rng(20240117)
_BYTE = _SEED.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _SEED.integers(1, 2**64, 64, dtype=np.uint64) | np.uint64(1)

#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of ``[^\x20\x09-\x0D]``.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``, for lower-cased text.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, cache: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006
    while len(cache[0]) < n:
        step = cache[0][-1:] * _FACTOR
        cache[0] = np.concatenate([cache[0], cache[0] * step])
    return cache[0]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; offsets has one entry more than rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    binary = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(binary.type) or pa.types.is_large_binary(binary.type)
    _, places, data = binary.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[binary.offset : binary.offset + len(binary) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _segments(data: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data):
            gaps = np.flatnonzero(~word[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(end + SEGMENT, len(data))
        yield at, end
        at = end


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, word: np.ndarray, lower: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, end byte) of every word, and the number of words of every text."""
    hashes, firsts, ends = [], [], []
    bounds = np.unique(offsets)
    for a, b in _segments(data, word):
        part = LOWER[data[a:b]] if lower else data[a:b]
        flag = word[part]
        edge = bounds[np.searchsorted(bounds, a) : np.searchsorted(bounds, b)] - a
        first = flag.copy()
        first[1:] &= ~flag[:-1]
        first[edge] = flag[edge]
        first = np.flatnonzero(first)
        if not len(first):
            continue
        last = flag.copy()
        last[:-1] &= ~flag[1:]
        inner = edge[edge > 0] - 1
        last[inner] = flag[inner]
        end = np.flatnonzero(last) + 1
        size = end - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        place = at - np.repeat(first, size)
        value = _BYTE[part[at]] * _powers(int(size.max()))[place]
        hashes.append(mix(np.add.reduceat(value, np.concatenate([[0], np.cumsum(size)[:-1]])) + size.astype(np.uint64)))
        firsts.append(first + a)
        ends.append(end + a)
    if not hashes:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets) - 1, np.int64)
    first = np.concatenate(firsts)
    counts = np.diff(np.searchsorted(first, offsets))
    return np.concatenate(hashes), first, np.concatenate(ends), counts


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of several, in which their order counts."""
    total = np.zeros(len(parts[0]), np.uint64) + np.uint64(len(parts))
    for place, part in enumerate(parts):
        total += part * _PLACE[place]
    return mix(total)


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes, text after text, and the number of each text's.

    A text of fewer words than ``width`` has its whole sequence as its one shingle; a text without
    words has none.
    """
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    if len(hashes) >= width:
        n = len(hashes) - width + 1
        all_ = combine(*[hashes[j : j + n] for j in range(width)])
    else:
        all_ = np.zeros(0, np.uint64)
    parts, sizes = [], np.zeros(len(counts), np.int64)
    for k, count in enumerate(counts.tolist()):
        a = int(starts[k])
        if count >= width:
            own = np.sort(all_[a : a + count - width + 1])
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif count:
            own = combine(*[hashes[a + j : a + j + 1] for j in range(count)])
        else:
            continue
        parts.append(own)
        sizes[k] = len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), sizes
