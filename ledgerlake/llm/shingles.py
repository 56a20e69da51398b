"""Sets of word shingles, worked out in numpy over the bytes of whole Arrow batches.

A text's set holds a 64-bit hash of each distinct n-word shingle; a text with fewer words is
one shingle of its own kind; a null, empty or wordless text has an empty set. A class is 128
bits of hash over the set. Work goes in lots of bytes, so memory is bounded by LOT_BYTES and
by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import spread

#: Texts are taken in lots of about so many bytes.
LOT_BYTES = 500_000
#: Least tokens of a set that estimate its similarity to a leader; keys to find one by, each of so many least hashes.
SKETCH, KEYS, BAND = 16, 6, 3

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += np.uint8(32)
#: The first so many of eight bytes, read as a little-endian number.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[32, *range(9, 14)]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """x with its bits spread over all 64 (the finaliser of splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts of x."""
    return np.diff(np.r_[np.zeros(1, x.dtype), np.cumsum(x)][np.r_[0, ends]])


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in lower case, number of words of each text) of texts that end at these bytes."""
    starts = np.r_[0, ends[:-1]]
    some = ends > starts
    inside = _IN_WORD[data]
    before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
    before[starts[some]] = False
    after[ends[some] - 1] = False
    first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    # Eight bytes of a word at a time are mixed with their place in it, and a word's blocks are summed: nothing about the
    # blocks' values passes linearly into the sum.
    blocks = (last - first + 7) // 8
    ends_of = np.cumsum(blocks)
    nth = np.arange(ends_of[-1] if len(ends_of) else 0) - np.repeat(ends_of - blocks, blocks)
    at = np.repeat(first, blocks) + 8 * nth
    padded = np.r_[_LOWER[data], np.zeros(8, np.uint8)]
    eight = np.ndarray(len(data) + 1, np.dtype("<u8"), padded.data, strides=(1,))
    part = eight[at] & _FIRST[np.minimum(np.repeat(last, blocks) - at, 8)]
    hashes = mixed(_sums(mixed(part ^ mixed(nth.astype(np.uint64) * _STEP + _BASE)), ends_of) ^ (last - first).astype(np.uint64) * _STEP)
    return hashes, np.diff(np.searchsorted(first, np.r_[0, ends]))


def sets(data: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all sets, sorted in each; end of each set)."""
    w, count = words(data, ends)
    at = np.cumsum(count) - count
    out = np.zeros(int(np.where(count >= n, count - n + 1, count > 0).sum()), dtype=np.uint64)
    size = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    to = np.cumsum(size) - size
    for k in range(1, n + 1):
        # texts of exactly k words are one shingle of k; those of n or more have all of n
        of = np.flatnonzero(count >= n if k == n else count == k)
        if len(of):
            here = spread(at[of], size[of])
            h = np.full(len(here), k, dtype=np.uint64)
            for j in range(k):
                h = h * _STEP + w[here + j]
            out[spread(to[of], size[of])] = mixed(h)
    tokens = out.view(np.int64)
    for a, b in zip(to[size > 1].tolist(), (to + size)[size > 1].tolist()):
        tokens[a:b].sort()
    fresh = np.r_[True, tokens[1:] != tokens[:-1]][: len(tokens)]
    fresh[to[size > 0]] = True
    return tokens[fresh], np.r_[0, np.cumsum(fresh)][to + size]


def classes(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of each set's class."""
    t = tokens.view(np.uint64)
    return tuple(_sums(mixed(t * _BASE ^ seed), ends).view(np.int64) for seed in (_STEP, _BASE))


def lots(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, end of each text in them) of a batch without nulls."""
    if not len(texts):
        return
    texts = texts.cast(pa.large_string())
    _, where, raw = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + LOT_BYTES, side="right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a + 1 : b + 1] - offsets[a]
        a = b


def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(values, pa.int64()))


def first_of_each(tokens: np.ndarray, ends: np.ndarray, most: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of each part, at most so many, and the new ends."""
    size = np.diff(np.r_[0, ends])
    take = np.minimum(size, most)
    return tokens[spread(ends - size, take)], np.cumsum(take)


def keys(tokens: np.ndarray, ends: np.ndarray) -> pa.Array:
    """KEYS hashes of each set, each over the least hashes by BAND seeds; none for an empty set."""
    size = np.diff(np.r_[0, ends])
    some = np.flatnonzero(size)
    start, t = (ends - size)[some], tokens.view(np.uint64)
    bands = np.zeros((len(some), KEYS), dtype=np.uint64)
    for k in range(KEYS * BAND if len(some) else 0):
        least = np.minimum.reduceat(mixed(t ^ np.uint64(int(_STEP) * (2 * k + 3) % 2**64)), start)
        bands[:, k // BAND] = mixed(bands[:, k // BAND] * _BASE + least)
    return lists(bands.reshape(-1).view(np.int64), np.cumsum(np.where(size > 0, KEYS, 0)))
