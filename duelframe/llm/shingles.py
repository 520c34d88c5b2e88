"""Hashes of words and of word shingles, for all texts of an Arrow batch at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from duelframe.llm.base import slices, utf8_buffers

SLICE = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, BASE, np.uint64)
    down = np.full(n, np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def words(raw: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased. documents: their first bytes."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[documents] = edge[-1] = True
    begin = ~space
    begin[1:] &= space[:-1] | edge[1:-1]
    stop = ~space
    stop[:-1] &= space[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SLICE, "right")))
        at = starts[first]
        own = LOWER[raw[at : ends[last - 1]]].astype(np.uint64) + np.uint64(1)
        up, down = _powers(1 << max(21, int(len(own)).bit_length()))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * up[: len(own)])])
        s, e = starts[first:last] - at, ends[first:last] - at
        out[first:last] = mix((total[e] - total[s]) * down[s])
        first = last
    return out, starts


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, and the n + 1 offsets of each document's.

    A document with fewer words than ``size`` has its whole sequence as one shingle.
    """
    step = np.uint64(0xD6E8FEB86659FD93)
    values, owners = [], []
    if len(h) >= size:
        s = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            s = (s + h[k : len(h) - size + 1 + k]) * step
        same = doc[: len(s)] == doc[size - 1 :]
        values.append(mix(s[same]))
        owners.append(doc[: len(s)][same])
    count = np.bincount(doc, minlength=n_docs)
    begin = np.concatenate([[0], np.cumsum(count)])
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        s = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            more = count[short] > k
            s[more] = (s[more] + h[begin[short[more]] + k]) * step
        values.append(mix(s + count[short].astype(np.uint64)))
        owners.append(short)
    if not values:
        return np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    v, d = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((v, d))
    v, d = v[order], d[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    v, d = v[new], d[new]
    return v, np.concatenate([[0], np.cumsum(np.bincount(d, minlength=n_docs))])


def word_slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first document, documents, bytes, their offsets, word hashes, each word's document) by slices."""
    raw, offsets = utf8_buffers(texts)
    for first, last in slices(offsets, SLICE):
        at = offsets[first : last + 1]
        own, at = raw[at[0] : at[-1]], at - at[0]
        h, starts = words(own, at[:-1][np.diff(at) > 0])
        yield first, last - first, own, at, h, np.searchsorted(at, starts, "right") - 1


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, shingle hashes, offsets) by slices of the documents."""
    for first, n, _, _, h, doc in word_slices(texts):
        yield (first, *shingles(h, doc, n, size))
