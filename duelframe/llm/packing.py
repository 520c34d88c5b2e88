"""Packing pieces of documents into fixed-size sequences by fitted length patterns.

Patterns of one to four lengths that fill a sequence are enumerated from the length histogram. Their repeat counts
are fitted to it by non-negative least squares (an active set: no more patterns than lengths stay) and rounded to
the nearest count that the histogram still has. This is repeated on what remains, with patterns that may leave a
little room at last. The residual pieces go best-fit, by decreasing length, into the room of these sequences and
into new ones; some sequences of patterns with many pieces are released to them where that takes fewer sequences in
all. Only the histogram (at most ``size`` rows) and the plan made from it are on the driver; pieces find their
sequence by their rank among pieces of equal length.

Defined results: null text is an empty text (its piece is the end id alone); rows that repeat a doc_id are
packed each; an empty table gives an empty result; other columns are not read. Lengths too short for patterns of
few pieces to fill a sequence are residual pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.base import lean, materialize, ranked, small_batches
from duelframe.llm.token_cache import CachedEncoder

#: Lengths tried for the second place of a pattern of three pieces, and for the second and third of one of four.
SECOND, THIRD = 24, 8
#: Rounds of fitting: a pattern may leave one of so many parts of a sequence empty.
ROOM = (512, 512, 128)
#: Steps of a fit, the relative residual that ends it, and the least repeat count that is rounded up.
FIT_STEPS, FIT_RESIDUAL, LEAST_REPEATS = 60, 1e-3, 0.3
#: Shares of all pieces that are released from patterns, tried in turn; the first with the fewest sequences counts.
RELEASED = (0, 0.01, 0.02, 0.04)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, entries: int | None = None) -> DataFrame:
    """Cut each document's ids (and end id) into pieces of ``size``; a longer document's first may be shorter."""
    small_batches(docs.sparkSession)

    @lean
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, ids, at in CachedEncoder.get(tokenizer, entries).encode(batch.column(1)):
                rows = []
                for k in range(len(at) - 1):
                    own = np.append(ids[at[k] : at[k + 1]], np.uint32(end_id)).astype("<u4")
                    start, length = 0, len(own) % size or size
                    for piece in range(-(-len(own) // size)):
                        rows.append((names[first + k], piece, start, length, zlib.crc32(own[start : start + length])))
                        start, length = start + length, size
                columns = list(zip(*rows, strict=True))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def patterns(lengths: np.ndarray, size: int, spare: int) -> list[tuple[int, ...]]:
    """Patterns of one to four of these lengths, each in descending order, that leave at most ``spare`` of a sequence.

    The last piece is the longest that fits; those before it are the first and a spread of the shorter ones.
    """
    have = np.sort(lengths)
    found: set[tuple[int, ...]] = set()

    def spread(most: int, n: int) -> list[int]:
        k = int(np.searchsorted(have, most, "right"))
        return have[np.unique(np.linspace(0, k - 1, min(k, n)).astype(int))].tolist() if k else []

    def fill(first: tuple[int, ...]) -> None:
        room = size - sum(first)
        k = int(np.searchsorted(have, min(room, first[-1]), "right")) - 1
        if k >= 0 and room - have[k] <= spare:
            found.add((*first, int(have[k])))

    for a in map(int, have):
        if size - a <= spare:
            found.add((a,))
        fill((a,))
        for b in spread(min(a, size - a), SECOND):
            fill((a, b))
        for b in spread(min(a, size - a), THIRD):
            for c in spread(min(b, size - a - b), THIRD):
                fill((a, b, c))
    return sorted(found)


def fit_repeats(histogram: np.ndarray, found: list[tuple[int, ...]]) -> tuple[np.ndarray, float]:
    """Repeat counts x >= 0 that make the patterns' lengths match the histogram best, and the relative residual.

    Columns have unit length. A step takes in patterns with no length in common that would lower the residual most,
    solves for all that are in, and drops those below zero until none is.
    """
    n, m = len(found), len(histogram)
    key = np.repeat(np.arange(n), [len(p) for p in found]) * m + np.array([a for p in found for a in p], np.int64)
    key, times = np.unique(key, return_counts=True)
    owner, length = key // m, key % m
    norm = np.sqrt(np.bincount(owner, times.astype(float) ** 2, n))
    value, start = times / norm[owner], np.searchsorted(owner, np.arange(n + 1))
    scale = max(float(np.linalg.norm(histogram)), 1e-9)
    x, held = np.zeros(n), np.zeros(n, bool)
    best, fewest, failed = x, 1.0, 0
    place, columns, products = np.full(n, -1), np.zeros((m, 0)), np.zeros((0, 0))
    for _ in range(FIT_STEPS):
        rest = histogram - np.bincount(length, value * x[owner], m)
        residual = float(np.linalg.norm(rest)) / scale
        if residual < fewest - 1e-6:
            best, fewest, failed = x, residual, 0
        else:
            failed += 1
        gain = np.bincount(owner, rest[length] * value, n)
        gain[held] = 0
        top = gain.max(initial=0)
        if fewest < FIT_RESIDUAL or failed > 3 or top <= 1e-9 * scale:
            break
        least, room = top * (0.9 if failed else 0.1), max(int((histogram > 0).sum() - held.sum()), 1)
        used, new = np.zeros(m, bool), []
        for j in np.argsort(-gain, kind="stable"):
            if gain[j] <= least or len(new) >= room:
                break
            own = length[start[j] : start[j + 1]]
            if not used[own].any():
                used[own] = True
                new.append(j)
        fresh = [j for j in new if place[j] < 0]
        more = np.zeros((m, len(fresh)))
        for k, j in enumerate(fresh):
            own = slice(start[j], start[j + 1])
            more[length[own], k], place[j] = value[own], columns.shape[1] + k
        across = columns.T @ more
        products, columns = np.block([[products, across], [across.T, more.T @ more]]), np.hstack([columns, more])
        held[new] = True
        wanted, solved = columns.T @ histogram, np.zeros(0)
        while held.any():
            at = place[own := np.flatnonzero(held)]
            inner = products[np.ix_(at, at)]
            inner[np.diag_indices(len(at))] += 1e-9
            solved = np.linalg.solve(inner, wanted[at])
            if (solved > 0).all():
                break
            held[own[solved <= 0]] = False
        x = np.zeros(n)
        if held.any():
            x[own] = solved
    return best / norm, fewest


#: Sequences of a plan: the lengths in one, how many of them (the first) are a fitted pattern, and how many such sequences.
Made = list[tuple[tuple[int, ...], int, int]]


def fitted(left: np.ndarray, size: int) -> dict[tuple[int, ...], int]:
    """Patterns and how often each is used; their pieces are taken from ``left``."""
    used: dict[tuple[int, ...], int] = defaultdict(int)
    for part in ROOM:
        found = patterns(np.flatnonzero(left), size, size // part)
        if not found:
            continue
        x, _ = fit_repeats(left.astype(float), found)
        for j in np.argsort(-x, kind="stable"):
            if x[j] < LEAST_REPEATS:
                break
            repeats = Counter(found[j])
            n = min(max(1, int(x[j] + 0.5)), *(int(left[a]) // m for a, m in repeats.items()))
            if n > 0:
                for a, m in repeats.items():
                    left[a] -= n * m
                used[found[j]] += n
    return used


def plan(histogram: dict[int, int], size: int) -> Made:
    """Sequences that together hold exactly the histogram."""
    left = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    total = int(left.sum())
    used = fitted(left, size)
    made = []
    for share in RELEASED:
        rest, begun, free = left.copy(), {}, int(share * total)
        for p, n in sorted(used.items(), key=lambda x: (-len(x[0]), x[1], x[0])):
            k = min(n, free // len(p)) if len(p) > 1 else 0
            free -= k * len(p)
            for a in p:
                rest[a] += k
            begun[p] = n - k
        made.append(best_fit(rest, begun, size))
    return min(made, key=lambda m: sum(n for _, _, n in m))


def best_fit(left: np.ndarray, begun: dict[tuple[int, ...], int], size: int) -> Made:
    """Pieces (how many of each length are left) by decreasing length into the least room of sequences begun, and new ones."""
    bins: dict[int, dict[tuple[tuple[int, ...], int], int]] = defaultdict(lambda: defaultdict(int))
    for p, n in begun.items():
        if n:
            bins[size - sum(p)][p, len(p)] += n
    for a in map(int, np.flatnonzero(left)[::-1]):
        n = int(left[a])
        while n:
            room = min((r for r, held in bins.items() if r >= a and held), default=None)
            if room is None:
                each = size // a
                full, rest = divmod(n, each)
                if full:
                    bins[size - each * a][(a,) * each, 0] += full
                if rest:
                    bins[size - rest * a][(a,) * rest, 0] += 1
                break
            p, of = next(iter(bins[room]))
            take = min(n, bins[room][p, of])
            bins[room][p, of] -= take
            if not bins[room][p, of]:
                del bins[room][p, of]
            bins[room - a][(*p, a), of] += take
            n -= take
    return sorted((p, of, n) for held in bins.values() for (p, of), n in held.items() if n)


def slots(made: Made) -> pd.DataFrame:
    """For each length, runs of ranks and where they go: sequence = first + (rank - from), at offset; and whether in a pattern."""
    rows, used, first = [], defaultdict(int), 0
    for p, of, n in made:
        at = 0
        for k, a in enumerate(p):
            rows.append((a, used[a], first, at, k < of))
            used[a] += n
            at += a
        first += n
    return pd.DataFrame(rows, columns=["length", "from", "first", "at", "fitted"]).sort_values(["length", "from"], ignore_index=True)


def pack(docs: DataFrame, tokenizer: str, end_id: int, size: int = 1024, entries: int | None = None) -> DataFrame:
    """Place every piece of every document: adds sequence_id, offset and fitted (in a fitted pattern) to the pieces.

    ``entries``: chunks that a worker's tokenizer cache holds, where its usual size is too much beside other work.
    """
    cut = materialize(pieces(docs, tokenizer, end_id, size, entries), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan(histogram, size))
    begins, at = {}, 0
    for length in sorted(histogram):
        begins[length] = at
        at += histogram[length]
    key = table["length"].to_numpy(np.int64) * (1 << 42) + table["from"].to_numpy(np.int64)
    base = np.array([begins.get(k, 0) for k in range(size + 1)], np.int64)
    run_from, first, offset = (table[c].to_numpy(np.int64) for c in ("from", "first", "at"))
    by_fit = table["fitted"].to_numpy(bool)

    @lean
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        CachedEncoder.forget()  # workers that encoded would keep it for as long as they live
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank_"))
            rank = rank - base[length]
            k = np.searchsorted(key, length * (1 << 42) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(first[k] + rank - run_from[k]), pa.array(offset[k]), pa.array(by_fit[k])], [*batch.schema.names[:-1], "sequence_id", "offset", "fitted"])

    order, _ = ranked(cut, ["length", "doc_id", "piece", "ids_crc32"], "packed")
    names = [x.split()[0] for x in PIECES.split(", ")]
    return order.select(*names, "rank_").mapInArrow(place, PIECES + ", sequence_id long, offset long, fitted boolean")
