"""Vector codes, SimHash duplicates and hard negatives against plain Python, on odd and given rows."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from duelframe.llm import grid_codes, negatives, simhash

VECTORS = "vec_id long, embedding array<float>, label int, code string, id string, v int, `salt` int"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def vectors(n, width, seed, hot=0):
    """Rows with nulls, ties, repeats and ``hot`` copies of one vector."""
    rng = np.random.default_rng(seed)
    rows = [(k, rng.normal(0, 0.3, width).astype(np.float32).tolist(), int(rng.integers(0, 4)) if k % 11 else None) for k in range(n)]
    rows += [(n + k, rows[1][1], 1) for k in range(hot)] + [rows[2], rows[100 % n]]
    nan, inf = float("nan"), float("inf")
    rows += [(9001, None, 1), (9100, [], 1), (9200, [None] * width, 2), (9300, [nan] * width, 2), (9400, [inf] * width, 2), (9500, [0.0] * width, 1), (9600, [0.0] * width, 2), (None, [0.25] * width, 1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3, 7) for r in rows], VECTORS).repartition(5)


def whole(rows):
    return [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]


def plain_codes(rows, parts, entries, rounds):
    kept = sorted(whole(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    books = [[cut(v)[p] for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    near = lambda p, x: min((far(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        held = [defaultdict(list) for _ in range(parts)]
        for _, v, _ in kept:
            for p, x in enumerate(cut(v)):
                held[p][near(p, x)[1]].append(x)
        for p in range(parts):
            for k, xs in held[p].items():
                books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs, strict=True))
    out, total = [], defaultdict(int)
    for i, v, label in kept:
        found = [near(p, x) for p, x in enumerate(cut(v))]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        total[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, code, error, total[label], digest) for i, code, error, label in out), key=str)


@pytest.mark.parametrize(("n", "width", "parts", "entries", "hot"), [(150, 8, 4, 16, 60), (40, 6, 2, 64, 0), (3, 16, 16, 64, 0)])
def test_grid_codes(spark, n, width, parts, entries, hot):
    rows = vectors(n, width, n, hot)
    got = grid_codes.encode(frame(spark, rows), parts, entries)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_codes(rows, parts, entries, 2)


def test_grid_codes_of_odd_tables(spark):
    assert grid_codes.encode(frame(spark, [(1, None, 1)])).collect() == []
    assert grid_codes.encode(frame(spark, []).limit(0)).collect() == []
    with pytest.raises(Exception, match="components"):
        grid_codes.encode(frame(spark, [(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)])).collect()
    with pytest.raises(ValueError, match="divide"):
        grid_codes.encode(frame(spark, [(1, [0.5] * 5, 1)]))


@pytest.mark.parametrize("cells", [10, 100_000])
@pytest.mark.parametrize("edge", [1, 8, 64])
def test_cells_leave_out_only_dominated_entries(monkeypatch, cells, edge):
    """Also where cells collide, and where the cache starts anew; far fewer entries than all are evaluated."""
    rng = np.random.default_rng(3)
    books, rows = rng.integers(-60, 60, (3, 40, 2)), rng.integers(-90, 90, (700, 6))
    books[1, 5] = books[1, 9]
    far = ((rows.reshape(-1, 3, 1, 2) - books[None]) ** 2).sum(3)
    for hashed in (grid_codes.mix, lambda x: x % np.uint64(7)):
        monkeypatch.setattr(grid_codes, "mix", hashed)
        cache = grid_codes.CellCache(books, edge, cells)
        for _ in range(2):
            index, distance = cache.nearest(rows)
            assert (index == far.argmin(2)).all() and (distance == far.min(2)).all()
        assert edge == 64 or cache.evaluated < 0.5 * cache.asked * 40


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(rows):
    codes = sorted({c for _, c in rows})
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for k, a in enumerate(codes):
        for b in codes[k + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(b)] = find(a)
    least = {}
    for d, c in rows:
        if d is not None:
            least[find(c)] = min(least.get(find(c), d), d)
    return sorted(((d, f"{c:016x}", least.get(find(c))) for d, c in rows), key=str)


LONG = " ".join(f"w{k * 7 % 401}" for k in range(5000))
TEXTS = [
    (0, ""), (1, None), (2, " \t\x0b\x0c\r\n"), (3, "One"), (4, "ONE "), (5, "one two"), (6, "one\ttwo three"), (7, "ONE two\n\nTHREE"), (8, LONG), (9, LONG + " "), (10, LONG.upper()), (11, LONG + " more"), (8, LONG),
    (12, "x" * 30_000), (13, "É é x 日本 語。　x \u0085 🙂 \x1c y"), (None, "no id"), (None, LONG), (14, "no ID"), (15, "a b c d a b c d a b c d"), (16, " " * 50_000 + "a"),
]


@pytest.mark.parametrize("crowd", [64, 1])
@pytest.mark.parametrize("which", ["odd", "given"])
def test_simhash(spark, which, crowd):
    if which == "odd":
        docs = spark.createDataFrame([(d, t, 1, "c", 2) for d, t in TEXTS], "doc_id long, text string, code int, component string, salt int").repartition(3)
    else:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    assert sorted((tuple(r) for r in simhash.near_duplicates(docs, crowd).collect()), key=str) == plain_components(rows)


def test_simhash_steps(monkeypatch):
    """Texts over several slices and steps have the fingerprints of whole texts."""
    import pyarrow as pa

    texts = [t for _, t in TEXTS]
    want = [plain_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "STEP", 50)
    assert simhash.fingerprints(pa.array(texts, pa.string())).tolist() == want
    assert simhash.fingerprints(pa.array(texts, pa.string()).slice(8, 3)).tolist() == want[8:11]


@pytest.mark.parametrize("crowd", [1, 3, 64])
def test_simhash_links(spark, crowd):
    """Codes around a few centres, in every segment, at the edges of the sign, in crowds: the same components."""
    rng = np.random.default_rng(8)
    codes = {0, (1 << 64) - 1, 1 << 63, 1, 3}
    for centre in [0, (1 << 64) - 1, int(rng.integers(0, 1 << 62)), int(rng.integers(0, 1 << 62))]:
        for _ in range(60):
            flips = rng.choice(64, int(rng.integers(1, 5)), replace=False)
            codes.add(centre ^ sum(1 << int(b) for b in flips))
    rows = [(k, c) for k, c in enumerate(sorted(codes))]
    signed = [(c - (1 << 64) if c >> 63 else c,) for _, c in rows]
    edges = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.linked(spark.createDataFrame(signed, "code long"), crowd).collect()]
    assert all((a ^ b).bit_count() <= 2 and a != b for a, b in edges)
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in edges:
        root[find(a)] = find(b)
    least = {}
    for k, c in rows:
        least.setdefault(find(c), k)
    assert sorted(((k, f"{c:016x}", least[find(c)]) for k, c in rows), key=str) == plain_components(rows)


def plain_negatives(rows, every, positives, count):
    kept = [(i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, v) for i, v, label in whole(rows) if label is not None]
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a, kind, v in kept:
        if a is None or a % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w, strict=True)), i, label) for i, label, w in kept]
        same = sorted((s for s in scored if s[2] == kind and s[1] != a), key=order)[:positives]
        for p, positive, _ in same:
            rest = sorted((s for s in scored if s[2] != kind and 30 * p <= 100 * s[0] <= 90 * p), key=order)[:count]
            out += [(a, positive, k + 1, i, p, s) for k, (s, i, _) in enumerate(rest)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("n", "every", "hot", "group_bytes"), [(400, 20, 150, 1 << 20), (300, 10, 0, 4000), (30, 100, 0, 1 << 20)])
def test_hard_negatives(spark, n, every, hot, group_bytes):
    rows = vectors(n, 8, n + 1, hot)
    got = negatives.mine(frame(spark, rows), every, 5, 10, group_bytes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows, every, 5, 10)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and (want or n == 30)


def test_hard_negatives_of_odd_tables(spark):
    for rows in ([], [(0, None, 1)], [(0, [0.5] * 4, None)], [(0, [0.5] * 4, 1)], [(0, [0.0] * 4, 1), (1, [0.0] * 4, 2), (5, [0.0] * 4, 2)]):
        assert sorted((tuple(r) for r in negatives.mine(frame(spark, rows)).collect()), key=str) == plain_negatives(rows, 100, 5, 10)
    with pytest.raises(Exception, match="components"):
        negatives.mine(frame(spark, [(0, [0.5] * 16, 1), (1, [0.5] * 32, 1)])).collect()


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_bounds_hold_and_leave_out_rows(spread):
    """Every score lies within its bounds; where rows form narrow cones, most are never scored."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 100, (6, 12))
    rows = np.floor(np.repeat(centres, 200, 0) + rng.normal(0, 100 * spread, (1200, 12))).astype(np.int64)
    axes = negatives.references(rows[::5], 8)
    norms, angle = negatives.angles(rows, axes)
    kinds = rng.integers(0, 3, len(rows))
    asked = np.arange(0, len(rows), 50)
    none = np.full((len(asked), 1), negatives.NONE + 1), np.full((len(asked), 1), negatives.NO_ID)
    state = negatives.Anchors(asked, kinds[asked], rows[asked], norms[asked], angle[asked], *none, 5, True)
    for first in range(0, len(rows), 100):
        at = slice(first, first + 100)
        low, high = negatives.slice_bounds(norms[asked], angle[asked], norms[at], angle[at].T)
        for k, a in enumerate(asked):
            scores = rows[at] @ rows[a]
            least, most = negatives.score_bounds(norms[a], angle[a], norms[at], angle[at].T)
            assert (least <= scores).all() and (scores <= most).all() and low[k] <= scores.min() and scores.max() <= high[k]
        state.meet(np.arange(first, first + 100), kinds[at], rows[at], norms[at], angle[at])
    for k, a in enumerate(asked):
        other = [(-int(rows[i] @ rows[a]), i) for i in range(len(rows)) if i != a and kinds[i] == kinds[a]]
        assert state.found[k, 0].tolist() == [i for _, i in sorted(other)[:5]]
    if spread < 1:
        assert state.scored < 0.25 * state.pairs


def test_labels_move_at_sevens(spark):
    rows = frame(spark, [(7, [1.0], 9), (8, [1.0], 9), (14, [1.0], -5), (None, [1.0], 3)])
    assert {r["id"]: r["label"] for r in negatives.laid_out(rows, "vec_id", "embedding", "label").select("id", F.col("label")).collect()} == {7: 0, 8: 9, 14: -4, None: 3}
