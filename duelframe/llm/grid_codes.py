"""Vector codes of sub-codebooks, with the nearest entries found through memoised grid cells.

A vector of whole numbers is cut into equal parts; each part gets the index of its nearest codebook entry. A part
falls into a coarse cell of a grid. For a cell that is met for the first time, every entry's least and greatest
distance to the cell's box is taken: an entry whose least distance exceeds another's greatest is dominated
everywhere in the box. The rest is remembered under the hash of the cell (whose coordinates are kept and compared,
so that equal hashes do no harm), and only those entries are evaluated for parts that fall there.

Codebooks start from the first rows by id and are refined by rounds of assignment and averaging: tasks add up sums
and counts of their own rows, and only sums by (part, entry, place) meet. What the driver holds is the codebooks.

Defined results: rows whose vector is null, empty, or has null or non-finite components are dropped; a null label
is a label of its own; null ids come after all others; rows that share an id are ordered by their components and
count each; with fewer rows than entries there are as many entries as rows; an empty table gives an empty result;
vectors of different widths, or of a width that the parts don't divide, are an error; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.base import lean, materialize
from duelframe.llm.shingles import mix
from duelframe.llm.vectors import SCALE, complete, matrix, scaled

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Edge of a grid cell, in scaled units; cells that a worker remembers before it starts anew.
CELL, CELLS = 32, 200_000
#: Parts of vectors that one step evaluates.
STEP = 1 << 15
#: Rows of one label are dealt to so many joins with their label's sum.
SALTS = 16


class CellCache:
    """Nearest entries of the parts of vectors; ``books``: parts x entries x width."""

    def __init__(self, books: np.ndarray, cell: int = CELL, cells: int = CELLS):
        self.books, self.cell, self.cells = books, cell, cells
        self.evaluated = self.asked = 0
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.place = np.zeros((0, self.books.shape[2] + 1), np.int64)
        self.flat, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _candidates(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For cells (part, coordinates): entries that no other dominates in the box, one after the other, and counts."""
        flats, counts = [], []
        for k in range(0, len(place), 1024):
            own = place[k : k + 1024]
            low = (own[:, 1:] * self.cell)[:, None, :]
            high = low + self.cell - 1
            entry = self.books[own[:, 0]]
            nearest = (np.maximum(np.maximum(low - entry, entry - high), 0) ** 2).sum(2)
            farthest = (np.maximum(np.abs(entry - low), np.abs(entry - high)) ** 2).sum(2)
            keep = nearest <= farthest.min(1)[:, None]
            flats.append(np.nonzero(keep)[1])
            counts.append(keep.sum(1))
        return np.concatenate(flats), np.concatenate(counts)

    def _slots(self, place: np.ndarray) -> np.ndarray:
        """The remembered slot of each (part, coordinates)."""
        key = np.zeros(len(place), np.uint64)
        for k in range(place.shape[1]):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + place[:, k].astype(np.uint64))
        keys, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        if len(self.place) + len(keys) > self.cells:
            self._forget()
        names = keys.tolist()
        new = [k for k, name in enumerate(names) if name not in self.slot]
        if new:
            self._learn(place[first[new]], [names[k] for k in new])
        slots = np.fromiter(map(self.slot.__getitem__, names), np.int64, len(names))[inverse]
        other = np.flatnonzero((self.place[slots] != place).any(1))
        if len(other):  # another cell with the same hash: a slot of its own, not remembered
            cells, back = np.unique(place[other], axis=0, return_inverse=True)
            slots[other] = len(self.place) + back.ravel()
            self._learn(cells, [])
        return slots

    def _learn(self, place: np.ndarray, names: list[int]) -> None:
        flat, counts = self._candidates(place)
        self.slot.update(zip(names, range(len(self.place), len(self.place) + len(names)), strict=True))
        self.place = np.concatenate([self.place, place])
        self.flat = np.concatenate([self.flat, flat])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(counts)])

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row: the nearest entry of each part (ties to the lower index), and its squared distance."""
        parts, _, width = self.books.shape
        index, distance = np.zeros((len(rows), parts), np.int64), np.zeros((len(rows), parts), np.int64)
        step = max(1, STEP // parts)
        for k in range(0, len(rows), step):
            values = rows[k : k + step].reshape(-1, width)
            part = np.tile(np.arange(parts), len(values) // parts)
            slots = self._slots(np.column_stack([part, values // self.cell]))
            count = self.at[slots + 1] - self.at[slots]
            begin = np.concatenate([[0], np.cumsum(count)[:-1]])
            owner = np.repeat(np.arange(len(values)), count)
            entry = self.flat[np.arange(len(owner)) - begin[owner] + self.at[slots][owner]]
            far = ((values[owner] - self.books[part[owner], entry]) ** 2).sum(1)
            best = np.minimum.reduceat(far, begin)
            first = np.minimum.reduceat(np.where(far == best[owner], entry, np.iinfo(np.int64).max), begin)
            index[k : k + step], distance[k : k + step] = first.reshape(-1, parts), best.reshape(-1, parts)
            self.evaluated, self.asked = self.evaluated + len(owner), self.asked + len(values)
        return index, distance


def first_codebooks(kept: DataFrame, parts: int, entries: int) -> np.ndarray:
    """parts x entries x width, from the rows with the smallest ids."""
    rows = kept.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    if not rows:
        return np.zeros((parts, 0, 0), np.int64)
    width = len(rows[0]["v"])
    if width % parts:
        raise ValueError(f"{parts} parts don't divide vectors of {width} components")
    whole = matrix(pa.array([r["v"] for r in rows], pa.list_(pa.int64())), width)
    return np.ascontiguousarray(whole.reshape(len(rows), parts, width // parts).transpose(1, 0, 2))


def refined(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry becomes the floor of its parts' mean."""
    parts, entries, width = books.shape
    shared = kept.sparkSession.sparkContext.broadcast(books)

    @lean
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, cells = CellCache(shared.value), parts * entries
        total, count = np.zeros((cells, width), np.int64), np.zeros(cells, np.int64)
        for batch in batches:
            rows = matrix(batch.column(0), parts * width)
            index, _ = cache.nearest(rows)
            at = (index + np.arange(parts) * entries).ravel()
            values = rows.reshape(-1, width)
            count += np.bincount(at, minlength=cells)
            for w in range(width):  # a batch's sums are far below 2^53, so exact as doubles
                total[:, w] += np.bincount(at, values[:, w], cells).astype(np.int64)
        used = np.repeat(np.flatnonzero(count), width)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.tile(np.arange(width), int((count > 0).sum()))), pa.array(total[count > 0].ravel()), pa.array(count[used])], ["cell", "place", "total", "n"])

    some = kept.select("v").mapInArrow(sums, "cell long, place long, total long, n long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))  # noqa: E731  sums of all rows may exceed 64 bits
    out = books.copy()
    for r in some.groupBy("cell", "place").agg(exact("total").alias("total"), exact("n").alias("n")).collect():
        out[r["cell"] // entries, r["cell"] % entries, r["place"]] = int(r["total"]) // int(r["n"])
    return out


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def assigned(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every row: two hex digits a part, and the summed squared distance."""
    parts, entries, width = books.shape
    shared = kept.sparkSession.sparkContext.broadcast(books)
    digits = [f"{k:02x}" for k in range(entries)]
    label_type = kept.schema["label"].dataType.simpleString()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = CellCache(shared.value)
        for batch in batches:
            index, far = cache.nearest(matrix(batch.column(2), parts * width))
            codes = ["".join([digits[k] for k in row]) for row in index.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(far.sum(1))], ["id", "label", "code", "error"])

    return kept.select("id", "label", "v").mapInArrow(run, f"id long, label {label_type}, code string, error long")


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row with a whole vector."""
    if not 0 < entries <= 256:
        raise ValueError("a part's code has two hex digits: 1 to 256 entries")
    whole = vectors.filter(complete(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), scaled(vector_col).alias("v"))
    kept = materialize(whole, "vectors")
    books = first_codebooks(kept, parts, entries)
    if not books.shape[1]:
        return kept.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    for _ in range(rounds):
        books = refined(kept, books)
    coded = materialize(assigned(kept, books), "codes")
    # a label may have most rows: its rows are dealt to SALTS keys, each with a copy of the (one) sum
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = materialize(totals, "totals").select(F.col("label").alias("label_"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_"))
    dealt = coded.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    out = dealt.join(totals, F.col("label").eqNullSafe(F.col("label_")) & (F.col("salt") == F.col("salt_")))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _rounds_sql() -> str:
    """Codebooks c0 to c2 and the assignments between them."""
    out = []
    for r in range(ROUNDS + 1):
        out.append(f"""
n{r} AS (SELECT vec_id, label, p, v, e, dist FROM (SELECT s.*, c.e, list_sum(list_transform(list_zip(s.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist FROM s JOIN c{r} c USING (p))
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY dist, e) = 1)""")
        if r < ROUNDS:
            out.append(f"""
m{r} AS (SELECT p, e, list(floor(total::DOUBLE / n)::BIGINT ORDER BY w) AS v FROM (SELECT p, e, w, sum(x)::HUGEINT AS total, count(*) AS n FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS w FROM n{r}) GROUP BY ALL) GROUP BY p, e),
c{r + 1} AS (SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (p, e))""")
    return ",".join(out)


#: The same by brute force: every part against every entry, ids distinct as in the given tables.
ORACLE_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS v FROM k, range({PARTS}) t(p)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < {ENTRIES}),
c0 AS (SELECT p, e, v FROM s JOIN f USING (vec_id)),{_rounds_sql()},
code AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM n{ROUNDS} GROUP BY ALL),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM code, books
"""
