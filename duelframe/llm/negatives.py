"""Hard negatives by angular triangle filtering.

Each row keeps its norm and its angles to a few reference directions. By the triangle inequality of angles, the
angle of an anchor and a row lies between the largest difference of their angles to a reference and the smallest
sum (or what the sum lacks of a full turn). The cosines of both ends, times both norms and with room for rounding,
bound the integer score. Only rows whose bounds meet what is still wanted get their integer score: for positives
the scores from the least that would count among the best so far, for negatives the windows of scores that the
anchor's positives leave open. The same bounds are taken first for a whole slice of rows, which are laid out by
label and nearest reference, so that slices are narrow.

Anchors are a stated query set. They go to the rows in groups of at most GROUP_BYTES; every task keeps its best few
rows for each anchor of the group, and these meet by anchor.

Defined results: rows with a null label or without a whole vector (null, empty, null or non-finite components)
take no part; a null id can't be an anchor and comes last among equal scores; rows with the anchor's own id are not
its positives; repeated rows count each, also as anchors; an anchor without positives, or a positive without
negatives, has no row; an empty table gives an empty result; vectors of different widths are an error; other
columns are not read. Ids are below 2^63 - 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.base import lean, materialize
from duelframe.llm.vectors import complete, matrix, scaled

POSITIVES, NEGATIVES, EVERY = 5, 10, 100
#: A negative's score is from LOW to HIGH hundredths of the positive's.
LOW, HIGH = 30, 90
#: References, and the rows (with the smallest hashes) that they are chosen from.
REFERENCES, SAMPLE = 8, 256
#: Rows of a slice that is bounded as one; bytes of anchors that go to the rows at once.
SLICE, GROUP_BYTES = 2048, 32 << 20
#: Room for the rounding of stored angles and cosines: both are right to far more digits.
SLACK = 1e-6
NO_ID, NONE = np.iinfo(np.int64).max, -np.iinfo(np.int64).max


def angles(rows: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references (of unit length); a row of zeros has angles zero."""
    values = rows.astype(np.float64)
    norms = np.sqrt((values**2).sum(1))
    cosines = np.clip(values @ references.T / np.maximum(norms, 1)[:, None], -1, 1)
    return norms, np.where(norms[:, None] > 0, np.arccos(cosines), 0)


def references(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` directions of the sample, each the farthest from those before it."""
    values = sample[(sample != 0).any(1)].astype(np.float64)
    if not len(values):
        return np.zeros((0, sample.shape[1] if sample.ndim == 2 else 0))
    values /= np.sqrt((values**2).sum(1))[:, None]
    picked, nearest = [0], values @ values[0]
    while len(picked) < min(most, len(values)) and nearest.min() < 1 - 1e-9:
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, values @ values[picked[-1]])
    return values[picked]


def score_bounds(norm: float, angle: np.ndarray, norms: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of an anchor with rows; turned: references x rows."""
    far = turned + angle[:, None]
    least = np.abs(turned - angle[:, None]).max(0, initial=0)
    greatest = np.minimum(far, 2 * np.pi - far).min(0, initial=np.pi)
    both = norm * norms
    return both * (np.cos(greatest) - SLACK) - 1, both * (np.cos(least) + SLACK) + 1


def slice_bounds(norm: np.ndarray, angle: np.ndarray, norms: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each anchor with any of the rows."""
    low, high = turned.min(1), turned.max(1)
    least = np.maximum(angle - high, low - angle).max(1, initial=0)
    ends = [np.minimum(s, 2 * np.pi - s) for s in (angle + low, angle + high)]
    opposite = (angle + low <= np.pi) & (angle + high >= np.pi)
    greatest = np.where(opposite, np.pi, np.maximum(*ends)).min(1, initial=np.pi)
    spans = norm[:, None] * np.array([norms.min(), norms.max()])
    return (spans * (np.cos(greatest) - SLACK)[:, None]).min(1) - 1, (spans * (np.cos(least) + SLACK)[:, None]).max(1) + 1


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k by higher score, then smaller id."""
    if len(scores) > k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class Anchors:
    """Anchors of a group and the best rows met so far: for each of their windows (low, high) the first k in it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, norm: np.ndarray, angle: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.rows, self.norm, self.angle, self.low, self.high, self.k, self.same = ids, labels, rows, norm, angle, low, high, k, same
        self.scores = np.full((*low.shape, k), NONE, np.int64)
        self.found = np.full((*low.shape, k), NO_ID, np.int64)
        self.values = rows.astype(np.float64)
        self.scored = self.pairs = 0

    def _wanted(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor that could still count; windows without a score are empty."""
        least = np.where(self.low <= self.high, np.maximum(self.low, self.scores[:, :, -1]), NO_ID)
        return least.min(1, initial=NO_ID), np.where(self.low <= self.high, self.high, NONE).max(1, initial=NONE)

    def meet(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, norms: np.ndarray, angle: np.ndarray) -> None:
        """Meet a slice of rows."""
        turned, values = np.ascontiguousarray(angle.T), rows.astype(np.float64)
        low, high = slice_bounds(self.norm, self.angle, norms, turned)
        least, most = self._wanted()
        go = (high >= least) & (low <= most)
        kinds = np.unique(labels)
        go &= np.isin(self.labels, kinds) if self.same else ~((len(kinds) == 1) & (self.labels == kinds[0]))
        self.pairs += len(self.ids) * len(ids)
        for a in np.flatnonzero(go).tolist():
            other = (labels == self.labels[a]) == self.same
            if self.same:
                other &= ids != self.ids[a]
            low, high = score_bounds(self.norm[a], self.angle[a], norms, turned)
            floor = least[a]
            if self.same and int(other.sum()) >= self.k:  # so many score at least this
                floor = max(floor, np.partition(low[other], -self.k)[-self.k])
            at = np.flatnonzero(other & (high >= floor) & (low <= most[a]))
            if not len(at):
                continue
            self.scored += len(at)
            exact = self.norm[a] * norms[at].max() < 1 << 52  # products and sums are whole doubles
            scores = (values[at] @ self.values[a]).astype(np.int64) if exact else rows[at] @ self.rows[a]
            for w in range(self.low.shape[1]):
                inside = (scores >= max(self.low[a, w], self.scores[a, w, -1])) & (scores <= self.high[a, w])
                if inside.any():
                    merged = np.concatenate([self.scores[a, w], scores[inside]]), np.concatenate([self.found[a, w], ids[at[inside]]])
                    self.scores[a, w], self.found[a, w] = best(*merged, self.k)

    def results(self) -> tuple[np.ndarray, ...]:
        """(anchor, window, id, score) of all that was found."""
        a, w, _ = at = np.nonzero(self.scores != NONE)
        return a, w, self.found[at], self.scores[at]


def laid_out(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v, norm, angles) of the rows that take part, ordered by label and nearest reference."""
    spark, label, own = vectors.sparkSession, F.col(label_col).cast("long"), F.col(id_col).cast("long")
    shifted = F.when(own % 7 == 0, (label + 1) % 10).otherwise(label)
    taking = vectors.filter(label.isNotNull() & complete(vector_col)).select(own.alias("id"), shifted.alias("label"), F.transform(scaled(vector_col), lambda x: x.cast("int")).alias("v"))
    some = [r["v"] for r in taking.orderBy(F.xxhash64("id"), "v").limit(SAMPLE).collect()]
    width = len(some[0]) if some else 0
    axes = references(matrix(pa.array(some, pa.list_(pa.int32())), width), REFERENCES) if some else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(axes)

    @lean
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms, turned = angles(matrix(batch.column(2), width), shared.value.reshape(-1, width))
            near = turned.argmin(1) if turned.shape[1] else np.zeros(len(norms), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms), pa.array(list(turned), pa.list_(pa.float64())), pa.array(near), pa.array(turned.min(1, initial=9))], ["id", "label", "v", "norm", "angles", "near", "angle"])

    measured = taking.mapInArrow(measure, "id long, label long, v array<int>, norm double, angles array<double>, near long, angle double")
    order = ["label", "near", "angle", "id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return materialize(measured.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("near", "angle"), "laid-out")


def _arrays(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """ids (NO_ID for null), labels, rows, norms, angles."""
    if isinstance(table, pa.Table):
        table = table.combine_chunks()
    ids = table.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column("id").fill_null(NO_ID).to_numpy()
    pick = lambda c: x.chunk(0) if isinstance(x := table.column(c), pa.ChunkedArray) else x
    v, turned = pick("v"), pick("angles")
    width, axes = len(v[0]), len(turned[0])
    return ids, pick("label").to_numpy(zero_copy_only=False), matrix(v, width), pick("norm").to_numpy(zero_copy_only=False), turned.flatten().to_numpy(zero_copy_only=False).reshape(len(v), axes)


def searched(rows: DataFrame, group: pa.Table, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> DataFrame:
    """(anchor, w, id, score): each task's first k rows of every window; anchor: its place in the group."""
    shared = rows.sparkSession.sparkContext.broadcast((*_arrays(group), low, high))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, own, norm, angle, low, high = shared.value
        state = Anchors(ids, labels, own, norm, angle, low, high, k, same)
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                state.meet(*_arrays(batch.slice(first, SLICE)))
        a, w, found, scores = state.results()
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(w.astype(np.int32)), pa.array(found, mask=found == NO_ID), pa.array(scores)], ["anchor", "w", "id", "score"])

    return rows.mapInArrow(run, "anchor int, w int, id long, score long")


def first_of_each(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of every (anchor, w), with their rank; each task brought k at most."""
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine_group(rows: DataFrame, group: pa.Table, positives: int, negatives: int) -> DataFrame:
    """The result's rows for one group of anchors, written."""
    n = group.num_rows
    everything = np.full((n, 1), NONE + 1), np.full((n, 1), NO_ID)
    chosen = first_of_each(searched(rows, group, *everything, positives, True), positives).select("anchor", (F.col("rank") - 1).alias("w"), "id", "score").toArrow()
    at = tuple(chosen.column(c).to_numpy() for c in ("anchor", "w"))
    score = chosen.column("score").to_numpy()
    low, high = np.full((n, positives), 1, np.int64), np.zeros((n, positives), np.int64)
    # 100 * negative from LOW to HIGH times the positive, in whole numbers
    low[at], high[at] = -((-LOW * score) // 100), HIGH * score // 100
    names = pa.table({"anchor": chosen.column("anchor"), "w": chosen.column("w"), "anchor_id": group.column("id").take(chosen.column("anchor")), "positive_id": chosen.column("id"), "positive_score": chosen.column("score")})
    spark = rows.sparkSession
    found = first_of_each(searched(rows, group, low, high, negatives, False), negatives)
    named = found.join(F.broadcast(spark.createDataFrame(names)), ["anchor", "w"])  # positives of one group: bounded like it
    return materialize(named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "mined")


def mine(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, group_bytes: int = GROUP_BYTES, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, for rows whose id is divisible by ``every``."""
    rows = laid_out(vectors, id_col, vector_col, label_col)
    asked = materialize(rows.filter(F.col("id") % every == 0), "anchors")
    n, size = asked.agg(F.count("*"), F.sum(8 * (F.size("v") + F.size("angles") + 4 + 3 * positives * (negatives + 1)))).first()
    groups = -(-(size or 0) // group_bytes)
    while groups > 1:  # dealt by hash of place and id; each group's size is checked
        of = F.pmod(F.xxhash64("id", "v"), F.lit(groups))
        if asked.groupBy(of.alias("g")).agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] * size <= group_bytes * n or groups >= n:
            break
        groups *= 2
    parts = [mine_group(rows, part, positives, negatives) for g in range(groups) if (part := (asked.filter(of == g) if groups > 1 else asked).toArrow()).num_rows]
    if not parts:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return reduce(DataFrame.unionByName, parts)


#: The same by brute force over all pairs of an anchor and a row; ids are distinct in the given tables.
ORACLE_SQL = f"""
WITH k AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS a, r.id AS b, a.label = r.label AS same, list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2]))::BIGINT AS score FROM k a JOIN k r ON a.id % {EVERY} = 0 AND a.id != r.id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES})
SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b))::INT AS rank, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score
QUALIFY rank <= {NEGATIVES}
"""
