"""Gradient-boosted trees for several classes at once (softmax), from histograms of binned features.

Features are binned once by quantiles of the training rows. Each round grows one tree a class: every pass over the
rows sums gradients, curvatures and counts by (class, leaf, feature, bin), at most a few thousand cells whatever the
rows, and the driver takes the best splits from these sums, the leaf with the largest gain first. A pass computes
its rows' scores from the trees so far, so nothing is kept between passes, and a lost task is just run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Defaults: rounds, step, leaves of a tree, depth, least rows of a leaf, penalty of squared leaf values.
DEFAULTS = {"rounds": 8, "learning_rate": 0.2, "leaves": 8, "depth": 3, "least_rows": 20, "penalty": 1.0}
BINS = 32


@dataclass
class Tree:
    """Nodes: feature (-1: a leaf), last bin that goes left, children, value of a leaf, gain of a split."""

    feature: list[int] = field(default_factory=lambda: [-1])
    last: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        at = np.zeros(len(bins), np.int64)
        feature, last, left, right = map(np.array, (self.feature, self.last, self.left, self.right))
        while len(on := np.flatnonzero(feature[at] >= 0)):
            node = at[on]
            at[on] = np.where(bins[on, feature[node]] <= last[node], left[node], right[node])
        return at

    def split(self, leaf: int, feature: int, last: int, gain: float) -> tuple[int, int]:
        for own, x in ((self.feature, -1), (self.last, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.gain, 0.0)):
            own += [x, x]
        self.feature[leaf], self.last[leaf], self.gain[leaf] = feature, last, gain
        self.left[leaf], self.right[leaf] = len(self.feature) - 2, len(self.feature) - 1
        return self.left[leaf], self.right[leaf]


@dataclass
class Boosted:
    features: list[str]
    edges: list[np.ndarray]  # ascending bounds of each feature's bins; nulls and NaN are bin 0
    start: np.ndarray
    rounds: list[list[Tree]] = field(default_factory=list)

    def bins(self, columns: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([np.where(np.isnan(x), 0, 1 + np.searchsorted(e, x, "left")) for x, e in zip(columns, self.edges, strict=True)])

    def scores(self, bins: np.ndarray) -> np.ndarray:
        out = np.tile(self.start, (len(bins), 1))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += np.array(tree.value)[tree.leaves(bins)]
        return out

    def probabilities(self, bins: np.ndarray) -> np.ndarray:
        raw = self.scores(bins)
        p = np.exp(raw - raw.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def gains(self) -> np.ndarray:
        """Summed gains: classes x features."""
        out = np.zeros((len(self.start), len(self.features)))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                for f, g in zip(tree.feature, tree.gain, strict=True):
                    if f >= 0:
                        out[k, f] += g
        return out


def _columns(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    return [batch.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(n)]


def histograms(rows: DataFrame, model: Boosted, growing: list[Tree], open_leaves: list[list[int]]) -> dict[tuple[int, int], np.ndarray]:
    """(class, leaf): sums (features x bins x (gradient, curvature, rows)) of the open leaves, over all rows."""
    n, classes, most = len(model.features), len(model.start), max(map(len, model.edges)) + 2
    width = max(len(t.feature) for t in growing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, classes * width * n * most))
        for batch in batches:
            bins, y = model.bins(_columns(batch, n)), batch.column(n).to_numpy(zero_copy_only=False)
            p = model.probabilities(bins)
            for k, tree in enumerate(growing):
                leaf = tree.leaves(bins)
                on = np.flatnonzero(np.isin(leaf, open_leaves[k]))
                g, h = p[on, k] - (y[on] == k), p[on, k] * (1 - p[on, k])
                for f in range(n):
                    at = ((k * width + leaf[on]) * n + f) * most + bins[on, f]
                    for s, v in enumerate((g, h, None)):
                        total[s] += np.bincount(at, v, total.shape[1])
        used = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[s][used]) for s in range(3))], ["at", "g", "h", "n"])

    out = {(k, leaf): np.zeros((n, most, 3)) for k in range(classes) for leaf in open_leaves[k]}
    for at, *sums in rows.mapInArrow(run, "at long, g double, h double, n double").groupBy("at").agg(F.sum("g"), F.sum("h"), F.sum("n")).collect():
        cell, b = divmod(at, most)
        cell, f = divmod(cell, n)
        out[divmod(cell, width)][f, b] = sums
    return out


def best_split(sums: np.ndarray, least_rows: int, penalty: float) -> tuple[float, int, int]:
    """(gain, feature, last bin to the left) of a leaf's sums; gain 0 for none. Ties go to the first feature and bin."""
    left = np.cumsum(sums, 1)
    whole = left[:, -1:, :]
    right = whole - left
    worth = lambda s: s[..., 0] ** 2 / (s[..., 1] + penalty)
    gain = np.where((left[..., 2] >= least_rows) & (right[..., 2] >= least_rows), worth(left) + worth(right) - worth(whole), 0)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[f, b]), int(f), int(b)) if gain[f, b] > 1e-12 else (0.0, -1, 0)


def fit_boosted(train: DataFrame, features: list[str], label: str, classes: int, **options: float) -> Boosted:
    """``label``: classes as whole numbers from 0. Rows without one are left out."""
    o = DEFAULTS | options
    rows = train.filter(F.col(label).isNotNull()).select(*(F.col(f).cast("double").alias(f"f{k}_") for k, f in enumerate(features)), F.col(label).cast("int").alias("y_")).checkpoint()
    shares = [k / BINS for k in range(1, BINS)]
    cuts = rows.agg(*(F.percentile_approx(F.when(~F.isnan(f"f{k}_"), F.col(f"f{k}_")), shares, 10_000) for k in range(len(features))), *(F.count_if(F.col("y_") == c) for c in range(classes))).first()
    counts = np.array(cuts[len(features) :], float)
    if not counts.sum():
        raise ValueError("no training rows")
    start = np.log(np.maximum(counts / counts.sum(), 1e-6))
    model = Boosted(features, [np.unique(np.array(c or [0.0], float)) for c in cuts[: len(features)]], start)
    for _ in range(int(o["rounds"])):
        growing = [Tree() for _ in range(classes)]
        wanted = [[0] for _ in range(classes)]
        leaves = [1] * classes
        for level in range(int(o["depth"])):
            sums = histograms(rows, model, growing, wanted)
            wanted = [[] for _ in range(classes)]
            found = {key: best_split(s, int(o["least_rows"]), o["penalty"]) for key, s in sums.items()}
            for (k, leaf), s in sums.items():
                if not level:
                    growing[k].value[leaf] = _value(s[0].sum(0), o)
            for (k, leaf), (gain, f, b) in sorted(found.items(), key=lambda x: (-x[1][0], x[0])):
                if gain > 0 and leaves[k] < o["leaves"]:
                    left, right = growing[k].split(leaf, f, b, gain)
                    growing[k].value[left], growing[k].value[right] = (_value(part.sum(0), o) for part in (sums[k, leaf][f, : b + 1], sums[k, leaf][f, b + 1 :]))
                    wanted[k] += [left, right]
                    leaves[k] += 1
            if not any(wanted):
                break
        model.rounds.append(growing)
    return model


def _value(sums: np.ndarray, o: dict) -> float:
    return float(-o["learning_rate"] * sums[0] / (sums[1] + o["penalty"]))


def with_boosted(rows: DataFrame, model: Boosted, names: list[str]) -> DataFrame:
    """``rows`` with the classes' probabilities, computed a batch at a time."""

    @F.arrow_udf("array<double>")
    def predict(*columns: pa.Array) -> pa.Array:
        p = model.probabilities(model.bins([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns]))
        return pa.array(list(p), pa.list_(pa.float64()))

    out = rows.withColumn("p_", predict(*(F.col(f).cast("double") for f in model.features)))
    return out.withColumns({name: F.col("p_")[k] for k, name in enumerate(names)}).drop("p_")


def select_boosted(train: DataFrame, tune: DataFrame, features: list[str], label: str, classes: int, grid: list[dict]) -> tuple[Boosted, list[float]]:
    """The option set with the least mean log loss on ``tune`` (ties: the first), and the losses of all."""
    names, losses, models = [f"p{k}_" for k in range(classes)], [], []
    for options in grid:
        models.append(fit_boosted(train, features, label, classes, **options))
        own = F.element_at(F.array(*names), F.col(label).cast("int") + 1)
        losses.append(float(with_boosted(tune, models[-1], names).agg(F.avg(-F.log(F.greatest(own, F.lit(1e-15))))).first()[0]))
    return models[int(np.argmin(losses))], losses
