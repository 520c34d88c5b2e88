"""Goal model: log-link Poisson effects with a penalty and sum-to-zero constraints, by Newton steps.

Rows with the same sides, competition and home mark are one cell with its weight and weighted goals, which is all
that the likelihood needs. A step sums gradient and curvature of its cells in every task, by the few parameters that a
cell touches; the driver holds the sums (a square of the parameters) and solves them with the constraints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of a log mean; steps, and the largest change of a parameter in the last one.
LOWEST, HIGHEST = -8.0, 4.0
STEPS, SETTLED = 50, 1e-10


@dataclass
class GoalModel:
    """Fitted effects: attack and defence of teams sum to zero, the first category's is zero."""

    teams: list[str]
    categories: list[str]
    values: np.ndarray  # intercept, home, attacks, defences, categories
    objective: float

    def effects(self) -> list[tuple[str, str, float]]:
        kinds = [("intercept", ["intercept"]), ("home", ["home"]), ("attack", self.teams), ("defence", self.teams), ("competition", self.categories)]
        names = [(kind, name) for kind, own in kinds for name in own]
        return [(kind, name, float(v)) for (kind, name), v in zip(names, self.values, strict=True)]

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` (attack, defence, competition, at_home) with ``prediction``: mean goals; unknown names have no effect."""
        table = rows.sparkSession.createDataFrame(self.effects(), "kind string, name string, effect double")
        out, total = rows, F.lit(float(self.values[0])) + F.lit(float(self.values[1])) * F.col("at_home")
        for kind in ("attack", "defence", "competition"):
            own = table.filter(F.col("kind") == kind).select(F.col("name").alias(f"{kind}_name_"), F.col("effect").alias(f"{kind}_effect_"))
            out = out.join(F.broadcast(own), F.col(kind) == F.col(f"{kind}_name_"), "left").drop(f"{kind}_name_")
            total = total + F.coalesce(f"{kind}_effect_", F.lit(0.0))
        return out.withColumn("prediction", F.exp(F.least(F.greatest(total, F.lit(LOWEST)), F.lit(HIGHEST)))).drop(*(f"{k}_effect_" for k in ("attack", "defence", "competition")))


def _sums(batches: Iterator[pa.RecordBatch], place: dict[str, dict[str, int]], values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of all cells of a task: (i, j, value) of the curvature, (i, -1, value) of the gradient, (-1, -1, value) of the loss."""
    found: dict[int, float] = {}
    base = len(values) + 1
    for batch in batches:
        at = [np.array([place[c][x] for x in batch.column(c).to_pylist()], np.int64) for c in ("attack", "defence", "competition")]
        home, weight, goals = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at_home", "weight", "goals"))
        parts = [(np.zeros(len(home), np.int64), np.ones(len(home))), (np.ones(len(home), np.int64), home), *((i, np.ones(len(home))) for i in at)]
        eta = sum(values[i] * x for i, x in parts)
        bound = np.clip(eta, LOWEST, HIGHEST)
        mean, free = np.exp(bound), (eta > LOWEST) & (eta < HIGHEST)
        keys, sums = [np.zeros(1, np.int64)], [np.array([(weight * mean - goals * bound).sum()])]
        for a, (i, x) in enumerate(parts):
            keys.append((i + 1) * base)
            sums.append(np.where(free, weight * mean - goals, 0) * x)
            for j, y in parts[a:]:
                keys.append((np.minimum(i, j) + 1) * base + np.maximum(i, j) + 1)
                sums.append(np.where(free, weight * mean, 0) * x * y)
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        for k, v in zip(key.tolist(), np.bincount(inverse, np.concatenate(sums)).tolist(), strict=True):
            found[k] = found.get(k, 0.0) + v
    keys = np.array(list(found), np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(keys // base - 1), pa.array(keys % base - 1), pa.array(list(found.values()), pa.float64())], ["i", "j", "value"])


def fit_goals(rows: DataFrame, strength: float = 0.01) -> GoalModel:
    """Minimise the weighted mean loss of contests plus ``strength`` times the means of squared effects (and a quarter of
    the squared home effect). ``rows``: attack, defence, competition, at_home, weight, goals; two rows a contest.
    """
    known = rows.filter("attack is not null and defence is not null and goals is not null and weight > 0")
    cells = known.groupBy("attack", "defence", F.coalesce("competition", F.lit("")).alias("competition"), "at_home").agg(F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("goals")).alias("goals")).checkpoint()
    teams = [r[0] for r in cells.select(F.explode(F.array("attack", "defence")).alias("team")).distinct().orderBy("team").collect()]
    categories = [r[0] for r in cells.select("competition").distinct().orderBy("competition").collect()]
    if len(teams) < 2:
        raise ValueError("a goal model needs two teams at least")
    weight, goals = cells.agg(F.sum("weight"), F.sum("goals")).first()
    t, c = len(teams), len(categories)
    place = {"attack": {x: 2 + k for k, x in enumerate(teams)}, "defence": {x: 2 + t + k for k, x in enumerate(teams)}, "competition": {x: 2 + 2 * t + k for k, x in enumerate(categories)}}
    size = 2 + 2 * t + c
    penalty = strength * np.concatenate([[0, 0.25], np.full(2 * t, 1 / t), np.full(c, 1 / c)])
    held = np.zeros((3, size))
    held[0, 2 : 2 + t] = held[1, 2 + t : 2 + 2 * t] = held[2, 2 + 2 * t] = 1
    values = np.zeros(size)
    values[0] = np.log(max(goals / weight, 1e-3))

    def around(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient and curvature there."""
        loss, slope, curve = 0.0, np.zeros(size), np.zeros((size, size))
        for i, j, v in cells.mapInArrow(lambda batches: _sums(batches, place, at), "i long, j long, value double").groupBy("i", "j").agg(F.sum("value")).collect():
            if i < 0:
                loss = v
            elif j < 0:
                slope[i] = v
            else:
                curve[i, j] = curve[j, i] = v
        scale = 2 / weight  # two rows a contest
        return loss * scale + float(penalty @ at**2), slope * scale + 2 * penalty * at, curve * scale + np.diag(2 * penalty)

    loss, slope, curve = around(values)
    for _ in range(STEPS):
        whole = np.block([[curve + 1e-12 * np.eye(size), held.T], [held, np.zeros((3, 3))]])
        step = np.linalg.solve(whole, np.concatenate([-slope, -held @ values]))[:size]
        for _ in range(30):  # the loss is convex: a shorter step lowers it
            tried = around(values + step)
            if tried[0] <= loss + 1e-12:
                break
            step = step / 2
        values, (loss, slope, curve) = values + step, tried
        if np.abs(step).max() < SETTLED:
            return GoalModel(teams, categories, values, loss)
    raise RuntimeError(f"the goal model has not settled after {STEPS} steps")
