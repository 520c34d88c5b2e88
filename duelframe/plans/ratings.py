"""Batch rating updates by date, every parameter set in the same pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions.scalars import expected_score

INITIAL = 1500.0
RATINGS = "param_id string, team long, rating double, played long, last_date date"
#: Parameter sets that one task of a grid carries.
SETS_A_TASK = 8
HISTORY = "param_id string, match_id long, match_date date, home_id long, away_id long, home_pre double, away_pre double, expected double, delta double, home_post double, away_post double"


def idle_regressed(rating: Column, rest_days: Column, idle_days: Column, share: Column) -> Column:
    """A rating moved by ``share`` towards the initial one after ``idle_days`` or more; a first contest never is."""
    return F.when(rest_days >= idle_days, INITIAL + (rating - INITIAL) * (1 - share)).otherwise(rating)


def rate_batch(ratings: DataFrame, batch: DataFrame, params: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All contests of a date read the given ratings; each team's changes are summed and applied once. Several dates
    are several batches: each reads the given ratings, and ratings after them are those after a team's last date.

    ``ratings``: param_id, team, rating, played, last_date. ``params``: param_id, k, home_advantage,
    margin_weight, idle_days, idle_share (a few rows). Returns (contest rows with pre and post, new ratings).
    """
    sides = batch.select(F.explode(F.array("home_id", "away_id")).alias("team"), F.col("match_date").alias("day")).distinct()
    p = F.broadcast(params)
    start = F.coalesce("rating", F.lit(INITIAL))
    pre = sides.crossJoin(p).join(ratings, ["param_id", "team"], "left").withColumn("pre", idle_regressed(start, F.datediff("day", "last_date"), F.col("idle_days"), F.col("idle_share")))
    pre = pre.select("param_id", "team", "day", "pre", F.coalesce("played", F.lit(0)).alias("played"))
    h, a = (pre.select("param_id", F.col("day").alias("match_date"), F.col("team").alias(f"{s}_id"), F.col("pre").alias(f"{s}_pre")) for s in ("home", "away"))
    rows = batch.join(h, ["match_date", "home_id"]).join(a, ["match_date", "param_id", "away_id"]).join(p, "param_id")
    gd = F.col("home_goals") - F.col("away_goals")
    actual = F.when(gd > 0, 1.0).when(gd < 0, 0.0).otherwise(0.5)
    margin = F.when(F.abs(gd) <= 1, 1.0).otherwise(1 + (F.abs(gd) - 1) * F.col("margin_weight"))
    rows = rows.withColumn("expected", expected_score(F.col("home_pre") + F.col("home_advantage") - F.col("away_pre"))).withColumn("delta", F.col("k") * margin * (actual - F.col("expected")))
    changes = rows.select("param_id", "match_date", F.explode(F.array(F.struct(F.col("home_id").alias("team"), F.col("delta").alias("d")), F.struct(F.col("away_id").alias("team"), (-F.col("delta")).alias("d")))).alias("x")).groupBy("param_id", "match_date", "x.team").agg(F.sum("x.d").alias("d"))
    for s in ("home", "away"):
        rows = rows.join(changes.select("param_id", "match_date", F.col("team").alias(f"{s}_id"), F.col("d").alias(f"{s}_d")), ["param_id", "match_date", f"{s}_id"])
    rows = rows.select("param_id", "match_id", "match_date", "home_id", "away_id", "home_pre", "away_pre", "expected", "delta", *((F.col(f"{s}_pre") + F.col(f"{s}_d")).alias(f"{s}_post") for s in ("home", "away")))
    return rows, ratings_after(ratings, rows)


def ratings_after(ratings: DataFrame, rows: DataFrame) -> DataFrame:
    """Ratings once these contest rows of one date are in."""
    side = lambda s: F.struct(F.col(f"{s}_id").alias("team"), F.col(f"{s}_post").alias("rating"))
    own = rows.select("param_id", "match_date", F.explode(F.array(side("home"), side("away"))).alias("x")).groupBy("param_id", "x.team").agg(F.max_by("x.rating", "match_date").alias("rating_"), F.count("*").alias("n_"), F.max("match_date").alias("day_"))
    met = ratings.join(own, ["param_id", "team"], "full")
    return met.select("param_id", "team", F.coalesce("rating_", "rating").alias("rating"), (F.coalesce("played", F.lit(0)) + F.coalesce("n_", F.lit(0))).alias("played"), F.coalesce("day_", "last_date").alias("last_date"))


class _Fold:
    """Contests of one parameter set in order of date: only the teams' state is kept."""

    def __init__(self, k: float, home_advantage: float, margin_weight: float, idle_days: int, idle_share: float, stops: list[dt.date]):
        self.k, self.home_advantage, self.margin_weight, self.idle_days, self.idle_share = k, home_advantage, margin_weight, idle_days, idle_share
        self.stops, self.ratings, self.played, self.last = stops, {}, {}, {}

    def snapshots(self, before: dt.date | None) -> list[tuple]:
        """State rows of all stops up to this date (none: the state after all contests)."""
        due = [d for d in self.stops if before is None or d <= before]
        self.stops = self.stops[len(due) :]
        return [(d, t, self.ratings[t], self.played[t], self.last[t]) for d in [*due, *([None] if before is None else [])] for t in self.ratings]

    def contests(self, day: dt.date, batch: list[tuple]) -> list[tuple]:
        """All contests of one date read the ratings before it; each team's changes are summed and applied once."""
        pre, change, rows = {}, {}, []
        for _, home, away, _, _ in batch:
            for t in (home, away):
                if t not in pre:
                    r = self.ratings.get(t, INITIAL)
                    idle = t in self.last and (day - self.last[t]).days >= self.idle_days
                    pre[t], change[t] = (INITIAL + (r - INITIAL) * (1 - self.idle_share) if idle else r), 0.0
        for match, home, away, scored, conceded in batch:
            gap = scored - conceded
            expected = 1 / (1 + 10 ** (-(pre[home] + self.home_advantage - pre[away]) / 400))
            margin = 1.0 if abs(gap) <= 1 else 1 + (abs(gap) - 1) * self.margin_weight
            delta = self.k * margin * ((gap > 0) + 0.5 * (gap == 0) - expected)
            change[home] += delta
            change[away] -= delta
            rows.append((match, day, home, away, pre[home], pre[away], expected, delta))
            for t in (home, away):
                self.played[t] = self.played.get(t, 0) + 1
        for t in pre:
            self.ratings[t], self.last[t] = pre[t] + change[t], day
        return [(*r, self.ratings[r[2]], self.ratings[r[3]]) for r in rows]


def _folded(batches: Iterator[pa.RecordBatch], stops: list[dt.date]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (param_id, match_date, match_id), several dates a batch, to contest rows and state rows."""
    schema = pa.schema([("param_id", pa.string()), ("match_id", pa.int64()), ("match_date", pa.date32()), *((c, pa.int64()) for c in ("home_id", "away_id")), *((c, pa.float64()) for c in ("home_pre", "away_pre", "expected", "delta", "home_post", "away_post")), ("played", pa.int64()), ("last_date", pa.date32())])
    name = fold = day = None
    held: list[tuple] = []

    def made(rows: list[tuple], states: list[tuple]) -> Iterator[pa.RecordBatch]:
        whole = [(name, *r, None, None) for r in rows] + [(name, None, d, t, None, None, None, None, None, r, None, n, last) for d, t, r, n, last in states]
        if whole:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*whole, strict=True), schema, strict=True)], schema=schema)

    def closed(end: bool) -> Iterator[pa.RecordBatch]:
        """The held date's contests, and with ``end`` the last states of the parameter set."""
        nonlocal held
        if fold is not None:
            states, rows = fold.snapshots(day) if held else [], fold.contests(day, held) if held else []
            held = []
            yield from made(rows, states + (fold.snapshots(None) if end else []))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("param_id", "match_date", "match_id", "home_id", "away_id", "home_goals", "away_goals")]
        options = [batch.column(c) for c in ("k", "home_advantage", "margin_weight", "idle_days", "idle_share")]
        for i, (param, date, *contest) in enumerate(zip(*columns, strict=True)):
            if param != name or date != day:
                yield from closed(param != name)
            if param != name:
                name, fold = param, _Fold(*(o[i].as_py() for o in options), sorted(stops))
            day = date
            held.append(tuple(contest))
    yield from closed(True)


def rating_fold(matches: DataFrame, params: DataFrame, path: str, stops: list[dt.date] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every date in order, every parameter set, in one pass: (contest rows, current ratings, ratings at the stops).

    Contests are sorted by Spark and go past a task for each parameter set, which keeps the teams' state alone, however
    many contests there are: each date reads the ratings before it, so one set's contests are a sequence. Ratings at a
    stop are those before its date (columns as of the current ones, and ``stop``), so that folds share the pass.
    Contests without a date, a team or a score are left out. The result is a table under ``path`` in a shared folder.
    """
    spark = matches.sparkSession
    played = matches.select("match_id", "match_date", *(F.col(c).cast("long").alias(c) for c in ("home_id", "away_id", "home_goals", "away_goals"))).dropna()
    sets = params.count()
    dealt = played.crossJoin(F.broadcast(params)).repartitionByRange(max(sets, 1), "param_id").sortWithinPartitions("param_id", "match_date", "match_id")
    days = list(stops or [])
    folded = dealt.mapInArrow(lambda batches: _folded(batches, days), f"{HISTORY}, played long, last_date date")
    folded.write.parquet(f"{path}/fold")
    table = spark.read.schema(f"{HISTORY}, played long, last_date date").parquet(f"{path}/fold")
    state = table.filter("match_id is null").select("param_id", F.col("home_id").alias("team"), F.col("home_post").alias("rating"), "played", "last_date", F.col("match_date").alias("stop"))
    now = state.filter("stop is null").drop("stop")
    return table.filter("match_id is not null").drop("played", "last_date"), now, state.filter("stop is not null")


def rating_history(matches: DataFrame, params: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """All dates in order: (contest rows, current ratings)."""
    rows, now, _ = rating_fold(matches, params, path)
    return rows, now


def _grid_folded(batches: Iterator[pa.RecordBatch], sets: list[tuple], first: dt.date) -> Iterator[pa.RecordBatch]:
    """Meetings in order of (group, date) to the ratings of each date's teams before it, all sets of a group at once."""
    schema = pa.schema([("match_date", pa.date32()), ("team", pa.int64()), ("group_", pa.int32()), ("pre", pa.list_(pa.float64()))])
    epoch, group, at, held = dt.date(1970, 1, 1), None, None, []

    def day_done() -> Iterator[pa.RecordBatch]:
        day = at[1]
        home, away, n, beyond, won, won_beyond = (np.concatenate(c) for c in zip(*held, strict=True))
        for t in np.unique(np.concatenate([home, away])).tolist():
            place.setdefault(t, len(place))
        while len(place) > len(state["rating"]):
            state["rating"] = np.concatenate([state["rating"], np.full_like(state["rating"], INITIAL)])
            state["last"] = np.concatenate([state["last"], np.full_like(state["last"], np.iinfo(np.int64).max)])
        teams, inverse = np.unique(np.concatenate([home, away]), return_inverse=True)
        own = np.array([place[t] for t in teams.tolist()])
        h, a = inverse[: len(home)], inverse[len(home) :]
        rating, idle = state["rating"][own], (day - state["last"][own])[:, None] >= idle_days  # no last date: far below
        pre = np.where(idle, INITIAL + (rating - INITIAL) * (1 - idle_share), rating)
        expected = 1 / (1 + 10 ** (-(pre[h] + advantage - pre[a]) / 400))
        delta = k * (won[:, None] + margin * won_beyond[:, None] - expected * (n[:, None] + margin * beyond[:, None]))
        change = np.zeros_like(pre)
        np.add.at(change, h, delta)
        np.subtract.at(change, a, delta)
        state["rating"][own], state["last"][own] = pre + change, day
        if day >= (first - epoch).days:
            flat = pa.ListArray.from_arrays(np.arange(len(teams) + 1, dtype=np.int32) * pre.shape[1], pa.array(pre.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(teams), day, np.int32)).cast(pa.date32()), pa.array(teams), pa.array(np.full(len(teams), group, np.int32)), flat], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        groups, days = batch.column(0).to_numpy(), batch.column(1).cast(pa.int32()).to_numpy().astype(np.int64)
        columns = [batch.column(c).to_numpy() for c in range(2, 8)]
        cuts = np.flatnonzero((np.diff(groups) != 0) | (np.diff(days) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if at != (groups[a], days[a]):
                if held:
                    yield from day_done()
                    held.clear()
                at = (groups[a], days[a])
            if group != groups[a]:
                group = groups[a]
                k, advantage, margin, idle_days, idle_share = (np.array(c, float) for c in zip(*sets[group * SETS_A_TASK : (group + 1) * SETS_A_TASK], strict=True))
                place: dict[int, int] = {}
                state = {"rating": np.full((64, len(k)), INITIAL), "last": np.full(64, np.iinfo(np.int64).max)}
            held.append([c[a:b] for c in columns])
    if held:
        yield from day_done()


def grid_ratings(matches: DataFrame, params: DataFrame, path: str, first: dt.date) -> tuple[DataFrame, DataFrame]:
    """Ratings of all parameter sets before each date from ``first`` on: (match_date, team, group_, pre), and what sets
    stand where in ``pre`` (group_, pos, param_id, home_advantage).

    All contests of a date read the same ratings, and changes of a team are summed, so that contests of a date, home and
    away team go on as one row with sums of their results; no contest is repeated for each set. A group of SETS_A_TASK
    sets is one pass over these rows. Contests without a date, a team or a score are left out.
    """
    spark = matches.sparkSession
    chosen = sorted(params.collect())
    sets = [tuple(r[c] for c in ("k", "home_advantage", "margin_weight", "idle_days", "idle_share")) for r in chosen]
    played = matches.select("match_id", "match_date", *(F.col(c).cast("long").alias(c) for c in ("home_id", "away_id", "home_goals", "away_goals"))).dropna()
    gap = F.col("home_goals") - F.col("away_goals")
    won, beyond = F.when(gap > 0, 1.0).when(gap < 0, 0.0).otherwise(0.5), F.greatest(F.abs(gap) - 1, F.lit(0)).cast("double")
    meetings = played.groupBy("match_date", "home_id", "away_id").agg(F.count("*").cast("double").alias("n"), F.sum(beyond).alias("beyond"), F.sum(won).alias("won"), F.sum(won * beyond).alias("won_beyond"))
    groups = max(-(-len(sets) // SETS_A_TASK), 1)
    dealt = meetings.select(F.explode(F.array(*(F.lit(g) for g in range(groups)))).alias("group_"), "*").repartitionByRange(groups, "group_").sortWithinPartitions("group_", "match_date", "home_id", "away_id")
    shape = "match_date date, team long, group_ int, pre array<double>"
    dealt.mapInArrow(lambda batches: _grid_folded(batches, sets, first), shape).write.parquet(f"{path}/grid")
    names = spark.createDataFrame([(i // SETS_A_TASK, i % SETS_A_TASK, r["param_id"], float(r["home_advantage"])) for i, r in enumerate(chosen)], "group_ int, pos int, param_id string, home_advantage double")
    return spark.read.schema(shape).parquet(f"{path}/grid"), names


def ratings_before(matches: DataFrame, params: DataFrame, path: str) -> DataFrame:
    """param_id, match_id, home_pre and away_pre of every contest, by way of the ratings before each date."""
    before, sets = grid_ratings(matches, params, path, dt.date.min)
    each = before.select("match_date", "team", "group_", F.posexplode("pre").alias("pos", "pre_")).join(F.broadcast(sets.drop("home_advantage")), ["group_", "pos"])
    side = lambda s: each.select("param_id", "match_date", F.col("team").alias(f"{s}_id"), F.col("pre_").alias(f"{s}_pre"))
    played = matches.dropna(subset=["match_id", "match_date", "home_id", "away_id", "home_goals", "away_goals"])
    met = played.select("match_id", "match_date", *(F.col(c).cast("long").alias(c) for c in ("home_id", "away_id"))).join(side("home").hint("merge"), ["match_date", "home_id"])
    return met.join(side("away").hint("merge"), ["match_date", "away_id", "param_id"]).select("param_id", "match_id", "home_pre", "away_pre")


def rating_grid(base: dict[str, float], **options: list) -> list[tuple]:
    """Rows of PARAMS columns for all combinations of options (others as in ``base``); names tell what differs."""
    names = ("k", "home_advantage", "margin_weight", "idle_days", "idle_share")
    out = []
    for chosen in product(*options.values()):
        own = base | dict(zip(options, chosen, strict=True))
        label = " ".join(f"{n}={v:g}" for n, v in zip(options, chosen, strict=True))
        out.append((label, float(own["k"]), float(own["home_advantage"]), float(own["margin_weight"]), int(own["idle_days"]), float(own["idle_share"])))
    if {*options} - {*names}:
        raise ValueError(f"unknown options: {sorted({*options} - {*names})}")
    return out
