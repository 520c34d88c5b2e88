"""Models against plain solvers on small rows: goal effects, boosted trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.plans import boosting, goals, jobs, models
from duelframe.queries import library, whole_jobs
from duelframe.views import view

SF = "/root/testdata/sf0.001"


def plain_goals(rows, strength):
    """Newton steps over free parameters (the last team's effect is minus the others' sum), from the rows themselves."""
    teams = sorted({r[0] for r in rows} | {r[1] for r in rows})
    kinds = sorted({r[2] for r in rows})
    t, c = len(teams), len(kinds)
    spread = np.vstack([np.eye(t - 1), -np.ones(t - 1)])
    free = np.zeros((2 + 2 * t + c, 2 + 2 * (t - 1) + c - 1))
    free[:2, :2] = np.eye(2)
    free[2 : 2 + t, 2 : 1 + t] = free[2 + t : 2 + 2 * t, 1 + t : 2 * t] = spread
    free[3 + 2 * t :, 2 * t :] = np.eye(c - 1)
    design = np.zeros((len(rows), len(free)))
    for k, (attack, defence, kind, home, _, _) in enumerate(rows):
        design[k, 0], design[k, 1] = 1, home
        design[k, 2 + teams.index(attack)] = design[k, 2 + t + teams.index(defence)] = design[k, 2 + 2 * t + kinds.index(kind)] = 1
    weight, scored = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
    penalty = np.diag(strength * np.concatenate([[0, 0.25], np.full(2 * t, 1 / t), np.full(c, 1 / c)]))
    x, own = design @ free, free.T @ penalty @ free
    at = np.zeros(free.shape[1])
    for _ in range(60):
        mean = np.exp(x @ at)
        slope = 2 / weight.sum() * x.T @ (weight * (mean - scored)) + 2 * own @ at
        curve = 2 / weight.sum() * (x * (weight * mean)[:, None]).T @ x + 2 * own
        at -= np.linalg.solve(curve, slope)
    return dict(zip([("intercept", "intercept"), ("home", "home"), *(("attack", n) for n in teams), *(("defence", n) for n in teams), *(("competition", n) for n in kinds)], free @ at, strict=True))


@pytest.mark.parametrize("strength", [0.01, 0.5])
def test_goal_effects_by_a_plain_solver(spark, strength):
    rng = np.random.default_rng(3)
    rows = [(f"t{a}", f"t{(a + int(d)) % 7}", f"c{int(k)}", float(h), float(w), float(g)) for a, d, k, h, w, g in zip(rng.integers(0, 7, 300), rng.integers(1, 7, 300), rng.integers(0, 3, 300), rng.integers(0, 2, 300), rng.uniform(0.1, 1, 300), rng.poisson(1.4, 300))]
    df = spark.createDataFrame(rows + [("t1", None, "c0", 1.0, 1.0, 3.0), ("t1", "t2", "c0", 1.0, 0.0, 3.0)], "attack string, defence string, competition string, at_home double, weight double, goals double").repartition(3)
    model = goals.fit_goals(df, strength)
    want = plain_goals(rows, strength)
    assert len(want) == len(model.effects()) and all(abs(want[k, n] - v) < 1e-6 for k, n, v in model.effects())
    seen = model.transform(df.filter("defence is not null").withColumn("competition", F.lit("new"))).select("attack", "defence", "at_home", "prediction").collect()
    assert all(abs(np.log(r["prediction"]) - want["intercept", "intercept"] - want["attack", r["attack"]] - want["defence", r["defence"]] - want["home", "home"] * r["at_home"]) < 1e-6 for r in seen)


def test_goal_fit_of_the_given_contests(spark):
    """The registered query's effects by the plain solver."""
    rows = [(r["attack"], r["defence"], r["competition"], r["at_home"], r["weight"], r["goals"]) for r in models.goal_rows(view(spark, SF, "pairs"), "1997-01-01", 730.0).collect()]
    want = plain_goals(rows, 0.05)
    got = {(r["kind"], r["name"]): r["effect"] for r in library.QUERIES["weighted_poisson_goal_fit"](spark, SF).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_goal_model_needs_two_teams(spark):
    with pytest.raises(ValueError, match="two teams"):
        goals.fit_goals(spark.createDataFrame([("a", "a", "c", 1.0, 1.0, 1.0)], "attack string, defence string, competition string, at_home double, weight double, goals double"))


def plain_trees(bins, y, start, o):
    """Rounds of trees as nested splits, each from direct sums over the rows of a leaf; and the rows' scores."""
    raw, rounds = np.tile(start, (len(y), 1)), []
    value = lambda g, h: -o["learning_rate"] * g.sum() / (h.sum() + o["penalty"])
    worth = lambda g, h: g.sum() ** 2 / (h.sum() + o["penalty"])
    for _ in range(o["rounds"]):
        p = np.exp(raw - raw.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        trees = []
        for k in range(len(start)):
            g, h = p[:, k] - (y == k), p[:, k] * (1 - p[:, k])
            leaves, splits, open_ = {0: np.arange(len(y))}, [], [0]
            for _ in range(o["depth"]):
                found = []
                for leaf in open_:
                    rows, best = leaves[leaf], (0.0, -1, 0)
                    for f in range(bins.shape[1]):
                        for b in range(bins.max() + 2):
                            left = bins[rows, f] <= b
                            if min(left.sum(), (~left).sum()) >= o["least_rows"]:
                                gain = worth(g[rows[left]], h[rows[left]]) + worth(g[rows[~left]], h[rows[~left]]) - worth(g[rows], h[rows])
                                if gain > best[0] + 1e-9:
                                    best = (gain, f, b)
                    found.append((-best[0], leaf, best))
                open_ = []
                for _, leaf, (gain, f, b) in sorted(found):
                    if gain > 1e-9 and len(leaves) < o["leaves"]:
                        rows = leaves.pop(leaf)
                        left = bins[rows, f] <= b
                        new = max([*leaves, leaf, *(x for s in splits for x in s[3:])]) + 1
                        leaves[new], leaves[new + 1] = rows[left], rows[~left]
                        splits.append((leaf, f, b, new, new + 1))
                        open_ += [new, new + 1]
            trees.append(splits)
            for rows in leaves.values():
                raw[rows, k] += value(g[rows], h[rows])
        rounds.append(trees)
    return rounds, raw


@pytest.mark.parametrize("options", [{"rounds": 3, "depth": 3, "leaves": 8, "least_rows": 15}, {"rounds": 2, "depth": 4, "leaves": 4, "least_rows": 5, "penalty": 0.1}])
def test_boosted_trees_by_plain_sums(spark, options):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 3)).round(2)
    x[::17, 1] = np.nan
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=400) > 0.4, 2, np.where(np.nan_to_num(x[:, 1]) > 0.2, 1, 0))
    df = spark.createDataFrame([(*map(float, r), int(c)) for r, c in zip(x, y)] + [(1.0, None, 2.0, None)], "a double, b double, c double, y int").repartition(4)
    model = boosting.fit_boosted(df, ["a", "b", "c"], "y", 3, **options)
    bins = model.bins([x[:, k] for k in range(3)])
    rounds, raw = plain_trees(bins, y, model.start, boosting.DEFAULTS | options)
    got = [[[(k, t.feature[k], t.last[k], t.left[k], t.right[k]) for k in range(len(t.feature)) if t.feature[k] >= 0] for t in trees] for trees in model.rounds]
    assert [[sorted(t) for t in trees] for trees in rounds] == got and np.allclose(model.scores(bins), raw)
    p = np.exp(raw) / np.exp(raw).sum(1, keepdims=True)
    loss = -np.log(p[np.arange(400), y]).mean()
    assert loss < 0.8 * -(np.bincount(y) / 400 * np.log(np.bincount(y) / 400)).sum()
    out = boosting.with_boosted(df.filter("y is not null"), model, ["p0", "p1", "p2"]).select(F.avg(-F.log(F.element_at(F.array("p0", "p1", "p2"), F.col("y") + 1)))).first()[0]
    assert out == pytest.approx(loss) and model.gains().sum(0)[2] < model.gains().sum(0)[0]


def test_boosted_options_are_selected(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=600)
    df = spark.createDataFrame([(float(v), int(v > 0)) for v in x], "a double, y int")
    grid = [{"rounds": 1, "learning_rate": 0.01}, {"rounds": 6, "learning_rate": 0.3}]
    model, losses = boosting.select_boosted(df.limit(400), df, ["a"], "y", 2, grid)
    assert losses[1] < losses[0] < np.log(2) + 0.01 and len(model.rounds) == 6
    flat = boosting.fit_boosted(df.withColumn("a", F.lit(None).cast("double")), ["a"], "y", 2)
    assert np.allclose(flat.probabilities(np.zeros((1, 1), int))[0], [np.mean(x <= 0), np.mean(x > 0)], atol=1e-6)
    with pytest.raises(ValueError, match="no training rows"):
        boosting.fit_boosted(df.limit(0), ["a"], "y", 2)


def test_boosted_challenger_of_the_given_contests(spark):
    """Probabilities of every later contest; on the rows it learned from the loss is below the class frequencies'."""
    got = library.QUERIES["boosted_tree_challenger"](spark, SF)
    train, test = library._training(view(spark, SF, "pairs"))
    assert got.count() == test.count() and got.filter("abs(p_home + p_draw + p_away - 1) > 1e-9 or least(p_home, p_draw, p_away) <= 0").count() == 0
    own = F.element_at(F.array("p_home", "p_draw", "p_away"), models.class_index(F.col("outcome")).cast("int") + 1)
    learned = models.boosted_tree_challenger(train, train, ["difference", "load"]).agg(F.avg(-F.log(own))).first()[0]
    shares = [r["count"] / train.count() for r in train.groupBy("outcome").count().collect()]
    assert learned < -sum(s * np.log(s) for s in shares)


def test_out_of_fold_by_role_goes_on_where_it_ended(spark, tmp_path, monkeypatch):
    """Each part is scored by a model of earlier rows alone; a run that breaks off leaves finished parts, which the next reads."""
    rows = whole_jobs._roles(view(spark, SF, "pairs"))
    calls, scored = [], jobs.goal_probabilities

    def watched(matches, fixtures, cutoff):
        assert matches.filter(F.col("match_date") >= F.lit(cutoff).cast("date")).isEmpty()
        assert fixtures.filter(F.col("match_date") < F.lit(cutoff).cast("date")).isEmpty()
        calls.append(cutoff)
        if len(calls) == 4:
            raise OSError("driver lost")
        return scored(matches, fixtures, cutoff)

    monkeypatch.setattr(jobs, "goal_probabilities", watched)
    folder = f"file://{tmp_path}/parts"
    with pytest.raises(OSError):
        jobs.oof_base_features_by_role(rows, folder, 100)
    out = jobs.oof_base_features_by_role(rows, folder, 100)
    assert len(calls) == 9 and calls[3] == calls[4]  # 5 blocks and 3 roles; only the broken one is made twice
    got = {r["match_id"]: (r["role"], r["block"]) for r in out.collect()}
    own = sorted(((r["match_date"], r["match_id"]) for r in rows.filter("role = 'train'").collect()))[100:]
    blocks = np.array_split(np.array([m for _, m in own]), 5)
    want = {int(m): ("train", k + 1) for k, b in enumerate(blocks) for m in b} | {r["match_id"]: (r["role"], 0) for r in rows.filter("role != 'train'").collect()}
    assert got == want


def test_feature_assembly_and_its_errors(spark):
    table = lambda rows, shape: spark.createDataFrame(rows, shape)
    rows = table([(1, "c"), (2, "c"), (3, "d")], "match_id long, competition string")
    base, rated, context = table([(1, 0.1), (2, 0.2), (2, 0.2)], "match_id long, log_p_home double"), table([(1, 10.0, 4.0), (2, 1.0, 2.0), (9, 0.0, 0.0)], "match_id long, home_pre double, away_pre double"), table([(1, 7), (2, None), (None, 1)], "match_id long, rest int")
    got = {r["match_id"]: (r["competition"], r["log_p_home"], r["rating_difference"], r["rest"]) for r in jobs.feature_assembly(rows, base, rated, context).collect()}
    assert got == {1: ("c", 0.1, 6.0, 7), 2: ("c", 0.2, -1.0, None)}
    with pytest.raises(ValueError, match="contextual features are missing for match_id 2"):
        jobs.feature_assembly(rows, base, rated, context.filter("match_id = 1"))
    with pytest.raises(ValueError, match="ratings are missing for match_id 1"):
        jobs.feature_assembly(rows, base, rated.filter("match_id = 2"), context)
    with pytest.raises(ValueError, match="contextual features of one match differ"):
        jobs.feature_assembly(rows, base, rated, context.unionByName(table([(1, 8)], "match_id long, rest int")))
    with pytest.raises(ValueError, match="no rows"):
        jobs.feature_assembly(rows, base.limit(0), rated, context)


def test_goal_grid_is_scored_by_fold_and_kept(spark):
    """Log losses of all option sets and folds from plain effects and grids of scores."""
    pairs = view(spark, SF, "pairs")
    rows = pairs.collect()
    got = {(r["param_id"], r["fold"]): r for r in library.QUERIES["goal_grid_search"](spark, SF).collect()}
    assert len(got) == 8 and len({p for (p, _), r in got.items() if r["selected"]}) == 1
    for options in whole_jobs.GOAL_GRID[::3]:
        start = whole_jobs.FOLD_STARTS[1]
        e = plain_goals([(r["attack"], r["defence"], r["competition"], r["at_home"], r["weight"], r["goals"]) for r in models.goal_rows(pairs, start.isoformat(), options["half_life"]).collect()], options["strength"])
        losses = []
        for r in rows:
            if start <= r["match_date"] < start.replace(year=start.year + 1):
                mean = lambda a, d, h: np.exp(e["intercept", "intercept"] + e.get(("attack", str(a)), 0) + e.get(("defence", str(d)), 0) + e.get(("competition", r["competition"]), 0) + h * e["home", "home"])
                k = np.arange(41)
                pmf = lambda m: np.exp(k * np.log(m) - m - np.array([sum(np.log(np.arange(1, x + 1))) for x in k]))
                grid = np.outer(pmf(mean(r["home_id"], r["away_id"], 1)), pmf(mean(r["away_id"], r["home_id"], 0)))
                gap = np.sign(r["home_goals"] - r["away_goals"])
                losses.append(-np.log({1: np.tril(grid, -1), 0: np.diag(grid), -1: np.triu(grid, 1)}[gap].sum() / grid.sum()))
        name = f"half_life={options['half_life']:g} strength={options['strength']:g}"
        assert got[name, start.isoformat()]["n"] == len(losses) and abs(got[name, start.isoformat()]["log_loss"] - np.mean(losses)) < 3e-6


def test_upcoming_forecasts_have_current_ratings(spark):
    got = library.QUERIES["predict_upcoming"](spark, SF)
    assert {"home_rating", "away_rating"} <= set(got.columns) and got.filter("home_rating is null or away_rating is null").count() == 0 and got.count() > 0
