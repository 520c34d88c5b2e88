"""Every query runs; each with SQL has the rows that DuckDB gives."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from compare import difference
from duelframe.operators import bootstrap as bootstrap_module
from duelframe.operators import scoring
from duelframe.plans import contextual, ratings
from duelframe.queries import library, whole_jobs
from duelframe.views import view

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(library.SQL))
def test_equals_sql(spark, name):
    assert difference(spark, SF, library.QUERIES[name], library.SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(library.QUERIES) - set(library.SQL)))
def test_runs(spark, name):
    assert library.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_preprocessing_of_all_rows(spark):
    """Medians, means and deviations, and one place for each competition, by numpy."""
    rows = view(spark, SF, "pairs").orderBy("match_id").collect()
    d = np.array([np.nan if r["match_id"] % 7 == 0 else r["home_goals"] - r["away_goals"] for r in rows], float)
    x = np.stack([np.where(np.isnan(d), np.median(d[~np.isnan(d)]), d), [r["home_id"] % 11 for r in rows]], 1)
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    kinds = sorted({r["competition"] for r in rows})
    got = {r["match_id"]: r["features"] for r in library.QUERIES["feature_preprocess"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r, own in zip(rows, x):
        place = [float(r["competition"] == k) for k in kinds]
        assert np.allclose(got[r["match_id"]][:2], own, atol=1e-6) and got[r["match_id"]][2 : 2 + len(kinds)] == place


def test_permutation_raises_the_loss(spark):
    got = {r["feature"]: r["increase"] for r in library.QUERIES["permutation_importance"](spark, SF).collect()}
    assert set(got) == {"p_home", "p_draw", "p_away"} and all(np.isfinite(v) for v in got.values())


def plain_history(rows, options):
    """(pre, pre, expected, delta, post, post) of every contest, date by date, and the ratings after each date."""
    k, advantage, weight, idle, share = options
    batches, now, last, want, after = {}, {}, {}, {}, {}
    for r in rows:
        batches.setdefault(r["match_date"], []).append(r)
    for day in sorted(batches):
        teams = {t for r in batches[day] for t in (r["home_id"], r["away_id"])}
        pre = {t: now.get(t, 1500.0) for t in teams}
        pre = {t: 1500 + (v - 1500) * (1 - share) if t in last and (day - last[t]).days >= idle else v for t, v in pre.items()}
        post, made = dict(pre), []
        for r in batches[day]:
            h, a, gd = r["home_id"], r["away_id"], r["home_goals"] - r["away_goals"]
            e = 1 / (1 + 10 ** (-(pre[h] + advantage - pre[a]) / 400))
            delta = k * (1 if abs(gd) <= 1 else 1 + (abs(gd) - 1) * weight) * ((1.0 if gd > 0 else 0.0 if gd < 0 else 0.5) - e)
            post[h] += delta
            post[a] -= delta
            made.append((r["match_id"], h, a, e, delta))
        for m, h, a, e, delta in made:
            want[m] = (pre[h], pre[a], e, delta, post[h], post[a])
        now |= post
        last |= dict.fromkeys(teams, day)
        after[day] = dict(now)
    return want, after


HISTORY = ("home_pre", "away_pre", "expected", "delta", "home_post", "away_post")


def test_ratings_of_all_contests(spark):
    """Every date of all contests in plain Python: dates read earlier ratings, idle teams regress; and ratings at folds."""
    rows = view(spark, SF, "pairs").collect()
    want, at = {}, {}
    for name, *options in whole_jobs.SETS:
        history, after = plain_history(rows, options)
        want |= {(name, m): v for m, v in history.items()}
        for start in whole_jobs.FOLD_STARTS:
            at |= {(name, start, t): v for t, v in after[max(d for d in after if d < start)].items()}
    got = {(r[0], r[1]): tuple(r)[2:] for r in library.QUERIES["elo_history"](spark, SF).select("param_id", "match_id", *HISTORY).collect()}
    assert set(got) == set(want) and np.allclose([got[k] for k in sorted(got)], [want[k] for k in sorted(want)], atol=2e-6)
    folds = {(r["param_id"], r["fold_start"], r["team"]): r["rating"] for r in library.QUERIES["elo_ratings_at_folds"](spark, SF).collect()}
    assert set(folds) == set(at) and np.allclose([folds[k] for k in sorted(folds)], [at[k] for k in sorted(at)], atol=2e-6)


def test_rating_grid_search(spark):
    """All 48 parameter sets over the folds by plain histories, draw rates and losses."""
    rows = view(spark, SF, "pairs").collect()
    base = {"k": 20, "home_advantage": 0, "margin_weight": 0, "idle_days": 365, "idle_share": 0}
    won = lambda r: (r["home_goals"] > r["away_goals"]) - (r["home_goals"] < r["away_goals"])
    want = {}
    for name, *options in ratings.rating_grid(base, **whole_jobs.RATING_GRID):
        history, _ = plain_history(rows, options)
        for start in whole_jobs.FOLD_STARTS:
            before = [r for r in rows if r["match_date"] < start]
            d = min(max(sum(won(r) == 0 for r in before) / len(before), 0.05), 0.45)
            losses = []
            for r in rows:
                if start <= r["match_date"] < start.replace(year=start.year + 1):
                    e = 1 / (1 + 10 ** (-(history[r["match_id"]][0] + options[1] - history[r["match_id"]][1]) / 400))
                    losses.append(-np.log({1: (1 - d) * e, 0: d, -1: (1 - d) * (1 - e)}[won(r)]))
            want[name, start.isoformat()] = (len(losses), np.mean(losses))
    got = library.QUERIES["rating_grid_search"](spark, SF).collect()
    assert len(got) == len(want) == 144 and len({r["param_id"] for r in got}) == 48
    assert all(want[r["param_id"], r["fold"]][0] == r["n"] and abs(want[r["param_id"], r["fold"]][1] - r["log_loss"]) < 2e-6 for r in got)
    mean = {p: np.mean([v for (q, _), (_, v) in want.items() if q == p]) for p, _ in want}
    assert {r["param_id"] for r in got if r["selected"]} <= {p for p, v in mean.items() if v < min(mean.values()) + 1e-9}


def test_ratings_leave_out_unplayed_contests(spark, tmp_path):
    day = [whole_jobs.FOLD_STARTS[0]] * 4
    rows = [(1, day[0], 1, 2, 1, 0), (2, day[0], 1, None, 1, 0), (3, None, 1, 2, 1, 0), (4, day[0], 3, 4, None, 0)]
    matches = spark.createDataFrame(rows, "match_id long, match_date date, home_id long, away_id long, home_goals int, away_goals int")
    history, now, at = ratings.rating_fold(matches, spark.createDataFrame(whole_jobs.SETS, library.PARAMS), str(tmp_path / "a"), [day[0]])
    assert history.count() == 2 and now.count() == 4 and at.count() == 0
    assert ratings.rating_history(matches.limit(0), spark.createDataFrame(whole_jobs.SETS, library.PARAMS), str(tmp_path / "b"))[0].count() == 0


def standing(matches, teams):
    """(points, difference, goals) of each of these teams in the matches among them."""
    out = {t: [0, 0, 0] for t in teams}
    for h, a, x, y in matches:
        if h in out and a in out:
            for t, s, c in ((h, x, y), (a, y, x)):
                out[t] = [out[t][0] + (3 if s > c else s == c), out[t][1] + s - c, out[t][2] + s]
    return out


def tied(matches, teams):
    """Buckets of teams in order: what splits starts over on what stays tied."""
    own = standing(matches, teams)
    for k in range(3):
        values = sorted({own[t][k] for t in teams}, reverse=True)
        if len(values) > 1:
            return [b for v in values for b in tied(matches, [t for t in teams if own[t][k] == v])]
    return [teams]


def test_tiebreaks_of_all_matches(spark):
    groups, code = {}, {r["t"]: r["h"] for r in spark.range(40).selectExpr("id AS t", "xxhash64(id) AS h").collect()}
    for r in view(spark, SF, "pairs").collect():
        groups.setdefault(f"{r['match_date'].year}/{r['competition']}", []).append((r["home_id"], r["away_id"], r["home_goals"], r["away_goals"]))
    want = set()
    for grp, matches in groups.items():
        whole = standing(matches, {t for m in matches for t in m[:2]})
        order = []
        for p in sorted({v[0] for v in whole.values()}, reverse=True):
            for bucket in tied(matches, [t for t in whole if whole[t][0] == p]):
                order += sorted(bucket, key=lambda t: (-whole[t][1], -whole[t][2], code[t]))
        want |= {(grp, t, *whole[t], k + 1) for k, t in enumerate(order)}
    got = [tuple(r) for r in library.QUERIES["rank_with_tiebreaks"](spark, SF).select("grp", "team", "points", "difference", "scored", "position").collect()]
    assert len(got) == len(want) and set(got) == want


def bootstrap(by, deltas, resamples):
    n = len(deltas)
    draw = lambda r, k: int(hashlib.md5(f"{by}|{r}|{k}".encode()).hexdigest()[:8], 16) % n
    means = np.array([np.mean([deltas[draw(r, k)] for k in range(n)]) for r in range(resamples)])
    return (n, np.mean(deltas), *np.quantile(means, [0.025, 0.975]), np.mean(means < 0))


def test_bootstrap_of_all_fixtures(spark):
    groups = {}
    for r in view(spark, SF, "forecasts").orderBy("forecast_id").collect():
        p = {"home_win": r["p_home"], "draw": r["p_draw"], "away_win": r["p_away"]}[r["outcome"]]
        groups.setdefault(r["fixture_id"], []).append(-np.log(p) + np.log(1 / 3))
    got = {r[0]: tuple(r)[1:] for r in library.QUERIES["paired_bootstrap_ci_whole"](spark, SF).select("fixture_id", "n", "mean_delta", "low", "high", "share_below_zero").collect()}
    assert set(got) == set(groups)
    for by in sorted(groups, key=lambda x: (len(groups[x]), x))[::7]:  # against independent draws by numpy
        values, (n, mean, low, high, below) = np.array(groups[by]), got[by]
        means = np.random.default_rng(by).choice(values, (10_000, n)).mean(1)
        spread = values.std() / np.sqrt(n)
        assert n == len(values) and abs(mean - values.mean()) < 2e-6 and abs(below - (means < 0).mean()) < 0.03
        assert np.allclose([low, high], np.quantile(means, [0.025, 0.975]), atol=0.12 * spread + 2e-6)


def test_bootstrap_by_blocks(spark):
    """One group over many blocks beside small ones and one without values: the same by each draw in plain Python."""
    rng = np.random.default_rng(4)
    values = {1: rng.normal(size=900).tolist(), 2: [0.5], 3: rng.normal(size=64).tolist(), None: [1.0, -2.0]}
    rows = [(g, k, v, "x") for g, own in values.items() for k, v in enumerate(own)] + [(9, 1, None, "x")]
    df = spark.createDataFrame(rows, "g long, k long, v double, n string").repartition(3)
    got = {r["g"]: tuple(r)[1:] for r in bootstrap_module.bootstrap_means(df, "k", "g", "v", 300, size=64).collect()}
    seeds = {r[0]: r[1] for r in df.select("g", F.xxhash64(F.col("g").cast("string"))).collect()}
    assert set(got) == set(values)
    for g, own in values.items():
        n, total = len(own), np.zeros(300)
        blocks = range(-(-n // 64))
        draws = [bootstrap_module.draws_of_block(seeds[g], n, b, 300, 64) for b in blocks]
        assert (np.sum(draws, 0) == n).all()
        for b in blocks:
            random, part = bootstrap_module._generator(seeds[g], 2, b), own[64 * b : 64 * b + 64]
            picked = iter(random.integers(0, len(part), int(draws[b].sum())))
            for r in range(300):
                total[r] += sum(part[next(picked)] for _ in range(draws[b][r]))
        assert np.allclose(got[g], (n, np.mean(own), *np.quantile(total / n, [0.025, 0.975]), (total < 0).mean()), atol=1e-9)


def test_draws_of_blocks_are_multinomial():
    """Each row's weight has the mean and variance of a draw with replacement, also across blocks of unequal size."""
    n, size, resamples = 1000, 300, 20_000
    draws = np.array([bootstrap_module.draws_of_block(11, n, b, resamples, size) for b in range(4)])
    share = np.array([300, 300, 300, 100]) / n
    assert np.allclose(draws.mean(1), n * share, rtol=0.01) and np.allclose(np.cov(draws), n * (np.diag(share) - np.outer(share, share)), atol=8)


def test_bootstrap_of_a_large_group(spark):
    deltas = [((k * 37) % 101 - 50) / 40 for k in range(1500)]
    df = spark.createDataFrame([(7, k, d) for k, d in enumerate(deltas)], "g long, k long, delta double")
    got = scoring.paired_bootstrap_ci(df, "k", "g", 20).select("n", "mean_delta", "low", "high", "share_below_zero").first()
    assert np.allclose(tuple(got), bootstrap(7, deltas, 20))


def test_bootstrap_of_groups_held_and_joined(spark):
    """Both ways give the same draws: in an array of the group's deltas, and in a join; no plan broadcasts draws."""
    rows = [(g, k, None if (g, k) == (2, 3) else ((k * 37 + g) % 101 - 50) / 40) for g, n in ((1, 300), (2, 5), (3, 1)) for k in range(n)]
    df = spark.createDataFrame([*rows, (None, 0, 1.0)], "g long, k long, delta double")
    whole, joined = (scoring.paired_bootstrap_ci(df, "k", "g", 20, held) for held in (scoring.HELD, 0))
    got, want = ({r["g"]: tuple(r)[1:] for r in out.collect()} for out in (whole, joined))
    assert got.keys() == want.keys() == {1, 2, 3} and all(np.allclose(got[g], want[g]) for g in got)
    assert np.allclose(got[1], bootstrap(1, [d for g, _, d in rows if g == 1], 20))
    for out in (whole, joined):
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_outgoing_files_of_many_rows_stay_below_the_bound(spark, tmp_path):
    """A part with more lines than one file may have is dealt to several: nothing is too large."""
    spark.range(500_000).select(F.col("id").alias("c_custkey"), F.lit(1).alias("c_nationkey"), F.lit("x").alias("c_mktsegment")).write.parquet(str(tmp_path / "customer.parquet"))
    assert difference(spark, str(tmp_path), library.QUERIES["publish_gate_scan"], library.SQL["publish_gate_scan"]) == ""


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """The given tables with every order eight times, so that many rows share a team and instant."""
    home = tmp_path_factory.mktemp("repeated")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    # 23,400 = 600 * 39: hour, teams, site and all flags stay but for what 7 and 9 divide
    orders.crossJoin(spark.range(8).withColumnRenamed("id", "k")).withColumn("o_orderkey", F.col("o_orderkey") + F.col("k") * 23_400).drop("k").write.parquet(str(home / "orders.parquet"))
    spark.read.parquet(f"{SF}/nation.parquet").write.parquet(str(home / "nation.parquet"))
    return str(home)


def test_contextual_windows_go_over_instants(spark, repeated, monkeypatch):
    """What windows see grows with teams' instants, not with rows; results are those of the SQL."""
    parts, written = [], contextual.written

    def spy(rows):
        parts.append(written(rows))
        return parts[-1]

    monkeypatch.setattr(contextual, "written", spy)
    assert difference(spark, repeated, library.QUERIES["contextual_feature_build"], library.SQL["contextual_feature_build"]) == ""
    assert parts[0].count() <= parts[0].agg(F.sum("n_")).first()[0] / 7


def test_contextual_match_rows_of_repeated_rows(spark, repeated):
    """Equal to the SQL, and rows are not doubled to count sides."""
    assert difference(spark, repeated, library.QUERIES["contextual_match_rows"], library.SQL["contextual_match_rows"]) == ""
    teams = spark.createDataFrame([(1, "home"), (1, "away"), (2, "home")], "match_id long, side string").withColumns({c: F.lit(1) for c in contextual.DIFFERENCES})
    out = contextual.match_rows(teams)
    assert [r["match_id"] for r in out.collect()] == [1] and "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_contextual_audit_is_one_pass(spark, repeated):
    """Equal to the SQL; the sides' rows are made once for all reasons."""
    assert difference(spark, repeated, library.QUERIES["contextual_audit"], library.SQL["contextual_audit"]) == ""
    plan = library.QUERIES["contextual_audit"](spark, repeated)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_contextual_features_by_cutoff_write_no_checkpoints(spark, repeated, monkeypatch):
    """Equal to the SQL; steps are compressed tables of few columns, where checkpoints of whole rows filled the disk."""

    def checkpoint(*_):
        raise AssertionError("uncompressed checkpoint")

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", checkpoint)
    assert difference(spark, repeated, library.QUERIES["contextual_feature_build_by_cutoff"], library.SQL["contextual_feature_build_by_cutoff"]) == ""


def test_grid_ratings_are_those_of_the_history(spark, tmp_path):
    """Ratings before each date as in the pass over contests, with idle teams and wide scores; no row for each contest."""
    pairs = view(spark, SF, "pairs")
    # teams with gaps, and every contest three times on its date
    rows = pairs.filter("match_id % 3 = 0").withColumn("home_goals", F.col("home_goals") * 2).crossJoin(spark.range(3).withColumnRenamed("id", "r")).withColumn("match_id", F.col("match_id") * 3 + F.col("r")).drop("r")
    params = spark.createDataFrame([*whole_jobs.SETS, *((f"s{k}", 5.0 * k, 10.0, 0.3, 30, 0.5) for k in range(9))], library.PARAMS)
    history, _ = ratings.rating_history(rows, params, str(tmp_path / "a"))
    day = whole_jobs.FOLD_STARTS[0]
    want = {(r["param_id"], r["match_date"], t): p for r in history.filter(F.col("match_date") >= F.lit(day)).collect() for t, p in ((r["home_id"], r["home_pre"]), (r["away_id"], r["away_pre"]))}
    before, sets = ratings.grid_ratings(rows, params, str(tmp_path / "b"), day)
    names = {(r["group_"], r["pos"]): r["param_id"] for r in sets.collect()}
    found = before.collect()
    got = {(names[r["group_"], k], r["match_date"], r["team"]): v for r in found for k, v in enumerate(r["pre"])}
    assert len(names) == 11 and got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-8 for x in want)
    assert len(found) * 3 < history.filter(F.col("match_date") >= F.lit(day)).count()


def test_ratings_before_contests_are_those_of_the_history(spark, tmp_path):
    """Each contest's ratings, without a pass over contests in one task."""
    pairs, params = view(spark, SF, "pairs"), spark.createDataFrame(whole_jobs.SETS, library.PARAMS)
    key = lambda rows: {(r["param_id"], r["match_id"]): (r["home_pre"], r["away_pre"]) for r in rows.collect()}
    want, got = key(ratings.rating_history(pairs, params, str(tmp_path / "a"))[0]), key(ratings.ratings_before(pairs, params, str(tmp_path / "b")))
    assert got.keys() == want.keys() and all(np.allclose(got[x], want[x], atol=1e-8) for x in want)
