"""Whole jobs composed of the library's operators: ingests, forecasts, grid search, stacked challengers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.functions.ids import derived_id, row_fingerprint, table_digest
from duelframe.functions.scalars import CLIP, decay_weight
from duelframe.operators import contracts, joins, scoring, windows
from duelframe.plans import models, resume
from duelframe.sources import sinks

P = scoring.P


def historical_ingest(raw: DataFrame, alias: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with stage and reason); every raw row is in exactly one of them.

    ``raw``: row_id and the texts day, home, away, home_score, away_score. Rows go through parsing, duplicates
    (identical ones keep the first, conflicting ones all go), names by date, and the contract of two teams.
    """
    kinds = {"day": "date", "home": "text", "away": "text", "home_score": "int", "away_score": "int"}
    parsed = {c: contracts.typed_parse(F.col(c), k, c) for c, k in kinds.items()}
    typed = raw.select("row_id", *(v.alias(c) for c, (v, _) in parsed.items()), F.coalesce(*(r for _, r in parsed.values())).alias("bad_"))
    payload = F.sha2(F.concat_ws("|", "home_score", "away_score"), 256)
    judged = windows.dedupe_identical_or_conflict(typed.filter("bad_ is null"), ["day", "home", "away"], payload, "row_id")
    kept = judged.filter("decision = 'keep'").drop("decision", "bad_")
    for side in ("home", "away"):
        named = joins.temporal_alias_join(kept.select("row_id", F.col(side).alias("name"), F.col("day").alias("seen")), alias)
        kept = kept.join(named.select("row_id", F.col("entity").alias(f"{side}_entity"), F.col("resolution").alias(f"{side}_found")), "row_id")
    unresolved = lambda s: F.when(F.col(f"{s}_found") != "resolved", F.concat_ws(" ", F.lit(s), F.col(f"{s}_found")))
    kept = kept.withColumn("name_", F.coalesce(unresolved("home"), unresolved("away"))).withColumn("rule_", F.when(F.col("home_entity") == F.col("away_entity"), "same teams"))
    accepted = kept.filter("name_ is null and rule_ is null").drop("name_", "rule_", "home_found", "away_found")
    out = lambda df, stage, reason: df.filter(reason.isNotNull()).select("row_id", F.lit(stage).alias("stage"), reason.alias("reason"))
    quarantined = out(typed, "parse", F.col("bad_")).unionByName(out(judged, "dedupe", F.when(F.col("decision") != "keep", F.col("decision"))))
    return accepted, quarantined.unionByName(out(kept, "resolve", F.col("name_"))).unionByName(out(kept.filter("name_ is null"), "contract", F.col("rule_")))


def live_ingest(previous: DataFrame, current: DataFrame, secondary: DataFrame, fields: list[str], now: str, stale_hours: int, path: str | None = None) -> DataFrame:
    """check, detail, n: changes since the last snapshot, transitions, stale rows, differences to another source.

    With ``path`` the snapshot (once for its time and content) and its view by status group are written too.
    """
    if path is not None:
        sinks.immutable_snapshot_sink(current, f"{path}/snapshots", now.replace(" ", "T").replace(":", ""))
        sinks.status_partitioned_view(current, f"{path}/view", "id")
    tally = lambda df, check, detail: df.groupBy(detail.alias("detail")).agg(F.count("*").alias("n")).select(F.lit(check).alias("check"), "detail", "n")
    changes = tally(joins.snapshot_diff(previous, current, "id", fields), "change", F.col("field"))
    moved = tally(joins.status_transitions(previous, current), "transition", F.concat_ws("->", "was", "now"))
    old = current.filter(F.col("updated").isNull() | (F.col("updated") < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {stale_hours} HOURS")))
    apart = tally(joins.reconcile(current, secondary, ["id"], fields), "reconcile", F.col("difference"))
    return changes.unionByName(moved).unionByName(tally(old, "stale", F.col("status"))).unionByName(apart)


def goal_means(model, fixtures: DataFrame) -> DataFrame:
    """Fixtures with home_mean and away_mean of a fitted goal model; teams it never saw get the effect of none."""
    side = lambda t, o, h, n: F.struct(F.col(t).cast("string").alias("attack"), F.col(o).cast("string").alias("defence"), F.lit(h).alias("at_home"), F.lit(n).alias("side"))
    both = F.array(side("home_id", "away_id", 1.0, "home"), side("away_id", "home_id", 0.0, "away"))
    rows = fixtures.select("match_id", "competition", F.explode(both).alias("x")).select("match_id", "competition", "x.*", F.lit(0.0).alias("goals"), F.lit(1.0).alias("weight"))
    means = model.transform(rows).groupBy("match_id").agg(*(F.max(F.when(F.col("side") == s, F.col("prediction"))).alias(f"{s}_mean") for s in ("home", "away")))
    return fixtures.join(means, "match_id")


def goal_probabilities(matches: DataFrame, fixtures: DataFrame, cutoff: str) -> DataFrame:
    """match_id, means and outcome probabilities of fixtures by a goal model of the matches before the cutoff."""
    model, _ = models.weighted_poisson_goal_fit(matches, cutoff)
    means = goal_means(model, fixtures).select("match_id", "home_mean", "away_mean", F.lit(0.0).alias("rho"))
    return models.score_grid(means).select("match_id", "home_mean", "away_mean", *P)


def predict_upcoming(matches: DataFrame, fixtures: DataFrame, cutoff: str, created: str, version: str, ratings: DataFrame | None = None) -> DataFrame:
    """Forecasts of eligible fixtures by what was known at the cutoff, each with id, checksum and lead hours.

    ``ratings`` (team, rating: those before the cutoff) are attached to both sides; null where a team has none.

    ``fixtures``: contests with status, kickoff, result. Rows that are not eligible have no forecast.
    """
    at, made = F.lit(cutoff).cast("timestamp"), F.lit(created).cast("timestamp")
    reason = contracts.upcoming_eligibility(F.col("status"), F.col("kickoff"), at, made, F.col("home_id"), F.col("away_id"), F.col("result"))
    open_ = fixtures.withColumn("reason_", reason).filter("reason_ is null").drop("reason_")
    scored = goal_probabilities(matches, open_, cutoff[:10]).join(open_.select("match_id", "kickoff"), "match_id")
    out = scored.select(derived_id(F.lit(version), F.col("match_id"), F.lit(created)).alias("prediction_id"), "match_id", "kickoff", *P, "home_mean", "away_mean", F.lit(version).alias("model_version"), at.alias("data_cutoff"), made.alias("created_at"), ((F.unix_micros("kickoff") - F.unix_micros(made)) / 3.6e9).alias("lead_hours"))
    if ratings is not None:
        out = out.join(open_.select("match_id", "home_id", "away_id"), "match_id")
        for side in ("home", "away"):
            out = out.join(ratings.select(F.col("team").alias(f"{side}_id"), F.col("rating").alias(f"{side}_rating")), f"{side}_id", "left")
        out = out.drop("home_id", "away_id")
    return out.withColumn("checksum", row_fingerprint(out))


def oof_base_features(matches: DataFrame, cutoffs: list[str]) -> DataFrame:
    """match_id, block and log probabilities for each match from the first cutoff on: block k's rows are scored
    by a goal model of rows before block k alone (the last block is open)."""
    out = None
    for k, cutoff in enumerate(cutoffs):
        block = matches.filter(F.col("match_date") >= F.lit(cutoff).cast("date"))
        if k + 1 < len(cutoffs):
            block = block.filter(F.col("match_date") < F.lit(cutoffs[k + 1]).cast("date"))
        one = goal_probabilities(matches, block, cutoff).select("match_id", F.lit(k).alias("block"), *(F.log(F.greatest(p, F.lit(CLIP))).alias(f"log_{p}") for p in P))
        out = one if out is None else out.unionByName(one)
    return out


def oof_base_features_by_role(rows: DataFrame, folder: str, least: int, blocks: int = 5) -> DataFrame:
    """match_id, role, block and log probabilities: no row is scored by a model that saw it or anything later.

    ``rows``: matches with a ``role``. Train rows in order of date, without the first ``least``, are cut into ``blocks``;
    each is scored by a goal model of the train rows before its first date (left out where those are fewer than
    ``least``). Tune, calibration and test rows are scored by a model of all rows before their role's first date. Each
    part is kept in ``folder`` when it is finished.
    """
    spark = rows.sparkSession
    train = rows.filter("role = 'train'")
    cut = windows.temporal_blocks(train.withColumn("all_", F.lit("train")), "all_", ["match_date", "match_id"], least, blocks).drop("all_")
    cut = resume.part(spark, folder, "blocks", lambda: cut.select("match_id", "block", "block_cutoff"))
    steps = [(f"block-{r['block']}", train, train.join(cut.filter(F.col("block") == r["block"]).select("match_id"), "match_id"), r["d"], r["block"]) for r in cut.groupBy("block").agg(F.min("block_cutoff").alias("d")).orderBy("block").collect()]
    for r in rows.filter("role != 'train'").groupBy("role").agg(F.min("match_date").alias("d")).orderBy("d").collect():
        steps.append((r["role"], rows, rows.filter(F.col("role") == r["role"]), r["d"], 0))
    out = []
    for name, known, fixtures, day, block in steps:
        before = known.filter(F.col("match_date") < F.lit(day))
        if block and before.limit(least).count() < least:
            continue

        def scored(before=before, fixtures=fixtures, day=day, block=block) -> DataFrame:
            made = goal_probabilities(before, fixtures, day.isoformat())
            roles = fixtures.select("match_id", "role")
            return made.join(roles, "match_id").select("match_id", "role", F.lit(block).alias("block"), *(F.log(F.greatest(p, F.lit(CLIP))).alias(f"log_{p}") for p in P))

        out.append(resume.part(spark, folder, name, scored))
    if not out:
        raise ValueError("no rows remain to be scored out of fold")
    return reduce(DataFrame.unionByName, out)


def feature_assembly(rows: DataFrame, base: DataFrame, ratings: DataFrame, contextual: DataFrame, key: str = "match_id") -> DataFrame:
    """``rows`` that have base features, with those, their ratings before the match, and contextual features.

    A row with base features but without a rating or contextual row is an error, and so are rows of one match whose
    contents differ; equal repeats count once.
    """
    one = {}
    for name, table in (("base features", base), ("ratings", ratings), ("contextual features", contextual)):
        one[name] = table.filter(F.col(key).isNotNull()).dropDuplicates()
        if not one[name].groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            raise ValueError(f"{name} of one match differ")
    usable = rows.join(one["base features"], key)
    for name in ("ratings", "contextual features"):
        missing = [r[0] for r in usable.select(key).join(one[name].select(key), key, "left_anti").orderBy(key).limit(5).collect()]
        if missing:
            raise ValueError(f"{name} are missing for {key} {', '.join(map(str, missing))}")
    out = usable.join(one["ratings"], key).join(one["contextual features"], key)
    if out.isEmpty():
        raise ValueError("no rows have base features")
    return out.withColumn("rating_difference", F.col("home_pre") - F.col("away_pre"))


def goal_grid_report(matches: DataFrame, folder: str, starts: list, grid: list[dict]) -> DataFrame:
    """param_id, fold (a year from each start), scores and ``selected`` for goal models of each option set.

    ``matches`` with their outcome; options: half_life and strength. A model of a fold sees the matches before its start
    alone. Scores of each (option set, fold) are kept in ``folder`` when they are finished.
    """
    spark, found = matches.sparkSession, []
    for options in grid:
        name = " ".join(f"{k}={v:g}" for k, v in sorted(options.items()))
        for start in starts:
            day = F.lit(start.isoformat()).cast("date")
            fixtures = matches.filter((F.col("match_date") >= day) & (F.col("match_date") < F.add_months(day, 12)))

            def scored(options=options, start=start, fixtures=fixtures, name=name) -> DataFrame:
                model, _ = models.weighted_poisson_goal_fit(matches, start.isoformat(), **options)
                means = goal_means(model, fixtures).select("match_id", "home_mean", "away_mean", F.lit(0.0).alias("rho"))
                rows = models.score_grid(means).select("match_id", *P).join(fixtures.select("match_id", "outcome"), "match_id")
                return scoring.proper_scores(rows.withColumns({"param_id": F.lit(name), "fold": F.lit(start.isoformat())}), "param_id", "fold")

            found.append(resume.part(spark, folder, f"{name.replace(' ', '-')}-{start.isoformat()}", scored))
    return _selected(reduce(DataFrame.unionByName, found))


def tempered(rows: DataFrame, temperature: Column) -> DataFrame:
    """Probabilities raised to 1 / temperature and normalised."""
    raised = {p: F.pow(F.greatest(F.col(p), F.lit(CLIP)), 1 / temperature) for p in P}
    total = raised[P[0]] + raised[P[1]] + raised[P[2]]
    return rows.withColumns({p: x / total for p, x in raised.items()})


def stacked_logistic_challenger(rows: DataFrame, numeric: list[str], categorical: list[str], strengths: tuple[float, ...]) -> DataFrame:
    """match_id, probabilities, strength and temperature for the rows of role ``test``.

    Logistic regression on ``train`` for each inverse strength C; the one with the least log loss on ``tune``
    (the smallest C if equal) is fitted again on both, and its temperature comes from ``calibration``.
    """
    part = lambda *roles: rows.filter(F.col("role").isin(*roles))
    train, both = part("train"), part("train", "tune")
    keep = [c for c in rows.columns]
    predict = lambda on, c, n, of: models.with_probabilities(models.multinomial_logistic(on, numeric, categorical, 1 / (c * n)).transform(of)).select(*keep, *P)
    n = max(train.count(), 1)
    losses = [(scoring.proper_scores(predict(train, c, n, part("tune"))).first()["log_loss"], c) for c in strengths]
    best = min(losses)[1]
    scored = predict(both, best, max(both.count(), 1), part("calibration", "test"))
    grid = tuple(0.5 + 0.1 * k for k in range(16)) + (1.0,)
    fit = scoring.temperature_fit(scored.filter("role = 'calibration'").withColumn("all_", F.lit(1)), "all_", grid).first()
    t = fit["temperature"] if fit else 1.0
    return tempered(scored.filter("role = 'test'"), F.lit(t)).select("match_id", *P, F.lit(best).alias("strength"), F.lit(t).alias("temperature"))


def predict_challenger(official: DataFrame, features: DataFrame, model, temperature: float, key: str = "match_id") -> DataFrame:
    """The challenger's forecasts for exactly the official fixtures; other or missing ones are an error.

    ``official``: key and stored base probabilities; ``features``: key and the model's other inputs.
    """
    if not joins.fixture_alignment(official, features, key).filter("state != 'aligned'").isEmpty():
        raise ValueError("challenger rows are not the official fixtures")
    base = official.select(key, *(F.log(F.greatest(p, F.lit(CLIP))).alias(f"log_{p}") for p in P))
    scored = models.with_probabilities(model.transform(features.join(base, key))).select(key, *P)
    return tempered(scored, F.lit(temperature)).withColumn("prediction_id", derived_id(F.lit("challenger"), F.col(key)))


def model_gain_importance(train: DataFrame, numeric: list[str]) -> DataFrame:
    """class, feature, gain: the gain shares of a boosted one-against-rest model of each outcome."""
    rows = [(outcome, f, float(g)) for outcome, model in models.boosted_models(train, numeric) for f, g in zip(numeric, model.stages[-1].featureImportances.toArray())]
    return train.sparkSession.createDataFrame(rows, "class string, feature string, gain double")


def grid_search_report(matches: DataFrame, folds: DataFrame, params: DataFrame, predict: Callable[[DataFrame, Column], DataFrame]) -> DataFrame:
    """param_id, fold, scores and ``selected`` (least mean log loss of folds; ties: the smaller id).

    Draw rates come from each fold's own training rows. Every parameter set (a few small rows) scores every
    test row in one pass; ``predict`` adds probabilities from the parameters' columns and the draw rate.
    """
    roles = models.walk_forward_folds(matches, folds).join(matches, "match_id")
    rates = roles.filter("role = 'train'").groupBy("fold").agg(F.avg((F.col("outcome") == "draw").cast("int")).alias("rate"))
    options = params.agg(F.collect_list(F.struct(*params.columns)).alias("options_")).first()["options_"]
    each = F.explode(F.array(*(F.struct(*(F.lit(v).alias(c) for c, v in o.asDict().items())) for o in options)))
    tests = roles.filter("role = 'test'").join(rates, "fold").withColumn("option_", each).select("*", "option_.*")
    scores = scoring.proper_scores(predict(tests, F.col("rate")), "param_id", "fold")
    return _selected(scores)


def rating_grid_report(matches: DataFrame, before: DataFrame, sets: DataFrame, starts: list) -> DataFrame:
    """param_id, fold (a year from each start), scores and ``selected``, for ratings of every parameter set.

    ``before``, ``sets``: tables of ``ratings.grid_ratings`` (ratings before a date hold nothing later, so they serve
    every fold). A fold's draw rate comes from the matches before its start. Contests of one date, home and away team
    and outcome are scored once, with their number as weight.
    """
    day = lambda d: F.lit(d.isoformat()).cast("date")
    drawn = (F.col("outcome") == "draw").cast("int")
    rates = matches.agg(*(F.avg(F.when(F.col("match_date") < day(s), drawn)).alias(f"r{k}") for k, s in enumerate(starts))).first()
    fold = [F.struct(F.lit(s.isoformat()).alias("fold"), F.lit(rates[k]).cast("double").alias("rate")) for k, s in enumerate(starts)]
    inside = F.coalesce(*(F.when((F.col("match_date") >= day(s)) & (F.col("match_date") < F.add_months(day(s), 12)), f) for s, f in zip(starts, fold, strict=True)))
    played = matches.dropna(subset=["match_id", "match_date", "home_id", "away_id", "home_goals", "away_goals"]).withColumn("fold_", inside).filter("fold_ is not null")
    tests = played.groupBy("match_date", F.col("home_id").cast("long").alias("home_id"), F.col("away_id").cast("long").alias("away_id"), "outcome", "fold_").agg(F.count("*").alias("n_"))
    side = lambda s: before.select("match_date", "group_", F.col("team").alias(f"{s}_id"), F.col("pre").alias(f"{s}_pre"))
    met = tests.join(side("home").hint("merge"), ["match_date", "home_id"]).join(side("away").hint("merge"), ["match_date", "away_id", "group_"])
    each = met.select("outcome", "fold_.*", "n_", "group_", F.posexplode(F.arrays_zip("home_pre", "away_pre")).alias("pos", "x_")).join(F.broadcast(sets), ["group_", "pos"])
    scored = scoring.with_losses(models.draw_rate_probability(each.withColumn("difference", F.col("x_.home_pre") + F.col("home_advantage") - F.col("x_.away_pre")), F.col("rate")))
    means = {"log_loss": "log_loss", "brier": "brier", "rps": "rps", "hit": "accuracy", "p_true": "mean_true_probability"}
    return _selected(scored.groupBy("param_id", "fold").agg(F.sum("n_").alias("n"), *((F.sum(F.col("n_") * F.col(c)) / F.sum("n_")).alias(m) for c, m in means.items())))


def _selected(scores: DataFrame) -> DataFrame:
    """Scores by param_id and fold with their mean over folds, and whether it is the least (ties: the smaller id)."""
    means = scores.groupBy("param_id").agg(F.round(F.avg("log_loss"), 12).alias("mean_log_loss"))
    best = means.agg(F.min(F.struct("mean_log_loss", "param_id")).alias("b")).select(F.col("b.param_id").alias("best_"))
    return scores.join(means, "param_id").join(best, F.col("param_id") == F.col("best_"), "left").withColumn("selected", F.col("best_").isNotNull()).drop("best_")


def holdout_scoring(matches: DataFrame, start: str, fit_predict: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Rows on or after the date by a model of rows before it, with their losses; without an outcome: pending."""
    d = F.lit(start).cast("date")
    scored = scoring.with_losses(fit_predict(matches.filter(F.col("match_date") < d), matches.filter(F.col("match_date") >= d)))
    known = F.col("outcome").isNotNull()
    losses = ("log_loss", "brier", "rps")
    return scored.withColumns({c: F.when(known, F.col(c)) for c in losses}).withColumn("status", F.when(known, "scored").otherwise("pending")).select("match_id", *P, *losses, "status")


def feature_manifest(inputs: DataFrame, features: DataFrame, key: str, team: str, kickoff: str, cutoff: str) -> DataFrame:
    """One row about a feature build: row counts, teams, the last kickoff, a digest, rows after the cutoff."""
    at = F.lit(cutoff).cast("timestamp")
    rows = inputs.agg(F.count("*").alias("input_rows"))
    built = features.agg(F.count("*").alias("feature_rows"), F.countDistinct(team).alias("teams"), F.max(kickoff).alias("last_kickoff"), F.count_if(F.col(kickoff) > at).alias("after_cutoff"))
    digest = table_digest(features.select(key, team)).select(F.col("digest").alias("revision"))
    out = rows.join(F.broadcast(built)).join(F.broadcast(digest))  # one row each
    return out.withColumn("audit_passed", (F.col("after_cutoff") == 0) & (F.col("feature_rows") == F.col("input_rows")))
