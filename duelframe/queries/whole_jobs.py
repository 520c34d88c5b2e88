"""Queries of whole jobs in one plan each: contextual features, the training table, the prospective scorecard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from duelframe.functions import scalars
from duelframe.operators import reports
from duelframe.plans import contextual, jobs, models, ratings, training
from duelframe.queries.library import AVGS, BUCKETS, LOSS, METRICS, PARAMS, VALIDITY, _rounded, _validity, query, r6
from duelframe.queries.round_trips import home

DAY = 86_400_000_000
FEATURES = contextual.DIFFERENCES
FLAGS = ("previous_match_id", "previous_extra_time", "previous_penalties", "cross_border", "host_country", "is_neutral", "first_tournament_match")
OFFSET = "CASE {}.zone WHEN 'Asia/Tokyo' THEN 9 WHEN 'UTC' THEN 0 WHEN 'Asia/Kolkata' THEN 5.5 WHEN 'Africa/Lagos' THEN 1 END"
_RANGE = "(PARTITION BY team ORDER BY epoch_us(instant) RANGE BETWEEN {} PRECEDING AND {})"
TEAM_ROWS = f"""s AS (SELECT *, 'home' AS side, home_id AS team FROM contests UNION ALL SELECT *, 'away', away_id FROM contests),
r AS (SELECT s.*, g.country, g.latitude, g.longitude, g.elevation, g.zone, h.team AS host_team, coalesce(kickoff, CAST(match_date AS TIMESTAMP)) AS instant, CASE WHEN trusted THEN CASE WHEN extra_time THEN 120.0 ELSE 90.0 END END AS minutes FROM s LEFT JOIN grounds g ON g.site_id = s.site_id LEFT JOIN hosts h ON h.country = g.country),
k AS (SELECT *, max(struct_pack(t := instant, m := match_id)) OVER {_RANGE.format("UNBOUNDED", "1 PRECEDING")} AS prev,
  {", ".join(f"count(*) OVER w{d} AS matches_{d}d, CASE WHEN count(*) FILTER (WHERE minutes IS NULL) OVER w{d} > 0 THEN NULL ELSE coalesce(sum(minutes) OVER w{d}, 0.0) END AS minutes_{d}d" for d in contextual.DAYS)},
  count(*) OVER (PARTITION BY team, competition ORDER BY epoch_us(instant) RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS tournament_match_number
  FROM r WINDOW {", ".join(f"w{d} AS {_RANGE.format(d * DAY, '1 PRECEDING')}" for d in contextual.DAYS)}),
j AS (SELECT k.*, p.match_id AS previous_match_id, p.minutes = 120 AS previous_extra_time, p.penalties AS previous_penalties, (epoch_us(k.kickoff) - epoch_us(p.kickoff)) / 3.6e9 AS rest_hours,
  coalesce((epoch_us(k.kickoff) - epoch_us(p.kickoff)) / 3.6e9 / 24, CASE WHEN k.match_date > p.match_date THEN CAST(k.match_date - p.match_date AS DOUBLE) END) AS rest_days,
  2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(k.latitude - p.latitude) / 2), 2) + cos(radians(k.latitude)) * cos(radians(p.latitude)) * pow(sin(radians(k.longitude - p.longitude) / 2), 2), 1.0))) AS travel_km,
  CASE WHEN k.kickoff IS NOT NULL THEN {OFFSET.format("k")} - {OFFSET.format("p")} END AS timezone_hours, k.elevation - p.elevation AS elevation_change, abs(k.elevation - p.elevation) AS elevation_change_size, k.country != p.country AS cross_border,
  CASE WHEN k.country IS NOT NULL THEN coalesce(k.host_team = k.team, false) END AS host_country, k.tournament_match_number = 1 AS first_tournament_match
  FROM k LEFT JOIN r p ON p.team = k.team AND p.match_id = k.prev.m),
i AS (SELECT *, coalesce(neutral, NOT host_country) AS is_neutral, CASE WHEN rest_days < 7 THEN 0 ELSE 1 END AS reset, sum(CASE WHEN rest_days < 7 THEN 0 ELSE 1 END) OVER (PARTITION BY team ORDER BY instant, match_id ROWS UNBOUNDED PRECEDING) AS island,
  {", ".join(f"sum(travel_km) OVER {_RANGE.format(d * DAY, 'CURRENT ROW')} AS travel_km_{d}d" for d in contextual.DAYS)} FROM j),
t AS (SELECT *, row_number() OVER (PARTITION BY team, island ORDER BY instant, match_id) - first_value(reset) OVER (PARTITION BY team, island ORDER BY instant, match_id) AS short_rest_streak FROM i)"""


def _teams(contests, grounds, hosts):
    return contextual.team_rows(contests, grounds, hosts)


@query(f"WITH {TEAM_ROWS} SELECT match_id, side, team, {', '.join(f'round(CAST({c} AS DOUBLE), 4) AS {c}' for c in FEATURES)}, {', '.join(FLAGS)} FROM t", "contests", "grounds", "hosts")
def contextual_feature_build(contests, grounds, hosts):
    rows = _teams(contests, grounds, hosts)
    return rows.select("match_id", "side", "team", *(F.round(F.col(c).cast("double"), 4).alias(c) for c in FEATURES), *FLAGS)


KNOWN_ROWS = TEAM_ROWS.replace("k AS (SELECT *, max(", f"""o AS (SELECT *, instant + INTERVAL 1 HOUR * CAST(match_id % 200 - 60 AS INT) AS cutoff FROM r),
n AS (SELECT a.match_id AS of_match, a.team AS of_team, max(struct_pack(t := b.instant, m := b.match_id)) AS prev, {", ".join(f"count(b.match_id) FILTER (WHERE b.instant >= a.instant - INTERVAL {d} DAY) AS matches_{d}d, CASE WHEN count(b.match_id) FILTER (WHERE b.instant >= a.instant - INTERVAL {d} DAY AND b.minutes IS NULL) = 0 THEN coalesce(sum(b.minutes) FILTER (WHERE b.instant >= a.instant - INTERVAL {d} DAY), 0.0) END AS minutes_{d}d" for d in contextual.DAYS)},
  count(b.match_id) FILTER (WHERE b.competition = a.competition) + 1 AS tournament_match_number FROM o a LEFT JOIN o b ON b.team = a.team AND b.instant < a.instant AND b.cutoff <= a.cutoff GROUP BY ALL),
k AS (SELECT o.*, n.* FROM o JOIN n ON n.of_match = o.match_id AND n.of_team = o.team),
unused AS (SELECT *, max(""")
KNOWN_ROWS = KNOWN_ROWS.replace(", ".join(f"sum(travel_km) OVER {_RANGE.format(d * DAY, 'CURRENT ROW')} AS travel_km_{d}d" for d in contextual.DAYS), ", ".join(f"(SELECT sum(b.travel_km) FROM j b WHERE b.team = j.team AND b.instant >= j.instant - INTERVAL {d} DAY AND (b.match_id = j.match_id OR (b.instant < j.instant AND b.cutoff <= j.cutoff))) AS travel_km_{d}d" for d in contextual.DAYS))


@query(f"WITH {KNOWN_ROWS} SELECT match_id, side, team, {', '.join(f'round(CAST({c} AS DOUBLE), 4) AS {c}' for c in FEATURES)}, {', '.join(FLAGS)} FROM t", "contests", "grounds", "hosts")
def contextual_feature_build_by_cutoff(contests, grounds, hosts):
    """Rows become known between 60 hours before and 139 hours after their instant: features see only what is known by then."""
    instant = F.coalesce("kickoff", F.col("match_date").cast("timestamp"))
    late = contests.withColumn("cutoff", F.timestamp_micros(F.unix_micros(instant) + (F.col("match_id") % 200 - 60) * 3_600_000_000))
    rows = _teams(late, grounds, hosts)
    return rows.select("match_id", "side", "team", *(F.round(F.col(c).cast("double"), 4).alias(c) for c in FEATURES), *FLAGS)


@query(f"""WITH {TEAM_ROWS} SELECT h.match_id, {', '.join(f'round(CAST(h.{c} AS DOUBLE), 4) AS home_{c}, round(CAST(a.{c} AS DOUBLE), 4) AS away_{c}, round(CAST(h.{c} AS DOUBLE) - CAST(a.{c} AS DOUBLE), 4) AS {c}_diff' for c in FEATURES)}
  FROM t h JOIN t a ON a.match_id = h.match_id AND h.side = 'home' AND a.side = 'away'""", "contests", "grounds", "hosts")
def contextual_match_rows(contests, grounds, hosts):
    rows = contextual.match_rows(_teams(contests, grounds, hosts))
    return rows.select("match_id", *(F.round(c, 4).alias(c) for c in rows.columns if c != "match_id"))


@query("""WITH odd AS (SELECT match_id FROM contests WHERE match_id % 6 = 0), south AS (SELECT site_id FROM grounds WHERE site_id % 5 = 0), sides AS (SELECT match_id, site_id FROM contests UNION ALL SELECT match_id, site_id FROM contests WHERE match_id % 6 != 0)
  SELECT 'match without two sides' AS reason, count(*) AS n FROM odd UNION ALL SELECT 'invalid geography', count(*) FROM sides WHERE site_id IN (SELECT site_id FROM south)""", "contests", "grounds", "hosts")
def contextual_audit(contests, grounds, hosts):
    """With faults put in: every sixth match has one side only, every fifth site lies beyond the pole."""
    away = F.when(F.col("match_id") % 6 != 0, F.col("away_id"))
    beyond = grounds.withColumn("latitude", F.when(F.col("site_id") % 5 == 0, 95.0).otherwise(F.col("latitude")))
    return contextual.audit(_teams(contests.withColumn("away_id", away), beyond, hosts))


RULES = training.TrainingRules("1993-01-01", "1997-01-01", ("class 1", "class 2", "class 3"), exclude_neutral=True)
TRAINING = """t AS (SELECT c.*, h.status AS home_team_status, h.type AS home_team_type, a.status AS away_team_status, a.type AS away_team_type, category AS competition_category, weight AS competition_importance,
  coalesce(home_advantage IN ('home_team', 'away_team'), false) AS home_advantage_eligible, CASE WHEN match_date < DATE '1993-01-01' THEN 'pre_rating_history' WHEN match_date < DATE '1997-01-01' THEN 'rating_history' ELSE 'evaluation' END AS modeling_period, strftime(match_date, '%Y-%m-%d') AS same_date_batch_id,
  CASE WHEN match_date < DATE '1993-01-01' THEN 'before_rating_history_start' WHEN match_status != 'played' OR neutral IS NULL OR h.team IS NULL OR a.team IS NULL THEN 'incomplete_record' WHEN category IS NULL THEN 'unresolved_competition_category' WHEN category NOT IN ('class 1', 'class 2', 'class 3') THEN 'competition_category_not_allowed'
  WHEN h.status != 'active' OR a.status != 'active' THEN 'team_status_not_allowed' WHEN h.type != 'senior' OR a.type != 'senior' THEN 'team_type_not_allowed' WHEN neutral THEN 'neutral_site_excluded' END AS exclusion_reason
  FROM contests c LEFT JOIN teams h ON h.team = home_id LEFT JOIN teams a ON a.team = away_id LEFT JOIN categories ON competition = name)"""
DERIVED = ("home_team_status", "away_team_status", "home_team_type", "away_team_type", "competition_category", "competition_importance", "home_advantage_eligible", "modeling_period", "same_date_batch_id", "exclusion_reason")


def _training(contests, teams, categories):
    return training.training_table(contests, teams, categories.withColumnRenamed("weight", "importance"), RULES)


@query(f"WITH {TRAINING} SELECT match_id, {', '.join(DERIVED)}, exclusion_reason IS NULL AS model_eligible FROM t", "contests", "teams", "categories")
def training_table_build(contests, teams, categories):
    return _training(contests, teams, categories).select("match_id", *DERIVED, "model_eligible")


@query(f"""WITH {TRAINING} SELECT 'eligible' AS key, CAST(exclusion_reason IS NULL AS VARCHAR) AS value, count(*) AS n FROM t GROUP BY 2 UNION ALL SELECT 'exclusion_reason', coalesce(exclusion_reason, 'none'), count(*) FROM t GROUP BY 2
  UNION ALL SELECT 'competition_category', coalesce(competition_category, 'none'), count(*) FROM t GROUP BY 2 UNION ALL SELECT 'modeling_period', modeling_period, count(*) FROM t GROUP BY 2 UNION ALL SELECT 'rows', 'all', count(*) FROM t""", "contests", "teams", "categories")
def training_table_report(contests, teams, categories):
    return training.training_report(_training(contests, teams, categories))


RESULT = "CASE WHEN fixture_id % 4 != 0 THEN CASE fixture_id % 3 WHEN 0 THEN 'home_win' WHEN 1 THEN 'draw' ELSE 'away_win' END END"
OFFICIAL = f"""o AS (SELECT * FROM forecasts WHERE {VALIDITY} IS NULL QUALIFY row_number() OVER (PARTITION BY fixture_id ORDER BY (lead_hours >= 6) DESC, CASE WHEN lead_hours >= 6 THEN created_at END DESC NULLS LAST, CASE WHEN lead_hours >= 6 THEN forecast_id END DESC NULLS LAST, created_at, forecast_id) = 1),
e AS (SELECT o.* REPLACE ({RESULT} AS outcome), CASE WHEN lead_hours >= 6 THEN 'latest_early_enough' ELSE 'earliest' END AS rule, CASE WHEN lead_hours < 6 THEN 'under_6h' WHEN lead_hours < 24 THEN '6h_to_24h' WHEN lead_hours < 40 THEN 'over_24h' ELSE 'unbucketed' END AS horizon, CASE WHEN fixture_id % 5 = 0 THEN 'none' ELSE 'round ' || fixture_id % 5 END AS stage FROM o WHERE {RESULT} IS NOT NULL)"""
_OWN = LOSS.replace("l AS", "l AS").replace("FROM forecasts", "FROM e")
_RATES = "f AS (SELECT avg((outcome = 'home_win')::INT) AS a, avg((outcome = 'draw')::INT) AS b, avg((outcome = 'away_win')::INT) AS c FROM e), x AS (SELECT outcome, 'baseline uniform' AS model, 1.0::DOUBLE / 3 AS p_home, 1.0::DOUBLE / 3 AS p_draw, 1.0::DOUBLE / 3 AS p_away FROM e UNION ALL SELECT outcome, 'baseline history', a, b, c FROM e, f)"


@query(f"""WITH {OFFICIAL}, {_OWN}, {_RATES}, {LOSS.replace("l AS", "y AS").replace("FROM forecasts", "FROM x")}
  {" UNION ALL ".join(f"SELECT 'official' AS model, '{n}' AS segment, {c} AS segment_value, {AVGS} FROM l GROUP BY 3" for n, c in (("all", "'all'"), ("rule", "rule"), ("horizon", "horizon"), ("stage", "stage")))} UNION ALL SELECT model, 'all', 'all', {AVGS} FROM y GROUP BY 1""", "forecasts")
def evaluate_prospective(forecasts):
    result = F.when(F.col("fixture_id") % 4 != 0, F.element_at(F.array(*map(F.lit, ("home_win", "draw", "away_win"))), (F.col("fixture_id") % 3 + 1).cast("int")))
    stage = F.when(F.col("fixture_id") % 5 != 0, F.concat(F.lit("round "), F.col("fixture_id") % 5))
    results = forecasts.select("fixture_id").distinct().select("fixture_id", result.alias("outcome"), stage.alias("stage"))
    card = training.prospective_scorecard(forecasts.withColumn("stage", F.lit(None).cast("string")), results, _validity(), BUCKETS, "stage")
    return _rounded(card.select("model", "segment", "segment_value", "n", *METRICS))


@query("""WITH p AS (SELECT competition, home_goals AS h, away_goals AS a, exp(-ln(2) * greatest(DATE '1999-01-01' - match_date, 0) / 730.0) AS w FROM pairs), g AS (SELECT -0.2 + 0.4 * range / 40 AS rho FROM range(41)), n AS (SELECT competition, sum(w) AS total FROM p GROUP BY 1),
  s AS (SELECT competition, rho, sum(w * ln(greatest(CASE WHEN h = 0 AND a = 0 THEN 1 - 1.4::DOUBLE * 1.1 * rho WHEN h = 0 THEN 1 + 1.4::DOUBLE * rho WHEN a = 0 THEN 1 + 1.1::DOUBLE * rho ELSE 1 - rho END, 1e-15))) AS s FROM p, g WHERE h <= 1 AND a <= 1 GROUP BY 1, 2),
  o AS (SELECT competition, rho, s / total - 10 * rho * rho AS objective FROM s JOIN n USING (competition))
  SELECT competition, round(rho, 6) AS rho, round(objective, 6) AS objective FROM o QUALIFY row_number() OVER (PARTITION BY competition ORDER BY objective DESC, abs(rho), rho DESC) = 1""", "pairs")
def rho_profile_fit(pairs):
    rows = pairs.select("competition", "home_goals", "away_goals", F.lit(1.4).alias("home_mean"), F.lit(1.1).alias("away_mean"), scalars.decay_weight(F.col("match_date"), F.lit("1999-01-01").cast("date"), 730.0).alias("weight"))
    return models.rho_profile_fit(rows, "competition").select("competition", r6("rho").alias("rho"), r6("objective").alias("objective"))


SETS = [("calm", 10.0, 0.0, 0.0, 10_000, 0.0), ("idle", 20.0, 50.0, 0.15, 180, 0.25)]
#: 48 parameter sets.
RATING_GRID = {"k": [10, 20, 30, 40], "home_advantage": [0, 50, 100], "margin_weight": [0, 0.15], "idle_share": [0, 0.25]}
FOLD_STARTS = (dt.date(1996, 1, 1), dt.date(1997, 1, 1), dt.date(1998, 1, 1))


@query(None, "pairs")
def elo_history(pairs):
    """All contests of every date, with two parameter sets."""
    rows, _ = ratings.rating_history(pairs, pairs.sparkSession.createDataFrame(SETS, PARAMS), home(pairs.sparkSession))
    return rows.select("param_id", "match_id", *(r6(c).alias(c) for c in ("home_pre", "away_pre", "expected", "delta", "home_post", "away_post")))


@query(None, "pairs")
def elo_ratings_at_folds(pairs):
    """Ratings of all teams before the start of each fold, from the same pass."""
    _, _, at = ratings.rating_fold(pairs, pairs.sparkSession.createDataFrame(SETS, PARAMS), home(pairs.sparkSession), list(FOLD_STARTS))
    return at.select("param_id", F.col("stop").alias("fold_start"), "team", r6("rating").alias("rating"), "played", "last_date")


@query(None, "pairs")
def rating_grid_search(pairs):
    """48 rating parameter sets over three yearly folds: mean log loss of the draw-rate predictor, and the one selected."""
    spark = pairs.sparkSession
    base = {"k": 20, "home_advantage": 0, "margin_weight": 0, "idle_days": 365, "idle_share": 0}
    grid = spark.createDataFrame(ratings.rating_grid(base, **RATING_GRID), PARAMS)
    before, sets = ratings.grid_ratings(pairs, grid, home(spark), min(FOLD_STARTS))
    out = jobs.rating_grid_report(reports.with_outcome(pairs), before, sets, list(FOLD_STARTS))
    return out.select("param_id", "fold", "n", r6("log_loss").alias("log_loss"), r6("mean_log_loss").alias("mean_log_loss"), "selected")


GOAL_GRID = [{"half_life": h, "strength": s} for h in (365.0, 1460.0) for s in (0.01, 0.2)]


@query(None, "pairs")
def goal_grid_search(pairs):
    """Four goal option sets over two yearly folds; each finished fit is kept, so that a lost driver goes on."""
    out = jobs.goal_grid_report(reports.with_outcome(pairs), home(pairs.sparkSession), list(FOLD_STARTS[1:]), GOAL_GRID)
    return out.select("param_id", "fold", "n", r6("log_loss").alias("log_loss"), r6("mean_log_loss").alias("mean_log_loss"), "selected")


def _roles(pairs):
    return models.nested_temporal_split(pairs.filter("match_date < DATE '1999-01-01'"), "1998-01-01", 180, 180)


@query(None, "pairs")
def oof_base_features_by_role(pairs):
    """Five blocks of the train rows, then tune, calibration and test rows."""
    return jobs.oof_base_features_by_role(_roles(pairs), home(pairs.sparkSession), 100)


@query(None, "contests", "grounds", "hosts")
def feature_assembly_whole(contests, grounds, hosts):
    """Out-of-fold base features, ratings before each match and contextual features of both sides, by match."""
    spark = contests.sparkSession
    base = jobs.oof_base_features_by_role(_roles(contests), home(spark), 100).drop("role", "block")
    rated = ratings.ratings_before(contests, spark.createDataFrame(SETS[1:], PARAMS), home(spark))
    context = contextual.match_rows(_teams(contests, grounds, hosts)).select("match_id", "home_rest_days", "away_rest_days", "rest_days_diff", "matches_30d_diff")
    out = jobs.feature_assembly(_roles(contests).select("match_id", "role", "competition"), base, rated.select("match_id", "home_pre", "away_pre"), context)
    return out.select("match_id", "role", *(r6(c).alias(c) for c in out.columns if c not in ("match_id", "role", "competition")), "competition")
