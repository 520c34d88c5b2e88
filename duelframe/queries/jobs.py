"""Queries of whole jobs: ingests, forecasts, grid search, stacked challengers, and their parts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.operators import joins, reports
from duelframe.plans import jobs, models, ratings
from duelframe.queries.library import DIFF, OUT, PARAMS, QUERIES, SQL, query, r6
from duelframe.streaming import ledger

GRID = {"advantage": [0, 50], "scale": [5, 10]}


@query("""WITH p AS (SELECT row_id, TRY_CAST(day AS DATE) AS seen, trim(home) AS home, trim(away) AS away, home_score, CASE WHEN day = 'n/a' THEN 'invalid day' WHEN home_score = '-1' THEN 'invalid home_score' WHEN away_score = '' THEN 'invalid away_score' END AS bad FROM raw),
d AS (SELECT *, count(DISTINCT home_score) OVER (PARTITION BY seen, home, away) AS k, min(row_id) OVER (PARTITION BY seen, home, away) AS f FROM p WHERE bad IS NULL),
a AS (SELECT name, entity, coalesce(valid_from, DATE '0001-01-01') AS x, coalesce(valid_to, DATE '9999-12-31') AS y FROM alias), kept AS (SELECT row_id, seen, home, away FROM d WHERE k = 1 AND row_id = f),
h AS (SELECT row_id, count(DISTINCT entity) AS n, min(entity) AS e FROM kept LEFT JOIN a ON a.name = home AND seen BETWEEN x AND y GROUP BY 1), w AS (SELECT row_id, count(DISTINCT entity) AS n, min(entity) AS e FROM kept LEFT JOIN a ON a.name = away AND seen BETWEEN x AND y GROUP BY 1),
s AS (SELECT p.row_id, p.bad, d.k, d.f, h.n AS hn, w.n AS wn, h.e AS he, w.e AS we FROM p LEFT JOIN d USING (row_id) LEFT JOIN h USING (row_id) LEFT JOIN w USING (row_id))
SELECT row_id, CASE WHEN bad IS NOT NULL THEN 'parse' WHEN k > 1 OR row_id != f THEN 'dedupe' WHEN hn != 1 OR wn != 1 THEN 'resolve' WHEN he = we THEN 'contract' ELSE 'accepted' END AS stage,
  CASE WHEN bad IS NOT NULL THEN bad WHEN k > 1 THEN 'conflict' WHEN row_id != f THEN 'duplicate' WHEN hn = 0 THEN 'home unresolved' WHEN hn > 1 THEN 'home ambiguous' WHEN wn = 0 THEN 'away unresolved' WHEN wn > 1 THEN 'away ambiguous' WHEN he = we THEN 'same teams' END AS reason FROM s""", "raw", "alias")
def historical_ingest_job(raw, alias):
    accepted, quarantined = jobs.historical_ingest(raw, alias)
    return accepted.select("row_id", F.lit("accepted").alias("stage"), F.lit(None).cast("string").alias("reason")).unionByName(quarantined)


@query(f"""WITH diff AS ({DIFF}), moved AS (SELECT p.status AS was, c.status AS now FROM snap_prev p JOIN snap_cur c ON p.id = c.id WHERE p.status != 'known' AND p.status != c.status),
apart AS (SELECT unnest(list_filter([CASE WHEN p.id IS NULL THEN 'missing' END, CASE WHEN p.id IS NOT NULL AND c.venue IS DISTINCT FROM p.venue THEN 'venue' END, CASE WHEN p.id IS NOT NULL AND c.status IS DISTINCT FROM p.status THEN 'status' END, CASE WHEN p.id IS NOT NULL AND c.stage IS DISTINCT FROM p.stage THEN 'stage' END], lambda x: x IS NOT NULL)) AS difference FROM snap_cur c LEFT JOIN snap_prev p ON c.id = p.id)
SELECT 'change' AS "check", field AS detail, count(*) AS n FROM diff GROUP BY 2 UNION ALL SELECT 'transition', concat(was, '->', now), count(*) FROM moved GROUP BY 2
UNION ALL SELECT 'stale', status, count(*) FROM snap_cur WHERE id % 48 > 24 OR id % 13 = 0 GROUP BY 2 UNION ALL SELECT 'reconcile', difference, count(*) FROM apart GROUP BY 2""", "snap_prev", "snap_cur")
def live_ingest_job(prev, cur):
    updated = F.when(F.col("id") % 13 != 0, F.expr("TIMESTAMP '2024-01-15 00:00:00' - make_dt_interval(0, id % 48, 0, 0)"))
    return jobs.live_ingest(prev, cur.withColumn("updated", updated), prev, ["venue", "status", "stage"], "2024-01-15 00:00:00", 24)


@query("""WITH o AS (SELECT match_id, count(*) AS n FROM (SELECT match_id FROM pairs WHERE match_id % 3 != 0 UNION ALL SELECT match_id FROM pairs WHERE match_id % 30 = 1) GROUP BY 1), c AS (SELECT match_id FROM pairs WHERE match_id % 4 != 0)
SELECT coalesce(o.match_id, c.match_id) AS match_id, CASE WHEN c.match_id IS NULL THEN 'missing' WHEN o.match_id IS NULL THEN 'unexpected' WHEN o.n > 1 THEN 'repeated' ELSE 'aligned' END AS state FROM o FULL JOIN c ON o.match_id = c.match_id""", "pairs")
def fixture_alignment_join(pairs):
    own = pairs.select("match_id")
    official = own.filter("match_id % 3 != 0").unionByName(own.filter("match_id % 30 = 1"))
    return joins.fixture_alignment(official, own.filter("match_id % 4 != 0"), "match_id")


@query("""WITH r AS (SELECT match_id, array_to_string(list_sort([CAST(home_id % 9 AS VARCHAR), CAST(away_id % 9 AS VARCHAR), CAST(match_id % 9 AS VARCHAR)]), '') AS k FROM pairs), t AS (SELECT k, min(match_id) AS assigned FROM r GROUP BY 1 HAVING min(match_id) % 2 = 0)
SELECT match_id, assigned FROM r LEFT JOIN t USING (k)""", "pairs")
def set_keyed_lookup_join(pairs):
    rows = pairs.select("match_id", F.array(*((F.col(c) % 9).cast("string") for c in ("home_id", "away_id", "match_id"))).alias("members"))
    table = rows.groupBy(F.concat_ws("", F.array_sort("members")).alias("k")).agg(F.min("match_id").alias("assigned")).filter("assigned % 2 = 0")
    return joins.set_keyed_lookup(rows, "members", table, "k").select("match_id", "assigned")


@query("""WITH f AS (SELECT CAST(sum(('0x' || substr(h, 1, 8))::BIGINT) AS BIGINT) AS a, CAST(sum(('0x' || substr(h, 9, 8))::BIGINT) AS BIGINT) AS b, CAST(sum(('0x' || substr(h, 17, 8))::BIGINT) AS BIGINT) AS c, count(*) AS n FROM (SELECT sha256(concat('{"team":', CAST(team AS VARCHAR), ',"visit_id":', CAST(visit_id AS VARCHAR), '}')) AS h FROM visits))
SELECT count(*) AS input_rows, count(*) AS feature_rows, count(DISTINCT team) AS teams, max(kickoff) AS last_kickoff, count(*) FILTER (WHERE kickoff > TIMESTAMP '2024-01-25 00:00:00') AS after_cutoff,
  (SELECT 'rev-' || substr(sha256(concat_ws('|', CAST(n AS VARCHAR), CAST(a AS VARCHAR), CAST(b AS VARCHAR), CAST(c AS VARCHAR))), 1, 16) FROM f) AS revision, count(*) FILTER (WHERE kickoff > TIMESTAMP '2024-01-25 00:00:00') = 0 AS audit_passed FROM visits""", "visits")
def feature_manifest(visits):
    return jobs.feature_manifest(visits, visits.select("visit_id", "team", "kickoff"), "visit_id", "team", "kickoff", "2024-01-25 00:00:00")


def _folds(pairs: DataFrame) -> DataFrame:
    folds = pairs.sparkSession.createDataFrame([("y95", "1995-01-01", "1995-12-31", "1-URGENT"), ("y97", "1997-01-01", "1997-12-31", "2-HIGH")], "fold string, start string, end string, fold_competition string")
    return folds.withColumns({c: F.col(c).cast("date") for c in ("start", "end")})


@query(f"""WITH f AS (SELECT 'y95' AS fold, DATE '1995-01-01' AS s, DATE '1995-12-31' AS e, '1-URGENT' AS c UNION ALL SELECT 'y97', DATE '1997-01-01', DATE '1997-12-31', '2-HIGH'),
o AS (SELECT *, {OUT} AS outcome FROM pairs), r AS (SELECT fold, least(greatest(avg((outcome = 'draw')::INT), 0.05), 0.45) AS d FROM o, f WHERE match_date < s GROUP BY 1),
g AS (SELECT a, k, substr(sha256(concat_ws('|', CAST(a AS VARCHAR), CAST(k AS VARCHAR))), 1, 24) AS param_id FROM (SELECT unnest([0.0, 50.0])::DOUBLE AS a), (SELECT unnest([5.0, 10.0])::DOUBLE AS k)),
t AS (SELECT param_id, fold, outcome, d, 1 / (1 + pow(10.0, -((home_id - away_id) * k + a) / 400.0)) AS e FROM o JOIN f ON match_date BETWEEN f.s AND f.e AND competition = f.c JOIN r USING (fold), g),
l AS (SELECT param_id, fold, count(*) AS n, avg(-ln(greatest(CASE outcome WHEN 'home_win' THEN (1 - d) * e WHEN 'draw' THEN d ELSE (1 - d) * (1 - e) END, 1e-15))) AS loss FROM t GROUP BY 1, 2),
m AS (SELECT param_id, round(avg(loss), 12) AS mean FROM l GROUP BY 1)
SELECT param_id, fold, n, round(loss, 6) AS log_loss, round(mean, 6) AS mean_log_loss, param_id = (SELECT param_id FROM m ORDER BY mean, param_id LIMIT 1) AS selected FROM l JOIN m USING (param_id)""", "pairs")
def grid_search_report(pairs):
    def predict(tests, rate):
        return models.draw_rate_probability(tests.withColumn("difference", (F.col("home_id") - F.col("away_id")) * F.col("scale") + F.col("advantage")), rate)

    out = jobs.grid_search_report(reports.with_outcome(pairs), _folds(pairs), joins.param_grid(pairs.sparkSession, **GRID), predict)
    return out.select("param_id", "fold", "n", r6("log_loss").alias("log_loss"), r6("mean_log_loss").alias("mean_log_loss"), "selected")


@query(f"""WITH o AS (SELECT *, CASE WHEN match_id % 6 != 0 THEN {OUT} END AS outcome FROM pairs), r AS (SELECT least(greatest(avg((outcome = 'draw')::INT), 0.05), 0.45) AS d FROM o WHERE match_date < DATE '1997-06-01'),
p AS (SELECT match_id, outcome, d, 1 / (1 + pow(10.0, -(home_id - away_id) * 10 / 400.0)) AS e FROM o, r WHERE match_date >= DATE '1997-06-01'), q AS (SELECT match_id, outcome, (1 - d) * e AS h, d, (1 - d) * (1 - e) AS a FROM p)
SELECT match_id, round(h, 6) AS p_home, round(d, 6) AS p_draw, round(a, 6) AS p_away, CASE WHEN outcome IS NULL THEN 'pending' ELSE 'scored' END AS status,
  round(CASE outcome WHEN 'home_win' THEN -ln(h) WHEN 'draw' THEN -ln(d) WHEN 'away_win' THEN -ln(a) END, 6) AS log_loss FROM q""", "pairs")
def holdout_scoring(pairs):
    def fit_predict(train, test):
        rate = train.agg(F.avg((F.col("outcome") == "draw").cast("int")).alias("rate"))
        rows = test.join(F.broadcast(rate)).withColumn("difference", (F.col("home_id") - F.col("away_id")) * 10)  # one row
        return models.draw_rate_probability(rows, F.col("rate"))

    known = reports.with_outcome(pairs).withColumn("outcome", F.when(F.col("match_id") % 6 != 0, F.col("outcome")))
    return jobs.holdout_scoring(known, "1997-06-01", fit_predict).select("match_id", *(r6(p).alias(p) for p in jobs.P), "status", r6("log_loss").alias("log_loss"))


@query(None, "pairs")
def predict_upcoming(pairs):
    late = pairs.filter("match_date >= DATE '1998-01-01'")
    status = F.when(F.col("match_id") % 8 == 0, "finished").when(F.col("match_id") % 8 == 1, "postponed").otherwise("scheduled")
    fixtures = late.withColumns({"status": status, "kickoff": F.col("match_date").cast("timestamp"), "result": F.lit(None).cast("string")})
    _, now = ratings.rating_history(pairs.filter("match_date < DATE '1998-01-01'"), pairs.sparkSession.createDataFrame([("p", 20.0, 50.0, 0.15, 365, 0.25)], PARAMS), f"{ledger.shared_folder(pairs.sparkSession)}/ratings-{uuid.uuid4().hex}")
    return jobs.predict_upcoming(pairs, fixtures, "1998-01-01 00:00:00", "1998-01-01 12:00:00", "goal-1", now)


@query(None, "pairs")
def oof_base_features(pairs):
    return jobs.oof_base_features(pairs, ["1997-01-01", "1997-09-01", "1998-03-01"])


def _rows(pairs: DataFrame) -> DataFrame:
    base = reports.with_outcome(pairs).withColumn("difference", (F.col("home_id") - F.col("away_id")) * 10.0)
    return models.draw_rate_probability(base, F.lit(0.25)).withColumn("load", (F.col("match_id") % 7).cast("double"))


def _log_rows(pairs: DataFrame) -> DataFrame:
    return _rows(pairs).withColumns({f"log_{p}": F.log(p) for p in jobs.P}).drop(*jobs.P)


@query(None, "pairs")
def stacked_logistic_challenger(pairs):
    rows = models.nested_temporal_split(_log_rows(pairs), "1997-01-01", 365, 180)
    return jobs.stacked_logistic_challenger(rows, ["log_p_home", "log_p_away", "load"], ["competition"], (0.1, 1.0))


@query(None, "pairs")
def predict_challenger(pairs):
    train = _log_rows(pairs).filter("match_date < DATE '1997-01-01'")
    model = models.multinomial_logistic(train, ["log_p_home", "log_p_away", "load"], [])
    late = _rows(pairs).filter("match_date >= DATE '1997-01-01'")
    return jobs.predict_challenger(late.select("match_id", *jobs.P), late.select("match_id", "load"), model, 1.1)


@query(None, "pairs")
def model_gain_importance(pairs):
    return jobs.model_gain_importance(_rows(pairs).filter("match_date < DATE '1997-01-01'"), ["difference", "load"])


def stream_ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as an arriving stream, appended to a ledger in the shared folder and read back."""
    source = f"{sf_dir}/events.parquet"
    arriving = spark.readStream.schema(spark.read.parquet(source).schema).parquet(f"{source}*").select("event_id", "user_id", "event_type", "ts", "value")
    home = f"{ledger.shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    running = ledger.stream_ledger_append(arriving, f"{home}/ledger", f"{home}/checkpoint", "event_id", ["ts"])
    running.awaitTermination()
    return spark.read.parquet(f"{home}/ledger").select("event_id", "user_id", "event_type", "value")


QUERIES["stream_ledger_append"] = stream_ledger_append
SQL["stream_ledger_append"] = "SELECT event_id, user_id, event_type, value FROM events"
