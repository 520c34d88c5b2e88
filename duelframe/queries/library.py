"""The library's queries over the driver's tables, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.functions import ids, scalars
from duelframe.operators import bootstrap, contracts, joins, reports, scoring, windows
from duelframe.plans import models, ratings
from duelframe.views import oracle, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None, *views: str):
    """Register a query over these views (its arguments), with its SQL."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(view(spark, sf_dir, v) for v in views))
        if sql is not None:
            SQL[f.__name__] = oracle(sql, *views)
        return f

    return add


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# --- projections, contracts -----------------------------------------------------------------------

OUT = "CASE WHEN home_goals > away_goals THEN 'home_win' WHEN home_goals < away_goals THEN 'away_win' ELSE 'draw' END"
SIDES = """sides AS (SELECT match_id, match_date, competition, 'home' AS side, home_id AS team, away_id AS opponent, home_goals AS scored, away_goals AS conceded FROM pairs
  UNION ALL SELECT match_id, match_date, competition, 'away', away_id, home_id, away_goals, home_goals FROM pairs)"""


@query(f"SELECT match_id, {OUT} AS outcome FROM pairs", "pairs")
def outcome_from_scores(pairs):
    return reports.with_outcome(pairs).select("match_id", "outcome")


@query(f"WITH {SIDES} SELECT * FROM sides", "pairs")
def home_away_expand(pairs):
    return reports.home_away_expand(pairs)


@query("""SELECT visit_id, CASE WHEN typed = 'bad' THEN 'invalid value' END AS reason, CASE WHEN typed != 'bad' THEN CAST(typed AS BIGINT) END AS value
  FROM (SELECT visit_id, CASE WHEN visit_id % 7 = 0 THEN 'bad' ELSE CAST(visit_id % 50 AS VARCHAR) END AS typed FROM visits)""", "visits")
def typed_parse_with_reason(visits):
    raw = F.when(F.col("visit_id") % 7 == 0, " x1").otherwise(F.concat(F.lit(" "), (F.col("visit_id") % 50).cast("string")))
    value, reason = contracts.typed_parse(raw, "int", "value")
    return visits.select("visit_id", reason.alias("reason"), value.alias("value"))


@query("""SELECT match_id, CAST(match_date AS VARCHAR) AS same_date_batch_id, substr(sha256(concat('src', chr(10), CAST(match_date AS VARCHAR), chr(10), CAST(home_id AS VARCHAR), chr(10), CAST(away_id AS VARCHAR))), 1, 20) AS row_hash,
  CASE WHEN match_date < DATE '1994-01-01' THEN 'pre_rating_history' WHEN match_date < DATE '1997-01-01' THEN 'rating_history' ELSE 'evaluation' END AS period FROM pairs""", "pairs")
def canonical_projection(pairs):
    h = ids.row_identity_hash(F.lit("src"), F.col("match_date"), F.col("home_id"), F.col("away_id"))
    return pairs.select("match_id", F.date_format("match_date", "yyyy-MM-dd").alias("same_date_batch_id"), h.alias("row_hash"), scalars.modeling_period(F.col("match_date"), "1994-01-01", "1997-01-01").alias("period"))


@query("SELECT match_id, CASE WHEN contains(lower(competition), 'urgent') OR contains(lower(competition), 'high') THEN 'continental' ELSE 'other' END AS kind FROM pairs", "pairs")
def match_type_classifier(pairs):
    return pairs.select("match_id", scalars.match_type_classifier(F.col("competition"), ("urgent", "high")).alias("kind"))


@query("""SELECT match_id, status, status IN ('home_team', 'away_team') AS eligible FROM (SELECT match_id, CASE WHEN match_id % 6 = 0 THEN 'neutral' WHEN match_id % 40 = home_id THEN 'home_team' WHEN match_id % 40 = away_id THEN 'away_team' ELSE 'unknown' END AS status FROM pairs)""", "pairs")
def home_advantage_status(pairs):
    out = pairs.select("match_id", scalars.home_advantage_status(F.col("match_id") % 6 == 0, F.col("match_id") % 40, F.col("home_id"), F.col("away_id")).alias("status"))
    return out.withColumn("eligible", F.col("status").isin("home_team", "away_team"))


STATUSES = {"FT": "played", "NS": "scheduled", "IN_PLAY": "in_progress", "1H": "in_progress", "PST": "postponed", "CANC": "cancelled"}


@query("""SELECT visit_id, CASE raw WHEN 'ft' THEN 'played' WHEN 'in-play' THEN 'in_progress' WHEN 'PST' THEN 'postponed' ELSE 'scheduled' END AS status
  FROM (SELECT visit_id, CASE visit_id % 4 WHEN 0 THEN 'ft' WHEN 1 THEN 'in-play' WHEN 2 THEN 'PST' ELSE 'other' END AS raw FROM visits)""", "visits")
def status_normalizer(visits):
    raw = F.element_at(F.array(*(F.lit(s) for s in ("ft", "in-play", "PST", "other"))), (F.col("visit_id") % 4 + 1).cast("int"))
    return visits.select("visit_id", scalars.status_normalizer(raw, STATUSES).alias("status"))


@query("SELECT visit_id, CASE WHEN visit_id % 3 = 0 AND visit_id % 4 = 0 THEN 'tbd' WHEN visit_id % 3 = 0 OR visit_id % 4 = 0 THEN 'partially_known' ELSE 'known' END AS participants FROM visits", "visits")
def participant_status(visits):
    some = lambda k: F.when(F.col("visit_id") % k != 0, F.lit("x"))
    return visits.select("visit_id", scalars.participant_status(some(3), some(4)).alias("participants"))


@query("""SELECT match_id, CASE WHEN match_id % 3 = 0 THEN coalesce(CASE WHEN match_id % 2 = 0 THEN home_goals + 2 END, CASE WHEN away_goals < home_goals THEN home_goals + away_goals ELSE away_goals END)
  ELSE CASE WHEN away_goals < home_goals THEN home_goals + away_goals ELSE away_goals END END AS after_extra FROM pairs""", "pairs")
def after_extra_time_rebuild(pairs):
    duration = F.when(F.col("match_id") % 3 == 0, "EXTRA_TIME").otherwise("REGULAR")
    full = F.when(F.col("match_id") % 2 == 0, F.col("home_goals") + 2)
    return pairs.select("match_id", scalars.after_extra_time(duration, F.col("home_goals"), full, F.col("away_goals")).alias("after_extra"))


@query("SELECT match_id, CASE WHEN match_id % 4 IN (0, 1) THEN home_goals END AS kept FROM pairs", "pairs")
def status_gated_scores(pairs):
    status = F.element_at(F.array(*(F.lit(s) for s in ("played", "in_progress", "scheduled", "cancelled"))), (F.col("match_id") % 4 + 1).cast("int"))
    return pairs.select("match_id", scalars.status_gated(status, F.col("home_goals"), ("played", "in_progress")).alias("kept"))


@query("""SELECT match_id, concat_ws(';', CASE WHEN match_id % 9 = 0 AND match_id % 8 = 0 THEN 'scores forbidden' END, CASE WHEN match_id % 4 = 0 AND home_goals <= away_goals THEN 'result mismatch' END,
  CASE WHEN match_id % 5 = 1 AND home_goals != away_goals THEN 'extra time without a tie' END, CASE WHEN match_id % 5 = 1 AND home_goals - 1 + match_id % 3 < home_goals THEN 'extra time score decreases' END) AS violations FROM pairs""", "pairs")
def row_contract_check(pairs):
    m = F.col("match_id")
    h, a = F.col("home_goals"), F.col("away_goals")
    none = F.lit(None).cast("long")
    v = contracts.row_contract(F.col("home_id"), F.col("away_id"), F.when((m % 9 == 0) & (m % 8 == 0), "scheduled").otherwise("played"), h, a, F.when(m % 4 == 0, "home_win"), scalars.outcome_from_scores(h, a), F.when(m % 5 == 1, h - 1 + m % 3), F.when(m % 5 == 1, a + 9), none, none)
    return pairs.select("match_id", F.array_join(v, ";").alias("violations"))


@query("""SELECT site_id, concat_ws(';', CASE WHEN site_id % 5 = 0 THEN 'zone' END, CASE WHEN site_id % 4 = 3 THEN 'clock' END, CASE WHEN site_id % 3 = 0 THEN 'slug' END) AS violations FROM sites""", "sites")
def field_format_check(sites):
    k = F.col("site_id")
    v = contracts.field_format(F.when(k % 5 == 0, "+15:00").otherwise(F.col("zone")), F.when(k % 4 == 3, "24:00").otherwise("23:59"), F.when(k % 3 == 0, "A b").otherwise("a-b1"))
    return sites.select("site_id", F.array_join(v, ";").alias("violations"))


REASON = """CASE WHEN match_date < DATE '1993-01-01' THEN 'before_history' WHEN match_id % 11 = 0 THEN 'incomplete' WHEN match_id % 13 = 0 THEN 'unresolved_category' WHEN competition NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'category_not_allowed'
  WHEN home_id % 17 = 0 THEN 'team_status' WHEN away_id % 19 = 0 THEN 'team_type' WHEN match_id % 23 = 0 THEN 'neutral_unknown' END"""


def _reason() -> Column:
    m = F.col("match_id")
    return contracts.exclusion_reason(F.col("match_date"), "1993-01-01", m % 11 != 0, F.when(m % 13 != 0, F.col("competition")), ("1-URGENT", "2-HIGH", "3-MEDIUM"), F.col("home_id") % 17 != 0, F.col("away_id") % 19 != 0, F.when(m % 23 != 0, True))


@query(f"SELECT match_id, {REASON} AS reason, {REASON} IS NULL AS model_eligible FROM pairs", "pairs")
def exclusion_reason(pairs):
    return pairs.select("match_id", _reason().alias("reason")).withColumn("model_eligible", F.col("reason").isNull())


@query("""SELECT visit_id, CASE WHEN visit_id % 8 = 0 THEN 'finished' WHEN visit_id % 8 = 1 THEN 'in_progress' WHEN visit_id % 8 = 2 THEN 'interrupted' WHEN visit_id % 8 = 3 THEN 'unsupported_status' WHEN visit_id % 5 = 0 THEN 'missing_kickoff'
  WHEN kickoff <= TIMESTAMP '2024-01-10 00:00:00' THEN 'kickoff_before_cutoff' WHEN kickoff <= TIMESTAMP '2024-01-12 00:00:00' THEN 'kickoff_before_creation' WHEN visit_id % 7 = 0 THEN 'unresolved_team' WHEN visit_id % 9 = 0 THEN 'result_present' END AS reason FROM visits""", "visits")
def upcoming_eligibility(visits):
    v = F.col("visit_id")
    status = F.when(v % 8 == 0, "finished").when(v % 8 == 1, "in_progress").when(v % 8 == 2, "postponed").when(v % 8 == 3, "odd").otherwise("scheduled")
    at = lambda s: F.lit(s).cast("timestamp")
    return visits.select("visit_id", contracts.upcoming_eligibility(status, F.when(v % 5 != 0, F.col("kickoff")), at("2024-01-10 00:00:00"), at("2024-01-12 00:00:00"), F.when(v % 7 != 0, v), v, F.when(v % 9 == 0, "draw")).alias("reason"))


VALIDITY = """CASE WHEN forecast_id % 10 = 0 THEN 'created_after_kickoff' WHEN forecast_id % 10 = 1 THEN 'cutoff_after_creation' WHEN forecast_id % 10 = 2 THEN 'probabilities' WHEN forecast_id % 10 = 3 THEN 'missing_version' WHEN forecast_id % 10 = 4 THEN 'missing_checksum' WHEN forecast_id % 10 = 5 THEN 'result_filled' END"""


def _validity() -> Column:
    k, at = F.col("forecast_id") % 10, F.col("created_at")
    hour = F.expr("INTERVAL 1 HOUR")
    p = [F.when(k == 2, F.col("p_home") + 0.1).otherwise(F.col("p_home")), F.col("p_draw"), F.col("p_away")]
    return contracts.prospective_validity(at, F.when(k == 1, at + hour).otherwise(at), F.when(k == 0, at).otherwise(at + hour), p, F.when(k != 3, "v1"), F.when(k != 4, "c"), F.when(k == 5, "draw"))


@query(f"SELECT forecast_id, {VALIDITY} AS reason FROM forecasts", "forecasts")
def prospective_validity(forecasts):
    return forecasts.select("forecast_id", _validity().alias("reason"))


@query("SELECT forecast_id FROM forecasts WHERE forecast_id % 6 = 0", "forecasts")
def probability_row_check(forecasts):
    odd = F.when(F.col("forecast_id") % 6 == 0, F.col("p_draw") * 1.01).otherwise(F.col("p_draw"))
    return forecasts.filter(~contracts.probabilities_ok(F.col("p_home"), odd, F.col("p_away"))).select("forecast_id")


@query(f"""SELECT match_id AS key, CASE WHEN reason IS NULL THEN 'evaluable' ELSE 'not_evaluable' END AS state, reason FROM (SELECT match_id, CASE WHEN match_id % 10 = 0 THEN 'interrupted' WHEN match_id % 10 = 1 THEN 'not_final' WHEN match_id % 10 = 2 THEN 'incomplete' WHEN match_id % 10 = 3 AND {OUT} != 'draw' THEN 'result_mismatch' END AS reason FROM pairs)""", "pairs")
def result_contract(pairs):
    k = F.col("match_id") % 10
    status = F.when(k == 0, "postponed").when(k == 1, "scheduled").otherwise("finished")
    return contracts.result_contract(pairs, "match_id", status, F.when(k != 2, F.col("home_goals")), F.col("away_goals"), F.when(k == 3, "draw"), scalars.outcome_from_scores(F.col("home_goals"), F.col("away_goals")))


@query("""SELECT match_id, CASE WHEN home_goals > away_goals THEN 'home' WHEN home_goals < away_goals THEN 'away' WHEN match_id % 3 > match_id % 2 THEN 'home' WHEN match_id % 3 < match_id % 2 THEN 'away' WHEN match_id % 7 > match_id % 5 THEN 'home' WHEN match_id % 7 < match_id % 5 THEN 'away' END AS through FROM pairs""", "pairs")
def advancing_side(pairs):
    m = F.col("match_id")
    return pairs.select("match_id", scalars.advancing_side(scalars.outcome_from_scores(F.col("home_goals"), F.col("away_goals")), m % 3, m % 2, m % 7, m % 5).alias("through"))


@query("""SELECT visit_id, CASE WHEN kickoff > TIMESTAMP '2024-01-15 00:00:00' THEN 'scheduled' WHEN kickoff > TIMESTAMP '2024-01-14 21:00:00' THEN 'in_progress' ELSE 'finished' END AS status, CASE WHEN kickoff <= TIMESTAMP '2024-01-15 00:00:00' THEN value END AS value FROM visits""", "visits")
def as_of_mask(visits):
    return contracts.as_of_mask(visits.withColumn("status", F.lit("finished")), "kickoff", "status", ["value"], "2024-01-15 00:00:00", 3).select("visit_id", "status", "value")


BUCKETS = [("under_6h", None, 6.0), ("6h_to_24h", 6.0, 24.0), ("over_24h", 24.0, 40.0)]


@query("SELECT forecast_id, CASE WHEN lead_hours < 6 THEN 'under_6h' WHEN lead_hours < 24 THEN '6h_to_24h' WHEN lead_hours < 40 THEN 'over_24h' ELSE 'unbucketed' END AS bucket FROM forecasts", "forecasts")
def horizon_bucket(forecasts):
    return forecasts.select("forecast_id", scalars.horizon_bucket(F.col("lead_hours"), BUCKETS).alias("bucket"))


@query("SELECT match_id, home_goals - away_goals AS gd, CASE WHEN abs(home_goals - away_goals) >= 3 THEN 'clear' WHEN home_goals = away_goals THEN 'level' ELSE 'close' END AS label, competition IN ('4-NOT SPECIFIED', '5-LOW') AS friendly FROM pairs", "pairs")
def segment_labels(pairs):
    gd = F.col("home_goals") - F.col("away_goals")
    return pairs.select("match_id", gd.alias("gd"), F.when(F.abs(gd) >= 3, "clear").when(gd == 0, "level").otherwise("close").alias("label"), F.col("competition").isin("4-NOT SPECIFIED", "5-LOW").alias("friendly"))


@query("SELECT visit_id, value FROM visits", "visits")
def feature_whitelist(visits):
    return contracts.feature_whitelist(visits, ["value"], ["visit_id"])


@query(f"SELECT match_id, match_date FROM pairs WHERE {REASON} IS NULL ORDER BY match_date, match_id", "pairs")
def eligible_training_filter(pairs):
    return pairs.filter(_reason().isNull()).select("match_id", "match_date").orderBy("match_date", "match_id")


@query("SELECT status AS state, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM snap_cur GROUP BY 1", "snap_cur")
def fixture_state_split(snap_cur):
    return reports.fixture_state_split(snap_cur, F.col("status"), "id")


# --- joins ----------------------------------------------------------------------------------------

ALIASED = """hit AS (SELECT n.row_id, count(DISTINCT a.entity) AS k, min(a.entity) AS one FROM names n LEFT JOIN alias a ON n.name = a.name AND n.seen >= coalesce(a.valid_from, DATE '0001-01-01') AND n.seen <= coalesce(a.valid_to, DATE '9999-12-31') GROUP BY 1)"""


@query(f"WITH {ALIASED} SELECT row_id, CASE WHEN k = 1 THEN one END AS entity, CASE WHEN k = 0 THEN 'unresolved' WHEN k = 1 THEN 'resolved' ELSE 'ambiguous' END AS resolution FROM hit", "names", "alias")
def temporal_alias_join(names, alias):
    return joins.temporal_alias_join(names, alias)


@query(f"WITH {ALIASED} SELECT h.row_id, CASE WHEN k = 1 THEN one WHEN k = 0 THEN s.site_id END AS entity FROM hit h JOIN names n ON n.row_id = h.row_id LEFT JOIN sites s ON s.name = n.name", "names", "alias", "sites")
def alias_or_name_fallback_join(names, alias, sites):
    return joins.alias_or_name_fallback(names, alias, sites)


@query("""SELECT x.name, x.entity, y.entity AS other FROM alias x JOIN alias y ON x.name = y.name AND x.entity < y.entity AND coalesce(x.valid_from, DATE '0001-01-01') <= coalesce(y.valid_to, DATE '9999-12-31') AND coalesce(y.valid_from, DATE '0001-01-01') <= coalesce(x.valid_to, DATE '9999-12-31')""", "alias")
def alias_conflict_self_join(alias):
    return joins.alias_conflicts(alias)


@query("SELECT name FROM (SELECT DISTINCT name FROM names) WHERE name NOT IN (SELECT name FROM alias)", "names", "alias")
def orphan_anti_join(names, alias):
    return joins.orphans(names.select("name").distinct(), alias, "name")


@query("""WITH seen AS (SELECT name, count(*) AS sightings, min(seen) AS first_seen, max(seen) AS last_seen FROM names GROUP BY 1)
SELECT s.name, sightings, first_seen, last_seen, count(DISTINCT a.entity) AS entities, count(DISTINCT a.entity) = 1 AS resolved FROM seen s LEFT JOIN alias a ON s.name = a.name AND coalesce(a.valid_from, DATE '0001-01-01') <= last_seen AND coalesce(a.valid_to, DATE '9999-12-31') >= first_seen GROUP BY 1, 2, 3, 4""", "names", "alias")
def alias_window_overlap_join(names, alias):
    return joins.alias_window_overlap(names, alias)


@query("""WITH aux AS (SELECT match_id AS aux_id, CASE WHEN match_id % 5 = 0 THEN match_date + 20000 ELSE match_date END AS match_date, home_id, away_id FROM pairs WHERE match_id % 3 = 0),
x AS (SELECT *, row_number() OVER (PARTITION BY match_date, home_id, away_id ORDER BY aux_id) AS nth FROM aux), k AS (SELECT DISTINCT match_date, home_id, away_id FROM pairs)
SELECT aux_id, CASE WHEN k.home_id IS NULL THEN 'unmatched' WHEN nth > 1 THEN 'duplicate' ELSE 'matched' END AS state FROM x LEFT JOIN k USING (match_date, home_id, away_id)""", "pairs")
def shootout_semi_anti_join(pairs):
    aux = pairs.filter("match_id % 3 = 0").select(F.col("match_id").alias("aux_id"), F.when(F.col("match_id") % 5 == 0, F.date_add("match_date", 20000)).otherwise(F.col("match_date")).alias("match_date"), "home_id", "away_id")
    return joins.semi_anti_split(aux, pairs, ["match_date", "home_id", "away_id"])


@query("SELECT visit_id, lag(visit_id) OVER (PARTITION BY team ORDER BY kickoff, visit_id) AS previous_visit_id FROM visits", "visits")
def previous_match_asof_join(visits):
    return joins.previous_asof(visits, "team", ["kickoff", "visit_id"], ["visit_id"]).select("visit_id", "previous_visit_id")


@query("""WITH v AS (SELECT *, kickoff + INTERVAL 1 HOUR * CAST(visit_id % 72 AS INT) AS cutoff FROM visits)
SELECT a.visit_id, arg_max(b.visit_id, struct_pack(k := b.kickoff, v := b.visit_id)) AS previous_id FROM v a LEFT JOIN v b ON a.team = b.team AND b.kickoff < a.kickoff AND b.cutoff <= a.cutoff GROUP BY 1""", "visits")
def previous_match_by_cutoff(visits):
    return joins.previous_asof_by_cutoff(visits.withColumn("cutoff", F.expr("kickoff + make_dt_interval(0, visit_id % 72, 0, 0)")))


@query("SELECT a.visit_id, count(b.visit_id) AS n FROM visits a LEFT JOIN visits b ON a.team = b.team AND b.kickoff < a.kickoff AND b.kickoff >= a.kickoff - INTERVAL 7 DAY GROUP BY 1", "visits")
def interval_self_join(visits):
    return joins.interval_self_join(visits, 7)


@query(f"WITH {SIDES} SELECT h.match_id, h.scored AS home_scored, h.conceded AS home_conceded, a.scored AS away_scored, a.conceded AS away_conceded, h.scored - a.scored AS diff_scored, h.conceded - a.conceded AS diff_conceded FROM sides h JOIN sides a ON h.match_id = a.match_id AND h.side = 'home' AND a.side = 'away'", "pairs")
def home_away_pair_join(pairs):
    return joins.home_away_pair(reports.home_away_expand(pairs), "match_id", ["scored", "conceded"])


@query("""SELECT m.match_id, m.match_date, v.n AS home_visits FROM pairs m JOIN (SELECT team, count(*) AS n FROM visits GROUP BY 1) v ON v.team = m.home_id""", "pairs", "visits")
def feature_assembly_join(pairs, visits):
    counts = visits.groupBy(F.col("team").alias("home_id")).agg(F.count("*").alias("home_visits"))
    return pairs.join(counts, "home_id").select("match_id", "match_date", "home_visits")


@query(f"""WITH r AS (SELECT match_id AS key, {OUT} AS result FROM pairs WHERE match_id % 4 != 0)
SELECT forecast_id, CASE WHEN r.key IS NULL THEN 'missing_result_contract' END AS reason, r.result FROM forecasts f LEFT JOIN r ON r.key = f.forecast_id""", "forecasts", "pairs")
def prediction_result_join(forecasts, pairs):
    r = reports.with_outcome(pairs.filter("match_id % 4 != 0")).select(F.col("match_id").alias("key"), F.col("outcome").alias("result"))
    return forecasts.join(r, F.col("forecast_id") == F.col("key"), "left").select("forecast_id", F.when(F.col("key").isNull(), "missing_result_contract").alias("reason"), "result")


@query("""SELECT a.forecast_id, 'sharp' AS model, round(-ln(greatest(CASE a.outcome WHEN 'home_win' THEN a.p_home WHEN 'draw' THEN a.p_draw ELSE a.p_away END, 1e-15)) + ln(1.0 / 3), 6) AS delta FROM forecasts a""", "forecasts")
def paired_model_join(forecasts):
    losses = scoring.with_losses(forecasts).select("forecast_id", F.explode(F.array(F.struct(F.lit("sharp").alias("model"), F.col("log_loss").alias("loss")), F.struct(F.lit("uniform").alias("model"), (-F.log(F.lit(1 / 3))).alias("loss")))).alias("x")).select("forecast_id", "x.model", "x.loss")
    return joins.paired_deltas(losses, "forecast_id", "model", "loss", "uniform").withColumn("delta", r6("delta"))


DIFF = """SELECT c.id, 'new' AS field, NULL AS was, NULL AS now FROM snap_cur c LEFT JOIN snap_prev p ON c.id = p.id WHERE p.id IS NULL
UNION ALL SELECT c.id, 'venue', CAST(p.venue AS VARCHAR), CAST(c.venue AS VARCHAR) FROM snap_cur c JOIN snap_prev p ON c.id = p.id WHERE c.venue IS DISTINCT FROM p.venue
UNION ALL SELECT c.id, 'status', p.status, c.status FROM snap_cur c JOIN snap_prev p ON c.id = p.id WHERE c.status IS DISTINCT FROM p.status
UNION ALL SELECT c.id, 'stage', p.stage, c.stage FROM snap_cur c JOIN snap_prev p ON c.id = p.id WHERE c.stage IS DISTINCT FROM p.stage"""


@query(DIFF, "snap_prev", "snap_cur")
def snapshot_diff_join(prev, cur):
    return joins.snapshot_diff(prev, cur, "id", ["venue", "status", "stage"])


@query("SELECT p.id, p.status AS was, c.status AS now FROM snap_prev p JOIN snap_cur c ON p.id = c.id WHERE p.status != 'known' AND p.status != c.status", "snap_prev", "snap_cur")
def status_transition_join(prev, cur):
    return joins.status_transitions(prev, cur)


@query("""SELECT c.id, unnest(list_filter([CASE WHEN p.id IS NULL THEN 'missing' END, CASE WHEN p.id IS NOT NULL AND c.venue IS DISTINCT FROM p.venue THEN 'venue' END, CASE WHEN p.id IS NOT NULL AND c.stage IS DISTINCT FROM p.stage THEN 'stage' END], lambda x: x IS NOT NULL)) AS difference FROM snap_cur c LEFT JOIN snap_prev p ON c.id = p.id""", "snap_prev", "snap_cur")
def cross_source_reconcile_join(prev, cur):
    return joins.reconcile(cur, prev, ["id"], ["venue", "stage"])


@query("""WITH live AS (SELECT match_id + 100000000 AS match_id, CASE WHEN match_id % 2 = 0 THEN match_date + 20000 ELSE match_date END AS match_date, home_id, away_id FROM pairs WHERE match_id % 3 = 0),
f AS (SELECT *, row_number() OVER (PARTITION BY match_date, home_id, away_id ORDER BY match_id) AS nth FROM live)
SELECT match_id, match_date, home_id, away_id FROM pairs UNION ALL SELECT match_id, match_date, home_id, away_id FROM f WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.match_date = f.match_date AND p.home_id = f.home_id AND p.away_id = f.away_id)""", "pairs")
def append_if_absent_join(pairs):
    own = pairs.select("match_id", "match_date", "home_id", "away_id")
    live = own.filter("match_id % 3 = 0").select((F.col("match_id") + 100_000_000).alias("match_id"), F.when(F.col("match_id") % 2 == 0, F.date_add("match_date", 20000)).otherwise(F.col("match_date")).alias("match_date"), "home_id", "away_id")
    return joins.append_if_absent(own, live, ["match_date", "home_id", "away_id"], "match_id")


@query("""WITH x AS (SELECT fixture_id, forecast_id, created_at, row_number() OVER (PARTITION BY fixture_id ORDER BY created_at DESC, forecast_id DESC) AS r FROM forecasts WHERE created_at <= TIMESTAMP '2024-01-20 00:00:00') SELECT fixture_id, forecast_id FROM x WHERE r = 1""", "forecasts")
def latest_compatible_prediction_asof(forecasts):
    fixtures = forecasts.select("fixture_id").distinct().withColumn("as_of", F.lit("2024-01-20 00:00:00").cast("timestamp"))
    return joins.latest_compatible(fixtures, forecasts.select("fixture_id", "forecast_id", "created_at"))


@query("""WITH a AS (SELECT fixture_id, avg(lead_hours) AS x FROM forecasts WHERE fixture_id % 3 != 0 GROUP BY 1), b AS (SELECT fixture_id, avg(p_home) AS y FROM forecasts WHERE fixture_id % 2 = 0 GROUP BY 1)
SELECT count(*) AS shared, round(avg(x), 6) AS mean_a, round(avg(y), 6) AS mean_b, round(avg(x - y), 6) AS mean_delta FROM a JOIN b USING (fixture_id)""", "forecasts")
def shared_fixture_compare(forecasts):
    a = forecasts.filter("fixture_id % 3 != 0").groupBy("fixture_id").agg(F.avg("lead_hours").alias("x"))
    b = forecasts.filter("fixture_id % 2 = 0").groupBy("fixture_id").agg(F.avg("p_home").alias("y"))
    return a.join(b, "fixture_id").agg(F.count("*").alias("shared"), r6(F.avg("x")).alias("mean_a"), r6(F.avg("y")).alias("mean_b"), r6(F.avg(F.col("x") - F.col("y"))).alias("mean_delta"))


# --- aggregations ---------------------------------------------------------------------------------

STAND = f"""{SIDES}, st AS (SELECT competition, team, count(*) AS played, count(*) FILTER (WHERE scored > conceded) AS won, count(*) FILTER (WHERE scored = conceded) AS drawn, count(*) FILTER (WHERE scored < conceded) AS lost,
  CAST(sum(CASE WHEN scored > conceded THEN 3 WHEN scored = conceded THEN 1 ELSE 0 END) AS BIGINT) AS points, CAST(sum(scored) AS BIGINT) AS scored, CAST(sum(conceded) AS BIGINT) AS conceded, CAST(sum(scored - conceded) AS BIGINT) AS difference FROM sides GROUP BY 1, 2)"""


@query(f"WITH {STAND} SELECT * FROM st", "pairs")
def group_standings(pairs):
    return reports.group_standings(pairs)


@query(f"WITH {STAND} SELECT competition, team, points FROM st ORDER BY points DESC, competition, team LIMIT 10", "pairs")
def top_n_rows(pairs):
    return reports.group_standings(pairs).select("competition", "team", "points").orderBy(F.desc("points"), "competition", "team").limit(10)


@query(f"SELECT match_id, match_date FROM pairs ORDER BY match_date, match_id", "pairs")
def deterministic_order(pairs):
    return pairs.select("match_id", "match_date").orderBy("match_date", "match_id")


@query(f"""SELECT 'reason' AS key, {REASON} AS value, count(*) AS n FROM pairs GROUP BY 2 UNION ALL SELECT 'year', CAST(year(match_date) AS VARCHAR), count(*) FROM pairs GROUP BY 2 UNION ALL SELECT 'competition', competition, count(*) FROM pairs GROUP BY 2""", "pairs")
def count_by_key_report(pairs):
    return reports.count_by_keys(pairs, {"reason": _reason(), "year": F.year("match_date"), "competition": F.col("competition")})


@query("SELECT (SELECT count(DISTINCT t) FROM (SELECT home_id AS t FROM pairs UNION SELECT away_id FROM pairs)) AS teams, min(match_date) AS first_date, max(match_date) AS last_date, count(*) AS matches FROM pairs", "pairs")
def distinct_entities_two_columns(pairs):
    return reports.distinct_entities(pairs)


@query("SELECT name, count(*) AS n, min(seen) AS first_seen, max(seen) AS last_seen FROM names GROUP BY 1", "names")
def name_observation_stats(names):
    return names.groupBy("name").agg(F.count("*").alias("n"), F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))


COVER = """x AS (SELECT competition, kickoff, CASE WHEN visit_id % 10 != 0 THEN value END AS a, CASE WHEN visit_id % 3 = 0 THEN value END AS b FROM visits),
u AS (SELECT 'a' AS feature, competition, a IS NOT NULL AS k FROM x UNION ALL SELECT 'b', competition, b IS NOT NULL FROM x),
c AS (SELECT feature, 'all' AS level, 'all' AS value, count(*) AS row_count, count(*) FILTER (WHERE k) AS known FROM u GROUP BY 1 UNION ALL SELECT feature, 'competition', competition, count(*), count(*) FILTER (WHERE k) FROM u GROUP BY 1, 3)"""


def _coverage(visits: DataFrame) -> DataFrame:
    v = F.col("visit_id")
    return reports.feature_coverage(visits.select("competition", F.when(v % 10 != 0, F.col("value")).alias("a"), F.when(v % 3 == 0, F.col("value")).alias("b")), ["a", "b"], ["competition"])


@query(f"WITH {COVER} SELECT feature, level, value, row_count, known, round(known / row_count, 6) AS ratio FROM c", "visits")
def feature_coverage(visits):
    return _coverage(visits).withColumn("ratio", r6("ratio"))


@query(f"WITH {COVER} SELECT feature, round(known / row_count, 6) AS ratio, CASE WHEN known / row_count >= 0.8 THEN 'trainable' ELSE 'indicator_only' END AS tier FROM c WHERE level = 'all'", "visits")
def feature_tiering(visits):
    return reports.feature_tiering(_coverage(visits)).withColumn("ratio", r6("ratio"))


@query("SELECT competition, count(*) AS n, min(value) AS min, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS p75, max(value) AS max FROM visits GROUP BY 1", "visits")
def distribution_summary(visits):
    return reports.distribution_summary(visits, "value", "competition").withColumns({c: r6(c) for c in ("p25", "median", "p75")})


@query("SELECT count(*) FILTER (WHERE value < 1) AS low, count(*) FILTER (WHERE value > 100) AS high, count(*) - count(DISTINCT (team, competition)) AS duplicates FROM visits", "visits")
def impossible_and_outlier_counts(visits):
    return reports.impossible_counts(visits, ["team", "competition"], {"low": F.col("value") < 1, "high": F.col("value") > 100})


@query(f"""WITH {SIDES}, s AS (SELECT * FROM sides WHERE NOT (match_id % 50 = 0 AND side = 'away') UNION ALL SELECT * FROM sides WHERE match_id % 70 = 1 AND side = 'home'), r AS (
SELECT 'negative_difference' AS rule FROM s WHERE scored - conceded < -2 UNION ALL SELECT 'duplicate_team_row' FROM s GROUP BY match_id, team HAVING count(*) > 1 UNION ALL SELECT 'not_two_sides' FROM s GROUP BY match_id HAVING count(*) != 2) SELECT rule, count(*) AS n FROM r GROUP BY 1""", "pairs")
def leakage_audit(pairs):
    sides = reports.home_away_expand(pairs)
    odd = sides.filter(~((F.col("match_id") % 50 == 0) & (F.col("side") == "away"))).unionByName(sides.filter("match_id % 70 = 1 AND side = 'home'"))
    return reports.leakage_audit(odd, [(F.col("scored") - F.col("conceded") < -2, "negative_difference")])


TRUE = "CASE outcome WHEN 'home_win' THEN p_home WHEN 'draw' THEN p_draw ELSE p_away END"
HIT = "CASE WHEN p_home >= p_draw AND p_home >= p_away THEN 'home_win' WHEN p_draw >= p_away THEN 'draw' ELSE 'away_win' END = outcome"
IH, ID, IA = (f"(outcome = '{o}')::INT" for o in ("home_win", "draw", "away_win"))
LOSS = f"""l AS (SELECT *, {TRUE} AS p_true, -ln(greatest({TRUE}, 1e-15)) AS log_loss, pow(p_home - {IH}, 2) + pow(p_draw - {ID}, 2) + pow(p_away - {IA}, 2) AS brier,
  (pow(p_home - {IH}, 2) + pow(p_home - {IH} + p_draw - {ID}, 2)) / 2 AS rps, ({HIT})::INT AS hit FROM forecasts)"""
AVGS = "count(*) AS n, round(avg(log_loss), 6) AS log_loss, round(avg(brier), 6) AS brier, round(avg(rps), 6) AS rps, round(avg(hit), 6) AS accuracy, round(avg(p_true), 6) AS mean_true_probability"
METRICS = ("log_loss", "brier", "rps", "accuracy", "mean_true_probability")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns or METRICS})


@query(f"WITH {LOSS} SELECT {AVGS} FROM l", "forecasts")
def proper_scores(forecasts):
    return _rounded(scoring.proper_scores(forecasts))


@query(f"WITH {LOSS} SELECT coalesce(CASE WHEN fold != 'error' THEN fold END, 'none') AS grp, {AVGS} FROM l GROUP BY 1", "forecasts")
def metrics_by_group(forecasts):
    return _rounded(scoring.metrics_by_group(forecasts, F.when(F.col("fold") != "error", F.col("fold")), "none"))


@query(f"WITH {LOSS} SELECT 'fold' AS segment, fold AS segment_value, {AVGS} FROM l GROUP BY 2 UNION ALL SELECT 'early', CASE WHEN lead_hours >= 6 THEN 'yes' ELSE 'no' END, {AVGS} FROM l GROUP BY 2", "forecasts")
def segment_metrics(forecasts):
    return _rounded(scoring.segment_metrics(forecasts, {"fold": F.col("fold"), "early": F.when(F.col("lead_hours") >= 6, "yes").otherwise("no")}))


BIN = "((p >= 0.1)::INT + (p >= 0.2)::INT + (p >= 0.30000000000000004)::INT + (p >= 0.4)::INT + (p >= 0.5)::INT + (p >= 0.6000000000000001)::INT + (p >= 0.7000000000000001)::INT + (p >= 0.8)::INT + (p >= 0.9)::INT)"
CLASSES = f"""k AS (SELECT fold, 'home_win' AS class, CAST(p_home AS DOUBLE) AS p, {IH} AS hit FROM forecasts UNION ALL SELECT fold, 'draw', CAST(p_draw AS DOUBLE), {ID} FROM forecasts UNION ALL SELECT fold, 'away_win', CAST(p_away AS DOUBLE), {IA} FROM forecasts),
b AS (SELECT fold, class, {BIN} AS bin, count(*) AS n, avg(p) AS mean_p, avg(hit) AS observed FROM k GROUP BY 1, 2, 3)"""


@query(f"WITH {CLASSES} SELECT fold, class, bin, n, round(mean_p, 6) AS mean_p, round(observed, 6) AS observed FROM b", "forecasts")
def calibration_curve(forecasts):
    return _rounded(scoring.calibration_curve(forecasts, "fold"), "mean_p", "observed")


@query(f"WITH {CLASSES}, e AS (SELECT fold, class, sum(n * abs(mean_p - observed)) / sum(n) AS e FROM b GROUP BY 1, 2) SELECT fold, round(avg(e), 6) AS ece FROM e GROUP BY 1", "forecasts")
def classwise_ece(forecasts):
    return _rounded(scoring.classwise_ece(forecasts, "fold"), "ece")


@query(f"""WITH t AS (SELECT fixture_id, greatest(p_home, p_draw, p_away) AS p, ({HIT})::INT AS hit FROM forecasts), b AS (SELECT fixture_id, {BIN} AS bin, count(*) AS n, avg(p) AS mean_p, avg(hit) AS observed FROM t GROUP BY 1, 2),
e AS (SELECT fixture_id, CAST(sum(n) AS BIGINT) AS n, sum(n * abs(mean_p - observed)) / sum(n) AS e FROM b GROUP BY 1) SELECT fixture_id, n, CASE WHEN n >= 65 THEN round(e, 6) END AS ece, CASE WHEN n < 65 THEN 'insufficient_sample' END AS note FROM e""", "forecasts")
def top_label_ece(forecasts):
    return _rounded(scoring.top_label_ece(forecasts, "fixture_id", least=65), "ece")


@query("""WITH s AS (SELECT match_id, competition, ln(1 + home_goals) + ln(1 + away_goals) - 1 AS ll FROM pairs) SELECT competition, round(avg(ll), 6) AS mean_loglik, round(-avg(ll), 6) AS loss FROM s GROUP BY 1""", "pairs")
def goal_log_likelihood_metric(pairs):
    ll = F.log(1 + F.col("home_goals")) + F.log(1 + F.col("away_goals")) - 1
    return pairs.groupBy("competition").agg(r6(F.avg(ll)).alias("mean_loglik"), r6(-F.avg(ll)).alias("loss"))


@query(f"""WITH f AS (SELECT *, 0.5 + home_id / 40.0 AS hm, 0.4 + away_id / 50.0 AS am FROM pairs WHERE match_id % 6 != 0), s AS (SELECT competition, home_goals * ln(hm) - hm - ln(factorial(home_goals::INT)::DOUBLE) + away_goals * ln(am) - am - ln(factorial(away_goals::INT)::DOUBLE)
  + ln(greatest(CASE WHEN home_goals = 0 AND away_goals = 0 THEN 1 + hm * am * 0.05 WHEN home_goals = 0 AND away_goals = 1 THEN 1 - hm * 0.05 WHEN home_goals = 1 AND away_goals = 0 THEN 1 - am * 0.05 WHEN home_goals = 1 AND away_goals = 1 THEN 1.05 ELSE 1 END, 1e-15)) AS ll FROM f)
  SELECT competition, count(*) AS n, round(avg(ll), 6) AS goal_log_likelihood, round(-avg(ll), 6) AS goal_loss FROM s GROUP BY 1""", "pairs")
def goal_log_likelihood_of_forecasts(pairs):
    """Every sixth match has no score yet."""
    scored = lambda c: F.when(F.col("match_id") % 6 != 0, F.col(c))
    rows = pairs.withColumns({"home_mean": 0.5 + F.col("home_id") / 40, "away_mean": 0.4 + F.col("away_id") / 50, "rho": F.lit(-0.05), "home_goals": scored("home_goals"), "away_goals": scored("away_goals")})
    return _rounded(scoring.goal_log_likelihood(rows, "competition"), "goal_log_likelihood", "goal_loss")


@query("SELECT year(match_date) AS fold, count(*) AS matches, min(match_date) AS first_date, max(match_date) AS last_date, array_to_string(list_sort(list_distinct(list(competition))), '; ') AS competitions FROM pairs GROUP BY 1", "pairs")
def fold_inventory(pairs):
    return reports.fold_inventory(pairs.withColumn("fold", F.year("match_date").cast("long")), "fold")


DRAW = "('0x' || substr(md5({}), 1, 8))::BIGINT"


@query(f"""WITH {LOSS}, d AS (SELECT fixture_id, forecast_id, log_loss + ln(1.0 / 3) AS delta FROM l), p AS (SELECT *, row_number() OVER (PARTITION BY fixture_id ORDER BY forecast_id) - 1 AS place FROM d),
s AS (SELECT fixture_id, count(*) AS n, avg(delta) AS m FROM p GROUP BY 1), g AS (SELECT fixture_id, n, resample, unnest(range(n)) AS slot FROM (SELECT fixture_id, n, unnest(range(50)) AS resample FROM s)),
k AS (SELECT fixture_id, resample, {DRAW.format("fixture_id || '|' || resample || '|' || slot")} % n AS place FROM g), m AS (SELECT fixture_id, resample, avg(delta) AS m FROM k JOIN p USING (fixture_id, place) GROUP BY 1, 2)
SELECT s.fixture_id, s.n, round(s.m, 6) AS mean_delta, round(quantile_cont(m.m, 0.025), 6) AS low, round(quantile_cont(m.m, 0.975), 6) AS high, round(avg((m.m < 0)::INT), 6) AS share_below_zero FROM m JOIN s USING (fixture_id) GROUP BY 1, 2, 3""", "forecasts")
def paired_bootstrap_ci(forecasts):
    d = scoring.with_losses(forecasts).select("fixture_id", "forecast_id", (F.col("log_loss") + F.log(F.lit(1 / 3))).alias("delta"))
    return _rounded(scoring.paired_bootstrap_ci(d, "forecast_id", "fixture_id", 50), "mean_delta", "low", "high", "share_below_zero")


@query(None, "forecasts")
def paired_bootstrap_ci_whole(forecasts):
    """10,000 resamples of every fixture, drawn by blocks; ``paired_bootstrap_ci`` has 50, of other draws, and SQL."""
    d = scoring.with_losses(forecasts).select("fixture_id", "forecast_id", (F.col("log_loss") + F.log(F.lit(1 / 3))).alias("delta"))
    return _rounded(bootstrap.bootstrap_means(d, "forecast_id", "fixture_id", "delta").withColumnRenamed("mean", "mean_delta"), "mean_delta", "low", "high", "share_below_zero")


@query(f"""WITH {LOSS}, m AS (SELECT fold, CASE WHEN forecast_id % 2 = 0 THEN 'a' ELSE 'b' END AS model, avg(log_loss) AS x, avg(brier) AS y, avg(rps) AS z FROM l GROUP BY 1, 2)
SELECT a.fold, round(a.x - b.x, 6) AS log_loss_delta, round(a.y - b.y, 6) AS brier_delta, round(a.z - b.z, 6) AS rps_delta FROM m a JOIN m b ON a.fold = b.fold AND a.model = 'a' AND b.model = 'b'""", "forecasts")
def model_comparison_delta(forecasts):
    rows = forecasts.withColumn("model", F.when(F.col("forecast_id") % 2 == 0, "a").otherwise("b"))
    return _rounded(scoring.model_comparison_delta(rows, "fold", "model", "a", "b"), "log_loss_delta", "brier_delta", "rps_delta")


@query(f"""WITH f AS (SELECT avg({IH}) AS a, avg({ID}) AS b, avg({IA}) AS c FROM forecasts), x AS (SELECT outcome, 'uniform' AS baseline, 1.0::DOUBLE / 3 AS p_home, 1.0::DOUBLE / 3 AS p_draw, 1.0::DOUBLE / 3 AS p_away FROM forecasts UNION ALL SELECT outcome, 'history', a, b, c FROM forecasts, f),
{LOSS.replace('FROM forecasts', 'FROM x')} SELECT baseline, {AVGS} FROM l GROUP BY 1""", "forecasts")
def baseline_probabilities(forecasts):
    return _rounded(scoring.baseline_probabilities(forecasts))


@query(f"""WITH {LOSS}, f AS (SELECT CASE forecast_id % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'a' ELSE 'b' END AS ablation, fold, avg(log_loss) AS loss FROM l GROUP BY 1, 2)
SELECT f.ablation, round(min(f.loss), 6) AS min_tune_log_loss, count(*) AS folds, count(*) FILTER (WHERE f.loss >= b.loss) AS folds_not_better, round(avg(f.loss), 6) AS mean_log_loss FROM f JOIN f b ON b.fold = f.fold AND b.ablation = 'base' GROUP BY 1""", "forecasts")
def ablation_summary(forecasts):
    rows = scoring.with_losses(forecasts).withColumn("ablation", F.element_at(F.array(F.lit("base"), F.lit("a"), F.lit("b")), (F.col("forecast_id") % 3 + 1).cast("int")))
    return _rounded(scoring.ablation_summary(rows), "min_tune_log_loss", "mean_log_loss")


@query(f"SELECT count(*) AS row_count, count(DISTINCT fixture_id) AS fixtures, count(DISTINCT fold) AS snapshots, count(*) FILTER (WHERE {VALIDITY} IS NULL) AS valid, count(*) FILTER (WHERE {VALIDITY} IS NOT NULL) AS invalid, max(created_at) AS cutoff, count(*) FILTER (WHERE {VALIDITY} IS NULL) < 30 AS small_sample FROM forecasts", "forecasts")
def ledger_summary(forecasts):
    return reports.ledger_summary(forecasts, _validity())


@query("SELECT min(CASE WHEN kickoff > TIMESTAMP '2024-01-15 00:00:00' THEN kickoff END) AS next_kickoff, count(*) FILTER (WHERE visit_id % 4 = 0 OR TIMESTAMP '2024-01-15 00:00:00' - kickoff > INTERVAL 6 HOUR) AS stale FROM visits", "visits")
def freshness_report(visits):
    return reports.freshness_report(visits.withColumn("updated", F.when(F.col("visit_id") % 4 != 0, F.col("kickoff"))), "kickoff", "updated", "2024-01-15 00:00:00", 6)


@query("SELECT count(*) AS received, count(*) FILTER (WHERE status = 'known') AS known, count(*) FILTER (WHERE status = 'pending') AS pending, true AS balanced FROM snap_cur", "snap_cur")
def partition_balance_check(cur):
    return reports.partition_balance(cur, {"known": F.col("status") == "known", "pending": F.col("status") == "pending"})


@query("""WITH r AS (SELECT team, visit_id % 100 AS run, visit_id % 4 AS reached FROM visits), x AS (SELECT team, run, max(reached) AS reached FROM r GROUP BY 1, 2)
SELECT team, round(count(*) FILTER (WHERE reached >= 0) / 100, 6) AS group_stage, round(count(*) FILTER (WHERE reached >= 1) / 100, 6) AS last16, round(count(*) FILTER (WHERE reached >= 2) / 100, 6) AS semi, true AS monotone FROM x GROUP BY 1""", "visits")
def outcome_table_probabilities(visits):
    reached = visits.groupBy("team", (F.col("visit_id") % 100).alias("run")).agg(F.max(F.col("visit_id") % 4).alias("reached"))
    stages = ["group_stage", "last16", "semi"]
    runs = reached.select("team", "run", F.explode(F.slice(F.array(*map(F.lit, stages)), F.lit(1), F.least(F.col("reached") + 1, F.lit(3)).cast("int"))).alias("stage"))
    return _rounded(reports.outcome_table_probabilities(runs, 100, stages), *stages)


@query(f"SELECT fold, round(sqrt(p * (1 - p) / n), 6) AS se, round(1.96 * sqrt(p * (1 - p) / n), 6) AS half_width FROM (SELECT fold, avg({IH}) AS p, count(*) AS n FROM forecasts GROUP BY 1)", "forecasts")
def proportion_standard_error(forecasts):
    x = forecasts.groupBy("fold").agg(F.avg((F.col("outcome") == "home_win").cast("int")).alias("p"), F.count("*").alias("n"))
    se = scalars.proportion_standard_error(F.col("p"), F.col("n"))
    return x.select("fold", r6(se).alias("se"), r6(1.96 * se).alias("half_width"))


@query("SELECT CAST(sum(visit_id % 3) AS BIGINT) AS total, count(*) FILTER (WHERE visit_id % 3 > 0) AS runs_with, sum(visit_id % 3) = 10000 AS matches_recorded FROM visits", "visits")
def fallback_count_audit(visits):
    return reports.fallback_audit(visits.withColumn("fallbacks", F.col("visit_id") % 3), "fallbacks", 10000)


# --- windows --------------------------------------------------------------------------------------

MICRO = "PARTITION BY team ORDER BY epoch_us(kickoff) RANGE BETWEEN {} PRECEDING AND {}"


@query(f"SELECT visit_id, {', '.join(f'count(*) OVER ({MICRO.format(d * 86_400_000_000, '1 PRECEDING')}) AS matches_{d}d' for d in (7, 14, 30))} FROM visits", "visits")
def rolling_match_count(visits):
    return windows.rolling_match_counts(visits, "team", "kickoff").select("visit_id", "matches_7d", "matches_14d", "matches_30d")


@query(f"""WITH v AS (SELECT *, CASE WHEN visit_id % 40 != 0 THEN CAST(90 + visit_id % 2 * 30 AS DOUBLE) END AS minutes FROM visits)
SELECT visit_id, CASE WHEN count(*) FILTER (WHERE minutes IS NULL) OVER w > 0 THEN NULL ELSE coalesce(sum(minutes) OVER w, 0.0) END AS minutes_7d FROM v WINDOW w AS ({MICRO.format(7 * 86_400_000_000, '1 PRECEDING')})""", "visits")
def rolling_minutes_null_poison(visits):
    v = visits.withColumn("minutes", F.when(F.col("visit_id") % 40 != 0, (90 + F.col("visit_id") % 2 * 30).cast("double")))
    return windows.rolling_minutes(v, "team", "kickoff", "minutes", 7).select("visit_id", "minutes_7d")


@query(f"WITH v AS (SELECT *, CASE WHEN visit_id % 3 != 0 THEN visit_id % 100 END AS km FROM visits) SELECT visit_id, CAST(sum(km) OVER ({MICRO.format(7 * 86_400_000_000, 'CURRENT ROW')}) AS BIGINT) AS km_7d FROM v", "visits")
def rolling_travel_sum(visits):
    return windows.rolling_travel(visits.withColumn("km", F.when(F.col("visit_id") % 3 != 0, F.col("visit_id") % 100)), "team", "kickoff", "km", 7).select("visit_id", "km_7d")


REST = "v AS (SELECT *, lag(kickoff) OVER (PARTITION BY team ORDER BY kickoff, visit_id) AS b FROM visits), d AS (SELECT *, CAST(kickoff AS DATE) - CAST(b AS DATE) AS rest_days, (epoch_us(kickoff) - epoch_us(b)) / 3.6e9 AS rest_hours FROM v)"


@query(f"WITH {REST} SELECT visit_id, round(rest_hours, 6) AS rest_hours, rest_days FROM d", "visits")
def rest_time(visits):
    return windows.rest_time(visits, "team", "kickoff", "visit_id").select("visit_id", r6("rest_hours").alias("rest_hours"), F.col("rest_days").cast("long").alias("rest_days"))


@query(f"""WITH {REST}, i AS (SELECT *, CASE WHEN rest_days < 1 THEN 0 ELSE 1 END AS reset, sum(CASE WHEN rest_days < 1 THEN 0 ELSE 1 END) OVER (PARTITION BY team ORDER BY kickoff, visit_id ROWS UNBOUNDED PRECEDING) AS g FROM d)
SELECT visit_id, row_number() OVER (PARTITION BY team, g ORDER BY kickoff, visit_id) - first_value(reset) OVER (PARTITION BY team, g ORDER BY kickoff, visit_id) AS streak FROM i""", "visits")
def short_rest_streak(visits):
    rested = windows.rest_time(visits, "team", "kickoff", "visit_id")
    return windows.short_rest_streak(rested, "team", ["kickoff", "visit_id"], "rest_days", 1).select("visit_id", F.col("streak").cast("long").alias("streak"))


@query("SELECT visit_id, rank() OVER (PARTITION BY team, competition ORDER BY kickoff) AS sequence_number, rank() OVER (PARTITION BY team, competition ORDER BY kickoff) = 1 AS first_match FROM visits", "visits")
def sequence_number_in_competition(visits):
    return windows.sequence_in_competition(visits, "team", "competition", "kickoff").select("visit_id", "sequence_number", "first_match")


@query("SELECT visit_id, coalesce(bool_or(competition = 'error') OVER (PARTITION BY team ORDER BY kickoff, visit_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS untrusted_before FROM visits", "visits")
def data_quality_flags(visits):
    return windows.data_quality_flags(visits, "team", ["kickoff", "visit_id"], "competition", "error").select("visit_id", "untrusted_before")


@query("""WITH v AS (SELECT *, count(DISTINCT value) OVER (PARTITION BY team, competition) AS k, min(visit_id) OVER (PARTITION BY team, competition) AS f FROM (SELECT visit_id, team, competition, CASE WHEN team % 2 = 0 THEN 0 ELSE visit_id % 2 END AS value FROM visits))
SELECT visit_id, CASE WHEN k > 1 THEN 'conflict' WHEN visit_id = f THEN 'keep' ELSE 'duplicate' END AS decision FROM v""", "visits")
def dedupe_identical_or_conflict(visits):
    payload = F.when(F.col("team") % 2 == 0, 0).otherwise(F.col("visit_id") % 2)
    return windows.dedupe_identical_or_conflict(visits, ["team", "competition"], payload, "visit_id").select("visit_id", "decision")


@query("SELECT match_date, home_id, away_id, count(*) AS n FROM pairs GROUP BY 1, 2, 3 HAVING count(*) > 1", "pairs")
def duplicate_key_gate(pairs):
    return windows.duplicate_keys(pairs, ["match_date", "home_id", "away_id"])


@query("SELECT visit_id FROM (SELECT visit_id, kickoff, lag(kickoff) OVER (PARTITION BY team ORDER BY value, visit_id) AS b FROM visits) WHERE kickoff < b", "visits")
def temporal_order_check(visits):
    return windows.temporal_order_violations(visits.withColumn("seq", F.struct("value", "visit_id")), "team", "seq", "kickoff").select("visit_id")


@query("""SELECT fixture_id, forecast_id, CASE WHEN lead_hours >= 6 THEN 'latest_early_enough' ELSE 'earliest' END AS rule FROM forecasts
QUALIFY row_number() OVER (PARTITION BY fixture_id ORDER BY (lead_hours >= 6) DESC, CASE WHEN lead_hours >= 6 THEN created_at END DESC NULLS LAST, CASE WHEN lead_hours >= 6 THEN forecast_id END DESC NULLS LAST, created_at, forecast_id) = 1""", "forecasts")
def official_selection(forecasts):
    return windows.official_selection(forecasts).select("fixture_id", "forecast_id", "rule")


@query("SELECT forecast_id, fixture_id FROM forecasts", "forecasts")
def ledger_merge(forecasts):
    twice = forecasts.unionByName(forecasts.filter("forecast_id % 5 = 0"))
    merged, conflicts = windows.ledger_merge(twice, "forecast_id", ids.row_fingerprint(twice), ["created_at"])
    return merged.join(conflicts, "forecast_id", "left_anti").select("forecast_id", "fixture_id")


@query("""WITH f AS (SELECT forecast_id // 2 AS id, created_at, CASE WHEN forecast_id % 10 < 6 THEN 1 ELSE forecast_id END AS body FROM forecasts),
t AS (SELECT id, count(*) > 1 AND count(DISTINCT body) = 1 AND count(DISTINCT created_at) = count(*) AS repair FROM f GROUP BY 1)
SELECT f.id, created_at, repair, CASE WHEN repair THEN substr(sha256(concat(CAST(f.id AS VARCHAR), '|', CAST(epoch_us(created_at) AS VARCHAR))), 1, 24) ELSE CAST(f.id AS VARCHAR) END AS new_id FROM f JOIN t USING (id)""", "forecasts")
def legacy_id_repair(forecasts):
    rows = forecasts.select(F.floor(F.col("forecast_id") / 2).alias("id"), "created_at", F.when(F.col("forecast_id") % 10 < 6, 1).otherwise(F.col("forecast_id")).alias("body"))
    return windows.legacy_id_repair(rows, "id", "created_at", F.col("body").cast("string")).select("id", "created_at", "repair", "new_id")


@query(f"WITH {STAND} SELECT competition, team, CAST(row_number() OVER w AS INT) AS rank, CASE WHEN row_number() OVER w <= 8 THEN 'best_third' ELSE 'eliminated' END AS status FROM st WINDOW w AS (ORDER BY points DESC, difference DESC, scored DESC, team, competition)", "pairs")
def top_k_with_status(pairs):
    order = [F.desc("points"), F.desc("difference"), F.desc("scored"), F.col("team"), F.col("competition")]
    return windows.top_k_with_status(reports.group_standings(pairs), order, 8).select("competition", "team", "rank", "status")


@query("""WITH x AS (SELECT *, row_number() OVER (PARTITION BY competition ORDER BY match_date, match_id) AS r FROM pairs), y AS (SELECT competition, match_id, match_date, ntile(5) OVER (PARTITION BY competition ORDER BY match_date, match_id) AS block FROM x WHERE r > 100)
SELECT match_id, CAST(block AS INT) AS block, min(match_date) OVER (PARTITION BY competition, block) AS block_cutoff FROM y""", "pairs")
def temporal_block_assignment(pairs):
    return windows.temporal_blocks(pairs, "competition", ["match_date", "match_id"], 100, 5).select("match_id", "block", "block_cutoff")


@query("SELECT match_id, CASE WHEN p <= 0.6 THEN 'train' WHEN p <= 0.8 THEN 'tune' ELSE 'calibration' END AS part FROM (SELECT match_id, row_number() OVER (PARTITION BY competition ORDER BY match_date, match_id) / count(*) OVER (PARTITION BY competition) AS p FROM pairs)", "pairs")
def fallback_ratio_split(pairs):
    return windows.ratio_split(pairs, "competition", ["match_date", "match_id"]).select("match_id", "part")


@query("SELECT competition, match_id, away_goals FROM pairs QUALIFY row_number() OVER (PARTITION BY competition ORDER BY away_goals, match_date, match_id) = 1", "pairs")
def argmin_selection(pairs):
    best = pairs.groupBy("competition").agg(F.min(F.struct("away_goals", "match_date", "match_id")).alias("b"))
    return best.select("competition", "b.match_id", "b.away_goals")


@query("SELECT visit_id FROM visits ORDER BY visit_id LIMIT 25", "visits")
def preview_limit(visits):
    return visits.select("visit_id").orderBy("visit_id").limit(25)


def _standings_of_years(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = pairs.withColumn("competition", F.concat_ws("/", F.year("match_date").cast("string"), F.col("competition")))
    return rows, reports.group_standings(rows)


@query(None, "pairs")
def rank_with_tiebreaks(pairs):
    rows, table = _standings_of_years(pairs)
    ranked = windows.rank_with_tiebreaks(table.withColumnRenamed("competition", "grp"), rows.withColumnRenamed("competition", "grp"))
    return ranked.select("grp", "team", "points", "difference", "scored", "position")


# --- set operations -------------------------------------------------------------------------------

@query("SELECT id, venue, status, stage, 'prev' AS origin FROM snap_prev UNION ALL SELECT id, venue, status, NULL, 'cur' FROM snap_cur WHERE id % 2 = 0", "snap_prev", "snap_cur")
def union_sources(prev, cur):
    return prev.withColumn("origin", F.lit("prev")).unionByName(cur.filter("id % 2 = 0").drop("stage").withColumn("origin", F.lit("cur")), allowMissingColumns=True)


@query("SELECT id, 'extra' AS kind FROM snap_cur WHERE id NOT IN (SELECT id FROM snap_prev) UNION ALL SELECT id, 'missing' FROM snap_prev WHERE id NOT IN (SELECT id FROM snap_cur)", "snap_prev", "snap_cur")
def id_set_equality(prev, cur):
    a, b = prev.select("id"), cur.select("id")
    return b.exceptAll(a).withColumn("kind", F.lit("extra")).unionByName(a.exceptAll(b).withColumn("kind", F.lit("missing")))


@query("SELECT id FROM snap_prev INTERSECT SELECT id FROM snap_cur WHERE status = 'known'", "snap_prev", "snap_cur")
def id_set_intersection(prev, cur):
    return prev.select("id").intersect(cur.filter("status = 'known'").select("id"))


# --- scalar functions -----------------------------------------------------------------------------

@query("SELECT match_id, regexp_replace(lower(translate(competition, '-_', '  ')), '\\s+', ' ', 'g') AS alias FROM pairs", "pairs")
def normalize_alias(pairs):
    return pairs.select("match_id", scalars.normalize_alias(F.col("competition")).alias("alias"))


TWO = "FROM sites a JOIN sites b ON b.site_id = (a.site_id * 3 + 1) % 25"


def _two(sites: DataFrame) -> DataFrame:
    a, b = sites.alias("a"), sites.alias("b")
    return a.join(b, F.col("b.site_id") == (F.col("a.site_id") * 3 + 1) % 25)


@query(f"SELECT a.site_id, round(2 * 6371.0088 * asin(sqrt(least(pow(sin(radians(a.latitude - b.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(a.longitude - b.longitude) / 2), 2), 1.0))), 4) AS km {TWO}", "sites")
def haversine_km(sites):
    km = scalars.haversine_km(*(F.col(c) for c in ("a.latitude", "a.longitude", "b.latitude", "b.longitude")))
    return _two(sites).select("a.site_id", F.round(km, 4).alias("km"))


@query("SELECT site_id, CAST(CASE zone WHEN 'Europe/London' THEN 1 WHEN 'America/New_York' THEN -4 WHEN 'Asia/Tokyo' THEN 9 ELSE 0 END AS DOUBLE) AS hours FROM sites", "sites")
def timezone_delta_hours(sites):
    return sites.select("site_id", scalars.timezone_delta_hours(F.lit("2026-07-01 12:00:00").cast("timestamp"), F.col("zone"), F.lit("UTC")).alias("hours"))


@query(f"SELECT a.site_id, CAST(a.elevation - b.elevation AS BIGINT) AS change, CAST(abs(a.elevation - b.elevation) AS BIGINT) AS size {TWO}", "sites")
def elevation_change(sites):
    change, absolute = scalars.elevation_change(F.col("a.elevation"), F.col("b.elevation"))
    return _two(sites).select("a.site_id", change.cast("long").alias("change"), absolute.cast("long").alias("size"))


@query(f"SELECT a.site_id, a.zone != b.zone AS cross_border, a.zone = 'UTC' AS host_match, coalesce(CASE WHEN a.site_id % 2 = 0 THEN true END, a.zone != 'UTC') AS is_neutral {TWO}", "sites")
def venue_flags(sites):
    flags = scalars.venue_flags(F.col("a.zone"), F.col("b.zone"), F.lit("UTC"), F.when(F.col("a.site_id") % 2 == 0, True))
    return _two(sites).select("a.site_id", flags.alias("f")).select("site_id", "f.*")


@query("SELECT site_id, latitude * 2 BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AS ok FROM sites", "sites")
def coordinate_checks(sites):
    return sites.select("site_id", scalars.coordinate_checks(F.col("latitude") * 2, F.col("longitude")).alias("ok"))


@query("SELECT match_id, round(1 / (1 + pow(10.0, -(home_id * 10 + 50 - away_id * 10) / 400.0)), 6) AS expected, CASE WHEN abs(home_goals - away_goals) <= 1 THEN 1.0 ELSE 1 + (abs(home_goals - away_goals) - 1) * 0.15 END::DOUBLE AS multiplier FROM pairs", "pairs")
def expected_score(pairs):
    return pairs.select("match_id", r6(scalars.expected_score(F.col("home_id") * 10 + 50 - F.col("away_id") * 10)).alias("expected"), scalars.margin_multiplier(F.col("home_goals") - F.col("away_goals"), 0.15).alias("multiplier"))


@query("SELECT match_id, round(exp(-ln(2.0) * greatest(DATE '1997-01-01' - match_date, 0) / 730.0), 6) AS weight FROM pairs", "pairs")
def decay_weight(pairs):
    return pairs.select("match_id", r6(scalars.decay_weight(F.col("match_date"), F.lit("1997-01-01").cast("date"), 730.0)).alias("weight"))


MEANS = "exp(least(greatest(0.1 + home_id / 100.0 + coalesce(CASE WHEN away_id % 5 != 0 THEN -away_id / 80.0 END, 0), -8), 4))"


def _mean() -> Column:
    return scalars.expected_goals(F.lit(0.1), F.col("home_id") / 100, F.when(F.col("away_id") % 5 != 0, -F.col("away_id") / 80), None)


@query(f"SELECT match_id, round({MEANS}, 6) AS mean_goals FROM pairs", "pairs")
def expected_goals(pairs):
    return pairs.select("match_id", r6(_mean()).alias("mean_goals"))


@query(f"SELECT match_id, k.range AS goals, round(exp(k.range * ln({MEANS}) - {MEANS}) / factorial(k.range::INT)::DOUBLE, 6) AS p FROM pairs, range(4) k", "pairs")
def poisson_pmf(pairs):
    return pairs.select("match_id", F.posexplode(scalars.poisson_pmf(_mean(), 3)).alias("goals", "p")).select("match_id", F.col("goals").cast("long").alias("goals"), r6("p").alias("p"))


TAU = "CASE WHEN home_goals = 0 AND away_goals = 0 THEN 1 - 1.2 * 0.9 * -0.1 WHEN home_goals = 0 AND away_goals = 1 THEN 1 + 1.2 * -0.1 WHEN home_goals = 1 AND away_goals = 0 THEN 1 + 0.9 * -0.1 WHEN home_goals = 1 AND away_goals = 1 THEN 1.1 ELSE 1.0 END::DOUBLE"


@query(f"SELECT match_id, round({TAU}, 6) AS tau FROM pairs", "pairs")
def low_score_correction(pairs):
    return pairs.select("match_id", r6(scalars.low_score_correction(F.col("home_goals"), F.col("away_goals"), F.lit(1.2), F.lit(0.9), F.lit(-0.1))).alias("tau"))


@query(f"SELECT match_id, round(home_goals * ln(1.2) - 1.2 - ln(factorial(home_goals::INT)::DOUBLE) + away_goals * ln(0.9) - 0.9 - ln(factorial(away_goals::INT)::DOUBLE) + ln({TAU}), 6) AS loglik FROM pairs", "pairs")
def observed_score_loglik(pairs):
    return pairs.select("match_id", r6(scalars.observed_score_loglik(F.col("home_goals"), F.col("away_goals"), F.lit(1.2), F.lit(0.9), F.lit(-0.1))).alias("loglik"))


@query("""WITH m AS (SELECT DISTINCT home_id, away_id, 0.5 + home_id / 40.0 AS hm, 0.4 + away_id / 50.0 AS am FROM pairs), g AS (SELECT home_id, away_id, h.range AS h, a.range AS a, exp(h.range * ln(hm) - hm - lgamma(h.range + 1.0)) * exp(a.range * ln(am) - am - lgamma(a.range + 1.0)) *
  greatest(CASE WHEN h.range = 0 AND a.range = 0 THEN 1 + hm * am * 0.05 WHEN h.range = 0 AND a.range = 1 THEN 1 - hm * 0.05 WHEN h.range = 1 AND a.range = 0 THEN 1 - am * 0.05 WHEN h.range = 1 AND a.range = 1 THEN 1.05 ELSE 1 END, 0) AS p FROM m, range(41) h, range(41) a),
o AS (SELECT home_id, away_id, round(sum(p) FILTER (WHERE h > a) / sum(p), 6) AS p_home, round(sum(p) FILTER (WHERE h = a) / sum(p), 6) AS p_draw, round(sum(p) FILTER (WHERE h < a) / sum(p), 6) AS p_away, round(sum(p) FILTER (WHERE h <= 10 AND a <= 10), 6) AS mass,
  arg_max(h || '-' || a, struct_pack(p := round(p, 12), h := -h, a := -a)) FILTER (WHERE h <= 10 AND a <= 10) AS modal_score FROM g GROUP BY 1, 2)
SELECT match_id, p_home, p_draw, p_away, mass, modal_score FROM pairs JOIN o USING (home_id, away_id)""", "pairs")
def score_grid(pairs):
    rows = pairs.select("match_id", (0.5 + F.col("home_id") / 40).alias("home_mean"), (0.4 + F.col("away_id") / 50).alias("away_mean"), F.lit(-0.05).alias("rho"))
    return _rounded(models.score_grid(rows).select("match_id", "p_home", "p_draw", "p_away", "mass", "modal_score"), "p_home", "p_draw", "p_away", "mass")


@query("SELECT competition, home_goals, away_goals, round(count(*) / sum(count(*)) OVER (PARTITION BY competition), 6) AS p FROM pairs GROUP BY 1, 2, 3", "pairs")
def score_map_json(pairs):
    counts = pairs.groupBy("competition", "home_goals", "away_goals").agg(F.count("*").cast("double").alias("n"))
    packed = counts.groupBy("competition").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("-", "home_goals", "away_goals"), "n")))).alias("grid"))
    open_ = packed.select("competition", F.explode(F.from_json("grid", "map<string,double>")).alias("score", "n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy("competition"))
    return open_.select("competition", F.split("score", "-")[0].cast("long").alias("home_goals"), F.split("score", "-")[1].cast("long").alias("away_goals"), r6(p).alias("p"))


@query("WITH x AS (SELECT forecast_id, least(greatest(p_home * 1.4 - 0.1, 0), 1) AS a, least(greatest(p_draw, 0), 1) AS b, least(greatest(p_away, 0), 1) AS c FROM forecasts) SELECT forecast_id, round(a / (a + b + c), 6) AS p_home, round(b / (a + b + c), 6) AS p_draw, round(c / (a + b + c), 6) AS p_away FROM x", "forecasts")
def probability_normalize(forecasts):
    h, d, a = scalars.probability_normalize(F.col("p_home") * 1.4 - 0.1, F.col("p_draw"), F.col("p_away"))
    return forecasts.select("forecast_id", r6(h).alias("p_home"), r6(d).alias("p_draw"), r6(a).alias("p_away"))


@query("SELECT forecast_id, round(ln(p_home / (1 - p_home)), 6) AS logit_home, round(ln(p_draw / (1 - p_draw)), 6) AS logit_draw, round(ln(p_away / (1 - p_away)), 6) AS logit_away, round(ln(p_home / p_away), 6) AS log_ratio FROM forecasts", "forecasts")
def probability_logits(forecasts):
    out = scalars.probability_logits(F.col("p_home"), F.col("p_draw"), F.col("p_away"))
    return forecasts.select("forecast_id", *(r6(c).alias(n) for c, n in zip(out, ("logit_home", "logit_draw", "logit_away", "log_ratio"))))


@query("WITH x AS (SELECT forecast_id, pow(p_home, 1 / 1.5) AS a, pow(p_draw, 1 / 1.5) AS b, pow(p_away, 1 / 1.5) AS c FROM forecasts) SELECT forecast_id, round(a / (a + b + c), 6) AS p_home, round(b / (a + b + c), 6) AS p_draw, round(c / (a + b + c), 6) AS p_away FROM x", "forecasts")
def temperature_transform(forecasts):
    h, d, a = scalars.temperature_transform(1.5, F.col("p_home"), F.col("p_draw"), F.col("p_away"))
    return forecasts.select("forecast_id", r6(h).alias("p_home"), r6(d).alias("p_draw"), r6(a).alias("p_away"))


# --- ids ------------------------------------------------------------------------------------------

@query("SELECT match_id, substr(sha256(concat(CAST(match_id AS VARCHAR), '|', CAST(home_id AS VARCHAR), '|v1')), 1, 24) AS derived FROM pairs", "pairs")
def derived_ids(pairs):
    return pairs.select("match_id", ids.derived_id(F.col("match_id"), F.col("home_id"), F.lit("v1")).alias("derived"))


FINGER = """sha256('{"away_id":' || away_id || ',"home_id":' || home_id || ',"match_id":' || match_id || '}')"""


@query(f"SELECT match_id, {FINGER} AS fingerprint FROM pairs", "pairs")
def row_fingerprint(pairs):
    few = pairs.select("match_id", "home_id", "away_id")
    return few.select("match_id", ids.row_fingerprint(few).alias("fingerprint"))


@query(f"""WITH h AS (SELECT {FINGER} AS h FROM pairs), s AS (SELECT count(*) AS n, CAST(sum(('0x' || substr(h, 1, 8))::BIGINT) AS BIGINT) AS a, CAST(sum(('0x' || substr(h, 9, 8))::BIGINT) AS BIGINT) AS b, CAST(sum(('0x' || substr(h, 17, 8))::BIGINT) AS BIGINT) AS c FROM h)
SELECT 'rev-' || substr(sha256(concat_ws('|', CAST(n AS VARCHAR), CAST(a AS VARCHAR), CAST(b AS VARCHAR), CAST(c AS VARCHAR))), 1, 16) AS digest, n FROM s""", "pairs")
def table_digest(pairs):
    return ids.table_digest(pairs.select("match_id", "home_id", "away_id"))


# --- rating and model jobs ------------------------------------------------------------------------

@query("""SELECT match_date, team, round(1500 + sum(20.0 * w * ((CASE WHEN d > 0 THEN 1.0 WHEN d < 0 THEN 0.0 ELSE 0.5 END) - e)), 6) AS rating FROM (
  SELECT match_date, match_id, home_id AS team, home_goals - away_goals AS d, CASE WHEN abs(home_goals - away_goals) <= 1 THEN 1.0 ELSE 1 + (abs(home_goals - away_goals) - 1) * 0.15 END AS w, 1 / (1 + pow(10.0, -50 / 400.0)) AS e FROM pairs
  UNION ALL SELECT match_date, match_id, away_id, away_goals - home_goals, CASE WHEN abs(home_goals - away_goals) <= 1 THEN 1.0 ELSE 1 + (abs(home_goals - away_goals) - 1) * 0.15 END, 1 - 1 / (1 + pow(10.0, -50 / 400.0)) FROM pairs) GROUP BY ALL""", "pairs")
def elo_batch_update(pairs):
    """Every date as a batch of its own, from initial ratings."""
    spark = pairs.sparkSession
    params = spark.createDataFrame([("p", 20.0, 50.0, 0.15, 365, 0.25)], PARAMS)
    rows, _ = ratings.rate_batch(spark.createDataFrame([], RATINGS), pairs, params)
    side = lambda s: F.struct(F.col(f"{s}_id").alias("team"), F.col(f"{s}_post").alias("rating"))
    return rows.select("match_date", F.explode(F.array(side("home"), side("away"))).alias("x")).groupBy("match_date", "x.team").agg(r6(F.first("x.rating")).alias("rating"))


PARAMS = "param_id string, k double, home_advantage double, margin_weight double, idle_days int, idle_share double"
RATINGS = "param_id string, team long, rating double, played long, last_date date"


@query("WITH f AS (SELECT 'y95' AS fold, DATE '1995-01-01' AS s, DATE '1995-12-31' AS e, '1-URGENT' AS c UNION ALL SELECT 'y97', DATE '1997-01-01', DATE '1997-12-31', '2-HIGH') SELECT fold, match_id, CASE WHEN match_date < s THEN 'train' ELSE 'test' END AS role FROM pairs, f WHERE match_date < s OR (match_date <= e AND competition = c)", "pairs")
def walk_forward_folds(pairs):
    folds = pairs.sparkSession.createDataFrame([("y95", "1995-01-01", "1995-12-31", "1-URGENT"), ("y97", "1997-01-01", "1997-12-31", "2-HIGH")], "fold string, start string, end string, fold_competition string")
    return models.walk_forward_folds(pairs, folds.withColumns({c: F.col(c).cast("date") for c in ("start", "end")}))


@query("SELECT match_id, CASE WHEN match_date >= DATE '1997-01-01' THEN 'test' WHEN match_date >= DATE '1997-01-01' - 180 THEN 'calibration' WHEN match_date >= DATE '1997-01-01' - 545 THEN 'tune' ELSE 'train' END AS role FROM pairs", "pairs")
def nested_temporal_split(pairs):
    return models.nested_temporal_split(pairs, "1997-01-01", 365, 180).select("match_id", "role")


@query(f"""WITH d AS (SELECT least(greatest(avg(({OUT} = 'draw')::INT), 0.05), 0.45) AS d FROM pairs WHERE match_date < DATE '1996-01-01'), x AS (SELECT match_id, 1 / (1 + pow(10.0, -(home_id - away_id) * 10 / 400.0)) AS e FROM pairs WHERE match_date >= DATE '1996-01-01')
SELECT match_id, round((1 - d) * e, 6) AS p_home, round(d, 6) AS p_draw, round((1 - d) * (1 - e), 6) AS p_away FROM x, d""", "pairs")
def draw_rate_elo_probability(pairs):
    p = reports.with_outcome(pairs)
    rate = p.filter("match_date < DATE '1996-01-01'").agg(F.avg((F.col("outcome") == "draw").cast("int")).alias("rate"))
    test = p.filter("match_date >= DATE '1996-01-01'").join(F.broadcast(rate)).withColumn("difference", (F.col("home_id") - F.col("away_id")) * 10)
    return _rounded(models.draw_rate_probability(test, F.col("rate")).select("match_id", "p_home", "p_draw", "p_away"), "p_home", "p_draw", "p_away")


@query(f"SELECT round(avg({IH}), 6) AS p_home, round(avg({ID}), 6) AS p_draw, round(avg({IA}), 6) AS p_away FROM forecasts", "forecasts")
def constant_estimator(forecasts):
    return _rounded(models.constant_estimator(forecasts), "p_home", "p_draw", "p_away")


@query("""WITH t AS (SELECT fold, x.t, avg(-ln(greatest(pow(CASE outcome WHEN 'home_win' THEN p_home WHEN 'draw' THEN p_draw ELSE p_away END, 1 / x.t) / (pow(p_home, 1 / x.t) + pow(p_draw, 1 / x.t) + pow(p_away, 1 / x.t)), 1e-15))) AS loss FROM forecasts, (SELECT unnest([0.5, 1.0, 2.0, 4.0])::DOUBLE AS t) x GROUP BY 1, 2)
SELECT fold, CASE WHEN min(loss) < min(loss) FILTER (WHERE t = 1) - 1e-12 THEN arg_min(t, struct_pack(l := loss, t := t)) ELSE 1.0 END::DOUBLE AS temperature, round(min(loss), 6) AS loss FROM t GROUP BY 1""", "forecasts")
def temperature_fit(forecasts):
    return _rounded(scoring.temperature_fit(forecasts, "fold", (0.5, 1.0, 2.0, 4.0)), "loss")


def _training(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = reports.with_outcome(pairs).select("match_id", "match_date", "competition", (F.col("home_id") - F.col("away_id")).cast("double").alias("difference"), (F.col("match_id") % 7).cast("double").alias("load"), "outcome")
    return rows.filter("match_date < DATE '1997-01-01'"), rows.filter("match_date >= DATE '1997-01-01'")


@query(None, "pairs")
def multinomial_logistic(pairs):
    train, test = _training(pairs)
    return models.with_probabilities(models.multinomial_logistic(train, ["difference", "load"], ["competition"]).transform(test)).select("match_id", "p_home", "p_draw", "p_away")


@query(None, "pairs")
def ordinal_logistic(pairs):
    train, test = _training(pairs)
    return models.ordinal_logistic(train, test, ["difference", "load"], ["competition"]).select("match_id", "p_home", "p_draw", "p_away")


@query(None, "pairs")
def boosted_tree_challenger(pairs):
    """Two option sets fitted on 1995 and early 1996, one of them selected on the rest of 1996."""
    train, test = _training(pairs)
    early, late = train.filter("match_date < DATE '1996-07-01'"), train.filter("match_date >= DATE '1996-07-01'")
    return models.boosted_tree_challenger(early, test, ["difference", "load"], late).select("match_id", "p_home", "p_draw", "p_away")


@query(None, "pairs")
def weighted_poisson_goal_fit(pairs):
    return models.weighted_poisson_goal_fit(pairs, "1997-01-01")[1]


@query("""SELECT p.match_id, h.zone AS home_zone, h.elevation AS home_elevation, a.zone AS away_zone, a.elevation AS away_elevation
  FROM pairs p LEFT JOIN sites h ON h.site_id = p.home_id LEFT JOIN sites a ON a.site_id = p.away_id""", "pairs", "sites")
def catalog_enrich_join(pairs, sites):
    return joins.catalog_enrich(pairs, sites, "site_id", ["zone", "elevation"]).select("match_id", "home_zone", "home_elevation", "away_zone", "away_elevation")


@query("SELECT match_id, category, weight FROM pairs LEFT JOIN categories ON competition = name", "pairs", "categories")
def category_lookup_join(pairs, categories):
    return joins.category_lookup(pairs, categories).select("match_id", "category", "weight")


@query("""WITH a AS (SELECT site_id, trim(unnest(string_split(aliases, '|'))) AS alias FROM venues),
  one AS (SELECT alias, min(site_id) AS site_id FROM a GROUP BY alias HAVING count(DISTINCT site_id) = 1)
  SELECT row_id, site_id FROM names LEFT JOIN one ON name = alias""", "names", "venues")
def venue_alias_join(names, venues):
    return joins.venue_alias(names, venues)


@query("""SELECT forecast_id, fixture_id, CASE WHEN p_home >= p_draw AND p_home >= p_away THEN 'home_win' WHEN p_draw >= p_away THEN 'draw' ELSE 'away_win' END AS predicted, outcome AS actual,
  round(avg(CASE WHEN outcome = 'home_win' THEN 1.0 ELSE 0.0 END) OVER (), 6) AS base_home_win, round(avg(CASE WHEN outcome = 'draw' THEN 1.0 ELSE 0.0 END) OVER (), 6) AS base_draw,
  round(avg(CASE WHEN outcome = 'away_win' THEN 1.0 ELSE 0.0 END) OVER (), 6) AS base_away_win FROM forecasts""", "forecasts")
def scored_match_projection(forecasts):
    out = scoring.scored_projection(forecasts)
    return out.select("forecast_id", "fixture_id", "predicted", "actual", *(r6(c).alias(c) for c in ("base_home_win", "base_draw", "base_away_win")))
