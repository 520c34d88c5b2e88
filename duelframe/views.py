"""Views over the driver's tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "pairs": """SELECT o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS match_date, o_custkey % 40 AS home_id, (o_custkey + 1 + o_orderkey % 39) % 40 AS away_id,
        o_orderkey % 5 AS home_goals, (o_orderkey * 7 + o_custkey) % 4 AS away_goals, o_orderpriority AS competition FROM {orders}""",
    "visits": "SELECT event_id AS visit_id, user_id AS team, CAST(ts AS TIMESTAMP) AS kickoff, event_type AS competition, value FROM {events}",
    "forecasts": """SELECT event_id AS forecast_id, user_id AS fixture_id, CAST(ts AS TIMESTAMP) AS created_at, value / 10 AS lead_hours,
        (1 + event_id % 7) / CAST(3 + event_id % 7 + event_id % 5 + event_id % 3 AS DOUBLE) AS p_home,
        (1 + event_id % 5) / CAST(3 + event_id % 7 + event_id % 5 + event_id % 3 AS DOUBLE) AS p_draw,
        (1 + event_id % 3) / CAST(3 + event_id % 7 + event_id % 5 + event_id % 3 AS DOUBLE) AS p_away,
        CASE WHEN event_id % 11 % 3 = 0 THEN 'home_win' WHEN event_id % 11 % 3 = 1 THEN 'draw' ELSE 'away_win' END AS outcome, event_type AS fold FROM {events}""",
    "snap_prev": "SELECT c_custkey AS id, c_nationkey AS venue, CASE WHEN c_custkey % 3 = 0 THEN 'pending' WHEN c_custkey % 3 = 1 THEN 'tbd' ELSE 'known' END AS status, c_mktsegment AS stage FROM {customer} WHERE c_custkey % 9 != 4",
    "snap_cur": """SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS venue, CASE WHEN c_custkey % 5 < 3 THEN 'known' ELSE 'pending' END AS status,
        CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS stage FROM {customer}""",
    "alias": """SELECT n_nationkey AS entity, n_name AS name, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST('1993-01-01' AS DATE) END AS valid_from, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE CAST('1996-06-30' AS DATE) END AS valid_to FROM {nation}
        UNION ALL SELECT n_nationkey + 100 AS entity, n_name AS name, CAST('1996-01-01' AS DATE) AS valid_from, CAST(NULL AS DATE) AS valid_to FROM {nation} WHERE n_nationkey % 2 = 0""",
    "names": "SELECT o_orderkey AS row_id, concat('NATION_', CAST(o_custkey % 27 AS STRING)) AS name, CAST(o_orderdate AS DATE) AS seen FROM {orders}",
    "sites": """SELECT n_nationkey AS site_id, n_name AS name, CAST(n_nationkey * 7 % 180 - 90 AS DOUBLE) AS latitude, CAST(n_nationkey * 31 % 360 - 180 AS DOUBLE) AS longitude, n_nationkey * 211 % 4000 AS elevation,
        CASE n_nationkey % 4 WHEN 0 THEN 'Europe/London' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'Asia/Tokyo' ELSE 'UTC' END AS zone FROM {nation}""",
    "raw": """SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 31 = 0 THEN 'n/a' ELSE concat(substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7), '-01') END AS day, concat('NATION_', CAST(o_custkey % 27 AS STRING)) AS home,
        concat(' NATION_', CAST((o_custkey + o_orderkey % 7) % 27 AS STRING)) AS away, CASE WHEN o_orderkey % 37 = 0 THEN '-1' ELSE CAST(o_orderkey % 2 AS STRING) END AS home_score, CASE WHEN o_orderkey % 41 = 0 THEN '' ELSE '1' END AS away_score FROM {orders}""",
    "contests": """SELECT o_orderkey AS match_id, CAST(o_orderdate AS DATE) AS match_date, o_custkey % 40 AS home_id, (o_custkey + 1 + o_orderkey % 39) % 40 AS away_id, o_orderkey % 5 AS home_goals, (o_orderkey * 7 + o_custkey) % 4 AS away_goals, o_orderpriority AS competition,
        CASE WHEN o_orderkey % 50 != 0 THEN CAST(concat(substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10), ' ', lpad(CAST(o_orderkey % 20 AS STRING), 2, '0'), ':00:00') AS TIMESTAMP) END AS kickoff,
        CASE WHEN o_orderkey % 30 != 29 THEN o_orderkey % 25 END AS site_id, CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS neutral, o_orderkey % 7 = 0 AS extra_time, o_orderkey % 14 = 0 AS penalties, o_orderkey % 40 != 0 AS trusted,
        CASE WHEN o_orderkey % 9 = 0 THEN 'abandoned' ELSE 'played' END AS match_status, CASE o_orderkey % 4 WHEN 0 THEN 'neutral' WHEN 1 THEN 'home_team' WHEN 2 THEN 'away_team' ELSE 'unknown' END AS home_advantage FROM {orders}""",
    "grounds": """SELECT n_nationkey AS site_id, n_nationkey % 6 AS country, CAST(n_nationkey * 7 % 180 - 90 AS DOUBLE) AS latitude, CAST(n_nationkey * 31 % 360 - 180 AS DOUBLE) AS longitude, n_nationkey * 211 % 4000 AS elevation,
        CASE n_nationkey % 4 WHEN 0 THEN 'Asia/Tokyo' WHEN 1 THEN 'UTC' WHEN 2 THEN 'Asia/Kolkata' ELSE 'Africa/Lagos' END AS zone FROM {nation}""",
    "hosts": "SELECT DISTINCT n_nationkey % 6 AS country, n_nationkey % 6 * 5 AS team FROM {nation} WHERE n_nationkey % 6 < 4",
    "teams": """SELECT DISTINCT o_custkey % 40 AS team, CASE WHEN o_custkey % 40 % 17 = 3 THEN 'former' ELSE 'active' END AS status, CASE WHEN o_custkey % 40 % 19 = 4 THEN 'youth' ELSE 'senior' END AS type FROM {orders} WHERE o_custkey % 40 != 39""",
    "venues": """SELECT n_nationkey AS site_id, CASE WHEN n_nationkey % 5 = 0 THEN concat(n_name, '|NATION_', CAST(n_nationkey + 1 AS STRING)) WHEN n_nationkey = 3 THEN concat(n_name, '| NATION_25') ELSE n_name END AS aliases FROM {nation}""",
    "categories": "SELECT o_orderpriority AS name, concat('class ', substr(o_orderpriority, 1, 1)) AS category, CAST(min(o_orderkey % 5) + length(o_orderpriority) AS DOUBLE) AS weight FROM {orders} WHERE o_orderpriority NOT LIKE '5%' GROUP BY o_orderpriority",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame; only the table it names is read."""
    text = VIEWS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def oracle(body: str, *names: str) -> str:
    """DuckDB SQL: the named views as common table expressions before a query's body."""
    own = [f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names]
    recursive = "RECURSIVE " if body.lstrip().startswith("RECURSIVE ") else ""
    body = body.lstrip().removeprefix("RECURSIVE ")
    joined = ", ".join(own)
    return f"WITH {recursive}{joined}, {body.lstrip()[5:]}" if body.lstrip().upper().startswith("WITH ") else f"WITH {recursive}{joined} {body}"
