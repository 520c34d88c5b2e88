"""Counts, coverage, distributions, audits, standings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions.scalars import outcome_from_scores
from duelframe.operators.windows import ranked


def home_away_expand(matches: DataFrame) -> DataFrame:
    """Each contest becomes two side rows; sides without a team go."""
    side = lambda s, t, o, g, c: F.struct(F.lit(s).alias("side"), F.col(t).alias("team"), F.col(o).alias("opponent"), F.col(g).alias("scored"), F.col(c).alias("conceded"))
    both = F.array(side("home", "home_id", "away_id", "home_goals", "away_goals"), side("away", "away_id", "home_id", "away_goals", "home_goals"))
    return matches.select("match_id", "match_date", "competition", F.explode(both).alias("x")).select("match_id", "match_date", "competition", "x.*").filter("team is not null")


def group_standings(matches: DataFrame, group: str = "competition") -> DataFrame:
    sides = home_away_expand(matches)
    won, drawn = F.col("scored") > F.col("conceded"), F.col("scored") == F.col("conceded")
    return sides.groupBy(group, "team").agg(
        F.count("*").alias("played"), F.count_if(won).alias("won"), F.count_if(drawn).alias("drawn"), F.count_if(~won & ~drawn).alias("lost"),
        F.sum(F.when(won, 3).when(drawn, 1).otherwise(0)).alias("points"), F.sum("scored").alias("scored"), F.sum("conceded").alias("conceded"), F.sum(F.col("scored") - F.col("conceded")).alias("difference"))


def count_by_keys(rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(key, value, n) for several keys in one pass."""
    each = F.array(*(F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in keys.items()))
    return rows.select(F.explode(each).alias("x")).groupBy("x.key", "x.value").agg(F.count("*").alias("n"))


def distinct_entities(matches: DataFrame) -> DataFrame:
    out = matches.select("match_date", F.explode(F.array("home_id", "away_id")).alias("team"))
    return out.agg(F.countDistinct("team").alias("teams"), F.min("match_date").alias("first_date"), F.max("match_date").alias("last_date"), (F.count("*") / 2).cast("long").alias("matches"))


def feature_coverage(rows: DataFrame, features: list[str], groups: list[str]) -> DataFrame:
    """Rows and non-null values of each feature overall and by each group."""
    each = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).isNotNull().cast("int").alias("known")) for f in features))
    kinds = F.array(F.struct(F.lit("all").alias("level"), F.lit("all").alias("value")), *(F.struct(F.lit(g).alias("level"), F.col(g).cast("string").alias("value")) for g in groups))
    # counted by all groups together first: few rows then take the levels
    fine = rows.select(*groups, F.explode(each).alias("x")).groupBy(*groups, "x.feature").agg(F.count("*").alias("r"), F.sum("x.known").alias("k"))
    out = fine.select("feature", "r", "k", F.explode(kinds).alias("l")).groupBy("feature", "l.level", "l.value").agg(F.sum("r").alias("row_count"), F.sum("k").alias("known"))
    return out.withColumn("ratio", F.col("known") / F.col("row_count"))


def feature_tiering(coverage: DataFrame, operational: tuple[str, ...] = ()) -> DataFrame:
    overall = coverage.filter("level = 'all'")
    tier = F.when(F.col("feature").isin(*operational) if operational else F.lit(False), "operational_only").when(F.col("ratio") >= 0.8, "trainable").when(1 - F.col("ratio") >= 0.2, "indicator_only").otherwise("excluded")
    return overall.select("feature", "ratio", tier.alias("tier"))


def distribution_summary(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """count, min, quartiles with linear interpolation, max of finite values.

    Values are ranked by range over all tasks, and only those at the wanted ranks meet, so no task holds a group's values.
    """
    finite = rows.filter(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))).select(*by, F.col(value).alias("value_"))
    placed = ranked(finite, [F.col("value_")], list(by))
    sizes = placed.groupBy(*by).agg(F.count("*").alias("n"), F.min("value_").alias("min"), F.max("value_").alias("max"))
    shares = ((0.25, "p25"), (0.5, "median"), (0.75, "p75"))
    at = {name: (F.col("n") - 1) * F.lit(q) for q, name in shares}
    ends = {name: (F.floor(x).cast("long") + 1, F.ceil(x).cast("long") + 1) for name, x in at.items()}
    own = sizes.select(F.col("n").alias("n"), *(F.col(c).alias(f"of_{c}_") for c in by))
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}_"))
    wanted = F.lit(False)
    for low, high in ends.values():
        wanted |= (F.col("rank_") == low) | (F.col("rank_") == high)
    met = placed.join(F.broadcast(own), same) if not by else placed.join(own, same)
    picked = met.filter(wanted).groupBy(*by, "n").agg(*(F.max(F.when(F.col("rank_") == e, F.col("value_").cast("double"))).alias(f"{name}_{k}_") for name, both in ends.items() for k, e in enumerate(both)))
    low, high = (lambda name, k=k: F.col(f"{name}_{k}_") for k in (0, 1))
    quartiles = picked.select(*(F.col(c).alias(f"of_{c}_") for c in by), *((low(name) + (high(name) - low(name)) * (x - F.floor(x))).alias(name) for name, x in at.items()))
    return sizes.join(quartiles, same).select(*by, "n", "min", "p25", "median", "p75", "max")


def impossible_counts(rows: DataFrame, key: list[str], checks: dict[str, Column]) -> DataFrame:
    """One row: how often each check holds, and rows beyond the first of their key."""
    extra = rows.groupBy(*key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    return rows.agg(*(F.count_if(c).alias(k) for k, c in checks.items())).join(F.broadcast(extra))


def leakage_audit(sides: DataFrame, rules: list[tuple[Column, str]]) -> DataFrame:
    """(rule, n): rows that break rules, repeated team rows, and contests without exactly two rows."""
    broken = sides.select(F.explode(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for c, k in rules)))).alias("rule"))
    twice = sides.groupBy("match_id", "team").agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("duplicate_team_row").alias("rule"))
    odd = sides.groupBy("match_id").agg(F.count("*").alias("n")).filter("n != 2").select(F.lit("not_two_sides").alias("rule"))
    return broken.unionByName(twice).unionByName(odd).groupBy("rule").agg(F.count("*").alias("n"))


def fold_inventory(rows: DataFrame, fold: str) -> DataFrame:
    return rows.groupBy(fold).agg(F.count("*").alias("matches"), F.min("match_date").alias("first_date"), F.max("match_date").alias("last_date"), F.concat_ws("; ", F.array_sort(F.collect_set("competition"))).alias("competitions"))


def ledger_summary(ledger: DataFrame, validity: Column, least: int = 30) -> DataFrame:
    out = ledger.withColumn("v_", validity).agg(F.count("*").alias("row_count"), F.countDistinct("fixture_id").alias("fixtures"), F.countDistinct("fold").alias("snapshots"), F.count_if(F.col("v_").isNull()).alias("valid"), F.count_if(F.col("v_").isNotNull()).alias("invalid"), F.max("created_at").alias("cutoff"))
    return out.withColumn("small_sample", F.col("valid") < least)


def freshness_report(rows: DataFrame, kickoff: str, updated: str, now: str, hours: int) -> DataFrame:
    """One row: the next kickoff after now, and rows without an update within the hours."""
    at = F.lit(now).cast("timestamp")
    stale = F.col(updated).isNull() | (F.unix_micros(at) - F.unix_micros(updated) > hours * 3_600_000_000)
    return rows.agg(F.min(F.when(F.col(kickoff) > at, F.col(kickoff))).alias("next_kickoff"), F.count_if(stale).alias("stale"))


def partition_balance(rows: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """One row: counts of all parts, of the rows, and whether they balance."""
    out = rows.agg(F.count("*").alias("received"), *(F.count_if(c).alias(k) for k, c in parts.items()))
    return out.withColumn("balanced", sum((F.col(k) for k in parts), F.lit(0)) == F.col("received"))


def outcome_table_probabilities(runs: DataFrame, total: int, stages: list[str]) -> DataFrame:
    """Per team: the share of runs in which it reached each stage, and whether shares never rise."""
    out = runs.groupBy("team").pivot("stage", stages).agg(F.countDistinct("run") / total).fillna(0.0, stages)
    falls = F.lit(True)
    for a, b in zip(stages, stages[1:]):
        falls &= F.col(a) >= F.col(b)
    return out.withColumn("monotone", falls)


def fallback_audit(runs: DataFrame, counter: str, recorded: int) -> DataFrame:
    return runs.agg(F.sum(counter).alias("total"), F.count_if(F.col(counter) > 0).alias("runs_with")).withColumn("matches_recorded", F.col("total") == recorded)


def fixture_state_split(rows: DataFrame, state: Column, key: str) -> DataFrame:
    """Counts and smallest and largest ids by state; ids themselves stay in rows, for a state can hold most of them."""
    return rows.withColumn("state", state).groupBy("state").agg(F.count("*").alias("n"), F.min(key).alias("first_id"), F.max(key).alias("last_id"))


def with_outcome(matches: DataFrame) -> DataFrame:
    return matches.withColumn("outcome", outcome_from_scores(F.col("home_goals"), F.col("away_goals")))
