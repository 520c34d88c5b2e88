"""The training table with its eleven derived columns and its report, and the scorecard of forecasts made ahead."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.functions import scalars
from duelframe.operators import contracts, scoring, windows
from duelframe.operators.reports import count_by_keys


@dataclass(frozen=True)
class TrainingRules:
    history_start: str
    evaluation_start: str
    allowed_categories: tuple[str, ...]
    allowed_statuses: tuple[str, ...] = ("active",)
    allowed_types: tuple[str, ...] = ("senior",)
    exclude_neutral: bool = False


def training_table(matches: DataFrame, teams: DataFrame, categories: DataFrame, rules: TrainingRules) -> DataFrame:
    """All rows of ``matches`` with the derived columns; what is excluded stays, with the first reason.

    ``matches``: match_id, match_status, match_date, home_id, away_id, home_goals, away_goals, competition, neutral,
    home_advantage. ``teams``: team, status, type. ``categories``: name, category, importance. Both are looked up by
    joins; keys of theirs are unique.
    """
    looked = matches
    for s in ("home", "away"):
        own = teams.select(F.col("team").alias(f"{s}_key_"), F.col("status").alias(f"{s}_team_status"), F.col("type").alias(f"{s}_team_type"))
        looked = looked.join(own, F.col(f"{s}_id") == F.col(f"{s}_key_"), "left")
    kinds = categories.select(F.col("name").alias("name_"), F.col("category").alias("competition_category"), F.col("importance").alias("competition_importance"))
    looked = looked.join(kinds, F.col("competition") == F.col("name_"), "left")
    needed = ("match_id", "match_date", "home_id", "away_id", "home_goals", "away_goals", "competition", "neutral", "home_key_", "away_key_")
    complete = F.coalesce(F.col("match_status") == "played", F.lit(False))
    for c in needed:
        complete &= F.col(c).isNotNull()
    both = lambda c, allowed: F.col(f"home_team_{c}").isin(*allowed) & F.col(f"away_team_{c}").isin(*allowed)
    reason = contracts.first_reason(
        (F.col("match_date") < F.lit(rules.history_start).cast("date"), "before_rating_history_start"),
        (~complete, "incomplete_record"),
        (F.col("competition_category").isNull(), "unresolved_competition_category"),
        (~F.col("competition_category").isin(*rules.allowed_categories), "competition_category_not_allowed"),
        (~both("status", rules.allowed_statuses), "team_status_not_allowed"),
        (~both("type", rules.allowed_types), "team_type_not_allowed"),
        (F.col("neutral") & F.lit(rules.exclude_neutral), "neutral_site_excluded"),
    )
    return looked.withColumns({
        "exclusion_reason": reason, "home_advantage_eligible": F.coalesce(F.col("home_advantage").isin("home_team", "away_team"), F.lit(False)),
        "modeling_period": scalars.modeling_period(F.col("match_date"), rules.history_start, rules.evaluation_start), "same_date_batch_id": F.date_format("match_date", "yyyy-MM-dd"),
    }).withColumn("model_eligible", F.col("exclusion_reason").isNull()).drop("home_key_", "away_key_", "name_")


def training_report(table: DataFrame) -> DataFrame:
    """(key, value, n): rows in all, eligible ones, and rows by reason, category and period, in one pass."""
    keys = {"eligible": F.col("model_eligible"), "exclusion_reason": F.coalesce("exclusion_reason", F.lit("none")), "competition_category": F.coalesce("competition_category", F.lit("none")), "modeling_period": F.col("modeling_period"), "rows": F.lit("all")}
    return count_by_keys(table, keys)


def prospective_scorecard(ledger: DataFrame, results: DataFrame, validity, horizons: list, stages: str) -> DataFrame:
    """Metrics of official forecasts of fixtures whose result can be evaluated, beside two baselines on the same rows.

    ``ledger``: forecasts with fixture_id, created_at, lead_hours and probabilities; ``validity``: a column, null
    where a row counts. ``results``: fixture_id, outcome (null: not evaluable), ``stages``. Long form: model, segment
    (all, rule, horizon, stage), its value, and the metrics.
    """
    official = windows.official_selection(ledger.filter(validity.isNull()))
    judged = official.drop("outcome", stages).join(results.select("fixture_id", "outcome", stages), "fixture_id").filter("outcome is not null")
    segments = {"all": F.lit("all"), "rule": F.col("rule"), "horizon": scalars.horizon_bucket(F.col("lead_hours"), horizons), "stage": F.coalesce(F.col(stages), F.lit("none"))}
    own = scoring.segment_metrics(judged, segments).withColumn("model", F.lit("official"))
    base = scoring.baseline_probabilities(judged).withColumns({"model": F.concat(F.lit("baseline "), "baseline"), "segment": F.lit("all"), "segment_value": F.lit("all")}).drop("baseline")
    return own.unionByName(base)
