"""Rules on rows: parsing with reasons, contracts, eligibility, validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed_parse(raw: Column, kind: str, field: str) -> tuple[Column, Column]:
    """Value and reason: date, int (not negative), bool (true or false), text (required)."""
    text = F.nullif(F.trim(raw), F.lit(""))
    if kind == "date":
        value = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))
    elif kind == "int":
        value = F.when(text.rlike(r"^\d+$"), text.try_cast("long"))
    elif kind == "bool":
        value = F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
    else:
        value = text
    return value, F.when(value.isNull(), F.lit(f"invalid {field}"))


def first_reason(*rules: tuple[Column, str]) -> Column:
    """The label of the first rule that holds; null if none does."""
    return F.coalesce(*(F.when(F.coalesce(rule, F.lit(False)), F.lit(label)) for rule, label in rules))


def violations(*rules: tuple[Column, str]) -> Column:
    """All labels of rules that hold."""
    return F.array_compact(F.array(*(F.when(F.coalesce(rule, F.lit(False)), F.lit(label)) for rule, label in rules)))


def row_contract(home: Column, away: Column, status: Column, h: Column, a: Column, result: Column, computed: Column, h_extra: Column, a_extra: Column, h_pens: Column, a_pens: Column) -> Column:
    """Labels of the cross-field rules that a contest's row breaks."""
    return violations(
        (home == away, "same teams"),
        ((status == "played") & (h.isNull() | a.isNull()), "scores required"),
        (status.isin("scheduled", "cancelled") & (h.isNotNull() | a.isNotNull()), "scores forbidden"),
        (result.isNotNull() & ~result.eqNullSafe(computed), "result mismatch"),
        ((h_extra.isNotNull() | a_extra.isNotNull()) & (h != a), "extra time without a tie"),
        ((h_extra < h) | (a_extra < a), "extra time score decreases"),
        (h_pens == a_pens, "penalties undecided"),
        (h_pens.isNotNull() & (F.coalesce(h_extra, h) != F.coalesce(a_extra, a)), "penalties without a tie"),
    )


def field_format(zone: Column, clock: Column, slug: Column) -> Column:
    """Labels of malformed fields: zone (IANA name or offset up to 14:00), HH:MM clock, id slug."""
    offset = zone.rlike(r"^[+-](0\d|1[0-3]):[0-5]\d$") | zone.rlike(r"^[+-]14:00$")
    return violations((~(zone.rlike(r"^[A-Za-z_]+(/[A-Za-z0-9_+-]+)*$") | offset), "zone"), (~clock.rlike(r"^([01]\d|2[0-3]):[0-5]\d$"), "clock"), (~slug.rlike(r"^[a-z0-9]+(-[a-z0-9]+)*$"), "slug"))


def exclusion_reason(date: Column, start: str, complete: Column, category: Column, allowed: tuple[str, ...], active: Column, senior: Column, neutral: Column) -> Column:
    return first_reason(
        (date < F.lit(start).cast("date"), "before_history"),
        (~complete, "incomplete"),
        (category.isNull(), "unresolved_category"),
        (~category.isin(*allowed), "category_not_allowed"),
        (~active, "team_status"),
        (~senior, "team_type"),
        (neutral.isNull(), "neutral_unknown"),
    )


def upcoming_eligibility(status: Column, kickoff: Column, cutoff: Column, created: Column, home: Column, away: Column, result: Column) -> Column:
    return first_reason(
        (status == "finished", "finished"),
        (status == "in_progress", "in_progress"),
        (status.isin("postponed", "cancelled", "suspended"), "interrupted"),
        (status != "scheduled", "unsupported_status"),
        (kickoff.isNull(), "missing_kickoff"),
        (kickoff <= cutoff, "kickoff_before_cutoff"),
        (kickoff <= created, "kickoff_before_creation"),
        (home.isNull() | away.isNull(), "unresolved_team"),
        (result.isNotNull(), "result_present"),
    )


def probabilities_ok(*p: Column, tolerance: float = 1e-6) -> Column:
    inside = F.lit(True)
    for x in p:
        inside &= F.coalesce(~F.isnan(x) & x.between(0, 1), F.lit(False))
    return inside & (F.abs(sum(p[1:], p[0]) - 1) <= tolerance)


def prospective_validity(created: Column, cutoff: Column, kickoff: Column, p: list[Column], version: Column, checksum: Column, result: Column) -> Column:
    return first_reason(
        (created >= kickoff, "created_after_kickoff"),
        (cutoff > created, "cutoff_after_creation"),
        (~probabilities_ok(*p), "probabilities"),
        (version.isNull(), "missing_version"),
        (checksum.isNull(), "missing_checksum"),
        (result.isNotNull(), "result_filled"),
    )


def result_contract(rows: DataFrame, key: str, status: Column, home: Column, away: Column, stored: Column, computed: Column) -> DataFrame:
    """key, state and reason of each row: evaluable, or why not; keys with different contents are ambiguous."""
    reason = first_reason((status.isin("postponed", "cancelled"), "interrupted"), (status != "finished", "not_final"), (home.isNull() | away.isNull(), "incomplete"), (stored.isNotNull() & ~stored.eqNullSafe(computed), "result_mismatch"))
    mark = F.sha2(F.concat_ws("|", F.coalesce(status, F.lit("")), F.coalesce(home.cast("string"), F.lit("")), F.coalesce(away.cast("string"), F.lit(""))), 256)
    out = rows.select(F.col(key).alias("key"), reason.alias("reason"), mark.alias("mark"))
    out = out.groupBy("key").agg(F.min("reason").alias("reason"), F.countDistinct("mark").alias("marks"))
    reason = F.when(F.col("marks") > 1, "ambiguous").otherwise(F.col("reason"))
    return out.select("key", F.when(reason.isNull(), "evaluable").otherwise("not_evaluable").alias("state"), reason.alias("reason"))


def as_of_mask(df: DataFrame, kickoff: str, status: str, hidden: list[str], cutoff: str, buffer_hours: int) -> DataFrame:
    """The table as it was known: later rows lose ``hidden``; those that ended just before are in progress."""
    at = F.lit(cutoff).cast("timestamp")
    seen = F.col(kickoff) <= at
    settled = F.col(kickoff) <= at - F.expr(f"INTERVAL {buffer_hours} HOURS")
    masked = {c: F.when(seen, F.col(c)) for c in hidden}
    masked[status] = F.when(~seen, "scheduled").when((F.col(status) == "finished") & ~settled, "in_progress").otherwise(F.col(status))
    return df.withColumns(masked)


def feature_whitelist(df: DataFrame, columns: list[str], keys: list[str], prohibited: tuple[str, ...] = ("result", "goals")) -> DataFrame:
    """Only declared feature columns; twice-named, missing or prohibited ones are errors."""
    if len(set(columns)) != len(columns):
        raise ValueError("a feature is named twice")
    bad = [c for c in columns if c not in df.columns or any(p in c for p in prohibited)]
    if bad:
        raise ValueError(f"features that can't be used: {bad}")
    return df.select(*keys, *columns)
