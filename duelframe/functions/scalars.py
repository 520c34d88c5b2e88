"""Column functions: outcomes, places and times, expected scores, count models, probabilities."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
CLIP = 1e-15


def outcome_from_scores(home: Column, away: Column) -> Column:
    return F.when(home > away, "home_win").when(home < away, "away_win").when(home == away, "draw")


def normalize_alias(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.lower(name), "-_", "  "), r"\s+", " "))


def timezone_delta_hours(at: Column, zone_a: Column, zone_b: Column) -> Column:
    local = lambda z: F.unix_micros(F.from_utc_timestamp(at, z))
    return (local(zone_a) - local(zone_b)) / 3.6e9


def haversine_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    half = lambda x, y: F.pow(F.sin(F.radians(x - y) / 2), 2)
    h = half(lat_a, lat_b) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half(lon_a, lon_b)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def elevation_change(current: Column, previous: Column) -> tuple[Column, Column]:
    """Signed and absolute change; null outside -500 to 6000 m."""
    ok = current.between(-500, 6000) & previous.between(-500, 6000)
    change = F.when(ok, current - previous)
    return change, F.abs(change)


def coordinate_checks(lat: Column, lon: Column) -> Column:
    return lat.between(-90, 90) & lon.between(-180, 180)


def venue_flags(country: Column, previous_country: Column, home_country: Column, neutral: Column) -> Column:
    """struct<cross_border, host_match, is_neutral>: the explicit flag first, else not the host's country."""
    host = country == home_country
    return F.struct((country != previous_country).alias("cross_border"), host.alias("host_match"), F.coalesce(neutral, ~host).alias("is_neutral"))


def expected_score(difference: Column) -> Column:
    return 1 / (1 + F.pow(F.lit(10.0), -difference / 400))


def margin_multiplier(goal_difference: Column, weight: float) -> Column:
    margin = F.abs(goal_difference)
    return F.when(margin <= 1, 1.0).otherwise(1 + (margin - 1) * weight)


def decay_weight(played: Column, cutoff: Column, half_life_days: float | None) -> Column:
    if half_life_days is None:
        return F.lit(1.0)
    return F.exp(-math.log(2) * F.greatest(F.datediff(cutoff, played), F.lit(0)) / half_life_days)


def expected_goals(base: Column, attack: Column, defence: Column, category: Column, home: Column | None = None) -> Column:
    """Mean goals: effects that are unknown count as none, the sum stays within -8 and 4."""
    total = base + sum((F.coalesce(x, F.lit(0.0)) for x in (attack, defence, category, home) if x is not None), F.lit(0.0))
    return F.exp(F.least(F.greatest(total, F.lit(-8.0)), F.lit(4.0)))


def poisson_pmf(mean: Column, most: int) -> Column:
    """array of P(0) to P(most)."""
    log_factorials = F.array(*(F.lit(math.lgamma(k + 1)) for k in range(most + 1)))
    at = F.transform(log_factorials, lambda f, k: F.exp(k * F.log(mean) - mean - f))
    never = F.transform(log_factorials, lambda f, k: F.when(k == 0, 1.0).otherwise(0.0))
    return F.when(mean > 0, at).when(mean == 0, never)


def low_score_correction(h: Column, a: Column, home_mean: Column, away_mean: Column, rho: Column) -> Column:
    both = lambda x, y: (h == x) & (a == y)
    return F.when(both(0, 0), 1 - home_mean * away_mean * rho).when(both(0, 1), 1 + home_mean * rho).when(both(1, 0), 1 + away_mean * rho).when(both(1, 1), 1 - rho).otherwise(1.0)


def observed_score_loglik(h: Column, a: Column, home_mean: Column, away_mean: Column, rho: Column) -> Column:
    log_pmf = lambda k, m: k * F.log(m) - m - F.log(F.factorial(k.cast("int")).cast("double"))
    tau = low_score_correction(h, a, home_mean, away_mean, rho)
    return log_pmf(h, home_mean) + log_pmf(a, away_mean) + F.log(F.greatest(tau, F.lit(CLIP)))


def probability_normalize(*p: Column) -> list[Column]:
    kept = [F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)) for x in p]
    total = sum(kept[1:], kept[0])
    return [F.when(total > 0, x / total) for x in kept]


def probability_logits(*p: Column) -> list[Column]:
    safe = [F.least(F.greatest(x, F.lit(CLIP)), F.lit(1 - CLIP)) for x in p]
    return [*(F.log(x / (1 - x)) for x in safe), F.log(safe[0] / safe[-1])]


def temperature_transform(t: float | Column, *p: Column) -> list[Column]:
    raised = [F.pow(F.greatest(x, F.lit(CLIP)), 1 / F.lit(t) if isinstance(t, float) else 1 / t) for x in p]
    total = sum(raised[1:], raised[0])
    return [x / total for x in raised]


def horizon_bucket(lead: Column, buckets: list[tuple[str, float | None, float | None]]) -> Column:
    """The first bucket with low <= lead < high (null: open), else unbucketed."""
    out = F.lit("unbucketed")
    for name, low, high in reversed(buckets):
        inside = (F.lit(True) if low is None else lead >= low) & (F.lit(True) if high is None else lead < high)
        out = F.when(inside, name).otherwise(out)
    return out


# Names of tournaments, lower-cased, by which kinds of matches are told apart.
WORLD_CUP = "fifa world cup"
CONTINENTAL = ("afc asian cup", "africa cup of nations", "copa america", "concacaf gold cup", "ofc nations cup", "uefa euro")


def match_type_classifier(name: Column, continental: tuple[str, ...] = CONTINENTAL, world_cup: str = WORLD_CUP) -> Column:
    """friendly, world_cup, qualification, continental (a name with one of these parts) or other."""
    n = F.lower(name)
    found = F.lit(False)
    for part in continental:
        found |= n.contains(part)
    return F.when(n.contains("friendly"), "friendly").when(n == world_cup, "world_cup").when(n.rlike("qualification|qualifier"), "qualification").when(found, "continental").otherwise("other")


def status_normalizer(raw: Column, known: dict[str, str]) -> Column:
    key = F.translate(F.upper(raw), "-", "_")
    table = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    return F.coalesce(table[key], F.lit("scheduled"))


def participant_status(home: Column, away: Column) -> Column:
    missing = home.isNull().cast("int") + away.isNull().cast("int")
    return F.when(missing == 0, "known").when(missing == 1, "partially_known").otherwise("tbd")


def after_extra_time(duration: Column, regular: Column, full: Column, extra: Column) -> Column:
    """Score after extra time: the full-time one there; an extra score below the regular one is an increment."""
    rebuilt = F.when(extra < regular, regular + extra).otherwise(extra)
    return F.when(duration == "EXTRA_TIME", F.coalesce(full, rebuilt)).otherwise(rebuilt)


def status_gated(status: Column, score: Column, allowed: tuple[str, ...]) -> Column:
    return F.when(status.isin(*allowed), score)


def home_advantage_status(neutral: Column, country: Column, home: Column, away: Column) -> Column:
    return F.when(neutral, "neutral").when(country == home, "home_team").when(country == away, "away_team").otherwise("unknown")


def modeling_period(date: Column, start: str, evaluation: str) -> Column:
    return F.when(date < F.lit(start).cast("date"), "pre_rating_history").when(date < F.lit(evaluation).cast("date"), "rating_history").otherwise("evaluation")


def advancing_side(result: Column, home_pens: Column, away_pens: Column, home_extra: Column, away_extra: Column) -> Column:
    by = lambda h, a: F.when(h > a, "home").when(a > h, "away")
    return F.coalesce(F.when(result == "home_win", "home").when(result == "away_win", "away"), by(home_pens, away_pens), by(home_extra, away_extra))


def proportion_standard_error(p: Column, n: Column) -> Column:
    return F.sqrt(p * (1 - p) / n)
