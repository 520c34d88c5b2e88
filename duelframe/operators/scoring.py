"""Scores of probability forecasts: proper scores, calibration, paired bootstrap, comparisons."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.functions.ids import hash_draw
from duelframe.functions.scalars import CLIP, observed_score_loglik
from duelframe.schemas import OUTCOMES

P = ("p_home", "p_draw", "p_away")
#: Bin edges as doubles that equal-width spacing gives; a value equal to an edge starts the next bin.
EDGES = (0.0, 0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0)


def _is(k: int) -> Column:
    return (F.col("outcome") == OUTCOMES[k]).cast("int")


def predicted() -> Column:
    """The most probable class; the first in order wins ties."""
    h, d, a = (F.col(p) for p in P)
    return F.when((h >= d) & (h >= a), OUTCOMES[0]).when(d >= a, OUTCOMES[1]).otherwise(OUTCOMES[2])


def with_losses(rows: DataFrame) -> DataFrame:
    """Adds log_loss, brier, rps, hit and p_true to each forecast."""
    true = F.when(F.col("outcome") == OUTCOMES[0], F.col(P[0])).when(F.col("outcome") == OUTCOMES[1], F.col(P[1])).otherwise(F.col(P[2]))
    brier = sum((F.pow(F.col(P[k]) - _is(k), 2) for k in (1, 2)), F.pow(F.col(P[0]) - _is(0), 2))
    first = F.col(P[0]) - _is(0)
    rps = (F.pow(first, 2) + F.pow(first + F.col(P[1]) - _is(1), 2)) / 2
    return rows.withColumns({"p_true": true, "log_loss": -F.log(F.greatest(true, F.lit(CLIP))), "brier": brier, "rps": rps, "hit": (predicted() == F.col("outcome")).cast("int")})


def proper_scores(rows: DataFrame, *by: str) -> DataFrame:
    names = ("log_loss", "brier", "rps")
    out = with_losses(rows).groupBy(*by).agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in names), F.avg("hit").alias("accuracy"), F.avg("p_true").alias("mean_true_probability"))
    return out


def bin_of(p: Column) -> Column:
    """0 to 9; the last bin is closed."""
    out = F.lit(0)
    for k, edge in enumerate(EDGES[1:-1]):
        out = out + (p >= edge).cast("int")
    return out


def by_class(rows: DataFrame, *keep: str) -> DataFrame:
    """One row for each forecast and class: p, hit."""
    each = F.array(*(F.struct(F.lit(OUTCOMES[k]).alias("class"), F.col(P[k]).alias("p"), _is(k).alias("hit")) for k in range(3)))
    return rows.select(*keep, F.explode(each).alias("x")).select(*keep, "x.*")


def calibration_curve(rows: DataFrame, *by: str) -> DataFrame:
    return by_class(rows, *by).withColumn("bin", bin_of(F.col("p"))).groupBy(*by, "class", "bin").agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.avg("hit").alias("observed"))


def classwise_ece(rows: DataFrame, *by: str) -> DataFrame:
    gaps = calibration_curve(rows, *by)
    each = gaps.groupBy(*by, "class").agg((F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("observed"))) / F.sum("n")).alias("e"))
    return each.groupBy(*by).agg(F.avg("e").alias("ece"))


def top_label_ece(rows: DataFrame, *by: str, least: int = 30) -> DataFrame:
    top = rows.withColumns({"p": F.greatest(*P), "hit": (predicted() == F.col("outcome")).cast("int")}).withColumn("bin", bin_of(F.col("p")))
    bins = top.groupBy(*by, "bin").agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"), F.avg("hit").alias("observed"))
    out = bins.groupBy(*by).agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.abs(F.col("mean_p") - F.col("observed"))) / F.sum("n")).alias("e"))
    return out.select(*by, "n", F.when(F.col("n") >= least, F.col("e")).alias("ece"), F.when(F.col("n") < least, "insufficient_sample").alias("note"))


def metrics_by_group(rows: DataFrame, key: Column, label: str) -> DataFrame:
    return proper_scores(rows.withColumn("grp", F.coalesce(key.cast("string"), F.lit(label))), "grp")


def segment_metrics(rows: DataFrame, segments: dict[str, Column]) -> DataFrame:
    """Several segmentations in one long table; each row counts once in each."""
    each = F.array(*(F.struct(F.lit(s).alias("segment"), c.cast("string").alias("value")) for s, c in segments.items()))
    return proper_scores(rows.withColumn("s_", F.explode(each)).select("*", "s_.segment", F.col("s_.value").alias("segment_value")), "segment", "segment_value")


def goal_log_likelihood(rows: DataFrame, *by: str) -> DataFrame:
    """n, mean log-likelihood of the observed scores under the forecasts' means and low-score correction, and its negative.

    ``rows``: home_goals, away_goals, home_mean, away_mean, rho. Rows without a score or a forecast are left out.
    """
    whole = rows.dropna(subset=["home_goals", "away_goals", "home_mean", "away_mean", "rho"])
    own = observed_score_loglik(*(F.col(c) for c in ("home_goals", "away_goals", "home_mean", "away_mean", "rho")))
    return whole.groupBy(*by).agg(F.count("*").alias("n"), F.avg(own).alias("goal_log_likelihood")).withColumn("goal_loss", -F.col("goal_log_likelihood"))


#: Rows of a group whose draws are looked up in an array of its deltas; those of larger groups meet them in a join.
HELD = 1 << 16


def paired_bootstrap_ci(deltas: DataFrame, key: str, by: str, resamples: int, held: int = HELD) -> DataFrame:
    """Mean of paired deltas with 2.5 % and 97.5 % quantiles of resampled means, and the share below 0.

    Every row's weight in a resample is how often hash-derived draws from 0 to n - 1 name its place. A group of up to
    ``held`` rows makes its draws beside the array of its deltas, with no row for each draw; draws and rows of larger
    groups meet in a join on (group, place), so groups are spread over the cluster. Draws are many more than their
    plan's size tells, so that neither join may be a broadcast one.
    """
    sizes = deltas.groupBy(by).agg(F.count("*").alias("n"), F.avg("delta").alias("mean_delta"))
    met = deltas.select(by, key, "delta").join(sizes.select(by, "n").hint("merge"), by)

    small = met.filter(F.col("n") <= held).groupBy(by, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct(key, "delta"))), lambda x: x.delta).alias("deltas_"))
    kind = deltas.schema[by].dataType.simpleString()
    own = small.select(by, F.col(by).cast("string").alias("name_"), "deltas_").mapInArrow(lambda batches: _resampled(batches, resamples), f"`{by}` {kind}, m double")

    large = met.filter(F.col("n") > held)
    placed = large.select(by, "delta", (F.row_number().over(Window.partitionBy(by).orderBy(key)) - 1).alias("place"))
    draws = sizes.filter(F.col("n") > held).select(by, "n", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))).alias("resample")).select(by, "n", "resample", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("slot"))
    picked = draws.select(by, "resample", (hash_draw(F.col(by), F.col("resample"), F.col("slot")) % F.col("n")).alias("place"))
    means = picked.join(placed.hint("merge"), [by, "place"]).groupBy(by, "resample").agg(F.avg("delta").alias("m")).select(by, "m").unionByName(own)
    out = means.groupBy(by).agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high"), F.avg((F.col("m") < 0).cast("int")).alias("share_below_zero"))
    return out.join(sizes.hint("merge"), by).select(by, "n", "mean_delta", "low", "high", "share_below_zero")


def _resampled(batches: Iterator[pa.RecordBatch], resamples: int) -> Iterator[pa.RecordBatch]:
    """The means of each group's resamples, by the draws of ``hash_draw``; null deltas are left out of a mean."""
    slots: list[bytes] = []
    for batch in batches:
        for k, name in enumerate(batch.column(1).to_pylist()):
            held = batch.column(2)[k].values
            n, values, known = len(held), pc.fill_null(held, 0.0).to_numpy(zero_copy_only=False), held.is_valid().to_numpy(zero_copy_only=False)
            slots += [str(j).encode() for j in range(len(slots), n)]
            means = []
            for r in range(resamples):
                start = f"{name}|{r}|".encode()
                drawn = b"".join([hashlib.md5(start + s).digest() for s in slots[:n]])
                at = np.frombuffer(drawn, ">u4")[::4].astype(np.int64) % n
                there = int(known[at].sum())
                means.append(float(values[at].sum()) / there if there else None)
            column = pa.concat_arrays([batch.column(0).slice(k, 1)] * resamples)
            yield pa.RecordBatch.from_arrays([column, pa.array(means, pa.float64())], [batch.schema.field(0).name, "m"])


def model_comparison_delta(scored: DataFrame, by: str, model: str, a: str, b: str) -> DataFrame:
    """Metrics of model a less model b for each group."""
    m = proper_scores(scored, by, model)
    x, y = (m.filter(F.col(model) == v).select(by, *(F.col(c).alias(f"{c}_{v_}") for c in ("log_loss", "brier", "rps"))) for v, v_ in ((a, "a"), (b, "b")))
    return x.join(y, by).select(by, *((F.col(f"{c}_a") - F.col(f"{c}_b")).alias(f"{c}_delta") for c in ("log_loss", "brier", "rps")))


def baseline_probabilities(rows: DataFrame) -> DataFrame:
    """Uniform and historical outcome frequencies, scored on the same rows."""
    rates = rows.agg(*(F.avg(_is(k).cast("double")).alias(f"f{k}") for k in range(3)))
    base = rows.select("outcome").join(F.broadcast(rates))
    uniform = base.select("outcome", F.lit("uniform").alias("baseline"), *(F.lit(1 / 3).alias(p) for p in P))
    history = base.select("outcome", F.lit("history").alias("baseline"), *(F.col(f"f{k}").alias(P[k]) for k in range(3)))
    return proper_scores(uniform.unionByName(history), "baseline")


def ablation_summary(scored: DataFrame) -> DataFrame:
    """Per ablation: minimum loss, folds, folds not better than the baseline fold, mean loss of folds."""
    folds = scored.groupBy("ablation", "fold").agg(F.avg("log_loss").alias("loss"))
    base = folds.filter("ablation = 'base'").select("fold", F.col("loss").alias("base_loss"))
    return folds.join(base, "fold").groupBy("ablation").agg(F.min("loss").alias("min_tune_log_loss"), F.count("*").alias("folds"), F.count_if(F.col("loss") >= F.col("base_loss")).alias("folds_not_better"), F.avg("loss").alias("mean_log_loss"))


def temperature_fit(rows: DataFrame, by: str, grid: tuple[float, ...]) -> DataFrame:
    """The temperature with the least mean log loss of each group; identity unless better by 1e-12."""
    raised = lambda p: F.pow(F.greatest(F.col(p), F.lit(CLIP)), 1 / F.col("t"))
    tried = rows.withColumn("t", F.explode(F.array(*(F.lit(t) for t in grid))))
    true = F.when(F.col("outcome") == OUTCOMES[0], raised(P[0])).when(F.col("outcome") == OUTCOMES[1], raised(P[1])).otherwise(raised(P[2]))
    losses = tried.groupBy(by, "t").agg(F.avg(-F.log(F.greatest(true / (raised(P[0]) + raised(P[1]) + raised(P[2])), F.lit(CLIP)))).alias("loss"))
    best = losses.groupBy(by).agg(F.min(F.struct("loss", "t")).alias("b"), F.min(F.when(F.col("t") == 1.0, F.col("loss"))).alias("identity"))
    better = F.col("b.loss") < F.col("identity") - 1e-12
    return best.select(by, F.when(better, F.col("b.t")).otherwise(1.0).alias("temperature"), F.least(F.col("b.loss"), F.col("identity")).alias("loss"))


def scored_projection(scored: DataFrame) -> DataFrame:
    """One flat row per scored forecast: predicted and actual class, and the classes' shares as a baseline.

    Equal probabilities: the first of home, draw, away counts. An empty table gives no rows.
    """
    shares = scored.agg(*(F.avg((F.col("outcome") == c).cast("double")).alias(c) for c in ("home_win", "draw", "away_win"))).first()
    predicted = F.when((F.col("p_home") >= F.col("p_draw")) & (F.col("p_home") >= F.col("p_away")), "home_win").when(F.col("p_draw") >= F.col("p_away"), "draw").otherwise("away_win")
    base = [F.lit(shares[c]).cast("double").alias(f"base_{c}") for c in ("home_win", "draw", "away_win")]
    return scored.select("forecast_id", "fixture_id", "created_at", "lead_hours", "p_home", "p_draw", "p_away", predicted.alias("predicted"), F.col("outcome").alias("actual"), *base)
