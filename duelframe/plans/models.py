"""Outcome and goal models on ``pyspark.ml``, and the pieces around them."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions.scalars import CLIP, decay_weight, expected_score, low_score_correction, poisson_pmf
from duelframe.plans import boosting, goals
from duelframe.schemas import OUTCOMES

CLASS = {o: k for k, o in enumerate(OUTCOMES)}


def class_index(outcome: Column) -> Column:
    return F.when(outcome == OUTCOMES[0], 0.0).when(outcome == OUTCOMES[1], 1.0).when(outcome == OUTCOMES[2], 2.0)


def preprocess_stages(numeric: list[str], categorical: list[str]) -> list:
    """Median imputation and standardising; one-hot categories, unknown ones ignored."""
    stages = [Imputer(strategy="median", inputCols=numeric, outputCols=[f"{c}_i" for c in numeric]), VectorAssembler(inputCols=[f"{c}_i" for c in numeric], outputCol="numeric_v"), StandardScaler(withMean=True, inputCol="numeric_v", outputCol="numeric_s")]
    parts = ["numeric_s"]
    if categorical:
        stages += [StringIndexer(inputCols=categorical, outputCols=[f"{c}_x" for c in categorical], handleInvalid="keep", stringOrderType="alphabetAsc"), OneHotEncoder(inputCols=[f"{c}_x" for c in categorical], outputCols=[f"{c}_o" for c in categorical])]
        parts += [f"{c}_o" for c in categorical]
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def constant_estimator(train: DataFrame) -> DataFrame:
    """Class frequencies of the training rows: one row."""
    return train.agg(*(F.avg((F.col("outcome") == o).cast("double")).alias(p) for o, p in zip(OUTCOMES, ("p_home", "p_draw", "p_away"))))


def multinomial_logistic(train: DataFrame, numeric: list[str], categorical: list[str], reg: float = 0.01):
    lr = LogisticRegression(family="multinomial", regParam=reg, maxIter=50, labelCol="label", featuresCol="features")
    return Pipeline(stages=[*preprocess_stages(numeric, categorical), lr]).fit(train.withColumn("label", class_index(F.col("outcome"))))


def with_probabilities(scored: DataFrame) -> DataFrame:
    v = vector_to_array("probability")
    return scored.withColumns({p: v[k] for k, p in enumerate(("p_home", "p_draw", "p_away"))})


def ordinal_logistic(train: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Two cumulative logits; crossed bounds are swapped, differences are the three probabilities."""
    out = test
    for name, label in (("c1", F.col("outcome") == OUTCOMES[0]), ("c2", F.col("outcome") != OUTCOMES[2])):
        lr = LogisticRegression(regParam=0.01, maxIter=50, labelCol="label", probabilityCol=f"{name}_p", rawPredictionCol=f"{name}_r", predictionCol=f"{name}_y")
        stages = preprocess_stages(numeric, categorical)
        model = Pipeline(stages=[*stages, lr]).fit(train.withColumn("label", label.cast("double")))
        out = model.transform(out).withColumn(name, vector_to_array(f"{name}_p")[1]).select(*out.columns, name)
    low, high = F.least("c1", "c2"), F.greatest("c1", "c2")
    return out.withColumns({"p_home": low, "p_draw": high - low, "p_away": 1 - high}).drop("c1", "c2")


def boosted_models(train: DataFrame, numeric: list[str]) -> list:
    """(outcome, boosted-tree pipeline against the rest) of each outcome."""
    out = []
    for outcome in OUTCOMES:
        gbt = GBTClassifier(maxIter=8, maxDepth=3, seed=2026, labelCol="label", featuresCol="features")
        out.append((outcome, Pipeline(stages=[*preprocess_stages(numeric, []), gbt]).fit(train.withColumn("label", (F.col("outcome") == outcome).cast("double")))))
    return out


#: Two option sets of the challenger: shallow trees, and larger ones in smaller steps.
BOOSTED_GRID = ({"rounds": 8, "learning_rate": 0.2, "leaves": 4, "depth": 2}, {"rounds": 12, "learning_rate": 0.1, "leaves": 8, "depth": 3})


def boosted_tree_challenger(train: DataFrame, test: DataFrame, numeric: list[str], tune: DataFrame | None = None, grid: tuple[dict, ...] = BOOSTED_GRID) -> DataFrame:
    """Boosted trees of all three outcomes at once; with ``tune`` rows the option set that has the least log loss there."""
    labelled = lambda rows: rows.withColumn("class_", class_index(F.col("outcome")))
    if tune is None:
        model = boosting.fit_boosted(labelled(train), numeric, "class_", len(OUTCOMES), **grid[0])
    else:
        model, _ = boosting.select_boosted(labelled(train), labelled(tune).filter("class_ is not null"), numeric, "class_", len(OUTCOMES), list(grid))
    return boosting.with_boosted(test, model, ["p_home", "p_draw", "p_away"])


def draw_rate_probability(rows: DataFrame, draw_rate: Column) -> DataFrame:
    """Draw share from training rows (0.05 to 0.45), the rest split by the expected score of ``difference``."""
    d = F.least(F.greatest(draw_rate, F.lit(0.05)), F.lit(0.45))
    e = expected_score(F.col("difference"))
    return rows.withColumns({"p_home": (1 - d) * e, "p_draw": d, "p_away": (1 - d) * (1 - e)})


def goal_rows(matches: DataFrame, cutoff: str, half_life: float) -> DataFrame:
    """Two rows a contest: goals of a side against the other, with time weights."""
    side = lambda t, o, g, h: F.struct(F.col(t).cast("string").alias("attack"), F.col(o).cast("string").alias("defence"), F.col(g).cast("double").alias("goals"), F.lit(h).alias("at_home"))
    both = F.array(side("home_id", "away_id", "home_goals", 1.0), side("away_id", "home_id", "away_goals", 0.0))
    before = matches.filter(F.col("match_date") < F.lit(cutoff).cast("date"))
    return before.select("competition", decay_weight(F.col("match_date"), F.lit(cutoff).cast("date"), half_life).alias("weight"), F.explode(both).alias("x")).select("competition", "weight", "x.*")


def weighted_poisson_goal_fit(matches: DataFrame, cutoff: str, half_life: float = 730.0, strength: float = 0.05) -> tuple[goals.GoalModel, DataFrame]:
    """(fitted model, effects): log-link Poisson on attack, defence, category and home; effects of teams sum to 0."""
    model = goals.fit_goals(goal_rows(matches, cutoff, half_life), strength)
    return model, matches.sparkSession.createDataFrame(model.effects(), "kind string, name string, effect double")


def score_grid(rows: DataFrame, most: int = 10, outcome_most: int = 40) -> DataFrame:
    """From home_mean, away_mean and rho: outcome probabilities on a wide grid, mass and mode of the stored one.

    The grid is a product of two marginals but for four low scores, so its sums come from the marginals' and what
    those four differ by: no row becomes many, and nothing is shuffled.
    """
    x, y = F.col("x_"), F.col("y_")
    at = lambda c, k: c[k]
    grid = rows.withColumns({"x_": poisson_pmf(F.col("home_mean"), outcome_most), "y_": poisson_pmf(F.col("away_mean"), outcome_most)})
    # one pass along both marginals: sums so far (a, b, of the stored scores c, d), and what wins, draws and loses
    both = F.zip_with(x, y, lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    names = ("k", "a", "b", "c", "d", "w", "e", "l")
    step = lambda s, v: F.struct(*(e.alias(n) for n, e in zip(names, (s.k + 1, s.a + v.p, s.b + v.q, F.when(s.k <= most, s.c + v.p).otherwise(s.c), F.when(s.k <= most, s.d + v.q).otherwise(s.d), s.w + v.p * s.b, s.e + v.p * v.q, s.l + v.q * s.a))))
    grid = grid.withColumn("s_", F.aggregate(both, F.struct(F.lit(0).alias("k"), *(F.lit(0.0).alias(n) for n in names[1:])), step))
    low = {(h, a): F.greatest(low_score_correction(F.lit(h), F.lit(a), F.col("home_mean"), F.col("away_mean"), F.col("rho")), F.lit(0.0)) for h in (0, 1) for a in (0, 1)}
    more = {k: at(x, k[0]) * at(y, k[1]) * (t - 1) for k, t in low.items()}
    own = lambda n: F.col(f"s_.{n}")
    grid = grid.withColumns({"w_": own("w") + more[1, 0], "d_": own("e") + more[0, 0] + more[1, 1], "l_": own("l") + more[0, 1], "all_": own("a") * own("b") + sum(more.values()), "mass": own("c") * own("d") + sum(more.values())})
    best = lambda c, first: F.array_max(F.transform(F.slice(c, first + 1, most + 1 - first), lambda v, k: F.struct(v.alias("p"), (-(k + first)).alias("k"))))
    # the mode is one of the four, or the best cell of the rest, which has a score of two or more on some side
    cell = lambda p, h, a: F.struct(F.round(p, 12).alias("p"), h.cast("int").alias("h"), a.cast("int").alias("a"))
    pairs = [(best(x, i), best(y, j)) for i, j in ((2, 0), (0, 2))]
    cells = [cell(h["p"] * a["p"], h["k"], a["k"]) for h, a in pairs] + [cell(at(x, h) * at(y, a) * t, F.lit(-h), F.lit(-a)) for (h, a), t in low.items()]
    grid = grid.withColumn("m_", F.array_max(F.array(*cells)))
    return grid.select(*rows.columns, (F.col("w_") / F.col("all_")).alias("p_home"), (F.col("d_") / F.col("all_")).alias("p_draw"), (F.col("l_") / F.col("all_")).alias("p_away"), "mass", (1 - F.col("mass")).alias("residual"), F.concat_ws("-", -F.col("m_.h"), -F.col("m_.a")).alias("modal_score"))


def rho_profile_fit(rows: DataFrame, by: str, steps: int = 40, most: float = 0.2, penalty: float = 10.0) -> DataFrame:
    """The rho of a grid with the largest weighted mean log correction less penalty * rho^2, for each group."""
    grid = F.array(*(F.lit(-most + 2 * most * k / steps) for k in range(steps + 1)))
    tau = low_score_correction(F.col("home_goals"), F.col("away_goals"), F.col("home_mean"), F.col("away_mean"), F.col("rho"))
    low = rows.filter("home_goals <= 1 and away_goals <= 1").withColumn("rho", F.explode(grid)).groupBy(by, "rho").agg(F.sum(F.col("weight") * F.log(F.greatest(tau, F.lit(CLIP)))).alias("s"))
    total = rows.groupBy(by).agg(F.sum("weight").alias("w"))
    value = F.col("s") / F.col("w") - penalty * F.col("rho") * F.col("rho")
    return low.join(total, by).groupBy(by).agg(F.max(F.struct(value.alias("v"), (-F.abs("rho")).alias("near"), F.col("rho"))).alias("b")).select(by, "b.rho", F.col("b.v").alias("objective"))


def walk_forward_folds(matches: DataFrame, folds: DataFrame) -> DataFrame:
    """(fold, match_id, role): test rows inside a fold's dates and competition, train rows strictly before it."""
    f = F.broadcast(folds)
    d = F.col("match_date")
    test = d.between(F.col("start"), F.col("end")) & (F.col("competition") == F.col("fold_competition"))
    return matches.join(f, d <= F.col("end")).select("fold", "match_id", F.when(d < F.col("start"), "train").when(test, "test").alias("role")).filter("role is not null")


def nested_temporal_split(matches: DataFrame, start: str, tune_days: int, calibration_days: int) -> DataFrame:
    s = F.lit(start).cast("date")
    d = F.col("match_date")
    role = F.when(d >= s, "test").when(d >= F.date_sub(s, calibration_days), "calibration").when(d >= F.date_sub(s, calibration_days + tune_days), "tune").otherwise("train")
    return matches.withColumn("role", role)


def permutation_importance(scored_with: callable, test: DataFrame, features: list[str], key: str) -> DataFrame:
    """Increase of mean log loss when one feature's values are dealt out in another (hash) order.

    ``scored_with``: rows to rows with ``log_loss``. Ranks are taken in ``salt`` buckets, so no single task
    orders all rows.
    """
    from pyspark.sql import Window

    base = scored_with(test).agg(F.avg("log_loss").alias("base"))
    out = None
    for f in features:
        bucket = F.pmod(F.xxhash64(key), F.lit(64))
        a = test.withColumn("b_", bucket).withColumn("r_", F.row_number().over(Window.partitionBy("b_").orderBy(key)))
        b = test.select(F.col(f).alias("v_"), bucket.alias("b_"), F.row_number().over(Window.partitionBy(bucket).orderBy(F.xxhash64(key, F.lit(f)))).alias("r_"))
        loss = scored_with(a.join(b, ["b_", "r_"]).drop(f, "b_", "r_").withColumnRenamed("v_", f)).agg(F.avg("log_loss").alias("loss")).join(F.broadcast(base)).select(F.lit(f).alias("feature"), (F.col("loss") - F.col("base")).alias("increase"))
        out = loss if out is None else out.unionByName(loss)
    return out
