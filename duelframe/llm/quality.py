"""Document quality by hierarchical empirical Bayes.

A logistic classifier of a few text measures gives each document's own evidence. Its scores, summed over
all documents of each host and of each path below it, give posterior rates: a host's rate is shrunk towards
the global one, a path's towards its host's, by beta priors whose strength follows from how much rates
differ between sites (method of moments). Both leave the document's own score out, so that it counts once. A
document's log odds are its own plus its path's over the global.

Defined results: null text is an empty text; null hosts or paths are sites of their own; documents without
a label are only scored; where no labelled row of both kinds exists every document scores 0.5 and is kept;
repeated rows count each; an empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.llm.base import materialize, small_batches
from duelframe.llm.shingles import shingles, word_slices

#: Bound of the fit: labelled rows, by smallest hash.
LABELLED = 20_000
STEPS, RIDGE = 25, 1e-3
#: Prior strengths stay between these.
STRENGTH = (1.0, 1e4)
#: Up to so many sites their rates are broadcast (some 10 MB); beyond, they are joined by a shuffle.
BROADCAST_SITES = 200_000
REJECT_BELOW = 0.5
MARKS = np.zeros(256, bool)
MARKS[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'-"]] = True
UPPER, DIGIT, STOP = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
UPPER[65:91] = DIGIT[48:58] = STOP[[44, 46]] = True
MEASURES = 9


def measures(texts: pa.Array) -> np.ndarray:
    """MEASURES numbers for each text, from whole texts."""
    out = np.zeros((len(texts), MEASURES))
    for first, n, raw, at, h, doc in word_slices(texts):
        own = np.repeat(np.arange(n), np.diff(at))
        size = np.maximum(np.diff(at), 1)
        n_words = np.bincount(doc, minlength=n)
        order = np.lexsort((h, doc))
        hs, ds = h[order], doc[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
        runs = np.diff(np.append(np.flatnonzero(new), len(hs)))
        top = np.zeros(n)
        np.maximum.at(top, ds[new], runs)
        grams = np.diff(shingles(h, doc, n, 3)[1])
        words = np.maximum(n_words, 1)
        share = lambda table: np.bincount(own, table[raw], n) / size  # noqa: E731, B023
        out[first : first + n] = np.stack(
            [np.log1p(n_words), np.log1p(n_words) ** 2 / 10, 100 * share(MARKS), 10 * share(UPPER), 10 * share(DIGIT), 100 * share(STOP),
             np.bincount(ds[new], minlength=n) / words, top / words, grams / np.maximum(words - 2, 1)], 1)
    return out


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Weights, means and scales (3 x (MEASURES + 1)) from up to LABELLED labelled rows; null without both kinds."""
    known = labels.select("doc_id", "quality").filter("doc_id is not null and quality is not null")
    picked = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "quality").limit(LABELLED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.float64()), pa.array(list(measures(batch.column(1))), pa.list_(pa.float64())), batch.column(2)], ["y", "x", "h"])

    shown = docs.select("doc_id", "text").join(picked, "doc_id").select(F.col("quality").cast("double").alias("quality"), "text", F.xxhash64("doc_id", "text").alias("h"))
    rows = shown.mapInArrow(run, "y double, x array<double>, h long").orderBy("h", "y").limit(LABELLED).collect()
    y = np.array([r["y"] for r in rows])
    if not len(y) or y.min() == y.max():
        return None
    x = np.array([r["x"] for r in rows])
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    x = np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))])
    w = np.zeros(MEASURES + 1)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + RIDGE * len(y) * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - RIDGE * len(y) * w)
        w += step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
    return np.stack([w, np.append(mean, 0), np.append(scale, 1)])


def scorer(docs: DataFrame, model: np.ndarray | None):
    """A column function: text to the classifier's probability."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array(np.full(len(texts), 0.5))
        x = np.clip((measures(texts) - model[1, :-1]) / model[2, :-1], -8, 8)
        return pa.array(1 / (1 + np.exp(-np.clip(x @ model[0, :-1] + model[0, -1], -30, 30))))

    return score


def _strength(sites: DataFrame, mean: str, prior: Column) -> float:
    """How many documents a prior is worth: mean * (1 - mean) over the variance of site rates, less chance's."""
    spread = F.pow(F.col(mean) - prior, 2)
    chance = F.col("var_") / F.col("n_")
    r = sites.agg(F.sum(F.col("n_") * (spread - chance)).alias("v"), F.sum("n_").alias("n"), F.sum(F.col("n_") * prior * (1 - prior)).alias("b")).first()
    if not r["n"]:
        return STRENGTH[1]
    return float(min(max(r["b"] / max(r["v"], 1e-9), STRENGTH[0]), STRENGTH[1]))


def sites_of(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path of each row: from its ``url`` (path: its first folder) where there is such a column; else the
    source stands in for the host and the language for the part of it that a document comes from."""
    if "url" not in docs.columns:
        return F.col("source"), F.col("lang")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return host, F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)


def site_sums(scored: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(host_, path_, host_n, host_s, path_n, path_s): documents and summed scores of all sites; and the global
    rate (mu), the strengths of the priors (host, path) and how many sites there are."""
    whole = scored.agg(F.avg("p_")).first()[0]
    mu = 0.5 if whole is None else float(min(max(whole, 1e-4), 1 - 1e-4))
    tally = [F.count("*").alias("n_"), F.sum("p_").alias("s_"), F.coalesce(F.var_pop("p_"), F.lit(0.0)).alias("var_")]
    hosts = materialize(scored.groupBy("host_").agg(*tally).withColumn("m_", F.col("s_") / F.col("n_")), "hosts")
    of_host = _strength(hosts, "m_", F.lit(mu))
    rated = hosts.select("host_", F.col("n_").alias("host_n"), F.col("s_").alias("host_s"), ((F.col("s_") + of_host * mu) / (F.col("n_") + of_host)).alias("host_rate"))
    paths = scored.groupBy("host_", "path_").agg(*tally).withColumn("m_", F.col("s_") / F.col("n_"))
    paths = materialize(paths.alias("p").join(rated.alias("h"), F.col("p.host_").eqNullSafe(F.col("h.host_"))).select("p.*", "host_n", "host_s", "host_rate"), "sites")
    of_path = _strength(paths, "m_", F.col("host_rate"))
    return paths.select("host_", "path_", "host_n", "host_s", F.col("n_").alias("path_n"), F.col("s_").alias("path_s")), {"mu": mu, "host": of_host, "path": of_path, "sites": paths.count()}


def posterior(scored: DataFrame) -> DataFrame:
    """Adds host_rate, path_rate (each without the row's own score) and quality_ to rows with host_, path_ and p_."""
    sums, prior = site_sums(scored.select("host_", "path_", "p_"))
    sums = sums.withColumnRenamed("host_", "of_host_").withColumnRenamed("path_", "of_path_")
    sums = F.broadcast(sums) if prior["sites"] <= BROADCAST_SITES else sums
    joined = scored.join(sums, F.col("host_").eqNullSafe(F.col("of_host_")) & F.col("path_").eqNullSafe(F.col("of_path_")), "left")
    rest = lambda s, n, k, towards: (F.greatest(F.col(s) - F.col("p_"), F.lit(0.0)) + k * towards) / (F.col(n) - 1 + k)
    rated = joined.withColumn("host_rate", rest("host_s", "host_n", prior["host"], prior["mu"])).withColumn("path_rate", rest("path_s", "path_n", prior["path"], F.col("host_rate")))
    safe = lambda p: F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    logit = lambda p: F.log(p / (1 - p))
    odds = logit(safe(F.col("p_"))) + logit(safe(F.col("path_rate"))) - logit(F.lit(prior["mu"]))
    return rated.withColumn("quality_", 1 / (1 + F.exp(-odds))).drop("of_host_", "of_path_", "host_n", "host_s", "path_n", "path_s")


def assess(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, classifier score, host and path rates, posterior quality and the decision, for every document."""
    score = scorer(docs, fit(docs, labels))
    scored = materialize(docs.select("doc_id", host.alias("host_"), path.alias("path_"), score("text").alias("p_")), "scores")
    return posterior(scored).select("doc_id", F.col("p_").alias("score"), "host_rate", "path_rate", F.col("quality_").alias("quality"), (F.col("quality_") >= REJECT_BELOW).alias("keep"))


def kept(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """The documents that ``assess`` keeps, with their own columns. Rows are written with their scores, so that
    each text is scored once and the second pass needs no Python."""
    score = scorer(docs, fit(docs, labels))
    scored = materialize(docs.select(F.struct(*docs.columns).alias("row_"), host.alias("host_"), path.alias("path_"), score("text").alias("p_")), "scores")
    return posterior(scored).filter(F.col("quality_") >= REJECT_BELOW).select("row_.*")
