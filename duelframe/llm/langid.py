"""Language identification with a blended-spectrum string kernel.

A text's features are which character n-grams of one to three (from a bounded vocabulary) it has. The
normalised kernel against a few landmark texts (Nystroem) feeds one-versus-rest kernel ridge regression;
documents are scored by matrix products over a batch of presence rows. The fit uses a bounded sample by
hash of each language, fewer texts and landmarks of each where there are very many languages, so that the model
stays small; none is left out. Whole texts are used throughout; Spark counts the sample's n-grams, and the driver
gets the vocabulary and which of it each sampled text has.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and where nothing was
learned; rows without a language are not learned from; repeated rows count each; an empty table gives an
empty result; a null doc_id is kept, and its row is learned from only where a caller keeps it; other columns are
not read. Ties between languages go to the first in order of names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.base import lean, materialize, small_batches

#: Bounds of the fit: texts and landmarks of a language, n-grams of the vocabulary.
TEXTS, LANDMARKS, VOCABULARY = 200, 24, 8192
#: Texts and landmarks of all languages together; beyond, each language has fewer, but FEWEST texts and one landmark.
ALL_TEXTS, ALL_LANDMARKS, FEWEST = 20_000, 2000, 4
#: Sampled texts that one step of the fit works on.
FIT_ROWS = 512
RIDGE = 1e-2
TABLE_BITS = 19
#: Characters that one step works on.
STEP_CHARS = 1 << 20
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    slots: np.ndarray  # vocabulary number + 1 at each place of the hash table, 0 if free
    keys: np.ndarray  # n-gram there
    landmarks: np.ndarray  # vocabulary x landmarks, columns of unit length
    weights: np.ndarray  # landmarks x languages


def _cells(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def grams(text: str) -> Iterator[np.ndarray]:
    """All n-grams of one to three lower-cased characters as numbers, in steps."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    for first in range(0, len(c), STEP_CHARS):
        part = c[first : first + STEP_CHARS + 2]
        yield part
        two = (part[:-1] << np.uint64(21)) | part[1:]
        yield two
        yield (two[:-1] << np.uint64(21)) | part[2:]


def presence(texts: list[str], model: Model) -> np.ndarray:
    """Rows of 0 and 1: which n-grams of the vocabulary each text has."""
    out = np.zeros((len(texts), model.landmarks.shape[0] + 1), np.uint8)
    for k, text in enumerate(texts):
        for keys in grams(text):
            at = _cells(keys)
            while len(keys):  # n-grams of other cells move on by one; few cells are taken, so almost all end here
                found, own = model.slots[at], model.keys[at] == keys
                out[k, found[own]] = 1
                on = (found > 0) & ~own
                keys, at = keys[on], (at[on] + 1) & ((1 << TABLE_BITS) - 1)
    return out[:, 1:]


def hash_table(vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and keys: each n-gram in the first free cell from its own on."""
    slots, keys = np.zeros(1 << TABLE_BITS, np.int32), np.zeros(1 << TABLE_BITS, np.uint64)
    for k, at in enumerate(_cells(vocabulary).tolist()):
        while slots[at]:
            at = (at + 1) & ((1 << TABLE_BITS) - 1)
        slots[at], keys[at] = k + 1, vocabulary[k]
    return slots, keys


def kernel(rows: np.ndarray, model: Model) -> np.ndarray:
    """Normalised kernel of each row with each landmark."""
    x = rows.astype(np.float32)
    return (x @ model.landmarks) / np.sqrt(np.maximum(x.sum(1), 1))[:, None]


def sample(docs: DataFrame, each: int) -> DataFrame:
    """(lang, text) of up to ``each`` different rows of each language: those with the smallest hashes of id and text.

    Every task keeps its own smallest first, so no language's rows meet in one place; rows that share id and text
    count once.
    """

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in batches:
            held = part if held is None else pd.concat([held, part])
            held = held.drop_duplicates().sort_values(["lang", "h"]).groupby("lang").head(each)
        if held is not None:
            yield held

    hashed = docs.filter("lang is not null").select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    order = Window.partitionBy("lang").orderBy("h")
    few = hashed.select("lang", "h").mapInPandas(smallest, "lang string, h long").distinct()
    few = few.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= each).drop("r")
    return hashed.join(F.broadcast(few), ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"]).select("lang", "text")


def vocabulary_of(texts: DataFrame) -> np.ndarray:
    """The n-grams that most of the texts have, the most frequent first."""

    @lean
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0):
                found = [np.unique(g) for g in grams(t.as_py() or "")]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64))], ["gram"])

    counted = texts.select("text").mapInArrow(distinct, "gram long").groupBy("gram").agg(F.count("*").alias("n"))
    return np.array([r["gram"] for r in counted.orderBy(F.desc("n"), "gram").limit(VOCABULARY).collect()], np.int64).view(np.uint64)


def fit(docs: DataFrame) -> Model | None:
    """Learn from the texts and languages of ``docs``."""
    known = docs.filter("lang is not null and text != ''").select(F.countDistinct("lang")).first()[0]
    if not known:
        return None
    each = min(TEXTS, max(ALL_TEXTS // known, FEWEST))
    few = materialize(sample(docs, each).filter("text != ''"), "sample")
    vocabulary = vocabulary_of(few)
    slots, keys = hash_table(vocabulary)
    model = Model([], slots, keys, np.zeros((len(vocabulary), 1), np.float32), np.zeros((1, 1), np.float32))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @lean
    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(presence([t.as_py()], shared.value), axis=1).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits, pa.binary())], ["lang", "bits"])

    rows = sorted((r["lang"], bytes(r["bits"])) for r in few.select("lang", "text").mapInArrow(marked, "lang string, bits binary").collect())
    model.languages = languages = sorted({lang for lang, _ in rows})
    place = {lang: k for k, lang in enumerate(languages)}
    y = np.array([place[lang] for lang, _ in rows])
    unpacked = lambda at: np.unpackbits(np.array([np.frombuffer(rows[k][1], np.uint8) for k in at]), axis=1, count=len(vocabulary))
    marks = max(1, min(LANDMARKS, ALL_LANDMARKS // len(languages)))
    chosen = unpacked(np.concatenate([np.flatnonzero(y == c)[:marks] for c in range(len(languages))]))
    model.landmarks = (chosen.T / np.sqrt(np.maximum(chosen.sum(1), 1))).astype(np.float32)
    size = len(chosen)
    gram, aim = RIDGE * len(y) * (model.landmarks.T @ model.landmarks).astype(np.float64) + 1e-6 * np.eye(size), np.zeros((size, len(languages)))
    balance = len(y) / (len(languages) * np.bincount(y, minlength=len(languages)))
    for first in range(0, len(y), FIT_ROWS):
        at = np.arange(first, min(first + FIT_ROWS, len(y)))
        near = kernel(unpacked(at), model).astype(np.float64)
        gram += near.T @ (balance[y[at]][:, None] * near)
        aim += near.T @ (balance[y[at]][:, None] * (y[at][:, None] == np.arange(len(languages))))
    model.weights = np.linalg.solve(gram, aim).astype(np.float32)
    return model


def predict_texts(texts: pa.Array, model: Model | None) -> pa.StructArray:
    """(lang_pred, score) of each text."""
    lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    held = [(k, t) for k, t in enumerate(texts.to_pylist()) if t and model is not None and any(map(str.isalpha, t))]
    for first in range(0, len(held), 512):
        part = held[first : first + 512]
        found = np.maximum(kernel(presence([t for _, t in part], model), model) @ model.weights, 0)
        best = found.argmax(1)
        share = found[np.arange(len(part)), best] / np.maximum(found.sum(1), 1e-9)
        for (k, _), b, s in zip(part, best, share, strict=True):
            lang[k], score[k] = model.languages[b], float(min(max(s, 0.0), 1.0))
    return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang_pred", "score"])


def predictor(docs: DataFrame, model: Model | None):
    """A column function: text to struct<lang_pred, score>. The model (a few MB, by its bounds) is broadcast."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        return predict_texts(texts, shared.value)

    return predict


def remainder() -> Column:
    """crc32 of the doc_id as text, modulo 3; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % 3


def identify(docs: DataFrame) -> DataFrame:
    """Predict every document, having learned from those whose remainder is not 1."""
    predict = predictor(docs, fit(docs.filter(remainder() != 1).select("doc_id", "text", "lang")))
    out = docs.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), predict("text").alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
