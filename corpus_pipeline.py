"""A corpus pipeline of five stages over ``documents``; each keeps the table's columns until the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import base, jaccard, langid, packing, pii, quality, registry

#: Below this share of all languages' scores a document's language counts as unknown.
LEAST_SCORE = 0.3
#: Chunks that a worker's tokenizer cache holds while packing.
CACHED_CHUNKS = 250_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose posterior quality is below one half."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept(docs, labels, *quality.sites_of(docs)).select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language: no letter, or no language's score stands out."""
    predict = langid.predictor(docs, langid.fit(docs.filter(langid.remainder() != 1)))
    own = docs.columns
    scored = docs.select(F.struct(*own).alias("row_"), predict("text").alias("p_"))
    return scored.filter((F.col("p_.lang_pred") != langid.UNDETERMINED) & (F.col("p_.score") >= LEAST_SCORE)).select("row_.*")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group."""
    return jaccard.one_of_each(docs).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and the terms that disclose it."""
    return pii.sanitise(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 tokens; the tokenizer's cache is small beside the other stages."""
    return packing.pack(docs, registry.tokenizer_path("byte_bpe_50k.json"), end_id=2, size=1024, entries=CACHED_CHUNKS)


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("PII", pii_stage),
    ("best-fit packing", packing_stage),
]

#: Learned models and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = base.materialize(docs, "stage")
    return docs
