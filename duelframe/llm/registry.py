"""The queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duelframe.llm import base, bpe, grid_codes, hamming, jaccard, langid, media, negatives, packing, pii, quality, sharding, simhash, token_store


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{base.shared_dir(spark)}/token-store-{uuid.uuid4().hex}"
    token_store.write_store(_table(spark, sf_dir), path, tokenizer_path("word_bpe_49k.json"), end_id=1)
    read = token_store.with_global_start(spark, path, token_store.read_store(spark, path))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir)
    return quality.assess(docs, _table(spark, sf_dir, "labels"), *quality.sites_of(docs))


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), end_id=2, size=1024)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(_table(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks, public_tokenizers.PATTERN).drop("decoded")


def op9_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.top_k(_table(spark, sf_dir, "embeddings"))


def op10_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(_table(spark, sf_dir))


def op11_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_codes.encode(_table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(_table(spark, sf_dir, "embeddings"))


#: op7 by brute force: word shingles, all pairs that share one, and reachability.
JACCARD_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w WHERE ws IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id != b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_token_store, op2_quality, op3_pattern_packing, op4_pii, op5_language, op6_sharding, op7_ngram_jaccard, op8_bpe, op9_hamming_topk, op10_audio, op11_grid_codes, op12_simhash, op13_hard_negatives)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op7_ngram_jaccard": JACCARD_SQL, "op9_hamming_topk": hamming.ORACLE_SQL, "op11_grid_codes": grid_codes.ORACLE_SQL, "op13_hard_negatives": negatives.ORACLE_SQL}
