"""Token ids of whole documents as small zstandard frames that share one trained dictionary.

File format (Parquet, so any store Spark can write to will do): ``<path>/dictionary`` has one row (the
dictionary, its SHA-256, bytes per id, end id); ``<path>/blocks`` has one row per block of documents in
ascending doc_id order: ids of the documents, their token counts, the n + 1 offsets of their frames in
``payload``, the dictionary's SHA-256, and how many ids the block's partition holds before it. A document
is read by pruning blocks on ``first_doc``/``last_doc`` and decompressing its own frame alone.

Defined results: null text is an empty text (only the end id); a null doc_id sorts first; rows that repeat
a doc_id are all kept, ordered by a hash of the text; an empty table gives an empty store; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.base import lean, small_batches
from duelframe.llm.token_cache import CachedEncoder

#: Bounds of the dictionary's fit: documents, ids of each, and its own size.
SAMPLE_DOCUMENTS, SAMPLE_IDS, DICTIONARY_BYTES = 1000, 2048, 64 << 10
BLOCK_BYTES = 2 << 20
LEVEL = 3
BLOCKS = (
    "part int, block int, first_doc long, last_doc long, doc_ids array<long>, n_tokens array<long>, "
    "offsets array<long>, tokens_before long, tokens long, dictionary_sha256 string, payload binary"
)
TOKENS = "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long, ids array<int>"


def fit_dictionary(docs: DataFrame, tokenizer: str, width: int) -> bytes:
    """A zstandard dictionary from a bounded sample (by hash) of documents' serialised ids; may be empty."""
    import zstandard

    share = min(1.0, SAMPLE_DOCUMENTS / max(1, docs.count()))
    picked = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    @lean
    def serialised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, at in CachedEncoder.get(tokenizer).encode(batch.column(0)):
                cut = [ids[i : min(j, i + SAMPLE_IDS)].astype(f"<u{width}").tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary())], ["s"])

    rows = picked.select("text").mapInArrow(serialised, "s binary").limit(2 * SAMPLE_DOCUMENTS).collect()
    samples = [bytes(r["s"]) for r in rows if r["s"]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=200, d=8).as_bytes()
    except zstandard.ZstdError:  # too few or too small samples: frames then go without a dictionary
        return b""


def _codec(dictionary: bytes) -> dict:
    import zstandard

    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, width: int = 2, partitions: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` and write the store. ``width``: bytes of an id in a frame."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    dictionary = fit_dictionary(docs, tokenizer, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary), width, end_id)], "sha256 string, bytes binary, width int, end_id long").coalesce(1).write.parquet(f"{path}/dictionary")

    @lean
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=LEVEL, **_codec(dictionary)).compress
        encoder, part = CachedEncoder.get(tokenizer), TaskContext.get().partitionId()
        state = {"block": 0, "before": 0}
        docs_in, counts, frames = [], [], []

        def block() -> pa.RecordBatch:
            known = [d for d in docs_in if d is not None]
            row = {
                "part": part, "block": state["block"], "first_doc": min(known, default=None), "last_doc": max(known, default=None), "doc_ids": list(docs_in), "n_tokens": list(counts),
                "offsets": [0, *np.cumsum([len(f) for f in frames]).tolist()], "tokens_before": state["before"], "tokens": sum(counts), "dictionary_sha256": digest, "payload": b"".join(frames),
            }
            state["block"] += 1
            state["before"] += row["tokens"]
            for held in (docs_in, counts, frames):
                held.clear()
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("tokens_before", pa.int64()), ("tokens", pa.int64()), ("dictionary_sha256", pa.string()), ("payload", pa.binary())]))

        size = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, ids, at in encoder.encode(batch.column(1)):
                for k in range(len(at) - 1):
                    own = np.append(ids[at[k] : at[k + 1]], np.uint32(end_id)).astype(f"<u{width}")
                    frame = compress(own.tobytes())
                    docs_in.append(names[first + k])
                    counts.append(len(own))
                    frames.append(frame)
                    size += len(frame)
                    if size > BLOCK_BYTES:
                        yield block()
                        size = 0
        if docs_in:
            yield block()

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    blocks = docs.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(encode, BLOCKS)
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def read_store(spark: SparkSession, path: str, doc_ids: list[int] | None = None, with_ids: bool = False) -> DataFrame:
    """Documents of a store: place of their first id in their partition, token count, CRC-32 (and ids).

    ``doc_ids``: only these, by the offset index; else all.
    """
    held = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, digest, width = bytes(held["bytes"]), held["sha256"], held["width"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        near = F.lit(False)
        for d in sorted(wanted):
            near |= (F.col("first_doc") <= d) & (F.col("last_doc") >= d)
        blocks = blocks.filter(near)

    @lean
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        CachedEncoder.forget()  # workers that encoded would keep it for as long as they live
        decompress = zstandard.ZstdDecompressor(**_codec(dictionary)).decompress
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in ("part", "doc_ids", "n_tokens", "offsets", "tokens_before", "dictionary_sha256", "payload")}
                if row["dictionary_sha256"].as_py() != digest:
                    raise ValueError("a block was written with another dictionary")
                payload, at = memoryview(row["payload"].as_buffer()), row["offsets"].as_py()
                counts, names = row["n_tokens"].as_py(), row["doc_ids"].as_py()
                starts = row["tokens_before"].as_py() + np.cumsum([0, *counts[:-1]])
                out = {n: [] for n in ("doc_id", "part", "part_start", "n_tokens", "ids_crc32", "ids")}
                for i, name in enumerate(names):
                    if wanted is not None and name not in wanted:
                        continue
                    ids = np.frombuffer(decompress(payload[at[i] : at[i + 1]]), f"<u{width}").astype("<u4")
                    for key, value in zip(out, (name, row["part"].as_py(), int(starts[i]), len(ids), zlib.crc32(ids), ids.astype(np.int32) if with_ids else None), strict=True):
                        out[key].append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

    return blocks.select("part", "doc_ids", "n_tokens", "offsets", "tokens_before", "dictionary_sha256", "payload").mapInArrow(decode, TOKENS)


def with_global_start(spark: SparkSession, path: str, tokens: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before this one. Only one row per partition passes the driver."""
    parts = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect()
    rows, at = [], 0
    for r in parts:
        rows.append((r["part"], at))
        at += r["n"]
    starts = spark.createDataFrame(rows, "part int, from_ long")
    return tokens.join(F.broadcast(starts), "part").withColumn("start", F.col("from_") + F.col("part_start")).drop("from_")
