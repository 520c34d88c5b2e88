"""Helpers shared by the training-data operators: durable tables, text buffers, global ranks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on; a longer document is a step of its own.
SLICE_BYTES = 4 << 20
#: Rows of a task's Arrow batches; texts vary in size, so this stays small.
BATCH_ROWS = 2000
#: Joins that the rows of one key are dealt to by ``spread_join``.
SALTS = 16
#: Bytes of a part of a set of bits.
BIT_PART = 1 << 15


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, which the cluster or a test names."""
    key = "spark.checkpoint.dir"
    base = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not base:
        raise ValueError(f"{key} names no folder that driver and executors share")
    return base.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``materialize`` that nothing reads any more, so that rounds don't fill the shared folder."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.table_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread_join(rows: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``small``, which has at most one row a key: a key that very many rows have is
    dealt to SALTS joins by hash, each with a copy of its row. Null keys meet nothing. Never a broadcast: Spark takes
    the copies for no more than the file of ``small``, and they would grow on the driver with the input."""
    each = small.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt_", F.pmod(F.xxhash64(*(F.col(c) for c in rows.columns if c != key)), F.lit(SALTS)).cast("int"))
    return dealt.join(each.hint("merge"), [key, "salt_"], how).drop("salt_")


def dealt_join(rows: DataFrame, other: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join that deals both tables out by ``key``; Spark splits a key that many of ``rows`` have. Compressed files of
    ids and small numbers are far smaller than their rows: by the size of a file, millions of rows would be broadcast."""
    return rows.join(other.hint("merge"), key, how)


def bit_set(places: DataFrame, bits: int) -> np.ndarray:
    """2^bits bits as bytes, those at the (only) column's numbers set. Each task sets bits of its own; parts of
    them meet by place, one after the other, so that nothing larger than the set is held anywhere."""
    size = 1 << (bits - 3)
    part = min(size, BIT_PART)

    def rows(found: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for k, own in found:
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["k", "bits"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            np.bitwise_or.at(table, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        yield from rows((k, own) for k, own in enumerate(table.reshape(-1, part)) if own.any())

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held[k] = held.get(k, 0) | np.frombuffer(own.as_buffer(), np.uint8)
        yield from rows(held.items())

    shape = "k int, bits binary"
    whole = np.zeros(size, np.uint8).reshape(-1, part)
    for r in places.mapInArrow(mark, shape).repartition("k").mapInArrow(unite, shape).collect():
        whole[r["k"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return whole.ravel()


def release() -> None:
    """Hand memory that this worker no longer uses back to the system; workers are reused by other operators."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def lean(run):
    """A ``mapInArrow`` function that ends with ``release``."""

    @wraps(run)
    def whole(batches):
        yield from run(batches)
        release()

    return whole


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def utf8_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null: empty) and the n + 1 offsets of each text in them."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``most`` bytes each; every range has one document at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def ranked(df: DataFrame, keys: list, tag: str, partitions: int | None = None) -> tuple[DataFrame, int]:
    """Rows of ``df`` with ``rank_``: their place (from 0) in the order of ``keys``; and the row count.

    Rows are dealt by range and sorted inside each partition, so no task holds more than its range;
    the only small table is one row per partition.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = materialize(
        df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("mono_", F.monotonically_increasing_id()),
        tag,
    )
    part = F.shiftright("mono_", 33)
    sizes = sorted((r["part_"], r["n_"]) for r in table.groupBy(part.alias("part_")).agg(F.count("*").alias("n_")).collect())
    rows, at = [], 0
    for k, count in sizes:
        rows.append((k, at))
        at += count
    starts = spark.createDataFrame(rows, "part_ long, from_ long")
    out = table.withColumn("part_", part).join(F.broadcast(starts), "part_")
    rank = F.col("from_") + F.col("mono_") - F.shiftleft("part_", 33)
    return out.withColumn("rank_", rank).drop("part_", "from_", "mono_"), at
