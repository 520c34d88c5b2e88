"""Structured Streaming forms of the append-only ledger and of snapshot changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from duelframe.functions.ids import row_fingerprint
from duelframe.operators.joins import snapshot_diff
from duelframe.operators.windows import ledger_merge


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, which the cluster or a test names."""
    key = "spark.checkpoint.dir"
    base = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not base:
        raise ValueError(f"{key} names no folder that driver and executors share")
    return base.rstrip("/")


def stream_ledger_append(arriving: DataFrame, ledger_path: str, checkpoint: str, key: str, order: list[str]) -> StreamingQuery:
    """Append arriving forecasts by id: replays add nothing, an id with other content stops the stream.

    Each batch reads only ids and marks of the ledger that its own ids meet.
    """

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new, conflicts = ledger_merge(batch, key, row_fingerprint(batch), order)
        if not conflicts.isEmpty():
            raise ValueError("an id arrived with different contents")
        marked = new.withColumn("mark_", row_fingerprint(new))
        try:
            held = spark.read.schema(new.schema).parquet(ledger_path)
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            held = spark.createDataFrame([], new.schema)
        known = held.withColumn("held_", row_fingerprint(held)).select(F.col(key).alias("k_"), "held_").join(new.select(F.col(key).alias("k_")), "k_", "left_semi")
        met = marked.join(known, marked[key] == known["k_"], "left")
        if not met.filter("held_ is not null and held_ != mark_").isEmpty():
            raise ValueError("an id is in the ledger with other content")
        met.filter("held_ is null").select(*new.columns).write.mode("append").parquet(ledger_path)

    return arriving.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_snapshot_changes(arriving: DataFrame, state_path: str, out_path: str, checkpoint: str, key: str, fields: list[str], fetched: str) -> StreamingQuery:
    """For each arriving snapshot in order of fetch time: its differences from the last; older ones are ignored.

    A batch reads the state of those before it and writes its differences, then its last snapshot, each to a folder of
    its own number, which a repeated batch writes over: nothing comes twice, wherever a run ended. Of the states only
    the last one before the batch (for its repetition) and the batch's own are kept.
    """

    def change(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earlier = [n for n in _numbers(spark, state_path) if n < number]
        state = spark.read.schema(batch.schema).parquet(f"{state_path}/batch={earlier[-1]}") if earlier else batch.limit(0)
        seen = state.agg(F.max(fetched)).first()[0] if earlier else None
        found, current = [], None
        for row in batch.select(fetched).distinct().orderBy(fetched).collect():
            if seen is None or row[0] > seen:
                seen, current = row[0], batch.filter(F.col(fetched) == row[0])
                found.append(snapshot_diff(state, current, key, fields).withColumn(fetched, F.lit(row[0])))
                state = current
        if current is not None:
            reduce(DataFrame.unionByName, found).write.mode("overwrite").parquet(f"{out_path}/batch={number}")
            current.write.mode("overwrite").parquet(f"{state_path}/batch={number}")
            _remove(spark, *(f"{state_path}/batch={n}" for n in earlier[:-1]))

    return arriving.writeStream.foreachBatch(change).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _files(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that have a folder there, in order."""
    files, where = _files(spark, path)
    names = [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []
    return sorted(int(x.removeprefix("batch=")) for x in names if x.startswith("batch="))


def _remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        files, where = _files(spark, path)
        files.delete(where, True)
