"""Sinks: typed tables, quarantine, CSV, status partitions, immutable snapshots, publishing gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.functions.ids import table_digest

STATUS_GROUPS = {"scheduled": "pending", "timed": "pending", "in_progress": "in_progress", "paused": "in_progress", "played": "finished", "finished": "finished"}
MOST_BYTES = 2_000_000


def typed_parquet_sink(df: DataFrame, path: str, schema: T.StructType, order: list[str]) -> None:
    df.select(*(F.col(f.name).cast(f.dataType) for f in schema)).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def quarantine_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def csv_sink(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    df.select(*(columns or sorted(df.columns))).write.mode("overwrite").option("header", True).csv(path)


def status_partitioned_view(df: DataFrame, path: str, key: str, status: str = "status") -> None:
    """One table by status group; a repeated key is an error."""
    if not df.groupBy(key).count().filter("count > 1").isEmpty():
        raise ValueError(f"repeated {key}")
    table = F.create_map(*(F.lit(x) for pair in STATUS_GROUPS.items() for x in pair))
    df.withColumn("status_group", F.coalesce(table[F.col(status)], F.lit("interrupted"))).write.mode("overwrite").partitionBy("status_group").parquet(path)


def immutable_snapshot_sink(df: DataFrame, path: str, fetched: str) -> str:
    """Append ``snapshot=<time>_<digest>``; the same content again is a no-op, other content at that time an error."""
    digest = table_digest(df, "").first()["digest"]
    name = f"{fetched}_{digest}"
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [s.getPath().getName().removeprefix("snapshot=") for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    if name in there:
        return name
    if any(s.startswith(f"{fetched}_") for s in there):
        raise ValueError(f"snapshot {fetched} has other content")
    df.write.mode("errorifexists").parquet(f"{path}/snapshot={name}")
    return name


def gzip_history_sink(df: DataFrame, path: str) -> bool:
    if df.isEmpty():
        return False
    df.write.mode("errorifexists").option("header", True).option("compression", "gzip").csv(path)
    return True


def write_if_changed(df: DataFrame, path: str, last_digest: str | None, cutoff: str) -> str | None:
    """Write and return the digest only if content changed; all rows must share one cutoff."""
    if df.select(cutoff).distinct().limit(2).count() > 1:
        raise ValueError("more than one cutoff")
    digest = table_digest(df).first()["digest"]
    if digest == last_digest:
        return None
    df.write.mode("overwrite").parquet(path)
    return digest


def manifest_rows(members: DataFrame, key: str) -> DataFrame:
    """A row for each member with the digest of its payload, and one for the collection."""
    own = members.select(F.col(key).cast("string").alias("source_id"), F.sha2(F.to_json(F.struct(*sorted(members.columns))), 256).alias("sha256"))
    whole = table_digest(members).select(F.lit("collection").alias("source_id"), F.col("digest").alias("sha256"))
    return own.unionByName(whole)


def manifest_verify(spark: SparkSession, manifest: DataFrame, path: str) -> DataFrame:
    """Manifest rows (name, sha256) whose file is missing or different."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("found"))
    return manifest.join(files, "name", "left").filter("found is null or found != sha256")


def publish_gate_scan(spark: SparkSession, path: str, allowed: list[str], secrets: list[str] = ()) -> DataFrame:
    """(path, violation) of outgoing files: name not allowed, too large, table files, key-like text, secrets."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    text = F.decode("content", "UTF-8")
    name = F.element_at(F.split("path", "/"), -1)
    rules = [(~name.isin(*allowed), "not allowed"), (F.col("length") > MOST_BYTES, "too large"), (name.rlike(r"\.parquet$"), "table file"), (text.rlike(r"(?i)(api[_-]?key|secret|token)\s*[:=]\s*\S{12,}"), "key-like text")]
    rules += [(text.contains(s), "secret value") for s in secrets]
    return files.select("path", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(v)) for c, v in rules)))).alias("violation"))
