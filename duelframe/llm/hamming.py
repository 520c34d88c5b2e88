"""Exact top-k search in binary codes by incremental multi-index hashing.

A vector's code holds the signs of its components. Codes are cut into segments, about as wide as the logarithm
of how many there are; round r looks up, for each segment, all values with r bits flipped of the query's. After it
every code closer than segments * (r + 1) has been met, so a query ends once its k-th verified distance is below
that. The last round would meet every value of a segment, so every query ends. Equal codes are one entry of the
index, and equal queries one query.

Defined results: a null or empty vector has no code and no row; a row with a null id is no query and nobody's
neighbour; ties go to the smaller id; a row is never its own neighbour; a row that repeats an id counts once for
each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.llm.base import discard, materialize

BITS = 64
#: Segments are at least so many: at most 22 bits wide, so that a radius has at most 705,432 masks (to be broadcast).
LEAST_SEGMENTS = 3


def sign_code(vector: str) -> Column:
    """Bit i is set where component i is positive. Vectors of more than 64 components are an error."""
    bits = F.transform(F.col(vector), lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))).otherwise(F.lit(0).cast("long")))
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(vector) > BITS, F.raise_error(F.lit(f"codes have {BITS} bits, a vector has more components")).cast("long")).when(F.size(vector) > 0, code)


def widths(codes: int, segments: int | None = None) -> list[int]:
    """Bits of each segment, about the logarithm of the codes."""
    n = segments or min(max(round(BITS / math.log2(max(codes, 4))), LEAST_SEGMENTS), BITS)
    return [BITS // n + (k < BITS % n) for k in range(n)]


def _segments(code: Column, bits: list[int]) -> Column:
    """(value, values): each segment's value, and how many it can have."""
    return F.array(*(F.struct(F.shiftrightunsigned(code, sum(bits[:k])).bitwiseAND(F.lit((1 << w) - 1)).alias("value"), F.lit(1 << w).cast("long").alias("values")) for k, w in enumerate(bits)))


def _masks(before: DataFrame | None, spark: SparkSession, width: int) -> DataFrame:
    """(mask, high): values with one bit more than those before, each once; high: the number of its highest bit."""
    if before is None:
        return spark.range(1).select(F.lit(0).cast("long").alias("mask"), F.lit(-1).alias("high"))
    more = before.filter(F.col("high") < width - 1).select("mask", F.explode(F.sequence(F.col("high") + 1, F.lit(width - 1))).alias("high"))
    return more.select(F.col("mask").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("high"))).alias("mask"), "high")


def top_k(vectors: DataFrame, k: int = 10, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", segments: int | None = None) -> DataFrame:
    """For each row whose id is divisible by ``every``: its k nearest rows by (Hamming distance, id)."""
    spark = vectors.sparkSession
    coded = materialize(vectors.select(F.col(id_col).cast("long").alias("id"), sign_code(vector_col).alias("code")).filter("code is not null and id is not null"), "codes")
    # per code: how many rows, and its k + 1 smallest ids, kept small in each task before they meet
    part = Window.partitionBy("code", "salt").orderBy("id")
    few = coded.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64))).withColumn("r", F.row_number().over(part)).filter(F.col("r") <= k + 1)
    lists = few.groupBy("code").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"))
    counts = coded.groupBy("code").agg(F.count("*").alias("rows"))
    entries = materialize(counts.join(lists, "code"), "codes")
    bits = widths(entries.count(), segments)
    index = materialize(entries.select(F.posexplode(_segments(F.col("code"), bits)).alias("segment", "s"), "code", "rows").select("segment", "s.value", "code", "rows"), "index")
    asked = materialize(coded.filter(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.col("code").alias("query")), "asked")
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("code"))).alias("distance")
    # the radius is a column of the written table: a join key like any other
    active, masks, ended, found = materialize(asked.select("query", F.lit(0).alias("radius")).distinct(), "active"), None, [], None
    for r in range(max(bits) + 1):
        whole = r == max(bits)
        masks = materialize(_masks(masks, spark, max(bits)).withColumn("radius", F.lit(r)), "masks")
        own = active.select("query", F.posexplode(_segments(F.col("query"), bits)).alias("segment", "s"), "radius")
        probes = own.join(F.broadcast(masks), "radius").filter(F.col("mask") < F.col("s.values")).select("query", "segment", F.col("s.value").bitwiseXOR(F.col("mask")).alias("value"))
        met = probes.join(index, ["segment", "value"]).select("query", "code", "rows", distance)
        met = (met if found is None else met.unionByName(found)).distinct()
        level = met.groupBy("query", "distance").agg(F.sum("rows").alias("n"))
        upto = Window.partitionBy("query").orderBy("distance")
        kth = level.withColumn("upto", F.sum("n").over(upto)).filter(F.col("upto") > k).groupBy("query").agg(F.min("distance").alias("kth"))
        met = materialize(met.join(kth, "query", "left").filter("kth is null or distance <= kth"), f"met-{r}")
        ready = F.lit(True) if whole else F.coalesce(F.col("kth") < len(bits) * (r + 1), F.lit(False))
        ended.append(met.filter(ready).select("query", "code", "distance"))
        found = met.filter(~ready).select("query", "code", "rows", "distance")
        if whole:
            break
        left = materialize(active.join(ended[-1].select("query").distinct(), "query", "left_anti").select("query", F.lit(r + 1).alias("radius")), "active")
        discard(active)
        active = left
        if active.isEmpty():
            break
    done = reduce(DataFrame.unionByName, ended)
    nearest = done.join(entries.select("code", "ids"), "code").select("query", "distance", F.explode("ids").alias("neighbour_id"))
    best = Window.partitionBy("query").orderBy("distance", "neighbour_id")
    nearest = nearest.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).drop("r")
    own = Window.partitionBy("query_id").orderBy("distance", "neighbour_id")
    out = asked.join(nearest, "query").filter("query_id != neighbour_id").withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "neighbour_id", "distance")


#: The same by brute force: DuckDB over the table embeddings.
ORACLE_SQL = """
WITH coded AS (SELECT vec_id AS id, list_sum(list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN (1::HUGEINT << (i - 1)::INT) ELSE 0::HUGEINT END))::HUGEINT AS code FROM embeddings WHERE len(embedding) > 0),
pairs AS (SELECT q.id AS query_id, c.id AS neighbour_id, bit_count(xor(q.code::UBIGINT, c.code::UBIGINT))::INT AS distance FROM coded q JOIN coded c ON q.id % 50 = 0 AND q.id != c.id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INT) AS rank, neighbour_id, distance FROM pairs
QUALIFY rank <= 10
"""
