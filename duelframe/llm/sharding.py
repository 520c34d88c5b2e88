"""Shards by balanced label propagation, with DataFrame operations only.

Equal texts are one node. Nodes are linked by the long lines that their texts share. In each round a node
wants the shard that most of its lines' documents have; moves are admitted up to each shard's quota, in
the order of a hash. At the end documents in order of (shard, node, doc_id) are cut into equal counts, so
that shards hold counts at most one apart (law ``rows``) and a node is cut only at a shard's edge.

Defined results: a null text has size 1, CRC-32 0, and no links; null doc_ids sort first; repeated rows
each get a slot of their own; with fewer documents than shards some shards stay empty; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.base import dealt_join, materialize, ranked, spread_join

SHARDS, ROUNDS = 8, 4
#: A line links documents if it has so many characters.
LINE_CHARS = 40
#: Shards may exceed their share by this much while labels move.
SLACK = 0.05
#: Movers to a shard are admitted by this many hash steps.
STEPS = 1000


def incidence(nodes: DataFrame) -> DataFrame:
    """(node, line, w): lines that two nodes or more share; w documents have the node's text."""
    lines = nodes.select("node", "w", F.explode("lines").alias("line"))
    shared = materialize(lines.groupBy("line").agg(F.count("*").alias("n")).filter("n > 1").select("line"), "shared")
    return spread_join(lines, shared, "line")


def propagate(nodes: DataFrame, links: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(node, w, shard) after the given rounds; shards start by a hash of the node."""
    labels = materialize(nodes.select("node", "w", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard")), "labels")
    total = nodes.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    quota = (1 + SLACK) * total / shards
    for turn in range(rounds):
        at = dealt_join(links, labels.select("node", "shard"), "node")
        tally = at.groupBy("line", "shard").agg(F.sum("w").alias("n"))
        # written, and copied to several joins: a line that very many nodes have is no hot key
        top = materialize(tally.groupBy("line").agg(F.max(F.struct("n", (-F.col("shard")).alias("s"))).alias("t"), F.sum("n").alias("of")), "lines")
        votes = spread_join(links.select("node", "line"), top.select("line", (-F.col("t.s")).alias("want"), (F.col("t.n") / F.col("of")).alias("share")), "line")
        wish = votes.groupBy("node", "want").agg(F.sum("share").alias("share")).groupBy("node").agg(F.max(F.struct("share", (-F.col("want")).alias("s"))).alias("t")).select("node", (-F.col("t.s")).alias("want"))
        wished = dealt_join(labels, wish, "node", "left").withColumn("moves", F.coalesce(F.col("want") != F.col("shard"), F.lit(False))).withColumn("step", F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(STEPS)))
        # at most shards x STEPS rows each: bounded, so they may be broadcast
        load = labels.groupBy("shard").agg(F.sum("w").alias("load"))
        queue = wished.filter("moves").groupBy("want", "step").agg(F.sum("w").alias("n"))
        upto = queue.withColumn("upto", F.sum("n").over(Window.partitionBy("want").orderBy("step")))
        room = upto.join(load, upto.want == load.shard, "left").filter(F.col("upto") <= quota - F.coalesce("load", F.lit(0))).select(F.col("want").alias("to"), F.col("step").alias("at"))
        moved = wished.join(F.broadcast(room), wished.moves & (wished.want == F.col("to")) & (wished.step == F.col("at")), "left")
        labels = materialize(moved.select("node", "w", F.coalesce("to", "shard").alias("shard")), "labels")
    return labels


def edge_cut(links: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: documents of shared lines in all, and those outside their line's largest shard (cut)."""
    tally = dealt_join(links, labels.select("node", "shard"), "node").groupBy("line", "shard").agg(F.sum("w").alias("n"))
    return tally.groupBy("line").agg(F.sum("n").alias("n"), F.max("n").alias("most")).agg(F.sum("n").alias("total"), F.sum(F.col("n") - F.col("most")).alias("cut"))


def nodes_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, size, text_crc32, a, b) and nodes (a, b, node, w, lines) of their texts."""
    text = F.col("text")
    lines = F.array_distinct(F.transform(F.filter(F.split(text, "\n"), lambda x: F.length(x) >= LINE_CHARS), lambda x: F.xxhash64(x)))
    measured = docs.select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.coalesce(F.xxhash64(text, F.lit(1)), F.lit(0)).alias("a"), F.when(text.isNull(), -1).otherwise(F.xxhash64(F.reverse(text))).alias("b"), F.coalesce(lines, F.array().cast("array<bigint>")).alias("lines"))
    held = materialize(measured, "measured")
    nodes = held.groupBy("a", "b").agg(F.count("*").alias("w"), F.first("lines").alias("lines")).withColumn("node", F.monotonically_increasing_id())
    return held.drop("lines"), materialize(nodes, "nodes")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    measured, nodes = nodes_of(docs)
    links = materialize(incidence(nodes), "links")
    labels = propagate(nodes, links, shards)
    labelled = dealt_join(nodes.select("a", "b", "node"), labels.select("node", "shard"), "node").select(F.struct("a", "b").alias("text_key"), "node", "shard")
    placed = spread_join(measured.withColumn("text_key", F.struct("a", "b")), labelled, "text_key")
    order, total = ranked(placed.select("doc_id", "size", "text_crc32", "node", "shard"), ["shard", "node", "doc_id"], "sharded")
    n = F.lit(max(total, 1))
    part = F.floor((F.lit(shards) * (F.col("rank_") + 1) + n - 1) / n) - 1
    return order.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), part.cast("int").alias("shard"), F.col("rank_")).withColumn("slot", F.col("rank_") - F.floor(F.col("shard") * n / shards)).drop("rank_").withColumn("grown_shard", F.lit(None).cast("int"))
