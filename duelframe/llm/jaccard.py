"""N-gram Jaccard join: documents whose word-shingle sets are similar, as classes and their components.

The document by n-gram incidence is multiplied with itself only where it must be: each document keeps the
n-grams that come first in one global order (rare ones first, by a sketch that covers all documents),
enough of them that similar sets must share some. N-grams that stand in the same documents are one block.
Documents that meet in a block are discarded where their sizes and the block's places in them rule the
similarity out, or a sketch of parities does, which counts no more than what they differ in; the rest are compared exactly.

Equal sets are one class before that, so copies never meet in pairs. Blocks that one component fills are
closed. While the others would still make more than PAIRS_PER_ENTRY pairs an entry, and each round halves them, a
few leading documents of each overfull block are compared with all that meet them, and are done with; what they
link becomes one component. At the end only documents outside a block's largest component are compared with the rest of it,
in parts of at most BLOCK_PAIRS pairs. Pairs that pass the bounds are compared in batches, a few of each class
first, since one link makes one component of two, and components stand for the links found so far. A pair is left
out only where both are in one component already, or where a bound says that they can't be similar.

Defined results: null or blank text has an empty set and links with nothing; a null doc_id is kept, its
component is the smallest doc_id of its component, or null; repeated rows share a class; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.base import bit_set, discard, lean, materialize, small_batches, spread_join
from duelframe.llm.components import connected_components
from duelframe.llm.shingles import shingle_sets

#: Similarity of at least UP / DOWN.
UP, DOWN = 4, 5
WORDS = 5
SKETCH_CHUNK = 1 << 15
#: Bits of the sketch: one bucket for every 1/8 document, within these bounds (so at most 4 MB are broadcast).
SKETCH_BITS = (15, 22)
#: Up to so many documents whose n-grams are needed for comparison are broadcast (about 60 bytes each); beyond, a set
#: of at most 2^PICK_BITS bits (16 MB) picks them.
PICK_ROWS, PICK_BITS = 500_000, (16, 27)
#: Leading documents of a block in one round.
LEADS = 4
#: All pairs that are left are made once there are at most so many for each entry, or a round has not halved them.
PAIRS_PER_ENTRY = 8
#: Pairs of one block that one task makes.
BLOCK_PAIRS = 1 << 20
#: A first batch has about so many pairs for each class, or for twice as many; each later one MORE times as many.
FIRST, MORE = 4, 8
#: Longs of a set's sketch of parities.
PARITY_LONGS = 8
SETS = "doc_id long, n long, sig binary, prefix array<long>, parity array<long>"


def _ceil_bits(n: int, bounds: tuple[int, int]) -> int:
    return min(max(math.ceil(math.log2(max(n, 2))), bounds[0]), bounds[1])


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many first n-grams of a set of size n must meet those of any similar set."""
    return n - (UP * n + DOWN - 1) // DOWN + 1


def frequency_classes(docs: DataFrame, bits: int) -> np.ndarray:
    """For each of 2^bits hash buckets, log2 of how many (document, n-gram) entries fall there."""
    buckets, mask = 1 << bits, np.uint64((1 << bits) - 1)
    names = ["chunk", "salt", "counts"]

    @lean
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(buckets, np.uint32)
        for batch in batches:
            for _, h, _ in shingle_sets(batch.column(0), WORDS):
                total += np.bincount((h & mask).astype(np.int64), minlength=buckets).astype(np.uint32)
        narrow = np.minimum(total, 255).astype(np.uint8).reshape(-1, SKETCH_CHUNK)  # a task's own share; sums go on beyond
        salt = TaskContext.get().partitionId() % 16
        for k, own in enumerate(narrow):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([salt], pa.int32()), pa.array([own.tobytes()], pa.binary())], names)

    def add(kind: type, last: bool):
        """Sums by chunk, one batch after the other: a task holds only the sums of its own chunks."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for k, salt, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                    key = (k, 0 if last else salt)
                    held[key] = held.get(key, 0) + np.frombuffer(own.as_buffer(), kind).astype(np.uint64)
            for (k, salt), total in held.items():
                out = np.log2(total + 1.0).astype(np.uint8) if last else total
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([salt], pa.int32()), pa.array([out.tobytes()], pa.binary())], names)

        return run

    shape = "chunk int, salt int, counts binary"
    some = docs.select("text").mapInArrow(tally, shape).repartition("chunk", "salt").mapInArrow(add(np.uint8, False), shape)
    rows = some.repartition("chunk").mapInArrow(add(np.uint64, True), shape).collect()
    whole = np.zeros(buckets, np.uint8).reshape(-1, SKETCH_CHUNK)
    for r in rows:
        whole[r["chunk"]] = np.frombuffer(bytes(r["counts"]), np.uint8)
    return whole.ravel()


def prefixes(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """For each document: size and signature of its set, and the n-grams that come first in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, mask = shared.value, np.uint64(len(shared.value) - 1)
        for batch in batches:
            names = batch.column(0)
            for first, h, at in shingle_sets(batch.column(1), WORDS):
                n = np.diff(at)
                doc = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((h, rank[(h & mask).astype(np.int64)], doc))
                keep = np.arange(len(h)) - at[:-1][doc] < prefix_length(n)[doc]
                picked = h[order][keep].view(np.int64)
                bounds = np.concatenate([[0], np.cumsum(np.where(n > 0, prefix_length(n), 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([names.slice(first, len(n)).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(signatures(h, at), pa.binary()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(picked)), parities(h, doc, len(n))], ["doc_id", "n", "sig", "prefix", "parity"])

    return docs.select("doc_id", "text").mapInArrow(run, SETS)


def signatures(h: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """A digest of each set, null for an empty one."""
    return [hashlib.blake2b(h[i:j], digest_size=16).digest() if j > i else None for i, j in zip(at[:-1], at[1:], strict=True)]


def parities(h: np.ndarray, doc: np.ndarray, n_docs: int) -> pa.Array:
    """For each set: whether an odd number of its n-grams falls into each of 64 * PARITY_LONGS buckets.

    Bits in which two sketches differ are no more than the n-grams that one of the two sets has alone.
    """
    bits = 64 * PARITY_LONGS
    bucket = (h >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(doc * bits + bucket, minlength=n_docs * bits) & 1
    longs = np.packbits(odd.astype(np.uint8).reshape(-1, bits), axis=1, bitorder="little").view("<i8").ravel()
    return pa.ListArray.from_arrays(pa.array(np.arange(n_docs + 1, dtype=np.int32) * PARITY_LONGS), pa.array(longs))


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, n-grams as bytes) of the classes in ``wanted`` (cid, rep, sig): only their representatives' texts are hashed."""
    rows = wanted.count()
    texts = docs.select("doc_id", "text")
    if rows <= PICK_ROWS:
        picked = F.broadcast(wanted.select("rep").distinct())
        texts, table = texts.join(picked, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi").withColumn("b", F.lit(0).cast("long")), None
    else:
        bits = _ceil_bits(16 * rows, PICK_BITS)
        place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
        texts, table = texts.withColumn("b", place("doc_id")), bit_set(wanted.select(place("rep")), bits)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is not None:
                b = batch.column(2).to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(shared.value[b >> 3] >> (b & 7).astype(np.uint8) & 1 == 1))
            for first, h, at in shingle_sets(batch.column(1), WORDS):
                own = [h[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(own)).cast(pa.int64()), pa.array(signatures(h, at), pa.binary()), pa.array(own, pa.binary())], ["doc", "s", "grams"])

    if table is None:
        wanted = F.broadcast(wanted)
    found = texts.mapInArrow(run, "doc long, s binary, grams binary")
    return found.join(wanted, F.col("rep").eqNullSafe(F.col("doc")) & (F.col("sig") == F.col("s"))).select("cid", "grams").dropDuplicates(["cid"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar, by comparing their whole sets. For each pair one set moves to the other."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                small, large = (p, q) if len(p) <= len(q) else (q, p)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(DOWN * both >= UP * (len(p) + len(q) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    left, right = sets.select(F.col("cid").alias("a"), F.col("grams").alias("x")), sets.select(F.col("cid").alias("b"), F.col("grams").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _may_link() -> Column:
    """By size; by place: nothing is shared before the first block that two sets share, so that what they
    share is at most what either has from there on; and by the parities in which they differ. Every similar pair passes
    in its first common block."""
    a, b = F.col("n_a"), F.col("n_b")
    reach = F.least(a - F.col("pos_a"), b - F.col("pos_b"))
    differ = sum(F.bit_count(F.col("parity_a")[k].bitwiseXOR(F.col("parity_b")[k])) for k in range(PARITY_LONGS))
    return (F.least(a, b) * DOWN >= F.greatest(a, b) * UP) & (reach * (UP + DOWN) >= (a + b) * UP) & (differ * (UP + DOWN) <= (a + b) * (DOWN - UP))


def blocks_of(classes: DataFrame) -> DataFrame:
    """(block, cid, n, pos, alone, parity): for each class the blocks of its first n-grams.

    N-grams of one class alone are left out. pos: place of the block's first n-gram among the class's; alone: how
    many of the prefix no other class has.
    """
    entries = classes.select(F.posexplode("prefix").alias("pos", "gram"), "cid", "n")
    columns = entries.groupBy("gram").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("cid")).alias("block")).filter("m > 1").drop("m")
    found = entries.join(columns, "gram").groupBy("cid", "block").agg(F.first("n").alias("n"), F.count("*").alias("w"), F.min("pos").alias("pos"))
    length = F.col("n") - F.floor((UP * F.col("n") + DOWN - 1) / DOWN) + 1
    return found.withColumn("alone", length - F.sum("w").over(Window.partitionBy("cid"))).drop("w").join(classes.select("cid", "parity"), "cid")


def overlaps(rows: DataFrame, parts: bool) -> DataFrame:
    """Pairs (a, b) of a row marked ``lead`` with any other of its block and of another component that pass the bounds.

    ``parts``: rows of a block are dealt to so many parts, each with a share of the leading rows.
    """
    names = ("cid", "n", "pos", "comp", "lead", "parity")
    a, b = (rows.select("block", *((F.col("parts"),) if parts else ()), *(F.col(c).alias(f"{c}_{x}") for c in names)) for x in "ab")
    a, on = a.filter("lead_a"), ["block"]
    if parts:
        a = a.withColumn("part", F.pmod(F.xxhash64("cid_a"), F.col("parts"))).drop("parts")
        b = b.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
        on = ["block", "part"]
    met = a.join(b, on).filter((F.col("comp_a") != F.col("comp_b")) & (~F.col("lead_b") | (F.col("cid_a") < F.col("cid_b"))) & _may_link())
    return met.select(F.least("cid_a", "cid_b").alias("a"), F.greatest("cid_a", "cid_b").alias("b")).distinct()


def leading(rows: DataFrame, turn: int) -> DataFrame:
    """The classes (lead) to compare next: of each overfull block some with the fewest n-grams of their own."""
    group = F.pmod(F.xxhash64("cid", F.lit(turn)), F.lit(LEADS))
    first = [F.min(F.when(group == k, F.struct((F.col("alone") / F.col("n")).alias("x"), F.xxhash64("cid", F.lit(turn)).alias("h"), F.col("cid").alias("lead")))) for k in range(LEADS)]
    return rows.filter("full").groupBy("block").agg(F.array_compact(F.array(*first)).alias("p")).select(F.explode("p.lead").alias("lead_cid")).distinct()


def batch_of(pairs: DataFrame, most: int, turn: int) -> DataFrame:
    """(a, b, now): about ``most`` pairs of each class are marked, by hash; of classes that have no more, all are.

    A pair's chance is that of the class with fewer pairs, so at most ``most`` times twice the classes are expected.
    """
    degree = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).groupBy("cid").agg(F.count("*").alias("d"))
    for x in "ab":
        pairs = pairs.join(degree.select(F.col("cid").alias(x), F.col("d").alias(f"d_{x}")), x)
    chance = F.least("d_a", "d_b") * F.pmod(F.xxhash64("a", "b", F.lit(turn)), F.lit(1 << 20))
    return pairs.select("a", "b", (chance < F.lit(most) * (1 << 20)).alias("now"))


def linked(docs: DataFrame, classes: DataFrame, found: DataFrame, component: DataFrame) -> DataFrame:
    """(node, component) of all that is linked in ``component`` or by the pairs ``found``.

    In a batch some pairs of each class are compared; what has come into one component needs no more. Batches grow
    until none is left; one that would leave less than half is made whole.
    """
    # only classes in pairs have their whole sets made
    wanted = materialize(classes.select("cid", "rep", "sig").join(found.select(F.col("a").alias("cid")).union(found.select("b")).distinct(), "cid", "left_semi"), "wanted")
    sets = materialize(whole_sets(docs, wanted), "grams")
    most, held = FIRST, [wanted, sets]
    for turn in count():
        judged = materialize(batch_of(found, most, turn), "batch")
        held.append(judged)
        total, now = judged.agg(F.count("*"), F.count_if("now")).first()
        whole = 2 * now >= total
        known = component.select(F.col("node").alias("a"), F.col("component").alias("b"))
        component = connected_components(known.unionByName(verified(judged.filter(F.lit(whole) | F.col("now")).select("a", "b"), sets)))
        if whole:
            break
        found = judged.filter("not now").select("a", "b")
        for x in "ab":
            found = found.join(component.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}")), x, "left")
        found = materialize(found.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b"), "pairs")
        held.append(found)
        if found.isEmpty():
            break
        most *= MORE
    discard(*held)
    return component


def similar_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, n, sig), classes (cid, sig, rep, n), and (node, component) of linked classes."""
    small_batches(docs.sparkSession)
    table = materialize(prefixes(docs, frequency_classes(docs, _ceil_bits(8 * docs.count(), SKETCH_BITS))), "sets")
    grouped = table.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("parity").alias("parity"))
    classes = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    live = materialize(blocks_of(classes), "blocks")
    component = live.sparkSession.createDataFrame([], "node long, component long")
    was = math.inf
    for turn in count():
        placed = live.join(component, live.cid == component.node, "left").drop("node").withColumn("comp", F.coalesce("component", "cid")).drop("component")
        tally = placed.groupBy("block", "comp").agg(F.count("*").alias("c")).groupBy("block").agg(F.count("*").alias("comps"), F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"), F.max(F.struct("c", "comp")).alias("top")).filter("comps > 1")
        tally = tally.select(F.col("block").alias("block_"), "s", ((F.col("s") * F.col("s") - F.col("q")) / 2).alias("pairs"), F.col("top.comp").alias("main"), F.col("top.c").alias("most"))
        rows = placed.join(tally, F.col("block") == F.col("block_")).drop("block_")
        rows = materialize(rows.select("block", "cid", "n", "pos", "alone", "parity", "comp", (F.col("comp") != F.col("main")).alias("lead"), F.ceil((F.col("s") - F.col("most")) * F.col("s") / BLOCK_PAIRS).alias("parts"), (F.col("pairs") > PAIRS_PER_ENTRY * F.col("s")).alias("full"), (F.col("pairs") / F.col("s")).alias("share")), "open")
        size, pairs = rows.agg(F.count("*"), F.sum("share")).first()
        if not size:
            break
        last, was = pairs <= PAIRS_PER_ENTRY * size or 2 * pairs > was, pairs
        rows = rows.drop("share")
        if last:
            found = overlaps(rows, parts=True)
        else:
            chosen = materialize(leading(rows, turn), "leads")
            rows = rows.join(chosen, F.col("cid") == F.col("lead_cid"), "left").withColumn("lead", F.col("lead_cid").isNotNull()).drop("lead_cid")
            found = overlaps(rows, parts=False)
        found = materialize(found, "pairs")
        if not found.isEmpty():
            component = linked(docs, classes, found, component)
        discard(found)
        if last:
            break
        live = rows.filter("not lead").select(live.columns)
    return members_of(table), classes.select("cid", "sig", "rep", "n"), component


def members_of(table: DataFrame) -> DataFrame:
    return table.select("doc_id", "n", "sig")


def components_of(classes: DataFrame, component: DataFrame) -> DataFrame:
    """(sig, rep, least, kept): least doc_id of each class's component, and the signature of the class that has it."""
    linked = component.join(classes, F.col("node") == F.col("cid")).select("node", "component", F.struct(F.col("rep").isNull().alias("none"), "rep", "sig").alias("c"))
    least = materialize(linked.groupBy("component").agg(F.min("c").alias("c")), "least")
    found = linked.select("node", "component").join(least, "component").select("node", F.col("c.rep").alias("least_"), F.col("c.sig").alias("kept_"))
    return classes.join(found, F.col("cid") == F.col("node"), "left").select("sig", "rep", F.when(F.col("node").isNull(), F.col("rep")).otherwise(F.col("least_")).alias("least"), F.coalesce("kept_", "sig").alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without all but one of each component: the one with the smallest doc_id stays.

    Documents without words stay, each. Rows that share a doc_id, or have none, are told apart by their sets: of
    those with equal sets one stays, if it is their component's.
    """
    members, classes, component = similar_classes(docs)
    chosen = components_of(classes, component).filter("kept = sig").select("sig", "rep", F.lit(True).alias("chosen"))
    judged = spread_join(members, chosen, "sig", "left").filter("n = 0 or (chosen and doc_id <=> rep)").select("doc_id", "sig")
    unclear = materialize(members.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1 or doc_id is null").select(F.col("doc_id").alias("unclear_")), "unclear")
    stay = judged.select(F.col("doc_id").alias("stay_"), F.col("sig").alias("stay_sig_"))
    # rows in one column, so that no name of theirs meets the joins' own
    own = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row_"), F.col("doc_id").alias("id_"), F.col("text").alias("text_"))
    if unclear.isEmpty():
        return rows.join(stay, F.col("id_") == F.col("stay_"), "left_semi").select("row_.*")
    is_unclear = F.col("id_").eqNullSafe(F.col("unclear_"))
    plain = rows.join(stay, F.col("id_") == F.col("stay_"), "left_semi").join(unclear, is_unclear, "left_anti")

    @F.arrow_udf("binary")
    def signature(texts: pa.Array) -> pa.Array:
        return pa.array([s for _, h, at in shingle_sets(texts, WORDS) for s in signatures(h, at)], pa.binary())

    odd = materialize(rows.join(unclear, is_unclear, "left_semi").select("row_", "id_", signature("text_").alias("sig_")), "odd")
    same = F.col("id_").eqNullSafe(F.col("stay_")) & F.col("sig_").eqNullSafe(F.col("stay_sig_"))
    one = odd.filter("sig_ is not null").join(stay, same, "left_semi").dropDuplicates(["id_", "sig_"])
    return plain.select("row_.*").unionByName(one.select("row_.*")).unionByName(odd.filter("sig_ is null").select("row_.*"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every document."""
    members, classes, component = similar_classes(docs)
    out = spread_join(members, components_of(classes, component).select("sig", "least"), "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
