"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint's 64 bits are cut into two segments, fewer than the bits that may differ plus one: of two
fingerprints that link (at most two bits differ) one segment is equal or differs in one bit. The index has, for each
segment, the segment itself and its 32 variants with one bit deleted. Segments that differ in exactly bit i have
the same variant i, one with the bit set and one without. An equality join of variants finds these pairs, and the
whole fingerprints verify them. Equal fingerprints are one class before that.

A variant that more than CROWD classes have makes no pairs. Its classes are linked in another exact way: two
classes at most two bits apart have a code in common among those at most one bit from each, and all classes around
one code are at most two bits apart, so each is linked with the smallest of them.

Defined results: null, empty or blank text has no words and fingerprint zero, which links like any other; a null
doc_id is kept, its component is the smallest doc_id of its component, or null; repeated rows share a class; an
empty table gives an empty result; other columns are not read. Whole texts of any length are hashed, in steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelframe.llm.base import lean, materialize, slices, utf8_buffers
from duelframe.llm.components import connected_components
from duelframe.llm.shingles import LOWER, SPACE

WORDS, SEED, DISTANCE = 3, 42, 2
BITS, SEGMENT = 64, 32
#: Classes of one variant that are joined in pairs.
CROWD = 64
#: Shingles that one step counts bits of; rows of a fingerprint are dealt to so many joins with its class.
STEP, SALTS = 1 << 16, 16
FOUND = "doc_id long, code long"


def joined_words(raw: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, with a space after each: the bytes, where words begin and
    end in them, and each word's text. at: the n + 1 offsets of the texts, where no word goes on."""
    if not len(raw):
        return b"", *[np.zeros(0, np.int64)] * 3
    space = SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    last = ~space
    last[:-1] &= space[1:] | edge[1:-1]
    # each word's bytes, and a space after its last
    times = np.where(space, 0, 1 + last)
    out = np.repeat(LOWER[raw], times)
    ends = np.cumsum(times)[last] - 1
    out[ends] = 32
    return out.tobytes(), np.concatenate([[0], ends[:-1] + 1]), ends, np.searchsorted(at, np.flatnonzero(last), "right") - 1


def fingerprints(texts: pa.Array, words: int = WORDS) -> np.ndarray:
    """The fingerprint of each text: a bit is set if more than half of its shingles' hashes have it."""
    from xxhash import xxh64_intdigest

    raw, offsets = utf8_buffers(texts)
    codes = np.zeros(len(texts), np.uint64)
    for first, last in slices(offsets):
        at = offsets[first : last + 1]
        own, at = raw[at[0] : at[-1]], at - at[0]
        data, begin, end, owner = joined_words(own, at)
        count = np.bincount(owner, minlength=last - first)
        bound = np.concatenate([[0], np.cumsum(count)])
        hashes = np.maximum(count - words + 1, np.minimum(count, 1))
        doc = np.repeat(np.arange(last - first), hashes)
        # shingle k of a document runs from word k to k + words - 1, or to its last word
        word = bound[doc] + np.arange(len(doc)) - (np.cumsum(hashes) - hashes)[doc]
        a, b = begin[word], end[np.minimum(word + words, bound[doc + 1]) - 1]
        votes = np.zeros((last - first, BITS), np.int64)
        view = memoryview(data)
        for k in range(0, len(doc), STEP):
            h = np.array([xxh64_intdigest(view[i:j], SEED) for i, j in zip(a[k : k + STEP].tolist(), b[k : k + STEP].tolist(), strict=True)], "<u8")
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            part = doc[k : k + STEP]
            edges = np.flatnonzero(np.diff(part, prepend=-1))
            votes[part[edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int64)
        set_bits = (2 * votes > hashes[:, None]).astype(np.uint8)
        codes[first:last] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return codes


def coded(docs: DataFrame) -> DataFrame:
    """(doc_id, code) of every document; the code's 64 bits as a signed number."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fingerprints(batch.column(1)).view(np.int64))], ["doc_id", "code"])

    return docs.select("doc_id", "text").mapInArrow(run, FOUND)


def variants(codes: DataFrame) -> DataFrame:
    """(code, key, bit): for each segment itself (place 32) and its variants without the bit at each place; bit: what it was."""
    masks = [(s, i, (((1 << SEGMENT) - 1) & ~(1 << i if i < SEGMENT else 0))) for s in range(BITS // SEGMENT) for i in range(SEGMENT + 1)]

    def entry(s: int, i: int, mask: int) -> Column:
        part = F.shiftrightunsigned("code", SEGMENT * s)
        key = part.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit((s << 6 | i) << SEGMENT))
        bit = F.shiftrightunsigned(part, i).bitwiseAND(F.lit(1)) if i < SEGMENT else F.lit(2).cast("long")
        return F.struct(key.alias("key"), bit.cast("byte").alias("bit"))

    return codes.select("code", F.inline(F.array(*(entry(*m) for m in masks))))


def around(codes: DataFrame) -> DataFrame:
    """(code, key): the code itself and those one bit from it."""
    masks = [0, *(1 << k if k < BITS - 1 else -(1 << k) for k in range(BITS))]
    return codes.select("code", F.explode(F.array(*(F.col("code").bitwiseXOR(F.lit(m).cast("long")) for m in masks))).alias("key"))


def linked(codes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): pairs of different codes, at most two bits apart, that connect all codes that are linked."""
    # one shuffle of the variants: each gets the number of its key's, and those of one class alone go
    counted = variants(codes).withColumn("m", F.count("*").over(Window.partitionBy("key")))
    entries = materialize(counted.filter("m > 1"), "entries")
    few = entries.filter(F.col("m") <= crowd)
    left, right = (few.select("key", F.col("code").alias(x), F.col("bit").alias(f"bit_{x}")) for x in "ab")
    order = (F.col("bit_a") < F.col("bit_b")) | ((F.col("bit_a") == 2) & (F.col("a") < F.col("b")))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    pairs = left.join(right, (left.key == right.key) & order & near).select("a", "b")
    many = entries.filter(F.col("m") > crowd).select("code").distinct()
    stars = around(many)
    centre = stars.groupBy("key").agg(F.min("code").alias("a"), F.count("*").alias("m")).filter("m > 1").drop("m")
    centre = materialize(centre, "centres")
    more = stars.join(centre, "key").filter("a != code").select("a", F.col("code").alias("b"))
    return pairs.unionByName(more).distinct()


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint and component_id (smallest doc_id reachable by links) of every document."""
    table = materialize(coded(docs), "coded")
    classes = materialize(table.groupBy("code").agg(F.min("doc_id").alias("least")), "classes")
    component = connected_components(linked(classes.select("code"), crowd))
    placed = classes.join(component, F.col("code") == F.col("node"), "left").select("code", "least", F.coalesce("component", "code").alias("component"))
    placed = materialize(placed, "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(placed.select("code", "component").join(least, "component").select("code", "component_id"), "named")
    # one fingerprint may be that of most rows: they are dealt to SALTS keys, each with a copy of the class
    each = named.select(F.col("code").alias("code_"), "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_"))
    dealt = table.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    out = dealt.join(each, (F.col("code") == F.col("code_")) & (F.col("salt") == F.col("salt_")))
    return out.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
