"""Personal data: patterns, and terms that give away what the patterns protect.

Base spans (email, ip, card, phone) come from patterns. A protected entity is such a value. For each term
anywhere in an entity's documents, co-occurrence over all documents estimates how surely the term points to the
entity: documents with both by documents with the term, shrunk by k / (k + 1) where k different texts have both, as
few texts tell little and copies of one tell nothing more. From it comes the point-wise mutual information of term
and entity; where that reaches the share GENERALISE of the entity's own information content, the term discloses
the entity. Each of its occurrences outside base spans, in any document, gets a span: ``remove`` where the shrunk
estimate reaches REMOVE (so only terms that two texts or more have beside the entity), else ``generalise``.
Entities are judged however rare they are.

Defined results: null text is an empty text (no spans; null stays null when sanitised); repeated rows
count each as a document; equal texts have equal spans; an empty table gives an empty result; other columns
stay as they are.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelframe.llm.base import bit_set, dealt_join, lean, materialize, small_batches, spread_join

KINDS = ("email", "ip", "card", "phone")
#: Each pattern takes a whole run of what a match may begin with, so that no text is scanned twice; where
#: group 1 is missing the run begins no match.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?"),
    "ip": re.compile(r"[0-9]++((?:\.[0-9]+){3})?"),
    "card": re.compile(r"[0-9]((?:[ -]?[0-9])++)"),
    "phone": re.compile(r"\+([0-9][ ().0-9-]+[0-9])"),
}
DIGIT, PLUS = re.compile("[0-9]"), re.compile(r"\+[0-9]")
WORD = re.compile(r"[^\W\d_]+")
#: Terms that are broadcast as they are (a few MB); more become a set of at most 2^27 bits (16 MB).
EXACT_TERMS, TERM_BITS = 100_000, (16, 27)
#: Words whose term a worker remembers.
KNOWN_WORDS = 200_000
#: Share of an entity's information content at which a term discloses it, and the shrunk probability of the entity
#: given the term at which the term is removed.
GENERALISE, REMOVE = 0.85, 0.6
FOUND = "doc_id long, key string, n array<long>, spans array<string>, entities array<string>, terms array<string>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all base matches, by start, then by kind as listed."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in PATTERNS["email"].finditer(text) if m[1]]
    if DIGIT.search(text):
        for m in PATTERNS["ip"].finditer(text):
            if m[1] and all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split(".")):
                found.append((m.start(), m.end(), "ip"))
        for m in PATTERNS["card"].finditer(text):
            if len(m[0]) >= 14 and 14 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
        if PLUS.search(text):
            for m in PATTERNS["phone"].finditer(text):
                if 10 <= sum(c.isdigit() for c in m[1]) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def outside(text: str, spans: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, term) of each word that no base span touches."""
    at, reach, k = 0, 0, 0
    for m in WORD.finditer(text):
        at, end = m.span()
        while k < len(spans) and spans[k][0] < end:
            reach = max(reach, spans[k][1])
            k += 1
        if reach <= at:
            yield at, end, m[0].lower()


def _letter(c: str) -> bool:
    return c.isalnum() and not c.isdecimal()


def blanked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with a space for each base span, and for what is left of words that a span touches."""
    out, at = [], 0
    for start, end, _ in spans:
        while start > at and _letter(text[start]) and _letter(text[start - 1]):
            start -= 1
        while end < len(text) and _letter(text[end - 1]) and _letter(text[end]):
            end += 1
        if end > at:
            out.append(text[at : max(start, at)])
            at = end
    return " ".join([*out, text[at:]])


def words_of(text: str) -> set[str]:
    """The terms of a text, each once."""
    return {w.lower() for w in set(WORD.findall(text))}


def digest(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=16).hexdigest()


def find(docs: DataFrame) -> DataFrame:
    """Base spans and the digest (key) of every whole text; entities and terms of those with base spans."""
    small_batches(docs.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1):
                text = t.as_py() or ""
                spans = base_spans(text)
                count = [sum(k == kind for _, _, k in spans) for kind in KINDS]
                entities = sorted({f"{k}:{text[s:e].lower()}" for s, e, k in spans})
                terms = sorted(words_of(blanked(text, spans))) if spans else []
                out.append((digest(text), count, [f"{k}:{s}:{e}" for s, e, k in spans], entities, terms))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = (pa.string(), pa.list_(pa.int64()), *[pa.list_(pa.string())] * 3)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], [x.split()[0] for x in FOUND.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, FOUND)


def terms_of_all(docs: DataFrame, may: Candidates) -> DataFrame:
    """(term, with_term): in how many documents each term that may be wanted stands, anywhere in them."""
    small_batches(docs.sparkSession)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter[str] = Counter()
            for t in batch.column(0):
                count.update(may.hits(t.as_py() or ""))
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["term", "n"])

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("with_term"))


def entities_of(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, entity) and (entity, with_entity): entities that stand in the same texts count as one, the first by name."""
    held = texts.select("key", "copies", F.explode("entities").alias("entity"))
    same = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"), F.sum(F.xxhash64(F.lit(1), "key").cast("decimal(20,0)")).alias("y")]
    each = held.groupBy("entity").agg(F.sum("copies").alias("with_entity"), *same)
    entities = materialize(each.groupBy("with_entity", "n", "x", "y").agg(F.min("entity").alias("entity")).select("entity", "with_entity"), "entities")
    return spread_join(held.select("key", "entity"), entities, "entity"), entities


def disclosing(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(term, action) where the term's information about some entity reaches the threshold.

    Counts are of documents, over all of them: with the entity, with the term, with both. Equal texts are
    counted once with their number. As both is at most either count, a term in more than
    total^(1 - GENERALISE) * with_entity^GENERALISE documents can't reach the threshold, and is left out early.
    """
    total = float(max(docs.count(), 1))
    texts = found.filter(F.size("entities") > 0).groupBy("key").agg(F.count("*").alias("copies"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    texts = materialize(texts, "texts")
    held, entities = entities_of(texts)
    most = entities.agg(F.max("with_entity")).first()[0]
    if most is None:
        return entities.select(F.col("entity").alias("term"), F.lit("").alias("action"))
    bound = lambda n: total ** (1 - GENERALISE) * n**GENERALISE * (1 + 1e-9)
    wanted = materialize(texts.select(F.explode("terms").alias("term")).distinct(), "wanted")
    terms = materialize(terms_of_all(docs, Candidates(wanted)).filter(F.col("with_term") <= bound(most)), "counted")
    rare = spread_join(texts.select("key", "copies", F.explode("terms").alias("term")), terms, "term")
    reach = F.lit(bound(1.0)) * F.pow(F.col("with_entity"), F.lit(GENERALISE))
    met = dealt_join(rare, held, "key").filter(F.col("with_term") <= reach)
    both = met.groupBy("entity", "term").agg(F.sum("copies").alias("both"), F.count("*").alias("k"), F.first("with_term").alias("with_term"), F.first("with_entity").alias("with_entity"))
    estimate = F.col("both") / F.col("with_term") * (F.col("k") / (F.col("k") + 1))
    content = F.greatest(F.log(F.lit(total) / F.col("with_entity")), F.lit(1e-9))
    share = F.log(estimate * total / F.col("with_entity")) / content
    action = F.when(share >= GENERALISE, F.when(estimate >= REMOVE, "remove").otherwise("generalise"))
    # of several entities' actions the stronger: remove comes last by name
    return materialize(both.select("term", action.alias("action")).filter("action is not null").groupBy("term").agg(F.max("action").alias("action")), "terms")


class Candidates:
    """Terms to look for, small enough for every task: up to EXACT_TERMS as they are, beyond as bits of their CRC,
    which may also say yes to others."""

    def __init__(self, terms: DataFrame):
        n = terms.count()
        self.empty, self.known = not n, None
        self.exact = n <= EXACT_TERMS
        if self.exact:
            held = [r["term"] for r in terms.select("term").collect()]
        else:
            bits = min(max(math.ceil(math.log2(1024 * n)), TERM_BITS[0]), TERM_BITS[1])
            held = bit_set(terms.select(F.crc32(F.col("term").cast("binary")) % (1 << bits)), bits).tobytes()
        self.shared = terms.sparkSession.sparkContext.broadcast(held)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": None}

    def hits(self, text: str) -> set[str]:
        """The terms among the text's words. What each word is, is remembered for up to KNOWN_WORDS of them."""
        if self.known is None or len(self.known) > KNOWN_WORDS:
            self.known, self.terms = {}, frozenset(self.shared.value) if self.exact else self.shared.value
        known, out = self.known, set()
        for w in set(WORD.findall(text)):
            term = known.get(w, w)
            if term is w:
                low = w.lower()
                term = known[w] = low if self._has(low) else None
            if term is not None:
                out.add(term)
        return out

    def _has(self, term: str) -> bool:
        if self.exact:
            return term in self.terms
        b = zlib.crc32(term.encode()) & (8 * len(self.terms) - 1)
        return bool(self.terms[b >> 3] >> (b & 7) & 1)


def term_spans(docs: DataFrame, terms: DataFrame, may: Candidates) -> DataFrame:
    """(key, extra): for each distinct text, the spans of all disclosing terms in it."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in set(batch.column(0).to_pylist()) - {None}:
                if own := may.hits(t):
                    key = digest(t)
                    rows += [(key, w, a, b) for a, b, w in outside(t, base_spans(t)) if w in own]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["key", "term", "start", "stop"])

    shape = "key string, term string, start long, stop long"
    if may.empty:
        return docs.sparkSession.createDataFrame([], "key string, extra array<string>")
    hit = spread_join(docs.select("text").mapInArrow(run, shape).dropDuplicates(["key", "start", "stop"]), terms, "term")
    return hit.groupBy("key").agg(F.collect_list(F.concat_ws(":", "action", "start", "stop")).alias("extra"))


def _in_order(spans: F.Column) -> F.Column:
    """Spans by start, then by kind as listed, the method's own last."""
    place = {k: i for i, k in enumerate((*KINDS, "generalise", "remove"))}
    kind = F.create_map(*(F.lit(x) for pair in place.items() for x in pair))
    keyed = F.transform(spans, lambda s: F.struct(F.split(s, ":")[1].cast("long").alias("a"), kind[F.split(s, ":")[0]].alias("b"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x.s)


def spans_of(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, spans, all_spans) of every document: base spans, and those with the terms' added."""
    found = materialize(find(docs), "found")
    terms = disclosing(docs, found)
    extra = materialize(term_spans(docs, terms, Candidates(terms)), "extra")
    out = dealt_join(found.select("doc_id", "key", "n", "spans"), extra, "key", "left").select("doc_id", "key", "n", "spans", "extra")
    return out.withColumn("all_spans", F.when(F.col("extra").isNull(), F.col("spans")).otherwise(_in_order(F.concat("spans", F.coalesce("extra", F.array().cast("array<string>"))))))


def report(docs: DataFrame) -> DataFrame:
    """Counts, the digest of base spans and all spans of every document."""
    out = spans_of(docs)
    counts = [F.col("n")[k].alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(F.array_join("spans", ","), 256).alias("base_sha256"), F.array_join("all_spans", ",").alias("spans"))


def replaced(text: str, extra: list[str]) -> str:
    """The text with base spans and disclosing terms replaced; spans that overlap merge, the first's kind counts."""
    spans = base_spans(text) + [(int(a), int(b), kind) for kind, a, b in (x.split(":") for x in extra)]
    out, at = [], 0
    for start, end, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out.append(text[at:start])
            out.append("" if kind == "remove" else "[TERM]" if kind == "generalise" else f"[{kind.upper()}]")
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """All documents with their own columns, personal data in ``text`` replaced."""
    found = materialize(find(docs), "found")
    terms = disclosing(docs, found)
    may = Candidates(terms)
    extra = materialize(term_spans(docs, terms, may), "extra").withColumnRenamed("key", "k_").withColumnRenamed("extra", "extra_")

    @F.arrow_udf(T.StringType())
    def clean(texts: pa.Array, more: pa.Array) -> pa.Array:
        return pa.array([t if t is None else replaced(t, x or []) for t, x in zip(texts.to_pylist(), more.to_pylist(), strict=True)], pa.string())

    @F.arrow_udf(T.StringType())
    def key_of(texts: pa.Array) -> pa.Array:
        some = lambda t: base_spans(t) or not may.empty and bool(may.hits(t))
        return pa.array([digest(t) if t and some(t) else None for t in texts.to_pylist()], pa.string())

    own = docs.columns
    keyed = docs.select(F.struct(*own).alias("row_"), F.col("text").alias("text_"), key_of("text").alias("k_"))
    plain = keyed.filter("k_ is null").select("row_.*")
    # written first: two Python steps in one stage would keep twice as many workers, and their caches, alive
    rest = dealt_join(materialize(keyed.filter("k_ is not null"), "personal"), extra, "k_", "left")
    rest = rest.select("row_", clean("text_", "extra_").alias("clean_"))
    return plain.unionByName(rest.select(*(F.col("clean_").alias(c) if c == "text" else F.col("row_")[c].alias(c) for c in own)))
