"""Byte-level BPE with tiktoken from a local rank file: whole texts to ids, and ids to raw bytes.

Long texts are cut where the splitting pattern surely ends a match: before a space or line feed that
follows an ASCII letter or digit, with something visible after it. Runs without such places stay whole, but for long
runs of white space: the pattern tries those character by character and would overflow its stack. By the pattern's
own rule (``\\s+(?!\\S)``) such a run is one match up to its last character, which belongs to what follows; at
the end of a text all of it is one. So the run is encoded as that one piece, without the pattern.

Defined results: null text is an empty text (no ids); a null doc_id is kept; texts of any length are encoded whole,
long runs of one kind of character too; empty tables give empty results; every row is encoded, repeated ones too;
other columns are not read. The splitting pattern must have the rule above and no other match across such places.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from duelframe.llm.base import small_batches

#: Characters of a text that go to the library at once.
PART_CHARS = 50_000
SAFE = re.compile(r"(?<=[A-Za-z0-9])(?=[ \n]\S)")
#: A run of white space (as Unicode has it) that the splitting pattern doesn't see.
RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
ENCODED = "doc_id long, n_tokens long, ids array<int>"


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str):
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def parts(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """The text in order, cut at safe boundaries after about ``most`` characters each."""
    first = 0
    while len(text) - first > most:
        found = SAFE.search(text, first + most)
        if not found:
            break
        yield text[first : found.start()]
        first = found.start()
    yield text[first:] if first else text


def encode_text(enc, text: str | None) -> np.ndarray:
    """Ids of a whole text."""
    if not text:
        return np.zeros(0, "<u4")
    if len(text) <= PART_CHARS:
        return np.array(enc.encode_ordinary(text), "<u4") if not RUN.search(text) else _with_runs(enc, text)
    return _with_runs(enc, text)


def _with_runs(enc, text: str) -> np.ndarray:
    found, first = [], 0
    for run in RUN.finditer(text):
        last = run.end() if run.end() == len(text) else run.end() - 1
        found += [enc.encode_ordinary(part) for part in parts(text[first : run.start()])]
        found.append(enc._encode_single_piece(text[run.start() : last]))
        first = last
    found += [enc.encode_ordinary(part) for part in parts(text[first:])]
    return np.concatenate([np.array(ids, "<u4") for ids in found])


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Ids of every whole text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            ids = [encode_text(enc, t.as_py()).astype(np.int32) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Raw bytes of the ids, and digests of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            out = []
            for doc, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
                raw = enc.decode_bytes(own.tolist())
                out.append((doc, n, hashlib.sha256(own).hexdigest(), hashlib.sha256(raw).hexdigest(), raw))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded binary")
