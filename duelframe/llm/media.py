"""Audio columns: lossless 8-bit media, polyphase resampling, log-mel patches, energy segments.

``store`` keeps bytes as unsigned 8-bit mono samples in a WAV file; ``features`` reads such files back,
resamples by a polyphase filter, takes overlapped log-mel frames and finds segments by two energy
thresholds. ``tensors`` gives the log-mel patches as a fixed-shape Arrow tensor column with time spans; they
are written as a table with the segments' spans, and what ``summary`` says comes from that table alone.

Defined results: null text is an empty text (payload: 64 zero bytes); equal texts give equal values; an
empty table gives an empty result; other columns are not read. Long media are worked through in blocks.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from duelframe.llm.base import materialize, small_batches

UNIT = 64
RATE, UP, DOWN, TAPS = 8000, 2, 5, 32
FRAME, HOP, BANDS, PATCH = 256, 128, 24, 32
#: Frames that one block holds.
BLOCK_FRAMES = 4096
#: A segment opens above the higher and closes below the lower of these, in nepers over the median energy.
OPEN, CLOSE = 0.35, 0.10
MEDIA = "doc_id long, n_bytes long, media binary"


def pcm_wav(payload: bytes) -> bytes:
    """A mono 8-bit WAV file with these bytes as its samples."""
    n = len(payload)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + n, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", n)
    return head + payload


def samples(media: bytes) -> bytes:
    """The samples of such a file, found by its chunk headers."""
    at = 12
    while media[at : at + 4] != b"data":
        at += 8 + struct.unpack_from("<I", media, at + 4)[0]
    n = struct.unpack_from("<I", media, at + 4)[0]
    return media[at + 8 : at + 8 + n]


def store(docs: DataFrame) -> DataFrame:
    """Each whole text's UTF-8 bytes, padded with zero bytes to a positive multiple of 64, as a WAV file."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(t.as_py() or "").encode() for t in batch.column(1)]
            media = [pcm_wav(x + b"\0" * ((-len(x)) % UNIT or (0 if x else UNIT))) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, MEDIA)


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The resampling filter by phase, the window, and the mel filterbank."""
    t = np.arange(TAPS * UP) - (TAPS * UP - 1) / 2
    cut = 1 / max(UP, DOWN)
    low = np.sinc(t * cut) * cut * np.hamming(TAPS * UP) * UP
    low /= low.sum() / UP
    phases = low.reshape(TAPS, UP).T[:, ::-1].astype(np.float32)
    rate = RATE * UP / DOWN
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(0), mel(rate / 2), BANDS + 2) / 2595) - 1)
    bins = np.arange(FRAME // 2 + 1) * rate / FRAME
    rise = (bins[None] - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    fall = (edges[2:, None] - bins[None]) / (edges[2:] - edges[1:-1])[:, None]
    bank = np.maximum(0, np.minimum(rise, fall)).T.astype(np.float32)
    return phases, np.hanning(FRAME).astype(np.float32), bank


def resample(x: np.ndarray) -> np.ndarray:
    """Rational-rate polyphase filter: output m uses phase (m * DOWN) mod UP at input (m * DOWN) // UP.

    The outputs of one phase are DOWN inputs apart, so each phase is one product of a strided view.
    """
    phases, _, _ = tables()
    padded = np.concatenate([np.zeros(TAPS // 2, np.float32), x, np.zeros(TAPS, np.float32)])
    n = len(x) * UP // DOWN
    out = np.empty(n, np.float32)
    windows = np.lib.stride_tricks.sliding_window_view(padded, TAPS)
    for first in range(min(UP, n)):
        out[first::UP] = windows[first * DOWN // UP :: DOWN][: -(-(n - first) // UP)] @ phases[first * DOWN % UP]
    return out


def log_mel(payload: bytes) -> np.ndarray:
    """Overlapped log-mel frames (n, BANDS) of 8-bit samples, at least one; worked through in blocks."""
    _, window, bank = tables()
    raw = np.frombuffer(payload, np.uint8)
    step = BLOCK_FRAMES * HOP * DOWN // UP
    out = []
    for first in range(0, len(raw), step):
        margin = min(first, TAPS * DOWN)
        part = raw[first - margin : first + step + (FRAME + TAPS) * DOWN].astype(np.float32) / 128 - 1
        y = resample(part)[margin * UP // DOWN :]
        frames = max(1, min(BLOCK_FRAMES, -(-min(len(raw) - first, step) * UP // DOWN // HOP)))
        y = np.pad(y, (0, max(0, (frames - 1) * HOP + FRAME - len(y))))
        view = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP][:frames]
        power = np.abs(np.fft.rfft(view * window, axis=1)).astype(np.float32) ** 2
        out.append(np.log(power @ bank + 1e-6))
    return np.concatenate(out)


def segments(mel: np.ndarray) -> np.ndarray:
    """(first, last + 1) frames of stretches whose energy rises above OPEN and stays above CLOSE."""
    energy = mel.mean(1)
    energy = energy - np.median(energy)
    idle = energy < CLOSE
    change = np.diff(np.concatenate([[False], ~idle, [False]]).astype(np.int8))
    spans = np.stack([np.flatnonzero(change == 1), np.flatnonzero(change == -1)], 1)
    high = np.concatenate([[0], np.cumsum(energy > OPEN)])
    return spans[high[spans[:, 1]] > high[spans[:, 0]]]


def tensors(mel: np.ndarray) -> pa.Table:
    """Patches of PATCH frames (the last padded) as a fixed-shape tensor column, with start and end seconds."""
    n = -(-len(mel) // PATCH)
    whole = np.pad(mel, ((0, n * PATCH - len(mel)), (0, 0))).reshape(n, PATCH, BANDS).astype(np.float32)
    second = HOP * DOWN / (RATE * UP)
    start = np.arange(n) * PATCH * second
    return pa.table({"log_mel": pa.FixedShapeTensorArray.from_numpy_ndarray(whole), "start_s": start, "end_s": np.minimum(start + PATCH * second, len(mel) * second)})


def ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def frames_of(table: pa.Table) -> np.ndarray:
    """The log-mel frames of such a table, without padding."""
    if not isinstance(table["log_mel"].type, pa.FixedShapeTensorType):
        raise TypeError("log_mel is no fixed-shape tensor column")
    whole = table["log_mel"].combine_chunks()
    whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
    n = round(table["end_s"][-1].as_py() * RATE * UP / (HOP * DOWN))
    return whole.to_numpy_ndarray().reshape(-1, BANDS)[:n]


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"
TENSORS = FEATURES + ", segments array<struct<start_s:double,end_s:double>>, tensors binary"


def features(media: DataFrame) -> DataFrame:
    """Read stored media back: digests of payload and file, segments in seconds, and the tensors as Arrow IPC."""
    second = HOP * DOWN / (RATE * UP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))
        for batch in batches:
            rows = []
            for doc, n, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                file = held.as_py()
                payload = samples(file)
                mel = log_mel(payload)
                found = [{"start_s": a * second, "end_s": b * second} for a, b in segments(mel).tolist()]
                rows.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(file), hashlib.sha256(file).hexdigest(), found, ipc(tensors(mel))))
            columns = list(zip(*rows, strict=True)) or [[]] * 9
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), spans, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*(x.split()[0] for x in FEATURES.split(", ")), "segments", "tensors"])

    return media.mapInArrow(run, TENSORS)


def summary(stored: DataFrame) -> DataFrame:
    """Read stored tensors and segments back: their counts, voiced frames and mean bands as ``feature``."""
    second = HOP * DOWN / (RATE * UP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found, held in zip(batch.column("segments").to_pylist(), batch.column("tensors"), strict=True):
                mel = frames_of(pa.ipc.open_stream(held.as_buffer()).read_all())
                voiced = sum(round((x["end_s"] - x["start_s"]) / second) for x in found)
                means = ",".join(f"{v:.2f}" for v in mel.mean(0, dtype=np.float64)[::4] + 0.0)
                out.append(f"frames={len(mel)};segments={len(found)};voiced={voiced};mel={means}")
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(out, pa.string())], [*batch.schema.names[:7], "feature"])

    return stored.mapInArrow(run, FEATURES + ", feature string")


def media_features(docs: DataFrame) -> DataFrame:
    """Store every whole text as media and its tensors, each written as a table, and sum up what is read back."""
    return summary(materialize(features(materialize(store(docs), "media")), "tensors"))
