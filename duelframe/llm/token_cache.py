"""Whole texts to token ids with a ``tokenizers`` file, encoding each distinct chunk once per worker.

A text is cut before each space or line feed that follows a visible character. Neither of the two
vocabularies' splitting patterns has a match that crosses such a place, so the ids of a text are the ids
of its chunks in order. Chunks are told apart exactly (Arrow dictionary encoding), looked up in a bounded
cache, and only unseen ones go through the tokenizer. A full cache keeps what the last steps used.

Where the vocabulary marks the ends of words, chunks of letters go through it without offsets: each gives one end
at least, so that as many ends as chunks are one each. Where its tokens are the text's bytes as they are, chunks share a
call without offsets and are told apart by the tokens' bytes. Where it ignores case and kinds of white space, so does the cache.
"""

from __future__ import annotations

import json
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa

from duelframe.llm.base import SLICE_BYTES, slices, utf8_buffers

#: Distinct chunks that a worker remembers; at this many it keeps only those of its last KEPT_STEPS steps, as far
#: as they are less than half of them.
CACHE_ENTRIES, KEPT_STEPS = 400_000, 2
#: Bytes of unseen chunks that are joined for one call.
JOINED_BYTES = 4000
SPACE, LINE = 32, 10
#: Bytes of ASCII letters and of characters up to U+027F, nearly all letters.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = True
#: Normalizers that make one of upper and lower case, and of any white space.
FOLDING = [("NFC", None), ("Replace", {"Regex": "\\s+"}), ("Lowercase", None)]


def chunk_starts(raw: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each document's first byte, and at each safe boundary.

    A boundary is a space or line feed after a byte that is surely the end of a visible character (ASCII
    0x21 to 0x7E, or a non-ASCII character that can't be white space), or a stop after an ASCII letter.
    """
    prev = np.empty_like(raw)
    prev[0], prev[1:] = SPACE, raw[:-1]
    cut = ((raw == SPACE) | (raw == LINE)) & (prev > 0x20) & (prev != 0x7F)
    letter = (prev | 0x20) - np.uint8(0x61) < 26
    for mark in b".,!?;:":
        cut |= (raw == mark) & letter
    wide = np.flatnonzero(cut & (prev >= 0x80))
    lead = raw[np.maximum(wide - 3, 0)]
    cut[wide[(wide < 3) | ((lead >= 0xE1) & (lead <= 0xE3)) | (raw[wide - 2] == 0xC2)]] = False
    cut[documents] = True
    return np.flatnonzero(cut)


class CachedEncoder:
    """Ids of whole texts; one instance per worker and file."""

    _made: dict[str, CachedEncoder] = {}

    def __init__(self, path: str, entries: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer, self.entries = Tokenizer.from_file(path), entries or CACHE_ENTRIES
        said = json.loads(Path(path).read_text(encoding="utf-8"))
        self.ends, suffix = None, said["model"].get("end_of_word_suffix")
        if suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[k for word, k in vocabulary.items() if word.endswith(suffix)]] = True
        self.bytes = None
        if said["normalizer"] is None and said["pre_tokenizer"]["type"] == "ByteLevel" and not said["pre_tokenizer"]["add_prefix_space"]:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.bytes = np.zeros(self.tokenizer.get_vocab_size() + 1, np.int64)  # a token has a character for each byte
            self.bytes[list(vocabulary.values())] = [len(word) for word in vocabulary]
            for token in said["added_tokens"]:
                self.bytes[token["id"]] = len(token["content"].encode())
        kinds = [(n["type"], n.get("pattern")) for n in (said["normalizer"] or {}).get("normalizers", [])]
        self.folds, self.added = kinds == FOLDING, [t["content"].lower().encode() for t in said["added_tokens"]]
        self.clear()

    @classmethod
    def get(cls, path: str, entries: int | None = None) -> CachedEncoder:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in cls._made:
            cls._made[path] = cls(path, entries)
        cls._made[path].entries = entries or CACHE_ENTRIES
        return cls._made[path]

    @classmethod
    def forget(cls) -> None:
        """Drop this worker's encoders and what they remember."""
        cls._made.clear()

    def clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros((1 << 14) + 1, np.int64)
        self.recent: list[list[bytes]] = []

    def _make_room(self, more: int) -> None:
        """Before ``more`` chunks come that would not fit: forget all but those of the last steps."""
        if len(self.slot) + more <= self.entries:
            return
        keep, room = {}, min(self.entries // 2, self.entries - more)
        for words in reversed(self.recent):
            if len(keep) + len(words) <= room:
                keep |= dict.fromkeys(words)
        words = list(keep)
        known = np.fromiter((self.slot[w] for w in words), np.int64, len(words))
        ids, total = self._gather(known)
        self.clear()
        if words:
            self._add(words, ids, total[1:])

    def _gather(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks at these places one after the other, and their n + 1 offsets."""
        begin, count = self.at[known], self.at[known + 1] - self.at[known]
        total = np.concatenate([[0], np.cumsum(count)])
        return self.pool[np.repeat(begin - total[:-1], count) + np.arange(total[-1])], total

    def _add(self, chunks: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        """Remember chunks whose ids follow each other in ``ids``, each up to its place in ``ends``."""
        k, used = len(self.slot), int(self.at[len(self.slot)])
        while used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while k + len(chunks) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.pool[used : used + len(ids)] = ids
        self.at[k + 1 : k + 1 + len(chunks)] = used + ends
        self.slot.update(zip(chunks, range(k, k + len(chunks)), strict=True))

    def _learn_words(self, chunks: list[bytes], words: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Encode chunks (at ``words``) of letters behind a space or line feed; which of them are known then."""
        done = np.zeros(len(words), bool)
        for part in np.split(np.arange(len(words)), np.flatnonzero(np.diff(np.cumsum(size[words]) // JOINED_BYTES)) + 1) if len(words) else []:
            own = [chunks[k] for k in words[part]]
            ids = np.array(self.tokenizer.encode_batch_fast([b"".join(own).decode("utf-8", "replace")], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(own) and ends[-1] == len(ids):
                self._add(own, ids, ends)
                done[part] = True
        return done

    def _folded(self, raw: np.ndarray) -> np.ndarray:
        """Lower case, except where what follows may combine with a letter, and spaces; but as it is beside an added token."""
        low = raw.copy()
        upper = raw - np.uint8(65) < 26
        upper[:-1] &= raw[1:] < 0x80
        low[upper] += 32
        low[raw == LINE] = SPACE
        data = bytes(low).lower()
        return raw if any(t in data for t in self.added) else low

    def _learn(self, chunks: list[bytes]) -> None:
        """Encode chunks that aren't known. Plain ones share calls, told apart by their offsets."""
        raw = np.frombuffer(b"".join(chunks), np.uint8)
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        stop = np.cumsum(size)
        first, last = raw[stop - size], raw[stop - 1]
        wide = (last >= 0x80) & ((raw[np.maximum(stop - 3, 0)] >= 0xE1) | (raw[np.maximum(stop - 2, 0)] == 0xC2))
        easy = ((first == SPACE) | (first == LINE)) & (size > 1) & (size < 200) & (last > 0x20) & (last != 0x7F) & ~wide
        chars = np.cumsum((raw & 0xC0) != 0x80)[stop - 1]
        chars = np.diff(chars, prepend=0)
        if self.ends is not None:
            odd = np.cumsum(~LETTER[raw])
            words = np.flatnonzero(easy & (odd[stop - 1] == odd[stop - size]))  # letters behind the first byte
            easy[words[self._learn_words(chunks, words, size)]] = False
            known = np.zeros(len(chunks), bool)
            known[words] = ~easy[words]
        else:
            known = np.zeros(len(chunks), bool)
        plain, alone = np.flatnonzero(easy), list(np.flatnonzero(~easy & ~known))
        for part in np.split(plain, np.flatnonzero(np.diff(np.cumsum(size[plain]) // JOINED_BYTES)) + 1) if len(plain) else []:
            own = [chunks[k] for k in part]
            text = b"".join(own).decode("utf-8", "replace")
            if self.bytes is not None:
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                ends, wanted = np.cumsum(self.bytes[ids]), np.cumsum(size[part])
                at = np.searchsorted(ends, wanted)
                if ends[-1] == wanted[-1] and (ends[at] == wanted).all():
                    self._add(own, ids, at + 1)
                else:
                    alone += list(part)
                continue
            if not unicodedata.is_normalized("NFC", text) or len(text) != chars[part].sum():
                alone += list(part)
                continue
            encoded = self.tokenizer.encode(text, add_special_tokens=False)
            ends = np.fromiter((e for _, e in encoded.offsets), np.int64, len(encoded.offsets))
            self._add(own, np.array(encoded.ids, np.uint32), np.searchsorted(ends, np.cumsum(chars[part]), "right"))
        for k in range(0, len(alone), 512):
            own = [chunks[i] for i in alone[k : k + 512]]
            found = [e.ids for e in self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in own], add_special_tokens=False)]
            self._add(own, np.array([i for ids in found for i in ids], np.uint32), np.cumsum([len(ids) for ids in found]))

    def _slice(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        documents = offsets[:-1][np.diff(offsets) > 0]
        if not len(documents):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.folds:
            raw = self._folded(raw)
        starts = chunk_starts(raw, documents)
        bounds = np.append(starts, len(raw))
        data = pa.py_buffer(np.ascontiguousarray(raw))
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), data])
        coded = chunks.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.slot]
        if len(self.slot) + len(new) > self.entries:
            self._make_room(len(words))
            new = [w for w in words if w not in self.slot]
        if new:
            self._learn(new)
        self.recent = [*self.recent[1 - KEPT_STEPS :], words]
        known = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy(zero_copy_only=False)]
        ids, total = self._gather(known)
        return ids, total[np.searchsorted(bounds, offsets)]

    def encode(self, texts: pa.Array):
        """Yields (first document, ids of some documents, their offsets): all documents in order."""
        raw, offsets = utf8_buffers(texts)
        # a smaller cache, for workers with less memory, also goes in smaller steps
        for first, last in slices(offsets, SLICE_BYTES if self.entries >= CACHE_ENTRIES else SLICE_BYTES // 2):
            at = offsets[first : last + 1]
            yield (first, *self._slice(raw[at[0] : at[-1]], at - at[0]))
