"""Token ids of whole texts with a public tokenizer, each distinct unit encoded once per worker.

The tokenizer drops white space and splits texts into runs of letters, single
digits and runs of other characters before it merges, so a text's ids are the
ids of its white-space chunks in order, and a plain chunk's are those of its
runs. A chunk is plain if it holds ASCII and precomposed Latin-1 letters only,
no apostrophe (contractions) and no ``<|`` (special tokens); any other chunk is
encoded whole, as it stands. Lower-casing plain units first changes nothing,
since the tokenizer does the same.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .text import LOWER, SPACE, Texts, U, Words, texts

CACHE_UNITS = 1 << 19
#: Units handed to the tokenizer at once; it returns an object for each.
CALL_UNITS = 4096

_KIND = np.full(256, 3, np.uint8)  # 1 letter, 2 digit, 3 other
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[0x80:] = 1


def units(src: Texts) -> Words:
    """The units of a slice: every occurrence, in order; bytes of plain units are lower-cased."""
    raw = src.data
    data = LOWER[raw]
    n = len(raw)
    odd = raw >= 0x80
    after_c3 = np.zeros(n, bool)
    if odd.any():
        lead = raw == 0xC3
        after_c3[1:] = lead[:-1]
        latin = after_c3 & (raw >= 0x80) & (raw < 0xC0) & (raw != 0x97) & (raw != 0xB7)
        odd &= ~latin
        odd[:-1] &= ~(lead[:-1] & latin[1:])
        upper = latin & (raw <= 0x9E)
        data[upper] += 0x20
    odd |= raw == ord("'")
    bar = (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
    odd[:-1] |= bar
    kind = _KIND[data]
    cut = np.zeros(n, bool)
    cut[1:] = kind[1:] != kind[:-1]
    where = np.flatnonzero(odd)
    if len(where):
        chunks = Words(src, SPACE)
        hit = np.unique(np.searchsorted(chunks.start, where, "right") - 1)
        step = np.zeros(n + 1, np.int8)
        step[chunks.start[hit]] += 1
        np.subtract.at(step, chunks.end[hit], 1)
        whole = np.cumsum(step[:-1]).astype(bool)
        cut &= ~whole
        data[whole] = raw[whole]
    return Words(Texts(src.first, src.offsets, data), SPACE, cut)


class Encoder:
    """Ids of units, remembered by hash; forgets all when it holds too many."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, U)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _add(self, keys: np.ndarray, words: list[str]) -> None:
        ids = []
        for lo in range(0, len(words), CALL_UNITS):
            ids += [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(words[lo : lo + CALL_UNITS], add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, *ids])
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.size = np.concatenate([self.size, size])[order]

    def encode(self, src: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice and where each row's begin (and the last ends)."""
        w = units(src)
        keys, first, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_UNITS:
            self._clear()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            body = w.src.data.tobytes()
            spans = zip(w.start[first[new]].tolist(), w.end[first[new]].tolist(), strict=True)
            self._add(keys[new], [body[a:b].decode("utf-8", "replace") for a, b in spans])
            at = np.searchsorted(self.keys, keys)
        begin, size = self.begin[at][back], self.size[at][back]
        upto = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])
        return self.flat[where], upto[w.first]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file; a reused worker keeps what it has learnt."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(batch: pa.RecordBatch, path: str, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, offsets) for each slice of the batch's ``text``, ``end_id`` after each row's ids."""
    enc = encoder(path)
    for src in texts(batch.column("text")):
        ids, off = enc.encode(src)
        n = len(off) - 1
        out = np.full(len(ids) + n, end_id, np.uint32)
        keep = np.ones(len(out), bool)
        keep[off[1:] + np.arange(n)] = False
        out[keep] = ids
        yield src.first, out, off + np.arange(n + 1)
