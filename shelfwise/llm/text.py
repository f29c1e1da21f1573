"""Vectorised words, shingles and hashes of whole Arrow text batches (numpy).

A text is a run of UTF-8 bytes. A word is a maximal run of bytes that are not
separators; all separators are ASCII, so bytes and code points agree. Every
function works on a slice of rows of bounded bytes, so memory does not follow
the batch size; one longer text is a slice of its own.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 2 << 20

#: ``[^\x20\x09-\x0D]+``: bytes that stand between words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_K1, _K2, _K3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_MASK = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=U)
LONG_WORD = 512
_PLACE = [U((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for j in range(64)]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns a worker's free memory to the system; the next stage's workers run beside it."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def tidy(work: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``work`` over batches, which gives its free memory back at the end."""

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch], *args, **named) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches, *args, **named)
        finally:
            give_back()

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * _K2
    x = (x ^ (x >> U(27))) * _K3
    return x ^ (x >> U(31))


class Texts:
    """Some consecutive rows of a text column: their bytes and row offsets."""

    def __init__(self, first: int, offsets: np.ndarray, data: np.ndarray):
        self.first = first
        self.offsets = offsets
        self.data = data
        self.n = len(offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def lowered(self) -> Texts:
        return Texts(self.first, self.offsets, LOWER[self.data])

    def words(self, stop: np.ndarray = SPACE) -> Words:
        return Words(self, stop)


def texts(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Slices of at most ``limit`` bytes (or one row); a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    if not len(column):
        return
    _, where, what = column.buffers()
    off = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield Texts(i, off[i : j + 1] - off[i], data[off[i] : off[j]])
        i = j


class Words:
    """All words of a slice in order: ``start``/``end`` byte, ``row`` and ``at`` (place in the row).

    ``stop`` marks the byte values between words; ``cut`` marks further bytes
    before which a word ends and another begins.
    """

    def __init__(self, src: Texts, stop: np.ndarray, cut: np.ndarray | None = None):
        self.src = src
        inside = ~stop[src.data]
        begins = np.zeros(len(inside) + 1, bool)  # a word that goes on from the byte before begins anew here
        begins[src.offsets] = True
        if cut is not None:
            begins[:-1] |= cut
        begins[:1] = begins[-1:] = True
        self.start = np.flatnonzero(inside & (begins[:-1] | ~np.concatenate([[False], inside[:-1]])))
        self.end = np.flatnonzero(inside & (begins[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        self.first = np.searchsorted(self.start, src.offsets)  # of each row, and the number of all
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(src.n), self.count)
        self.at = np.arange(len(self.start)) - self.first[:-1][self.row]

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words' bytes."""
        size = self.end - self.start
        h = mix(size.astype(U) * _K1 + U(1))
        padded = np.zeros(len(self.src.data) + 8, np.uint8)
        padded[: len(self.src.data)] = self.src.data
        eight = np.ndarray((len(self.src.data) + 1,), "<u8", padded, strides=(1,))
        todo = np.flatnonzero(size <= LONG_WORD)
        step = 0
        while len(todo):
            left = size[todo] - step
            chunk = eight[self.start[todo] + step] & _MASK[np.minimum(left, 8)]
            h[todo] = mix((h[todo] ^ chunk) * _K1)
            step += 8
            todo = todo[left > 8]
        for i in np.flatnonzero(size > LONG_WORD):
            word = self.src.data[self.start[i] : self.end[i]].tobytes()
            h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h

    def windows(self, h: np.ndarray, k: int) -> np.ndarray:
        """Hash of the k words from each word on; only places with ``at + k <= count`` are meant."""
        n = len(h)
        out = np.zeros(n, U)
        for j in range(min(k, n)):
            out[: n - j] += mix(h[j:] + _PLACE[j])
        return mix(out)


def distinct_in_rows(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs, ordered by row and key; ``rows`` ascend."""
    order = np.argsort(keys, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    r, k = rows[order], keys[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    return r[new], k[new]


def shingles(w: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row as (row, hash); a row of fewer words has its whole sequence as one."""
    h = w.hashes()
    full = w.windows(h, k)
    have = w.count[w.row]
    keep = w.at + k <= have
    rows, keys = w.row[keep], full[keep]
    short = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(short):
        own = np.empty(len(short), U)
        for size in range(1, k):
            these = np.flatnonzero(w.count[short] == size)
            own[these] = mix(w.windows(h, size)[w.first[short[these]]] ^ U(size))
        rows, keys = np.concatenate([rows, short]), np.concatenate([keys, own])
        order = np.argsort(rows, kind="stable")
        rows, keys = rows[order], keys[order]
    return distinct_in_rows(rows, keys)
