"""Simple-8b word-aligned coding of token ids, vectorised over blocks.

A 64-bit word holds a 4-bit selector above 60 data bits; the selector says how
many ids of which width the word packs. A file image codes ids by their
frequency rank in the file (the most frequent id is 0), so common ids take few
bits, in blocks of ``BLOCK`` ids with the word offset of each block, so blocks
decode independently. A value of 60 bits or more is an escape: selector 15
with its index in a table of raw values.
"""

from __future__ import annotations

import struct

import numpy as np

U = np.uint64
BLOCK = 1024
#: Blocks whose selectors are found together, so that their tables stay in a core's cache.
SLICE = 256
#: selector -> (ids in the word, bits each); 0 and 1 are runs of zeros.
COUNT = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTH = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: A 60-bit field with its top bit set is an escape: the rest is an index into the raw values.
ESCAPE = 1 << 59
MAGIC = b"S8B1"


def _selectors(v: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, selector) of every word; in each block a word takes the most ids that fit."""
    n = len(v)
    bits = np.zeros((blocks, BLOCK), np.uint8)  # frexp rounds up beyond 53 bits, where only the widest field is left
    bits.ravel()[:n] = np.frexp(v.astype(np.float64))[1]
    widths = [int(w) for w in np.unique(WIDTH) if w < 60]
    place = np.arange(BLOCK, dtype=np.int16)
    wider = np.empty((len(widths), blocks, BLOCK), np.int16)  # the next id that is too wide, by width
    for i, w in enumerate(widths):
        if i and not (bits > widths[i - 1]).any():
            wider[i:] = BLOCK
            break
        bad = np.where(bits > w, place, np.int16(BLOCK))
        np.minimum.accumulate(bad[:, ::-1], axis=1, out=wider[i][:, ::-1])
    which = np.searchsorted(widths, WIDTH[:15])[:, None]
    stop = np.full(blocks, BLOCK)
    if n % BLOCK:
        stop[-1] = n % BLOCK
    block, at = np.arange(blocks), np.zeros(blocks, np.int64)
    heads, picks = [], []
    while len(block):
        fits = wider[which, block, at] >= np.minimum(at + COUNT[:15, None], BLOCK)
        pick = np.where(fits.any(0), fits.argmax(0), 15)
        heads.append(block * BLOCK + at)
        picks.append(pick)
        at = at + COUNT[pick]
        live = at < stop[block]
        block, at = block[live], at[live]
    head, pick = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (heads, picks))
    order = np.argsort(head)
    return head[order], pick[order]


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """words, first word of each block (and the end), raw escaped values."""
    v = values.astype(U)
    n = len(v)
    blocks = -(-n // BLOCK)
    wide = v >= U(ESCAPE)
    raw = v[wide]
    if len(raw):
        v = np.where(wide, np.cumsum(wide).astype(U) - U(1) + U(ESCAPE), v)
    parts = [_selectors(v[a * BLOCK : (a + SLICE) * BLOCK], min(SLICE, blocks - a)) for a in range(0, blocks, SLICE)]
    head = np.concatenate([h + a * SLICE * BLOCK for a, (h, _) in enumerate(parts)]) if parts else np.zeros(0, np.int64)
    sel = np.concatenate([x for _, x in parts]) if parts else head
    words = sel.astype(U) << U(60)
    limit = np.minimum((head // BLOCK + 1) * BLOCK, n)
    for s in np.unique(sel):
        if WIDTH[s] == 0:
            continue
        mine = np.flatnonzero(sel == s)
        at, upto = head[mine], limit[mine]
        whole = at + COUNT[s] <= upto
        word = np.zeros(len(mine), U)
        for j in range(int(COUNT[s])):
            if whole.all():
                word |= v[at + j] << U(int(WIDTH[s]) * j)
            else:
                ok = at + j < upto
                word[ok] |= v[at[ok] + j] << U(int(WIDTH[s]) * j)
        words[mine] |= word
    first = np.searchsorted(head, np.arange(blocks + 1) * BLOCK)
    return words, first.astype(np.uint32), raw


def unpack(words: np.ndarray, first: np.ndarray, raw: np.ndarray, n: int) -> np.ndarray:
    """The values again, all words at once."""
    sel = (words >> U(60)).astype(np.int64)
    count, width = COUNT[sel], WIDTH[sel].astype(U)
    block = np.repeat(np.arange(len(first) - 1), np.diff(first.astype(np.int64)))
    upto = np.cumsum(count) - count
    within = upto - upto[first[:-1].astype(np.int64)][block] if len(words) else upto
    start = block * BLOCK + within
    count = np.minimum(count, np.minimum((block + 1) * BLOCK, n) - start)
    which = np.repeat(np.arange(len(words)), count)
    j = (np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)).astype(U)
    w = width[which]
    mask = (U(1) << w) - U(1)
    out = (words[which] >> (w * j)) & mask
    wide = (sel[which] == 15) & (out >= U(ESCAPE))
    if wide.any():
        out[wide] = raw[(out[wide] - U(ESCAPE)).astype(np.int64)]
    return out


def to_bytes(doc_ids: np.ndarray, nulls: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> bytes:
    """A file image: documents, their ends in the id stream, the rank table and the coded blocks."""
    rank, table = _ranks(ids)
    words, first, raw = pack(rank)
    head = struct.pack("<4sIQQIII", MAGIC, BLOCK, len(doc_ids), len(ids), len(table), len(first), len(raw))
    parts = [doc_ids.astype("<i8"), nulls.astype("u1"), ends.astype("<i8"), table.astype("<u4"), first.astype("<u4"), raw.astype("<u8"), words.astype("<u8")]
    return head + b"".join(p.tobytes() for p in parts)


def _ranks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) and int(ids.max()) < 1 << 22:
        counts = np.bincount(ids)
        table = np.flatnonzero(counts)
        table = table[np.argsort(-counts[table], kind="stable")]
        back = np.zeros(len(counts), np.int64)
        back[table] = np.arange(len(table))
        return back[ids], table
    table, back, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[back], table[order]


def from_bytes(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, nulls, ends and ids of a file image."""
    fmt = "<4sIQQIII"
    magic, block, n_docs, n_ids, n_table, n_first, n_raw = struct.unpack_from(fmt, image)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a token file of this format")
    at = struct.calcsize(fmt)
    out = []
    for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<i8", n_docs), ("<u4", n_table), ("<u4", n_first), ("<u8", n_raw)):
        out.append(np.frombuffer(image, kind, n, at))
        at += out[-1].nbytes
    doc_ids, nulls, ends, table, first, raw = out
    words = np.frombuffer(image, "<u8", (len(image) - at) // 8, at)
    rank = unpack(words, first, raw, n_ids)
    ids = table[rank.astype(np.int64)] if n_ids else np.zeros(0, np.uint32)
    return doc_ids, nulls.astype(bool), ends, ids
