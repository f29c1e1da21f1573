"""Substring removal with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Every window has an
anchor, its least-hashed phrase of ``PHRASE`` words (the first of equals);
equal windows have equal anchors at equal places.

1. Anchors of all documents are counted; windows whose anchor occurs once in
   the corpus cannot repeat. The rest are the recurring phrases.
2. Documents are dealt to buckets. Each bucket compiles its recurring phrases
   into an Aho-Corasick automaton over word codes and streams all its
   documents through it, which locates every occurrence. The windows around
   an anchor are its context; of equal contexts in a bucket only the earliest
   asks on, the others are repeats.
3. Asking contexts meet by anchor, the hottest once per bucket and context;
   there the earliest start of each window is found, and later ones are
   repeats.
4. Words covered by a repeat go.

Exact copies of a whole document need no search: each of their windows starts
in the copy of the least id.

Defined results: a null text is empty and keeps the empty string; a null id
counts as the largest; rows that repeat an id are one document each, and
neither precedes the other at the same start; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import bounded_batches, cut, fan_out, release
from .text import U, Words, give_back, mix, texts, tidy

WINDOW = 20
PHRASE = 8
BROADCAST_IDS = 200_000
NO_ID = (1 << 63) - 1


def joined(w: Words, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The kept words of each row joined by one space, and each row's offsets."""
    src = w.src
    kept = np.flatnonzero(keep)
    size = (w.end - w.start)[kept]
    row = w.row[kept]
    gap = np.zeros(len(kept), np.int64)
    gap[:-1] = row[1:] == row[:-1]
    total = np.concatenate([[0], np.cumsum(size + gap)])
    at = np.repeat(w.start[kept] - total[:-1], size + gap) + np.arange(total[-1])
    out = src.data[np.minimum(at, max(0, len(src.data) - 1))] if len(src.data) else src.data
    out = out.copy()
    out[total[1:][gap == 1] - 1] = 0x20
    return out.tobytes(), total[np.searchsorted(row, np.arange(src.n + 1))]


def digests(w: Words, keep: np.ndarray) -> list[str]:
    body, off = joined(w, keep)
    view = memoryview(body)
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


BASE = "key long, tag long, n_words long, h1 long, h2 long, sha string"


@tidy
def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, a hash of the word sequence, and the digest of all words."""
    for batch in batches:
        for src in texts(batch.column("text")):
            w = src.words()
            h = w.hashes()
            place = w.at.astype(U) + U(1)
            sums = []
            for salt in (U(0x2545F4914F6CDD1D), U(0x5851F42D4C957F2D)):
                total = np.concatenate([np.zeros(1, U), np.cumsum(mix(h ^ mix(place * salt)), dtype=U)])
                sums.append((total[w.first[1:]] - total[w.first[:-1]]).view(np.int64))
            cols = [batch.column(c).slice(src.first, src.n) for c in ("key", "tag")]
            cols += [pa.array(w.count.astype(np.int64)), *map(pa.array, sums), pa.array(digests(w, np.ones(len(w), bool)), pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["key", "tag", "n_words", "h1", "h2", "sha"])


class Contexts:
    """The anchors of a slice with the run of windows [lo, hi] that each stands for (word numbers)."""

    def __init__(self, w: Words, h: np.ndarray, window: int, phrase: int):
        g = w.windows(h, phrase)
        n = len(g)
        best = g.copy()
        at = np.arange(n)
        for j in range(1, min(window - phrase + 1, n)):
            less = g[j:] < best[: n - j]
            best[: n - j][less] = g[j:][less]
            at[: n - j][less] = np.arange(j, n)[less]
        valid = np.flatnonzero(w.at + window <= w.count[w.row])
        anchor = at[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (w.row[valid[1:]] != w.row[valid[:-1]])
        first = np.flatnonzero(new)
        self.anchor = anchor[first]
        self.lo = valid[first]
        self.hi = valid[np.append(first[1:], len(valid)) - 1] if len(valid) else valid
        self.t = g[self.anchor]


@tidy
def _anchors(batches: Iterator[pa.RecordBatch], window: int, phrase: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = batch.column("key")
        for src in texts(batch.column("text")):
            w = src.words()
            c = Contexts(w, w.hashes(), window, phrase)
            where = pa.array(w.row[c.anchor] + src.first)
            yield pa.RecordBatch.from_arrays([pa.array(c.t.view(np.int64)), key.take(where)], ["t", "key"])


def _automaton(phrases: np.ndarray) -> ahocorasick.Automaton:
    """Of phrases given as rows of word codes."""
    out = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for p in map(tuple, phrases.tolist()):
        out.add_word(p)
    out.make_automaton()
    return out


LOCATED = "key long, tag long, lo long, hi long, t long, w binary"


def _locate(docs: pa.Table, recurring: pa.Table, window: int, phrase: int) -> pa.Table:
    """Repeats known within the bucket (t null), and one asking row for each context (t, the windows' hashes)."""
    t = np.unique(np.asarray(recurring.column("t")).astype(np.int64).view(U)) if len(recurring) else np.zeros(0, U)
    docs = docs.combine_chunks()
    slices = []
    forms: list[np.ndarray] = []
    for src in texts(docs.column("text")):
        w = src.words()
        h = w.hashes()
        c = Contexts(w, h, window, phrase)
        slices.append((src, w, h, c))
        mine = c.anchor[np.isin(c.t, t)]
        forms.append(h[mine[:, None] + np.arange(phrase)])
    words = np.unique(np.concatenate(forms)) if forms else np.zeros(0, U)
    codes = np.unique(np.searchsorted(words, np.concatenate(forms)) + 1, axis=0) if len(words) else np.zeros((0, phrase), np.int64)
    names = ["key", "tag", "lo", "hi", "t", "w"]
    kinds = [pa.int64()] * 5 + [pa.binary()]
    if not len(codes):
        return pa.table([pa.array([], k) for k in kinds], names=names)
    automaton = _automaton(codes)
    key_of, tag_of = (np.asarray(docs.column(c)).astype(np.int64) for c in ("key", "tag"))
    found: list[list[np.ndarray]] = []
    hashes = []
    for src, w, h, c in slices:
        at = np.searchsorted(words, h)
        known = words[np.minimum(at, len(words) - 1)] == h
        code = np.where(known, at + 1, 0)
        hit = np.zeros(len(h), bool)
        for a, n in zip(w.first[:-1].tolist(), w.count.tolist(), strict=True):
            if n >= window:
                ends = [e for e, _ in automaton.iter(tuple(code[a : a + n].tolist()))]
                hit[np.array(ends, np.int64) + (a - phrase + 1)] = True
        keep = hit[c.anchor]
        lo, hi, row = c.lo[keep], c.hi[keep], w.row[c.anchor[keep]] + src.first
        g = w.windows(h, window)
        found.append([key_of[row], tag_of[row], w.at[lo], w.at[hi], c.t[keep], g[lo], g[hi]])
        size = hi - lo + 1
        flat = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        hashes.append(g[flat])
    key, tag, lo, hi, t, g_lo, g_hi = (np.concatenate(x) for x in zip(*found, strict=True))
    flat = np.concatenate(hashes)
    size = hi - lo + 1
    begin = np.cumsum(size) - size
    order = np.lexsort((lo, key, size, g_hi, g_lo))
    new = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    new[1:] = (g_lo[a] != g_lo[b]) | (g_hi[a] != g_hi[b]) | (size[a] != size[b])
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = order[(key[order] != key[head]) | (lo[order] != lo[head])]
    ask = order[new]
    tie = order[~new & (key[order] == key[head]) & (lo[order] == lo[head]) & (tag[order] != tag[head])]
    ask = np.concatenate([ask, tie])
    body = flat.astype("<u8").tobytes()
    w_bytes = [body[8 * x : 8 * (x + y)] for x, y in zip(begin[ask].tolist(), size[ask].tolist(), strict=True)]
    n_later = len(later)
    both = np.concatenate([later, ask])
    t_col = pa.concat_arrays([pa.nulls(n_later, pa.int64()), pa.array(t[ask].view(np.int64))])
    w_col = pa.concat_arrays([pa.nulls(n_later, pa.binary()), pa.array(w_bytes, pa.binary())])
    del slices, found, hashes
    give_back()
    return pa.table([pa.array(key[both]), pa.array(tag[both]), pa.array(lo[both]), pa.array(hi[both]), t_col, w_col], names=names)


def _later(group: pa.Table) -> pa.Table:
    """Runs of windows that also start earlier, among the asking contexts of some anchors."""
    key, tag, lo, hi = (np.asarray(group.column(c)).astype(np.int64) for c in ("key", "tag", "lo", "hi"))
    g = np.frombuffer(b"".join(group.column("w").to_pylist()), "<u8")
    size = hi - lo + 1
    ask = np.repeat(np.arange(len(size)), size)
    start = lo[ask] + np.arange(len(ask)) - np.repeat(np.cumsum(size) - size, size)
    order = np.lexsort((start, key[ask], g))
    new = np.ones(len(order), bool)
    new[1:] = g[order[1:]] != g[order[:-1]]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    late = np.zeros(len(order), bool)
    late[order] = (key[ask[order]] != key[ask[head]]) | (start[order] != start[head])
    ask, start = ask[late], start[late]
    first = np.ones(len(ask), bool)
    first[1:] = (ask[1:] != ask[:-1]) | (start[1:] != start[:-1] + 1)
    a = np.flatnonzero(first)
    b = np.append(a[1:], len(ask)) - 1 if len(ask) else a
    return pa.table({"key": pa.array(key[ask[a]]), "tag": pa.array(tag[ask[a]]), "lo": pa.array(start[a]), "hi": pa.array(start[b])})


@tidy
def _remove(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        size = np.asarray(spans.value_lengths()).astype(np.int64)
        inner = spans.flatten()
        lo, hi = (np.asarray(inner.field(i)).astype(np.int64) for i in (0, 1))
        off = np.concatenate([[0], np.cumsum(size)])
        for src in texts(batch.column("text")):
            w = src.words()
            span = slice(off[src.first], off[src.first + src.n])
            row = np.repeat(np.arange(src.n), size[src.first : src.first + src.n])
            step = np.zeros(len(w) + 1, np.int64)
            np.add.at(step, w.first[row] + lo[span], 1)
            np.add.at(step, w.first[row] + hi[span] + window, -1)
            keep = np.cumsum(step[:-1]) == 0
            gone = w.count - np.bincount(w.row[keep], minlength=src.n)
            body, o = joined(w, keep)
            kept = [body[a:b].decode("utf-8", "replace") for a, b in zip(o[:-1].tolist(), o[1:].tolist(), strict=True)]
            cols = [batch.column(c).slice(src.first, src.n) for c in ("key", "tag")]
            cols += [pa.array(gone.astype(np.int64)), pa.array(kept, pa.string()), pa.array(digests(w, keep), pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["key", "tag", "n_removed", "kept_text", "kept_sha256"])


def _recurring(docs: DataFrame, reps: DataFrame, window: int, phrase: int) -> DataFrame:
    """(t, key) of each recurring phrase and each document that holds it and is no copy of an earlier one."""
    rows = docs.mapInArrow(partial(_anchors, window=window, phrase=phrase), "t long, key long")
    often = rows.groupBy("t").count().filter("count > 1").select("t")
    held = cut(rows.join(often, "t"), "phrases_held")
    return cut(held.join(reps, "key", "left_semi").distinct(), "phrases")


def repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, texts, spans): all documents; the texts of some; and for these the windows [lo, hi] that are repeats."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64("text").alias("tag"), "text")
    base = cut(docs.mapInArrow(_base, BASE), "substring_base")
    least = base.filter(f"n_words >= {window}").groupBy("h1", "h2", "n_words").agg(F.min("key").alias("first"))
    base = cut(base.join(least, ["h1", "h2", "n_words"], "left").select("key", "tag", "n_words", "sha", (F.col("key") > F.col("first")).alias("copy")), "substring_base")
    reps = base.filter("not copy").select("key").distinct()
    phrases = _recurring(docs, reps, window, phrase)
    release(spark)
    ids = cut(phrases.select("key").distinct(), "phrase_ids")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    held = cut(docs.join(few, "key"), "phrase_texts")
    n = 2 * fan_out(spark)
    deal = F.pmod(F.xxhash64("key"), F.lit(n)).alias("bucket")

    def locate(a: pa.Table, b: pa.Table) -> pa.Table:
        return _locate(a, b, window, phrase)

    by_bucket = phrases.select(deal, "t").distinct().groupBy("bucket")
    located = cut(held.select(deal, "key", "tag", "text").groupBy("bucket").cogroup(by_bucket).applyInArrow(locate, LOCATED), "located")
    release(spark)
    asked = located.filter("t is not null").withColumn("at", F.pmod("t", F.lit(n)))
    late = asked.groupBy("at").applyInArrow(_later, "key long, tag long, lo long, hi long")
    spans = cut(located.filter("t is null").select("key", "tag", "lo", "hi").unionByName(late), "spans")
    return base, held, spans


def remove_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """key, tag, n_words, n_removed, kept_text (null where nothing went), kept_sha256 for every document."""
    base, held, spans = repeats(docs, window, phrase)
    per = spans.groupBy("key", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    changed = held.join(per, ["key", "tag"]).select("key", "tag", "text", "spans").mapInArrow(partial(_remove, window=window), "key long, tag long, n_removed long, kept_text string, kept_sha256 string")
    changed = changed.dropDuplicates(["key", "tag"])
    out = base.join(changed, ["key", "tag"], "left")
    copy = F.coalesce("copy", F.lit(False))
    return out.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"),
        "tag",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
