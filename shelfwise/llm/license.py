"""Licence scans: exact set-similarity join of text blocks with licence templates.

A block is a piece of 64 words, which overlap by 32, of a line or of the whole
text: every template has at most 32 words, so a notice that is wrapped over lines lies within
one piece of the text. A block meets a template if it holds at least ``percent`` of the template's distinct words.
Words are ordered by their frequency over all blocks of the corpus, rarest
first. A block that meets a template of m words, c of which it needs, holds
one of the template's first m - c + 1 words (prefix filter), holds at least c
words of the vocabulary (length filter), and after the first common word at
places p and q both still have c - 1 more (positional filter). Blocks that
pass are counted exactly. The templates, their order and their index are
bounded by the template list; documents stream past them.

Besides, the places of the base phrases are counted word by word.

Defined results: a null or empty text has no words, empty labels and score 0;
repeated rows are scanned one by one; extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import NON_ALNUM, Words, texts

#: Base phrases and their labels (fixed values).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Customary notices of public licences (fixed values).
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under creative commons attribution 4 0 international"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "free and unencumbered software released into the public domain"),
]
#: Words without which a notice is another licence's: most of its other words stand in that one too (fixed values).
TELLING = {"lgpl": {"lesser"}, "cc-by-nc": {"nc"}}
PERCENT = 80
PIECE, STRIDE = 64, 32


def word_hashes(words: list[str]) -> np.ndarray:
    src = next(texts(pa.array([" ".join(words)])))
    return src.words(NON_ALNUM).hashes()


class Index:
    """The templates as sets in one order, and the words that can open a match."""

    def __init__(self, templates: list[tuple[str, str]], percent: int, frequency: dict[str, int]):
        rank = {w: i for i, w in enumerate(sorted({w for _, t in templates for w in t.split()}, key=lambda w: (frequency.get(w, 0), w)))}
        self.percent = percent
        self.labels = [label for label, _ in templates]
        self.sets = [sorted(rank[w] for w in set(t.split())) for _, t in templates]
        self.need = [-(-len(s) * percent // 100) for s in self.sets]
        hashes = word_hashes(list(rank))
        order = np.argsort(hashes)
        self.hashes, self.ranks = hashes[order], order  # words are listed by rank
        self.opens: dict[int, list[tuple[int, int]]] = {}
        for i, (s, c) in enumerate(zip(self.sets, self.need, strict=True)):
            for p, x in enumerate(s[: len(s) - c + 1]):
                self.opens.setdefault(x, []).append((i, p))
        self.is_open = np.zeros(len(rank), bool)
        self.is_open[list(self.opens)] = True
        self.members = [set(s) for s in self.sets]
        self.telling = [{rank[w] for w in TELLING.get(label, ()) if w in rank} for label in self.labels]

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Rank of each word; -1 outside the vocabulary."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.ranks[at], -1)

    def meets(self, block: list[int]) -> list[tuple[int, int]]:
        """(template, words in common) of every template that the block (ascending ranks) meets."""
        out, tried = [], set()
        n = len(block)
        for q, x in enumerate(block):
            for i, p in self.opens.get(x, ()):
                m, c = len(self.sets[i]), self.need[i]
                if i in tried or n < c:
                    continue
                tried.add(i)  # the first common word decides, for both lists ascend
                if 1 + min(m - p - 1, n - q - 1) >= c:
                    common = len(self.members[i].intersection(block))
                    if common >= c and self.telling[i].issubset(block):
                        out.append((i, common))
        return out


def _pieces(begin: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, block) for the words of ``inside``: a block number per run of words, which begins at ``begin``, and piece."""
    piece = (inside - begin[inside]) // STRIDE
    base = begin[inside] * 2
    word = np.concatenate([inside, inside[piece > 0]])
    return word, np.concatenate([base + piece, (base + piece - 1)[piece > 0]])


def _blocks(w: Words, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, block) for the words of ``inside`` (word numbers): a block number per row, line and piece, and per row of several lines and piece."""
    lines = np.flatnonzero(w.src.data == 0x0A)
    line = np.searchsorted(lines, w.start) + w.row  # rows part lines too
    first = np.ones(len(w), bool)
    first[1:] = line[1:] != line[:-1]
    word, block = _pieces(np.maximum.accumulate(np.where(first, np.arange(len(w)), 0)), inside)
    wrapped = np.bincount(w.row[first], minlength=w.src.n) > 1  # of other rows, the text is the line
    whole, more = _pieces(w.first[w.row], inside[wrapped[w.row[inside]]])
    return np.concatenate([word, whole]), np.concatenate([block, more + 2 * len(w) + 2])


def _count(batches: Iterator[pa.RecordBatch], vocabulary: list[str]) -> Iterator[pa.RecordBatch]:
    """How many blocks hold each word of the vocabulary."""
    hashes = word_hashes(vocabulary)
    order = np.argsort(hashes)
    total = np.zeros(len(vocabulary), np.int64)
    for batch in batches:
        for src in texts(batch.column("text")):
            w = src.lowered().words(NON_ALNUM)
            h = w.hashes()
            at = np.minimum(np.searchsorted(hashes[order], h), len(hashes) - 1)
            inside = np.flatnonzero(hashes[order][at] == h)
            word, block = _blocks(w, inside)
            pair = np.unique(block * len(vocabulary) + order[at[word]])
            total += np.bincount(pair % len(vocabulary), minlength=len(vocabulary))
    yield pa.RecordBatch.from_arrays([pa.array(vocabulary), pa.array(total)], ["word", "n"])


SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan(batches: Iterator[pa.RecordBatch], index: Index, base: dict[str, str]) -> Iterator[pa.RecordBatch]:
    phrases = [(word_hashes(p.split()), label) for p, label in base.items()]
    for batch in batches:
        doc_id = batch.column("doc_id")
        for src in texts(batch.column("text")):
            w = src.lowered().words(NON_ALNUM)
            h = w.hashes()
            n = np.zeros(src.n, np.int64)
            low = np.full(src.n, len(w) + 1, np.int64)
            high = np.full(src.n, -1, np.int64)
            base_labels: dict[int, set] = {}
            labels: dict[int, set] = {}
            score = np.zeros(src.n)
            for forms, label in phrases:
                at = np.flatnonzero(h == forms[0])
                at = at[w.at[at] + len(forms) <= w.count[w.row[at]]]
                for j in range(1, len(forms)):
                    at = at[h[at + j] == forms[j]]
                row = w.row[at]
                n += np.bincount(row, minlength=src.n)
                np.minimum.at(low, row, w.at[at])
                np.maximum.at(high, row, w.at[at])
                for r in np.unique(row).tolist():
                    base_labels.setdefault(r, set()).add(label)
            rank = index.lookup(h)
            inside = np.flatnonzero(rank >= 0)
            if len(inside):
                word, block = _blocks(w, inside)
                known, number = np.unique(block, return_inverse=True)
                opened = np.zeros(len(known), bool)
                opened[number[index.is_open[rank[word]]]] = True
                mine = np.flatnonzero(opened[number])
                mine = mine[np.lexsort((rank[word[mine]], number[mine]))]
                cuts = np.flatnonzero(np.diff(number[mine])) + 1
                for part in np.split(mine, cuts) if len(mine) else []:
                    r = int(w.row[word[part[0]]])
                    for i, common in index.meets(np.unique(rank[word[part]]).tolist()):
                        labels.setdefault(r, set()).add(index.labels[i])
                        score[r] = max(score[r], common / len(index.sets[i]))
            cols = [doc_id.slice(src.first, src.n), pa.array(w.count.astype(np.int64)), pa.array(n)]
            cols += [pa.array(x, mask=n == 0) for x in (low, high)]
            cols.append(pa.array([",".join(sorted(base_labels.get(r, ()))) for r in range(src.n)], pa.string()))
            cols.append(pa.array([",".join(sorted(base_labels.get(r, set()) | labels.get(r, set()))) for r in range(src.n)], pa.string()))
            cols.append(pa.array(score))
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in SCAN.split(", ")])


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, percent: int = PERCENT, base: dict[str, str] = BASE) -> DataFrame:
    """One row per document: words, base phrase places and labels, all labels, and the best containment found."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vocabulary = sorted({x for _, t in templates for x in t.split()})
    counts = text.select("text").mapInArrow(partial(_count, vocabulary=vocabulary), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = Counter({r["word"]: r["n"] for r in counts.collect()})  # one row per word of the templates
    index = Index(templates, percent, frequency)
    return text.mapInArrow(partial(_scan, index=index, base=base), SCAN)
