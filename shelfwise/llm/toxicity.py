"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel counts subsequences of four letters in common, with gaps: one that
spans s letters weighs GAP ** (s - 4), up to ``SPAN`` letters, so a word with
inserted letters keeps most of what it shares with the plain one. Letters are compared
after dropping whatever is no letter, and three or more single letters in a
row are one word, so spelled-out words look like plain ones. Instances are
windows of ``STARTS`` starts within a word; a word's value is its highest
window (a multiple-instance SVM), and a logistic function of a document's
``TOP`` highest words and its length gives its score.

Training uses a bounded sample of labelled documents (``SAMPLE`` a class, by
hash of the id, held-out rows never). Spark counts in how many toxic and clean
documents each word of their sentences stands; by its contexts (the two
neighbours) copies of a document count once. Words of many toxic and hardly any
clean documents give the positive instances, words of clean
documents the negative ones, at first by hash and then those that score
highest. Landmarks are picked from both by farthest-first traversal; windows
become kernel rows against them, whitened by the inverse root of the
landmarks' kernel matrix, and a squared-hinge linear SVM is fitted by Newton
steps. As kernel and SVM are linear in subsequences, the fitted function is
one table of their weights, and scoring looks up those of each distinct word
of whole texts.

Defined results: a null or wordless text gets the score of no evidence;
labels without a document, null labels and null ids are not learnt from; of
repeated labels the largest stands; if the sample lacks a class, every score
is 0 (no toxic rows) or 1 (only toxic rows); extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import cut
from .text import LOWER, SPACE, Texts, U, mix, texts, tidy

#: Labelled documents learnt from, a class.
SAMPLE = 3000
GAP = 0.6
SPAN = 7
STARTS = 3
LENGTH, STRIDE = 24, 12
#: Bytes of text whose words are held as letter rows at once.
SLICE = 1 << 20
BASE = 29
POSITIVE, NEGATIVE, HARD = 1500, 3000, 2000
LANDMARKS = 160
#: Fits at most, each with the highest clean words of the one before as further negatives.
ROUNDS = 3
PREDICT = 0.7

_CODE = np.zeros(256, np.uint8)
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CODE[0xC0:] = 27  # one code for each letter beyond ASCII
BEGIN = 28  # stands before the first letter of a word
#: Places of the second to fourth letter after the first, and the weight.
_FORMS = [(a, b, c, GAP ** (c - 3)) for c in range(3, SPAN) for b in range(2, c) for a in range(1, b)]


def words_of(src: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, letters): letter codes of every word of a slice, in rows of LENGTH; a longer word has overlapping rows."""
    data = LOWER[src.data]
    w = Texts(src.first, src.offsets, data).words(SPACE)
    code = _CODE[data]
    is_letter = code > 0
    upto = np.concatenate([[0], np.cumsum(is_letter)])
    letters = code[is_letter]
    a, b, row = upto[w.start], upto[w.end], w.row
    some = b > a
    a, b, row = a[some], b[some], row[some]
    one = b - a == 1
    joins = np.zeros(len(a), bool)
    joins[1:] = one[1:] & one[:-1] & (row[1:] == row[:-1])
    run = np.cumsum(~joins)
    joins &= np.bincount(run, minlength=len(a) + 2)[run] >= 3
    head = np.flatnonzero(~joins)
    begin, row = a[head], row[head]
    end = b[np.append(head[1:], len(a)) - 1] if len(head) else b
    # A place for BEGIN before each word.
    letters = np.insert(letters, begin, BEGIN)
    shift = np.arange(len(begin))
    begin, end = begin + shift, end + shift + 1
    size = end - begin
    pieces = np.maximum(1, -(-(size - (LENGTH - STRIDE)) // STRIDE))
    which = np.repeat(np.arange(len(size)), pieces)
    begin = begin[which] + STRIDE * (np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    size = np.minimum(end[which] - begin, LENGTH)
    out = np.zeros((len(which), LENGTH), np.uint8)
    r = np.repeat(np.arange(len(which)), size)
    c = np.arange(len(r)) - np.repeat(np.cumsum(size) - size, size)
    out[r, c] = letters[begin[r] + c]
    return row[which], out


def keys_of(letters: np.ndarray) -> np.ndarray:
    x = np.ascontiguousarray(letters).view("<u8")
    h = np.zeros(len(letters), U)
    for j in range(x.shape[1]):
        h = mix((h ^ x[:, j]) * U(0x9E3779B97F4A7C15) + U(1))
    return h


def _windows(letters: np.ndarray) -> int:
    """Windows of a row: as many as have all their starts in it, one at least."""
    return np.maximum(1, (letters > 0).sum(1) - STARTS - 2)


def value(letters: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """The SVM's value of each word: that of its highest window."""
    x = letters.astype(np.int32)
    starts = np.zeros((len(x), LENGTH + STARTS), np.float32)
    for i, j, k, weight in _FORMS:
        n = LENGTH - k
        starts[:, :n] += np.float32(weight) * table[((x[:, :n] * BASE + x[:, i : i + n]) * BASE + x[:, j : j + n]) * BASE + x[:, k:]]
    total = np.concatenate([np.zeros((len(x), 1), np.float32), np.cumsum(starts, axis=1)], axis=1)
    sums = total[:, STARTS : STARTS + LENGTH] - total[:, :LENGTH]
    sums[np.arange(LENGTH)[None, :] >= _windows(letters)[:, None]] = -np.inf
    return sums.max(1) + np.float32(bias)


class Model:
    """Subsequence weights, bias and the logistic weights of a document's evidence; or one constant score."""

    def __init__(self, table: np.ndarray | None, bias: float = 0.0, weights: np.ndarray | None = None, constant: float | None = None):
        self.table, self.bias, self.weights, self.constant = table, bias, weights, constant

    def probability(self, seen: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(seen), self.constant)
        return 1 / (1 + np.exp(-np.clip(seen @ self.weights[:-1] + self.weights[-1], -40, 40)))


#: Word values are held within -LIMIT and LIMIT as evidence; the lower end stands for a word that a text lacks.
LIMIT = 1.5
#: Highest words of a document that are its evidence, besides its length: a stray word alike to an insult stands alone.
TOP = 3
_SEEN: dict[int, tuple[np.ndarray, np.ndarray]] = {}
CACHE_WORDS = 1 << 20


def evidence(src: Texts, model: Model) -> np.ndarray:
    """The TOP highest word values of each row and the logarithm of its length in words.

    Each distinct word is valued once while this worker remembers it.
    """
    out = np.full((src.n, TOP + 1), -LIMIT)
    out[:, TOP] = 0
    if model.table is None:
        return out
    row, letters = words_of(src)
    if not len(row):
        return out
    h, first, back = np.unique(keys_of(letters), return_index=True, return_inverse=True)
    name = hash((model.table.tobytes(), model.bias)) if not hasattr(model, "_name") else model._name
    model._name = name
    keys, values = _SEEN.get(name, (np.zeros(0, U), np.zeros(0, np.float32)))
    if len(keys) > CACHE_WORDS:
        keys, values = keys[:0], values[:0]
    at = np.searchsorted(keys, h)
    known = np.zeros(len(h), bool)
    inside = at < len(keys)
    known[inside] = keys[at[inside]] == h[inside]
    new = np.flatnonzero(~known)
    mine = np.empty(len(h), np.float32)
    mine[known] = values[at[known]]
    for lo in range(0, len(new), 1 << 15):
        some = new[lo : lo + (1 << 15)]
        mine[some] = value(letters[first[some]], model.table, model.bias)
    if len(new):
        keys, values = np.insert(keys, at[new], h[new]), np.insert(values, at[new], mine[new])
        _SEEN.clear()
        _SEEN[name] = (keys, values)
    worth = np.clip(mine[back].astype(np.float64), -LIMIT, LIMIT)
    order = np.argsort(-worth, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    row, worth = row[order], worth[order]
    count = np.bincount(row, minlength=src.n)
    place = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    top = place < TOP
    out[row[top], place[top]] = worth[top]
    out[:, TOP] = np.log1p(count) / 10
    return out


@tidy
def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for src in texts(batch.column("text"), SLICE):
            seen = evidence(src, model)
            cols = [batch.column("doc_id").slice(src.first, src.n), pa.array(seen[:, 0]), pa.array(model.probability(seen))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "best", "score"])


@tidy
def _sentence_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of the sampled documents with a hash of its two neighbours."""
    for batch in batches:
        toxic, doc = np.asarray(batch.column("toxic")), np.asarray(batch.column("doc_id"))
        for src in texts(batch.column("text"), SLICE):
            row, letters = words_of(src)
            h = keys_of(letters)
            left, right = np.zeros(len(h), U), np.zeros(len(h), U)
            left[1:] = np.where(row[1:] == row[:-1], h[:-1], U(0))
            right[:-1] = np.where(row[1:] == row[:-1], h[1:], U(0))
            context = mix(mix(left + U(1)) ^ right)
            body = letters.tobytes()
            words = [body[i * LENGTH : (i + 1) * LENGTH] for i in range(len(h))]
            cols = [pa.array(words, pa.binary()), pa.array(context.view(np.int64)), pa.array(toxic[src.first + row].astype(np.int64)), pa.array(doc[src.first + row])]
            yield pa.RecordBatch.from_arrays(cols, ["word", "context", "toxic", "doc_id"])


def word_counts(chosen: DataFrame) -> DataFrame:
    """word, in_toxic, in_clean: in how many different documents a word stands.

    Each context of a word counts for the first document that has it: copies, which share
    their contexts, count once together, and so does a word that one document repeats.
    """
    seen = chosen.mapInArrow(_sentence_words, "word binary, context long, toxic long, doc_id long")
    first = seen.groupBy("word", "context", "toxic").agg(F.min("doc_id").alias("doc"))
    once = first.select("word", "toxic", "doc").distinct()
    return once.groupBy("word").agg(F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_clean"))


@tidy
def _value_words(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = value(_letters(batch.column("word").to_pylist()), model.table, model.bias) if batch.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(found.astype(np.float64))], ["word", "f"])


def _letters(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(-1, LENGTH)


def features(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequences, weights) of every window."""
    n = _windows(letters)
    word = np.repeat(np.arange(len(letters)), n)
    a = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    wide = np.zeros((len(letters), LENGTH + STARTS + SPAN), np.int32)
    wide[:, :LENGTH] = letters
    idx, weight = [], []
    for s in range(STARTS):
        x = wide[word, a + s]
        for i, j, k, g in _FORMS:
            last = wide[word, a + s + k]
            idx.append(((x * BASE + wide[word, a + s + i]) * BASE + wide[word, a + s + j]) * BASE + last)
            weight.append(np.where(last > 0, np.float32(g), np.float32(0)))
    return word, np.stack(idx, 1), np.stack(weight, 1)


def _table(idx: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return np.bincount(idx.ravel(), weight.ravel(), BASE**4).astype(np.float32)


def _landmarks(idx: np.ndarray, weight: np.ndarray, k: int) -> list[int]:
    """Farthest-first choice of windows by kernel cosine."""
    norm = np.empty(len(idx))
    for lo in range(0, len(idx), 500):
        i, g = idx[lo : lo + 500], weight[lo : lo + 500]
        norm[lo : lo + 500] = np.sqrt(((i[:, :, None] == i[:, None, :]) * g[:, :, None] * g[:, None, :]).sum((1, 2)))
    use = np.flatnonzero(norm > 0)
    idx, weight, norm = idx[use], weight[use], norm[use]
    chosen: list[int] = []
    near = np.zeros(len(use))
    while len(chosen) < min(k, len(use)):
        nxt = int(near.argmin())
        if chosen and near[nxt] > 0.999:
            break
        chosen.append(nxt)
        near = np.maximum(near, (_table(idx[nxt], weight[nxt])[idx] * weight).sum(1) / (norm * norm[nxt]))
    return use[chosen].tolist()


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by Newton steps on the active rows."""
    z = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(z.shape[1])
    reg = np.full(z.shape[1], ridge)
    reg[-1] = 1e-6
    for _ in range(30):
        active = y * (z @ w) < 1
        za, ca = z[active], cost[active]
        new = np.linalg.solve(za.T @ (za * ca[:, None]) + np.diag(reg), za.T @ (ca * y[active]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _lowest(by: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The window of each word with the least ``by``."""
    order = np.lexsort((by, word))
    return order[np.concatenate([[True], word[order][1:] != word[order][:-1]])]


def fit_table(positive: np.ndarray, counts: np.ndarray, negative: np.ndarray, landmarks: int = LANDMARKS) -> tuple[np.ndarray, float]:
    """Triple weights and bias from letter rows of positive words (with their document counts) and negative ones."""
    pw, pi, pg = features(positive)
    _, ni, ng = features(negative)
    # At first, of each positive word the window that is rarest among negative words.
    usual = np.log1p(_table(ni, ng))
    rare = _lowest((usual[pi] * pg).sum(1) / np.maximum(pg.sum(1), 1e-9), pw)
    top = rare[:1000]
    marks = [(pi[top[i]], pg[top[i]]) for i in _landmarks(pi[top], pg[top], landmarks // 3)]
    # Of negative words, their windows nearest to what is rare among them: these must be told apart.
    near = np.argsort(-(_table(pi[top], pg[top])[ni] * ng).sum(1), kind="stable")[:3000]
    marks += [(ni[near[i]], ng[near[i]]) for i in _landmarks(ni[near], ng[near], landmarks - len(marks))]
    columns = []
    for i, g in marks:
        t = _table(i, g)
        columns.append([(t[a] * b).sum(1) for a, b in ((pi, pg), (ni, ng), (np.stack([m[0] for m in marks]), np.stack([m[1] for m in marks])))])
    kp, kn, kmm = (np.stack(c, 1).astype(np.float64) for c in zip(*columns, strict=True))
    values, vectors = np.linalg.eigh(kmm)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    xp, xn = kp @ root, kn @ root
    witness = rare
    for _ in range(3):
        x = np.concatenate([xp[witness], xn])
        y = np.concatenate([np.ones(len(witness)), -np.ones(len(xn))])
        weight = np.minimum(counts[pw[witness]], 50).astype(np.float64)
        cost = np.concatenate([weight / weight.sum(), np.full(len(xn), 1 / len(xn))]) * len(xn)
        w, bias = svm(x, y, cost)
        witness = _lowest(-(xp @ w), pw)  # then its highest window
    alpha = root @ w
    return _table(np.stack([m[0] for m in marks]), np.stack([a * m[1] for a, m in zip(alpha, marks, strict=True)])), bias


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights and shift of evidence rows, by Newton steps on Platt's smoothed targets; both classes weigh the same."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y == 1, 0.5 / max(1, pos), 0.5 / max(1, neg)) * len(y)
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (weight * (p - target)) + 1e-2 * w
        step = np.linalg.solve(z.T @ (z * (weight * p * (1 - p))[:, None]) + 1e-2 * np.eye(len(w)), grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from at most ``sample`` labelled documents a class, never from held-out ones."""
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    parts = [known.filter(F.col("toxic") == t).orderBy(order, "doc_id").limit(sample) for t in (1, 0)]
    ids = cut(parts[0].unionByName(parts[1]), "toxic_sample")  # at most 2 * sample rows
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    chosen = cut(chosen, "toxic_texts")
    found = {r["toxic"]: r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (found.get(1) and found.get(0)):
        return Model(None, constant=1.0 if found.get(1) else 0.0)
    words = cut(word_counts(chosen), "toxic_words")
    total = words.agg(F.sum("in_toxic"), F.sum("in_clean"), F.count("*")).first()
    if not (total[0] and total[1]):
        return Model(None, constant=0.0)
    share, chance = total[1] / total[0], total[0] / (total[0] + total[1])
    # Of all words, less than one that stands at random would stand so often in toxic documents alone.
    least = max(2, min(int(np.ceil(np.log(total[2] + 1) / -np.log(chance))), found[1] // 4))
    strong = words.filter((F.col("in_toxic") >= least) & (F.col("in_toxic") * share > 50 * F.col("in_clean")))
    strong = strong.orderBy(F.desc("in_toxic"), "word").limit(POSITIVE).collect()
    clean = words.filter("in_clean > 0")
    negative = [r["word"] for r in clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVE).collect()]
    if not strong or not negative:
        return Model(None, constant=0.0)
    positive, counts = _letters([r["word"] for r in strong]), np.array([r["in_toxic"] for r in strong])
    for _ in range(ROUNDS):
        table, bias = fit_table(positive, counts, _letters(negative))
        model = Model(table, bias)
        hard = clean.select("word").mapInArrow(partial(_value_words, model=model), "word binary, f double").orderBy(F.desc("f"), "word").limit(HARD)
        hard = hard.collect()
        if not hard or hard[0]["f"] < 0:
            break
        negative = list(dict.fromkeys([*(r["word"] for r in hard), *negative]))[: NEGATIVE + 2 * HARD]
    # At most 2 * sample rows.
    seen = chosen.select("doc_id", "text", "toxic").mapInArrow(partial(_evidence, model=model), "toxic int, seen array<double>").toPandas()
    return Model(table, bias, logistic(np.stack(seen["seen"].to_list()), seen["toxic"].to_numpy()))


@tidy
def _evidence(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for src in texts(batch.column("text"), SLICE):
            seen = pa.array(list(evidence(src, model)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(src.first, src.n), seen], ["toxic", "seen"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every document."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text.mapInArrow(partial(_score, model=model), "doc_id long, best double, score double")


@tidy
def _keep(batches: Iterator[pa.RecordBatch], model: Model, below: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = np.ones(batch.num_rows, bool)
        for src in texts(batch.column("text"), SLICE):
            ok[src.first : src.first + src.n] = model.probability(evidence(src, model)) < below
        yield batch.filter(pa.array(ok))


def keep_clean(docs: DataFrame, model: Model, below: float = PREDICT) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under ``below``."""
    return docs.mapInArrow(partial(_keep, model=model, below=below), docs.schema)
