"""Decontamination, hard negatives and the prefix trie against brute force, on odd rows as well."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import covertree, trie, winnowing
from shelfwise.llm.covertree import Windows, candidates, descend, grow, hard_negatives
from shelfwise.llm.trie import prefix_trie
from shelfwise.llm.winnowing import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum(text):
    return WORD.findall((text or "").translate(LOWER))


def contaminated(docs, items):
    """(doc_id, n_words, n_hit, n_items, hash, flag) of each row."""
    held = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        t = min(10, len(w))
        for i in range(len(w) - t + 1 if w and item is not None else 0):
            held[tuple(w[i : i + t])].add(str(item))
    sizes = {len(g) for g in held}
    out = Counter()
    for doc, text in docs:
        w = alnum(text)
        hit, found = set(), set()
        for t in sizes:
            for i in range(len(w) - t + 1):
                got = held.get(tuple(w[i : i + t]))
                if got:
                    hit |= set(range(i, i + t))
                    found |= got
        out[doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    return out


def leak_rows(seed=5, short=True):
    r = random.Random(seed)
    vocab = ["The", "of", "naïve", "Straße", "x1", "É", "don't"] + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choices(vocab, k=r.choice([10, 11, 25, 40])))) for i in range(20)]
    items += [(20, items[3][1] + " tail"), (21, items[3][1]), (3, "another text of the same id with ten words or more here"), (None, "nobody's item has words that no one will ever find again at all"), (30, None), (31, " .. "), (32, "a " * 30)]
    items += [(40, "rare1"), (41, "two rare"), (42, "one two three four five"), (43, "just nine words in here to be found now")] if short else []
    docs = []
    for i in range(120):
        w = r.choices(vocab, k=r.choice([0, 1, 5, 9, 10, 60, 300]))
        if i % 3 == 0:
            source = items[r.randrange(20)][1].split()
            a = r.randrange(len(source))
            w[len(w) // 2 : len(w) // 2] = source[a : a + r.choice([9, 10, 12, 40])]
        docs.append((i, r.choice([" ", ", ", "\n", " - "]).join(w)))
    hot = items[5][1]
    docs += [(200 + i, f"x{i} y{i} {hot} z{i}") for i in range(40)]  # a passage that many share
    docs += [(300, None), (301, ""), (302, " \n"), (303, "rare1"), (304, "Two RARE one two three four five rare1 rare1"), (305, "just nine words in here to be found now"), (306, "a " * 5000), (307, "x" * 20000), (308, hot.upper()), (None, hot), (None, None)]
    docs += [docs[0], docs[0], (1, hot)]  # repeated rows, and an id with another text
    return docs, items


DOCS = "doc_id long, text string, t int, v long, row long, window string, hits string, item string, n_words long"
ITEMS = "item_id long, text string, t int, wid long, item string"


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, *[None] * 7) for d in docs], DOCS).repartition(3), spark.createDataFrame([(*i, *[None] * 3) for i in items], ITEMS).repartition(2)


RESULT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("short", [True, False])
def test_contamination(spark, short):
    docs, items = leak_rows(short=short)
    got = contamination(*frames(spark, docs, items)).collect()
    assert Counter(tuple(r[c] for c in RESULT) for r in got) == contaminated(docs, items)
    assert all(r["n_hit"] == sum(s["end"] - s["first"] for s in r["spans"]) for r in got)


def test_contamination_by_shuffle(spark, monkeypatch):
    """With windows too many to be broadcast, and a bitmap that lets every fingerprint pass."""
    docs, items = leak_rows(seed=6)
    monkeypatch.setattr(winnowing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(winnowing, "BITS", 64)
    got = contamination(*frames(spark, docs, items)).collect()
    assert Counter(tuple(r[c] for c in RESULT) for r in got) == contaminated(docs, items)


def test_contamination_without_rows(spark):
    docs, items = leak_rows()
    assert contamination(*frames(spark, [], items)).count() == 0
    got = contamination(*frames(spark, docs, [])).collect()
    assert Counter(tuple(r[c] for c in RESULT) for r in got) == contaminated(docs, [])


def test_winnowing_keeps_a_fingerprint_of_every_shared_span(spark):
    """Far fewer fingerprints than k-grams, and one in every window of SPAN words."""
    df = spark.createDataFrame([(" ".join(f"w{random.Random(7 * i).randrange(10**6)}" for i in range(3000)),)], "text string")
    k = winnowing._k(winnowing.SPAN)
    run = winnowing.SPAN - k + 1
    g = winnowing._grams(winnowing.words(F.col("text")), k)
    grams, minima = df.select(g, winnowing._minima(g, run)).first()
    assert minima == [min(grams[i : i + run]) for i in range(len(grams) - run + 1)]
    assert len(grams) == 3000 - k + 1 and len(set(minima)) < 0.4 * len(grams)


def test_contamination_rests_on_fingerprints(spark, monkeypatch):
    """Nothing is found when no fingerprint is kept: there is no other way to a hit."""
    docs, items = leak_rows()
    none = ",".join(["0"] * (winnowing.BITS // 64))
    monkeypatch.setattr(winnowing, "bitmap", lambda prints: F.split(F.lit(none), ",").cast("array<long>"))
    assert contamination(*frames(spark, docs, items)).filter("contaminated").count() == 0


# --- hard negatives


def mined(rows, n_pos=5, n_neg=3):
    """Result rows by brute force; rows: (vec_id, label, ints)."""
    out = []
    for a, la, va in rows:
        if a % 50:
            continue
        score = sorted((-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in rows if i != a)
        for p, pos, lab in [x for x in score if x[2] == la][:n_pos]:
            fits = [(n, i) for n, i, other in score if other != la and 50 * -p <= 100 * -n <= 95 * -p][:n_neg]
            out += [(a, pos, r, i, -p, -n) for r, (n, i) in enumerate(fits, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label long, v int, block int, n int, which int"


def vector_rows(n, dims, seed, spread=None):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dims))
    x = r.normal(size=(n, dims)) if spread is None else centres[r.integers(12, size=n)] + spread * r.normal(size=(n, dims))
    x = (x / dims**0.5).astype(np.float32)
    label = np.where(r.random(n) < 0.4, 1, r.integers(6, size=n))
    rows = [[i, [float(y) for y in x[i]], int(label[i])] for i in range(n)]
    for i in range(1, n, 9):
        rows[i][1] = rows[0][1]  # one very common vector: ties
    rows[7][1], rows[8][1], rows[10][2] = None, [None] + rows[8][1][1:], None
    rows[11][1] = [float("nan")] + rows[11][1][1:]
    rows[12][1] = [float("inf")] + rows[12][1][1:]
    rows[13][1] = [0.0] * dims
    rows[50][1] = [0.0] * dims  # an anchor whose products are all zero
    rows[14][1] = rows[14][1][:3]
    return [tuple(x) for x in rows] + [(None, rows[0][1], 1), tuple(rows[2]), tuple(rows[2])]


def ints(rows):
    good = {}
    for i, e, lab in rows:
        if i is None or e is None or lab is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        good[i] = (i, lab, [int(np.floor(256.0 * x)) for x in e])
    return sorted(good.values())


@pytest.mark.parametrize("spread", [None, 0.1])
def test_hard_negatives(spark, spread):
    rows = vector_rows(420, 8, 3, spread)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS).repartition(3)
    want = mined(ints(rows))
    for size in (40, 4096):  # large and shared labels
        got = hard_negatives(candidates(df), F.col("vec_id") % 50 == 0, block_rows=size, anchor_rows=4)
        assert sorted(map(tuple, got.collect())) == want and len(want) > 20


def test_hard_negatives_without_rows(spark):
    df = spark.createDataFrame([], VECTORS)
    assert hard_negatives(candidates(df), F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 1, *[None] * 4)], VECTORS)
    assert hard_negatives(candidates(one), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("size", [250, 30_000, 40_000_000])  # products in floats, doubles and longs
def test_a_pack_of_anchors_descends_together(monkeypatch, size):
    """Two blocks of scattered rows: the second is met in a few matrix products, and results are those of brute force."""
    r = np.random.default_rng(9)
    v = r.integers(-size, size, (3000, 16))
    v[::7] = v[3]  # ties
    ids, label = r.permutation(3000), r.integers(4, size=3000)
    q, mine = v[:96], label[:96]
    score = q @ v.T
    top = np.sort(score, 1)[:, -8:-5]
    low, high = top // 2, top * 95 // 100
    low[5], high[5] = 1, 0  # no window
    found, calls = Windows(low, high, 3), []
    add = Windows.add
    monkeypatch.setattr(Windows, "add", lambda self, *a: (calls.append(a[1].shape), add(self, *a)))
    for block in (np.arange(1500), np.arange(1500, 3000)):
        calls.clear()
        open_ = label[block] != mine[:, None]
        own = np.arange(96) if block[0] == 0 else np.full(96, -1)
        descend(grow(v[block]), v[block], ids[block], open_, q, found, own=own)
    assert len(calls) <= 2 and sum(a * b for a, b in calls) <= 96 * 1500
    for a in range(96):
        for j in range(3):
            fits = np.flatnonzero((label != mine[a]) & (score[a] >= low[a, j]) & (score[a] <= high[a, j]))
            best = fits[np.lexsort((ids[fits], -score[a][fits]))[:3]]
            assert found.ids[3 * a + j].tolist() == ids[best].tolist()
    assert sum(len(x) > 0 for x in found.ids) > 200


def test_what_one_block_gave_spares_the_next():
    """Blocks of the same clusters: once its windows are filled, a pack reads far fewer points."""
    r = np.random.default_rng(11)
    centres = r.normal(size=(60, 16)) * 1000
    blocks = [np.floor(centres[r.integers(60, size=4000)] + 20 * r.normal(size=(4000, 16))).astype(np.int64) for _ in range(2)]
    q = np.floor(centres[0] + 20 * r.normal(size=(64, 16))).astype(np.int64)
    high = (0.8 * (blocks[0] @ q.T).max(0)).astype(np.int64)[:, None]
    found = Windows(np.full((64, 1), -(1 << 62)), high, 5)
    seen = [descend(grow(v), v, b * 4000 + np.arange(4000), np.ones(4000, bool), q, found) for b, v in enumerate(blocks)]
    assert seen[1] < 0.25 * 64 * 4000
    v = np.concatenate(blocks)
    for a in range(64):
        score = v @ q[a]
        fits = np.flatnonzero(score <= high[a])
        assert found.ids[a].tolist() == fits[np.lexsort((fits, -score[fits]))[:5]].tolist()


@pytest.mark.parametrize("products, bytes_", [(300, 80 << 20), (1 << 27, 2000)])
def test_hard_negatives_in_cells(spark, monkeypatch, products, bytes_):
    """Anchors dealt to packs and blocks to chunks; an anchor brings its best of a chunk, not of each block."""
    rows = vector_rows(420, 8, 3)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS).repartition(3)
    want, made, meetings = mined(ints(rows)), [], covertree._meetings
    monkeypatch.setattr(covertree, "CELL_PRODUCTS", products)
    monkeypatch.setattr(covertree, "CELL_BYTES", bytes_)
    monkeypatch.setattr(covertree, "CELLS_PER_CORE", 2)
    monkeypatch.setattr(covertree, "_meetings", lambda *a: made.append((a[2].count(), meetings(*a))) or made[-1][1])
    got = hard_negatives(candidates(df), F.col("vec_id") % 50 == 0, block_rows=20, anchor_rows=4)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20
    cells = 8 if products == 300 else 1  # 2 for each of 4 cores
    best = made[1][1].groupBy("anchor_id", "which").count().agg(F.max("count")).first()[0]
    assert 3 <= best <= 3 * cells


def test_cover_tree_covers_separates_and_skips():
    r = np.random.default_rng(4)
    centres = r.normal(size=(60, 16)) * 1000
    v = np.floor(centres[r.integers(60, size=4000)] + 20 * r.normal(size=(4000, 16))).astype(np.int64)
    tree = grow(v)
    x, top = covertree.augmented(v)
    below = {}

    def members(at):
        mine = list(tree.points[tree.point_at[at] : tree.point_at[at + 1]])
        for kid in tree.kids[tree.kid_at[at] : tree.kid_at[at + 1]]:
            mine += members(kid)
        below[at] = mine
        return mine

    assert sorted(members(0)) == list(range(4000))
    for at, mine in below.items():
        assert np.sqrt(((x[mine] - x[tree.centre[at]]) ** 2).sum(1)).max() <= 2 * top * np.sin(tree.angle[at] / 2) + 1e-6
    ids, everything = np.arange(4000), np.ones(4000, bool)
    seen = 0
    for a in range(0, 4000, 100):
        score = v @ v[a]
        high = int(0.8 * score.max())
        for low in (-(1 << 62), high // 2):
            found = Windows(np.array([low]), np.array([high]), 5)
            seen += descend(tree, v, ids, everything, v[a], found)
            fits = np.flatnonzero((score >= low) & (score <= high))
            best = fits[np.lexsort((fits, -score[fits]))[:5]]
            assert found.ids[0].tolist() == best.tolist()
    assert seen < 0.25 * 80 * 4000  # on clustered rows most nodes lie outside a window or below what it holds


# --- prefix trie


def trie_brute(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if built[c] == list(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


TURNS = "conv_id long, turn long, role string, text string, place int, id long, ids string, size int, depth int"


def turn_rows(seed=2):
    r = random.Random(seed)
    texts = ["hello", "Grüße 🙂", "", None, "yes", "no", "a longer text " * 20]
    rows = []
    for c in [*range(0, 260), 405, 1207, -150, -100]:  # some without a base
        n = r.choice([1, 1, 2, 3, 6, 8])
        start = r.choice([["hello"], ["hello", "yes"], []])
        for t in range(n):
            text = start[t] if t < len(start) else r.choice(texts)
            rows.append((c, t, r.choice(["user", "user", "assistant", None]), text))
    rows += [(300 + i, t, "user", f"same {t}") for i in range(40) for t in range(7)]  # copies
    rows += [(700, t, "user", "deep" + str(t % 3)) for t in range(150)]
    rows += [(701, None, "user", "first"), (701, 1, "user", "tie b"), (701, 1, "user", "tie a"), (701, 1, None, "tie a"), (None, 1, "user", "lost")]
    return rows + rows[:5]


@pytest.mark.parametrize("shard,partitions", [(1, 8), (3, 8), (20_000, 8), (7, 1)])
def test_trie(spark, shard, partitions, monkeypatch):
    rows = turn_rows()
    monkeypatch.setattr(trie, "fan_out", lambda _: partitions)
    df = spark.createDataFrame([(*r, *[None] * 5) for r in rows], TURNS).repartition(4)
    got = prefix_trie(df, shard=shard).collect()
    assert Counter(map(tuple, got)) == trie_brute(rows)


def test_trie_of_few_rows(spark):
    assert prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    for rows in ([(None, 1, "a", "b")], [(5, 0, "user", "x")], [(1, 0, "user", "x"), (3, 0, "user", "x")], [(100, 0, None, None), (100, 1, "u", "long"), (107, 0, "u", "x"), (107, 9, "u", "x")]):
        got = prefix_trie(spark.createDataFrame([(*r, *[None] * 5) for r in rows], TURNS)).collect()
        assert Counter(map(tuple, got)) == trie_brute(rows)


def test_tree_is_balanced_by_median_insertion():
    tree, first, last = trie.build([([i], [1], 1, i, "") for i in range(1023)])
    deepest, todo = 0, [(tree.equal[0], 1)]
    while todo:
        x, d = todo.pop()
        if x >= 0:
            deepest = max(deepest, d)
            todo += [(tree.low[x], d + 1), (tree.high[x], d + 1)]
    assert deepest == 10 and tree.key[first] == 0 and tree.key[last] == 1022
