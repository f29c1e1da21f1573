"""The dealt operators against brute force, on rows with nulls, ties, repeats, odd texts and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import fixity, mixing, simple8b
from shelfwise.llm.jaccard import Points, jaccard_join, tree_pairs
from shelfwise.llm.license import TELLING, TEMPLATES, license_scan
from shelfwise.llm.mixing import described, leaders, mixed, probabilities
from shelfwise.llm.packing import pack, plan
from shelfwise.llm.quality import quality_rules
from shelfwise.llm.substrings import remove_repeats
from shelfwise.llm.token_output import read_tokens, write_tokens
from shelfwise.llm.tokens import Encoder
from shelfwise.llm.topk import quantised, top_k
from shelfwise.llm.toxicity import held_out, score, train

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, t long, key string, tag string, kept boolean, _words string, bucket int, tokens long"
GAP = re.compile(r"[\x20\x09-\x0D]+")
PATH = public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def corpus(seed=1, n=60):
    """Rows of DOCS: prose with copies, near copies, shared passages and odd rows."""
    r = random.Random(seed)
    vocab = ["alpha", "Beta", "the", "of", "naïve", "groß", "x1", "don't", "end."] + [f"w{i}" for i in range(300)]
    passage = " ".join(r.choices(vocab, k=60))
    texts = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and texts:
            texts.append(r.choice(texts))
        elif kind == 2 and texts:
            w = (r.choice(texts) or "x").split(" ")
            w[r.randrange(len(w))] = "edit"
            texts.append(" ".join(w))
        elif kind == 3:
            texts.append(" ".join(r.choices(vocab, k=30)) + "\n" + passage + "\t" + " ".join(r.choices(vocab, k=30)))
        else:
            texts.append(" ".join(r.choices(vocab, k=r.choice([1, 3, 4, 5, 19, 20, 21, 80, 200]))))
    texts += [None, "", " \n\t ", "the the the the the the", "a " * 3000 + passage, "x" * 5000, passage, passage, "ABC def", "abc DEF"]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s1", "s1", "s2", None]), len(t or "")) + (1, 2, "k", "g", True, "w", 3, 4) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[9]]  # repeated rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def without_id(spark):
    return spark.createDataFrame([(None, "one two three", None, None, None, *[None] * 8), (None, None, None, None, None, *[None] * 8), (7, "one two three", "en", "s", 1, *[None] * 8)], DOCS)


def test_quality_counts(docs, rows):
    got = Counter(tuple(r) for r in quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    want = []
    for doc_id, text, *_ in rows:
        w = words(text)
        n = Counter(zip(w, w[1:], w[2:]))
        cover = {i + k for i in range(len(w) - 2) if n[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        want.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)))
    assert got == Counter(want)


def test_quality_adapts(spark):
    r = random.Random(3)

    def clean(i):
        return " ".join(f"v{r.randrange(10**6)}" for _ in range(80))

    rows = [(i, clean(i) if i % 20 else " ".join(w + "###" for w in clean(i).split()), "en", f"s{i % 2}", 0, *[None] * 8) for i in range(600)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: bool(i % 20) for i in range(600)}


def test_token_files(docs, rows):
    enc = Encoder(PATH).model
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in read_tokens(write_tokens(docs, PATH, 1, file_ids=500)).collect())
    at, want = 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda x: x[0]):
        ids = np.array([*enc.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


@pytest.mark.parametrize("values", [[], [0] * 700, [1 << 62, 0, (1 << 59) - 1, 1 << 59, (1 << 64) - 1], list(range(5000)), [0, 0, 9] * 999])
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    assert (simple8b.unpack(*simple8b.pack(v), len(v)) == v).all()


def test_odd_chunks_tokenize_as_whole():
    enc = Encoder(PATH)
    import pyarrow as pa

    from shelfwise.llm.text import texts

    odd = ["H̱ x", "it's I'LL 'S", "<|endoftext|>a<|startoftext|>", "é ́x ≠ !̸", "１２３ 12ab", "a\x00b\x1fc\x85d", "KKİ", "Σας ΟΔΟΣ", "日本 …“q”—d", "É×÷ß", ""]
    for text in odd:
        ids, _ = enc.encode(next(texts(pa.array([text]))))
        assert ids.tolist() == enc.model.encode(text, add_special_tokens=False).ids


def jaccard_brute(rows, k=5):
    sets = {}
    for doc_id, text, *_ in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return Counter((d, len(sets[d]), find(d)) for d, *_ in rows)


def links_brute(rows, k=5):
    sets = []
    for _, text, *_ in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    n = [0] * len(rows)
    for i, j in combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
            n[i] += 1
            n[j] += 1
    return Counter((r[0], n[i]) for i, r in enumerate(rows))


def test_jaccard(docs, rows):
    assert Counter(tuple(r) for r in jaccard_join(docs).collect()) == jaccard_brute(rows)
    got = jaccard_join(docs, count_links=True).collect()
    assert Counter(tuple(r)[:3] for r in got) == jaccard_brute(rows)
    assert Counter((r.doc_id, r.n_links) for r in got) == links_brute(rows)


def test_jaccard_keeps_links_within_a_component(spark):
    """A chain of edits: every text is linked with its near ones only, and a group beyond a tile loses no link."""
    r = random.Random(11)
    base = [f"w{r.randrange(10**6)}" for _ in range(400)]
    rows = []
    for i in range(700):
        w = list(base)
        for at in range(i // 50):
            w[at * 20] = f"e{at}"
        w[399] = f"own{i % 600}"
        rows.append((i, " ".join(w), *[None] * 11))
    got = jaccard_join(spark.createDataFrame(rows, DOCS).repartition(4), count_links=True).collect()
    assert Counter((x.doc_id, x.n_links) for x in got) == links_brute(rows)
    assert len({x.component_id for x in got}) == 1 and len({x.n_links for x in got}) > 3


def test_tree_finds_all_bounded_pairs():
    r = np.random.default_rng(0)
    sets = [r.choice(4000, size=s, replace=False) for s in r.integers(20, 60, 150)]
    sets += [np.append(s[:-1], 9999) for s in sets[:40]]
    raw = [bytes([2]) + np.bincount(s % 32, minlength=32).astype("<u2").tobytes() for s in sets]
    points = Points(raw)
    every = np.arange(len(sets))
    a, b = tree_pairs(points, 80, every, every)
    x, y = np.triu_indices(len(sets), 1)
    ok = points.passing(x, y, 80)
    assert {p for p in zip(a.tolist(), b.tolist()) if p[0] < p[1]} == set(zip(x[ok].tolist(), y[ok].tolist()))
    assert {(i, 150 + i) for i in range(40)} <= set(zip(x[ok].tolist(), y[ok].tolist()))


def test_plan_keeps_every_piece_and_is_tight():
    r = random.Random(5)
    for capacity, lengths in ((10, [10, 9, 1, 5, 5, 5, 7, 2, 2, 3]), (100, [r.randint(1, 100) for _ in range(400)]), (100, [51] * 9 + [34] * 9), (7, [])):
        bins = plan(dict(Counter(lengths)), capacity)
        assert Counter(x for b, n in bins for x in b * n) == Counter(lengths)
        assert all(sum(b) <= capacity and n > 0 for b, n in bins)
        assert sum(n for _, n in bins) <= max(-(-sum(lengths) // capacity) * 1.05 + 1, sum(2 * x > capacity for x in lengths))


def test_packing(docs, rows):
    enc = Encoder(PATH).model
    got = [r.asDict() for r in pack(docs, PATH, 0, capacity=64).collect()]
    want = []
    for doc_id, text, *_ in rows:
        ids = np.array([*enc.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(doc_id, i // 64, i, len(ids[i : i + 64]), zlib.crc32(ids[i : i + 64].tobytes())) for i in range(0, len(ids), 64)]
    assert Counter(tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == Counter(want)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in by.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 64
    assert len(by) <= -(-sum(r["length"] for r in got) // 64) + 2


def substrings_brute(rows, size=20):
    seqs = sorted({(d, tuple(words(t))) for d, t, *_ in rows})
    first = {}
    for d, w in seqs:
        for i in range(len(w) - size + 1):
            first.setdefault(w[i : i + size], (d, i))
    out = {}
    for d, w in seqs:
        gone = {i + k for i in range(len(w) - size + 1) if first[w[i : i + size]] < (d, i) for k in range(size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return Counter(out[d] for d, *_ in rows)


def test_substrings(docs, rows):
    got = remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(tuple(r) for r in got) == substrings_brute(rows)


def test_substrings_within_one_text_and_at_edges(spark):
    r = random.Random(8)
    a = [f"a{r.randrange(10**6)}" for _ in range(100)]
    texts = [" ".join(a[:40] + a[10:60]), " ".join(["z"] + a[41:60]), " ".join(["z"] + a[40:60] + ["q"]), "same " * 50, " ".join(a[60:80]), " ".join(a[59:81])]
    rows = [(i, t, None, None, 0, *[None] * 8) for i, t in enumerate(texts)]
    got = remove_repeats(spark.createDataFrame(rows, DOCS)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(tuple(r) for r in got) == substrings_brute(rows)


def test_license(spark):
    texts = ["Released under the MIT License.\nmit licenses", "x MIT\nLicense y general public license", "cc by nc licensed 4 zero", "mit", None, "", "filler " * 500 + "Licensed under the Apache License, Version 2.0." + " filler" * 500]
    texts += [" ".join(r for r in random.Random(i).sample(t.split(), max(1, int(len(t.split()) * p)))) for i, (_, t) in enumerate(TEMPLATES) for p in (0.7, 0.85)]
    rows = [(i, t, *[None] * 11) for i, t in enumerate(texts)] * 2
    got = {r["doc_id"]: r.asDict() for r in license_scan(spark.createDataFrame(rows, DOCS)).collect()}
    for i, text in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        starts = sorted(k for k in range(len(w)) for p in ("mit license", "apache license", "general public license") if w[k : k + len(p.split())] == p.split())
        labels, best = set(), 0.0
        for line in (text or "").lower().split("\n"):
            x = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line)
            for a in range(0, len(x), 32):
                for label, t in TEMPLATES:
                    need = set(t.split())
                    part = len(need & set(x[a : a + 64])) / len(need)
                    if part >= 0.8 and TELLING.get(label, set()) <= set(x[a : a + 64]):
                        labels.add(label)
                        best = max(best, part)
        base = {label for p, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")) if any(w[k : k + len(p.split())] == p.split() for k in range(len(w)))}
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(starts), starts[0] if starts else None, starts[-1] if starts else None)
        assert (r["base_labels"], r["labels"], r["score"]) == (",".join(sorted(base)), ",".join(sorted(base | labels)), best)


def test_license_families_are_told_apart(spark):
    texts = ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU Lesser General Public License.", "Licensed under CC BY 4.0", "Licensed under CC BY-NC 4.0.", "licensed under\nthe gnu general\npublic license"]
    rows = [(i, t, None, None, 0) + (None,) * 8 for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["labels"] for r in license_scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {0: "gpl", 1: "gpl,lgpl", 2: "", 3: "cc-by-nc", 4: "gpl"}


def test_license_notices_wrapped_over_lines(spark):
    rows = []
    for label, t in TEMPLATES:
        w = t.split()
        for at in range(1, len(w)):
            for before in (0, 31, 40, 63):
                rows.append((len(rows), "filler " * before + " ".join(w[:at]) + "\n  * " + " ".join(w[at:]) + "\nother words", label, *[None] * 10))
    rows.append((len(rows), "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files", "mit", *[None] * 10))
    got = {r["doc_id"]: r for r in license_scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert [r for r in rows if r[2] not in got[r[0]]["labels"].split(",") or got[r[0]]["score"] != 1] == []


def test_fixity_locates_damage(spark):
    pages = spark.createDataFrame([(i, f"u{i % 50}", f"<p>{i}</p>") for i in range(300)] + [(None, None, None), (5, "u5", "<p>5</p>")], "page_id long, url string, html string").withColumn("file", F.lit("x"))
    records = fixity.archive(pages, file_records=64)
    lost = fixity.damaged(records, 100).filter("page_id is null or page_id != 77")
    more = spark.createDataFrame([(1000, "u", "<p>new</p>")], "page_id long, url string, html string")
    added = fixity.archive(more, file_records=64).withColumn("file", F.lit(records.agg(F.min("file")).first()[0]))
    got = Counter((r["status"], r["page_id"]) for r in fixity.audit(records, lost.unionByName(added)).collect() if r["status"] not in ("ok", "moved"))
    assert got == Counter([("corrupt", 0), ("corrupt", 100), ("corrupt", 200), ("missing", 77), ("extra", 1000)])
    # Two records that swap their places, and nothing else.
    one_file = fixity.archive(pages, file_records=10**6)
    turned = one_file.withColumn("page_id", F.expr("case page_id when 10 then 11 when 11 then 10 else page_id end"))
    got = Counter((r["status"], r["page_id"]) for r in fixity.audit(one_file, turned).collect() if r["status"] != "ok")
    assert set(got) == {("moved", 10), ("moved", 11)}
    same = fixity.audit(records, records).collect()
    assert {r["status"] for r in same} == {"ok"} and len(same) == 302


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(4)
    clean = [f"{a}{b}{c}" for a in ("tho", "an", "re") for b in ("ti", "ble", "or") for c in ("sh", "ly", "ea", "nd")]
    bad = ["idiot", "stupid", "pathetic", "worthless"]

    def text(toxic):
        w = r.choices(clean, k=60)
        for _ in range(4 * toxic):
            x = r.choice(bad)
            w.insert(r.randrange(len(w)), x if r.random() < 0.7 else x[:2] + "-" + x[2:])
        return " ".join(w) + "."

    rows = [(i, text(i % 3 == 0), *[None] * 11) for i in range(600)] + [(1000, "", *[None] * 11), (1001, None, *[None] * 11)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(5, None), (None, 1), (9999, 1), (3, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in score(docs, train(docs, labels)).withColumn("h", held_out()).collect()}
    assert all(r["h"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    out = [(r["score"] >= 0.7, d % 3 == 0) for d, r in got.items() if r["h"] and d < 600]
    assert len(out) > 100 and sum(a == b for a, b in out) >= 0.98 * len(out)
    assert got[1000]["score"] < 0.7 and got[1000]["score"] == got[1001]["score"]


def test_mixing_meets_targets(spark):
    r = random.Random(6)
    rows = [(i, " ".join(r.choices(["corpus", "leader", "common", "a", "b"], k=20)), r.choice(["en", "en", "de"]), "big" if i % 3 else f"s{i % 5}", 0, *[None] * 8) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    labelled = described(docs, leaders(docs))
    targets = {"source": {"big": 0.4, **{f"s{i}": 0.12 for i in range(5)}}}
    cells = probabilities(labelled, targets, keep=0.4, rounds=20).toPandas()
    cells["w"] = cells.tokens * cells.probability
    assert cells.probability.max() <= 1 and cells.w.sum() / cells.tokens.sum() == pytest.approx(0.4, abs=1e-6)
    share = cells.groupby("_source").w.sum() / cells.w.sum()
    assert share["big"] == pytest.approx(0.4, abs=0.01)
    kept = mixed(docs, targets, keep=0.4).filter("_kept")
    assert kept.count() == pytest.approx(1200, rel=0.1)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_mixing_on_target_with_production_parameters(spark, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", broadcast)
    r = random.Random(7)
    rows = [(i, " ".join(r.choices(["corpus", "leader", "a", "b"], k=20)), "de" if r.random() < 0.1 else "en", "small" if r.random() < 0.1 else "big", 0, *[None] * 8) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    cells = probabilities(described(docs, leaders(docs)), on_target=True).toPandas()
    cells["w"] = cells.tokens * cells.probability
    for c in ("_source", "_lang", "_topic"):
        want = cells.groupby(c).tokens.sum() ** 0.7
        share = cells.groupby(c).w.sum() / cells.w.sum()
        assert (share - want / want.sum()).abs().max() < 1e-3
    # As many tokens as the scarcest value of any dimension allows.
    most = min((cells.groupby(c).tokens.sum() / (t := cells.groupby(c).tokens.sum() ** 0.7) * t.sum()).min() for c in ("_source", "_lang", "_topic"))
    assert 0.64 * min(0.8 * cells.tokens.sum(), most) <= cells.w.sum() <= 1.001 * most


def test_topk(spark):
    r = np.random.default_rng(2)
    vectors = r.normal(0, 0.2, (300, 16)).astype(np.float32)
    vectors[50:80] = vectors[50]  # ties
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)] + [(20, vectors[20].tolist(), "again"), (400, None, "x"), (420, [None] * 16, "x"), (440, [float("nan")] * 16, "x"), (460, [float("inf")] * 16, "x"), (None, vectors[0].tolist(), "x"), (480, vectors[1][:9].tolist(), "short")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    v = quantised(table)
    got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in top_k(v, v.filter("vec_id % 20 = 0"), k=20, block_rows=60, query_rows=5).collect()}
    ints = {i: np.floor(64 * x.astype(np.float64)).astype(np.int64) for i, x in enumerate(vectors)}
    ints[480] = np.concatenate([ints[1][:9], np.zeros(7, np.int64)])
    for q in [i for i in ints if i % 20 == 0]:
        best = sorted(((-int(ints[q] @ x), i) for i, x in ints.items() if i != q))[:20]
        assert [got[q, n + 1] for n in range(20)] == [(i, -s) for s, i in best]
    assert len(got) == 20 * sum(i % 20 == 0 for i in ints)


ALL = {
    "quality": quality_rules,
    "tokens": lambda d: read_tokens(write_tokens(d, PATH, 1)),
    "jaccard": jaccard_join,
    "jaccard_links": lambda d: jaccard_join(d, count_links=True),
    "packing": lambda d: pack(d, PATH, 0),
    "substrings": remove_repeats,
    "license": license_scan,
    "mixing": mixed,
    "toxicity": lambda d: score(d, train(d, d.select("doc_id", F.lit(1).alias("toxic")))),
    "fixity": lambda d: fixity.audit(a := fixity.archive(d.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html"))), a),
}


@pytest.mark.parametrize("name", ALL)
def test_empty_table(nothing, name):
    assert ALL[name](nothing).count() == 0


@pytest.mark.parametrize("name", ALL)
def test_null_ids_and_columns(without_id, name):
    assert ALL[name](without_id).count() == 3


def test_topk_empty(spark):
    v = quantised(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert top_k(v, v).count() == 0
