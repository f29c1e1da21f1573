"""What the block join sends: nothing for sets that meet by chance, and the first shingles once."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from shelfwise.llm import jaccard

from .test_operators import jaccard_brute, links_brute

DOCS = "doc_id long, text string"


def _written(monkeypatch):
    """Rows of each table that the join writes, by name."""
    seen = {}
    cut = jaccard.cut

    def counted(df, name):
        out = cut(df, name)
        seen[name] = out
        return out

    monkeypatch.setattr(jaccard, "cut", counted)
    return seen


@pytest.mark.parametrize("count_links", [True, False])
def test_sets_that_meet_by_chance_are_not_dealt(spark, monkeypatch, count_links):
    """Every two texts share one phrase, which stands in the first shingles of both: no point and no text is sent."""
    rows = []
    for i in range(80):
        phrase = [f"p{i // 2}x{j}" for j in range(5)]
        rows.append((i, " ".join(phrase + [f"own{i}x{j}" for j in range(30 + i % 3)])))
    seen = _written(monkeypatch)
    got = jaccard.jaccard_join(spark.createDataFrame(rows, DOCS), count_links=count_links).collect()
    assert Counter(tuple(r)[:3] for r in got) == jaccard_brute(rows)
    assert seen["mixed"].count() == 0 and seen["mixed_texts"].count() == 0
    if not count_links:
        assert seen["pairs"].count() == 0


def test_keys_are_dealt_once(spark):
    """The rows of all first shingles pass one exchange, which the counting and the join both read."""
    seen = []
    cut = jaccard.cut

    def explained(df, name):
        out = cut(df, name)
        if name in ("blocks", "mixed"):
            df.collect()
            seen.append((name, df._jdf.queryExecution().toString()))
        return out

    jaccard.cut = explained
    try:
        jaccard.jaccard_join(spark.createDataFrame([(i, " ".join([*(f"w{j}" for j in range(60)), f"own{i}"])) for i in range(40)], DOCS), count_links=True)
    finally:
        jaccard.cut = cut
    assert [n for n, _ in seen] == ["blocks", "mixed"]
    for name, plan in seen:
        assert "ReusedExchange" in plan.split("== Physical Plan ==")[1], name


@pytest.mark.parametrize("size", [1, 4, 9, 30])
def test_links_at_the_edge(spark, size):
    """Sets of one size, near the threshold and below it, down to one shingle: the node count loses no link."""
    r = random.Random(size)
    rows = []
    for base in range(8):
        w = [f"b{base}w{r.randrange(40 * size)}" for _ in range(size + 4)]
        for _ in range(8):
            v = list(w)
            for _ in range(r.randrange(3)):
                at = r.choice([0, len(v) - 1, r.randrange(len(v))])
                v[at] = f"e{r.randrange(5)}"
            cut = r.randrange(1 + size // 4)
            rows.append((len(rows), " ".join(v[cut:])))
    got = jaccard.jaccard_join(spark.createDataFrame(rows, DOCS).repartition(3), count_links=True).collect()
    assert Counter(tuple(x)[:3] for x in got) == jaccard_brute(rows)
    assert Counter((x.doc_id, x.n_links) for x in got) == links_brute(rows)
    assert Counter(tuple(x) for x in jaccard.jaccard_join(spark.createDataFrame(rows, DOCS)).collect()) == jaccard_brute(rows)
