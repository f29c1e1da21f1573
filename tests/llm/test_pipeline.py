"""The pipeline's stages against what their operators decide, over the small tables."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from shelfwise.llm.store import cut, table

from ..conftest import SF_SMALL
from .test_operators import jaccard_brute, substrings_brute


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = cut(stage(spark, docs, SF_SMALL), "test_stage")
        after = [tuple(r) for r in docs.collect()]
        kept[name] = len(after)
        if name != "packing":
            assert docs.columns == columns
        if name in ("toxicity", "mixing"):
            assert set(after) <= set(before)
        if name == "near_duplicates":
            want = {d for d, _, c in jaccard_brute(before) if d == c}
            assert sorted(r[0] for r in after) == sorted(want)
        if name == "substring_dedup":
            now = {r[0]: r[1] for r in after}
            for d, n, gone, digest in substrings_brute(before):
                if gone == n and n:
                    assert d not in now
                elif gone:
                    assert hashlib.sha256(now[d].encode()).hexdigest() == digest
        if name == "packing":
            assert {r[0] for r in after} == {r[0] for r in before}
    assert kept["toxicity"] > 0.7 * 200 and kept["mixing"] > 0


def test_empty(spark):
    docs = table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF_SMALL), "test_empty")
    assert docs.count() == 0
