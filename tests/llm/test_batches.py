"""Whole texts reach Python in Arrow batches of bounded bytes."""

from __future__ import annotations

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import jaccard
from shelfwise.llm.substrings import repeats

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("step", ["toxicity", "near_duplicates", "op3", "substrings"])
def test_batches_are_bounded_in_bytes(spark, step):
    """Texts reach Python in batches of about 2 MB, not of 10,000 rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    big = spark.range(3000).select("id", F.rpad(F.lit("word "), 5000, "text ").alias("text")).coalesce(1)

    def most(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    before = spark.conf.get(LIMIT)
    spark.conf.unset(LIMIT)
    try:
        if step == "op3":
            jaccard.jaccard_join(docs, count_links=True)
        elif step == "substrings":
            repeats(docs)
        else:
            dict(corpus_pipeline.STAGES)[step](spark, docs, "/root/testdata/sf0.001")
        assert max(r.n for r in big.mapInArrow(most, "n long").collect()) < 4 << 20
        spark.conf.set(LIMIT, str(1 << 20))  # a lower limit stays
        repeats(docs.limit(0))
        assert spark.conf.get(LIMIT).rstrip("b") == str(1 << 20)
    finally:
        spark.conf.set(LIMIT, before.rstrip("b"))
