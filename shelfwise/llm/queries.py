"""The registered queries of this package: op1 to op13 and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .covertree import candidates, hard_negatives
from .fixity import archive, audit, damaged
from .jaccard import jaccard_join
from .license import license_scan
from .mixing import mixed
from .packing import pack
from .quality import quality_rules
from .store import cut, table
from .substrings import remove_repeats
from .token_output import read_tokens, write_tokens
from .topk import quantised, top_k
from .toxicity import PREDICT, held_out, score, train
from .trie import prefix_trie
from .winnowing import contamination

VOCABULARY = "word_bpe_49k.json"
END_OF_DOCUMENT = 1
END_OF_PIECE = 0


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), END_OF_DOCUMENT)
    return read_tokens(files)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), k=5, percent=80, count_links=True)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), END_OF_PIECE)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a stored copy, with known damage, against the records as they were written."""
    records = archive(table(spark, sf_dir, "pages"))
    return audit(records, cut(damaged(records), "replica"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixed(table(spark, sf_dir, "documents"), with_text=False)
    return docs.select("doc_id", F.col("_topic").alias("topic"), F.col("_words").alias("n_words"), F.round("_probability", 6).alias("probability"), F.col("_kept").alias("kept"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cut(quantised(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = cut(candidates(table(spark, sf_dir, "embeddings"), 256, label), "mining_rows")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_quality_rules, op2_token_output, op3_jaccard_join, op4_best_fit_packing, op5_substring_dedup, op6_license_scan, op7_warc_fixity, op8_toxicity, op9_source_mixing, op10_exact_top_k, op11_benchmark_decontamination, op12_hard_negatives, op13_conversation_trie]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
