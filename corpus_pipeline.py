"""A training corpus from raw documents: five stages, each on all that the one before kept.

Every stage is a function of (spark, docs, sf_dir). All but the last return
the columns of ``documents``; the last returns the packed pieces.

Defined results: nulls, empty texts and repeated rows behave as the operators'
docstrings say; rows without an id are never near duplicates; columns beyond
those of ``documents`` are dropped; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.jaccard import jaccard_join
from shelfwise.llm.mixing import mixed
from shelfwise.llm.packing import pack
from shelfwise.llm.store import bounded_batches, cut, table
from shelfwise.llm.substrings import NO_ID, remove_repeats
from shelfwise.llm.toxicity import PREDICT, keep_clean, train

#: Ids up to this many are broadcast to pick rows; more are joined by shuffle.
BROADCAST_IDS = 200_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "word_bpe_49k.json"
END_OF_PIECE = 0
#: Largest miss of a target share: exact shares would keep only what the scarcest topic allows, 3 to 5 % of the documents.
MISS = 0.05

#: SQL cannot express the toxicity stage; tests hold the stages against brute force.
ORACLE_SQL = None


def _small(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    bounded_batches(spark)
    docs = docs.select(COLUMNS)
    return keep_clean(docs, train(docs, table(spark, sf_dir, "labels")), PREDICT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each component."""
    docs = docs.select(COLUMNS)
    found = cut(jaccard_join(docs), "near_duplicates")
    if found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("doc_id is not null and n > 1").limit(1).count():
        whole = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
        docs = whole.unionByName(docs.filter("doc_id is null"))
    later = cut(found.filter("component_id != doc_id").select("doc_id").distinct(), "later_copies")
    return docs.join(_small(later), "doc_id", "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages; those left without a word go."""
    docs = docs.select(COLUMNS)
    found = cut(remove_repeats(docs).filter("n_removed > 0").select("doc_id", "tag", "n_words", "n_removed", "kept_text"), "substrings_removed")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    marked = docs.withColumns({"_key": key, "_tag": F.xxhash64("text")})
    changed = found.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_key"), F.col("tag").alias("_tag"), "kept_text").dropDuplicates(["_key", "_tag"])
    ids = cut(changed.select("_key", "_tag"), "substring_ids")
    same = marked.join(_small(ids), ["_key", "_tag"], "left_anti").select(COLUMNS)
    new = marked.drop("text").join(changed.filter("kept_text != ''"), ["_key", "_tag"])
    new = new.withColumns({"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)})
    return same.unionByName(new.select(COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their cells' calibrated probabilities, as many as keep every share within MISS of its target."""
    docs = docs.select(COLUMNS)
    return mixed(docs, on_target=True, tolerance=MISS).filter("_kept").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return pack(docs, public_tokenizers.path(VOCABULARY), END_OF_PIECE)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
