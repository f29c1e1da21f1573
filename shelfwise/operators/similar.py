"""Product embeddings: append, first-by-product, exact cosine top-k search.

``similar_products`` is exact and never materialises query × candidate pairs
as rows: catalogue and queries are packed into blocks on the executors, a
meeting of two blocks is one matrix product that keeps the k best per query
(rounded score, then smaller id), and a final per-query ranking merges these
lists (``k × blocks`` rows per query at most).
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The task-side scorer is shipped by value: executors need numpy and pandas,
# not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_QUERY_ROWS = 4096  # vectors of a block (x dims x 8 bytes)
SCORE_DECIMALS = 9  # ranking precision: equal at 1e-9 -> smaller id first


def append_embedding(src: DataFrame, now: str) -> DataFrame:
    """Rows for ``product_embeddings``: NULL vectors are rejected, never written."""
    return src.where(F.col("embedding").isNotNull()).select(
        F.col("vec_id").alias("id"),
        F.col("label").cast("int").alias("product_id"),
        F.concat(F.lit("embedding "), F.col("vec_id").cast("string")).alias("content"),
        F.col("embedding"),
        F.lit(now).cast("timestamp_ntz").alias("created_at"),
    )


def save_embeddings(rows: DataFrame, path: str) -> None:
    """Plain insert (append) of embedding rows; NULL vectors never reach it (see ``append_embedding``)."""
    rows.where(F.col("embedding").isNotNull()).write.mode("append").parquet(path)


def first_embedding(emb: DataFrame, key: str = "product_id", order: str = "id") -> DataFrame:
    """First row per product by primary key, for every product at once (partial ``min_by``)."""
    payload = [c for c in emb.columns if c != key]
    agg = emb.groupBy(key).agg(F.min_by(F.struct(*payload), F.col(order)).alias("_r"))
    return agg.select(key, *[F.col(f"_r.{c}").alias(c) for c in payload])


def l2_norm(c) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sqrt(F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for a block of vectors: its ids and its matrix as bytes."""
    mat = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "ids": [pdf["id"].to_numpy().astype(np.int64).tobytes()],
                         "mat": [mat.tobytes()], "dims": [mat.shape[1]]})


def _unit(ids: bytes, mat: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    m = np.frombuffer(mat, np.float64).reshape(len(i), dims)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return i, m / np.where(norm == 0, 1, norm)


def _block_top(ids: np.ndarray, unit: np.ndarray, qids: np.ndarray, qunit: np.ndarray, k: int, exclude_self: bool) -> pd.DataFrame:
    """The k best of a block for each query, by rounded score and then the smaller id."""
    sims = np.round(qunit @ unit.T, SCORE_DECIMALS)
    if exclude_self:
        sims[qids[:, None] == ids[None, :]] = -np.inf
    kk = min(k, len(ids))
    bar = np.partition(sims, len(ids) - kk, axis=1)[:, len(ids) - kk][:, None]
    q, c = np.nonzero((sims >= bar) & np.isfinite(sims))  # the k best and all that tie with the last of them
    order = np.lexsort((ids[c], -sims[q, c], q))
    q, c = q[order], c[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    q, c = q[place < k], c[place < k]
    return pd.DataFrame({"query_id": qids[q], "id": ids[c], "score": sims[q, c]})


def _blocks(df: DataFrame, id_col: str, rows: int) -> tuple[DataFrame, int]:
    """(block, ids, mat, dims) rows of about ``rows`` vectors each, dealt by a hash of the id."""
    n = max(1, -(-df.count() // rows))
    dealt = df.select(F.pmod(F.xxhash64(id_col), F.lit(n)).alias("block"), F.col(id_col).cast("long").alias("id"), "embedding")
    return dealt.groupBy("block").applyInPandas(_pack, "block long, ids binary, mat binary, dims int"), n


def similar_products(
    catalog: DataFrame,
    queries: DataFrame,
    k: int = 5,
    exclude_self: bool = True,
    max_query_rows: int = MAX_QUERY_ROWS,
) -> DataFrame:
    """Top-k catalogue rows by cosine similarity for each query vector.

    ``catalog``: (id, embedding); ``queries``: (query_id, embedding).
    Output: query_id, rank, id, score (rounded to 6 places). Catalogue and
    queries are packed into blocks on the executors; each query block meets
    each catalogue block once, and only the k best rows of a meeting go on.
    """
    cat, n = _blocks(catalog, "id", MAX_QUERY_ROWS)
    asked, _ = _blocks(queries, "query_id", max_query_rows)
    asked = asked.select(F.col("ids").alias("q_ids"), F.col("mat").alias("q_mat"), F.col("dims").alias("q_dims"))
    met = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))).join(cat, "block")

    def search(batches):
        for pdf in batches:
            for r in pdf.itertuples():
                yield _block_top(*_unit(r.ids, r.mat, r.dims), *_unit(r.q_ids, r.q_mat, r.q_dims), k, exclude_self)

    found = met.mapInPandas(search, "query_id long, id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id",
                         F.round("score", 6).alias("score"))
