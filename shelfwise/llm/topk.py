"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

The index deals the vectors to blocks of bounded size by their ids' hash. In a
block, each component is a posting (dimension, row, value); postings of equal
quantised impact, the power of two of their size, form a segment, and segments
are stored in descending impact together with the norm of what each vector
keeps for lower segments. A batch of queries meets each block: segments are
scored in order for all queries at once, and by the Cauchy-Schwarz inequality
each partial score is within |q| * rest of the whole. Scoring stops only when
this proves that few vectors can still be among the k best (ties included);
those possible members are rescored exactly.

Defined results: a vector that is null, or holds null, NaN or infinite
components, takes no part, nor does a null id; of rows that repeat an id the
least vector stands; a shorter vector counts as padded with zeros; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Stop when a query has at most so many possible members on average, in units of k.
FEW = 4


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id, v: the integer vectors that take part."""
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    ints = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    good = vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    return good.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(ints).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    out = np.zeros((len(column), int(size.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = np.asarray(column.flatten())
    return out


def _level(x: np.ndarray) -> np.ndarray:
    """floor(log2 |x|) for integers other than 0."""
    return np.frexp(np.abs(x).astype(np.float64))[1] - 1


INDEX = "block long, ids binary, n int, dims int, levels array<int>, rows array<binary>, dim array<binary>, values array<binary>, rest array<binary>"


def _build(group: pa.Table) -> pa.Table:
    """The index row of one block."""
    ids = np.asarray(group.column("vec_id")).astype(np.int64)
    v = _matrix(group.column("v"))
    row, dim = np.nonzero(v)
    value = v[row, dim]
    level = _level(value)
    left = (v.astype(np.float64) ** 2).sum(1)
    out: dict[str, list] = {"levels": [], "rows": [], "dim": [], "values": [], "rest": []}
    for x in np.unique(level)[::-1]:
        mine = np.flatnonzero(level == x)
        mine = mine[np.lexsort((row[mine], -value[mine], dim[mine]))]
        left = left - np.bincount(row[mine], value[mine].astype(np.float64) ** 2, len(ids))
        out["levels"].append(int(x))
        out["rows"].append(row[mine].astype("<i4").tobytes())
        out["dim"].append(dim[mine].astype("<i4").tobytes())
        out["values"].append(value[mine].astype("<i8").tobytes())
        out["rest"].append(np.sqrt(np.maximum(left, 0)).astype("<f8").tobytes())
    block = group.column("block")[0].as_py()
    cols = [[block], [ids.astype("<i8").tobytes()], [len(ids)], [v.shape[1]], *([out[c]] for c in ("levels", "rows", "dim", "values", "rest"))]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32()), *[pa.list_(pa.binary())] * 4]
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["block", "ids", "n", "dims", "levels", "rows", "dim", "values", "rest"])


def build_index(vectors: DataFrame, n_blocks: int) -> DataFrame:
    """One row a block: ids and the segments in descending impact."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("block")
    return vectors.select(block, "vec_id", "v").groupBy("block").applyInArrow(_build, INDEX)


def _pack_queries(group: pa.Table) -> pa.Table:
    q = _matrix(group.column("v"))
    ids = np.asarray(group.column("vec_id")).astype("<i8")
    cols = [pa.array([ids.tobytes()], pa.binary()), pa.array([q.shape[1]], pa.int32()), pa.array([q.astype("<i8").tobytes()], pa.binary())]
    return pa.table(cols, names=["q_ids", "q_dims", "q"])


def _search_block(x: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec_id, score) of each query's k best in the block."""
    ids, q_ids = (np.frombuffer(x[c], "<i8") for c in ("ids", "q_ids"))
    dims = max(x["dims"], x["q_dims"], 1)
    q = np.zeros((len(q_ids), dims), np.int64)
    q[:, : x["q_dims"]] = np.frombuffer(x["q"], "<i8").reshape(len(q_ids), x["q_dims"])
    segments = [tuple(np.frombuffer(x[c][i], kind) for c, kind in (("rows", "<i4"), ("dim", "<i4"), ("values", "<i8"), ("rest", "<f8"))) for i in range(len(x["levels"]))]
    q_top = int(np.abs(q).max(initial=0))
    v_top = max((int(np.abs(s[2]).max()) for s in segments), default=0)
    most = q_top * v_top * dims
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object
    qs = q.astype(kind)
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(1))[:, None]
    score = np.zeros((len(q_ids), len(ids)), kind)
    own = q_ids[:, None] == ids[None, :]
    whole = np.zeros((dims, len(ids)), kind)
    possible = ~own
    for i, (row, dim, value, rest) in enumerate(segments):
        part = np.zeros((dims, len(ids)), kind)
        part[dim, row] = value.astype(kind)
        whole += part
        score += qs @ part
        if i + 1 == len(segments) or kind is object or len(ids) <= FEW * k:
            continue
        slack = norm * rest[None, :] * (1 + 1e-9) + 1e-3
        sure = np.where(own, -np.inf, score - slack)
        bar = np.partition(sure, len(ids) - k, axis=1)[:, len(ids) - k][:, None]
        possible = ~own & (score + slack >= bar)
        if possible.sum() <= FEW * k * len(q_ids):
            for row, dim, value, _ in segments[i + 1 :]:
                whole[dim, row] = value.astype(kind)
            break
    else:
        possible = ~own
    if possible.sum() <= FEW * k * len(q_ids):
        who, what = np.nonzero(possible)
        exact = np.empty(len(who), np.int64)
        for a in range(0, len(who), 1 << 16):
            b = slice(a, a + (1 << 16))
            exact[b] = (q[who[b]] * whole.T[what[b]].astype(np.int64)).sum(1)
    else:
        if len(ids) > k:
            bar = np.partition(np.where(own, -np.inf, score), len(ids) - k, axis=1)[:, len(ids) - k][:, None] if kind is not object else np.sort(score, 1)[:, [max(0, len(ids) - k - 1)]]
            possible &= score >= bar
        who, what = np.nonzero(possible)
        exact = score[who, what].astype(np.int64)
    order = np.lexsort((ids[what], -exact, who))
    who, what, exact = who[order], what[order], exact[order]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    best = place < k
    return q_ids[who[best]], ids[what[best]], exact[best]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            found = _search_block(batch.slice(i, 1).to_pylist()[0], k)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of ``vectors`` for each row of ``queries`` (both vec_id, v)."""
    n_blocks = max(1, -(-vectors.count() // block_rows))
    n_batches = max(1, -(-queries.count() // query_rows))
    index = cut(build_index(vectors, n_blocks), "topk_index")
    batch = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_batches)).alias("batch")
    packed = queries.select(batch, "vec_id", "v").groupBy("batch").applyInArrow(_pack_queries, "q_ids binary, q_dims int, q binary")
    # The stated query set meets every block once; both sides are packed rows of bounded size.
    met = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<bigint>"))).join(index, "block")
    found = met.mapInArrow(partial(_search, k=k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
