"""Token-ID output: documents in ascending id order as Simple-8b files.

Documents are range-partitioned and sorted by id; each task tokenizes its
whole texts and writes file images (``simple8b``) of about ``FILE_IDS`` ids as
rows of one table, so that Spark's committer publishes them and any shared
store can hold them. Reading decodes the images block-wise; a document's place
in the whole stream is its place in the file plus the ids of all files before.

Defined results: a null text is empty (one end id); a null id comes first;
repeated ids follow one another in order of their texts' hashes; extra columns are
ignored; an empty table gives no file and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simple8b
from .store import cut, fan_out
from .tokens import encoded

FILE_IDS = 1 << 20
FILES = "part int, seq int, n_docs long, n_ids long, image binary"


def _image(docs: list, ids: list) -> tuple[int, int, bytes]:
    doc = pa.concat_arrays(docs)
    size = np.concatenate([s for _, s in ids])
    flat = np.concatenate([i for i, _ in ids])
    nulls = np.asarray(doc.is_null())
    return len(doc), len(flat), simple8b.to_bytes(np.asarray(doc.fill_null(0)), nulls, np.cumsum(size), flat)


def _write(batches: Iterator[pa.RecordBatch], path: str, end_id: int, file_ids: int) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    docs: list = []
    ids: list = []
    held = 0

    def flush() -> pa.RecordBatch:
        n_docs, n_ids, image = _image(docs, ids)
        docs.clear()
        ids.clear()
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((part, seq, n_docs, n_ids, image), kinds, strict=True)], ["part", "seq", "n_docs", "n_ids", "image"])

    for batch in batches:
        for first, flat, off in encoded(batch, path, end_id):
            docs.append(batch.column("doc_id").slice(first, len(off) - 1))
            ids.append((flat, np.diff(off)))
            held += len(flat)
            if held >= file_ids:
                yield flush()
                seq, held = seq + 1, 0
    if docs:
        yield flush()


def write_tokens(docs: DataFrame, path: str, end_id: int, file_ids: int = FILE_IDS) -> DataFrame:
    """The written file images, in order of (part, seq)."""
    text_hash = F.xxhash64("text").alias("_h")
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash).repartitionByRange(fan_out(docs.sparkSession), "doc_id", "_h")
    dealt = dealt.sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    return cut(dealt.mapInArrow(partial(_write, path=path, end_id=end_id, file_ids=file_ids), FILES), "token_files")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "part", "seq", "local", "n_tokens", "ids_crc32"]
    for batch in batches:
        for part, seq, image in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "image")), strict=True):
            doc, nulls, ends, ids = simple8b.from_bytes(image)
            begin = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            body = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip(begin.tolist(), ends.tolist(), strict=True)]
            n = len(doc)
            cols = [pa.array(doc, pa.int64(), mask=nulls), np.full(n, part, np.int32), np.full(n, seq, np.int32), begin, ends - begin, np.array(crc, np.int64)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names)


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files alone."""
    sizes = files.select("part", "seq", "n_ids")
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task that wrote, so the only ordered total is over a bounded table.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    place = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).join(ahead, "part")
    place = place.select("part", "seq", (F.col("ahead") + F.col("inside")).alias("base"))
    docs = files.select("part", "seq", "image").mapInArrow(_read, "doc_id long, part int, seq int, local long, n_tokens long, ids_crc32 long")
    return docs.join(place, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
