"""Merkle fixity audit of WARC archives.

Pages become WARC records, dealt to files by a digest of their identity and
laid out in each file in order of their ids, so a record has an offset range. A leaf
hashes a record's range and bytes; a node hashes its ``FAN`` children in
order; the top node is the file's root. Two replicas are compared root by
root, and only below a mismatching node are its children compared, down to
the records. Trees are built by partial orders of bounded size (a file, a
node), from digests and lengths alone.

Defined results: a null address or body is empty; a null id comes first;
equal records follow one another; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

FAN = 16
FILE_RECORDS = 4096
DAMAGED = 1009


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a response record, as text."""
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(F.coalesce(html, F.lit(""))).cast("string"),
        F.lit("\r\n\r\n"), F.coalesce(html, F.lit("")), F.lit("\r\n\r\n"),
    )


def archive(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """page_id, url, file, record: the records of all pages with the file that each goes to."""
    files = max(1, -(-pages.count() // file_records))
    name = F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce("url", F.lit("")))
    file = (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") % files).alias("file")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), file, record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))


def damaged(records: DataFrame, every: int = DAMAGED) -> DataFrame:
    """A replica in which the first byte of each record whose id is divisible by ``every`` has lost a bit."""
    hit = F.coalesce(F.col("page_id") % every == 0, F.lit(False))
    return records.withColumn("record", F.when(hit, F.concat(F.lit("w"), F.expr("substring(record, 2)"))).otherwise(F.col("record")))


def leaves(records: DataFrame) -> DataFrame:
    """file, idx, page_id, offset, length, digest, hash of every record, in file order."""
    short = records.select("file", "page_id", "url", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file").orderBy("page_id", "url", "length", "digest")
    placed = short.withColumn("idx", (F.row_number().over(order) - 1).cast("long"))
    before = Window.partitionBy("file").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    return placed.select("file", "idx", "page_id", "offset", "length", "digest", F.sha2(F.concat_ws(":", "offset", "length", "digest"), 256).alias("hash"))


def tree(leaf: DataFrame, depth: int, fan: int = FAN) -> list[DataFrame]:
    """The levels above the leaves up to the roots: file, idx, hash."""
    levels = [leaf.select("file", "idx", "hash")]
    for _ in range(depth):
        children = F.sort_array(F.collect_list(F.struct("idx", "hash")))
        up = levels[-1].groupBy("file", F.floor(F.col("idx") / fan).alias("up")).agg(children.alias("c"))
        levels.append(up.select("file", F.col("up").alias("idx"), F.sha2(F.array_join("c.hash", ""), 256).alias("hash")))
    return [levels[0], *(cut(x, "merkle") for x in levels[1:])]


def _differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """(file, idx) of nodes that differ or stand on one side only."""
    both = a.join(b.withColumnRenamed("hash", "other"), ["file", "idx"], "full")
    return both.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "idx")


def _numbered(df: DataFrame, column: str) -> DataFrame:
    """``nth``: which of the rows of equal ``column`` in its file a row is."""
    return df.drop("nth").withColumn("nth", F.row_number().over(Window.partitionBy("file", column).orderBy("idx")))


def audit(primary: DataFrame, replica: DataFrame, fan: int = FAN) -> DataFrame:
    """The primary's records with their status, and the replica's ``extra`` ones (its position, digest null).

    ``ok``: the same bytes at the same place; ``moved``: the same bytes elsewhere in the file (also behind a
    deleted or inserted record); ``corrupt``: the replica has other bytes under this record id; ``missing``: it has none.
    """
    a, b = cut(leaves(primary), "leaves"), cut(leaves(replica), "leaves")
    most = max(x.agg(F.max("idx")).first()[0] or 0 for x in (a, b))
    depth = 1
    while fan**depth <= most:
        depth += 1
    left, right = tree(a, depth, fan), tree(b, depth, fan)
    bad = cut(_differ(left[depth], right[depth]), "mismatch")
    for level in range(depth - 1, -1, -1):
        parent = bad.select("file", F.col("idx").alias("up"))
        below = [x.withColumn("up", F.floor(F.col("idx") / fan)).join(parent, ["file", "up"], "left_semi").select("file", "idx", "hash") for x in (left[level], right[level])]
        bad = cut(_differ(*below), "mismatch")
    # Only what lies in mismatching ranges is aligned: first by digest, then what is left by record id.
    lost = _numbered(a.join(bad, ["file", "idx"], "left_semi").select("file", "idx", "digest", "page_id"), "digest")
    there = _numbered(b.join(bad, ["file", "idx"], "left_semi").select("file", "idx", "digest", "page_id"), "digest")
    moved = lost.join(there.select("file", "digest", "nth"), ["file", "digest", "nth"], "left_semi").select("file", "idx", F.lit("moved").alias("status"))
    mine = _numbered(lost.join(there, ["file", "digest", "nth"], "left_anti"), "page_id").select("file", "idx", "page_id", "nth")
    other = _numbered(there.join(lost, ["file", "digest", "nth"], "left_anti"), "page_id")
    other = other.select(F.col("file").alias("file_b"), F.col("idx").alias("idx_b"), F.col("page_id").alias("page_b"), F.col("nth").alias("nth_b"))
    pairs = mine.join(other, (F.col("file") == F.col("file_b")) & F.col("page_id").eqNullSafe(F.col("page_b")) & (F.col("nth") == F.col("nth_b")), "full")
    pairs = cut(pairs, "aligned")
    state = pairs.filter("idx is not null").select("file", "idx", F.when(F.col("idx_b").isNull(), "missing").otherwise("corrupt").alias("status"))
    known = a.join(moved.unionByName(state), ["file", "idx"], "left")
    known = known.select("page_id", "file", F.col("idx").alias("position"), "offset", "length", F.col("digest").alias("record_sha256"), F.coalesce("status", F.lit("ok")).alias("status"))
    none = F.lit(None)
    extra = pairs.filter("idx is null").select(F.col("page_b").alias("page_id"), F.col("file_b").alias("file"), F.col("idx_b").alias("position"), none.cast("long").alias("offset"), none.cast("long").alias("length"), none.cast("string").alias("record_sha256"), F.lit("extra").alias("status"))
    return known.unionByName(extra)
