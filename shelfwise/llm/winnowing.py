"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``SPAN`` consecutive words of an item (a shorter item is one
window of its own length). For windows of t words the k-gram is k = t // 2
words; of each run of t - k + 1 consecutive k-gram hashes only the least (the
rightmost of equal ones) is kept as a fingerprint, so two texts that share t
words in a row share a fingerprint inside them. Three steps:

1. Every document is winnowed in its own row. Its fingerprints are tested
   against a bitmap of ``BITS`` bits over the items' fingerprints; the size of
   the bitmap is fixed, and a larger benchmark only lets more false ones pass.
   What passes is written with its surroundings, t - k words to either side:
   all windows that can hold the fingerprint lie there.
2. These fingerprints are joined with those of the items.
3. Hits are extended: each window around a hit is compared word by word, by a
   join with the distinct windows of the items. Window and item pairs are
   expanded once for each distinct set of windows, so a passage that many
   documents share is not paired with its items again for each of them.

Defined results: a null or empty text has no words and is clean; rows that
repeat an id, and rows without one, each get their own result row; items
without an id or a word take no part, and items that share an id count as one;
extra columns are ignored; an empty table gives no rows, an empty benchmark
clean ones. One document's words are held in memory at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import cut

SPAN = 10
#: Bits of the fixed-size fingerprint bitmap.
BITS = 1 << 18
#: The items' windows are broadcast up to so many rows and bytes, else joined by shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case; a null text has none."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.filter(F.split(low, _GAP), lambda x: x != "")


def _grams(w: Column, k: int) -> Column:
    """Hash of the k words from each place on; ``w`` has k words at least."""
    hashed = F.transform(w, lambda x: F.xxhash64(x))
    return _let(hashed, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (k - 1)), lambda i: F.xxhash64(*[F.element_at(h, i + j) for j in range(k)])))


def _minima(g: Column, run: int) -> Column:
    """The least hash of each run of k-grams."""
    return F.transform(F.sequence(F.lit(1), F.size(g) - (run - 1)), lambda i: F.array_min(F.slice(g, i, run)))


def _k(t: int) -> int:
    return max(1, t // 2)


def _bit(v: Column, bits: Column) -> Column:
    return F.getbit(F.element_at(bits, (v.bitwiseAND(F.lit(BITS // 64 - 1)) + 1).cast("int")), F.shiftrightunsigned(v, 40).bitwiseAND(F.lit(63)).cast("int")) == 1


def bitmap(prints: DataFrame) -> Column:
    """The bitmap of the fingerprints ``v`` as a literal of BITS // 64 longs."""
    word = F.col("v").bitwiseAND(F.lit(BITS // 64 - 1)).alias("word")
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(v, 40) & 63 as int))")
    found = {r["word"]: r["bits"] for r in prints.groupBy(word).agg(F.bit_or(bit).alias("bits")).collect()}
    return F.split(F.lit(",".join(str(found.get(i, 0)) for i in range(BITS // 64))), ",").cast("array<long>")


def _hits(w: Column, t: int, bits: Column) -> Column:
    """The fingerprints of a text for windows of t words that pass the bitmap: t, v, from (word place of the surroundings), near (their words)."""
    k = _k(t)
    run = t - k + 1

    def place(g: Column, m: Column, i: Column) -> Column:
        return (i + run - F.array_position(F.reverse(F.slice(g, i, run)), F.element_at(m, i))).cast("int")

    def around(g: Column, p: Column) -> Column:
        first = F.greatest(F.lit(1), p - (t - k))
        return F.struct(F.lit(t).alias("t"), F.element_at(g, p).alias("v"), first.cast("long").alias("from"), F.array_join(F.slice(w, first, p + t - first), " ").alias("near"))

    def kept(g: Column, m: Column) -> Column:
        passing = F.filter(F.sequence(F.lit(1), F.size(m)), lambda i: _bit(F.element_at(m, i), bits))
        return F.transform(F.array_distinct(F.transform(passing, lambda i: place(g, m, i))), lambda p: around(g, p))

    found = _let(_grams(w, k), lambda g: _let(_minima(g, run), lambda m: kept(g, m)))
    return F.when(F.size(w) >= t, found).otherwise(F.array().cast("array<struct<t:int,v:bigint,from:bigint,near:string>>"))


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, t, v, window: every window of every item with the fingerprint chosen in it."""
    split = cut(items.filter("item_id is not null").select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0).withColumn("t", F.least(F.size("w"), F.lit(SPAN))), "benchmark_words")
    out = None
    for t in [r["t"] for r in split.select("t").distinct().collect()]:  # at most SPAN lengths
        run = t - _k(t) + 1
        held = _let(_grams(F.col("w"), _k(t)), lambda g: _minima(g, run))
        each = F.transform(held, lambda v, i: F.struct(v.alias("v"), F.array_join(F.slice("w", i + 1, t), " ").alias("window")))
        part = split.filter(F.col("t") == t).select("item_id", "t", F.explode(each).alias("e")).select("item_id", "t", "e.v", "e.window")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else split.select("item_id", "t", F.lit(0).cast("long").alias("v"), F.lit("").alias("window")).limit(0)


def _bounded(df: DataFrame, size: Column) -> DataFrame:
    n, b = df.agg(F.count("*"), F.sum(size)).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (b or 0) <= BROADCAST_BYTES else df


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and spans: the hit words as runs of [first, end) word places."""
    pairs = cut(item_windows(items), "benchmark_windows")
    windows = cut(pairs.select("t", "v", "window").distinct().withColumn("wid", F.monotonically_increasing_id()), "distinct_windows")
    holders = pairs.join(windows.select("t", "window", "wid"), ["t", "window"]).select("wid", F.col("item_id").cast("string").alias("item")).distinct()
    prints = windows.select("t", "v").distinct()
    bits = bitmap(prints)
    lengths = [r["t"] for r in prints.select("t").distinct().collect()]

    def scan(w: Column) -> Column:
        none = F.array().cast("array<struct<t:int,v:bigint,from:bigint,near:string>>")
        return F.struct(F.size(w).cast("long").alias("n_words"), F.concat(none, *[_hits(w, t, bits) for t in lengths]).alias("hits"))

    scanned = docs.select("doc_id", _let(words(F.col("text")), scan).alias("s")).select(F.monotonically_increasing_id().alias("row"), "doc_id", "s.n_words", "s.hits")
    scanned = cut(scanned, "winnowed")

    found = scanned.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    found = found.join(_bounded(prints, F.lit(12)), ["t", "v"], "left_semi")
    around = F.split("near", " ")
    each = _let(around, lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - F.col("t") + 1), lambda i: F.struct((F.col("from") + i - 1).alias("start"), F.array_join(F.slice(w, i, F.col("t")), " ").alias("window"))))
    near = found.filter(F.size(around) >= F.col("t")).select("row", "t", F.explode(each).alias("e")).select("row", "t", "e.start", "e.window")
    same = near.join(_bounded(windows.select("t", "window", "wid"), F.octet_length("window")), ["t", "window"])

    runs = F.array_sort(F.collect_set(F.struct((F.col("start") - 1).alias("first"), (F.col("start") + F.col("t") - 1).alias("end"))))
    per_row = cut(same.groupBy("row").agg(runs.alias("runs"), F.array_sort(F.collect_set("wid")).alias("wids")), "contaminated")

    sets = per_row.select("wids").distinct().withColumn("wid", F.explode("wids")).join(holders, "wid")
    sets = sets.groupBy("wids").agg(F.array_sort(F.collect_set("item")).alias("items"))
    sets = sets.select("wids", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))

    def grow(acc: Column, x: Column) -> Column:  # joins a run with the one before where they meet
        last = F.element_at(acc, -1)
        longer = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["first"].alias("first"), F.greatest(last["end"], x["end"]).alias("end"))))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["end"] >= x["first"]), longer).otherwise(F.concat(acc, F.array(x)))

    spans = F.array().cast("array<struct<first:bigint,end:bigint>>")
    marked = per_row.join(sets, "wids").select("row", "n_items", "items_sha256", F.aggregate("runs", spans, grow).alias("spans"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    marked = marked.select("row", hit.alias("n_hit"), "n_items", "items_sha256", "spans")
    whole = scanned.select("row", "doc_id", "n_words").join(marked, "row", "left")
    return whole.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("spans", spans).alias("spans"),
    )
