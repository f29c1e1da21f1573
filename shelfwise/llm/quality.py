"""Quality rules with adaptive thresholds [native: DataFrame functions only].

Every document gets integer signals (per-mille rates of symbols, repeated
words and repeated lines, mean word length in tenths). A quantile sketch per
(language, source, signal) counts documents in log-linear buckets: buckets are
exact for values below 32 and 1/16 wide above, so a sketch has at most a few
hundred counters, and merging sketches is adding counters. Thresholds are
fences around the sketch's quartiles; a group with too few documents merges
its sketch into its language's, and that into the whole corpus'. The fences
join back to the documents and replace fixed cutoffs.

Defined results: a null text has no words and fails the base rule; a null
language or source is a group of its own; repeated rows are judged one by one;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: signal -> (fences wanted, slack in the signal's units, which keeps a zero-width sketch from rejecting its neighbours)
SIGNALS = {"symbols": ("upper", 30), "repeats": ("upper", 300), "dup_lines": ("upper", 400), "word_len": ("both", 30)}
FENCE = 3
MIN_GROUP = 200
FAILED_WORDS = 50


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def _repeat_stats(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in 3-word windows found twice or more.

    A window's 64-bit hash is shortened to make room for its place in one long;
    sorted longs put equal windows side by side. The number of distinct full
    hashes proves that shortening merged none; otherwise equal full hashes are
    searched one by one.
    """
    df = df.withColumn("_bits", F.length(F.bin(F.size("_w"))).cast("int"))
    df = df.withColumn(
        "_h",
        F.when(
            F.size("_w") >= 3,
            F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))),
        ).otherwise(F.expr("cast(array() as array<bigint>)")),
    )
    df = df.withColumn("_p", F.sort_array(F.transform("_h", _shift)))
    df = df.withColumn(
        "_n_short",
        F.size(F.filter("_p", lambda p, k: (k == 0) | (_top(p) != _top(F.get("_p", k - 1))))),
    )
    df = df.withColumn("_exact", F.col("_n_short") == F.size(F.array_distinct("_h")))
    near = F.filter(
        "_p",
        lambda p, k: F.coalesce(_top(p) == _top(F.get("_p", k - 1)), F.lit(False)) | F.coalesce(_top(p) == _top(F.get("_p", k + 1)), F.lit(False)),
    )
    slow = F.filter(
        F.sequence(F.lit(0), F.size("_h") - 1).cast("array<bigint>"),
        lambda i: F.size(F.filter("_h", lambda h: h == F.get("_h", i.cast("int")))) > 1,
    )
    df = df.withColumn(
        "_at",
        F.when(F.size("_h") == 0, F.expr("cast(array() as array<bigint>)"))
        .when(F.col("_exact"), F.sort_array(F.transform(near, lambda p: p.bitwiseAND(F.expr("shiftleft(1L, _bits) - 1")))))
        .otherwise(slow),
    )
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return df.withColumn("n_repeat_words", covered).drop("_bits", "_h", "_p", "_n_short", "_exact", "_at")


def _shift(h: Column, i: Column) -> Column:
    """The hash's low bits above ``_bits`` bits of place."""
    return F.call_function("shiftleft", h, F.col("_bits")).bitwiseOR(i.cast("long"))


def _top(p: Column) -> Column:
    return F.call_function("shiftright", p, F.col("_bits"))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of every whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", "lang", "source", text.alias("_t")).withColumn("_w", _words(F.col("_t")))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_l", lines).select(
        "doc_id",
        "lang",
        "source",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("_n_lines"),
        "_w",
    )
    df = _repeat_stats(df).drop("_w")
    return df.withColumn("base_failed", (F.col("n_words") < FAILED_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def with_signals(df: DataFrame) -> DataFrame:
    def per(a: str, b: str, by: int) -> Column:
        return F.when(F.col(b) > 0, F.expr(f"({by} * {a}) div {b}")).otherwise(F.lit(0)).cast("long")

    return df.withColumns(
        {
            "s_symbols": per("n_symbols", "word_chars", 1000),
            "s_repeats": per("n_repeat_words", "n_words", 1000),
            "s_dup_lines": per("n_dup_lines", "_n_lines", 1000),
            "s_word_len": per("word_chars", "n_words", 10),
        }
    )


def bucket(x: Column) -> Column:
    """Lower edge of the log-linear bucket that holds ``x`` >= 0."""
    low = F.greatest(F.length(F.bin(x)) - 5, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", x, low), low)


def sketches(signals: DataFrame) -> DataFrame:
    """(lang, source, signal, edge) -> n over the documents that pass the base rule."""
    pairs = ", ".join(f"'{s}', s_{s}" for s in SIGNALS)
    return (
        signals.filter(~F.col("base_failed"))
        .select("lang", "source", F.expr(f"stack({len(SIGNALS)}, {pairs}) as (signal, x)"))
        .groupBy("lang", "source", "signal", bucket(F.col("x")).alias("edge"))
        .agg(F.count("*").alias("n"))
    )


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartile edges of each sketch after merging to ``keys``: q25, q75 and the number of documents."""
    merged = sketch.groupBy(*keys, "edge").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("edge").rowsBetween(Window.unboundedPreceding, 0)
    run = merged.withColumns({"cum": F.sum("n").over(upto), "total": F.sum("n").over(whole)})
    return run.groupBy(*keys).agg(
        F.min(F.when(4 * F.col("cum") >= F.col("total"), F.col("edge"))).alias("q25"),
        F.min(F.when(4 * F.col("cum") >= 3 * F.col("total"), F.col("edge"))).alias("q75"),
        F.max("total").alias("total"),
    )


def fences(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source) -> lo_word_len, hi_<signal>; small groups use the merged sketch of their language, or of all."""
    own = quartiles(sketch, ["lang", "source", "signal"])
    by_lang = quartiles(sketch, ["lang", "signal"]).select(F.col("lang").alias("_lang"), F.col("signal").alias("_s2"), F.struct("q25", "q75", "total").alias("_b"))
    by_all = quartiles(sketch, ["signal"]).select(F.col("signal").alias("_s3"), F.struct("q25", "q75", "total").alias("_c"))
    joined = (
        own.withColumn("_a", F.struct("q25", "q75", "total"))
        .join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("signal") == F.col("_s2")))
        .join(by_all, F.col("signal") == F.col("_s3"))
    )
    use = F.when(F.col("_a.total") >= min_group, F.col("_a")).when(F.col("_b.total") >= min_group, F.col("_b")).otherwise(F.col("_c"))
    joined = joined.select("lang", "source", "signal", use.alias("q"))
    out = []
    for name, (side, slack) in SIGNALS.items():
        mine = F.when(F.col("signal") == name, F.col("q"))
        iqr = mine["q75"] - mine["q25"]
        out.append(F.max(mine["q75"] + FENCE * iqr + slack).alias(f"hi_{name}"))
        if side == "both":
            out.append(F.max(mine["q25"] - FENCE * iqr - slack).alias(f"lo_{name}"))
    return joined.groupBy("lang", "source").agg(*out)


def quality_rules(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per document: base counts, base_failed, the fences of its group and kept."""
    base = cut(with_signals(base_counts(docs)), "quality_base")
    limits = cut(fences(cut(sketches(base), "quality_sketch"), min_group), "quality_fences")
    limits = limits.withColumnRenamed("lang", "_lang").withColumnRenamed("source", "_source")
    df = base.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    good = F.lit(True)
    for name, (side, _) in SIGNALS.items():
        good = good & (F.col(f"s_{name}") <= F.col(f"hi_{name}"))
        if side == "both":
            good = good & (F.col(f"s_{name}") >= F.col(f"lo_{name}"))
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(good, F.lit(False))).alias("kept"),
        *[f"s_{s}" for s in SIGNALS],
        *[f"hi_{s}" for s in SIGNALS],
        "lo_word_len",
    )
