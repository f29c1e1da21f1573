"""Mixing sources to target weights by iterative proportional fitting [native].

Documents fall into cells (source, language, topic). Topics are the corpus'
leading content words: the ``topics`` words of ``LONG`` letters or more that
stand in most documents; a document's topic is the leader it holds most often
(the first of equals), or none. Cell weights start as token counts and are
raked: scaled in turn so that the sums by source, by language and by topic
meet their targets, until they hold together. Targets are given shares, or
the tempered token shares share ** TEMPER, renormalised. A document is then
kept with probability min(1, s * weight / tokens of its cell), where s is such
that a share ``KEEP`` of all tokens is expected: the expected tokens have the
raked shares but for cells that would need more tokens than they hold. That
share comes first, and the targets are missed by what such cells lack.

With ``on_target`` the targets come first: ``keep`` is lowered to the greatest
share for which no source, language or topic needs more tokens than it holds,
and raking has the bound inside: each factor is solved for sum(min(tokens,
factor * weight)), so capped cells' tokens are made up by the others. It goes
on until no share is off its target by ``TOLERANCE`` or more. If it does not
get there, keep falls by ``STEP``; if that brings the shares no nearer, the
targets contradict each other on the cells there are, the greater keep stays,
and the miss is logged.

Only word counts, cell sums and the final lookup touch the documents; raking
runs on the cells, which catalogues bound, in partitions sized by their count.

Defined results: a null or empty text has no words and topic none; a null
source or language is the value '(none)'; a cell without tokens keeps its
documents; repeated rows share their fate, which a hash of the id
decides; extra columns stay; an empty table gives no rows.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut

WORD_GAP = r"[\x20\x09-\x0D]+"
NONE = "(none)"
TOPICS = 8
LONG = 6
TEMPER = 0.7
ROUNDS = 10
KEEP = 0.8
#: The largest miss of a share that ``on_target`` leaves, its rounds at one keep and between looks at the miss, and the fall of keep.
TOLERANCE = 1e-3
MOST_ROUNDS, LOOK = 60, 4
STEP = 0.8
DIMENSIONS = ("source", "lang", "topic")
#: Cells up to this many rows are looked up by broadcast; more by a shuffle join.
BROADCAST_CELLS = 100_000


def words() -> Column:
    return F.array_remove(F.split(F.coalesce("text", F.lit("")), WORD_GAP), "")


def leaders(docs: DataFrame, topics: int = TOPICS, long: int = LONG) -> list[str]:
    """The words of at least ``long`` letters that stand in most documents."""
    held = F.array_distinct(F.filter(words(), lambda w: F.length(w) >= long))
    counts = docs.select(F.explode(held).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return [r["w"] for r in counts.orderBy(F.desc("n"), "w").limit(topics).collect()]


def _times(term: str) -> Column:
    return F.size("_k") - F.size(F.array_remove("_k", term))


def described(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``docs`` with _source, _lang, _topic and _words."""
    out = docs.withColumn("_w", words())  # a column of its own, so that texts are split once
    if terms:
        known = F.filter("_w", lambda w: (F.length(w) >= min(map(len, terms))) & w.isin(terms))
        # The leader with most occurrences, the earliest of equals: the maximum of (count, -place, leader).
        best = F.array_max(F.array(*[F.struct(_times(t).alias("n"), F.lit(-i).alias("p"), F.lit(t).alias("t")) for i, t in enumerate(terms)]))
        topic = F.when(F.size("_k") > 0, best["t"]).otherwise(F.lit(NONE))
    else:
        known, topic = F.expr("cast(array() as array<string>)"), F.lit(NONE)
    out = out.withColumns({"_words": F.size("_w").cast("long"), "_k": known}).drop("_w")
    keys = {f"_{c}": F.coalesce(F.col(c).cast("string"), F.lit(NONE)) for c in ("source", "lang")}
    return out.withColumns(keys | {"_topic": topic}).drop("_k")


def with_targets(cells: DataFrame, targets: dict[str, dict[str, float]] | None, temper: float) -> DataFrame:
    """Each cell with the share that its source, its language and its topic shall have."""
    for c in DIMENSIONS:
        key = f"_{c}"
        if targets and c in targets:
            given = F.create_map(*[x for k, v in targets[c].items() for x in (F.lit(k), F.lit(float(v)))])
            cells = cells.withColumn(f"t_{c}", F.coalesce(F.element_at(given, F.col(key)), F.lit(0.0)))
            continue
        sums = cells.groupBy(key).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("_p"))
        total = sums.agg(F.sum("_p")).first()[0]
        cells = cells.join(sums.select(key, (F.col("_p") / F.lit(total)).alias(f"t_{c}")), key)
    return cells


def rake(cells: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Cells with the fitted weight ``w``; ``w`` starts as the token count."""
    for r in range(rounds):
        for c in DIMENSIONS:
            total = F.sum("w").over(Window.partitionBy(f"_{c}"))
            cells = cells.withColumn("w", F.when(total > 0, F.col("w") * F.col(f"t_{c}") / total).otherwise(F.col("w")))
        if r % 2 == 1 or r + 1 == rounds:
            cells = cut(cells, "raked")
    return cells


def _filled_up(cells: DataFrame, c: str, aim: Column) -> DataFrame:
    """``u`` times the factor of its ``c`` value for which sum(min(tokens, u * tokens)) is the value's target share of ``aim`` tokens."""
    order = Window.partitionBy(f"_{c}").orderBy(F.desc("u"), *(f"_{d}" for d in DIMENSIONS))
    capped = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    free = F.sum(F.col("u") * F.col("tokens")).over(order.rowsBetween(0, Window.unboundedFollowing))
    line = F.when(free > 0, (F.col(f"t_{c}") * aim - capped) / free)
    factor = F.coalesce(F.max("_line").over(Window.partitionBy(f"_{c}")), F.lit(0.0))
    # A factor without end, of targets that contradict each other, stays a number.
    return cells.withColumn("_line", line).withColumn("u", F.least(F.lit(1e100), F.col("u") * F.greatest(F.lit(0.0), factor))).drop("_line")


def _miss(cells: DataFrame) -> float:
    """The largest difference of a source's, language's or topic's share of the expected tokens from its target."""
    w = F.least(F.lit(1.0), F.col("u")) * F.col("tokens")
    by = [cells.groupBy(f"_{c}").agg(F.sum(w).alias("w"), F.first(f"t_{c}").alias("t")).select(F.lit(c).alias("c"), "w", "t") for c in DIMENSIONS]
    total = F.sum("w").over(Window.partitionBy("c"))
    sums = by[0].unionByName(by[1]).unionByName(by[2])
    return sums.select(F.abs(F.when(total > 0, F.col("w") / total).otherwise(F.lit(0.0)) - F.col("t")).alias("e")).agg(F.max("e")).first()[0] or 0.0


def _raked_there(cells: DataFrame, k: float, total: int, parts: int) -> tuple[DataFrame, float]:
    """The cells with ``u`` raked at one keep ``k``, and the miss; on Spark."""
    now = cells.withColumn("u", F.lit(float(k)))
    for _ in range(0, MOST_ROUNDS, LOOK):
        now = now.repartition(parts)
        for c in DIMENSIONS * LOOK:
            now = _filled_up(now, c, F.lit(float(k * total)))
        now = cut(now, "on_target")
        miss = _miss(now)
        if miss < TOLERANCE:
            break
    return now, miss


def _raked_here(cells: pd.DataFrame, k: float, total: int) -> tuple[np.ndarray, float]:
    """``_raked_there`` for cells that fit a broadcast: the same rounds on the driver."""
    tokens = cells["tokens"].to_numpy(np.float64)
    groups = [(list(cells.groupby(f"_{c}").indices.values()), cells[f"t_{c}"].to_numpy(np.float64)) for c in DIMENSIONS]
    u = np.full(len(tokens), float(k))
    for r in range(MOST_ROUNDS):
        for members, t in groups:
            for at in members:
                at = at[np.argsort(-u[at], kind="stable")]
                w = u[at] * tokens[at]
                capped = np.cumsum(tokens[at]) - tokens[at]
                free = np.cumsum(w[::-1])[::-1]
                lines = (t[at] * k * total - capped)[free > 0] / free[free > 0]
                u[at] = np.minimum(1e100, u[at] * max(0.0, lines.max(initial=0.0)))
        w = np.minimum(1.0, u) * tokens
        whole = w.sum() or 1.0
        miss = max(abs(w[at].sum() / whole - t[at[0]]) for members, t in groups for at in members)
        if (r + 1) % LOOK == 0 and miss < TOLERANCE:
            break
    return u, float(miss)


def on_targets(cells: DataFrame, keep: float, parts: int, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells (with tokens and t_ shares) with ``u``, where min(1, u) is the probability that meets the targets.

    No share misses its target by ``tolerance`` or more, unless the targets contradict each other.
    A wider one lets cells that hold too little be kept whole, and so keeps more of the others.
    """
    sums = [cells.groupBy(f"_{c}").agg(F.sum("tokens").alias("n"), F.first(f"t_{c}").alias("t")).select(F.lit(c).alias("c"), "n", "t") for c in DIMENSIONS]
    known = sums[0].unionByName(sums[1]).unionByName(sums[2])
    whole = known.groupBy("c").agg(F.sum("t").alias("t_all"), F.sum("n").alias("tokens"))
    by = {r["c"]: r for r in whole.collect()}  # one row per dimension
    if not by or min(r["t_all"] for r in by.values()) <= 0:
        return cells.withColumn("u", F.lit(float(keep)))
    total = by[DIMENSIONS[0]]["tokens"]
    cells = cells.withColumns({f"t_{c}": F.col(f"t_{c}") / F.lit(by[c]["t_all"]) for c in DIMENSIONS})
    share = known.join(whole.select("c", "t_all"), "c").filter("t > 0").select((F.col("n") * F.col("t_all") / F.col("t")).alias("s")).agg(F.min("s")).first()[0]
    k = min(keep, share / total) if tolerance <= TOLERANCE else keep  # a value's stock bounds what exact shares can keep
    few = cells.toPandas() if cells.count() <= BROADCAST_CELLS else None
    best = None
    while True:
        now, miss = _raked_here(few, k, total) if few is not None else _raked_there(cells, k, total, parts)
        if miss >= tolerance and best is not None and miss > 0.9 * best[1]:
            logging.getLogger(__name__).warning("mixing: the targets contradict each other; a share misses its target by %.4f", best[1])
            now, miss = best[0], 0.0
        if miss < tolerance:
            return now if few is None else cells.sparkSession.createDataFrame(few[[f"_{c}" for c in DIMENSIONS]].assign(u=now))
        best = (now, miss)
        k *= STEP


def probabilities(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER, rounds: int = ROUNDS, keep: float = KEEP, on_target: bool = False, tolerance: float = TOLERANCE) -> DataFrame:
    """(_source, _lang, _topic) -> tokens, probability, from documents that ``described`` has described."""
    cells = cut(docs.groupBy("_source", "_lang", "_topic").agg(F.sum("_words").alias("tokens")), "cells")
    parts = -(-max(1, cells.count()) // 100_000)
    filled = cut(with_targets(cells.filter("tokens > 0"), targets, temper).repartition(parts), "targets")
    if on_target:
        p = F.round(F.least(F.lit(1.0), F.col("u")), 9).alias("probability")
        fitted = on_targets(filled, keep, parts, tolerance).select("_source", "_lang", "_topic", p)
        return cells.join(fitted, ["_source", "_lang", "_topic"], "left").withColumn("probability", F.coalesce("probability", F.lit(1.0)))
    raked = rake(filled.repartition(parts).withColumn("w", F.col("tokens").cast("double")), rounds)
    ratio = raked.select("_source", "_lang", "_topic", "tokens", "w", (F.col("w") / F.col("tokens")).alias("ratio"))
    # The tokens expected at scale s, sum(min(tokens, s * w)), is the least of the lines that cap the first j cells by
    # falling ratio, so s is the greatest of the solutions of these lines.
    order = Window.orderBy(F.desc("ratio"), "_source", "_lang", "_topic")
    capped = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    free = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    aim = F.lit(keep) * F.sum("tokens").over(Window.partitionBy(F.lit(1)))
    scale = ratio.select(((aim - capped) / free).alias("s")).agg(F.max("s")).first()[0]
    p = F.round(F.least(F.lit(1.0), F.lit(scale) * F.col("ratio")), 9)
    fitted = ratio.select("_source", "_lang", "_topic", p.alias("probability"))
    return cells.join(fitted, ["_source", "_lang", "_topic"], "left").withColumn("probability", F.coalesce("probability", F.lit(1.0)))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from the id and the seed: 52 bits of a digest."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, seed: int = 9, temper: float = TEMPER, rounds: int = ROUNDS, keep: float = KEEP, with_text: bool = True, on_target: bool = False, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` (or their ids alone) with _source, _lang, _topic, _words, _probability and _kept."""
    labelled = described(docs, leaders(docs))
    if not with_text:  # then what is known of the texts is written once
        labelled = cut(labelled.select("doc_id", "_source", "_lang", "_topic", "_words"), "described")
    fitted = cut(probabilities(labelled, targets, temper, rounds, keep, on_target, tolerance), "probabilities")
    fitted = F.broadcast(fitted) if fitted.count() <= BROADCAST_CELLS else fitted
    fitted = fitted.select("_source", "_lang", "_topic", F.col("probability").alias("_probability"))
    out = labelled.join(fitted, ["_source", "_lang", "_topic"])
    return out.withColumn("_kept", uniform(F.col("doc_id"), seed) < F.col("_probability"))
