"""Best-fit packing of token pieces with Martello-Toth dominance reduction.

The instance of a bin-packing problem is how many pieces of each length there
are: at most ``capacity`` counters, however many documents. Spark counts them,
the reduction and the best-fit run on the counters, and the plan (which
sequences take how many pieces of a length, at which offsets) goes back to the
pieces by their rank within their length.

Reduction, for the longest length L left and the room r beside it: a set that
holds L and dominates every other set that holds L is fixed for good. That is
L alone if nothing fits; L with a piece of exactly r; L with the longest
fitting k if no two pieces fit, or if k is at least as long as the best
fitting pair and no three fit; L with the pair (k, b) if no three pieces fit
and each other pair is element-wise no longer. A fixed set repeats while its
lengths last, for fewer pieces never break dominance. The rest is best-fit
decreasing: each bin opens with the longest piece and takes the longest that
fits, preferring a last piece that fills it.

Defined results: a null text is empty (one end id); repeated rows are packed one
by one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import cut, fan_out
from .tokens import encoded

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_id = batch.column("doc_id")
        for first, ids, off in encoded(batch, path, end_id):
            size = np.diff(off)
            count = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            at = off[:-1][row] + start
            body = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(body[4 * a : 4 * (a + b)]) for a, b in zip(at.tolist(), length.tolist(), strict=True)]
            cols = [doc_id.take(pa.array(row + first)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents; only a document longer than ``capacity`` is cut."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return text.mapInArrow(partial(_pieces, path=path, end_id=end_id, capacity=capacity), PIECES)


class Instance:
    """Counts of the lengths left."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.count = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.count[length] = n
        self.capacity = capacity

    def longest(self, room: int, used: tuple[int, ...] = ()) -> int:
        """The longest length of at most ``room`` that is left beside ``used``; 0 if none."""
        for x in np.flatnonzero(self.count[: max(0, room) + 1])[::-1]:
            if self.count[x] > used.count(int(x)):
                return int(x)
        return 0

    def smallest(self, k: int, used: tuple[int, ...]) -> list[int]:
        out: list[int] = []
        for x in np.flatnonzero(self.count):
            out += [int(x)] * int(min(k - len(out), self.count[x] - used.count(int(x))))
            if len(out) >= k:
                break
        return out

    def take(self, lengths: tuple[int, ...]) -> int:
        """Removes the set as often as its lengths last; says how often."""
        times = min(int(self.count[x]) // lengths.count(x) for x in set(lengths))
        for x in lengths:
            self.count[x] -= times
        return times

    def dominating(self, big: int) -> tuple[int, ...] | None:
        """A set with ``big`` that dominates all others with it, or None."""
        room = self.capacity - big
        k = self.longest(room, (big,))
        if not k:
            return (big,)
        if k == room:
            return (big, k)
        low = self.smallest(3, (big,))
        if len(low) < 2 or low[0] + low[1] > room:
            return (big, k)
        if len(low) == 3 and sum(low) <= room:
            return None
        pairs = [(a, b) for a in map(int, np.flatnonzero(self.count[: room + 1])) if self.count[a] > (a == big) and (b := self.longest(min(a, room - a), (big, a)))]
        if all(a + b <= k for a, b in pairs):
            return (big, k)
        b = self.longest(room - k, (big, k))
        if b and all(x <= k and y <= b for x, y in pairs):
            return (big, k, b)
        return None

    def best_fit(self, big: int) -> tuple[int, ...]:
        lengths = (big,)
        room = self.capacity - big
        while x := self.longest(room, lengths):
            if x < room:  # a pair that fills the room beats the longest piece with a gap behind it
                for a in map(int, np.flatnonzero(self.count[: room // 2 + 1])):
                    if self.count[room - a] > lengths.count(room - a) + (a == room - a) and self.count[a] > lengths.count(a):
                        return (*lengths, room - a, a)
            lengths += (x,)
            room -= x
        return lengths


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a bin, how many such bins): reduction first, then best fit."""
    left = Instance(counts, capacity)
    bins = []
    later: list[int] = []
    for big in range(capacity, 0, -1):
        while left.count[big]:
            fixed = left.dominating(big)
            if fixed is None:
                later.append(big)
                break
            bins.append((fixed, left.take(fixed)))
    for big in later:
        while left.count[big]:
            chosen = left.best_fit(big)
            bins.append((chosen, left.take(chosen)))
    return bins


def _runs(bins: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """For each (bin shape, length): the first rank within the length, first sequence, copies a bin, first offset."""
    used = np.zeros(capacity + 1, np.int64)
    rows = []
    sequence = 0
    for lengths, times in bins:
        offset = 0
        for x in sorted(set(lengths), reverse=True):
            copies = lengths.count(x)
            rows.append((x << 44 | int(used[x]), int(used[x]), sequence, copies, offset))
            used[x] += copies * times
            offset += copies * x
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return tuple(table.T)


def _place(batches: Iterator[pa.RecordBatch], runs: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    key, first, sequence, copies, offset = runs
    for batch in batches:
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        at = np.searchsorted(key, (length << 44) + rank, "right") - 1
        past = rank - first[at]
        out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        out += [pa.array(sequence[at] + past // copies[at]), pa.array(offset[at] + past % copies[at] * length)]
        yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and offset."""
    all_pieces = cut(pieces(docs, path, end_id, capacity), "pieces")
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(fan_out(docs.sparkSession)))
    salted = all_pieces.withColumn("salt", salt)
    # One row per (length, salt): a length of a third of all pieces is ranked in many tasks.
    counts = cut(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = _runs(plan(histogram, capacity), capacity)
    ahead = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    mine = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("r", F.row_number().over(mine)).join(base, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("r") - 1).cast("long").alias("rank"))
    return ranked.mapInArrow(partial(_place, runs=runs), PIECES + ", sequence_id long, offset long")
