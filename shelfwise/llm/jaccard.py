"""Exact Jaccard join of word-shingle sets with a count-vector R-tree.

Documents with equal sets are one node. A set's shingles are hashed into
groups; the counts per group are its point, and the sum of two points'
coordinate minima bounds their overlap from above. A larger set has more
groups (a power of two, about a fifth of its size), and points fold to fewer
groups by adding counts, so any two compare in the groups of the smaller.

Which points meet: two sets of similarity t share min(m, ceil(t n)) shingles among the
first n - ceil(t n) + m of each in any common order, for any m up to ceil(t n). The
order is frequency, from a fixed-size sketch of the whole corpus, then hash, so shared
boilerplate comes last. A shingle that several nodes have among these is a block. A node
in fewer than m = ``SHARED`` blocks has no similar node: most nodes that share a
phrase by chance go here, before any point is sent.
First each node of a block is tried against the block's least node (a star);
surviving pairs of the bound are verified on the whole sets. Blocks whose
nodes still lie in different components then join in full: an R-tree over
their points finds the pairs whose bound passes, and these are verified node
by node where the texts of a few blocks lie together, but for pairs that have
come into one component by then; so no link between components is lost and
a large group of near copies does not verify all its pairs. Of blocks with the same nodes one is
joined, and a block beyond ``TILE`` nodes is dealt to tiles that meet pairwise.

Nodes without a pair that passes the bound leave their blocks before texts are sent, and the
rest are dealt anew by the least node left, so a set's text goes to few buckets.

With ``count_links`` every block joins in full without the stars: all pairs of
different sets whose bound passes are verified. A pair belongs to the least block
that both sets stand in, so it is verified in one task; the task adds up its links per
set and passes on these sums and a forest of the links, which grow with the sets and not
with their pairs. A document's number of links counts the rows with the linked sets,
copies included.

Defined results: a null, empty or wordless text has the empty set and is
linked with nothing; a text of fewer than k words has its whole sequence as its one
shingle; repeated rows share a component; of rows that repeat an id with other
texts the least text is compared; rows without an id have the component
of an equal set's row that has one, or none; extra columns are ignored; an empty
table gives no rows. n_links counts rows that have an id, the row itself not;
it is null for rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .store import bounded_batches, cut, fan_out, release
from .text import U, give_back, mix, shingles, texts, tidy

GROUPS, MOST_GROUPS = 32, 4096
SKETCH_BITS = 22
#: Shingles that two similar sets have in common among the first of each, unless a set has fewer.
SHARED = 4
TILE = 500
LEAF = 32
#: Blocks of at most so many nodes are a leaf of their own.
SMALL = 32
#: Pair codes of a bucket held before repeated ones are merged.
MOST_CODES = 1 << 22
#: Ids up to this many (8 bytes each) are broadcast to pick their texts; more are joined by shuffle.
BROADCAST_IDS = 200_000
#: Buckets of the block join in units of the shuffle partitions: one holds few pivots beside each other.
DEAL = 32

SETS = "doc_id long, n long, s1 long, s2 long, point binary, slot int, hits long"


def _points_of(row: np.ndarray, key: np.ndarray, n: np.ndarray) -> list[bytes]:
    """The count vector of each set, in as many groups as its size asks for."""
    groups = np.clip(1 << np.ceil(np.log2(np.maximum(n, 1) / 5)).astype(np.int64).clip(0), GROUPS, MOST_GROUPS)
    begin = np.cumsum(groups) - groups
    counts = np.bincount(begin[row] + (key % groups[row].astype(U)).astype(np.int64), minlength=int(groups.sum()))
    most = counts.max(initial=0)
    wide = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    body = counts.astype(f"<u{wide}").tobytes()
    return [bytes([wide]) + body[wide * a : wide * (a + g)] for a, g in zip(begin.tolist(), groups.tolist(), strict=True)]


class Points:
    """Count vectors of different widths, foldable to any common one."""

    def __init__(self, raw: list[bytes]):
        self.rows = [np.frombuffer(x, f"<u{x[0]}", offset=1) for x in raw]
        self.groups = np.array([len(r) for r in self.rows], np.int64)
        self.coarse = self.fold(np.arange(len(raw)), GROUPS)
        self.size = self.coarse.sum(1)

    def fold(self, which: np.ndarray, groups: int) -> np.ndarray:
        out = np.empty((len(which), groups), np.int32)
        for i, r in enumerate(which.tolist()):
            out[i] = self.rows[r].reshape(-1, groups).sum(0)
        return out

    def passing(self, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        """Whether the bound lets each pair (a, b) be similar, in the groups of the smaller."""
        ok = np.zeros(len(a), bool)
        least = np.minimum(self.groups[a], self.groups[b])
        for g in np.unique(least):
            pairs = np.flatnonzero(least == g)
            which, at = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
            p = self.fold(which, int(g))
            x, y = at[: len(pairs)], at[len(pairs) :]
            step = max(1, (1 << 22) // int(g))
            for lo in range(0, len(pairs), step):
                c = slice(lo, lo + step)
                bound = np.minimum(p[x[c]], p[y[c]]).sum(1)
                ok[pairs[c]] = _enough(bound, self.size[a[pairs[c]]] + self.size[b[pairs[c]]], percent)
        return ok


@tidy
def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """A row for each document's set; at the end, a row for each frequent counter of the task's sketch."""
    counters = np.zeros(1 << SKETCH_BITS, np.int64)
    names = ["doc_id", "n", "s1", "s2", "point", "slot", "hits"]
    for batch in batches:
        for src in texts(batch.column("text")):
            row, key = shingles(src.lowered().words(), k)
            n = np.bincount(row, minlength=src.n)
            first = np.concatenate([[0], np.cumsum(n)])
            sums = []
            for salt in (U(0), U(0x5851F42D4C957F2D)):
                total = np.concatenate([np.zeros(1, U), np.cumsum(mix(key ^ salt), dtype=U)])
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            np.add.at(counters, (key >> U(64 - SKETCH_BITS)).astype(np.int64), 1)
            cols = [batch.column("doc_id").slice(src.first, src.n), pa.array(n, pa.int64()), *(pa.array(s) for s in sums)]
            cols += [pa.array(_points_of(row, key, n), pa.binary()), pa.nulls(src.n, pa.int32()), pa.nulls(src.n, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names)
    mean = counters.mean()
    slot = np.flatnonzero(counters > 1 + mean + 6 * np.sqrt(mean))
    cols = [pa.nulls(len(slot), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())]
    yield pa.RecordBatch.from_arrays([*cols, pa.array(slot, pa.int32()), pa.array(counters[slot])], names)


@tidy
def _prefixes(batches: Iterator[pa.RecordBatch], k: int, percent: int, level: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(shingle, node hash) for the shingles of each set that must hold ``SHARED`` in common with any similar set."""
    seen = np.zeros(0, U)  # equal sets within a batch of rows are sent once
    for batch in batches:
        for src in texts(batch.column("text")):
            row, key = shingles(src.lowered().words(), k)
            n = np.bincount(row, minlength=src.n)
            first = np.concatenate([[0], np.cumsum(n)])
            total = np.concatenate([np.zeros(1, U), np.cumsum(mix(key), dtype=U)])
            node = total[first[1:]] - total[first[:-1]]
            fresh = np.zeros(src.n, bool)
            fresh[np.unique(node, return_index=True)[1]] = True
            fresh &= ~np.isin(node, seen) & (n > 0)
            seen = np.concatenate([seen[-(1 << 16) :], node[fresh]])
            keep = fresh[row]
            row, key = row[keep], key[keep]
            lv = level[(key >> U(64 - SKETCH_BITS)).astype(np.int64)]
            if lv.any():
                order = np.argsort(lv, kind="stable")
                order = order[np.argsort(row[order].astype(np.int32), kind="stable")]
                row, key = row[order], key[order]
            start = np.searchsorted(row, np.arange(src.n))
            place = np.arange(len(row)) - start[row]
            least = -(-n * percent // 100)  # shingles that a similar set has too
            use = place < (n - least + np.minimum(SHARED, least))[row]
            yield pa.RecordBatch.from_arrays([pa.array(key[use].view(np.int64)), pa.array(node[row[use]].view(np.int64))], ["t", "node"])


def _enough(bound: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap of ``bound`` can reach the similarity: bound / (sizes - bound) >= percent / 100."""
    return (100 + percent) * bound >= percent * sizes


@tidy
def _bounded(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            part = batch.slice(lo, 2000)
            points = Points(part.column("pa").to_pylist() + part.column("pb").to_pylist())
            n = part.num_rows
            ok = pa.array(points.passing(np.arange(n), n + np.arange(n), percent))
            yield pa.RecordBatch.from_arrays([part.column("a").filter(ok), part.column("b").filter(ok)], ["a", "b"])


def tree_pairs(of: Points, percent: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of ``left``, j of ``right``) whose bound passes, by an R-tree over the points of ``right``.

    Leaves pack points by size and then by their largest group; a node keeps the
    coordinate maxima and the least size of its points, and is entered by the
    points of ``left`` for which the bound against these passes.
    """
    points, size = of.coarse, of.size
    order = right[np.lexsort((points[right].argmax(1), size[right]))]
    top = [(points[order], size[order])]
    while len(top[-1][1]) > 1:
        p, s = top[-1]
        cuts = np.arange(0, len(s), LEAF if len(top) == 1 else 8)
        top.append((np.maximum.reduceat(p, cuts), np.minimum.reduceat(s, cuts)))
    who = np.repeat(left, len(top[-1][1]))
    node = np.tile(np.arange(len(top[-1][1])), len(left))
    for depth in range(len(top) - 1, -1, -1):
        p, s = top[depth]
        ok = np.zeros(len(who), bool)
        for a in range(0, len(who), 1 << 15):
            c = slice(a, a + (1 << 15))
            ok[c] = _enough(np.minimum(points[who[c]], p[node[c]]).sum(1), size[who[c]] + s[node[c]], percent)
        who, node = who[ok], node[ok]
        if depth:
            fan = LEAF if depth == 1 else 8
            below = len(top[depth - 1][1])
            count = np.minimum((node + 1) * fan, below) - node * fan
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            who, node = np.repeat(who, count), np.repeat(node * fan, count) + at
    return who, order[node]


class Sets:
    """The shingle sets of some texts, as runs of codes."""

    def __init__(self, column: pa.ChunkedArray, k: int):
        found = [(r + s.first, x) for s in texts(column) for r, x in [shingles(s.lowered().words(), k)]]
        row, key = (np.concatenate(x) for x in zip(*found, strict=True))
        known, self.code = np.unique(key, return_inverse=True)
        self.first = np.searchsorted(row, np.arange(len(column) + 1))
        self.size = np.diff(self.first)
        self.mark = np.zeros(len(known), np.int64)

    def shared(self, a: int, others: np.ndarray) -> np.ndarray:
        """Shingles that set ``a`` has in common with each of the others, none of them empty."""
        mine = self.code[self.first[a] : self.first[a + 1]]
        self.mark[mine] = 1
        size = self.size[others]
        begin = np.cumsum(size) - size
        at = np.repeat(self.first[others] - begin, size) + np.arange(size.sum())
        out = np.add.reduceat(self.mark[self.code[at]], begin)
        self.mark[mine] = 0
        return out


def link_pairs(sets: Sets, comp: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs (a, b) that join the components of ``comp``; every similar pair ends in one component."""
    root = {int(c): int(c) for c in np.unique(comp)}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    cuts = np.flatnonzero(np.diff(a)) + 1
    out: list[tuple[int, int]] = []
    for part in np.split(np.arange(len(a)), cuts):
        if not len(part):
            continue
        x = int(a[part[0]])
        mine = find(int(comp[x]))
        others = np.array([y for y in b[part].tolist() if find(int(comp[y])) != mine], np.int64)
        for lo in range(0, len(others), 512):
            some = others[lo : lo + 512]
            for y in some[_enough(sets.shared(x, some), sets.size[x] + sets.size[some], percent)].tolist():
                if find(int(comp[y])) != find(int(comp[x])):
                    root[find(int(comp[y]))] = find(int(comp[x]))
                    out.append((x, y))
    return tuple(np.array(out, np.int64).reshape(-1, 2).T)


def every_link(sets: Sets, a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) that are similar enough."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    cuts = [*np.flatnonzero(np.diff(a, prepend=-1)).tolist(), len(a)]
    ok = np.zeros(len(a), bool)
    for lo, hi in pairwise(cuts):
        for at in range(lo, hi, 512):
            c = slice(at, min(at + 512, hi))
            x = int(a[at])
            ok[c] = _enough(sets.shared(x, b[c]), sets.size[x] + sets.size[b[c]], percent)
    return a[ok], b[ok]


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The links (a, b) that join parts of the n nodes which the links before leave apart."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = np.zeros(len(a), bool)
    for at, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = find(x), find(y)
        if x != y:
            root[y] = x
            keep[at] = True
    return a[keep], b[keep]


def own_pairs(group: pa.Table, standing: pa.ListArray, node: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the least block that both nodes of a pair (places a, b of ``node``) stand in brings them together here.

    ``group`` has the tile pairs (t, i, j) of this bucket; ``standing`` all blocks of each node, here or elsewhere."""
    size = np.diff(np.asarray(standing.offsets))
    begin = np.cumsum(size) - size
    known, code = np.unique(np.asarray(standing.flatten()), return_inverse=True)
    mark = np.zeros(len(known), bool)
    least = np.full(len(a), len(known))
    order = np.lexsort((b, a))
    for some in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
        mine = code[begin[a[some[0]]] :][: size[a[some[0]]]]
        mark[mine] = True
        for lo in range(0, len(some), 512):
            n = size[b[some[lo : lo + 512]]]
            first = np.cumsum(n) - n
            at = np.repeat(begin[b[some[lo : lo + 512]]] - first, n) + np.arange(n.sum())
            least[some[lo : lo + 512]] = np.minimum.reduceat(np.where(mark[code[at]], code[at], len(known)), first)
        mark[mine] = False
    t, i, j, tile, who = (np.asarray(group.column(c)).astype(np.int64) for c in ("t", "i", "j", "tile", "node"))
    t = np.searchsorted(known, t)
    here, row = np.unique(t * len(node) + np.searchsorted(node, who), return_index=True)
    tiles = []
    own = np.ones(len(a), bool)
    for side in (a, b):
        key = least * len(node) + side
        at = np.searchsorted(here, key).clip(max=len(here) - 1)
        own &= here[at] == key
        tiles.append(tile[row[at]])
    wide = int(max(i.max(), j.max())) + 1
    own &= np.isin((least * wide + np.minimum(*tiles)) * wide + np.maximum(*tiles), (t * wide + i) * wide + j)
    return own


def _merged(codes: list[np.ndarray], most: int) -> list[np.ndarray]:
    """The pair codes, once each as soon as more than ``most`` have come together."""
    return [np.unique(np.concatenate(codes))] if sum(map(len, codes)) > most else codes


def _bounded_pairs(group: pa.Table, known: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """The nodes of some tile pairs (t, i, j) of blocks, their components, their rows in ``known``, and the pairs
    (a, b) of places in these whose components differ and whose bound passes. ``known`` has the nodes' points."""
    t, i, j, tile, node, comp = (np.asarray(group.column(c)).astype(np.int64) for c in ("t", "i", "j", "tile", "node", "comp"))
    _, first, number = np.unique(node, return_index=True, return_inverse=True)
    node, comp = node[first], comp[first]
    of = pa.array(np.argsort(np.asarray(known.column("id")).astype(np.int64)))  # the same nodes, once each
    points = Points(known.column("p").take(of).to_pylist())
    order = np.lexsort((j, i, t))
    cuts = np.flatnonzero((np.diff(t[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
    small: list[np.ndarray] = []
    pairs = []
    for part in np.split(order, cuts):
        if i[part[0]] == j[part[0]]:
            who = np.unique(number[part])
            if len(who) <= SMALL:
                small.append(who)
                continue
            a, b = tree_pairs(points, percent, who, who)
        else:
            a, b = tree_pairs(points, percent, np.unique(number[part[tile[part] == i[part[0]]]]), np.unique(number[part[tile[part] == j[part[0]]]]))
        pairs = _merged([*pairs, np.minimum(a, b) * len(node) + np.maximum(a, b)], MOST_CODES)
    for size in {len(w) for w in small}:  # all small blocks of a size at once
        x, y = np.triu_indices(size, 1)
        blocks = np.unique(np.stack([w for w in small if len(w) == size]), axis=0)
        step = max(1, MOST_CODES // max(1, len(x)))
        for lo in range(0, len(blocks), step):
            some = blocks[lo : lo + step]
            pairs = _merged([*pairs, np.unique((some[:, x] * len(node) + some[:, y]).ravel())], MOST_CODES)
    code = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    a, b = code // len(node), code % len(node)
    differ = comp[a] != comp[b]
    a, b = a[differ], b[differ]
    ok = points.passing(a, b, percent)
    return node, comp, of, a[ok], b[ok]


def _bounded_nodes(group: pa.Table, known: pa.Table, percent: int) -> pa.Table:
    """The nodes that stand in some pair whose bound passes, with their bucket."""
    node, _, _, a, b = _bounded_pairs(group, known, percent)
    some = node[np.unique(np.concatenate([a, b]))]
    give_back()
    return pa.table({"to": pa.array(np.full(len(some), group.column("bucket")[0].as_py(), np.int64)), "id": pa.array(some)})


def _join_blocks(group: pa.Table, known: pa.Table, k: int, percent: int) -> pa.Table:
    """Links that join components; ``known`` has the texts as well."""
    node, comp, of, a, b = _bounded_pairs(group, known, percent)
    if len(a):
        a, b = link_pairs(Sets(known.column("text").take(of), k), comp, a, b, percent)
        give_back()
    return pa.table({"a": pa.array(np.minimum(node[a], node[b])), "b": pa.array(np.maximum(node[a], node[b]))})


def _count_links(group: pa.Table, known: pa.Table, k: int, percent: int) -> pa.Table:
    """(node, null, rows linked with it by this bucket's own pairs) and the links (a, b, null) of a forest."""
    node, _, of, a, b = _bounded_pairs(group, known, percent)
    if len(a):
        own = own_pairs(group, known.column("standing").take(of).combine_chunks(), node, a, b)
        a, b = a[own], b[own]
    if len(a):
        a, b = every_link(Sets(known.column("text").take(of), k), a, b, percent)
        give_back()
    copies = np.asarray(known.column("copies").take(of)).astype(np.int64)
    n = np.zeros(len(node), np.int64)
    np.add.at(n, a, copies[b])
    np.add.at(n, b, copies[a])
    some = np.flatnonzero(n)
    a, b = _forest(a, b, len(node))
    ends = pa.array(np.concatenate([node[some], node[a]])), pa.chunked_array([pa.nulls(len(some), pa.int64()), pa.array(node[b])])
    return pa.table({"a": ends[0], "b": ends[1], "n": pa.chunked_array([pa.array(n[some]), pa.nulls(len(a), pa.int64())])})


@tidy
def _verified(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets are similar enough."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            keys = []
            for c in ("ta", "tb"):
                found = [shingles(s.lowered().words(), k) + (s.first,) for s in texts(part.column(c))]
                keys.append((np.concatenate([r + f for r, _, f in found]), np.concatenate([x for _, x, _ in found])))
            (ra, ka), (rb, kb) = keys
            n = part.num_rows
            sizes = np.bincount(ra, minlength=n) + np.bincount(rb, minlength=n)
            row, key = np.concatenate([ra, rb]), np.concatenate([ka, kb])
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            same = (row[1:] == row[:-1]) & (key[1:] == key[:-1])
            inter = np.bincount(row[1:][same], minlength=n)
            ok = pa.array(_enough(inter, sizes, percent))
            yield pa.RecordBatch.from_arrays([part.column("a").filter(ok), part.column("b").filter(ok)], ["a", "b"])


def _texts(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """id, text of the documents of ``ids``, one row each."""
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    text = docs.select(F.col("doc_id").alias("id"), "text").join(few, "id")
    return cut(text.groupBy("id").agg(F.min("text").alias("text")), name)


def _verify(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b: document ids of nodes) that link. The many-partner side b travels once, to its partner a."""
    pairs = cut(pairs, "pairs")
    ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair_ids")
    text = _texts(docs, ids, "pair_texts")
    b = pairs.join(text.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    both = b.join(text.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(partial(_verified, k=k, percent=percent), "a long, b long")


def _members(blocks: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(t, node) of the nodes that stand in as many blocks as a similar node would share with them."""
    held = blocks.join(nodes.select("s1", "node", "n"), "s1")
    # A node has few blocks, as many as its text has shingles at most.
    held = held.withColumn("blocks", F.count("*").over(Window.partitionBy("s1", "node")))
    return held.filter(f"blocks >= least({SHARED}, (n * {percent} + 99) div 100)").select("t", "node")


def _dealt(members: DataFrame, name: str) -> DataFrame:
    """Tile pairs (t, i, j) of blocks with nodes of different components, one block of those with equal nodes, dealt to buckets."""
    members = members.filter("t is not null").repartition("t")  # the counting and the join read the same exchange
    if "comp" not in members.columns:
        members = members.withColumn("comp", F.col("node"))
    sign = F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sign")
    split = members.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("node").alias("pivot"), F.count("*").alias("size"), sign).filter("lo < hi")
    split = split.groupBy("size", "sign").agg(F.min(F.struct("t", "pivot")).alias("one"))
    mixed = members.join(split.select("one.t", "one.pivot", F.expr(f"cast(ceil(size / {TILE}) as int)").alias("k")), "t")
    mixed = mixed.withColumn("tile", F.expr("cast(pmod(xxhash64(node), k) as int)"))
    met = F.expr("transform(sequence(0, k - 1), x -> struct(least(x, tile) as i, greatest(x, tile) as j))")
    # Blocks with the same least node mostly hold the same nodes, so they meet in one task, to which each point goes once.
    deal = F.pmod(F.xxhash64("pivot", "i", "j"), F.lit(DEAL * fan_out(members.sparkSession))).cast("long").alias("bucket")
    mixed = mixed.withColumn("ij", F.explode(met)).select("t", "pivot", "node", "comp", "tile", "ij.i", "ij.j")
    return cut(mixed.select(deal, "t", "node", "comp", "tile", "i", "j"), name)


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80, count_links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``; with ``count_links`` also n_links."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = cut(docs.mapInArrow(partial(_sets, k=k), SETS), "sets")
    sets = found.filter("slot is null")
    # At most 2**SKETCH_BITS counters, whatever the corpus.
    hot = found.filter("slot is not null").groupBy("slot").agg(F.sum("hits").alias("hits")).toPandas()
    level = np.zeros(1 << SKETCH_BITS, np.uint8)
    level[hot["slot"].to_numpy(np.int64)] = np.log2(np.maximum(hot["hits"].to_numpy(np.float64), 1)).astype(np.uint8)

    nodes = sets.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("node"), F.first("point").alias("point"), F.count("doc_id").alias("copies"))
    nodes = cut(nodes.filter("node is not null"), "nodes")
    # Dealt once by shingle, for the counting and for the join.
    keys = docs.mapInArrow(partial(_prefixes, k=k, percent=percent, level=level), "t long, node long").repartition("t")
    several = keys.groupBy("t").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("t")
    blocks = cut(keys.join(several, "t").select("t", F.col("node").alias("s1")).distinct(), "blocks")
    release(docs.sparkSession)
    members = cut(_members(blocks, nodes, percent), "members")
    release(docs.sparkSession)
    point = nodes.select(F.col("node").alias("id"), F.col("point").alias("p"))

    def known(pairs: DataFrame, name: str) -> DataFrame:
        return pairs.join(point.select(F.col("id").alias(name), F.col("p").alias(f"p{name}")), name)

    if not count_links:
        pivot = members.groupBy("t").agg(F.min("node").alias("a"))
        stars = members.join(pivot, "t").filter("node != a").select("a", F.col("node").alias("b")).distinct()
        stars = known(known(stars, "a"), "b").select("a", "b", "pa", "pb").mapInArrow(partial(_bounded, percent=percent), "a long, b long")
        links = cut(_verify(stars, docs, k, percent), "links")
        roots = cut(components(links), "roots")
        members = members.join(roots, "node", "left")
        members = cut(members.select("t", "node", F.coalesce("root", "node").alias("comp")), "members")
    mixed = _dealt(members, "mixed")
    release(docs.sparkSession)
    needed = mixed.select(F.col("bucket").alias("to"), F.col("node").alias("id")).distinct().join(point, "id")

    def bounded(group: pa.Table, known: pa.Table) -> pa.Table:
        return _bounded_nodes(group, known, percent)

    some = mixed.groupBy("bucket").cogroup(needed.groupBy("to")).applyInArrow(bounded, "to long, id long")
    some = cut(cut(some, "bounded_nodes").select("id").distinct(), "mixed_ids")
    release(docs.sparkSession)
    # Texts go only where nodes with a pair that passes the bound meet.
    few = F.broadcast(some) if some.count() <= BROADCAST_IDS else some
    left = mixed.join(few.withColumnRenamed("id", "node"), "node", "left_semi")
    mixed = _dealt(left.select("t", "node", "comp").distinct(), "mixed_left")
    known = mixed.select(F.col("bucket").alias("to"), F.col("node").alias("id")).distinct().join(point, "id").join(_texts(docs, some, "mixed_texts"), "id")

    def join(group: pa.Table, known: pa.Table) -> pa.Table:
        return _join_blocks(group, known, k, percent)

    def count(group: pa.Table, known: pa.Table) -> pa.Table:
        return _count_links(group, known, k, percent)

    if count_links:
        standing = mixed.groupBy(F.col("node").alias("id")).agg(F.sort_array(F.collect_set("t")).alias("standing"))
        known = known.join(standing, "id").join(nodes.select(F.col("node").alias("id"), "copies"), "id")
        more = cut(mixed.groupBy("bucket").cogroup(known.groupBy("to")).applyInArrow(count, "a long, b long, n long"), "links")
        roots = cut(components(more.filter("b is not null")), "roots")
    else:
        more = cut(mixed.groupBy("bucket").cogroup(known.groupBy("to")).applyInArrow(join, "a long, b long"), "links")
        if not more.isEmpty():
            roots = cut(components(links.unionByName(more)), "roots")
    label = nodes.join(roots, "node", "left").select("s1", "s2", "n", "node", "copies", F.coalesce("root", "node").alias("component_id"))
    if count_links:
        linked = more.filter("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
        label = label.join(linked, "node", "left")
        label = label.withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
    out = sets.select("doc_id", "n", "s1", "s2").join(label.drop("node", "copies", "others"), ["s1", "s2", "n"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.withColumns({"n_shingles": F.col("n"), "component_id": own})
    if not count_links:
        return out.select("doc_id", "n_shingles", "component_id")
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
    return out.select("doc_id", "n_shingles", "component_id", n_links.alias("n_links"))
