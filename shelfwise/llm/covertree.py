"""Hard-negative mining over cover trees of norm-augmented candidates.

Candidates are integer vectors x; one more coordinate sqrt(M^2 - |x|^2), with M
the greatest norm of a block, puts a block's candidates on one sphere, where
the inner product with an anchor falls with the angle to it. Rows are dealt to
blocks by label (small labels share blocks, large ones are split by id), and
each block holds one cover tree: a node of level i covers its members within
R / 2^i of its centre, the centre stays a centre below, and the centres of a
node's children are more than the next radius apart. With the angle t between
anchor and centre and the covering angle f, all members' products lie within
|q| M cos(t + f) and |q| M cos(max(0, t - f)).

Anchors descend a tree together, a pack at a time, best first by upper bound:
the bounds of a level are one matrix product with the pack, and so are the
points that its anchors verify (in floats that hold the whole numbers exactly,
else in longs). A node outside all of an anchor's windows (or below what these
already hold) is skipped for it, and one that all of a pack skip is not read;
anchors of a pack are neighbours in a cover tree of their own, so they skip
alike. Positives take blocks of the anchor's own label with an open window;
negatives take all others, with one window for each positive:
percent_low * p <= 100 * n <= percent_high * p.

What anchors meet is dealt in cells: a large pack of anchors and a run of
blocks. A task holds one pack and streams its blocks, so what an anchor has
found in one block spares it work in the next, and only its best of the run
goes on.

Defined results: rows with a null id, a null label, or a vector that is null or
holds null or non-finite components take no part; of rows that repeat an id
the least (vector, label) stands; a shorter vector counts as padded with
zeros; ties go to the smaller id; extra columns are ignored; an empty table
gives no rows. Products must fit in a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import cut, release

BLOCK_ROWS = 4096
ANCHOR_ROWS = 256
#: A node of so few members keeps them as points.
LEAF = 16
#: Levels at most; what a node of the last level covers are copies, or nearly so.
LEVELS = 24
#: Centres that a growing tree tries at once.
CENTRES = 256
#: Points verified at once: as many by the first block that an anchor meets, and at most.
FIRST_POINTS, POINTS = 256, 4096
#: Hits on average, in units of an anchor's places, beyond which its windows are narrowed before they are filled.
DENSE = 8
#: Least products of a cell that is not the only one, cells for each core at most, and tasks at most.
CELL_PRODUCTS, CELLS_PER_CORE, TASKS = 1 << 27, 4, 1 << 14
#: Bytes of a cell's anchors in memory at most.
CELL_BYTES = 80 << 20
#: Smaller labels' counts that are joined by broadcast.
BROADCAST_LABELS = 100_000

NEVER, LEAST = np.iinfo(np.int64).max, -np.iinfo(np.int64).max


def candidates(vectors: DataFrame, scale: int = 256, label: Column | str = "label") -> DataFrame:
    """vec_id, label, v: the rows that take part, as integer vectors."""
    label = F.col(label) if isinstance(label, str) else label
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = vectors.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.coalesce(usable, F.lit(False)))
    ints = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    one = F.min(F.struct(ints.alias("v"), label.cast("long").alias("label"))).alias("x")
    return good.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(one).select("vec_id", "x.label", "x.v")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    out = np.zeros((len(column), int(size.max(initial=0))), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = np.asarray(column.flatten())
    return out


class CoverTree:
    """Nodes in arrays: ``centre`` (row), ``angle`` (covering angle), ``kids`` and ``points`` (rows) by offsets."""

    def __init__(self, centre: np.ndarray, angle: np.ndarray, kid_at: np.ndarray, kids: np.ndarray, point_at: np.ndarray, points: np.ndarray, top: float):
        self.centre, self.angle, self.top = centre, angle, top
        self.kid_at, self.kids, self.point_at, self.points = kid_at, kids, point_at, points

    def order(self) -> np.ndarray:
        """All points, those of a node together."""
        out, todo = [], [0] if len(self.centre) else []
        while todo:
            at = todo.pop()
            out.append(self.points[self.point_at[at] : self.point_at[at + 1]])
            todo += self.kids[self.kid_at[at] : self.kid_at[at + 1]].tolist()
        return np.concatenate(out) if out else np.zeros(0, np.int64)


def augmented(v: np.ndarray) -> tuple[np.ndarray, float]:
    """Rows with the coordinate that gives all the greatest norm, and that norm."""
    x = v.astype(np.float64)
    norm = (x * x).sum(1)
    most = float(norm.max(initial=0))
    return np.column_stack([x, np.sqrt(np.maximum(most - norm, 0))]), most**0.5


def grow(v: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """The cover tree of the rows of ``v``."""
    x, top = augmented(v)
    square = (x * x).sum(1)
    # Different rows of whole numbers are at least 1 apart; products of doubles are safe to a part of 1e-13.
    zero = 0.5 if top < 1e6 else 0.0
    centre, angle, kids, points = [], [], [], []

    def node(c: int, far: float) -> int:
        centre.append(c)
        angle.append(2 * np.arcsin(min(1.0, (far * far + 1e-13 * top * top) ** 0.5 / (2 * top))) if top else 0.0)
        kids.append([])
        points.append([])
        return len(centre) - 1

    def apart(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Squared distances; those of the first rows are from themselves."""
        d = square[rows][:, None] + square[others] - 2 * (x[rows] @ x[others].T)
        d[d < zero] = 0
        own = np.arange(len(others))
        d[own, own] = 0
        return d

    todo = []
    if len(x):
        far = np.sqrt(apart(np.arange(len(x)), np.arange(1))[:, 0])
        todo.append((node(0, float(far.max())), np.arange(len(x)), far, float(far.max()), 0))
    while todo:
        at, rows, far, radius, level = todo.pop()
        reach = float(far.max())
        if len(rows) <= leaf or level >= LEVELS or reach == 0:
            points[at] = rows.tolist()
            continue
        radius, level = radius / 2, level + 1
        while radius >= reach and level < LEVELS:  # levels with one child only
            radius, level = radius / 2, level + 1
        near = far <= radius  # the node's centre goes on as the first child's
        parts = [(rows[near], far[near])]
        rest = rows[~near]
        while len(rest):
            d = apart(rest, rest[:CENTRES])
            close = d <= radius * radius
            done = np.zeros(len(rest), bool)
            alone = np.flatnonzero(close.sum(0) == 1)
            done[alone] = True
            points[at] += rest[alone].tolist()
            for j in np.flatnonzero(~done[: d.shape[1]]):
                if not done[j]:  # not covered by a centre before it
                    mine = close[:, j] & ~done
                    done |= mine
                    parts.append((rest[mine], np.sqrt(d[mine, j])))
            rest = rest[~done]
        for mine, d in parts:
            if len(mine) == 1:
                points[at].append(int(mine[0]))
            elif len(mine):
                kid = node(int(mine[d.argmin()]), float(d.max()))
                kids[at].append(kid)
                todo.append((kid, mine, d, radius, level))
    flat = [np.array([x for part in lists for x in part], np.int64) for lists in (kids, points)]
    at = [np.cumsum([0, *map(len, lists)]) for lists in (kids, points)]
    return CoverTree(np.array(centre, np.int64), np.array(angle), at[0], flat[0], at[1], flat[1], top)


def _bounds(tree: CoverTree, nodes: np.ndarray, v: np.ndarray, q: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each row of ``q`` with what each node covers, safe against rounding."""
    scale = size * tree.top
    c = np.clip(v[tree.centre[nodes]].astype(np.float64) @ q.T / np.where(scale == 0, 1, scale), -1, 1)
    s = np.sqrt(1 - c * c)
    f = (tree.angle[nodes] + 1e-7)[:, None]
    cf, sf = np.cos(f), np.sin(f)
    slack = scale * 2e-7 + 1e-3
    return np.where(c <= -cf, -1, c * cf - s * sf) * scale - slack, np.where(c >= cf, 1, c * cf + s * sf) * scale + slack


class Windows:
    """The k best of each window [low, high] of each anchor; ties go to the smaller id."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        low, self.high, self.k = np.atleast_2d(low), np.atleast_2d(high), k
        self.need = np.where(low <= self.high, low, NEVER)  # least product that could still enter
        self.score, self.id = np.full((*low.shape, k), LEAST), np.full((*low.shape, k), NEVER)
        self.last = np.full(low.shape, NEVER)  # greatest id that could still enter with the least product
        self.met = (self.need == NEVER).all(1)

    @property
    def ids(self) -> list[np.ndarray]:
        """Of each window of each anchor."""
        return [x[x != NEVER] for x in self.id.reshape(-1, self.k)]

    def wanted(self, who: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which ranges meet a window of the anchors ``who`` above what it needs."""
        out = np.zeros(least.shape, bool)
        for need, high in zip(self.need[who].T, self.high[who].T, strict=True):
            out |= (most >= need) & (least <= high)
        return out

    def _inside(self, who: np.ndarray, score: np.ndarray) -> np.ndarray:
        out = np.zeros(score.shape, bool)
        for need, high in zip(self.need[who].T, self.high[who].T, strict=True):
            out |= (score >= need.astype(score.dtype)[:, None]) & (score <= high.astype(score.dtype)[:, None])
        return out

    def _narrow(self, who: np.ndarray, score: np.ndarray) -> None:
        """Raise what each window needs to the k-th best that it has among ``score``."""
        ranked = np.sort(score, axis=1)
        for j in range(self.need.shape[1]):
            place = (ranked <= self.high[who, j].astype(score.dtype)[:, None]).sum(1) - self.k
            best = ranked[np.arange(len(who)), np.maximum(place, 0)]
            more = (place >= 0) & (best > self.need[who, j].astype(score.dtype))
            self.need[who[more], j] = best[more].astype(np.int64)
            self.last[who[more], j] = NEVER

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``score``: a row for each of the anchors ``who``, a column for each of ``ids``."""
        need = self.need[who]
        mask = score >= need.min(1).astype(score.dtype)[:, None]
        self.met[who] = True
        many = DENSE * need.shape[1] * self.k * len(who)
        if np.count_nonzero(mask) > many:
            mask = self._inside(who, score)
            if np.count_nonzero(mask) > many:
                self._narrow(who, score)
                mask = self._inside(who, score)
        row, column = _hits(mask)
        if not len(row):
            return
        s, vec, at = score[row, column].astype(np.int64)[:, None], ids[column][:, None], who[row]
        need = self.need[at]
        row, window = np.nonzero((s >= need) & (s <= self.high[at]) & ((s > need) | (vec <= self.last[at])))
        if not len(row):
            return
        width = self.need.shape[1]
        key = at[row] * width + window
        mine = np.unique(key)
        # What the windows hold already comes with the new rows; empty places sort last.
        held = self.score.reshape(-1, self.k), self.id.reshape(-1, self.k)
        key = np.concatenate([np.repeat(mine, self.k), key])
        s = np.concatenate([held[0][mine].ravel(), s[row, 0]])
        vec = np.concatenate([held[1][mine].ravel(), vec[row, 0]])
        order = np.lexsort((vec, -s, key))
        key, s, vec = key[order], s[order], vec[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        best = place < self.k
        held[0][key[best], place[best]], held[1][key[best], place[best]] = s[best], vec[best]
        full = mine[held[1][mine, -1] != NEVER]
        self.need.reshape(-1)[full], self.last.reshape(-1)[full] = held[0][full, -1], held[1][full, -1]


def _hits(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is true; eight are looked at at once, as few are."""
    flat = mask.ravel()
    n = len(flat) // 8 * 8
    some = np.flatnonzero(flat[:n].view(np.uint64) != 0)
    word, bit = np.nonzero(flat[:n].reshape(-1, 8)[some])
    return np.divmod(np.concatenate([some[word] * 8 + bit, n + np.flatnonzero(flat[n:])]), mask.shape[1])


def _kind(most: float) -> type:
    """A type that holds all whole numbers up to ``most``: floats have the fast products."""
    return np.float32 if most < 2.0**24 else np.float64 if most < 2.0**52 else np.int64


def _none(kind: np.dtype) -> float | int:
    """Less than all that a window lets in."""
    return LEAST if kind.kind == "i" else -np.inf


def descend(
    tree: CoverTree, v: np.ndarray, ids: np.ndarray, open_: np.ndarray, q: np.ndarray, found: Windows, who: np.ndarray | None = None, own: np.ndarray | None = None
) -> int:
    """Best-first descent of the anchors ``q``, the rows ``who`` of ``found``; ``open_`` marks the rows of ``v`` that they
    may take, or those that each of them may take, ``own`` has the row of each anchor itself or -1. Returns how many
    points were verified. Floats in ``v`` and ``q`` are taken for numbers whose products they hold exactly."""
    q = np.atleast_2d(q)
    who = np.arange(len(q)) if who is None else who
    if not len(tree.centre) or not len(q):
        return 0
    qf = q.astype(np.float64)
    size = np.sqrt((qf * qf).sum(1))
    if v.dtype.kind != "f":
        kind = _kind(float(size.max()) * max(tree.top, 1.0))
        v, q = v.astype(kind), q.astype(kind)
    shared = open_.ndim == 1
    low, high = _bounds(tree, np.zeros(1, np.int64), v, qf, size)
    if not (asks := found.wanted(who, low, high)[0]).all():
        q, qf, size, who, low, high = q[asks], qf[asks], size[asks], who[asks], low[:, asks], high[:, asks]
        open_, own = open_ if shared else open_[asks], None if own is None else own[asks]
        if not len(q):
            return 0

    def verify(part: np.ndarray | slice, asks: np.ndarray) -> int:
        score = (q if len(asks) == len(q) else q[asks]) @ v[part].T
        if not shared:
            score[~open_[asks][:, part]] = _none(score.dtype)
        if own is not None and (mine := np.flatnonzero(own[asks] >= 0)).size:
            place = np.full(len(v), -1)
            place[part] = np.arange(score.shape[1])
            column = place[own[asks[mine]]]
            score[mine[column >= 0], column[column >= 0]] = _none(score.dtype)
        found.add(who[asks], score, ids[part])
        return score.size

    # Nodes with points that some anchor wants, level by level.
    level, wants, kept, pairs = np.zeros(1, np.int64), np.ones((1, len(q)), bool), [], 0
    known = bool(found.met[who].all()) and (not shared or bool(open_.all()))
    while len(level):
        n = tree.point_at[level + 1] - tree.point_at[level]
        pairs += int((n * wants.sum(1)).sum())
        if known and 2 * pairs > len(v) * len(q):  # most is wanted: no order spares work
            return sum(verify(slice(at, at + POINTS), np.arange(len(q))) for at in range(0, len(v), POINTS))
        has = n > 0
        kept.append((level[has], low[has], high[has], wants[has]))
        n = tree.kid_at[level + 1] - tree.kid_at[level]
        level = tree.kids[np.repeat(tree.kid_at[level] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        low, high = _bounds(tree, level, v, qf, size)
        wants = found.wanted(who, low, high) & np.repeat(wants, n, axis=0)
        some = wants.any(1)
        level, low, high, wants = level[some], low[some], high[some], wants[some]
    nodes, low, high, wants = map(np.concatenate, zip(*kept, strict=True))
    best = np.argsort(-np.where(wants, high, -np.inf).max(1, initial=-np.inf), kind="stable")
    nodes, low, high, wants = nodes[best], low[best], high[best], wants[best]
    n = tree.point_at[nodes + 1] - tree.point_at[nodes]
    rows = tree.points[np.repeat(tree.point_at[nodes] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    of = np.repeat(np.arange(len(nodes)), n)
    if shared and not open_.all():
        mine = open_[rows]
        rows, of = rows[mine], of[mine]
    seen, step = 0, POINTS if known else FIRST_POINTS
    while len(rows):
        part, last = rows[:step], int(of[min(step, len(rows)) - 1])
        asks = np.flatnonzero(wants[int(of[0]) : last + 1].any(0))
        rows, of, step = rows[step:], of[step:], min(4 * step, POINTS)
        if len(asks):
            seen += verify(part, asks)
        if len(of) and len(nodes) > 1:
            first = int(of[0])
            wants[first:] &= found.wanted(who, low[first:], high[first:])
            mine = wants.any(1)[of]
            rows, of = rows[mine], of[mine]
    return seen


TREE = "block long, ids binary, labels binary, dims int, width int, v binary, centre binary, angle binary, kid_at binary, kids binary, point_at binary, points binary, top double, size long"


def _narrowest(v: np.ndarray) -> np.ndarray:
    """The same whole numbers in as few bytes as hold them."""
    return v.astype(next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= v.min(initial=0) and v.max(initial=0) <= np.iinfo(k).max))


def _row(cells: list, schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    columns = [c.split() for c in schema.split(", ")]
    return pa.table([pa.array([x], kinds[k]) for x, (_, k) in zip(cells, columns, strict=True)], names=[c for c, _ in columns])


def _grow_block(group: pa.Table) -> pa.Table:
    """The index row of one block."""
    ids, labels = (np.asarray(group.column(c)).astype("<i8") for c in ("vec_id", "label"))
    order = np.argsort(ids)
    v = _matrix(group.column("v"))[order]
    t = grow(v)
    v = _narrowest(v)
    arrays = [t.centre.astype("<i4"), t.angle.astype("<f8"), t.kid_at.astype("<i4"), t.kids.astype("<i4"), t.point_at.astype("<i4"), t.points.astype("<i4")]
    return _row([group.column("block")[0].as_py(), ids[order].tobytes(), labels[order].tobytes(), v.shape[1], v.itemsize, v.tobytes(), *[a.tobytes() for a in arrays], t.top, v.nbytes + 16 * len(ids)], TREE)


def label_blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """label, base, parts: a label's rows lie in the blocks base to base + parts - 1; small labels share blocks of one part."""
    sizes = cut(rows.groupBy("label").agg(F.count("*").alias("n")), "label_sizes")
    small, large = sizes.filter(F.col("n") <= block_rows), sizes.filter(F.col("n") > block_rows)
    shared = -(-(small.agg(F.sum("n")).first()[0] or 0) // block_rows)
    base = F.pmod(F.xxhash64("label"), F.lit(max(1, shared)))
    parts = F.ceil(F.col("n") / block_rows).cast("long")
    # At most one row for each block_rows rows of the input.
    before = F.coalesce(F.sum("parts").over(Window.orderBy("label").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = large.withColumn("parts", parts).withColumn("base", before + shared)
    return small.select("label", base.alias("base"), F.lit(1).cast("long").alias("parts")).unionByName(whole.select("label", "base", "parts"))


def build_index(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a block: its vectors and their cover tree."""
    small = labels.count() <= BROADCAST_LABELS
    block = F.col("base") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    dealt = rows.join(F.broadcast(labels) if small else labels, "label").select(block.alias("block"), "vec_id", "label", "v")
    return dealt.groupBy("block").applyInArrow(_grow_block, TREE)


def _vectors(x: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(x[c], "<i8") for c in ("ids", "labels"))
    return np.frombuffer(x["v"], f"<i{x['width']}").reshape(len(ids), x["dims"]), ids, labels


def _unpack(x: dict) -> CoverTree:
    centre, kid_at, kids, point_at, points = (np.frombuffer(x[c], "<i4").astype(np.int64) for c in ("centre", "kid_at", "kids", "point_at", "points"))
    return CoverTree(centre, np.frombuffer(x["angle"], "<f8"), kid_at, kids, point_at, points, x["top"])


PACK = "first long, chunks long, ids binary, labels binary, dims int, width int, v binary, windows int, low binary, high binary"


def _pack(group: pa.Table) -> pa.Table:
    """Anchors as one row, neighbours together; an anchor with fewer windows than others gets empty ones."""
    v = _matrix(group.column("v"))
    order = np.concatenate([a + grow(v[a : a + BLOCK_ROWS]).order() for a in range(0, len(v), BLOCK_ROWS)])
    low, high = (_matrix(group.column(c)) for c in ("low", "high"))
    width = np.asarray(group.column("low").combine_chunks().value_lengths()).astype(np.int64)
    low[np.arange(low.shape[1]) >= width[:, None]] = 1
    ids, labels = (np.asarray(group.column(c)).astype("<i8")[order] for c in ("anchor_id", "label"))
    v = _narrowest(v[order])
    first, chunks = (group.column(c)[0].as_py() for c in ("first", "chunks"))
    return _row([first, chunks, ids.tobytes(), labels.tobytes(), v.shape[1], v.itemsize, v.tobytes(), low.shape[1], low[order].astype("<i8").tobytes(), high[order].astype("<i8").tobytes()], PACK)


class Pack:
    """Anchors and what they have found in the blocks they met."""

    def __init__(self, x: dict, k: int, same: bool, rows: int):
        self.v, self.ids, self.labels = _vectors(x)
        low, high = (np.frombuffer(x[c], "<i8").reshape(len(self.ids), x["windows"]) for c in ("low", "high"))
        self.found, self.same, self.rows = Windows(low, high, k), same, rows
        norm = self.v.astype(np.float64)
        self.most = float((norm * norm).sum(1).max(initial=0)) ** 0.5
        self.cast: dict[tuple[type, int], np.ndarray] = {}

    def _as(self, kind: type, dims: int) -> np.ndarray:
        if (kind, dims) not in self.cast:
            self.cast = {(kind, dims): np.pad(self.v.astype(kind), ((0, 0), (0, dims - self.v.shape[1])))}
        return self.cast[kind, dims]

    def meet(self, x: dict) -> None:
        tree, (v, ids, labels) = _unpack(x), _vectors(x)
        dims = max(v.shape[1], self.v.shape[1])
        kind = _kind(self.most * max(tree.top, 1.0))
        v, q = np.pad(v.astype(kind), ((0, 0), (0, dims - v.shape[1]))), self._as(kind, dims)
        alike = labels.min() == labels.max()
        fits = (self.labels == labels[0]) == self.same if alike else np.isin(self.labels, labels) | (not self.same)
        everything = np.ones(len(ids), bool)
        for a in range(0, len(self.ids), self.rows):
            who = a + np.flatnonzero(fits[a : a + self.rows])
            own = np.minimum(np.searchsorted(ids, self.ids[who]), len(ids) - 1)
            own[ids[own] != self.ids[who]] = -1
            open_ = everything if alike else (labels == self.labels[who][:, None]) == self.same
            descend(tree, v, ids, open_, q[who], self.found, who, own)

    def met(self) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(self.ids), 1 << 13):
            vec, score = self.found.id[a : a + (1 << 13)], self.found.score[a : a + (1 << 13)]
            anchor, which, place = np.nonzero(vec != NEVER)
            columns = [self.ids[a + anchor], which.astype(np.int32), vec[anchor, which, place], score[anchor, which, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in MET.split(", ")])


MET = "anchor_id long, which int, vec_id long, score long"


def _meet(batches: Iterator[pa.RecordBatch], k: int, same: bool, rows: int) -> Iterator[pa.RecordBatch]:
    """MET rows: the k best of a cell for each window of each anchor. A cell's anchors come before its blocks."""
    cell = pack = None
    for batch in batches:
        for i in range(batch.num_rows):
            x = batch.slice(i, 1).to_pylist()[0]
            if x["block"] < 0:
                if pack:
                    yield from pack.met()
                cell, pack = x["cell"], Pack(x, k, same, rows)
            elif pack and x["cell"] == cell:
                pack.meet(x)
    if pack:
        yield from pack.met()


def _cells(units: DataFrame, index: DataFrame, block_rows: int) -> DataFrame:
    """unit, base, parts, packs, chunks, first: the anchors of a unit are dealt to packs and its blocks to chunks; each pair is a cell, from ``first``."""
    total = units.agg(F.sum(F.col("n") * F.col("parts"))).first()[0] or 1
    size, dims = index.agg(F.max("size"), F.max("dims")).first()
    products = F.col("n") * F.col("parts") * F.lit(float(block_rows))
    most = CELLS_PER_CORE * units.sparkSession.sparkContext.defaultParallelism
    cells = F.ceil(F.least(products / CELL_PRODUCTS, F.lit(float(most)) * F.col("n") * F.col("parts") / F.lit(float(total))))
    # Moved: the blocks for each pack, the anchors for each chunk. A chunk costs an anchor more than its bytes: what it finds, and its first block.
    each = 4 * (dims or 0) + 400
    even = F.sqrt(cells * F.col("n") * (each + 2000) / (F.col("parts") * F.lit(float(size or 1))))
    packs = F.greatest(F.lit(1), F.ceil(F.col("n") * each / CELL_BYTES), F.least(F.round(even), F.col("n"))).cast("long")
    dealt = units.withColumn("packs", packs).withColumn("chunks", F.greatest(F.lit(1), F.least(F.ceil(cells / F.col("packs")), F.col("parts"))).cast("long"))
    # At most one row for each block.
    before = F.sum(F.col("packs") * F.col("chunks")).over(Window.orderBy("unit").rowsBetween(Window.unboundedPreceding, -1))
    return dealt.withColumn("first", F.coalesce(before, F.lit(0)).cast("long"))


def _meetings(index: DataFrame, asked: DataFrame, units: DataFrame, k: int, same: bool, block_rows: int, anchor_rows: int) -> DataFrame:
    """MET rows. ``asked``: unit, anchor_id, label, v, low, high; ``units``: unit, its blocks base to base + parts - 1, n anchors."""
    cells = cut(_cells(units, index, block_rows), "cells")
    n_cells, n_blocks = cells.agg(F.sum(F.col("packs") * F.col("chunks")), F.sum("parts")).first()
    small = (n_blocks or 0) <= BROADCAST_LABELS
    few = F.broadcast(cells) if small else cells
    pack = F.pmod(F.xxhash64("anchor_id"), F.col("packs"))
    dealt = asked.join(few, "unit").select((F.col("first") + pack * F.col("chunks")).alias("first"), "chunks", "anchor_id", "label", "v", "low", "high")
    packed = dealt.groupBy("first").applyInArrow(_pack, PACK)
    packed = packed.select(F.explode(F.sequence("first", F.col("first") + F.col("chunks") - 1)).alias("cell"), F.lit(-1).cast("long").alias("block"), *(c for c in packed.columns if c not in ("first", "chunks")))
    blocks = cells.select("first", "packs", "chunks", "base", F.explode(F.sequence("base", F.col("base") + F.col("parts") - 1)).alias("block"))
    mine = F.col("first") + F.pmod(F.col("block") - F.col("base"), F.col("chunks"))
    blocks = blocks.select("block", F.transform(F.sequence(F.lit(0).cast("long"), F.col("packs") - 1), lambda p: mine + p * F.col("chunks")).alias("cells"))
    streamed = index.join(F.broadcast(blocks) if small else blocks, "block").withColumn("cell", F.explode("cells")).drop("cells")
    n = min(max(n_cells or 1, 1), TASKS)
    both = streamed.unionByName(packed, allowMissingColumns=True).repartitionById(n, F.pmod("cell", F.lit(n)).cast("int"))
    return both.sortWithinPartitions("cell", "block").mapInArrow(partial(_meet, k=k, same=same, rows=anchor_rows), MET)


def _floor(x: Column) -> Column:
    """x / 100 rounded down, in whole numbers."""
    return ((x - F.pmod(x, F.lit(100))) / F.lit(100)).cast("long")


def _best(met: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "which").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    percent_low: int = 50,
    percent_high: int = 95,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are ``candidates``; ``anchors`` selects the anchors among them. Every anchor meets every block that can
    hold what it asks for, once for positives and once for negatives; ``anchor_rows`` of them descend its tree together.
    """
    labels = cut(label_blocks(rows, block_rows), "labels")
    index = cut(build_index(rows, labels), "cover_trees")
    asked = cut(rows.filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "v"), "anchors")
    n = asked.count()
    release(rows.sparkSession)

    small = labels.count() <= BROADCAST_LABELS
    anywhere = asked.withColumns({"low": F.array(F.lit(-(1 << 62))), "high": F.array(F.lit(1 << 62))})
    anywhere = anywhere.join(F.broadcast(labels) if small else labels, "label").withColumn("unit", F.col("base"))
    # All blocks of a large label, or one that small labels share.
    units = anywhere.groupBy("unit").agg(F.first("base").alias("base"), F.first("parts").alias("parts"), F.count("*").alias("n"))
    met = _meetings(index, anywhere.drop("base", "parts"), cut(units, "units"), n_positives, True, block_rows, anchor_rows)
    positives = cut(_best(met, n_positives).select("anchor_id", F.col("rank").alias("which"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    release(rows.sparkSession)

    # A window of a product p <= 0 is empty, or holds 0 only.
    listed = positives.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("which", "positive_score"))).alias("p"))
    wide = asked.join(listed, "anchor_id").select(
        F.lit(0).cast("long").alias("unit"),
        "anchor_id",
        "label",
        "v",
        F.transform("p", lambda x: -_floor(-x["positive_score"] * percent_low)).alias("low"),
        F.transform("p", lambda x: _floor(x["positive_score"] * percent_high)).alias("high"),
    )
    n_blocks = labels.agg(F.max(F.col("base") + F.col("parts"))).first()[0] or 1
    # The stated anchors meet every block; both sides are packed rows, and what is held of them at once is bounded.
    whole = rows.sparkSession.range(1).select(F.col("id").alias("unit"), F.col("id").alias("base"), F.lit(n_blocks).cast("long").alias("parts"), F.lit(n).cast("long").alias("n"))
    met = _meetings(index, wide, whole, n_negatives, False, block_rows, anchor_rows)
    negatives = _best(met, n_negatives).select("anchor_id", (F.col("which") + 1).alias("which"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return negatives.join(positives, ["anchor_id", "which"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
