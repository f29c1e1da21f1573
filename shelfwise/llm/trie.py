"""The prefix trie of conversations, by ternary search trees over shards of turn ids.

Turns are dictionary-encoded: each distinct (role, text), known by its
SHA-256, has one id, and a conversation is its row of ids; texts are not
shuffled after the turns of a conversation are put in order. Conversations are
range-partitioned and sorted by their ids, so equal ones lie together and are
counted while they stream by. A shard, a run of at most ``SHARD`` distinct
sequences or ``SHARD_TURNS`` turns of a partition, becomes a ternary search
tree (key, low, equal, high), in which sequences are inserted median first, so
the siblings of a node form a balanced search tree. One iterative traversal
accumulates members, leaves and savings from the leaves up.

Only prefixes of a shard's first and last sequence can go on in another shard.
These boundary nodes are written as two paths a shard with what lies inside
the shard below them; paths sorted by their ids are merged in one streaming
pass a first turn, with a stack as deep as a path, and the root is summed from
them. All other nodes are whole within their shard.

Defined results: rows without a conversation id take no part; a null role or
text is empty; turns of one number come by role and text, repeated rows each
count as a turn; extra columns are ignored; an empty table gives no rows. One
conversation's ids (8 bytes a turn) must fit in a row. The ids of the members
that end in a node are hashed as they stream by in order, as SHA-256 has to
read them one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import cut, fan_out

#: Bounds of a shard, for the memory of its tree.
SHARD = 20_000
SHARD_TURNS = 100_000
BATCH = 8192
NO_ONE = hashlib.sha256(b"").hexdigest()
#: Turns at most that a conversation takes over from its base.
SHARED = 5

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
INNER = NODE + ", shard string, side int, parent_depth long"
PATH = "shard string, side int, ids array<long>, sizes array<long>, members array<long>, least array<long>, children array<long>, leaves array<long>, saved array<long>, ends array<string>"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns (array of id, size): every conversation in order, over a dictionary of its turns."""
    text = [F.coalesce(c, F.lit("")) for c in ("role", "text")]
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text[0].alias("role"), text[1].alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("place", F.row_number().over(order))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    rows = cut(rows.select("conv_id", "place", digest.alias("digest"), F.length("text").cast("long").alias("size")), "turns")
    dictionary = cut(rows.groupBy("digest").agg(F.first("size").alias("size")).select("digest", "size", F.monotonically_increasing_id().alias("id")), "turn_ids")
    coded = rows.drop("size").join(dictionary, "digest").select("conv_id", F.struct("place", "id", "size").alias("x"))
    listed = coded.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    return listed.select("conv_id", F.transform("x", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """conv_id, ids, sizes: each conversation with its first turns taken from the conversation at its hundred."""
    own = cut(convs, "conversations")
    base = own.filter(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1)).cast("int")
    got = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 100, "h": h}).join(base, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    seq = F.concat(head, F.slice("turns", F.col("h") + 1, F.greatest(F.lit(0), F.size("turns") - F.col("h"))))
    return got.select("conv_id", seq.alias("s")).select("conv_id", F.col("s.id").alias("ids"), F.col("s.size").alias("sizes"))


class Tree:
    """A ternary search tree over sequences of turn ids; node 0 is the root, which has no turn."""

    def __init__(self) -> None:
        self.key, self.size, self.parent, self.depth = [0], [0], [-1], [0]
        self.low, self.high, self.equal = [-1], [-1], [-1]
        self.members, self.least, self.ends = [0], [None], [None]

    def _node(self, key: int, size: int, parent: int) -> int:
        for column, value in ((self.key, key), (self.size, size), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.low, -1), (self.high, -1), (self.equal, -1), (self.members, 0), (self.least, None), (self.ends, None)):
            column.append(value)
        return len(self.key) - 1

    def insert(self, ids: list[int], sizes: list[int], n: int, least: int, ends: str) -> int:
        """Adds a sequence with its number of members; its last node."""
        at = 0
        for x, size in zip(ids, sizes, strict=True):
            up, now = at, self.equal[at]
            if now < 0:
                at = self._node(x, size, up)
                self.equal[up] = at
                continue
            while self.key[now] != x:
                side = self.low if x < self.key[now] else self.high
                if side[now] < 0:
                    side[now] = self._node(x, size, up)
                now = side[now]
            at = now
        self.members[at], self.least[at], self.ends[at] = n, least, ends
        return at

    def path(self, at: int) -> list[int]:
        """The nodes from the root to ``at``."""
        out = [at]
        while self.parent[out[-1]] >= 0:
            out.append(self.parent[out[-1]])
        return out[::-1]

    def order(self) -> list[int]:
        """All nodes, every one before the nodes below it; by an own stack through low, equal and high links."""
        out, todo = [0], [self.equal[0]]
        while todo:
            x = todo.pop()
            if x >= 0:
                out.append(x)
                todo += [self.low[x], self.high[x], self.equal[x]]
        return out


def build(sequences: list[tuple]) -> tuple[Tree, int, int]:
    """The tree of sorted (ids, sizes, n, least, ends), inserted median first, and the last nodes of the first and last sequence."""
    tree = Tree()
    ends = {}
    todo = [(0, len(sequences))]
    while todo:
        nxt = []
        for a, b in todo:
            mid = (a + b) // 2
            ends[mid] = tree.insert(*sequences[mid])
            nxt += [x for x in ((a, mid), (mid + 1, b)) if x[0] < x[1]]
        todo = nxt
    return tree, ends[0], ends[len(sequences) - 1]


def shard_rows(sequences: list[tuple], shard: str) -> tuple[list[tuple], list[tuple]]:
    """The whole nodes of a shard, and its two boundary paths with what is below them inside the shard."""
    tree, first, last = build(sequences)
    paths = [tree.path(first), tree.path(last)]
    where = {x: (side, d) for side in (1, 0) for d, x in enumerate(paths[side])}
    n = len(tree.key)
    members, least = list(tree.members), list(tree.least)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    order = tree.order()
    for x in reversed(order):
        up = tree.parent[x]
        if x not in where:
            if not children[x]:
                leaves[x] = 1
            saved[x] += (members[x] - 1) * tree.size[x]
        if up >= 0:
            members[up] += members[x]
            if least[up] is None or least[x] < least[up]:
                least[up] = least[x]
            if x not in where:
                children[up] += 1
                leaves[up] += leaves[x]
                saved[up] += saved[x]
    inner = []
    for x in order:
        if x in where:
            continue
        up = tree.parent[x]
        side, d = where.get(up, (None, None))
        inner.append((least[x], tree.depth[x], None if up in where else least[up], members[x], children[x], leaves[x], saved[x], tree.ends[x] or NO_ONE, shard, side, d))
    bounds = []
    for side in (0, 1):
        path = paths[side]
        mine = [where[x][0] == side for x in path]
        if side and not any(mine):
            continue
        pick = [(tree.size[x], members[x], least[x], children[x], leaves[x], saved[x], tree.ends[x]) if m else (tree.size[x], 0, None, 0, 0, 0, None) for x, m in zip(path, mine, strict=True)]
        bounds.append((shard, side, [tree.key[x] for x in path[1:]], *map(list, zip(*pick, strict=True))))
    return inner, bounds


def _schema(text: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in text.split(", ")])


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), BATCH):
        columns = zip(*rows[a : a + BATCH], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _wide(rows: list[tuple], first: int) -> list[tuple]:
    """Rows of SHARDS from the columns of INNER, or of PATH, which begin at ``first``."""
    width = len(SHARDS.split(", "))
    return [(None,) * first + r + (None,) * (width - first - len(r)) for r in rows]


SHARDS = INNER + ", " + ", ".join(f"path_{c}" for c in PATH.split(", "))


def _shards(batches: Iterator[pa.RecordBatch], limit: int, turns: int) -> Iterator[pa.RecordBatch]:
    """SHARDS rows from conversations sorted by ids and conv_id."""
    task = TaskContext.get()
    part, schema, width = task.partitionId() if task else 0, _schema(SHARDS), len(INNER.split(", "))
    held, size, number = [], 0, 0

    def flush() -> Iterator[pa.RecordBatch]:
        inner, bounds = shard_rows(held, f"{part}-{number}")
        yield from _batches(_wide(inner, 0) + _wide(bounds, width), schema)

    now = None  # ids, sizes, members, least, hash of the members' ids
    for batch in batches:
        convs = batch.column(0).to_pylist()
        ids, at = (np.asarray(x) for x in (batch.column(1).flatten(), batch.column(1).value_lengths().fill_null(0)))
        sizes = np.asarray(batch.column(2).flatten())
        end = np.cumsum(at)
        for conv, b, k in zip(convs, end.tolist(), at.tolist(), strict=True):
            seq = ids[b - k : b]
            if now is not None and len(seq) == len(now[0]) and (seq == now[0]).all():
                now[2] += 1
                now[4].update(f",{conv}".encode())
                continue
            if now is not None:
                held.append((now[0].tolist(), now[1].tolist(), now[2], now[3], now[4].hexdigest()))
                size += len(now[0])
                if len(held) >= limit or size >= turns:
                    yield from flush()
                    held, size, number = [], 0, number + 1
            now = [seq, sizes[b - k : b], 1, conv, hashlib.sha256(str(conv).encode())]
    if now is not None:
        held.append((now[0].tolist(), now[1].tolist(), now[2], now[3], now[4].hexdigest()))
        yield from flush()


#: A merged boundary node; ``refs`` are the (shard, side) of the paths that it lies on.
MERGED = NODE + ", shard string, side int"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """MERGED rows from sorted paths of whole first turns: each node once with shard null, then once for each path it lies on."""
    schema = _schema(MERGED)
    stack: list[dict] = []  # open nodes of depth 1, 2, ...
    done: list[tuple] = []

    def close() -> None:
        x = stack.pop()
        if not x["children"]:
            x["leaves"] += 1
        x["saved"] += (x["members"] - 1) * x["size"]
        if stack:
            up = stack[-1]
            up["children"] += 1
            up["leaves"] += x["leaves"]
            up["saved"] += x["saved"]
        # The parent's least member is known only once it is closed: the node waits there.
        row = [x["least"], len(stack) + 1, None, x["members"], x["children"], x["leaves"], x["saved"], x["ends"] or NO_ONE]
        for child in x["below"]:
            child[2] = x["least"]
            done.append((*child, None, None))
        done.extend((x["least"], len(stack) + 1, *[None] * 6, *ref) for ref in x["refs"])
        if stack:
            stack[-1]["below"].append(row)
        else:
            done.append((*row, None, None))

    for batch in batches:
        for r in batch.to_pylist():
            same = 0
            while same < len(stack) and same < len(r["ids"]) and stack[same]["key"] == r["ids"][same]:
                same += 1
            while len(stack) > same:
                close()
            for d in range(same, len(r["ids"])):
                stack.append({"key": r["ids"][d], "size": r["sizes"][d + 1], "members": 0, "least": None, "children": 0, "leaves": 0, "saved": 0, "ends": None, "refs": [], "below": []})
            for d, x in enumerate(stack, 1):
                x["members"] += r["members"][d]
                x["children"] += r["children"][d]
                x["leaves"] += r["leaves"][d]
                x["saved"] += r["saved"][d]
                x["ends"] = x["ends"] or r["ends"][d]
                if r["least"][d] is not None:
                    x["least"] = r["least"][d] if x["least"] is None else min(x["least"], r["least"][d])
                    x["refs"].append((r["shard"], r["side"]))
        yield from _batches(done, schema)
        done.clear()
    while stack:
        close()
    yield from _batches(done, schema)


def prefix_trie(turns: DataFrame, shard: int = SHARD, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations; the columns are those of NODE."""
    spark = turns.sparkSession
    seqs = cut(rebuilt(conversations(turns)), "rebuilt")
    sorted_ = seqs.repartitionByRange(fan_out(spark), "ids").sortWithinPartitions("ids", "conv_id")
    got = cut(sorted_.mapInArrow(partial(_shards, limit=shard, turns=shard_turns), SHARDS), "trie_shards")
    inner = got.filter("conv_id is not null")
    paths = got.filter("path_shard is not null").select(*[F.col(f"path_{c.split()[0]}").alias(c.split()[0]) for c in PATH.split(", ")])

    deep = paths.filter(F.size("ids") > 0).repartition(fan_out(spark), F.col("ids")[0]).sortWithinPartitions("ids", "shard", "side")
    merged = cut(deep.mapInArrow(_merge, MERGED), "trie_boundaries")
    nodes, refs = merged.filter("shard is null").drop("shard", "side"), merged.filter("shard is not null").select("shard", "side", F.col("depth").alias("parent_depth"), F.col("conv_id").alias("up"))

    # The root: sums over the shards' roots and the boundary nodes below it.
    tops = paths.select(F.col("members")[0].alias("members"), F.col("least")[0].alias("least"), F.col("children")[0].alias("children"), F.col("leaves")[0].alias("leaves"), F.col("saved")[0].alias("saved"), F.col("ends")[0].alias("ends"))
    ones = nodes.filter("depth = 1").select(F.lit(0).cast("long").alias("members"), F.col("conv_id").alias("least"), F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("ends"))
    root = tops.unionByName(ones).agg(*[F.sum(c).alias(c) for c in ("members", "children", "leaves", "saved")], F.min("least").alias("least"), F.max("ends").alias("ends")).filter("members > 0")
    zero = F.lit(0).cast("long")
    root = root.select(F.col("least").alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.col("members").alias("n_convs"), F.col("children").alias("n_children"), F.when(F.col("children") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NO_ONE)).alias("ends_sha256"))
    root = cut(root, "trie_root")

    columns = [c.split()[0] for c in NODE.split(", ")]
    ready = inner.filter("parent_conv_id is not null").select(columns)
    waiting = inner.filter("parent_conv_id is null and parent_depth > 0").drop("parent_conv_id")
    joined = waiting.join(refs, ["shard", "side", "parent_depth"]).withColumn("parent_conv_id", F.col("up")).select(columns)
    least = next((r["conv_id"] for r in root.collect()), None)  # one row at most
    top = inner.filter("parent_conv_id is null and parent_depth = 0").select(columns).unionByName(nodes.filter("depth = 1").select(columns))
    top = top.withColumn("parent_conv_id", F.lit(least).cast("long"))
    deeper = nodes.filter("depth > 1").select(columns)
    return root.unionByName(ready).unionByName(joined).unionByName(top).unionByName(deeper)
