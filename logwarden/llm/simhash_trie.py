"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

A document's fingerprint has a bit set where over half of its 4-word shingles' hashes have it set. The
distinct fingerprints form a binary trie. The join walks pairs of trie nodes of equal depth, starting with
(root, root): a pair's children are its four combinations, those that differ in their bit cost one of the
Hamming budget, and a pair that would exceed the budget is pruned with everything below it. Pairs of
small nodes are compared fingerprint by fingerprint, so every link within the budget is found.

On the cluster the top of the trie is cut into subtrees of a bounded number of fingerprints, at whatever
depth that takes; the walk over the cut's nodes gives the pairs of subtrees that survive, and each
such pair is one group of a shuffle, walked in its task with numpy arrays, depth first, so the
frontier stays bounded. A task keeps a spanning forest of the links it finds, not all of them, and skips node
pairs that the forest already joins; the forests' components are the components of all links.

Subtrees hold 1/64 of the fingerprints, 4,096 at least and 2,097,152 at most: while that bound is not
reached a fingerprint is sent to about 33 pairs of subtrees at most, beyond it to more (half of the
prefixes within the budget).

Defined cases: null texts and texts without words have fingerprint zero, which links like any other; fewer
words than a shingle make one shingle. Equal fingerprints are one node, whatever the number of their
documents. Null ids do not count for a component's smallest id; a component with none but null ids has
a null one. Repeated rows are all returned. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.common import written
from logwarden.llm.components import components
from logwarden.llm.tables import free_name, join_parts

SHINGLE, SEED, BITS, BUDGET = 4, 42, 64, 4
PARTS, SMALLEST, LARGEST = 64, 1 << 12, 1 << 21  # subtrees the trie is cut into, and bounds of their size
DEEPER = 8  # bits that a count of prefixes goes further down
LEAF = 8  # fingerprints of a node that is not split further
COMPARED = 1 << 12  # pairs of small nodes compared at once
FRONTIER = 1 << 17  # node pairs that are held and split at once
HOT = 1024  # a fingerprint with more than 1/HOT of all rows is attached by broadcast; at most HOT are
STRETCH = 1 << 16  # shingles hashed at once


# Fingerprints

def fingerprint(text: str | None) -> int:
    """The fingerprint of one text, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    line, hashed = b" ".join(words), xxhash.xxh64_intdigest
    first, last = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    count, total = np.zeros(BITS, dtype=np.int64), len(first)
    for at in range(0, total, STRETCH):
        hashes = np.array([hashed(line[a:b], SEED) for a, b in zip(first[at:at + STRETCH], last[at:at + STRETCH], strict=True)], dtype="<u8")
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view("<u8")[0])


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.int64)


@F.arrow_udf(T.LongType())
def fingerprints(texts: pa.Array) -> pa.Array:
    """The 64 bits of every text's fingerprint as a long."""
    return pa.array(_signed(np.array([fingerprint(t.as_py()) for t in texts], dtype=np.uint64)))


def hex_digits(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# The walk over two subtrees

class Trie:
    """The nodes of all depths over sorted fingerprints; a node is a range of them with a common prefix."""

    def __init__(self, sorted_fps: np.ndarray):
        self.fps, self.starts = sorted_fps, {}

    def level(self, depth: int) -> np.ndarray:
        """First positions of the nodes at ``depth``, and the end."""
        if depth not in self.starts:
            if depth:
                prefix = self.fps >> np.uint64(BITS - depth)
                edges = np.flatnonzero(prefix[1:] != prefix[:-1]) + 1
            else:
                edges = np.zeros(0, dtype=np.int64)
            self.starts[depth] = np.concatenate([[0], edges, [len(self.fps)]])
        return self.starts[depth]

    def children(self, depth: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of nodes at ``depth``: the first child, whether there are two, and the first child's bit."""
        here, below = self.level(depth), self.level(depth + 1)
        first = np.searchsorted(below, here[nodes])
        two = below[first + 1] < here[nodes + 1]
        bit = (self.fps[below[first]] >> np.uint64(BITS - depth - 1)) & np.uint64(1)
        return first, two, bit.astype(np.int64)


class Forest:
    """Which fingerprints the links found so far join."""

    def __init__(self, size: int):
        self.parent, self.joined = np.arange(size), False

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        top = self.parent[nodes]
        while not np.array_equal(up := self.parent[top], top):
            top = up
        self.parent[nodes] = top
        return top

    def join(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Take links in; gives back those that were needed."""
        none = np.zeros(0, dtype=np.int64)
        used_a, used_b = [none], [none]
        while True:
            x, y = self.roots(a), self.roots(b)
            apart = x != y
            if not apart.any():
                return np.concatenate(used_a), np.concatenate(used_b)
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            # One link for every root that hangs itself under a smaller one in this round.
            high, one = np.unique(np.maximum(x, y), return_index=True)
            self.parent[high], self.joined = np.minimum(x, y)[one], True
            used_a.append(a[one])
            used_b.append(b[one])


def walk(left: np.ndarray, right: np.ndarray | None, depth: int, used: int, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two subtrees, or inside one when ``right`` is None.

    Both hold sorted distinct fingerprints; ``depth`` is the number of leading bits at which their nodes stand
    and ``used`` the number of those in which they differ. Gives the linked fingerprints.
    """
    same = right is None
    a = Trie(left)
    b = a if same else Trie(right)
    fps = left if same else np.concatenate([left, right])
    shift = 0 if same else len(left)
    forest, links = Forest(len(fps)), []
    one = np.zeros(1, dtype=np.int64)
    todo = [(depth, one, one, np.full(1, used, dtype=np.int64))]
    while todo:
        depth, x, y, cost = todo.pop()
        sx, sy = a.level(depth), b.level(depth)
        wide = np.maximum(sx[x + 1] - sx[x], sy[y + 1] - sy[y])
        small = (wide <= LEAF) | (depth == BITS)
        if small.any():
            found = _compare(a.fps, b.fps, sx, sy, x[small], y[small], forest, shift, budget)
            if found is not None:
                links.append(found)
            x, y, cost = x[~small], y[~small], cost[~small]
        if not len(x):
            continue
        fx, tx, bx = a.children(depth, x)
        fy, ty, by = b.children(depth, y)
        parts = []
        for i in (0, 1):
            for j in (0, 1):
                real = (tx if i else True) & (ty if j else np.ones(len(x), dtype=bool))
                spent = cost + ((bx ^ i) != (by ^ j))
                real = real & (spent <= budget)
                if same and i > j:
                    real = real & (x != y)  # inside one node the two mixed pairs are the same pair
                parts.append((fx[real] + i, fy[real] + j, spent[real]))
        nx, ny, nc = (np.concatenate([p[k] for p in parts]) for k in range(3))
        for at in range(0, len(nx), FRONTIER):
            piece = slice(at, at + FRONTIER)
            todo.append((depth + 1, nx[piece], ny[piece], nc[piece]))
    none = np.zeros(0, dtype=np.int64)
    i = np.concatenate([none, *[p[0] for p in links]])
    j = np.concatenate([none, *[p[1] for p in links]])
    return fps[i], fps[j]


def _compare(left: np.ndarray, right: np.ndarray, sx: np.ndarray, sy: np.ndarray, x: np.ndarray, y: np.ndarray, forest: Forest, shift: int,
             budget: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Compare all fingerprints of pairs of small nodes; gives the links that join what was apart."""
    places, taken = np.arange(LEAF)[:, None], []
    for at in range(0, len(x), COMPARED):
        piece = slice(at, at + COMPARED)
        # One column per pair of nodes; short nodes repeat their last member, and equal pairs do no harm.
        i = np.minimum(sx[x[piece]] + places, sx[x[piece] + 1] - 1)
        j = np.minimum(sy[y[piece]] + places, sy[y[piece] + 1] - 1)
        if forest.joined:  # pairs of nodes whose members hang under one node already have nothing to add
            label = forest.parent[i[0]]
            apart = (forest.parent[i] != label).any(axis=0) | (forest.parent[j + shift] != label).any(axis=0)
            i, j = i[:, apart], np.ascontiguousarray(j[:, apart])
        near, values, others, flat = [], left[i], right[j], j.ravel()
        for member, value in zip(i, values, strict=True):
            hit = np.flatnonzero(np.bitwise_count(others ^ value) <= budget)
            if len(hit):
                near.append((member[hit % len(member)], flat[hit] + shift))
        if near:
            taken.append(forest.join(*(np.concatenate([n[k] for n in near]) for k in (0, 1))))
    if not taken:
        return None
    return np.concatenate([t[0] for t in taken]), np.concatenate([t[1] for t in taken])


# The cut of the trie's top

def cut(counts: Callable[[list[tuple[int, int]], int], dict[tuple[int, int], dict[int, int]]], limit: int) -> list[tuple[int, int]]:
    """Nodes ``(depth, prefix)`` that cover the trie, each with at most ``limit`` fingerprints, in order.

    ``counts(nodes, below)`` tells for every node how many fingerprints it has under each prefix of
    ``below`` further bits. Nodes that have more than ``limit`` are few: there is room for no others.
    """
    done, open_nodes = [], [(0, 0)]
    while open_nodes:
        deeper = []
        for (depth, prefix), under in counts(open_nodes, DEEPER).items():
            todo = [(depth, prefix, under)]
            while todo:
                d, p, inside = todo.pop()
                size = sum(inside.values())
                if size == 0:
                    continue
                if size <= limit or d == BITS:
                    done.append((d, p))
                elif d == depth + DEEPER:
                    deeper.append((d, p))
                else:
                    bit = depth + DEEPER - d - 1
                    for side in (0, 1):
                        todo.append((d + 1, 2 * p + side, {k: n for k, n in inside.items() if (k >> bit) & 1 == side}))
        open_nodes = deeper
    return sorted(done, key=lambda n: n[1] << (BITS - n[0]))


def partners(top: int, depths: np.ndarray, starts: np.ndarray, budget: int = BUDGET) -> list[dict]:
    """The pairs of cut nodes that ``top`` belongs to and whose common leading bits differ within the budget."""
    both = np.minimum(depths[top], depths)
    # A shift by all 64 bits is not defined; a root that was not cut is alone anyway.
    differ = np.where(both > 0, (starts[top] ^ starts) >> np.minimum(BITS - both, BITS - 1).astype(np.uint64), np.uint64(0))
    used = np.bitwise_count(differ)
    return [{"a": min(top, k), "b": max(top, k), "side": int(k < top), "depth": int(both[k]), "used": int(used[k])}
            for k in np.flatnonzero(used <= budget).tolist()]


def _walk_groups(budget: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        """One pair of subtrees: one row each, or one row for a subtree with itself."""
        table = table.sort_by("side")
        sides = [np.sort(table.column("fps")[k].values.to_numpy(zero_copy_only=False).view(np.uint64)) for k in range(table.num_rows)]
        depth, used = table.column("depth")[0].as_py(), table.column("used")[0].as_py()
        a, b = walk(sides[0], sides[1] if len(sides) == 2 else None, depth, used, budget)
        return pa.table({"a": pa.array(_signed(a)), "b": pa.array(_signed(b))})
    return run


def linked(nodes: DataFrame, budget: int = BUDGET, limit: int | None = None) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that join the same components as all links do."""
    spark = nodes.sparkSession
    bound = limit or min(LARGEST, max(SMALLEST, -(-nodes.count() // PARTS)))

    def counts(roots: list[tuple[int, int]], below: int):
        depth = roots[0][0]
        asked = nodes
        if depth:
            chosen = spark.createDataFrame([(_as_long(p),) for _, p in roots], "root long")  # few: see cut
            asked = nodes.join(F.broadcast(chosen), F.shiftrightunsigned("fp", BITS - depth) == F.col("root"), "leftsemi")
        per = asked.groupBy(F.shiftrightunsigned("fp", BITS - depth - below).alias("p")).count().collect()
        out: dict[tuple[int, int], dict[int, int]] = {r: {} for r in roots}
        for r in per:
            p = r["p"] % (1 << 64)
            out[depth, p >> below][p & ((1 << below) - 1)] = r["count"]
        return out

    tops = cut(counts, bound)
    depths = np.array([d for d, _ in tops], dtype=np.int64)
    starts = np.array([p << (BITS - d) for d, p in tops], dtype=np.uint64)

    @F.arrow_udf(T.IntegerType())
    def subtree(fps: pa.Array) -> pa.Array:
        at = np.searchsorted(starts, fps.to_numpy(zero_copy_only=False).view(np.uint64), side="right") - 1
        return pa.array(at.astype(np.int32))

    @F.arrow_udf("array<struct<a: int, b: int, side: int, depth: int, used: int>>")
    def pairs(top: pa.Array) -> pa.Array:
        kind = pa.struct([(n, pa.int32()) for n in ("a", "b", "side", "depth", "used")])
        return pa.array([partners(t, depths, starts, budget) for t in top.to_pylist()], pa.list_(kind))

    packed = nodes.groupBy(subtree("fp").alias("top")).agg(F.collect_list("fp").alias("fps"))  # at most the bound each
    sent = packed.select("fps", F.explode(pairs("top")).alias("pair")).select("fps", "pair.*")
    # By number, as the groups are small and heavy: merging partitions would leave cores idle.
    return sent.repartition(join_parts(nodes), "a", "b").groupBy("a", "b").applyInArrow(_walk_groups(budget), "a long, b long")


def _as_long(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), budget: int = BUDGET,
            limit: int | None = None) -> DataFrame:
    """The ``keep`` columns with ``fingerprint`` (16 hex digits) and ``component_id`` for every row."""
    names = [free_name(docs, n) for n in ("fingerprint", "component_id")]
    own, fp = free_name(docs, "_key"), free_name(docs, "_fp")
    rows = written(docs.select(*[docs[c] for c in dict.fromkeys(keep)], docs[key].alias(own), fingerprints(docs[text]).alias(fp)), "simhash")
    nodes = written(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(own).alias("least"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    joined = components(written(linked(nodes.select("fp"), budget, limit), "simhash-links"))
    rooted = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "n", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "simhash-roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = written(rooted.join(smallest, "root").select(F.col("fp").alias(fp), "n", F.col("component").alias(names[1])), "simhash-components")
    hot = F.col("n") * HOT > (rooted.agg(F.sum("n")).first()[0] or 0)
    digits = hex_digits(F.col(fp)).alias(names[0])
    shown = [*dict.fromkeys(keep), digits, names[1]]
    # At most HOT fingerprints are that common; the rows of all others meet theirs in a join without hot keys.
    many = rows.join(F.broadcast(named.where(hot)), fp)
    few = rows.join(F.broadcast(named.where(hot).select(fp)), fp, "leftanti").join(named.where(~hot), fp)
    return many.select(*shown).unionByName(few.select(*shown))
