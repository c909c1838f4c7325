"""A Merkle manifest of a data set: one tree per source, one tree over the sources, proofs for every row.

A leaf is the SHA-256 of a row's fields. The leaves of a source stand in the order of their keys; every
three neighbours become the hash of their digests, level by level, until one node, the subroot, is
left. Subroots, in the order of their sources, give the root in the same way.

Only every ``EVERY``-th level is stored (a checkpoint): an aligned subtree of ``3 ** EVERY`` stored nodes
is folded to its top within a row, and nothing between is kept. A proof is taken from the top down: each
aligned subtree is gathered again, its missing levels are computed from the stored nodes under it,
the siblings on the way of each of its nodes are put before the siblings that its top already has, and
the regenerated levels are dropped with the row. So a checkpoint holds 1/27 of the nodes below it, and a
step of the extraction joins subtrees, not rows.

A subtree's key is (tree, place div 27): a source with most of the rows spreads over as many
groups as it has subtrees, and no group holds more than 27 nodes. Places come from sorted ranges;
stretches of places stand in for the source in the join that tells where a source begins.

Defined cases: a null field is hashed as ``-``, so null and empty differ. Null keys come first. Rows that
share source and key stand in the order of their digests; entirely equal rows get places of their
own, in any order. The null source is a source, before all others, also before the empty one. A lone leaf
is its subroot, a lone subroot the root, and an empty table has no root. Columns of the rows pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.llm.feistel_shards import numbered
from logwarden.llm.tables import free_name, let

ARITY, EVERY = 3, 3
SPAN = ARITY**EVERY
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RANGE_ROWS = 1 << 16  # rows of one source and one stretch of places that meet in a join
MAX_LEVELS = 40  # 3 ** 40 rows are more than a long can count
SIBLINGS = "array<struct<before: string, after: string>>"  # level by level: digests left and right of the node


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """The hash of a row's fields: ``-`` for null, else byte count, colon, value."""
    def told(value: Column) -> Column:
        return F.coalesce(let(value.cast("string"), lambda v: F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)), F.lit("-"))

    return digest(F.concat(*[told(f) for f in fields]))


def fold(start: Column, siblings: Column) -> Column:
    """The root that a node and its siblings lead to."""
    return F.aggregate(siblings, start, lambda node, s: digest(F.concat(s["before"], node, s["after"])))


def proof_text(siblings: Column) -> Column:
    """All siblings, level by level, from left to right."""
    return F.array_join(F.transform(siblings, lambda s: F.concat(s["before"], s["after"])), "")


def _over(place: Column, by: int) -> Column:
    return F.call_function("div", place, F.lit(by).cast("bigint"))


def _levels(count: Column) -> Column:
    """How many levels of runs a tree of ``count`` leaves has."""
    return reduce(lambda a, b: a + b, [(count > ARITY**k).cast("int") for k in range(MAX_LEVELS) if ARITY**k < 1 << 63])


def _runs(nodes: Column) -> Column:
    """The next level: the hash of every three neighbours."""
    starts = F.sequence(F.lit(0), F.call_function("div", F.size(nodes) - 1, F.lit(ARITY)).cast("int"))
    return F.transform(starts, lambda r: digest(F.array_join(F.slice(nodes, r * ARITY + 1, ARITY), "")))


def _top(nodes: Column, rise: Column) -> Column:
    """The node that stands ``rise`` levels above a whole subtree."""
    return F.get(F.aggregate(F.sequence(F.lit(1), rise), nodes, lambda level, _: _runs(level)), F.lit(0))


def _subtrees(nodes: DataFrame, rise: Column, *, payload: Sequence[str] = ()) -> DataFrame:
    """Stored nodes gathered per aligned subtree: ``tree, above, rise, items``, items in the order of their places."""
    item = F.struct("place", "node", *payload)
    return (nodes.groupBy("tree", _over(F.col("place"), SPAN).alias("above"))
            .agg(F.first("levels").alias("levels"), F.sort_array(F.collect_list(item)).alias("items"))
            .withColumn("rise", rise))


@dataclass(frozen=True)
class Tree:
    """The stored levels 0, EVERY, 2 EVERY ... of one tree per ``tree`` id, as ``tree, levels, place, node``."""

    stored: tuple[DataFrame, ...]
    payload: tuple[str, ...] = ()

    def roots(self) -> DataFrame:
        """``tree, node``: the top of every tree."""
        # A stored level holds only trees that go on above the one before it.
        tops = [nodes.where(F.col("levels") <= s * EVERY) for s, nodes in enumerate(self.stored)]
        return reduce(DataFrame.unionByName, [t.select("tree", "node") for t in tops])

    def proofs(self, upper: DataFrame) -> DataFrame:
        """The payload, node and ``siblings`` of every leaf.

        ``upper`` (``tree, siblings`` and columns that every leaf of the tree gets) continues above the roots.
        """
        extra = [c for c in upper.columns if c not in ("tree", "siblings")]
        known = None
        for s in range(len(self.stored) - 1, -1, -1):
            nodes, base = self.stored[s], s * EVERY
            kept = self.payload if s == 0 else ()
            here = nodes.where(F.col("levels") <= base).join(upper, "tree").select("tree", "place", "node", *kept, "siblings", *extra)
            if known is not None:
                rise = F.least(F.lit(EVERY), F.col("levels") - base)
                groups = _subtrees(nodes.where(F.col("levels") > base), rise, payload=kept)
                above = known.select("tree", F.col("place").alias("above"), F.col("siblings").alias("higher"), *extra)
                here = here.unionByName(self._expanded(groups.join(above, ["tree", "above"]), kept, extra))
            known = here if s == 0 else written(here, "merkle-proofs")
        return known.drop("tree", "place")

    @staticmethod
    def _expanded(groups: DataFrame, kept: Sequence[str], extra: Sequence[str]) -> DataFrame:
        """Each node of a subtree with the siblings inside it, then those of the subtree's top."""
        bottom = F.transform("items", lambda i: i["node"])
        # The levels between two checkpoints, computed again; those above a tree's root stay empty of use.
        chain = F.aggregate(F.sequence(F.lit(1), F.lit(EVERY - 1)), F.array(bottom),
                            lambda all_levels, _: F.concat(all_levels, F.array(_runs(F.element_at(all_levels, -1)))))
        made = groups.withColumn("made", F.slice(chain, F.lit(1), F.col("rise")))

        def siblings(item: Column) -> Column:
            def at(level: Column, height: Column) -> Column:
                spot = F.call_function("div", item["place"] % SPAN, F.pow(F.lit(ARITY), height).cast("bigint")).cast("int")
                first = spot - spot % ARITY
                return F.struct(F.array_join(F.slice(level, first + 1, spot - first), "").alias("before"),
                                F.array_join(F.slice(level, spot + 2, ARITY - 1 - spot % ARITY), "").alias("after"))
            return F.concat(F.transform(F.col("made"), at), F.col("higher"))

        one = made.select("tree", "made", "higher", *extra, F.explode("items").alias("item"))
        return one.select("tree", F.col("item.place").alias("place"), F.col("item.node").alias("node"),
                          *[F.col("item")[c].alias(c) for c in kept], siblings(F.col("item")).alias("siblings"), *extra)


def grow(leaves: DataFrame, payload: Sequence[str] = ()) -> Tree:
    """Store every ``EVERY``-th level over ``tree, levels, place, node`` and the payload."""
    stored = [leaves]
    tallest = leaves.agg(F.max("levels")).first()[0] or 0
    for base in range(0, tallest, EVERY):
        rise = F.least(F.lit(EVERY), F.col("levels") - base)
        groups = _subtrees(stored[-1].where(F.col("levels") > base), rise)
        level = groups.select("tree", "levels", F.col("above").alias("place"),
                              _top(F.transform("items", lambda i: i["node"]), F.col("rise")).alias("node"))
        stored.append(written(level, "merkle-level"))
    return Tree(tuple(stored), tuple(payload))


@dataclass(frozen=True)
class Manifest:
    sources: Tree  # one tree per source
    top: Tree  # the tree over their subroots; its payload names source and subroot

    def root(self) -> str | None:
        row = self.top.roots().first()
        return None if row is None else row["node"]

    def proofs(self) -> DataFrame:
        """Every row of the leaf table with ``leaf``, ``subroot``, ``root`` and its ``siblings`` up to the root.

        A column of the leaf table that has one of these names keeps it; the new one gets a ``_`` at its end.
        """
        ends = self.top.roots().select("tree", F.array().cast(SIBLINGS).alias("siblings"), F.col("node").alias("_root"))
        upper = self.top.proofs(ends).select(F.col("_tree").alias("tree"), "siblings", "_root", F.col("node").alias("_subroot"))
        found = self.sources.proofs(written(upper, "merkle-sources"))
        for name, wish in (("node", "leaf"), ("_subroot", "subroot"), ("_root", "root")):
            rows = found.select("_row.*")
            found = found.withColumn("_row", F.struct("_row.*", F.col(name).alias(free_name(rows, wish))))
        return found.withColumn("_row", F.struct("_row.*", F.col("siblings").alias(free_name(found.select("_row.*"), "siblings")))).select("_row.*")


def build(rows: DataFrame, node: Column, source: str = "source", key: str = "doc_id") -> Manifest:
    """The manifest of ``rows``, whose digest is ``node``; the rows' columns are carried to the proofs.

    Carry few columns: whole texts need not pass through the sort.
    """
    carried = F.struct(*[rows[c] for c in rows.columns])
    # A key that is never null and sorts null first, then bytewise.
    tagged = rows.select(F.coalesce(F.concat(F.lit("s"), rows[source].cast("string")), F.lit("")).alias("_source"),
                         rows[key].alias("_key"), node.alias("node"), carried.alias("_row"))
    placed, _ = numbered(tagged, ["_source", "_key", "node"])
    placed = placed.withColumn("_range", _over(F.col("row_number"), RANGE_ROWS))
    per = written(placed.groupBy("_range", "_source").agg(F.min("row_number").alias("at"), F.count(F.lit(1)).alias("n")), "merkle-ranges")
    starts = per.groupBy("_source").agg(F.min("at").alias("start"), F.sum("n").alias("count"))
    # Sources in order: the number of a source is that of sources which begin before its first row.
    listed, sources = numbered(starts, ["_source"])
    listed = written(listed.select("_source", F.col("row_number").alias("tree"), "start", "count"), "merkle-sources")
    begins = per.select("_range", "_source").join(listed, "_source")
    leaves = written(placed.join(begins, ["_range", "_source"]).select(
        "tree", _levels(F.col("count")).alias("levels"), (F.col("row_number") - F.col("start")).alias("place"), "node", "_row"), "merkle-leaves")
    tree = grow(leaves, ["_row"])
    subroots = tree.roots().select(F.lit(0).cast("bigint").alias("tree"), _levels(F.lit(sources).cast("bigint")).alias("levels"),
                                   F.col("tree").alias("place"), "node", F.col("tree").alias("_tree"))
    return Manifest(tree, grow(written(subroots, "merkle-subroots"), ["_tree"]))
