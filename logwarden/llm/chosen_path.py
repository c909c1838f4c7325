"""Near-duplicate join on word shingles by chosen paths.

A text is the set of its five-word shingles. In every run a set chooses about ``1 / similarity`` of
its shingles by a hash that all sets share, so two similar sets choose a common shingle with a
probability known beforehand. Sets that chose the same shingle form a bucket. A bucket that is too
large is split again and again on further sampled shingles of its sets (entries of their
one-permutation sketch, several at a level, so that few similar sets part); one that does not fall
apart is cut into blocks, and all pairs of blocks are taken. The number of runs follows from the
target recall, counting the choice of paths, the deepest splits and the sketches' margin. Buckets are searched by brute force on sketches, with
a wide margin; each gives a spanning forest of what it found, never all pairs.

The forests are joined to candidate classes, and inside each class all similarities are computed
exactly from the shingles, block against block where a class is large. The answer is one row per
document: its class and its number of links.

Defined cases: words are runs of characters other than the six ASCII white-space characters; a text
of one to four words has one shingle; a text without a word, or null, links to nothing and is its own
class; texts with equal shingle sets are linked to each other; repeated rows count as documents of
their own; the class is named by its smallest doc_id, null only where no other exists; other columns
of the input are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.llm.components import components
from logwarden.llm.tables import free_name, join_parts, small_batches, whole_groups, whole_text

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9999
SKETCH = 64
MARGIN = 0.25  # sketches estimate a similarity to about 0.05
BUCKET = 1024  # sets that a bucket may hold for brute force
DEPTH = 3  # further splits of larger buckets
ENTRIES = 2  # sketch entries by which a set goes on at a split
BLOCK = 512  # sets of a class that are compared at once


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word windows of a text."""
    parts = text.encode("utf-8", "replace").split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    span = min(words, len(parts))
    count = len(parts) - span + 1
    out = np.full(count, span, np.uint64)
    for i in range(span):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + found[i:i + count])
    return np.unique(out)


def sketch(tokens: np.ndarray) -> bytes:
    """The smallest shingle of each of 64 ranges, as a byte; 0 where a range is empty."""
    edges = np.arange(SKETCH, dtype=np.uint64) << np.uint64(64 - int(math.log2(SKETCH)))
    at = np.searchsorted(tokens, edges)
    upper = np.append(at[1:], len(tokens))
    first = tokens[np.minimum(at, len(tokens) - 1)]
    return np.where(at < upper, (first & np.uint64(0xFFFFFF)) % np.uint64(255) + np.uint64(1), 0).astype(np.uint8).tobytes()


def expected_miss(runs: int, similarity: float, depth: int = DEPTH, margin: float = MARGIN) -> float:
    """Chance that a pair at the threshold is not found although all its buckets are split ``depth`` times.

    Such a pair shares at least ``similarity`` of the larger set, and each of its shingles chooses
    ``1 / similarity`` shingles in the mean, so it meets once a run in the mean. Its sketches agree in a
    binomial number of entries at worst; too few, and it is no candidate; otherwise a split keeps it
    together unless all of the entries drawn there differ.
    """
    missed = 0.0
    for same in range(SKETCH + 1):
        chance = math.comb(SKETCH, same) * similarity**same * (1 - similarity) ** (SKETCH - same)
        kept = 1 - math.comb(SKETCH - same, ENTRIES) / math.comb(SKETCH, ENTRIES)
        missed += chance * (math.exp(-runs * kept**depth) if same >= (similarity - margin) * SKETCH else 1.0)
    return missed


def runs_for(recall: float, similarity: float, depth: int = DEPTH, margin: float = MARGIN) -> int:
    """Runs after which a pair at the threshold has been found with the given probability."""
    if expected_miss(1 << 20, similarity, depth, margin) > 1 - recall:
        raise ValueError("the sketches' margin alone misses more than the recall allows")
    runs = 1
    while expected_miss(runs, similarity, depth, margin) > 1 - recall:
        runs += 1
    return runs


def set_id(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _sets(docs: DataFrame, similarity: float, runs: int) -> DataFrame:
    """``doc_id, text_key, sid, size, paths, sketch`` of every row; the last four are null without a word."""
    seeds = mixed(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, paths, sketches = [], [], [], []
            for text in batch.column(2):
                tokens = shingles(text.as_py())
                if not len(tokens):
                    for column in (ids, sizes, paths, sketches):
                        column.append(None)
                    continue
                below = np.uint64(min(2**64 - 1, int(2**64 / max(1.0, similarity * len(tokens)))))
                chosen = []
                for at in range(0, len(tokens), 1 << 16):
                    hashed = mixed(tokens[None, at:at + (1 << 16)] ^ seeds[:, None])
                    chosen.append(hashed[hashed <= below])
                ids.append(set_id(tokens))
                sizes.append(len(tokens))
                paths.append(np.concatenate(chosen).view(np.int64))
                sketches.append(sketch(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(paths, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "text_key", "sid", "size", "paths", "sketch"])

    text = whole_text(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = small_batches(docs).select(docs["doc_id"], F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"), text.alias("t"))
    return rows.mapInArrow(run, f"doc_id {kind}, text_key binary, sid binary, size bigint, paths array<bigint>, sketch binary")


class Forest:
    """Union-find over positions; the smallest position of a tree is its root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _alike(left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Pairs of rows of two sketch tables whose estimated similarity reaches ``least``."""
    same = np.zeros((len(left), len(right)), np.int16)
    empty = np.zeros((len(left), len(right)), np.int16)
    for c in range(SKETCH):
        a, b = left[:, c][:, None], right[:, c][None, :]
        same += (a == b) & (a > 0)
        empty += (a | b) == 0
    return np.argwhere(same >= least * (SKETCH - empty))


def _bucket_edges(sketches: np.ndarray, least: float) -> list[tuple[int, int]]:
    """A spanning forest of the similar rows of one bucket, as (position, root)."""
    n = len(sketches)
    forest = Forest(n)
    for at in range(0, n, 128):
        for i, j in _alike(sketches[at:at + 128], sketches[at:], least).tolist():
            if i != j:
                forest.join(at + i, at + j)
    return [(i, forest.root(i)) for i in range(n) if forest.root(i) != i]


def _search(rows: DataFrame, least: float) -> DataFrame:
    """Edges ``a, b`` found in the buckets of ``path, sid, sketch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 1):
            path = table.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(path[1:] != path[:-1]) + 1, [len(path)]])
            wanted = np.flatnonzero(np.diff(cuts) > 1)
            if not len(wanted):
                continue
            sids = table.column(1).to_pylist()
            looks = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(-1, SKETCH)
            found = set()
            for k in wanted.tolist():
                start, stop = cuts[k], cuts[k + 1]
                for i, root in _bucket_edges(looks[start:stop], least):
                    found.add((sids[start + i], sids[start + root]))
            if found:
                a, b = zip(*sorted(found))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    parts = join_parts(rows)
    return rows.repartition(parts, "path").sortWithinPartitions("path", "sid").mapInArrow(run, "a binary, b binary")


def _buckets(sets: DataFrame, bucket: int, depth: int) -> DataFrame:
    """``path, sid, sketch`` with at most about ``2 * bucket`` sets a path."""
    rows = sets.select(F.explode("paths").alias("path"), "sid", "sketch", F.lit(None).cast("bigint").alias("above"))
    done = []
    for level in range(depth + 1):
        sizes = written(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket), "large-buckets")
        if sizes.isEmpty():
            done.append(rows.drop("above"))
            break
        tagged = written(rows.join(sizes, "path", "left"), "buckets")
        done.append(tagged.where("n is null").drop("n", "above"))
        large = tagged.where("n is not null")
        # Parts nearly as large as the bucket above make more work together than it does: such a bucket does not fall apart.
        whole = F.lit(True) if level == depth else F.coalesce(F.lit(ENTRIES) * F.col("n") * F.col("n") >= F.col("above") * F.col("above"), F.lit(False))
        blocks = F.ceil(F.col("n") / bucket).cast("bigint")
        own = F.pmod(F.xxhash64("sid"), blocks)
        pairs = large.where(whole).withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        done.append(pairs.select(F.xxhash64("path", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("path"), "sid", "sketch"))
        if level < depth:
            # Sets that agree in one of the sampled entries share a shingle there, but for one in 255.
            first = F.pmod(F.xxhash64("path", F.lit(level)), F.lit(SKETCH)).cast("int")
            step = F.lit(2) * F.pmod(F.xxhash64("path", F.lit(level), F.lit("step")), F.lit(SKETCH // 2)).cast("int") + 1
            entries = F.array(*[F.pmod(first + step * k, F.lit(SKETCH)) for k in range(ENTRIES)])
            spread = large.where(~whole).withColumn("_entry", F.explode(entries))
            value = F.substring(F.col("sketch"), F.col("_entry") + 1, F.lit(1))
            rows = spread.select(F.xxhash64("path", "_entry", value, F.lit(level)).alias("path"), "sid", "sketch", F.col("n").alias("above"))
    return _all(done)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    tokens, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    own = np.repeat(np.arange(n), sizes)
    useful = count > 1
    column = np.cumsum(useful) - 1
    keep = useful[where]
    own, where = own[keep], column[where[keep]]
    order = np.argsort(where, kind="stable")
    own, where = own[order], where[order]
    shared = np.zeros((n, n), np.float32)
    width = 4096
    for start in range(0, int(useful.sum()), width):
        lo, hi = np.searchsorted(where, [start, start + width])
        grid = np.zeros((n, width), np.float32)
        grid[own[lo:hi], where[lo:hi] - start] = 1
        shared += grid @ grid.T
    return shared


def _verify(rows: DataFrame, similarity: float) -> DataFrame:
    """Exact links inside blocks of classes: per set its links, the documents behind them, and the root of its tree.

    ``rows``: class, left, right (numbers of two blocks), own block, sid, copies, tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 3):
            names, left, right, own = (table.column(i).to_pylist() for i in range(4))
            sids, copies = table.column(4).to_pylist(), table.column(5).to_numpy()
            sets = [np.frombuffer(t, np.uint64) for t in table.column(6).to_pylist()]
            out: list[tuple[bytes, bytes, int, int]] = []
            start = 0
            for stop in range(1, len(sids) + 1):
                if stop < len(sids) and (names[stop], left[stop], right[stop]) == (names[start], left[start], right[start]):
                    continue
                group = sets[start:stop]
                sizes = np.array([len(s) for s in group], np.float64)
                shared = _shared(group).astype(np.float64)
                linked = shared >= similarity * (sizes[:, None] + sizes[None, :] - shared) - 1e-6
                np.fill_diagonal(linked, False)
                if left[start] != right[start]:
                    block = np.array(own[start:stop])
                    linked &= block[:, None] != block[None, :]
                forest = Forest(stop - start)
                for i, j in np.argwhere(np.triu(linked)).tolist():
                    forest.join(i, j)
                links, behind = linked.sum(axis=1), linked @ copies[start:stop]
                out.extend((sids[start + i], sids[start + forest.root(i)], int(links[i]), int(behind[i])) for i in range(stop - start))
                start = stop
            a, b, n, d = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                ["sid", "root", "links", "behind"])

    order = ["class", "left", "right"]
    dealt = rows.repartition(join_parts(rows), *order).sortWithinPartitions(*order, "sid")
    return dealt.select("class", "left", "right", "own", "sid", "copies", "tokens").mapInArrow(
        run, "sid binary, root binary, links bigint, behind bigint")


def _tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class, sid, copies, tokens`` from one document of each wanted set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [shingles(t.as_py()).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(tokens, pa.binary())], ["class", "sid", "copies", "tokens"])

    text = whole_text(docs)
    rows = docs.select(docs["doc_id"].alias("_id"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("_key"), text.alias("_text"))
    met = rows.join(wanted.hint("shuffle_hash"), rows["_id"].eqNullSafe(wanted["rep.doc_id"]) & (rows["_key"] == wanted["rep.text_key"]))
    once = met.select("class", "sid", "copies", "_text")
    return once.mapInArrow(run, "class binary, sid binary, copies bigint, tokens binary").dropDuplicates(["sid"])


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, bucket: int = BUCKET,
         depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """``doc_id, text_key, class_id, keep, n_links, class_size`` of every row.

    ``text_key`` is the digest of the text; ``keep`` is the (doc_id, text_key) that represents the class, the smallest.
    """
    rows = written(_sets(docs, similarity, runs_for(recall, similarity, depth)), "shingle-sets")
    own = F.struct("doc_id", "text_key")
    sets = written(rows.where("sid is not null").groupBy("sid").agg(
        F.first("paths").alias("paths"), F.first("sketch").alias("sketch"), F.min(_nulls_last(own)).alias("least"),
        F.count(F.lit(1)).alias("copies")), "distinct-sets").withColumn("rep", F.col("least.of"))
    found = _search(_buckets(sets, bucket, depth), similarity - MARGIN)
    candidates = components(found)
    roots = candidates.select(F.col("root").alias("node"), "root").distinct()
    classed = written(sets.select("sid", "rep", "copies").join(
        candidates.union(roots).withColumnsRenamed({"node": "sid", "root": "class"}), "sid"), "candidate-classes")
    sizes = classed.groupBy("class").agg(F.ceil(F.count(F.lit(1)) / block).cast("bigint").alias("blocks"))
    tokens = _tokens(docs, classed).join(sizes, "class")
    mine = tokens.withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    pairs = mine.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).select(
        "class", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "sid", "copies", "tokens")
    verified = written(_verify(pairs, similarity), "links")
    counts = verified.groupBy("sid").agg(F.sum("links").alias("links"), F.sum("behind").alias("behind"))
    tree = components(verified.where("sid != root").select(F.col("sid").alias("a"), F.col("root").alias("b")))
    joined = sets.select("sid", "least", "copies").join(counts, "sid", "left").join(tree.withColumnRenamed("node", "sid"), "sid", "left")
    known = written(joined.select("sid", F.coalesce("root", "sid").alias("root"), "least", "copies",
                                  F.coalesce("behind", F.lit(0)).alias("behind")), "set-classes")
    heads = known.groupBy("root").agg(F.min("least").alias("least"), F.sum("copies").alias("class_size"))
    per_set = written(known.select("sid", "root", "copies", "behind").join(heads, "root").select(
        "sid", F.col("least.of").alias("keep"), "class_size", (F.col("behind") + F.col("copies") - 1).alias("n_links")), "classes")
    out = rows.select("doc_id", "text_key", "sid").join(per_set, "sid", "left")
    return out.select("doc_id", "text_key", F.coalesce("keep", own).alias("keep"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      F.coalesce("class_size", F.lit(1)).alias("class_size")).withColumn("class_id", F.col("keep.doc_id"))


def _nulls_last(key: Column) -> Column:
    """A struct that sorts rows without a doc_id after all others."""
    return F.struct(key["doc_id"].isNull().alias("without"), key.alias("of"))


def deduplicate(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that represent their class, all columns as they were.

    Rows equal in doc_id and text stay or go together.
    """
    found = join(docs, **settings)
    own_id, own_key, key = (free_name(docs, n) for n in ("_id", "_key", "_text_key"))
    stays = F.col("keep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("keep.text_key") == F.col("text_key"))
    gone = found.where(~stays).select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).distinct()
    own = docs.withColumn(key, F.unhex(F.sha2(whole_text(docs).cast("binary"), 256)))
    met = own.join(gone.hint("shuffle_hash"), own["doc_id"].eqNullSafe(gone[own_id]) & (own[key] == gone[own_key]), "left_anti")
    return met.drop(key)
