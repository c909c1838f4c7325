"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere is removed. The work is
cut down without losing a match: each window of ``LENGTH`` bytes is assigned to the smallest hash of
a short gram inside it, its anchor. Equal windows have equal anchors, so

* a run of windows whose anchor occurs once in the corpus is settled: nothing repeats,
* a run that occurs again as a whole, with the same first and last window, is settled: all repeats,
* only runs that share an anchor but differ, or hold their anchor twice, are compared suffix by suffix.

For those, the bytes of the runs that share an anchor meet in one partition. They are cut into
shards; each shard sorts its own suffixes and yields its Burrows-Wheeler transform over an alphabet
of ``SYMBOL``-byte strings. The transforms are merged by refining their interleave (Holt and
McMillan): every round stably distributes the interleave by the preceding symbols, which extends the
known common prefix of each block by one symbol, so after ``LENGTH / SYMBOL`` rounds the blocks are
the intervals whose suffixes share a prefix of ``LENGTH`` bytes. No suffix is sorted again. An anchor
with more than ``HEAVY`` different runs is not brought together: its windows are counted one by one
with partial aggregation, which gives the same answer.

Strings are compared by 64-bit hashes. Defined cases: null text counts as empty; a text shorter than
``LENGTH`` bytes loses nothing; repeated rows repeat each other; positions are bytes of the UTF-8
text; other columns of the input are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.llm.tables import join_parts, small_batches, whole_groups, whole_text

LENGTH = 400
SYMBOL = 100
GRAM = 32
WIDTH = LENGTH - GRAM + 1  # grams in a window
SHARD_BYTES = 1 << 18
CHUNK_BYTES = 1 << 19
STRETCH = 1 << 19
HEAVY = 2048
RUN = "doc_id {kind}, key bigint, lo bigint, len bigint, fp bigint, first bigint, last bigint, inner boolean"

_draw = np.random.default_rng(20261201)
BYTE = _draw.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = _draw.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _pair(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    """Hash of two neighbouring strings from their hashes."""
    x = left * ODD[level] + right
    x ^= x >> np.uint64(31)
    x *= ODD[level + 7]
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(data: np.ndarray, longest: int = 256) -> list[np.ndarray]:
    """Hashes of all strings of 1, 2, 4 ... ``longest`` bytes, as long as there are any."""
    levels, size = [BYTE[data]], 1
    while size < longest and len(levels[-1]) > size:
        last = levels[-1]
        levels.append(_pair(last[:-size], last[size:], len(levels)))
        size *= 2
    return levels


def spread_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if width > size else values


def window_hashes(levels: list[np.ndarray]) -> np.ndarray:
    """Hashes of all windows, from those of 256 bytes at both of their ends."""
    long = levels[8]
    return _pair(long[:len(long) - (LENGTH - 256)], long[LENGTH - 256:], 0)


def runs(text: bytes) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first window, number of windows, anchor, hashes of the first and last
    window, and whether the anchor stands in the run more than once.

    A run of more than ``WIDTH`` windows, as in periodic text, is cut, so its end windows cover all its bytes.
    """
    levels = gram_hashes(np.frombuffer(text, np.uint8))
    anchor = spread_min(levels[5], WIDTH)
    window = window_hashes(levels)
    cuts = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    sizes = np.diff(np.append(cuts, len(anchor)))
    pieces = -(-sizes // WIDTH)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    lo = np.repeat(cuts, pieces) + nth * WIDTH
    size = np.minimum(WIDTH, np.repeat(sizes, pieces) - nth * WIDTH)
    gram, fp = levels[5], anchor[lo]
    inner = [np.count_nonzero(gram[a:b] == v) > 1 for a, b, v in zip(lo.tolist(), (lo + size - 1 + WIDTH).tolist(), fp)]
    return lo, size, fp.view(np.int64), window[lo].view(np.int64), window[lo + size - 1].view(np.int64), np.array(inner)


def _runs(docs: DataFrame) -> DataFrame:
    """All runs of all documents; ``key`` tells rows of one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found, rows = [], []
                for i, text in enumerate(part.column(2)):
                    data = text.as_py()
                    # A long text is read in stretches of windows; where a run is cut does not matter.
                    for first in range(0, len(data) - LENGTH + 1, STRETCH):
                        lo, *rest = runs(data[first:first + STRETCH + LENGTH - 1])
                        found.append((lo + first, *rest))
                        rows.append(np.full(len(lo), i))
                if found:
                    which = pa.array(np.concatenate(rows))
                    columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(which), part.column(1).take(which), *columns],
                                                     ["doc_id", "key", "lo", "len", "fp", "first", "last", "inner"])

    return _keyed(docs).mapInArrow(run, RUN.format(kind=docs.schema["doc_id"].dataType.simpleString()))


def _keyed(docs: DataFrame) -> DataFrame:
    text = whole_text(small_batches(docs))
    return docs.select(docs["doc_id"].alias("doc_id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("bytes"))


def stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable ascending order of numbers below 2^32, by two counting sorts of their halves."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    high = (keys >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def dense_ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks 0.. of keys that stand sorted in ``order``."""
    at = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.append(False, at[1:] != at[:-1])) if len(at) else at
    return out


class Shard:
    """The Burrows-Wheeler transform of some strings over ``SYMBOL``-byte symbols.

    Nodes are all positions of all strings, the end included; the symbol of a node starts at it, and is
    0 where less than ``SYMBOL`` bytes are left. The node before is ``SYMBOL`` bytes to the left; the
    first nodes of a string are preceded by its last ones, by symbol 0.
    """

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray):
        n = len(symbols)
        starts = np.cumsum(sizes) - sizes
        place = np.arange(n) - np.repeat(starts, sizes)
        left = np.repeat(sizes, sizes) - 1 - place  # bytes to the end
        rank, step = symbols.astype(np.int64), SYMBOL
        while step < sizes.max(initial=0):
            ahead = np.zeros(n, np.int64)
            ahead[:max(0, n - step)] = rank[step:] + 1
            ahead[left < step] = 0
            order = stable_order(ahead)
            order = order[stable_order(rank[order])]
            rank = dense_ranks(rank * (int(ahead.max(initial=0)) + 1) + ahead, order)
            step *= 2
        # Equal suffixes are ordered by string and residue, as are the nodes before them.
        tie = stable_order(np.repeat(np.arange(len(sizes)), sizes) * SYMBOL + place % SYMBOL)
        self.order = tie[stable_order(rank[tie])]
        before = np.where(place >= SYMBOL, symbols[np.maximum(np.arange(n) - SYMBOL, 0)], 0)
        self.transform = before[self.order]


def interleave(shards: list[Shard], rounds: int) -> np.ndarray:
    """Merge the shards' transforms; returns per node, shard after shard, the block of its common prefix of ``rounds`` symbols."""
    sizes = [len(s.order) for s in shards]
    symbols = np.concatenate([s.transform for s in shards])
    which = np.repeat(np.arange(len(shards), dtype=np.uint16), sizes)
    block = np.zeros(len(symbols), np.int64)
    mine = np.arange(len(symbols))
    for _ in range(rounds):
        # Each shard's entries stand in the interleave in the order of its own transform.
        read = np.empty(len(symbols), symbols.dtype)
        read[mine] = symbols
        order = stable_order(read)
        which, read, block = which[order], read[order], block[order]
        fresh = np.ones(len(read), bool)
        fresh[1:] = (read[1:] != read[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(fresh)
        mine = np.argsort(which, kind="stable")
    out = np.empty(len(symbols), np.int64)
    nodes = np.concatenate([s.order + shift for s, shift in zip(shards, np.cumsum([0, *sizes[:-1]]))])
    out[nodes] = block[mine]
    return out


def repeated_windows(strings: list[bytes]) -> list[np.ndarray]:
    """Per string, which of its windows occur more than once among all windows of all strings."""
    sizes = np.array([len(s) + 1 for s in strings])
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    grams = gram_hashes(data, 64)[6]
    symbol = _pair(grams[:len(grams) - (SYMBOL - 64)], grams[SYMBOL - 64:], 1)
    left = np.repeat(np.cumsum(sizes), sizes) - 1 - np.arange(len(data))
    full = np.flatnonzero(left[:len(symbol)] >= SYMBOL)
    symbols = np.zeros(len(data), np.int64)
    symbols[full] = np.unique(symbol[full], return_inverse=True)[1] + 1
    shards, start, first = [], 0, 0
    ends = np.cumsum(sizes)
    while first < len(strings):
        last = max(first + 1, int(np.searchsorted(ends, start + SHARD_BYTES)))
        stop = int(ends[last - 1])
        shards.append(Shard(symbols[start:stop], sizes[first:last]))
        start, first = stop, last
    block = interleave(shards, LENGTH // SYMBOL)
    whole = left >= LENGTH
    size = np.bincount(block[whole], minlength=int(block.max(initial=0)) + 1)
    again = whole & (size[block] > 1)
    return [again[end - size_:end - size_ + max(0, size_ - LENGTH)] for end, size_ in zip(ends, sizes)]


def _edges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    step = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _compare(rows: DataFrame) -> DataFrame:
    """``doc_id, key, lo, hi``: repeated bytes of the single runs among ``fp, doc_id, key, lo, single, bytes``."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, size = [], 0
        for table in whole_groups(batches, 1):
            # One table may hold many anchors; it is cut between them.
            fp = table.column(0).to_numpy()
            ends = np.append(np.flatnonzero(fp[1:] != fp[:-1]) + 1, len(fp))
            weight = np.cumsum([len(b.as_buffer()) for b in table.column(5).combine_chunks()]) if len(fp) else np.empty(0)
            start = 0
            for end in ends.tolist():
                if weight[end - 1] - (weight[start - 1] if start else 0) + size >= CHUNK_BYTES or end == len(fp):
                    part = table.slice(start, end - start)
                    held.append(part)
                    size += int(weight[end - 1] - (weight[start - 1] if start else 0))
                    start = end
                    if size >= CHUNK_BYTES:
                        yield pa.concat_tables(held)
                        held, size = [], 0
        if held:
            yield pa.concat_tables(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches):
            lo, single = table.column(3).to_numpy(), table.column(4).to_pylist()
            rows_, starts, ends = [], [], []
            for i, flags in enumerate(repeated_windows(table.column(5).to_pylist())):
                if single[i] and flags.any():
                    a, b = _edges(flags)
                    rows_.append(np.full(len(a), i))
                    starts.append(lo[i] + a)
                    ends.append(lo[i] + b - 1 + LENGTH)
            if rows_:
                which = pa.array(np.concatenate(rows_))
                table = table.combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [_one(table.column(1).take(which)), _one(table.column(2).take(which)), pa.array(np.concatenate(starts)), pa.array(np.concatenate(ends))],
                    ["doc_id", "key", "lo", "hi"])

    dealt = rows.repartition(join_parts(rows), "fp").sortWithinPartitions("fp")
    return dealt.select("fp", "doc_id", "key", "lo", "single", "bytes").mapInArrow(run, f"doc_id {kind}, key bigint, lo bigint, hi bigint")


def _one(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return found.chunk(0) if isinstance(found, pa.ChunkedArray) else found


def _count(rows: DataFrame) -> DataFrame:
    """The same for anchors with very many runs: every window is counted by its hash."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(batch.column(5).to_pylist()):
                hashes = window_hashes(gram_hashes(np.frombuffer(data, np.uint8))).view(np.int64)
                which = pa.array(np.full(len(hashes), i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(which), batch.column(1).take(which), batch.column(2).take(which),
                     pa.array(batch.column(3)[i].as_py() + np.arange(len(hashes))), batch.column(4).take(which), pa.array(hashes)],
                    ["fp", "doc_id", "key", "lo", "single", "window"])

    windows = rows.select("fp", "doc_id", "key", "lo", "single", "bytes").mapInArrow(
        run, f"fp bigint, doc_id {kind}, key bigint, lo bigint, single boolean, window bigint")
    twice = windows.groupBy("fp", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp", "window")
    return windows.where("single").join(twice, ["fp", "window"]).select("doc_id", "key", "lo", (F.col("lo") + LENGTH).alias("hi"))


def _bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted runs: ``fp, doc_id, key, lo, single, bytes``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                which, places, cut = [], [], []
                for i, (data, wanted_here) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    which += [i] * len(wanted_here)
                    places += wanted_here
                    cut += [data[p["lo"]:p["lo"] + p["len"] - 1 + LENGTH] for p in wanted_here]
                rows = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p["fp"] for p in places], pa.int64()), part.column(0).take(rows), part.column(1).take(rows),
                     pa.array([p["lo"] for p in places], pa.int64()), pa.array([p["single"] for p in places], pa.bool_()),
                     pa.array(cut, pa.binary())],
                    ["fp", "doc_id", "key", "lo", "single", "bytes"])

    lists = wanted.groupBy("doc_id", "key").agg(F.collect_set(F.struct("fp", "lo", "len", "single")).alias("places"))
    return _met(docs, lists, "inner").select("doc_id", "key", "bytes", "places").mapInArrow(
        run, f"fp bigint, doc_id {kind}, key bigint, lo bigint, single boolean, bytes binary")


def _met(docs: DataFrame, per_text: DataFrame, how: str) -> DataFrame:
    """Documents with what is known of them; the texts are streamed past the smaller table."""
    known = per_text.withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    rows = _keyed(docs)
    return rows.join(known.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(known["_id"]) & (rows["key"] == known["_key"]), how).drop("_id", "_key")


def repeated(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``doc_id, key, spans``: byte ranges that repeat, unmerged, of the texts that have any."""
    every = written(_runs(docs), "runs")
    look = F.struct("first", "last", "len")
    anchors = every.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(look).alias("low"), F.max(look).alias("high"),
                                      F.bool_or("inner").alias("inner"))
    mixes = F.col("inner") | (F.col("low") != F.col("high"))
    shared = written(anchors.where("n > 1 or inner").select("fp", mixes.alias("mixed")), "anchors")
    some = written(every.drop("inner").join(shared, "fp"), "shared-runs")
    mixed = some.where("mixed")
    forms = written(mixed.groupBy("fp", "first", "last", "len").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "key", "lo")).alias("rep")), "forms")
    whole = some.where("not mixed").select("doc_id", "key", "lo", "len").union(
        mixed.join(forms.where("n > 1").drop("n", "rep"), ["fp", "first", "last", "len"]).select("doc_id", "key", "lo", "len"))
    crowded = written(forms.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy).select("fp"), "heavy-anchors")
    wanted = forms.select("fp", "rep.doc_id", "rep.key", "rep.lo", "len", (F.col("n") == 1).alias("single"))
    parts = written(_bytes(docs, wanted), "run-bytes")
    found = _compare(parts.join(crowded, "fp", "left_anti"))
    if not crowded.isEmpty():
        found = found.union(_count(parts.join(crowded, "fp", "left_semi")))
    spans = whole.select("doc_id", "key", "lo", (F.col("lo") + F.col("len") - 1 + LENGTH).alias("hi")).union(found)
    return spans.groupBy("doc_id", "key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def remove(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """``doc_id, n_bytes, spans`` (merged), ``kept`` (the remaining bytes) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                kept, merged, sizes = [], [], []
                for data, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    out, at, runs_ = [], 0, []
                    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                        if runs_ and lo <= runs_[-1][1]:
                            runs_[-1][1] = max(hi, runs_[-1][1])
                        else:
                            runs_.append([lo, hi])
                    for lo, hi in runs_:
                        out.append(data[at:lo])
                        at = hi
                    kept.append(b"".join(out) + data[at:])
                    merged.append([{"lo": lo, "hi": hi} for lo, hi in runs_])
                    sizes.append(len(data))
                shape = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(merged, shape), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    met = _met(docs, repeated(docs, heavy), "left").select("doc_id", "bytes", "spans")
    return met.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, spans array<struct<lo:bigint,hi:bigint>>, kept binary")
