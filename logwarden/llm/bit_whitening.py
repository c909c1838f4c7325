"""Whitening of embeddings from an exact scatter matrix, counted bit plane by bit plane.

Every entry ``c`` becomes the integer ``x = floor(64 c) + 1000000``. The fit list holds each distinct
integer vector once. A task takes its share of the list in stretches: the integers of a dimension
are shifted to start at zero, their bits are packed across rows into 64-bit words, one word row per
(dimension, bit), and the number of rows that two planes share is the popcount of their AND. Weighted
with the two bits' values these counts are the cross-products, without rounding. Spark adds them up
per pair of dimensions; ``n * sum(x y) - sum(x) sum(y)`` is taken in unbounded integers, and only the
centred result becomes a double matrix, whose unit eigenvectors whiten any row.

What comes to the driver is one number per pair of dimensions, whatever the number of rows. Copies
of a vector meet in a distinct that aggregates before its shuffle, so a hot vector sends one row a task.

Defined cases: a row is usable when its vector is not null and every entry is a number below 1e17 in
size; the others are left out. Vectors of a length other than the commonest among the distinct ones
(the longest of equally common ones) are left out as well, as are vectors without entries. Repeated
rows are all returned and count once in the fit list. Directions without variance are no components, so
one distinct vector, or an empty table, gives no components. A ``deviation`` beyond a long is null.
All columns of the input stay; new names give way to theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.llm.tables import free_name

STEPS, ORIGIN = 64, 1_000_000  # x = floor(STEPS * c) + ORIGIN
LARGEST = 1e17  # beyond this an entry has no exact place among the longs
COMPONENTS = 16
STRETCH = 8192  # rows whose bit planes are held at once
LIMB = 40  # bits of a summand, so that Spark's long sums cannot overflow


@dataclass(frozen=True)
class Whitening:
    """Sums of the fit list, eigenvalues by falling size, and unit eigenvectors as columns."""

    n: int
    sums: tuple[int, ...]
    scatter: tuple[tuple[int, ...], ...]  # n * sum(x y) - sum(x) sum(y), exact
    values: np.ndarray
    vectors: np.ndarray
    total: float
    identity_error: float = 0.0

    @property
    def components(self) -> int:
        return len(self.values)


def usable(vector: Column) -> Column:
    """Whether all entries are finite numbers that have an integer."""
    return F.coalesce(F.forall(vector, lambda c: F.abs(c.cast("double")) < LARGEST), F.lit(False)) & (F.size(vector) > 0)


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS) + ORIGIN)


def _matrix(column: pa.Array) -> np.ndarray:
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the shifted columns as 64-bit words; with the dimension and the bit of each plane."""
    shifted = np.ascontiguousarray((x - x.min(axis=0)).T)
    bits = [int(top).bit_length() for top in shifted.max(axis=1)]
    owner = np.repeat(np.arange(len(bits)), bits)
    place = np.concatenate([np.arange(b) for b in bits]).astype(np.int64)
    rows = x.shape[0]
    words = np.zeros((len(owner), -(-rows // 64) * 8), dtype=np.uint8)
    for at in range(0, len(owner), 256):  # a bounded number of planes is unpacked at once
        part = slice(at, at + 256)
        words[part, :-(-rows // 8)] = np.packbits((shifted[owner[part]] >> place[part, None]) & 1 != 0, axis=1)
    return words.view(np.uint64), owner, place


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of integer rows, as unbounded integers.

    The cross-products of the shifted columns come from AND-popcounts of their bit planes; the shift
    is then undone.
    """
    rows, dims = x.shape
    words, owner, place = _planes(x)
    low = x.min(axis=0).astype(object)
    wide = int(place.max(initial=0)) + 1
    # Counts times both weights stay inside a long unless values are very far apart.
    kind = np.int64 if 2 * wide + rows.bit_length() < 62 else object
    weight = np.array([1 << int(b) for b in place], dtype=kind)
    starts = np.searchsorted(owner, np.arange(dims + 1))
    products = np.zeros((dims, dims), dtype=object)
    sums = np.zeros(dims, dtype=object)
    for i in range(dims):
        for k in range(starts[i], starts[i + 1]):
            shared = np.bitwise_count(words[k] & words[starts[i]:]).sum(axis=1, dtype=np.int64).astype(kind)
            shared = np.concatenate([[0], np.cumsum(shared * weight[starts[i]:] * weight[k])])
            ends = shared[starts[i:] - starts[i]]
            products[i, i:] += ends[1:] - ends[:-1]
            sums[i] += int(np.bitwise_count(words[k]).sum(dtype=np.int64)) << int(place[k])
    products = np.triu(products) + np.triu(products, 1).T
    shift = np.outer(low, sums)
    return sums + rows * low, products + shift + shift.T + rows * np.outer(low, low)


def _limbs(i: int, j: int, value: int) -> Iterator[tuple[int, int, int, int]]:
    size, sign, limb = abs(value), 1 if value >= 0 else -1, 0
    while size:
        yield i, j, limb, sign * (size & ((1 << LIMB) - 1))
        size, limb = size >> LIMB, limb + 1


def _scatter_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums (``j`` = -1) and cross-products of a task's rows, around the origin, in limbs."""
    sums = products = None
    for batch in batches:
        x = _matrix(batch.column(0)) - ORIGIN
        for at in range(0, len(x), STRETCH):
            s, p = cross_products(x[at:at + STRETCH])
            sums, products = (s, p) if sums is None else (sums + s, products + p)
    if sums is None:
        return
    dims = len(sums)
    rows = [part for i in range(dims) for j, v in [(-1, sums[i]), *((j, products[i, j]) for j in range(i, dims))]
            for part in _limbs(i, j, int(v))]
    yield pa.RecordBatch.from_pydict({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(
        [("i", pa.int32()), ("j", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])})


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n x - S`` around the origin, exact; longs where they suffice."""
    around = x - ORIGIN
    if n * int(np.abs(around).max(initial=0)) + max(map(abs, sums), default=0) < 1 << 62:
        return n * around - np.array(sums, dtype=np.int64)
    return n * around.astype(object) - np.array(sums, dtype=object)


def _projected(centred: np.ndarray, model: Whitening) -> np.ndarray:
    # An integer beyond 53 bits is rounded once here, as is its quotient.
    return (centred.astype(np.float64) / model.n) @ model.vectors / np.sqrt(model.values)


def _identity_task(model: Whitening, sums: list[int]):
    """Count, means and centred cross-products of a task's whitened rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, cross = 0, 0.0, 0.0
        for batch in batches:
            w = _projected(_centred(_matrix(batch.column(0)), model.n, sums), model)
            if not len(w):
                continue
            own = w.mean(axis=0)
            step, both = own - mean, n + len(w)
            cross = cross + (w - own).T @ (w - own) + np.outer(step, step) * (n * len(w) / both)
            mean, n = mean + step * (len(w) / both), both
        if n:
            a, b = np.triu_indices(model.components)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "n": pa.array([n] * len(a), pa.int64()),
                                              "ma": pa.array(mean[a]), "mb": pa.array(mean[b]), "cross": pa.array(cross[a, b])})
    return run


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Learn from each distinct integer vector once."""
    vector = df[column]
    unique = written(df.where(usable(vector)).select(integers(vector).alias("x")).distinct(), "whitening")
    sizes = unique.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
    if common is None:
        return Whitening(0, (), (), np.zeros(0), np.zeros((0, 0)), 0.0)
    n, dims = common["n"], common["dims"]
    listed = unique.where(F.size("x") == dims)
    parts = listed.mapInArrow(_scatter_task, "i int, j int, limb int, value long").groupBy("i", "j", "limb").agg(F.sum("value").alias("value"))
    sums, products = [0] * dims, [[0] * dims for _ in range(dims)]
    for r in parts.toArrow().to_pylist():  # one number per pair of dimensions
        add = r["value"] << (LIMB * r["limb"]) if r["value"] >= 0 else -(-r["value"] << (LIMB * r["limb"]))
        if r["j"] < 0:
            sums[r["i"]] += add
        else:
            products[r["i"]][r["j"]] += add
    scatter = [[n * products[min(i, j)][max(i, j)] - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    covariance = np.array([[v / (n * n) for v in row] for row in scatter])  # a quotient of integers is rounded once
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > max(values.max(), 0.0) * dims * np.finfo(float).eps]
    vectors = vectors[:, order]
    # Either sign is right; the largest entry is made positive.
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0) if len(order) else vectors
    total = sum(scatter[i][i] for i in range(dims)) / (n * n)
    model = Whitening(n, tuple(s + n * ORIGIN for s in sums), tuple(map(tuple, scatter)), values[order], vectors, total)
    if not model.components:
        return model
    sums_of = listed.mapInArrow(_identity_task(model, sums), "a int, b int, n long, ma double, mb double, cross double")
    met = sums_of.groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("cross").alias("cross"), F.sum(F.col("n") * F.col("ma") * F.col("mb")).alias("between"),
                                        F.sum(F.col("n") * F.col("ma")).alias("sa"), F.sum(F.col("n") * F.col("mb")).alias("sb"))
    error = max(abs((r["cross"] + r["between"]) / r["n"] - r["sa"] / r["n"] * r["sb"] / r["n"] - (r["a"] == r["b"]))
                for r in met.toArrow().to_pylist())
    return Whitening(model.n, model.sums, model.scatter, model.values, model.vectors, model.total, error)


def whiten(df: DataFrame, model: Whitening, column: str = "embedding", out: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """The usable rows with their components as an array of doubles and ``deviation`` = sum of (n x - S)^2."""
    sums = [s - model.n * ORIGIN for s in model.sums]

    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def project(x: pa.Array) -> pa.Array:
        rows = len(x)
        centred = _centred(_matrix(x), model.n, sums) if rows else np.zeros((0, len(sums)), dtype=np.int64)
        top = int(np.abs(centred).max(initial=0))
        exact = centred if top * top * len(sums) < 1 << 63 else centred.astype(object)
        size = (exact * exact).sum(axis=1)
        flat = _projected(centred, model)
        lists = pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * model.components, pa.array(flat.ravel()))
        return pa.StructArray.from_arrays([pa.array([int(v) if v < 1 << 63 else None for v in size], pa.int64()), lists],
                                          names=["deviation", "whitened"])

    if not model.n:
        empty = {free_name(df, deviation): F.lit(None).cast("bigint"), free_name(df, out): F.lit(None).cast("array<double>")}
        return df.where(F.lit(False)).withColumns(empty)
    rows = df.where(usable(df[column]) & (F.size(df[column]) == len(sums)))
    name = free_name(df, "_white")
    done = rows.withColumn(name, project(integers(rows[column])))
    return done.withColumns({free_name(df, deviation): F.col(f"{name}.deviation"), free_name(df, out): F.col(f"{name}.whitened")}).drop(name)
