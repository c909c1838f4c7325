"""Isolation forest (Liu, Ting and Zhou 2008).

Each tree needs only a few hundred rows. A hash deals every row to one tree, or to as many as a small
table needs; of its rows a tree keeps those with the smallest hashes of its own. The count of rows
tells how small these must be, so all others go before the shuffle. Trees grow where their rows
are, in parallel, and only the finished forest comes to the driver; it is broadcast for scoring in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import portable_hash, portable_number, written
from logwarden.detectors.base import RAW, Detector, Model

TREE_SCHEMA = "tree int, feature array<int>, threshold array<double>, path array<double>, cover array<int>"
_EULER = 0.5772156649


def candidates(max_samples: int) -> int:
    """Rows a tree may expect to choose from, so many that fewer than it needs are out of the question."""
    return 2 * max_samples + 40


def copies(rows: int, n_trees: int, max_samples: int) -> int:
    """To how many trees a row is dealt; to one, so that no two trees share a row, as soon as the table allows it."""
    return min(n_trees, max(1, -(-n_trees * candidates(max_samples) // max(rows, 1))))


def average_path(size: float) -> float:
    """Mean path length of an unsuccessful search among ``size`` rows."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (math.log(size - 1.0) + _EULER) - 2.0 * (size - 1.0) / size


def grow_tree(rows: np.ndarray, tree: int, seed: int, depth: int):
    """One random tree as a full binary tree of fixed depth.

    What a node draws depends on (tree, node, seed) alone, so any engine grows the same tree.

    Splits sit in level order; a branch that ends early sends all its rows left down to the
    last level, where its path length is stored. Scoring then needs no leaf test.
    """
    feature = np.zeros(2**depth - 1, dtype=np.int32)
    threshold = np.full(2**depth - 1, np.inf)
    path = np.zeros(2**depth)
    todo = [(0, 0, rows)]
    while todo:
        node, level, part = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        varied = np.flatnonzero(high > low)
        if level == depth or len(part) <= 1 or not len(varied):
            bottom = (node + 1) * 2 ** (depth - level) - 2**depth
            path[bottom] = level + average_path(len(part))
            continue
        pick = varied[portable_number(tree, node, seed=seed) % len(varied)]
        share = portable_number(tree, node, seed=seed + 1) / 2.0**52
        # strictly below the upper end, so neither side is empty
        at = min(low[pick] + share * (high[pick] - low[pick]), np.nextafter(high[pick], low[pick]))
        left = part[:, pick] <= at
        feature[node], threshold[node] = pick, at
        todo.append((2 * node + 1, level + 1, part[left]))
        todo.append((2 * node + 2, level + 1, part[~left]))
    return feature, threshold, path


def mean_path(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Average path length over all trees for each row of ``x``."""
    depth = int(math.log2(path.shape[1]))
    total = np.zeros(len(x))
    at = np.arange(len(x))
    for tree in range(len(path)):
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (x[at, feature[tree][node]] > threshold[tree][node])
        total += path[tree][node - (2**depth - 1)]
    return total / len(path)


def node_covers(rows: np.ndarray, feature: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """How many rows pass each node of a grown tree, in level order."""
    cover = np.zeros(2 * len(threshold) + 1, dtype=np.int32)
    node = np.zeros(len(rows), dtype=np.int64)
    cover[0] = len(rows)
    for _ in range(int(math.log2(len(threshold) + 1))):
        node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > threshold[node])
        np.add.at(cover, node, 1)
    return cover


def tree_contributions(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, path: np.ndarray, cover: np.ndarray) -> np.ndarray:
    """Exact Shapley values of the path length in one tree, for each row and feature.

    A tree's value for a set of known features follows the row at splits on them, and weighs both sides by
    their rows at all others (Lundberg et al. 2020). That makes every leaf a product with one factor per feature,
    ``o`` (the row takes all of its turns) where it is known and ``z`` (share of the rows that do) where it is
    not; the Shapley weights of such a product are an integral over [0, 1] of a polynomial, which Gauss-Legendre
    nodes give exactly. So the work is linear in leaves and features, without a loop over feature sets.
    """
    depth, features = int(math.log2(len(path))), x.shape[1]
    leaves = np.flatnonzero(cover[len(threshold):]) + len(threshold)
    known, share = np.ones((len(x), len(leaves), features)), np.ones((len(leaves), features))
    node, each = leaves.copy(), np.arange(len(leaves))
    for _ in range(depth):
        above, right = (node - 1) // 2, node % 2 == 0
        split = feature[above]
        share[each, split] *= cover[node] / cover[above]
        known[:, each, split] *= (x[:, split] > threshold[above]) == right
        node = above
    points, weights = np.polynomial.legendre.leggauss(min(depth, features) // 2 + 1)
    total = np.zeros((len(x), features))
    for at, weight in zip((points + 1) / 2, weights / 2, strict=True):
        factor = share * (1 - at) + known * at  # above zero, as every leaf has rows
        total += weight * ((known - share) / factor * (factor.prod(axis=2) * path[leaves - len(threshold)])[:, :, None]).sum(axis=1)
    return total


class ForestModel(Model):
    method = "isolation_forest"
    reports_margin = True

    def __init__(self, features: Sequence[str], feature: np.ndarray, threshold: np.ndarray,
                 path: np.ndarray, sample: int, cut: float | None = None, cover: np.ndarray | None = None):
        super().__init__(features, cut)
        self.feature, self.threshold, self.path, self.sample, self.cover = feature, threshold, path, sample, cover

    def with_raw(self, df: DataFrame, out: str = RAW, on_null: str = "error") -> DataFrame:
        forest = df.sparkSession.sparkContext.broadcast((self.feature, self.threshold, self.path))
        norm = average_path(self.sample) or 1.0

        @F.pandas_udf("double")
        def isolation(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
            return pd.Series(np.exp2(-mean_path(x, *forest.value) / norm))

        return df.withColumn(out, isolation(*self.inputs(on_null)))

    def with_contributions(self, df: DataFrame, out: str, rows: int = 64) -> DataFrame:
        """Add what each feature adds to log2 of the score, an array in the order of the features."""
        if self.cover is None:
            raise ValueError("this forest was stored without the row counts of its nodes; fit it again")
        forest = df.sparkSession.sparkContext.broadcast((self.feature, self.threshold, self.path, self.cover))
        norm = average_path(self.sample) or 1.0

        @F.pandas_udf("array<double>")
        def contributions(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
            parts = [sum(tree_contributions(x[at:at + rows], *tree) for tree in zip(*forest.value, strict=True))
                     for at in range(0, len(x), rows)]
            # A longer path means a more ordinary row.
            return pd.Series(list(np.concatenate(parts) / (-norm * len(forest.value[0])))) if parts else pd.Series([], dtype=object)

        return df.withColumn(out, contributions(*self.inputs()))

    def params(self) -> dict:
        return {**super().params(), "sample": self.sample}

    def arrays(self):
        cover = {} if self.cover is None else {"cover": self.cover}
        return {"feature": self.feature, "threshold": self.threshold, "path": self.path, **cover}

    @classmethod
    def restore(cls, params, arrays):
        return cls(params["features"], arrays["feature"].astype(np.int32), arrays["threshold"],
                   arrays["path"], int(params["sample"]), params["cut"], arrays["cover"].astype(np.int32) if "cover" in arrays else None)


class ForestDetector(Detector):
    def __init__(self, features: Sequence[str] | None = None, contamination: float = 0.1,
                 row_id: str = "row_id", seed: int = 42, on_null: str = "error",
                 n_trees: int = 100, max_samples: int = 256):
        super().__init__(features, contamination, row_id, seed, on_null)
        if n_trees < 1 or max_samples < 2:
            raise ValueError("the forest needs a tree and at least two rows per tree")
        self.n_trees, self.max_samples = n_trees, max_samples

    def learn(self, df: DataFrame) -> tuple[ForestModel, DataFrame]:
        names = self.training_features(df)
        table = self.training_table(df, names, self.row_id)
        n = table.count()
        if not n:
            raise ValueError("cannot fit an empty table")
        sample = min(self.max_samples, n)
        depth = max(1, math.ceil(math.log2(max(sample, 2))))
        seed, columns = self.seed, list(names)

        def grow(rows: pd.DataFrame) -> pd.DataFrame:
            tree = int(rows["_tree"].iloc[0])
            x = rows[columns].to_numpy(dtype=np.float64)
            grown = grow_tree(x, tree, seed, depth)
            cover = node_covers(x, *grown[:2])
            return pd.DataFrame([[tree, *[p.tolist() for p in (*grown, cover)]]], columns=["tree", "feature", "threshold", "path", "cover"])

        # At most n_trees rows come to the driver.
        trees = self.samples(table, n, sample).groupBy("_tree").applyInPandas(grow, TREE_SCHEMA).orderBy("tree").collect()
        return ForestModel(names, np.array([t["feature"] for t in trees], dtype=np.int32),
                           np.array([t["threshold"] for t in trees]),
                           np.array([t["path"] for t in trees]), sample, None, np.array([t["cover"] for t in trees], dtype=np.int32)), table

    def samples(self, table: DataFrame, rows: int, sample: int) -> DataFrame:
        """``_tree``, ``_rank`` and the columns of the ``sample`` rows of every tree with its smallest ranks."""
        deal = F.sequence(F.lit(0), F.lit(copies(rows, self.n_trees, sample) - 1))
        tree = F.pmod(portable_hash(self.row_id, seed=self.seed) + F.col("_copy"), F.lit(self.n_trees)).cast("int")
        dealt = table.withColumn("_copy", F.explode(deal)).withColumn("_tree", tree).drop("_copy")
        ranked = dealt.withColumn("_rank", portable_hash(self.row_id, "_tree", seed=self.seed + 1))
        pool = rows * copies(rows, self.n_trees, sample) / self.n_trees  # rows dealt to a tree, on average
        bound = min(1.0, candidates(sample) / pool)
        while True:
            drawn = written(ranked.where(F.col("_rank") < F.lit(int(bound * 2**52))), "tree-samples")
            sizes = drawn.groupBy("_tree").count().agg(F.count(F.lit(1)).alias("trees"), F.min("count").alias("least")).first()
            if bound >= 1.0 or (sizes["trees"] == self.n_trees and sizes["least"] >= sample):
                break
            bound = min(1.0, 4 * bound)  # next to never: some tree found too few rows under the bound
        place = F.row_number().over(Window.partitionBy("_tree").orderBy("_rank", self.row_id))
        return drawn.withColumn("_place", place).where(F.col("_place") <= sample).drop("_place")
