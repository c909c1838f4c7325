"""Linear reconstruction: principal components from one covariance pass, closed form.

A linear autoencoder learns the same subspace (Baldi and Hornik 1989). Only the d x d
covariance reaches the driver; projection and error are column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.detectors.base import RAW, Detector, Model
from logwarden.operators.scaling import Scale, fit_scale

SQL_COVARIANCE_COLUMNS = 16  # wider tables use the vector job


def covariance(df: DataFrame, names: Sequence[str], scale: Scale) -> np.ndarray:
    """Population covariance of the columns (d x d, so small enough for the driver)."""
    d = len(names)
    out = np.zeros((d, d))
    if d <= SQL_COVARIANCE_COLUMNS:
        pairs = [(i, j) for i in range(d) for j in range(i, d)]
        row = df.agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        for i, j in pairs:
            out[i, j] = out[j, i] = row[f"c{i}_{j}"]
        return out
    vectors = VectorAssembler(inputCols=list(names), outputCol="_v").transform(df.select(*names))
    corr = Correlation.corr(vectors, "_v").first()[0].toArray()
    stds = np.array(scale.stds)
    return np.nan_to_num(corr, nan=0.0) * np.outer(stds, stds)


def principal_axes(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k axes (rows) and their share of the variance; largest loading is positive."""
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:k]
    axes = vectors[:, order].T
    lead = axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)]
    total = values.sum()
    share = values[order] / total if total > 0 else np.zeros(len(order))
    return axes * np.where(lead < 0, -1.0, 1.0)[:, None], share


def _sum(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def projection(values: Sequence[Column], axis: np.ndarray) -> Column:
    return _sum([v * F.lit(float(w)) for v, w in zip(values, axis, strict=True)])


def pca_points(df: DataFrame, features: Sequence[str], k: int = 2) -> DataFrame:
    """Add ``pc1..pck`` of the centred raw features and each one's variance share."""
    table = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    scale = fit_scale(table, features)
    axes, share = principal_axes(covariance(table, features, scale), k)
    centred = [F.col(c).cast("double") - F.lit(m) for c, m in zip(features, scale.means, strict=True)]
    added = {f"pc{i + 1}": projection(centred, axis) for i, axis in enumerate(axes)}
    added |= {f"explained_{i + 1}": F.lit(float(s)) for i, s in enumerate(share)}
    return df.withColumns(added)


class LinearModel(Model):
    method = "linear"

    def __init__(self, scale: Scale, axes: np.ndarray, cut: float | None = None):
        super().__init__(scale.features, cut)
        self.scale, self.axes = scale, axes

    def with_raw(self, df: DataFrame, out: str = RAW, on_null: str = "error") -> DataFrame:
        # The axes are orthonormal, so the squared error is the length left after projection.
        z = self.scale.scaled(self.inputs(on_null))
        size = _sum([v * v for v in z])
        explained = _sum([F.pow(projection(z, axis), F.lit(2.0)) for axis in self.axes])
        return df.withColumn(out, F.greatest(size - explained, F.lit(0.0)) / F.lit(float(len(z))))

    def params(self) -> dict:
        return {**super().params(), "means": list(self.scale.means), "stds": list(self.scale.stds)}

    def arrays(self):
        return {"axes": self.axes}

    @classmethod
    def restore(cls, params, arrays):
        scale = Scale(tuple(params["features"]), tuple(params["means"]), tuple(params["stds"]))
        return cls(scale, arrays["axes"], params["cut"])


class LinearDetector(Detector):
    def __init__(self, features: Sequence[str] | None = None, contamination: float = 0.1,
                 row_id: str = "row_id", seed: int = 42, on_null: str = "error",
                 components: int | None = None):
        super().__init__(features, contamination, row_id, seed, on_null)
        self.components = components

    def learn(self, df: DataFrame) -> tuple[LinearModel, DataFrame]:
        names = self.training_features(df)
        table = self.training_table(df, names)
        scale = fit_scale(table, names)
        cov = covariance(table, names, scale)
        spread = np.array([s if s > 0 else 1.0 for s in scale.stds])
        k = self.components or max(1, len(names) // 2)
        axes, _ = principal_axes(cov / np.outer(spread, spread), min(k, len(names)))
        return LinearModel(scale, axes), table
