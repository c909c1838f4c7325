"""Standardised deviation: the largest absolute z-score of a row. Column expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.detectors.base import RAW, Detector, Model
from logwarden.operators.scaling import Scale, fit_scale


class DeviationModel(Model):
    method = "deviation"

    def __init__(self, scale: Scale, cut: float | None = None):
        super().__init__(scale.features, cut)
        self.scale = scale

    def with_raw(self, df: DataFrame, out: str = RAW, on_null: str = "error") -> DataFrame:
        sizes = [F.abs(z) for z in self.scale.scaled(self.inputs(on_null))]
        return df.withColumn(out, F.greatest(*sizes) if len(sizes) > 1 else sizes[0])

    def params(self) -> dict:
        return {**super().params(), "means": list(self.scale.means), "stds": list(self.scale.stds)}

    @classmethod
    def restore(cls, params, arrays):
        return cls(Scale(tuple(params["features"]), tuple(params["means"]), tuple(params["stds"])), params["cut"])


class DeviationDetector(Detector):
    def learn(self, df: DataFrame) -> tuple[DeviationModel, DataFrame]:
        names = self.training_features(df)
        table = self.training_table(df, names)
        return DeviationModel(fit_scale(table, names)), table
