"""The detector contract. A model exists only once it is fitted, so it is always usable."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import assert_unique, clean_feature, drop_missing, feature_columns, kept, require_columns, written
from logwarden.operators.quantiles import contamination_cut

RAW = "_raw"


def check_contamination(value: float) -> None:
    if not 0.0 < value < 1.0:
        raise ValueError("contamination must lie between 0 and 1")


class Model(ABC):
    """Scores rows; a row is flagged when its raw score lies strictly above ``cut``."""

    method: str = ""
    #: the reported score is ``raw - cut`` instead of ``raw``
    reports_margin = False

    def __init__(self, features: Sequence[str], cut: float | None):
        self.features = tuple(features)
        self.cut = cut

    @abstractmethod
    def with_raw(self, df: DataFrame, out: str = RAW, on_null: str = "error") -> DataFrame:
        """Add the raw score column; higher is more anomalous."""

    def score(self, df: DataFrame, score: str = "score", pred: str = "pred",
              on_null: str = "error") -> DataFrame:
        """Add the reported score and the 0/1 flag."""
        require_columns(df, self.features)
        if on_null == "drop":
            df = drop_missing(df, self.features)
        return self.flagged(self.with_raw(df, RAW, on_null), score, pred).drop(RAW)

    def flagged(self, raw_scored: DataFrame, score: str = "score", pred: str = "pred") -> DataFrame:
        """The reported score and the flag of rows that have their raw score."""
        raw = F.col(RAW)
        shown = raw - F.lit(self.cut) if self.reports_margin else raw
        return raw_scored.withColumns({score: shown, pred: (raw > F.lit(self.cut)).cast("int")})

    def inputs(self, on_null: str = "error") -> list[Column]:
        return [clean_feature(c, on_null) for c in self.features]

    # What the model store writes and reads back.
    def params(self) -> dict:
        return {"method": self.method, "features": list(self.features), "cut": self.cut}

    def arrays(self) -> dict[str, np.ndarray]:
        return {}

    @classmethod
    @abstractmethod
    def restore(cls, params: dict, arrays: dict[str, np.ndarray]) -> Model:
        """Rebuild the model from what ``params`` and ``arrays`` gave."""


class Detector(ABC):
    """Settings of a method; ``fit`` gives a model."""

    def __init__(self, features: Sequence[str] | None = None, contamination: float = 0.1,
                 row_id: str = "row_id", seed: int = 42, on_null: str = "error"):
        check_contamination(contamination)
        if on_null not in ("error", "drop", "zero"):
            raise ValueError("on_null must be 'error', 'drop' or 'zero'")
        self.features, self.contamination = features, contamination
        self.row_id, self.seed, self.on_null = row_id, seed, on_null

    @abstractmethod
    def learn(self, df: DataFrame) -> tuple[Model, DataFrame]:
        """Learn from every row of the table; gives the model, still without a cut-off, and its training rows."""

    def fit(self, df: DataFrame) -> Model:
        return self.set_cut(*self.learn(df))

    def fit_score(self, df: DataFrame) -> DataFrame:
        """``fit(df).score(df)``, with every row scored once: the scored table is written to the shared folder."""
        model, _ = self.learn(df)
        if self.on_null == "drop":
            df = drop_missing(df, model.features)
        scored = written(model.with_raw(df, RAW, self.on_null), "scored")
        model.cut = contamination_cut(scored, RAW, self.contamination)
        return model.flagged(scored).drop(RAW)

    def training_features(self, df: DataFrame) -> list[str]:
        return [c for c in feature_columns(df, self.features) if c != self.row_id]

    def training_table(self, df: DataFrame, names: Sequence[str], *keys: str) -> DataFrame:
        """Keys and clean features only, so that nothing else is read from the source; row ids must be unique."""
        if not names:
            raise ValueError("no numeric feature to learn from")
        if self.row_id in keys:
            assert_unique(df, self.row_id)
        if self.on_null == "drop":
            df = drop_missing(df, names)
        return df.select(*keys, *[clean_feature(c, self.on_null).alias(c) for c in names])

    def set_cut(self, model: Model, table: DataFrame) -> Model:
        """Put the cut-off at the contamination quantile of the training scores.

        The search takes several passes, so the one score column is kept on disk: whatever made
        the features (a window, a join, a Python worker) runs once for all of them.
        """
        scores = kept(model.with_raw(table).select(RAW))
        try:
            model.cut = contamination_cut(scores, RAW, self.contamination)
        finally:
            scores.unpersist()
        return model
