"""Reconstruction over sliding windows of an entity's events, in event-time order.

The window's columns are laid side by side and given to a row-wise reconstruction model:
an autoencoder, or its linear closed form. The linear form needs no stored windows at all;
the autoencoder keeps one float copy of them while it trains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.common import clean_feature
from logwarden.detectors.autoencoder import AutoencoderDetector, AutoencoderModel
from logwarden.detectors.base import RAW, Detector, Model
from logwarden.detectors.linear import LinearDetector, LinearModel
from logwarden.operators.neighbours import sequence_table

_BASES = {"autoencoder": AutoencoderModel, "linear": LinearModel}


class SequenceModel(Model):
    """Rows without a full window get score 0.0 and are never flagged."""

    method = "sequence"

    def __init__(self, base: Model, features: Sequence[str], entity: str, time: str, row_id: str,
                 length: int, assign: str, limit: int | None = None):
        super().__init__(features, base.cut)
        self.base, self.entity, self.time, self.row_id = base, entity, time, row_id
        self.length, self.assign, self.limit = length, assign, limit

    def with_raw(self, df: DataFrame, out: str = RAW, on_null: str = "error") -> DataFrame:
        steps = {f"_x{i}": clean_feature(c, on_null) for i, c in enumerate(self.features)}
        wide, names = sequence_table(df.withColumns(steps), list(steps), self.entity, self.time, self.row_id,
                                     self.length, self.assign, self.limit)
        flat = {flat_name(k, i): F.coalesce(F.col(c), F.lit(0.0))
                for k, step in enumerate(names) for i, c in enumerate(step)}
        scored = self.base.with_raw(wide.withColumns(flat), "_error")
        return scored.select(*df.columns, F.when(F.col("_full"), F.col("_error")).otherwise(0.0).alias(out))

    def params(self) -> dict:
        return {**super().params(), "base": self.base.params(), "entity": self.entity, "time": self.time,
                "row_id": self.row_id, "length": self.length, "assign": self.assign, "limit": self.limit}

    def arrays(self):
        return self.base.arrays()

    @classmethod
    def restore(cls, params, arrays):
        base = _BASES[params["base"]["method"]].restore(params["base"], arrays)
        return cls(base, params["features"], params["entity"], params["time"], params["row_id"],
                   int(params["length"]), params["assign"], params.get("limit"))


def flat_name(step: int, feature: int) -> str:
    return f"_w{step}_{feature}"


class SequenceDetector(Detector):
    def __init__(self, features: Sequence[str] | None = None, contamination: float = 0.1,
                 row_id: str = "row_id", seed: int = 42, on_null: str = "error", entity: str = "user_id",
                 time: str = "ts", sequence_length: int = 10, assign: str = "first",
                 base: str = "autoencoder", limit: int | None = None, **base_settings):
        super().__init__(features, contamination, row_id, seed, on_null)
        if base not in _BASES:
            raise ValueError(f"base must be one of {sorted(_BASES)}")
        self.entity, self.time, self.length, self.assign = entity, time, sequence_length, assign
        self.base, self.limit, self.base_settings = base, limit, base_settings

    def learn(self, df: DataFrame) -> tuple[SequenceModel, DataFrame]:
        raise NotImplementedError("the cut-off of a sequence model comes from its windows; use fit")

    def fit_score(self, df: DataFrame) -> DataFrame:
        return self.fit(df).score(df, on_null=self.on_null)

    def fit(self, df: DataFrame) -> SequenceModel:
        names = [c for c in self.training_features(df) if c not in (self.entity, self.time)]
        table = self.training_table(df, names, self.row_id, self.entity, self.time)
        wide, steps = sequence_table(table, names, self.entity, self.time, self.row_id, self.length,
                                     self.assign, self.limit)
        flat = [F.col(c).alias(flat_name(k, i)) for k, step in enumerate(steps) for i, c in enumerate(step)]
        windows = wide.where("_full").select(self.row_id, *flat)
        if windows.isEmpty():
            raise ValueError("Not enough data to create sequences")
        kind = AutoencoderDetector if self.base == "autoencoder" else LinearDetector
        columns = [c for c in windows.columns if c != self.row_id]
        base = kind(features=columns, contamination=self.contamination, row_id=self.row_id,
                    seed=self.seed, **self.base_settings).fit(windows)
        return SequenceModel(base, names, self.entity, self.time, self.row_id, self.length, self.assign, self.limit)
