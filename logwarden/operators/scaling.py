"""Standardisation with population deviation (one aggregate, then literals)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Scale:
    """Mean and population deviation per feature: a few numbers, kept on the driver."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    def scaled(self, values: Sequence[Column]) -> list[Column]:
        """(x - mean) / std, with a zero deviation replaced by one."""
        return [(v - F.lit(m)) / F.lit(s if s > 0 else 1.0)
                for v, m, s in zip(values, self.means, self.stds, strict=True)]

    def rounded(self, digits: int = 10) -> Scale:
        """The same scale to so many significant digits, so that it does not depend on the order of the rows."""
        return Scale(self.features, *[tuple(float(f"{x:.{digits}g}") for x in part) for part in (self.means, self.stds)])


def fit_scale(df: DataFrame, features: Sequence[str]) -> Scale:
    parts = [f(c).alias(f"{n}{i}") for i, c in enumerate(features)
             for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*parts).first()
    if any(row[f"m{i}"] is None for i in range(len(features))):
        raise ValueError("cannot scale an empty table")
    return Scale(tuple(features),
                 tuple(float(row[f"m{i}"]) for i in range(len(features))),
                 tuple(float(row[f"s{i}"]) for i in range(len(features))))


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """Absolute distance from a baseline in deviations, safe for a zero deviation."""
    return F.abs((value - mean) / (std + F.lit(1e-8)))
