"""Sketches per day that can be stored and merged: approximate quantiles and distinct counts over any span of days.

The exact twins (``operators.quantiles``, ``profile.distinct_counts``) read all rows of the span; these read one
small row per day. A KLL sketch with parameter ``k`` gives a quantile whose rank is off by at most ``rank_error(k)``
of the rows with 99 % confidence, merged or not; a HyperLogLog sketch with ``2 ** lg_k`` registers has a relative
standard error of ``distinct_error(lg_k)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KLL_K, HLL_LG_K = 400, 12


def rank_error(k: int = KLL_K) -> float:
    """Normalised rank error of one quantile (the published fit 2.296 / k ** 0.9021)."""
    return 2.296 / k**0.9021


def distinct_error(lg_k: int = HLL_LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def daily_sketches(df: DataFrame, time: str, values: list[str] = (), distinct: list[str] = (), k: int = KLL_K, lg_k: int = HLL_LG_K) -> DataFrame:
    """``day, rows`` with a quantile sketch ``q_<column>`` and a distinct sketch ``d_<column>`` each; null and NaN are left out."""
    quantiles = [F.kll_sketch_agg_double(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), k).alias(f"q_{c}") for c in values]
    counts = [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"d_{c}") for c in distinct]
    return df.groupBy(F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("rows"), *quantiles, *counts)


def merged(sketches: DataFrame, values: list[str] = (), distinct: list[str] = ()) -> DataFrame:
    """One row for all days given: ``days, rows`` and the merged sketches."""
    return sketches.agg(F.count(F.lit(1)).alias("days"), F.sum("rows").alias("rows"),
                        *[F.kll_merge_agg_double(f"q_{c}").alias(f"q_{c}") for c in values],
                        *[F.hll_union_agg(f"d_{c}").alias(f"d_{c}") for c in distinct])


def sketch_cut(sketches: DataFrame, value: str, contamination: float) -> float:
    """The contamination cut-off of all days given, from their sketches alone."""
    if not 0.0 < contamination < 1.0:
        raise ValueError("contamination must lie between 0 and 1")
    row = merged(sketches, [value]).select(F.kll_sketch_get_quantile_double(f"q_{value}", F.lit(1.0 - contamination)).alias("cut")).first()
    return row["cut"]


def sketch_distinct(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """``column, estimate`` of the distinct values of all days given."""
    row = merged(sketches, distinct=columns)
    return row.select(*[F.hll_sketch_estimate(f"d_{c}").alias(c) for c in columns]).unpivot([], list(columns), "column", "estimate")
