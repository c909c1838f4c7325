"""Joining labels and scores that live in separate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import require_columns


def _counted(side: DataFrame, key: str, what: str) -> DataFrame:
    """``side`` with a mark per row; a key that comes twice is an error, raised before any join."""
    many = F.count(F.lit(1)).over(Window.partitionBy(key))
    stop = F.raise_error(F.concat(F.lit(f"{what}: {key} has duplicate values: "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return side.withColumn(f"_{what}", F.when(many > 1, stop.cast("int")).otherwise(F.lit(1)))


def attach_scores(labels: DataFrame, scores: DataFrame, key: str = "row_id", complete: bool = True) -> DataFrame:
    """Labels with their scores, one to one.

    Keys must be unique on both sides, and with ``complete`` every label needs a score; a breach is
    an error of the action that reads the result. Each side is shuffled once, by the key, for the
    check and the join together.
    """
    require_columns(labels, [key])
    require_columns(scores, [key])
    both = _counted(labels, key, "labels").join(_counted(scores, key, "scores"), key, "left")
    if complete:
        missing = F.raise_error(F.concat(F.lit(f"no score for {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        both = both.withColumn("_scores", F.when(F.col("_scores").isNull(), missing.cast("int")).otherwise(F.col("_scores")))
    # The marks are compared, not only dropped, so that the checks are part of the plan.
    return both.where((F.col("_labels") == 1) & (F.col("_scores") == 1)).drop("_labels", "_scores")
