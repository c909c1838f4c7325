"""Metric history, comparison tables, audit and privacy exports (CSV, JSON, Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_SCHEMA = "run_id string, metric string, value double"


def append_history(metrics: DataFrame, path: str) -> None:
    """Add long metric rows ``(run_id, metric, value)`` to the history table."""
    metrics.write.mode("append").parquet(path)


def export_history(history: DataFrame, path: str) -> bool:
    """Write the history as CSV; an empty history writes nothing."""
    if history.isEmpty():
        return False
    history.write.mode("overwrite").option("header", True).csv(path)
    return True


def load_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).option("header", True).csv(path)


def export_comparison(comparison: DataFrame, path: str) -> None:
    comparison.write.mode("overwrite").option("header", True).csv(path)


def export_audit(audit: DataFrame, path: str) -> None:
    """CSV has no maps, so the extra data is written as JSON text."""
    flat = audit.withColumn("additional_data", F.to_json("additional_data"))
    # Quotes inside the JSON text are doubled, as other CSV readers expect.
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_privacy_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)
