"""Derived host metrics, bounds, flags and tags as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import require_columns

# Host metrics that may not be negative, and those that are percentages.
HOST_METRICS = ("cpu_usage", "memory_usage", "disk_usage", "bytes_sent", "bytes_received",
                "active_connections", "process_count")
PERCENT_METRICS = ("cpu_usage", "memory_usage", "disk_usage")


def cpu_memory_ratio(cpu: str = "cpu_usage", memory: str = "memory_usage") -> Column:
    return F.col(cpu) / (F.col(memory) + F.lit(1e-6))


def network_activity(sent: str = "bytes_sent", received: str = "bytes_received") -> Column:
    return F.col(sent) + F.col(received)


def resource_pressure(cpu: str = "cpu_usage", memory: str = "memory_usage", disk: str = "disk_usage") -> Column:
    return (F.col(cpu) + F.col(memory) + F.col(disk)) / F.lit(3.0)


def derive_features(df: DataFrame) -> DataFrame:
    """Add the three derived columns of a host log table."""
    require_columns(df, PERCENT_METRICS + ("bytes_sent", "bytes_received"))
    return df.withColumns({
        "cpu_memory_ratio": cpu_memory_ratio(),
        "network_activity": network_activity(),
        "resource_pressure": resource_pressure(),
    })


def floor_at_zero(df: DataFrame, columns: Sequence[str] = HOST_METRICS) -> DataFrame:
    """Negative values become zero; null and NaN stay what they are."""
    # The zero is cast so that the column keeps its type.
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.when(F.col(c) < 0, F.lit(0).cast(kinds[c])).otherwise(F.col(c)) for c in columns})


def cap_percent(column: Column) -> Column:
    """At most 100; null and NaN stay what they are."""
    value = column.cast("double")
    return F.when((value > 100) & ~F.isnan(value), F.lit(100.0)).otherwise(value)


def cap_percentages(df: DataFrame, columns: Sequence[str] = PERCENT_METRICS) -> DataFrame:
    return df.withColumns({c: cap_percent(F.col(c)) for c in columns})


def above(score: str, cut: float) -> Column:
    """1 where the score lies strictly above the cut."""
    return (F.col(score) > F.lit(cut)).cast("int")


def at_least(score: str, threshold: float) -> Column:
    return (F.col(score) >= F.lit(threshold)).cast("int")


def outcome_tag(label: str = "label", pred: str = "pred") -> Column:
    """The cell of the confusion matrix; a label or flag other than 0 and 1 is an error."""
    actual, flagged = F.col(label) == 1, F.col(pred) == 1
    wrong = F.raise_error(F.lit("labels and flags must be 0 or 1")).cast("string")
    return (F.when(~(is_class(label) & is_class(pred)), wrong)
            .when(actual & flagged, "TP").when(flagged, "FP").when(actual, "FN").otherwise("TN"))


def is_class(column: str) -> Column:
    """True for 0 and 1 alone; never null."""
    return F.coalesce(F.col(column).isin(0, 1), F.lit(False))


def class_of(column: str) -> Column:
    """A 0/1 label as int; anything else is an error."""
    wrong = F.raise_error(F.concat(F.lit(f"{column} is not 0 or 1: "), F.coalesce(F.col(column).cast("string"), F.lit("null"))))
    return F.when(is_class(column), F.col(column).cast("int")).otherwise(wrong.cast("int"))


def z_flag(z_score: str = "z_score", limit: float = 2.0) -> Column:
    return F.when(F.col(z_score) > limit, "high").otherwise("normal")


def micros(time: str) -> Column:
    """Microseconds since the epoch for either timestamp type."""
    return F.unix_micros(F.col(time).cast("timestamp"))


def hours_since(df: DataFrame, time: str, out: str = "hours") -> DataFrame:
    """Hours since the first event of the table (one extra column-pruned pass for the minimum)."""
    start = df.agg(F.min(micros(time))).first()[0]
    return df.withColumn(out, (micros(time) - F.lit(start)) / F.lit(3.6e9))


def to_long(df: DataFrame, keys: Sequence[str], features: Sequence[str],
            name: str = "feature", value: str = "value") -> DataFrame:
    """Wide measurements to ``(keys, feature, value)`` rows."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features])
    return wide.unpivot(list(keys), list(features), name, value)
