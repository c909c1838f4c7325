"""Labelled anomalies put into a host log table, the same rows for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import portable_hash, require_columns
from logwarden.functions.features import PERCENT_METRICS, cap_percent, derive_features
from logwarden.operators.quantiles import ranked_values

# The five patterns and the factor each applies per column.
PATTERNS = {
    "cpu_spike": {"cpu_usage": 3.0, "memory_usage": 1.5},
    "memory_leak": {"memory_usage": 2.5, "cpu_usage": 1.2},
    "network_flood": {"bytes_sent": 5.0, "bytes_received": 5.0, "active_connections": 4.0},
    "process_explosion": {"process_count": 3.0, "cpu_usage": 2.0},
    "disk_full": {"disk_usage": 2.0, "cpu_usage": 1.3},
}

LABEL, PATTERN, HASH = "anomaly_label", "pattern", "_hash"


def choose_exactly(df: DataFrame, share: float, row_id: str, seed: int) -> Column:
    """True for exactly ``int(rows * share)`` rows: those with the smallest (hash, row id).

    The cut hash is found by counting, so nothing is sorted or gathered. Rows that share the
    cut hash, a handful at most, are separated by row id.
    """
    if not 0.0 <= share <= 1.0:
        raise ValueError("the share must lie between 0 and 1")
    hashed = df.select(F.col(row_id).alias("id"), portable_hash(row_id, seed=seed).alias("h"))
    rows, found = ranked_values(hashed, "h", lambda n: [int(n * share) - 1])
    wanted = int(rows * share)
    if wanted == 0:
        return F.lit(False)
    cut = int(found[wanted - 1])
    own = portable_hash(row_id, seed=seed)
    near = hashed.agg(F.count_if(F.col("h") < cut).alias("below"), F.count_if(F.col("h") == cut).alias("equal"),
                      F.max(F.when(F.col("h") == cut, F.col("id"))).alias("last")).first()
    tied, last = wanted - near["below"], near["last"]
    if tied < near["equal"]:
        last = hashed.where(F.col("h") == cut).orderBy("id").limit(tied).agg(F.max("id")).first()[0]
    return (own < F.lit(cut)) | ((own == F.lit(cut)) & (F.col(row_id) <= F.lit(last)))


def pattern_of(row_id: str, seed: int) -> Column:
    names = F.array(*[F.lit(p) for p in PATTERNS])
    return F.element_at(names, (portable_hash(row_id, seed=seed + 1) % len(PATTERNS) + 1).cast("int"))


def inject_anomalies(df: DataFrame, share: float = 0.1, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """Multiply the metrics of the chosen rows by their pattern and label them 1.

    Percentages are capped at 100 on injected rows only; the derived columns are computed
    from the changed values. ``pattern`` is null on normal rows.
    """
    touched = sorted({c for factors in PATTERNS.values() for c in factors})
    require_columns(df, [row_id, *touched])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    chosen = choose_exactly(df, share, row_id, seed)
    tagged = df.withColumn(LABEL, chosen.cast("int")).withColumn(
        PATTERN, F.when(F.col(LABEL) == 1, pattern_of(row_id, seed)))
    changes = {}
    for column in touched:
        factor = F.lit(1.0)
        for name, factors in PATTERNS.items():
            if column in factors:
                factor = F.when(F.col(PATTERN) == name, F.lit(factors[column])).otherwise(factor)
        moved = F.col(column) * factor
        if column in PERCENT_METRICS:
            moved = cap_percent(moved)
        changes[column] = F.when(F.col(LABEL) == 1, moved.cast(kinds[column])).otherwise(F.col(column))
    return derive_features(tagged.withColumns(changes))
