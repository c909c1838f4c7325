"""Checks of tables and texts; findings come as rows ``(severity, check, column, n, detail)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import numeric_columns
from logwarden.functions.pii import has_pii, redact
from logwarden.operators.quantiles import exact_quantiles

# The columns that every host log table must have.
REQUIRED_COLUMNS = ("cpu_usage", "memory_usage")
REQUIRED_PARTS = ("data", "labels")
FINDING_SCHEMA = "severity string, check string, column string, n bigint, detail string"


def is_missing(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    empty = F.col(column).isNull()
    return empty | F.isnan(column) if kind in ("double", "float") else empty


def missing_cells(df: DataFrame) -> DataFrame:
    """One row with the number of null or NaN cells of the whole table."""
    counts = [F.count_if(is_missing(df, c)) for c in df.columns]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return df.agg(total.alias("missing"))


def iqr_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float, float, float]]:
    """``q1, q3, low, high`` per column that has values."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.75] for c in columns})
    return {c: (a, b, a - 1.5 * (b - a), b + 1.5 * (b - a)) for c, (a, b) in quartiles.items() if a is not None}


def outside(column: str, low: float, high: float) -> Column:
    value = F.col(column).cast("double")
    return ~F.isnan(value) & ((value < F.lit(low)) | (value > F.lit(high)))


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Quartiles, bounds and number of rows outside them, one row per column."""
    columns = list(columns or numeric_columns(df))
    bounds = iqr_bounds(df, columns)
    if not bounds:
        return df.sparkSession.createDataFrame([], "column string, q1 double, q3 double, low double, high double, outliers bigint")
    counts = df.agg(*[F.count_if(outside(c, low, high)).alias(f"n_{c}") for c, (_, _, low, high) in bounds.items()])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(a).alias("q1"), F.lit(b).alias("q3"), F.lit(low).alias("low"),
                     F.lit(high).alias("high"), F.col(f"n_{c}").alias("outliers"))
            for c, (a, b, low, high) in bounds.items()]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def numeric_checks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN, infinite and negative values per numeric column."""
    columns = list(columns or numeric_columns(df))
    tallies = []
    for c in columns:
        value = F.col(c).cast("double")
        tallies += [F.count_if(F.isnan(value)).alias(f"a_{c}"),
                    F.count_if(F.abs(value) == F.lit(float("inf"))).alias(f"b_{c}"),
                    F.count_if(value < 0).alias(f"c_{c}")]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"a_{c}").alias("nan"), F.col(f"b_{c}").alias("infinite"),
                     F.col(f"c_{c}").alias("negative")) for c in columns]
    return df.agg(*tallies).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def validate_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Warnings for columns with NaN, infinite or negative values."""
    kinds = {"nan": "values are NaN", "infinite": "values are infinite", "negative": "values are negative"}
    checks = numeric_checks(df, columns)
    rows = F.array(*[F.struct(F.lit("warning").alias("severity"), F.lit(k).alias("check"), F.col("column"),
                              F.col(k).alias("n"), F.lit(text).alias("detail")) for k, text in kinds.items()])
    return checks.select(F.explode(rows).alias("r")).select("r.*").where("n > 0")


def validate_table(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS,
                   numeric: Sequence[str] | None = None) -> DataFrame:
    """Findings of a log table: missing columns are errors, the rest are warnings."""
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    columns = list(numeric_columns(df) if numeric is None else numeric)
    known = [("error", "required_column", c, 1, f"Missing required column: {c}") for c in missing]
    if not columns:
        known.append(("warning", "numeric_columns", None, 0, "No numeric columns found"))
    findings = spark.createDataFrame(known, FINDING_SCHEMA)
    nulls = missing_cells(df).where("missing > 0").select(
        F.lit("warning").alias("severity"), F.lit("missing_values").alias("check"),
        F.lit(None).cast("string").alias("column"), F.col("missing").alias("n"),
        F.concat(F.lit("Found "), F.col("missing"), F.lit(" missing values")).alias("detail"))
    findings = findings.unionByName(nulls)
    if columns:
        findings = findings.unionByName(iqr_outliers(df, columns).where("outliers > 0").select(
            F.lit("warning").alias("severity"), F.lit("outliers").alias("check"), "column",
            F.col("outliers").alias("n"),
            F.concat(F.lit("Found "), F.col("outliers"), F.lit(" outliers in column "), F.col("column")).alias("detail")))
    return findings


def is_valid(findings: DataFrame) -> bool:
    return findings.where("severity = 'error'").isEmpty()


def validate_parts(parts: dict[str, DataFrame]) -> list[str]:
    """The required parts of a dataset that are not there."""
    return [k for k in REQUIRED_PARTS if k not in parts]


def label_completeness(data: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """One row: rows of the table, labelled rows, rows without label, labels without row."""
    have = labels.select(key).distinct().withColumn("_l", F.lit(1))
    rows = data.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    both = rows.join(have, key, "full_outer")
    n = F.coalesce("n", F.lit(0))
    return both.agg(
        F.sum(n).alias("rows"), F.sum(F.when(F.col("_l").isNotNull(), n).otherwise(0)).alias("labelled"),
        F.sum(F.when(F.col("_l").isNull(), n).otherwise(0)).alias("unlabelled"),
        F.count_if(F.col("n").isNull()).alias("orphan_labels"))


def validate_text(df: DataFrame, text: str = "text", remove_pii: bool = True) -> DataFrame:
    """Add ``pii_detected`` and ``sanitized_text``."""
    clean = redact(F.col(text)) if remove_pii else F.col(text)
    return df.withColumns({"pii_detected": has_pii(F.col(text)), "sanitized_text": clean})
