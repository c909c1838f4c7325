"""Tables behind the overview, the explorer and the plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import numeric_columns, portable_hash, ratio
from logwarden.functions.features import class_of, outcome_tag, to_long
from logwarden.operators.quantiles import exact_quantiles

BINS = 50
QUARTILES = (0.25, 0.5, 0.75)
RECENT_ROWS = 100
EXPLAIN_ROWS = 10


def _unstack(row: DataFrame, cells: Sequence[Column]) -> DataFrame:
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, one row per column."""
    columns = list(columns or numeric_columns(df))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    quartiles = exact_quantiles(values, {c: QUARTILES for c in columns})
    parts = [f(c).alias(f"{k}_{c}") for c in columns
             for k, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    return _unstack(values.agg(*parts), [F.struct(
        F.lit(c).alias("column"), F.col(f"n_{c}").alias("count"), F.col(f"mean_{c}").alias("mean"),
        F.col(f"std_{c}").alias("std"), F.col(f"min_{c}").alias("min"),
        *[F.lit(q).cast("double").alias(f"p{int(p * 100)}") for p, q in zip(QUARTILES, quartiles[c], strict=True)],
        F.col(f"max_{c}").alias("max")) for c in columns])


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def key_figures(scored: DataFrame) -> DataFrame:
    """Rows, true anomalies, detected anomalies and their shares, in one aggregate."""
    rows, true, found = F.count(F.lit(1)), F.count_if(class_of("label") == 1), F.count_if(F.col("pred") == 1)
    right = F.count_if(F.col("label") == F.col("pred"))
    return scored.agg(rows.alias("rows"), true.alias("anomalies"), ratio(true, rows).alias("anomaly_share"),
                      found.alias("detected"), ratio(found, rows).alias("detected_share"),
                      ratio(right, rows).alias("accuracy"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; the approximate form needs no shuffle of the values."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(f"distinct_{c}") for c in columns])


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin number 0..bins-1; the highest value belongs to the last bin, a missing value to bin null."""
    at = F.floor(ratio((value - low) * F.lit(float(bins)), high - low)).cast("int")
    return F.when(value.isNotNull() & ~F.isnan(value), F.greatest(F.lit(0), F.least(F.lit(bins - 1), at)))


def score_histogram(scored: DataFrame, score: str = "score", by: str = "label", bins: int = BINS) -> DataFrame:
    """Density histogram per class, each class over its own range; empty bins included.

    A class is a 0/1 label, anything else an error, so the per-class bounds are two rows.
    """
    data = scored.select(class_of(by).alias("class"), F.col(score).cast("double").alias("v"))
    two = data.groupBy("class").agg(F.min("v").alias("low"), F.max("v").alias("high"),
                                    F.count("v").alias("total"))
    placed = data.join(F.broadcast(two), "class").where(F.col("v").isNotNull())
    counts = placed.groupBy("class", _bin(F.col("v"), F.col("low"), F.col("high"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    grid = two.where("total > 0").withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    n = F.coalesce("n", F.lit(0))
    return grid.join(counts, ["class", "bin"], "left").select(
        "class", "bin", (F.col("low") + F.col("bin") * width).alias("left_edge"), n.alias("n"),
        ratio(n, F.col("total") * width).alias("density"))


def feature_histogram(df: DataFrame, feature: str, label: str = "label", bins: int = BINS) -> DataFrame:
    """Counts per bin and class over bins that both classes share; empty bins included, other labels an error."""
    data = df.select(class_of(label).alias("class"), F.col(feature).cast("double").alias("v")).where(
        F.col("v").isNotNull())
    ends = data.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    if ends["low"] is None:
        return df.sparkSession.createDataFrame([], "class int, bin int, left_edge double, n bigint")
    low, high = F.lit(ends["low"]), F.lit(ends["high"])
    counts = data.groupBy("class", _bin(F.col("v"), low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(2 * bins).select(
        F.expr(f"cast(id div {bins} as int)").alias("class"), F.expr(f"cast(id % {bins} as int)").alias("bin"))
    width = (high - low) / F.lit(float(bins))
    return grid.join(counts, ["class", "bin"], "left").select(
        "class", "bin", (low + F.col("bin") * width).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n"))


def class_summary(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Distribution of each feature per class: count, mean, deviation, quartiles, ends.

    The quartiles are exact and found per class and feature without gathering values. Labels other
    than 0 and 1 are an error.
    """
    df = df.withColumn(label, class_of(label))
    long = to_long(df, [label], features).withColumnRenamed(label, "class")
    stats = long.groupBy("feature", "class").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    split = df.select(*[F.when(F.col(label) == c, F.col(f).cast("double")).alias(f"{c}_{f}")
                        for c in (0, 1) for f in features])
    found = exact_quantiles(split, {c: QUARTILES for c in split.columns})
    rows = [(f, c, *found[f"{c}_{f}"]) for c in (0, 1) for f in features if found[f"{c}_{f}"][0] is not None]
    quartiles = df.sparkSession.createDataFrame(rows, "feature string, class int, p25 double, p50 double, p75 double")
    return stats.join(F.broadcast(quartiles), ["feature", "class"])  # two rows per feature


def recent_rows(df: DataFrame, n: int = RECENT_ROWS, time: str = "ts", row_id: str = "row_id") -> DataFrame:
    return df.orderBy(F.col(time).desc(), F.col(row_id).desc()).limit(n)


def recent_activity(scored: DataFrame, n: int = RECENT_ROWS, time: str = "ts") -> DataFrame:
    """Flagged and true anomalies among the latest n rows by event time."""
    rows, found, true = F.count(F.lit(1)), F.count_if(F.col("pred") == 1), F.count_if(class_of("label") == 1)
    return recent_rows(scored, n, time).agg(
        rows.alias("rows"), found.alias("flagged"), true.alias("anomalies"), ratio(true, rows).alias("anomaly_rate"),
        F.when(found > 0, "ALERT").otherwise("NORMAL").alias("status"))


def explain_candidates(scored: DataFrame, n: int = EXPLAIN_ROWS, by_score: bool = False) -> DataFrame:
    """The first n flagged rows, by row id or by falling score."""
    order = [F.col("score").desc(), F.col("row_id")] if by_score else [F.col("row_id")]
    return scored.where("pred = 1").orderBy(*order).limit(n)


def anomalies_only(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label) == 1)


def outcome_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy(outcome_tag().alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def scatter_sample(scored: DataFrame, x: str, y: str, points: int, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """A bounded, repeatable sample of points with their outcome, for drawing."""
    return scored.orderBy(portable_hash(row_id, seed=seed), row_id).limit(points).select(
        row_id, x, y, outcome_tag().alias("outcome"))


def scatter_grid(scored: DataFrame, x: str, y: str, bins: int = BINS) -> DataFrame:
    """Counts per cell and outcome over a bins x bins grid; every row is counted, missing coordinates in cell null."""
    ends = scored.agg(*[f(c).cast("double").alias(f"{k}_{c}") for c in (x, y)
                        for k, f in (("low", F.min), ("high", F.max))]).first()
    cell = [_bin(F.col(c).cast("double"), F.lit(ends[f"low_{c}"]), F.lit(ends[f"high_{c}"]), bins).alias(f"bin_{k}")
            for k, c in (("x", x), ("y", y))]
    return scored.groupBy(*cell, outcome_tag().alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def time_series(df: DataFrame, value: str, time: str = "ts", label: str = "label", every: str = "1 day") -> DataFrame:
    """Mean, minimum and maximum of a metric per time bucket and class."""
    start = F.window(time, every).getField("start")
    return df.groupBy(start.alias("start"), F.col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))


def panel(df: DataFrame, values: Sequence[str], time: str = "ts", label: str = "label",
          every: str = "1 day") -> DataFrame:
    """The time series of several metrics in long form."""
    start = F.window(time, every).getField("start")
    wide = df.groupBy(start.alias("start"), F.col(label).alias("class")).agg(*[F.avg(v).alias(v) for v in values])
    return wide.unpivot(["start", "class"], list(values), "feature", "mean")


def feature_importance(explanation: DataFrame, value: str = "z_score") -> DataFrame:
    """Mean size per feature over explained rows, largest first."""
    return (explanation.groupBy("feature").agg(F.avg(F.abs(value)).alias("importance"))
            .orderBy(F.col("importance").desc(), "feature"))
