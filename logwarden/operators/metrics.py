"""Detection metrics for flagged rows, from one aggregate over the scored table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import ratio, require_columns, written
from logwarden.functions.features import class_of, is_class
from logwarden.operators.buckets import add_bucket
from logwarden.operators.curves import CurveTargets, curve_metrics, score_steps

# Fixed values of the metric definitions.
PRECISION_K = (10, 50, 100, 500)
INVESTIGATION_MINUTES = 30
MAX_ALERTS_PER_DAY = 100
ANALYST_HOURS = 8
OVERLOAD_BURDEN = 10
SWEEP_POINTS = 100


def confusion_counts(scored: DataFrame, label: str = "label", pred: str = "pred",
                     by: Sequence[str] = ()) -> DataFrame:
    """``tp, fp, tn, fn`` as one row, or one row per group; labels and flags other than 0 and 1 are an error."""
    require_columns(scored, [label, pred, *by])
    actual, flagged = F.col(label) == 1, F.col(pred) == 1
    rows = scored.groupBy(*by) if by else scored
    counts = rows.agg(
        F.count_if(actual & flagged).alias("tp"),
        F.count_if(~actual & flagged).alias("fp"),
        F.count_if(~actual & ~flagged).alias("tn"),
        F.count_if(actual & ~flagged).alias("fn"),
        F.count_if(~(is_class(label) & is_class(pred))).alias("_wrong"),
    )
    stop = F.raise_error(F.concat(F.col("_wrong").cast("string"), F.lit(" rows have a label or flag other than 0 and 1")))
    return counts.select(*by, *[F.when(F.col("_wrong") > 0, stop.cast("bigint")).otherwise(F.col(c)).alias(c)
                                for c in ("tp", "fp", "tn", "fn")])


def confusion_matrix(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """The four counts in long form ``(label, pred, n)``, zero cells included."""
    return confusion_counts(scored, label, pred).select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("pred"), F.col(c).alias("n"))
        for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])).alias("cell")).select("cell.*")


def _total() -> Column:
    return F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")


def basic_columns() -> dict[str, Column]:
    """Ratios of the confusion counts; one class in the labels gives zeros and accuracy."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    both = (tp + fn > 0) & (fp + tn > 0)

    def guarded(value: Column) -> Column:
        return F.when(both, value).otherwise(F.lit(0.0))

    recall = guarded(ratio(tp, tp + fn))
    return {
        "precision": guarded(ratio(tp, tp + fp)),
        "recall": recall,
        "f1_score": guarded(ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn)),
        "accuracy": ratio(tp + tn, _total()),
        "specificity": guarded(ratio(tn, tn + fp)),
        "sensitivity": recall,
    }


def operational_columns() -> dict[str, Column]:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    detection, efficiency = ratio(tp, tp + fn), ratio(tp, tp + fp)
    return {
        "detection_rate": detection,
        "false_alarm_rate": ratio(fp, fp + tn),
        "alert_efficiency": efficiency,
        "miss_rate": F.lit(1.0) - detection,
        "positive_predictive_value": efficiency,
        "negative_predictive_value": ratio(tn, tn + fn),
    }


def workload_columns(investigation_minutes: int = INVESTIGATION_MINUTES) -> dict[str, Column]:
    tp, alerts = F.col("tp"), F.col("tp") + F.col("fp")
    per_day = ratio(alerts * 24, _total())
    hours = alerts * F.lit(float(investigation_minutes)) / F.lit(60.0)
    burden = per_day / F.lit(float(ANALYST_HOURS))
    return {
        "total_alerts": alerts,
        "alerts_per_day": per_day,
        "investigation_hours": hours,
        "workload_efficiency": ratio(tp, hours),
        "alert_burden_per_analyst": burden,
        "overload_indicator": F.when(burden > OVERLOAD_BURDEN, 1.0).otherwise(0.0),
    }


def _add(counts: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return counts.select("*", *[c.alias(n) for n, c in columns.items()])


def basic_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _add(confusion_counts(scored, by=by), basic_columns())


def operational_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _add(confusion_counts(scored, by=by), operational_columns())


def workload_metrics(scored: DataFrame, by: Sequence[str] = (),
                     investigation_minutes: int = INVESTIGATION_MINUTES) -> DataFrame:
    return _add(confusion_counts(scored, by=by), workload_columns(investigation_minutes))


def flag_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every metric that needs only labels and flags, from one aggregate."""
    return _add(confusion_counts(scored, by=by),
                {**basic_columns(), **operational_columns(), **workload_columns()})


def alerts_by_day(scored: DataFrame, time: str = "ts", analysts: int = ANALYST_HOURS,
                  max_alerts: int = MAX_ALERTS_PER_DAY) -> DataFrame:
    """Alerts per calendar day against the daily limit."""
    day = F.window(time, "1 day").getField("start")
    return (
        scored.groupBy(day.alias("day"))
        .agg(F.count(F.lit(1)).alias("events"),
             F.count_if(F.col("pred") == 1).alias("alerts"),
             F.count_if((class_of("label") == 1) & (F.col("pred") == 1)).alias("true_alerts"))
        .withColumn("alerts_per_analyst", F.col("alerts") / F.lit(float(analysts)))
        .withColumn("over_limit", (F.col("alerts") > max_alerts).cast("int"))
    )


def top_scored(scored: DataFrame, k: int, score: str = "score", row_id: str = "row_id") -> DataFrame:
    """The k highest scores with their rank; ties go to the smaller row id."""
    order = [F.col(score).desc(), F.col(row_id).asc()]
    top = scored.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # k rows


def precision_at_k(scored: DataFrame, ks: Sequence[int] = PRECISION_K) -> DataFrame:
    """``precision_at_<k>`` for every requested k; short tables divide by their row count."""
    if not ks or min(ks) < 1:
        raise ValueError("k must be at least 1")
    # Checked before the top is taken, so in every row.
    checked = scored.select("row_id", class_of("label").alias("label"), "score")
    top = top_scored(checked, max(ks))
    hits = [F.count_if((F.col("rank") <= k) & (F.col("label") == 1)).alias(f"h{k}") for k in ks]
    return top.agg(F.count(F.lit(1)).alias("rows"), *hits).select(*[
        ratio(F.col(f"h{k}"), F.least(F.lit(k), F.col("rows"))).alias(f"precision_at_{k}") for k in ks])


def sweep_thresholds(scored: DataFrame, points: int = SWEEP_POINTS, score: str = "score") -> list[float]:
    """Evenly spaced thresholds from the lowest to the highest score, both ends exact."""
    row = scored.agg(F.min(score).cast("double").alias("low"),
                     F.max(score).cast("double").alias("high")).first()
    low, high = row["low"], row["high"]
    if low is None:
        raise ValueError("cannot sweep an empty table")
    step = (high - low) / (points - 1)
    return [low + i * step for i in range(points - 1)] + [high]


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float] | None = None) -> DataFrame:
    """Confusion counts and basic metrics of ``score >= threshold`` per threshold.

    Each score is put into the gap between two thresholds and counted there, so the data is
    read once whatever the number of thresholds. Infinite thresholds are allowed, NaN is not.
    """
    asked = list(map(float, thresholds)) if thresholds is not None else sweep_thresholds(scored)
    if any(math.isnan(t) for t in asked):
        raise ValueError("a threshold must be a number")
    grid = sorted({t for t in asked if math.isfinite(t)})
    spark = scored.sparkSession
    placed = add_bucket(scored.select(F.col("score").cast("double").alias("score"), class_of("label").alias("label")), "score", grid, "gap")
    # Below all finite thresholds is level 0, at infinity the last one.
    gaps = placed.withColumn("gap", F.when(F.col("score") == math.inf, F.lit(len(grid) + 1)).otherwise(F.col("gap")))
    counts = gaps.groupBy("gap").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                     F.count_if(F.col("label") == 0).alias("neg"))
    levels = spark.createDataFrame(list(enumerate([-math.inf, *grid, math.inf])), "gap int, threshold double")
    # One row per threshold from here on.
    down = Window.orderBy(F.col("gap").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("gap").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pos, neg = F.coalesce("pos", F.lit(0)), F.coalesce("neg", F.lit(0))
    swept = (
        levels.join(counts, "gap", "left")
        .select("gap", "threshold", F.sum(pos).over(down).alias("tp"), F.sum(neg).over(down).alias("fp"),
                F.sum(pos).over(whole).alias("p"), F.sum(neg).over(whole).alias("n"))
        .select("threshold", "tp", "fp", (F.col("n") - F.col("fp")).alias("tn"),
                (F.col("p") - F.col("tp")).alias("fn"))
    )
    order = spark.createDataFrame(list(enumerate(asked)), "step int, threshold double")
    return _add(order.join(swept, "threshold"), basic_columns())


def evaluate(scored: DataFrame, with_scores: bool = True, ks: Sequence[int] = PRECISION_K,
             targets: CurveTargets = CurveTargets()) -> DataFrame:
    """All metrics as one wide row (row_id, label, pred and, optionally, score as input).

    The four columns are written once, so whatever computed the scores does not run again for each part.
    """
    if not with_scores:
        return flag_metrics(scored)
    scored = written(scored.select("row_id", "label", "pred", "score"), "evaluated")
    row = flag_metrics(scored)
    parts = [row, precision_at_k(scored, ks), curve_metrics(score_steps(scored), targets)]
    keyed = [p.withColumn("_all", F.lit("all")) for p in parts]  # each part is one row
    return keyed[0].join(keyed[1], "_all").join(keyed[2], "_all").drop("_all")


def metrics_long(metrics: DataFrame, run_id: str) -> DataFrame:
    """A wide metrics row as ``(run_id, metric, value)`` for the metric history."""
    names = metrics.columns
    cells = metrics.select(*[F.col(c).cast("double").alias(c) for c in names])
    return cells.unpivot([], names, "metric", "value").select(F.lit(run_id).alias("run_id"), "metric", "value")


def compare_methods(flags: DataFrame, method: str = "method") -> DataFrame:
    """Flag metrics per method from long rows ``(method, row_id, label, pred)``."""
    return flag_metrics(flags, by=[method])


def best_method(comparison: DataFrame, order: Sequence[str], method: str = "method") -> DataFrame:
    """Highest accuracy; the method listed first wins ties."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(method))
    return comparison.orderBy(F.col("accuracy").desc(), place).limit(1)


# Section and metric names of the evaluation report.
REPORT_SECTIONS = {
    "basic": ("accuracy", "precision", "recall", "f1_score", "specificity"),
    "security": ("detection_rate", "false_alarm_rate", "alert_efficiency", "miss_rate"),
    "operational": ("total_alerts", "alerts_per_day", "investigation_hours", "workload_efficiency",
                    "alert_burden_per_analyst"),
    "confusion": ("tp", "fp", "tn", "fn"),
}


def report_table(metrics: DataFrame) -> DataFrame:
    """The evaluation report as ``(section, metric, value)`` rows."""
    sections = dict(REPORT_SECTIONS)
    at_k = tuple(c for c in metrics.columns if c.startswith("precision_at_"))
    if at_k:
        sections["precision_at_k"] = at_k
    cells = [F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"),
                      F.col(m).cast("double").alias("value"))
             for s, names in sections.items() for m in names]
    return metrics.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def recommendations(metrics: DataFrame) -> DataFrame:
    """One row per advice that the metrics call for."""
    # Fixed texts and limits of the advice rules.
    rules = [
        (F.col("false_alarm_rate") > 0.05, "High false alarm rate - consider adjusting threshold"),
        (F.col("detection_rate") < 0.8, "Low detection rate - model may need retraining"),
        (F.col("alert_burden_per_analyst") > 10, "High alert burden - consider alert prioritization"),
        (F.col("workload_efficiency") < 0.1, "Low workload efficiency - many false alerts"),
    ]
    advice = F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in rules]))
    return metrics.select(F.explode(advice).alias("recommendation"))
