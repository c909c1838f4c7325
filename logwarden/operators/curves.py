"""ROC and precision-recall curves without a one-partition window.

Scores are first reduced to one row per distinct value (partial aggregation takes care of
heavy ties), then cut into value ranges. A window runs inside each range and the totals of
the ranges above it are added, so no task ever sees the whole ordered table. Equal scores
always share a range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import ratio, written

ROWS_PER_RANGE = 500_000


def score_steps(df: DataFrame, label: str = "label", score: str = "score",
                rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per distinct score: ``score, pos, neg, tp, fp`` and the next row's counts.

    ``tp``/``fp`` count labels 1/0 at this score or above. ``next_pos``/``next_neg`` are the
    counts at the next lower score (null on the last row), which marks the curve corners.
    ``positives``/``negatives`` repeat the class totals.
    """
    value = F.col(score).cast("double")
    base = df.select(value.alias("score"), F.col(label).cast("int").alias("label"))
    usable = F.col("score").isNotNull() & ~F.isnan("score") & F.coalesce(F.col("label").isin(0, 1), F.lit(False))
    seen = base.agg(
        F.count_if(~usable).alias("bad"),
        F.approx_count_distinct("score").alias("distinct"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives")).first()
    if seen["bad"]:
        raise ValueError(f"{seen['bad']} rows have no usable score or a label other than 0 and 1")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-seen["distinct"] // rows_per_range))
    groups = base.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                       F.count_if(F.col("label") == 0).alias("neg"))
    # Ranges of distinct scores, so ties cannot make them uneven; written, so that the ranges stay as they are.
    steps = written(groups.repartitionByRange(ranges, "score").withColumn("range", F.spark_partition_id()), "score-ranges")

    # One row per range: this window may run in one task.
    above = Window.orderBy(F.col("range").desc())
    before = above.rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        steps.groupBy("range")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"),
             F.max_by(F.struct("pos", "neg"), "score").alias("top"))
        .select("range",
                F.coalesce(F.sum("p").over(before), F.lit(0)).alias("tp_above"),
                F.coalesce(F.sum("n").over(before), F.lit(0)).alias("fp_above"),
                F.lead("top").over(above).alias("below"))
    )
    falling = Window.partitionBy("range").orderBy(F.col("score").desc())
    running = falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        steps.join(F.broadcast(totals), "range")
        .select(
            "score", "pos", "neg",
            (F.sum("pos").over(running) + F.col("tp_above")).alias("tp"),
            (F.sum("neg").over(running) + F.col("fp_above")).alias("fp"),
            F.coalesce(F.lead("pos").over(falling), F.col("below.pos")).alias("next_pos"),
            F.coalesce(F.lead("neg").over(falling), F.col("below.neg")).alias("next_neg"),
            F.lit(seen["positives"]).cast("bigint").alias("positives"),
            F.lit(seen["negatives"]).cast("bigint").alias("negatives"),
        )
    )


def _is_corner() -> Column:
    """Ends of the curve, and points where it bends (collinear points are dropped)."""
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    last = F.col("next_pos").isNull()
    bends = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    return first | last | bends


def roc_points(steps: DataFrame, corners_only: bool = True) -> DataFrame:
    """``threshold, fp, tp, fpr, tpr``; the (0, 0) start has a null threshold."""
    start = steps.sparkSession.createDataFrame(
        [(None, 0, 0, 0.0, 0.0)], "threshold double, fp bigint, tp bigint, fpr double, tpr double")
    points = steps.where(_is_corner()) if corners_only else steps
    return points.select(
        F.col("score").alias("threshold"), "fp", "tp",
        ratio(F.col("fp"), F.col("negatives")).alias("fpr"),
        ratio(F.col("tp"), F.col("positives")).alias("tpr")).unionByName(start)


def pr_points(steps: DataFrame, corners_only: bool = False) -> DataFrame:
    """``threshold, precision, recall`` at every distinct score, and the end (1, 0) with a null threshold."""
    points = steps.where(_is_corner()) if corners_only else steps
    end = steps.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.select(
        F.col("score").alias("threshold"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("positives")).alias("recall")).unionByName(end)


@dataclass(frozen=True)
class CurveTargets:
    tpr: float = 0.95
    fpr: float = 0.01
    precision: float = 0.9
    tie: str = "first"  # 'first' nearest point on the curve, or the 'best' of equally near ones

    def __post_init__(self):
        if self.tie not in ("first", "best"):
            raise ValueError("tie must be 'first' or 'best'")


def curve_metrics(steps: DataFrame, targets: CurveTargets = CurveTargets()) -> DataFrame:
    """One row: ``roc_auc, pr_auc, fpr_at_tpr, tpr_at_fpr, recall_at_precision``.

    With a single class in the labels the ROC values are 0.0.
    """
    tpr = ratio(F.col("tp"), F.col("positives"))
    fpr = ratio(F.col("fp"), F.col("negatives"))
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    place = F.col("tp") + F.col("fp")  # rises strictly along the curve
    near_tpr, near_fpr = F.abs(tpr - F.lit(targets.tpr)), F.abs(fpr - F.lit(targets.fpr))
    best = targets.tie == "best"
    order_tpr = F.struct(near_tpr, fpr) if best else F.struct(near_tpr, place.cast("double"))
    order_fpr = F.struct(near_fpr, -tpr) if best else F.struct(near_fpr, place.cast("double"))
    corner = _is_corner()
    row = steps.agg(
        F.first("positives").alias("p"), F.first("negatives").alias("n"),
        F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / F.lit(2.0))).alias("area"),
        F.sum(F.col("pos") * precision).alias("ap"),
        F.min_by(fpr, F.when(corner, order_tpr)).alias("fpr_at"),
        F.min(F.when(corner, near_tpr)).alias("near_tpr"),
        F.min_by(tpr, F.when(corner, order_fpr)).alias("tpr_at"),
        F.min(F.when(corner, near_fpr)).alias("near_fpr"),
        F.max(F.when(precision >= F.lit(targets.precision), tpr)).alias("rec"),
    )
    two = (F.col("p") > 0) & (F.col("n") > 0)

    def at_start(near: str, target: float, strict: bool) -> Column:
        # The curve starts at (0, 0), which comes first on ties.
        here = F.lit(abs(0.0 - target))
        return (here < F.col(near)) if strict else (here <= F.col(near))

    start_tpr = at_start("near_tpr", targets.tpr, strict=False)  # fpr 0 is also the best fpr
    start_fpr = at_start("near_fpr", targets.fpr, strict=best)
    zero = F.lit(0.0)
    return row.select(
        F.when(two, ratio(F.col("area"), F.col("p").cast("double") * F.col("n"))).otherwise(zero).alias("roc_auc"),
        ratio(F.col("ap"), F.col("p")).alias("pr_auc"),
        F.when(two & ~start_tpr, F.col("fpr_at")).otherwise(zero).alias("fpr_at_tpr"),
        F.when(two & ~start_fpr, F.col("tpr_at")).otherwise(zero).alias("tpr_at_fpr"),
        F.coalesce("rec", zero).alias("recall_at_precision"),
    )
