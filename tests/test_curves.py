import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.operators import curves, metrics, quantiles

LABELS = [1, 0, 1, 0, 1, 0, 0, 1, 0, 0]
SCORES = [round(0.9 - 0.1 * i, 1) for i in range(10)]


def scored(spark, labels, scores, preds=None):
    preds = preds or [0] * len(labels)
    rows = [(i, int(a), float(s), int(p)) for i, (a, s, p) in enumerate(zip(labels, scores, preds))]
    return spark.createDataFrame(rows, "row_id bigint, label int, score double, pred int")


def brute_points(labels, scores):
    labels, scores = np.asarray(labels), np.asarray(scores, float)
    cuts = np.unique(scores)[::-1]
    return [(c, int(((scores >= c) & (labels == 1)).sum()), int(((scores >= c) & (labels == 0)).sum()))
            for c in cuts]


def brute_corners(points):
    keep = [0]
    for i in range(1, len(points) - 1):
        a, b, c = points[i - 1], points[i], points[i + 1]
        if (c[1] - 2 * b[1] + a[1]) or (c[2] - 2 * b[2] + a[2]):
            keep.append(i)
    if len(points) > 1:
        keep.append(len(points) - 1)
    return [points[i] for i in keep]


def test_golden_curve_values(spark):
    steps = curves.score_steps(scored(spark, LABELS, SCORES))
    row = curves.curve_metrics(steps).first()
    assert row["roc_auc"] == pytest.approx(17 / 24)
    assert row["pr_auc"] == pytest.approx(0.691667, abs=1e-6)
    assert row["fpr_at_tpr"] == pytest.approx(0.666667, abs=1e-6)
    assert row["tpr_at_fpr"] == 0.0
    assert row["recall_at_precision"] == pytest.approx(0.25)
    best = curves.curve_metrics(steps, curves.CurveTargets(tie="best")).first()
    assert best["tpr_at_fpr"] == pytest.approx(0.25)


def test_ties_and_single_class(spark):
    row = curves.curve_metrics(curves.score_steps(scored(spark, LABELS, [0.5] * 10))).first()
    assert row["roc_auc"] == pytest.approx(0.5)
    assert row["pr_auc"] == pytest.approx(0.4)
    one = curves.curve_metrics(curves.score_steps(scored(spark, [0] * 10, SCORES))).first()
    assert (one["roc_auc"], one["fpr_at_tpr"], one["pr_auc"]) == (0.0, 0.0, 0.0)
    empty = scored(spark, [], [])
    assert curves.curve_metrics(curves.score_steps(empty)).first()["roc_auc"] == 0.0


def test_bad_labels_and_scores_are_refused(spark):
    with pytest.raises(ValueError):
        curves.score_steps(scored(spark, [0, 2], [0.1, 0.2]))
    with pytest.raises(ValueError):
        curves.score_steps(scored(spark, [0, 1], [0.1, float("nan")]))


@pytest.mark.parametrize("rows_per_range", [3, 500_000])
def test_steps_match_brute_force_across_ranges(spark, rows_per_range):
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 3000)
    scores = np.round(rng.gamma(2.0, 1.0, 3000), 2)
    scores[:1000] = 1.5  # a third of all rows share one score
    df = scored(spark, labels, scores).repartition(7)
    steps = curves.score_steps(df, rows_per_range=rows_per_range)
    got = [(r["score"], r["tp"], r["fp"]) for r in steps.orderBy(F.desc("score")).collect()]
    expect = brute_points(labels, scores)
    assert got == expect
    pts = curves.roc_points(steps).where("threshold is not null").orderBy(F.desc("threshold")).collect()
    assert [(r["threshold"], r["tp"], r["fp"]) for r in pts] == brute_corners(expect)
    p, n = int(labels.sum()), int((1 - labels).sum())
    auc = sum((s[labels == 1][:, None] > s[labels == 0][None, :]).sum()
              + 0.5 * (s[labels == 1][:, None] == s[labels == 0][None, :]).sum() for s in [scores]) / (p * n)
    row = curves.curve_metrics(steps).first()
    assert row["roc_auc"] == pytest.approx(auc)
    ap = sum((b[1] - a[1]) / p * b[1] / (b[1] + b[2]) for a, b in zip([(0, 0, 0)] + expect, expect))
    assert row["pr_auc"] == pytest.approx(ap)
    flipped = curves.score_steps(df.withColumn("score", -F.col("score")))
    assert curves.curve_metrics(flipped).first()["roc_auc"] == pytest.approx(1 - auc)


def test_prefix_sums_need_no_single_partition_window(spark):
    df = scored(spark, LABELS, SCORES)
    plan = curves.score_steps(df)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window" in line and "score" in line:
            assert "range" in line


def test_threshold_sweep_goldens(spark):
    df = scored(spark, LABELS, SCORES)
    rows = metrics.threshold_sweep(df, [0.45, 0.0, 0.9, 0.45]).orderBy("step").collect()
    assert [(r["tp"], r["fp"], r["tn"], r["fn"]) for r in rows] == [
        (3, 2, 4, 1), (4, 6, 0, 0), (1, 0, 6, 3), (3, 2, 4, 1)]
    sweep = metrics.threshold_sweep(df).orderBy("step").collect()
    assert len(sweep) == 100 and sweep[-1]["threshold"] == 0.9 and sweep[-1]["tp"] == 1
    flat = metrics.threshold_sweep(scored(spark, LABELS, [0.5] * 10)).collect()
    assert len(flat) == 100 and {r["tp"] for r in flat} == {4}


def test_precision_at_k(spark):
    row = metrics.precision_at_k(scored(spark, LABELS, SCORES)).first()
    assert [row[f"precision_at_{k}"] for k in (10, 50, 100, 500)] == [0.4] * 4
    assert metrics.precision_at_k(scored(spark, LABELS, SCORES), [3]).first()[0] == pytest.approx(2 / 3)


def test_quantile_goldens(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (None,), (math.nan,)], "v double")
    got = quantiles.exact_quantiles(df, {"v": [0.25, 0.75, 0.9]})["v"]
    assert got == pytest.approx([2.0, 4.0, 61.6])
    with pytest.raises(ValueError):
        quantiles.quantile(df.where("v > 1000 and not isnan(v)"), "v", 0.5)


@pytest.mark.parametrize("shape", ["smooth", "tied", "constant"])
def test_rank_search_is_exact_without_the_builtin(spark, shape):
    rng = np.random.default_rng(11)
    values = rng.normal(size=20_000)
    if shape == "tied":
        values[:7000] = 0.25
        values = np.round(values, 2)
    if shape == "constant":
        values[:] = 3.0
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = quantiles.exact_quantiles(df, {"v": probs}, gather_rows=10)["v"]
    assert got == pytest.approx(list(np.quantile(values, probs)), abs=1e-12)
