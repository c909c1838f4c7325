"""Registered queries: metrics, curves, sweeps, reports, method comparison."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.detectors import make_detector
from logwarden.operators import curves, metrics
from logwarden.operators.scoring import attach_scores
from logwarden.plans.base import (
    FEATS, FEATURES, SCORED, cut_sql, deviation_sql, log_features, r, rounded, scored_events, table)

METHODS = ["value", "deviation", "gap"]


def _steps(spark, sf_dir) -> DataFrame:
    return curves.score_steps(scored_events(spark, sf_dir))


def _curve(*names):
    return lambda spark, sf: rounded(curves.curve_metrics(_steps(spark, sf)).select(*names))


def best_ties(spark, sf_dir):
    targets = curves.CurveTargets(tie="best")
    return rounded(curves.curve_metrics(_steps(spark, sf_dir), targets).select("fpr_at_tpr", "tpr_at_fpr"))


def labels_precision(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), F.col("toxic").alias("label"))
    scores = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("n_chars").cast("double").alias("score"))
    return rounded(metrics.precision_at_k(attach_scores(labels, scores, "row_id")))


def method_flags(spark, sf_dir) -> DataFrame:
    """Flags of three scorers side by side, then one row per method and event."""
    rows = log_features(spark, sf_dir)
    wide = rows.select("row_id", "label", *FEATURES)
    for name, features in (("value", ["value"]), ("deviation", FEATURES), ("gap", ["gap"])):
        model = make_detector("deviation", features=features).fit(rows)
        wide = model.score(wide, "_score", f"_{name}").drop("_score")
    flags = [F.col(f"_{m}").alias(m) for m in METHODS]
    return wide.select("row_id", "label", *flags).unpivot(["row_id", "label"], METHODS, "method", "pred")


def method_comparison(spark, sf_dir):
    return rounded(metrics.compare_methods(method_flags(spark, sf_dir)))


def best_method(spark, sf_dir):
    best = metrics.best_method(metrics.compare_methods(method_flags(spark, sf_dir)), METHODS)
    return rounded(best.select("method", "accuracy"))


QUERIES = {
    "confusion_counts": lambda s, d: metrics.confusion_counts(scored_events(s, d)),
    "confusion_matrix": lambda s, d: metrics.confusion_matrix(scored_events(s, d)),
    "confusion_metrics": lambda s, d: rounded(metrics.basic_metrics(scored_events(s, d))),
    "operational_metrics": lambda s, d: rounded(metrics.operational_metrics(scored_events(s, d))),
    "workload_metrics": lambda s, d: rounded(metrics.workload_metrics(scored_events(s, d))),
    "alerts_per_day": lambda s, d: rounded(metrics.alerts_by_day(scored_events(s, d), max_alerts=30).withColumn(
        "day", F.col("day").cast("timestamp_ntz"))),
    "precision_at_k": lambda s, d: rounded(metrics.precision_at_k(scored_events(s, d))),
    "precision_at_k_labels": labels_precision,
    "precision_given_ks": lambda s, d: rounded(metrics.precision_at_k(scored_events(s, d), (1, 7, 333))),
    "sweep_given_thresholds": lambda s, d: rounded(metrics.threshold_sweep(
        scored_events(s, d), [math.inf, 3.0, -math.inf, 40.0]).withColumn("threshold", F.col("threshold").cast("string"))),
    "one_class_metrics": lambda s, d: rounded(metrics.flag_metrics(scored_events(s, d).where("label = 1")).select(
        "tp", "fp", "tn", "fn", "precision", "recall", "accuracy", "detection_rate", "false_alarm_rate")),
    "recommendations_poor": lambda s, d: metrics.recommendations(metrics.flag_metrics(
        scored_events(s, d).withColumn("pred", 1 - F.col("label")))),
    "top_scored": lambda s, d: metrics.top_scored(
        scored_events(s, d).select("row_id", "label", "score"), 500),
    "score_steps": lambda s, d: _steps(s, d).select("score", "pos", "neg", "tp", "fp"),
    "roc_auc": _curve("roc_auc"),
    "fpr_at_tpr": _curve("fpr_at_tpr", "tpr_at_fpr"),
    "fpr_at_tpr_best_ties": best_ties,
    "average_precision": _curve("pr_auc"),
    "recall_at_precision": _curve("recall_at_precision"),
    "roc_points": lambda s, d: rounded(curves.roc_points(_steps(s, d))),
    "pr_points": lambda s, d: rounded(curves.pr_points(_steps(s, d))),
    "threshold_sweep": lambda s, d: rounded(metrics.threshold_sweep(scored_events(s, d))),
    "evaluate_all": lambda s, d: rounded(metrics.evaluate(scored_events(s, d))),
    "evaluation_report": lambda s, d: rounded(metrics.report_table(metrics.evaluate(scored_events(s, d)))),
    "recommendations": lambda s, d: metrics.recommendations(metrics.flag_metrics(scored_events(s, d))),
    "method_comparison": method_comparison,
    "best_method": best_method,
}


def _div(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0::DOUBLE)"


def _guard(x: str) -> str:
    return f"CASE WHEN tp + fn > 0 AND fp + tn > 0 THEN {x} ELSE 0.0::DOUBLE END"


_RECALL = _guard(_div("tp", "tp + fn"))
_PRECISION = _guard(_div("tp", "tp + fp"))
BASIC_SQL = {
    "precision": _PRECISION, "recall": _RECALL, "f1_score": _guard(_div("2 * tp", "2 * tp + fp + fn")),
    "accuracy": _div("tp + tn", "tp + fp + tn + fn"), "specificity": _guard(_div("tn", "tn + fp")),
    "sensitivity": _RECALL,
}
OPERATIONAL_SQL = {
    "detection_rate": _div("tp", "tp + fn"), "false_alarm_rate": _div("fp", "fp + tn"),
    "alert_efficiency": _div("tp", "tp + fp"), "miss_rate": f"1 - {_div('tp', 'tp + fn')}",
    "positive_predictive_value": _div("tp", "tp + fp"), "negative_predictive_value": _div("tn", "tn + fn"),
}
_PER_DAY = _div("(tp + fp) * 24", "tp + fp + tn + fn")
WORKLOAD_SQL = {
    "alerts_per_day": _PER_DAY, "investigation_hours": "(tp + fp) * 30.0::DOUBLE / 60",
    "workload_efficiency": _div("tp", "(tp + fp) * 30.0::DOUBLE / 60"),
    "alert_burden_per_analyst": f"{_PER_DAY} / 8",
    "overload_indicator": f"CASE WHEN {_PER_DAY} / 8 > 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END",
}


def _columns(*groups: dict[str, str]) -> str:
    return ", ".join(f"{r(x)} AS {n}" for g in groups for n, x in g.items())


def _counts(source: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""cm AS (SELECT {key}count(*) FILTER (label = 1 AND pred = 1) AS tp,
  count(*) FILTER (label = 0 AND pred = 1) AS fp, count(*) FILTER (label = 0 AND pred = 0) AS tn,
  count(*) FILTER (label = 1 AND pred = 0) AS fn FROM {source}{tail})"""


CURVE = """
g AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM scored GROUP BY score),
steps AS (SELECT score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
    lead(pos) OVER w AS np, lead(neg) OVER w AS nn, row_number() OVER w AS rn FROM g WINDOW w AS (ORDER BY score DESC)),
tot AS (SELECT sum(pos)::DOUBLE AS p, sum(neg)::DOUBLE AS n FROM g),
corners AS (SELECT score AS threshold, fp, tp, fp / n AS fpr, tp / p AS tpr FROM steps, tot
    WHERE rn = 1 OR np IS NULL OR np <> pos OR nn <> neg
  UNION ALL SELECT CAST(NULL AS DOUBLE), 0, 0, 0.0::DOUBLE, 0.0::DOUBLE)"""
_AUC = "sum(neg::DOUBLE * (tp - pos / 2.0::DOUBLE)) / (any_value(p) * any_value(n))"
_AP = "sum(pos * (tp::DOUBLE / (tp + fp))) / any_value(p)"
_RAP = "COALESCE(max(CASE WHEN tp::DOUBLE / (tp + fp) >= 0.9::DOUBLE THEN tp / p END), 0.0::DOUBLE)"
_FPR_AT = "(SELECT fpr FROM corners ORDER BY abs(tpr - 0.95::DOUBLE), tp + fp LIMIT 1)"
_TPR_AT = "(SELECT tpr FROM corners ORDER BY abs(fpr - 0.01::DOUBLE), tp + fp LIMIT 1)"
_FPR_BEST = "(SELECT fpr FROM corners ORDER BY abs(tpr - 0.95::DOUBLE), fpr LIMIT 1)"
_TPR_BEST = "(SELECT tpr FROM corners ORDER BY abs(fpr - 0.01::DOUBLE), tpr DESC LIMIT 1)"
_HEAD = f"WITH {SCORED}"


def _at_k(source: str) -> str:
    parts = ", ".join(f"{r(_div(f'count(*) FILTER (rn <= {k} AND label = 1)', f'least({k}, count(*))'))} AS precision_at_{k}"
                      for k in (10, 50, 100, 500))
    return f"SELECT {parts} FROM (SELECT label, row_number() OVER (ORDER BY score DESC, row_id) AS rn FROM {source}) t"


_FLAG_SQL = _columns(BASIC_SQL, OPERATIONAL_SQL) + ", tp + fp AS total_alerts, " + _columns(WORKLOAD_SQL)
_METHODS_SQL = f"""WITH {FEATS}, {deviation_sql(FEATURES)},
one AS (SELECT row_id, label, pred AS deviation, abs((value - m_value) / s_value) AS v, abs((gap - m_gap) / s_gap) AS g
        FROM dscored, st),
cuts AS (SELECT {cut_sql('v', 'one')} AS cv, {cut_sql('g', 'one')} AS cg),
flags AS (SELECT 'deviation' AS method, label, deviation AS pred FROM one
  UNION ALL SELECT 'value', label, CAST(v > cv AS INTEGER) FROM one, cuts
  UNION ALL SELECT 'gap', label, CAST(g > cg AS INTEGER) FROM one, cuts),
{_counts('flags', 'method')}"""


def _report_sql() -> str:
    sections = {"basic": ("accuracy", "precision", "recall", "f1_score", "specificity"),
                "security": ("detection_rate", "false_alarm_rate", "alert_efficiency", "miss_rate"),
                "operational": ("total_alerts", "alerts_per_day", "investigation_hours", "workload_efficiency",
                                "alert_burden_per_analyst"),
                "confusion": ("tp", "fp", "tn", "fn"),
                "precision_at_k": tuple(f"precision_at_{k}" for k in (10, 50, 100, 500))}
    rows = " UNION ALL ".join(f"SELECT '{s}' AS section, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM wide"
                              for s, names in sections.items() for m in names)
    return (f"{_HEAD}, {_counts('scored')}, at_k AS ({_at_k('scored')}), "
            f"wide AS (SELECT tp, fp, tn, fn, {_FLAG_SQL}, at_k.* FROM cm, at_k) {rows}")


ORACLES = {
    "confusion_counts": f"{_HEAD}, {_counts('scored')} SELECT tp, fp, tn, fn FROM cm",
    "confusion_matrix": f"""{_HEAD}, cells AS (SELECT a AS label, b AS pred FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b))
        SELECT label, pred, count(row_id) AS n FROM cells LEFT JOIN scored USING (label, pred) GROUP BY label, pred""",
    "confusion_metrics": f"{_HEAD}, {_counts('scored')} SELECT tp, fp, tn, fn, {_columns(BASIC_SQL)} FROM cm",
    "operational_metrics": f"{_HEAD}, {_counts('scored')} SELECT tp, fp, tn, fn, {_columns(OPERATIONAL_SQL)} FROM cm",
    "workload_metrics": f"""{_HEAD}, {_counts('scored')}
        SELECT tp, fp, tn, fn, tp + fp AS total_alerts, {_columns(WORKLOAD_SQL)} FROM cm""",
    "alerts_per_day": f"""{_HEAD} SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS events,
        count(*) FILTER (pred = 1) AS alerts, count(*) FILTER (pred = 1 AND label = 1) AS true_alerts,
        {r("count(*) FILTER (pred = 1) / 8.0::DOUBLE")} AS alerts_per_analyst,
        CAST(count(*) FILTER (pred = 1) > 30 AS INTEGER) AS over_limit FROM scored GROUP BY 1""",
    "precision_at_k": f"{_HEAD} {_at_k('scored')}",
    "precision_given_ks": f"""{_HEAD}, o AS (SELECT label, row_number() OVER (ORDER BY score DESC, row_id) AS rn FROM scored)
        SELECT {', '.join(f"{r(f'count(*) FILTER (rn <= {k} AND label = 1)::DOUBLE / least({k}, count(*))')} AS precision_at_{k}" for k in (1, 7, 333))}
        FROM o""",
    "sweep_given_thresholds": f"""{_HEAD}, g AS (SELECT * FROM (VALUES (0, 'Infinity', 'inf'::DOUBLE), (1, '3.0', 3.0::DOUBLE),
            (2, '-Infinity', '-inf'::DOUBLE), (3, '40.0', 40.0::DOUBLE)) v(step, threshold, t)),
        c AS (SELECT CAST(step AS INTEGER) AS step, threshold, count(*) FILTER (label = 1 AND score >= t) AS tp, count(*) FILTER (label = 0 AND score >= t) AS fp,
            count(*) FILTER (label = 0 AND score < t) AS tn, count(*) FILTER (label = 1 AND score < t) AS fn FROM scored, g GROUP BY 1, 2)
        SELECT step, threshold, tp, fp, tn, fn, {_columns(BASIC_SQL)} FROM c""",
    "one_class_metrics": f"""{_HEAD}, one AS (SELECT * FROM scored WHERE label = 1), {_counts('one')}
        SELECT tp, fp, tn, fn, 0.0::DOUBLE AS "precision", 0.0::DOUBLE AS recall, {r('tp::DOUBLE / (tp + fn)')} AS accuracy,
            {r('tp::DOUBLE / (tp + fn)')} AS detection_rate, 0.0::DOUBLE AS false_alarm_rate FROM cm""",
    "recommendations_poor": """SELECT unnest(['High false alarm rate - consider adjusting threshold',
        'Low detection rate - model may need retraining', 'Low workload efficiency - many false alerts']) AS recommendation""",
    "precision_at_k_labels": "WITH j AS (SELECT l.doc_id AS row_id, toxic AS label, n_chars::DOUBLE AS score "
                             f"FROM labels l JOIN documents d ON l.doc_id = d.doc_id) {_at_k('j')}",
    "top_scored": f"""{_HEAD} SELECT row_id, label, score, CAST(rn AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (ORDER BY score DESC, row_id) AS rn FROM scored) t WHERE rn <= 500""",
    "score_steps": f"{_HEAD}, {CURVE} SELECT score, pos, neg, tp, fp FROM steps",
    "roc_auc": f"{_HEAD}, {CURVE} SELECT {r(_AUC)} AS roc_auc FROM steps, tot",
    "fpr_at_tpr": f"{_HEAD}, {CURVE} SELECT {r(_FPR_AT)} AS fpr_at_tpr, {r(_TPR_AT)} AS tpr_at_fpr",
    "fpr_at_tpr_best_ties": f"{_HEAD}, {CURVE} SELECT {r(_FPR_BEST)} AS fpr_at_tpr, {r(_TPR_BEST)} AS tpr_at_fpr",
    "average_precision": f"{_HEAD}, {CURVE} SELECT {r(_AP)} AS pr_auc FROM steps, tot",
    "recall_at_precision": f"{_HEAD}, {CURVE} SELECT {r(_RAP)} AS recall_at_precision FROM steps, tot",
    "roc_points": f"{_HEAD}, {CURVE} SELECT {r('threshold')} AS threshold, fp, tp, {r('fpr')} AS fpr, {r('tpr')} AS tpr FROM corners",
    "pr_points": f"""{_HEAD}, {CURVE} SELECT {r('score')} AS threshold, {r('tp::DOUBLE / (tp + fp)')} AS "precision",
        {r('tp / p')} AS recall FROM steps, tot UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE""",
    "threshold_sweep": f"""{_HEAD}, ends AS (SELECT min(score) AS lo, max(score) AS hi FROM scored),
        grid AS (SELECT CAST(i AS INTEGER) AS step, CASE WHEN i = 99 THEN hi ELSE lo + i * ((hi - lo) / 99) END AS threshold
                 FROM range(100) t(i), ends),
        cm AS (SELECT step, threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp,
            count(*) FILTER (label = 0 AND score >= threshold) AS fp, count(*) FILTER (label = 0 AND score < threshold) AS tn,
            count(*) FILTER (label = 1 AND score < threshold) AS fn FROM grid, scored GROUP BY step, threshold)
        SELECT {r('threshold')} AS threshold, step, tp, fp, tn, fn, {_columns(BASIC_SQL)} FROM cm""",
    "evaluate_all": f"""{_HEAD}, {_counts('scored')}, {CURVE}, at_k AS ({_at_k('scored')}),
        cv AS (SELECT {r(_AUC)} AS roc_auc, {r(_AP)} AS pr_auc, {r(_RAP)} AS recall_at_precision FROM steps, tot)
        SELECT tp, fp, tn, fn, {_FLAG_SQL}, at_k.*, cv.*, {r(_FPR_AT)} AS fpr_at_tpr, {r(_TPR_AT)} AS tpr_at_fpr
        FROM cm, at_k, cv""",
    "evaluation_report": _report_sql(),
    "recommendations": f"""{_HEAD}, {_counts('scored')}
        SELECT 'High false alarm rate - consider adjusting threshold' AS recommendation FROM cm
          WHERE {OPERATIONAL_SQL['false_alarm_rate']} > 0.05
        UNION ALL SELECT 'Low detection rate - model may need retraining' FROM cm WHERE {OPERATIONAL_SQL['detection_rate']} < 0.8
        UNION ALL SELECT 'High alert burden - consider alert prioritization' FROM cm WHERE {_PER_DAY} / 8 > 10
        UNION ALL SELECT 'Low workload efficiency - many false alerts' FROM cm WHERE {WORKLOAD_SQL['workload_efficiency']} < 0.1""",
    "method_comparison": f"{_METHODS_SQL} SELECT method, tp, fp, tn, fn, {_FLAG_SQL} FROM cm",
    "best_method": f"""{_METHODS_SQL} SELECT method, {r(BASIC_SQL['accuracy'])} AS accuracy FROM cm
        ORDER BY {BASIC_SQL['accuracy']} DESC, list_position(['value', 'deviation', 'gap'], method) LIMIT 1""",
}
