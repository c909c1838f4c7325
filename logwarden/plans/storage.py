"""Registered queries: every sink written to the shared folder and read back through its source."""

from __future__ import annotations

from pyspark.sql import functions as F

from logwarden.common import work_path, written
from logwarden.detectors import make_detector
from logwarden.operators import audit
from logwarden.operators.metrics import compare_methods, flag_metrics, metrics_long
from logwarden.plans import evaluation, privacy
from logwarden.plans.base import (
    FEATS, FEATURES, HOST_EVENTS, SCORED, deviation_sql, host_events, log_features, r, rounded, scored_events, table)
from logwarden.sources import models, reports, tables


def log_table_round_trip(spark, sf_dir):
    """Host events written by event date and read back with a declared schema."""
    times = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), F.col("ts").alias("timestamp"))
    rows = host_events(spark, sf_dir).join(times, "row_id")
    path = work_path(spark, "logs")
    tables.save_logs(rows, path)
    return rounded(tables.load_logs(spark, path, rows.schema).data.drop(tables.EVENT_DATE))


def metric_history(spark, sf_dir):
    """Two runs appended to the history, exported as CSV and read back."""
    scored = scored_events(spark, sf_dir)
    path = work_path(spark, "history")
    for run, rows in (("all", scored), ("errors", scored.where("label = 1"))):
        reports.append_history(metrics_long(flag_metrics(rows).select("tp", "fp", "tn", "fn", "accuracy"), run), path)
    csv = work_path(spark, "history-csv")
    reports.export_history(spark.read.schema(reports.METRIC_SCHEMA).parquet(path), csv)
    return rounded(reports.load_history(spark, csv))


def comparison_csv(spark, sf_dir):
    comparison = rounded(compare_methods(evaluation.method_flags(spark, sf_dir)).select("method", "tp", "fp", "accuracy"))
    path = work_path(spark, "comparison")
    reports.export_comparison(comparison, path)
    return spark.read.schema(comparison.schema).option("header", True).csv(path)


def audit_csv(spark, sf_dir):
    path = work_path(spark, "audit-csv")
    reports.export_audit(privacy._audit_table(spark, sf_dir), path)
    schema = "timestamp timestamp, event_type string, description string, user_id string, ip_address string, additional_data string"
    back = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return back.select("event_type", "description", "additional_data")


def privacy_report_json(spark, sf_dir):
    report = audit.privacy_report(privacy._audit_table(spark, sf_dir))
    path = work_path(spark, "privacy-report")
    reports.export_privacy_report(report, path)
    return spark.read.schema(report.schema).json(path)


def model_round_trip(spark, sf_dir):
    rows = log_features(spark, sf_dir)
    path = work_path(spark, "model")
    models.save_model(spark, make_detector("deviation", features=FEATURES).fit(rows), path)
    return rounded(models.load_model(spark, path).score(rows).select("row_id", "score", "pred"))


def model_round_trip_arrays(spark, sf_dir):
    """Models with arrays, saved and loaded: how many rows score differently afterwards."""
    rows = written(log_features(spark, sf_dir), "log-rows")  # read in many passes, the gaps are found in one
    sequence = make_detector("sequence", features=["value", "k"], base="linear", components=2, sequence_length=3, limit=500_000)
    made = {"isolation_forest": make_detector("isolation_forest", features=FEATURES), "sequence": sequence,
            "autoencoder": make_detector("autoencoder", features=FEATURES, hidden_dims=(8, 4)),
            "ensemble": make_detector("ensemble", detectors=[make_detector("linear", features=FEATURES),
                                                             make_detector("isolation_forest", features=["value", "gap"])], normalise="rank")}
    out = []
    for name, detector in made.items():
        model, path = detector.fit(rows), work_path(spark, "model")
        models.save_model(spark, model, path)
        before = model.score(rows).select("row_id", F.col("score").alias("s"), F.col("pred").alias("p"))
        after = models.load_model(spark, path).score(rows).select("row_id", "score", "pred")
        same = F.col("s").eqNullSafe(F.col("score")) & F.col("p").eqNullSafe(F.col("pred"))
        out.append(before.join(after, "row_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("different"))
                   .select(F.lit(name).alias("method"), "rows", "different"))
    found = out[0]
    for part in out[1:]:
        found = found.unionByName(part)
    return found


QUERIES = {
    "log_table_round_trip": log_table_round_trip,
    "metric_history": metric_history,
    "comparison_csv": comparison_csv,
    "audit_csv": audit_csv,
    "privacy_report_json": privacy_report_json,
    "model_round_trip": model_round_trip,
    "model_round_trip_arrays": model_round_trip_arrays,
}

_RUN = "SELECT '{run}' AS run_id, '{m}' AS metric, {x} AS value FROM scored"
_PARTS = {"tp": "count(*) FILTER (label = 1 AND pred = 1)::DOUBLE", "fp": "count(*) FILTER (label = 0 AND pred = 1)::DOUBLE",
          "tn": "count(*) FILTER (label = 0 AND pred = 0)::DOUBLE", "fn": "count(*) FILTER (label = 1 AND pred = 0)::DOUBLE",
          "accuracy": r("count(*) FILTER (label = pred)::DOUBLE / count(*)")}
ORACLES = {
    "log_table_round_trip": f"""WITH {HOST_EVENTS} SELECT h.row_id, {', '.join(
        f"{r(c)} AS {c}" for c in ('cpu_usage', 'memory_usage', 'disk_usage', 'bytes_sent', 'bytes_received', 'process_count'))},
        active_connections, ts AS timestamp FROM hostev h JOIN events e ON h.row_id = e.event_id""",
    "metric_history": f"WITH {SCORED} " + " UNION ALL ".join(
        _RUN.format(run=run, m=m, x=x) + where for run, where in (("all", ""), ("errors", " WHERE label = 1"))
        for m, x in _PARTS.items()),
    "comparison_csv": f"""{evaluation._METHODS_SQL} SELECT method, tp, fp,
        {r(evaluation.BASIC_SQL['accuracy'])} AS accuracy FROM cm""",
    "audit_csv": f"{privacy._AUDIT_SQL} SELECT event_type, description, additional_data FROM a",
    "privacy_report_json": privacy.ORACLES["audit_summary"],
    "model_round_trip_arrays": """SELECT unnest(['isolation_forest', 'sequence', 'autoencoder', 'ensemble']) AS method,
        count(*) AS "rows", CAST(0 AS BIGINT) AS different FROM events""",
    "model_round_trip": f"WITH {FEATS}, {deviation_sql(FEATURES)} SELECT row_id, {r('score')} AS score, pred FROM dscored",
}
