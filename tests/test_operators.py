import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.common import portable_hash, work_path
from logwarden.detectors import make_detector
from logwarden.functions import features as ft
from logwarden.operators import audit, explain, inject, profile, quality
from logwarden.operators.metrics import flag_metrics, metrics_long
from logwarden.operators.scoring import attach_scores
from logwarden.sources import reports, tables


def host(spark, n=200):
    return spark.range(n).select(
        F.col("id").alias("row_id"), F.lit(30.0).alias("cpu_usage"), F.lit(60.0).alias("memory_usage"),
        F.lit(30.0).alias("disk_usage"), F.lit(1000.0).alias("bytes_sent"), F.lit(2000.0).alias("bytes_received"),
        F.lit(10).cast("bigint").alias("active_connections"), F.lit(100.0).alias("process_count"))


def test_derived_columns_golden(spark):
    row = ft.derive_features(host(spark, 1)).first()
    assert row["cpu_memory_ratio"] == pytest.approx(30 / (60 + 1e-6), abs=1e-12)
    assert (row["network_activity"], row["resource_pressure"]) == (3000.0, 40.0)


def test_injection_goldens_and_exact_count(spark):
    rows = inject.inject_anomalies(host(spark), 0.25).collect()
    chosen = [r for r in rows if r["anomaly_label"] == 1]
    assert len(chosen) == 50 and all(r["pattern"] is None for r in rows if r["anomaly_label"] == 0)
    expect = {"cpu_spike": (90.0, 90.0, 30.0), "memory_leak": (36.0, 100.0, 30.0), "network_flood": (30.0, 60.0, 30.0),
              "process_explosion": (60.0, 60.0, 30.0), "disk_full": (39.0, 60.0, 60.0)}
    for r in chosen:
        assert (r["cpu_usage"], r["memory_usage"], r["disk_usage"]) == pytest.approx(expect[r["pattern"]])
        flood = r["pattern"] == "network_flood"
        assert (r["bytes_sent"], r["bytes_received"]) == ((5000.0, 10000.0) if flood else (1000.0, 2000.0))
        assert r["active_connections"] == (40 if flood else 10)
        assert r["network_activity"] == r["bytes_sent"] + r["bytes_received"]
    assert {r["pattern"] for r in chosen} == set(inject.PATTERNS)


@pytest.mark.parametrize("share,count", [(0.0, 0), (0.05, 5), (0.1, 10), (0.2, 20), (1.0, 100)])
def test_injection_counts(spark, share, count):
    df = host(spark, 100)
    first = {r["row_id"] for r in inject.inject_anomalies(df, share).where("anomaly_label = 1").collect()}
    again = {r["row_id"] for r in inject.inject_anomalies(df.repartition(5), share).where("anomaly_label = 1").collect()}
    assert len(first) == count and first == again
    with pytest.raises(ValueError):
        inject.inject_anomalies(df, 1.5)


def test_equal_hashes_are_split_by_row_id(spark, monkeypatch):
    monkeypatch.setattr(inject, "portable_hash", lambda *k, seed=0: F.lit(7).cast("bigint"))
    df = host(spark, 40)
    chosen = df.where(inject.choose_exactly(df, 0.25, "row_id", 1)).select("row_id").collect()
    assert sorted(r[0] for r in chosen) == list(range(10))


def test_floor_applies_everywhere_and_cap_to_percentages(spark):
    df = spark.createDataFrame([(-1.0, 150.0, -3)], "cpu_usage double, memory_usage double, n bigint")
    row = ft.cap_percentages(ft.floor_at_zero(df, ["cpu_usage", "memory_usage", "n"]), ["cpu_usage", "memory_usage"])
    assert row.first() == (0.0, 100.0, 0) and dict(row.dtypes)["n"] == "bigint"


def test_iqr_goldens_and_findings(spark):
    df = spark.createDataFrame([(float(v), None if v == 3 else 1.0) for v in (1, 2, 3, 4, 100)],
                               "cpu_usage double, memory_usage double")
    row = quality.iqr_outliers(df, ["cpu_usage"]).first()
    assert (row["q1"], row["q3"], row["low"], row["high"], row["outliers"]) == (2.0, 4.0, -1.0, 7.0, 1)
    found = {(r["severity"], r["check"], r["n"]) for r in quality.validate_table(df).collect()}
    assert found == {("warning", "missing_values", 1), ("warning", "outliers", 1)}
    assert quality.is_valid(quality.validate_table(df))
    bad = quality.validate_table(df.select(F.lit("x").alias("name")))
    assert not quality.is_valid(bad)
    assert {r["check"] for r in bad.collect()} == {"required_column", "numeric_columns"}


def test_matrix_and_parts(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (float("-inf"), -1.0), (None, 2.0)], "a double, b double")
    found = {(r["check"], r["column"]): r["n"] for r in quality.validate_matrix(df).collect()}
    assert found == {("nan", "a"): 1, ("infinite", "a"): 1, ("negative", "a"): 1, ("negative", "b"): 1}
    assert quality.validate_parts({"data": df}) == ["labels"]


def test_zscore_explanation_golden(spark):
    df = spark.createDataFrame([(0, 1.0, 10.0), (1, 2.0, 20.0), (2, 3.0, 30.0), (3, 4.0, 40.0), (4, 100.0, 25.0)],
                               "row_id bigint, f1 double, f2 double")
    asked = df.where("row_id = 4").select("row_id")
    rows = explain.explain(df, asked, baseline="asked").collect()
    assert [(r["rank"], r["feature"]) for r in rows] == [(1, "f1"), (2, "f2")]
    assert rows[0]["z_score"] == pytest.approx(87.206650, abs=1e-6)
    assert (rows[0]["normal_mean"], rows[1]["normal_mean"], rows[1]["z_score"]) == (2.5, 25.0, 0.0)
    assert rows[0]["normal_std"] == pytest.approx(1.118034, abs=1e-6)
    nested = explain.nested_explanation(df, asked=asked, baseline="asked").first()
    assert [t["feature"] for t in nested["top_features"]] == ["f1", "f2"]
    with pytest.raises(ValueError):
        explain.explain(df, asked, "guess")


def test_shapley_adds_up_and_matches_the_exact_value(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame([*rows, (300, 6.0, -1.0)], "row_id bigint, a double, b double")
    model = make_detector("deviation").fit(df)
    asked = df.where("row_id = 300").select("row_id")
    got = {r["feature"]: r for r in explain.explain(df, asked, "shapley", model, permutations=400, background=50).collect()}
    base = explain.background_rows(df, "row_id", 50).collect()
    m, s = np.array(model.scale.means), np.array(model.scale.stds)

    def value(a, b):
        return np.abs((np.array([a, b]) - m) / s).max()

    exact_a = np.mean([0.5 * (value(6.0, r["b"]) - value(r["a"], r["b"]) + value(6.0, -1.0) - value(r["a"], -1.0))
                       for r in base])
    whole = value(6.0, -1.0) - np.mean([value(r["a"], r["b"]) for r in base])
    assert got["a"]["rank"] == 1 and got["a"]["contribution"] == pytest.approx(exact_a, abs=0.2)
    assert got["a"]["prediction_score"] == pytest.approx(whole, abs=0.2)
    assert got["a"]["prediction_score"] == pytest.approx(got["a"]["contribution"] + got["b"]["contribution"])


def test_attach_scores_checks_the_keys(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "row_id bigint, label int")
    scores = spark.createDataFrame([(1, 0.5), (2, 0.7)], "row_id bigint, score double")
    assert attach_scores(labels, scores).count() == 2
    with pytest.raises(Exception, match="duplicate"):
        attach_scores(labels.unionByName(labels), scores).collect()
    with pytest.raises(Exception, match="no score"):
        attach_scores(labels, scores.where("row_id = 1")).collect()
    big = spark.range(1000).withColumnRenamed("id", "row_id")
    with_scores = attach_scores(big.withColumn("label", F.lit(0)), big.withColumn("score", F.rand(1)).hint("merge"))
    assert with_scores._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_histogram_counts_every_row(spark):
    df = spark.createDataFrame([(i % 2, float(i)) for i in range(100)] + [(0, 500.0)], "label int, score double")
    rows = profile.score_histogram(df).collect()
    assert len(rows) == 100 and sum(r["n"] for r in rows) == 101
    flat = profile.score_histogram(df.withColumn("score", F.lit(1.0))).collect()
    assert sum(r["n"] for r in flat) == 101
    total = sum(r["density"] for r in rows if r["class"] == 0) * (500.0 - 0.0) / 50
    assert total == pytest.approx(1.0)


def test_guarded_processing_and_audit(spark):
    df = spark.createDataFrame([("u1", 1.0, 2.0, "a@b.cd"), ("u2", 1.0, None, "x")],
                               "user_id string, cpu_usage double, memory_usage double, note string")
    assert {r["note"] for r in audit.process(df, "score")[0].collect()} == {"a@b.cd", "x"}
    clean, findings, events = audit.process(df, "score", settings=audit.PrivacySettings(redact_text=True))
    row = clean.orderBy("cpu_usage", F.col("note")).collect()
    assert {r["note"] for r in row} == {"[REDACTED]", "x"} and all(r["user_id"].startswith("usr_") for r in row)
    assert [r["event_type"] for r in events.collect()] == ["data_access", "data_validation_warning"]
    with pytest.raises(audit.InvalidData) as stopped:
        audit.process(df.drop("cpu_usage"))
    assert [r["event_type"] for r in stopped.value.audit.collect()] == ["data_access", "data_validation_failed"]
    path = work_path(spark, "audit")
    audit.append_events(events, path)
    audit.append_events(audit.model_operation(spark, "train", "deviation", "u9"), path)
    back = audit.read_audit(spark, path)
    assert back.count() == 3 and audit.audit_tail(back, 2).count() == 2
    report = audit.privacy_report(back).first()
    assert (report["total_events"], report["recent_events"], report["compliance_status"]) == (3, 3, "COMPLIANT")
    settings = audit.PrivacySettings(hash_user_ids=False, gdpr_compliant=False)
    kept_ids, _, _ = audit.process(df, settings=settings)
    assert {r["user_id"] for r in kept_ids.collect()} == {"u1", "u2"}
    assert audit.privacy_report(back, settings).first()["compliance_status"] == "NON_COMPLIANT"


def test_table_and_history_round_trips(spark):
    logs = inject.inject_anomalies(host(spark, 50), 0.1).withColumn(
        "timestamp", F.timestamp_seconds(F.col("row_id") * 7200)).drop("pattern")
    path = work_path(spark, "logs")
    tables.save_logs(logs, path)
    back = tables.load_logs(spark, path, logs.schema)
    assert back.data.count() == 50 and back.label == "anomaly_label"
    assert "cpu_usage" in back.features and not {"row_id", "timestamp", "anomaly_label"} & set(back.features)
    day = back.data.where("event_date = date'1970-01-02'")
    assert "PartitionFilters: [isnotnull" in day._jdf.queryExecution().executedPlan().toString()
    scored = back.data.select("row_id", F.col("anomaly_label").alias("label"), F.col("anomaly_label").alias("pred"))
    history = work_path(spark, "history")
    reports.append_history(metrics_long(flag_metrics(scored), "run-1"), history)
    reports.append_history(metrics_long(flag_metrics(scored), "run-2"), history)
    out = work_path(spark, "csv")
    whole = spark.read.schema(reports.METRIC_SCHEMA).parquet(history)
    assert reports.export_history(whole, out)
    assert reports.load_history(spark, out).where("metric = 'accuracy'").count() == 2
    assert not reports.export_history(whole.where("run_id = 'none'"), work_path(spark, "csv"))


def test_append_needs_equal_columns(spark):
    with pytest.raises(Exception):
        tables.append_batch(host(spark), host(spark).drop("cpu_usage")).collect()


def test_hash_is_the_sha256_prefix(spark):
    import hashlib
    got = spark.range(1).select(portable_hash("id", seed=42)).first()[0]
    assert got == int(hashlib.sha256(b"0|42").hexdigest()[:13], 16)
