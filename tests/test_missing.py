"""Missing and infinite values, labels other than 0 and 1, and the package on other folders' workers."""

import math
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from logwarden.functions import features, pii
from logwarden.operators import curves, inject, metrics, profile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bounds_keep_missing_values(spark):
    rows = spark.createDataFrame([(0, -5.0), (1, None), (2, math.nan), (3, 170.0), (4, 40.0)], "i int, cpu_usage double")
    clean = features.cap_percentages(features.floor_at_zero(rows, ["cpu_usage"]), ["cpu_usage"])
    got = {r["i"]: r["cpu_usage"] for r in clean.collect()}
    assert (got[0], got[1], got[3], got[4]) == (0.0, None, 100.0, 40.0) and math.isnan(got[2])


def test_injection_keeps_missing_values(spark):
    names = ["cpu_usage", "memory_usage", "disk_usage", "bytes_sent", "bytes_received", "process_count"]
    rows = spark.range(200).select(F.col("id").alias("row_id"), *[F.lit(None).cast("double").alias(c) for c in names],
                                   F.lit(5).cast("bigint").alias("active_connections"))
    changed = inject.inject_anomalies(rows, 0.5)
    assert changed.where(" or ".join(f"{c} is not null" for c in names)).isEmpty()


def test_infinite_thresholds(spark):
    rows = spark.createDataFrame([(1, 0.2), (0, 0.4), (1, 0.7), (0, math.inf), (1, -math.inf)], "label int, score double")
    asked = [math.inf, 0.5, -math.inf, 0.5]
    got = sorted((r["threshold"], r["tp"], r["fp"], r["tn"], r["fn"]) for r in metrics.threshold_sweep(rows, asked).collect())
    assert got == [(-math.inf, 3, 2, 0, 0), (0.5, 1, 1, 1, 2), (0.5, 1, 1, 1, 2), (math.inf, 0, 1, 1, 3)]
    with pytest.raises(ValueError):
        metrics.threshold_sweep(rows, [math.nan])


def test_null_address_and_null_point(spark):
    rows = spark.createDataFrame([(1, None, 1.0, 2.0, 0, 0), (2, "ip_0", None, 3.0, 0, 1), (3, "x", 5.0, 4.0, 1, 1)],
                                 "row_id int, ip string, x double, y double, label int, pred int")
    assert [r[0] for r in rows.orderBy("row_id").select(pii.pseudonymous_ip(F.col("ip"))).collect()][:2] == [None, "192.168.107.203"]
    grid = {(r["bin_x"], r["bin_y"], r["outcome"]): r["n"] for r in profile.scatter_grid(rows, "x", "y", 2).collect()}
    assert grid == {(0, 0, "TN"): 1, (None, 1, "FP"): 1, (1, 1, "TP"): 1}


@pytest.mark.parametrize("bad", [2, None])
def test_other_labels_are_refused(spark, bad):
    rows = spark.createDataFrame([(0, 0, 0.1, 0), (1, 1, 0.2, 1), (2, bad, 0.3, 1)], "row_id int, label int, score double, pred int")
    for made in (lambda: metrics.confusion_counts(rows), lambda: profile.score_histogram(rows), lambda: profile.outcome_counts(rows),
                 lambda: profile.class_summary(rows, ["score"]), lambda: profile.feature_histogram(rows, "score"),
                 lambda: curves.score_steps(rows)):
        with pytest.raises(Exception):
            made().collect()
    flags = rows.withColumnsRenamed({"pred": "label", "label": "pred"})
    with pytest.raises(Exception):
        metrics.confusion_counts(flags).collect()


def test_curve_ranges_stay_even_under_ties(spark):
    """99 % of the rows tie at one score; the ranges hold distinct scores."""
    rows = spark.range(100_000).select((F.col("id") % 7 == 0).cast("int").alias("label"),
                                       F.when(F.col("id") < 1000, F.col("id").cast("double")).otherwise(5000.0).alias("score"))
    steps = curves.score_steps(rows, rows_per_range=50)
    assert steps.count() == 1001
    top = steps.orderBy(F.col("score")).first()
    assert (top["tp"], top["fp"]) == (14286, 85714)


def test_workers_find_the_package(tmp_path):
    """A driver started elsewhere, without PYTHONPATH, runs a query that needs Python workers."""
    code = (f"import importlib.util as u; s = u.spec_from_file_location('entry', {os.path.join(ROOT, '__spark_entry__.py')!r}); "
            "e = u.module_from_spec(s); s.loader.exec_module(e); from pyspark.sql import SparkSession; "
            "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
            "print('rows', e.queries()['isolation_forest'](spark, '/root/testdata/sf0.001').count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1000" in done.stdout, done.stderr[-2000:]
