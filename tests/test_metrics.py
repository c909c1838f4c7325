import pytest
from pyspark.sql import functions as F


from logwarden.operators import metrics
from tests.test_curves import scored

LABEL = [0, 0, 1, 1, 0, 1, 0, 0, 1, 0]
PRED = [0, 1, 1, 0, 0, 1, 0, 1, 1, 0]


def test_flag_metric_goldens(spark):
    row = metrics.flag_metrics(scored(spark, LABEL, [0.0] * 10, PRED)).first().asDict()
    expect = dict(tp=3, fp=2, tn=4, fn=1, precision=0.6, recall=0.75, f1_score=2 / 3, accuracy=0.7,
                  specificity=2 / 3, detection_rate=0.75, false_alarm_rate=1 / 3, miss_rate=0.25,
                  alert_efficiency=0.6, positive_predictive_value=0.6, negative_predictive_value=0.8,
                  total_alerts=5, alerts_per_day=12.0, investigation_hours=2.5, workload_efficiency=1.2,
                  alert_burden_per_analyst=1.5, overload_indicator=0.0, sensitivity=0.75)
    assert row == pytest.approx(expect)


def test_edge_tables(spark):
    one = metrics.flag_metrics(scored(spark, [0] * 5, [0.0] * 5, [0, 1, 0, 0, 0])).first()
    assert (one["precision"], one["recall"], one["specificity"], one["accuracy"]) == (0.0, 0.0, 0.0, 0.8)
    quiet = metrics.flag_metrics(scored(spark, LABEL, [0.0] * 10, [0] * 10)).first()
    assert quiet["precision"] == 0.0 and quiet["total_alerts"] == 0 and quiet["workload_efficiency"] == 0.0
    empty = metrics.flag_metrics(scored(spark, [], [])).first().asDict()
    assert empty.pop("miss_rate") == 1.0
    assert set(empty.values()) == {0}


def test_recommendations_and_report(spark):
    df = scored(spark, LABEL, [i / 10 for i in range(10)], PRED)
    row = metrics.evaluate(df)
    texts = [r[0] for r in metrics.recommendations(row).collect()]
    assert len(texts) == 2 and texts[0].startswith("High false alarm") and texts[1].startswith("Low detection")
    report = {(r["section"], r["metric"]): r["value"] for r in metrics.report_table(row).collect()}
    assert report["confusion", "tp"] == 3.0 and report["precision_at_k", "precision_at_500"] == 0.4
    assert len(report) == 5 + 4 + 4 + 5 + 4


def test_best_method_prefers_first_on_ties(spark):
    rows = [(m, i, a, p) for m in ("b", "a") for i, (a, p) in enumerate(zip(LABEL, PRED))]
    flags = spark.createDataFrame(rows, "method string, row_id bigint, label int, pred int")
    table = metrics.compare_methods(flags)
    assert metrics.best_method(table, ["b", "a"]).first()["method"] == "b"


def test_confusion_matrix_has_all_cells(spark):
    cells = {(r["label"], r["pred"]): r["n"]
             for r in metrics.confusion_matrix(scored(spark, LABEL, [0.0] * 10, [0] * 10)).collect()}
    assert cells == {(0, 0): 6, (0, 1): 0, (1, 0): 4, (1, 1): 0}


def test_labels_outside_the_classes_are_refused(spark):
    from logwarden.operators import profile
    from logwarden.operators.metrics import alerts_by_day, precision_at_k, threshold_sweep

    for wrong in (2, None):
        rows = spark.createDataFrame([(1, 0, 5.0), (2, 1, 4.0), (3, wrong, 0.5)], "row_id long, label int, score double")
        rows = rows.withColumn("pred", F.lit(1)).withColumn("ts", F.timestamp_seconds("row_id"))
        for use in (lambda d: precision_at_k(d, [1]), lambda d: threshold_sweep(d, [1.0]), alerts_by_day, profile.key_figures, profile.recent_activity):
            with pytest.raises(Exception, match="label is not 0 or 1"):
                use(rows).collect()
            assert use(rows.where("label in (0, 1)")).count() == 1
