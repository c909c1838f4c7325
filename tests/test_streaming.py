import pytest
from pyspark.sql import functions as F

from logwarden.common import work_path
from logwarden.detectors import make_detector
from logwarden.functions.pii import anonymise
from logwarden.streaming import jobs

SCHEMA = "row_id bigint, user_id bigint, ts timestamp, value double"


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("user_id"),
        F.timestamp_seconds(F.col("id") * 300).alias("ts"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10.0).alias("value"))
    return df.withColumns({"user_id": F.col("user_id").cast("bigint")}).persist()


@pytest.fixture(scope="module")
def folder(spark, rows):
    """Six files in time order, one per micro-batch."""
    path = work_path(spark, "source")
    for i in range(6):
        rows.where(f"row_id div 100 = {i}").coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, rows, folder):
    return jobs.stream_table(spark, folder, rows.schema, max_files=1)


def flagged(df):
    return df.withColumn("pred", (F.col("value") > 90).cast("int"))


def test_scores_equal_batch(spark, rows, folder):
    for detector in (make_detector("deviation", features=["value"]),
                     make_detector("isolation_forest", features=["value"], n_trees=5, max_samples=64)):
        model = detector.fit(rows)
        out = jobs.score_stream(stream(spark, rows, folder), model).select("row_id", "score", "pred")
        path = work_path(spark, "scored")
        jobs.finished(jobs.append_stream(out, path))
        assert sorted(jobs.appended_table(spark, path, out.schema).collect()) == sorted(
            model.score(rows).select("row_id", "score", "pred").collect())


def test_restart_adds_nothing(spark, rows, folder):
    out = flagged(stream(spark, rows, folder)).select("row_id", "pred")
    path = work_path(spark, "restart")
    jobs.finished(jobs.append_stream(out, path))
    jobs.finished(jobs.append_stream(out, path))
    assert jobs.appended_table(spark, path, out.schema).count() == 600


def windows_of(df):
    return {(r["start"], r["events"], r["alerts"]) for r in df.collect()}


def test_windows_equal_batch_over_many_micro_batches(spark, rows, folder):
    live = jobs.alert_windows(flagged(stream(spark, rows, folder)))
    path = work_path(spark, "windows")
    jobs.finished(jobs.upsert_stream(live, path))
    got = windows_of(jobs.latest_table(spark, path, live.schema, ["start", "end"]))
    batch = flagged(rows).groupBy(F.window("ts", "1 hour").start.alias("start")).agg(
        F.count("*").alias("events"), F.sum("pred").alias("alerts"))
    assert got == windows_of(batch)


def test_append_gives_closed_windows_only(spark, rows, folder):
    live = jobs.alert_windows(flagged(stream(spark, rows, folder)), length="6 hours", delay="1 hour")
    path = work_path(spark, "closed")
    jobs.finished(jobs.append_stream(live, path))
    got = jobs.appended_table(spark, path, live.schema)
    assert got.count() == 8 and got.agg(F.sum("events")).first()[0] == 576


def test_rows_behind_the_watermark_do_not_change_closed_windows(spark, rows):
    path = work_path(spark, "late")
    for part in (rows.where("row_id < 300"), rows.where("row_id between 300 and 400"),
                 rows.where("row_id < 5").withColumn("value", F.lit(99.0)), rows.where("row_id > 590")):
        part.coalesce(1).write.mode("append").parquet(path)
    live = jobs.alert_windows(flagged(stream(spark, rows, path)))
    out = work_path(spark, "late-out")
    jobs.finished(jobs.append_stream(live, out))
    first = jobs.appended_table(spark, out, live.schema).orderBy("start").first()
    assert first["events"] == 12


def test_recent_rows_per_entity(spark, rows, folder):
    live = jobs.recent_stream(flagged(stream(spark, rows, folder)), "user_id", keep=15)
    path = work_path(spark, "recent")
    jobs.finished(jobs.upsert_stream(live, path))
    got = {r["user_id"]: (r["rows"], r["flagged"]) for r in
           jobs.latest_table(spark, path, live.schema, ["user_id"]).collect()}
    by_user = {}
    for r in sorted(flagged(rows).collect(), key=lambda r: (r["ts"], r["row_id"])):
        by_user.setdefault(r["user_id"], []).append(r["pred"])
    assert got == {u: (len(p[-15:]), sum(p[-15:])) for u, p in by_user.items()}


def test_privacy_equals_batch(spark, rows, folder):
    out = jobs.private_stream(stream(spark, rows, folder)).select("row_id", "user_id")
    path = work_path(spark, "private")
    jobs.finished(jobs.append_stream(out, path))
    assert sorted(jobs.appended_table(spark, path, out.schema).collect()) == sorted(
        anonymise(rows).select("row_id", "user_id").collect())


def test_models_that_need_more_than_a_row_are_refused(spark, rows, folder):
    sequence = make_detector("sequence", features=["value"], base="linear", sequence_length=3).fit(rows)
    ensemble = make_detector("ensemble", detectors=[make_detector("deviation", features=["value"])],
                             threshold_on="batch").fit(rows)
    nested = make_detector("ensemble", detectors=[make_detector("deviation", features=["value"])]).fit(rows)
    nested.members.append(sequence)
    for model in (sequence, ensemble, nested):
        with pytest.raises(ValueError):
            jobs.score_stream(stream(spark, rows, folder), model)


def test_silent_entities_are_forgotten(spark):
    path = work_path(spark, "silent")
    for start, users in ((0, (1, 2)), (10_000, (2,)), (20_000, (2,)), (30_000, (1, 2))):
        rows = [(start + 10 * i + u, u, float(start + i), 1) for u in users for i in range(3)]
        part = spark.createDataFrame(rows, "row_id bigint, user_id bigint, s double, pred int")
        part.select("row_id", "user_id", F.timestamp_seconds("s").alias("ts"), "pred").coalesce(1).write.mode("append").parquet(path)
    kind = spark.read.parquet(path).schema
    live = jobs.recent_stream(jobs.stream_table(spark, path, kind, max_files=1), "user_id", keep=5, expire="1 hour")
    out = work_path(spark, "silent-out")
    jobs.finished(jobs.upsert_stream(live, out))
    got = {r["user_id"]: r["rows"] for r in jobs.latest_table(spark, out, live.schema, ["user_id"]).collect()}
    # Entity 2 has rows in every micro-batch, so it never falls silent.
    assert got == {1: 3, 2: 5}
    kept = jobs.recent_stream(jobs.stream_table(spark, path, kind, max_files=1), "user_id", keep=5)
    out = work_path(spark, "kept-out")
    jobs.finished(jobs.upsert_stream(kept, out))
    assert {r["user_id"]: r["rows"] for r in jobs.latest_table(spark, out, kept.schema, ["user_id"]).collect()} == {1: 5, 2: 5}
