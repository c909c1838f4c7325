"""Compaction, restarts and joins of streams against the same work in batch."""

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import TimerValues

from logwarden.common import work_path
from logwarden.streaming import jobs

KIND = "row_id bigint, user_id bigint, s double, pred int"


def put(spark, path, rows):
    part = spark.createDataFrame(rows, KIND).select("row_id", "user_id", F.timestamp_seconds("s").alias("ts"), "pred")
    part.coalesce(1).write.mode("append").parquet(path)


def many(spark, batches, users=7):
    """A folder of small files, to be read one at a time, and all of their rows."""
    draw, path, rows = np.random.default_rng(4), work_path(spark, "many"), []
    for b in range(batches):
        part = [(b * 100 + i, int(draw.integers(0, users)), float(b * 600 + draw.integers(0, 600)), int(draw.integers(0, 2))) for i in range(9)]
        put(spark, path, part)
        rows += part
    return path, rows


def stream(spark, path):
    return jobs.stream_table(spark, path, spark.read.parquet(path).schema, max_files=1)


def versions(stream):
    """Every row as a version of its user's place in the batch; later micro-batches send the same keys again."""
    return stream.select((F.col("row_id") % 100).alias("place"), "row_id", "pred")


def newest(rows):
    return {i % 100: (i, pred) for i, _, _, pred in rows}


def got(table):
    return {r["place"]: (r["row_id"], r["pred"]) for r in table.collect()}


def folders(spark, out):
    """How many micro-batches a reader meets, and how many are still there."""
    manifest = jobs.Manifest.read(spark, out)
    names = [int(n.split("=")[1]) for n in jobs.Files(spark, out).names(f"{out}/table") if n.startswith(jobs.BATCH)]
    return sum(n > manifest.upto for n in names), len(names)


def test_fifty_micro_batches_stay_few_folders(spark):
    path, rows = many(spark, 50)
    out = work_path(spark, "compacted")
    live = versions(stream(spark, path))
    jobs.finished(jobs.upsert_stream(live, out, ["place"], every=6))
    assert got(jobs.latest_table(spark, out, live.schema, ["place"])) == newest(rows)
    read, kept = folders(spark, out)
    assert read <= 6 and kept <= 13
    assert len(jobs.Files(spark, out).names(f"{out}/snapshots")) <= 2 and len(jobs.Files(spark, out).names(f"{out}/manifest")) <= 4


@pytest.mark.parametrize("point", ["write", "sweep"])
def test_crash_while_compacting(spark, monkeypatch, point):
    """Before the new manifest is in place the old one counts; after it the old files are of no use. Both go on."""
    path, rows = many(spark, 14)
    out = work_path(spark, "crashed")
    live = versions(stream(spark, path))
    calls, write, remove = [], jobs.Manifest.write, jobs.Files.remove

    def crash(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return (write if point == "write" else remove)(*args)

    with monkeypatch.context() as m:
        m.setattr(*((jobs.Manifest, "write", crash) if point == "write" else (jobs.Files, "remove", crash)))
        with pytest.raises(StreamingQueryException, match="lost"):
            jobs.finished(jobs.upsert_stream(live, out, ["place"], every=3))
    done = max(int(n.split("=")[1]) for n in jobs.Files(spark, out).names(f"{out}/table") if "=" in n) + 1
    assert done < 14
    assert got(jobs.latest_table(spark, out, live.schema, ["place"])) == newest(rows[:9 * done])
    jobs.finished(jobs.upsert_stream(versions(stream(spark, path)), out, ["place"], every=3))
    assert got(jobs.latest_table(spark, out, live.schema, ["place"])) == newest(rows)


def last_of(rows, keep):
    by_user = {}
    for i, u, s, pred in sorted(rows, key=lambda r: (r[2], r[0])):
        by_user.setdefault(u, []).append(pred)
    return {u: (len(p[-keep:]), sum(p[-keep:])) for u, p in by_user.items()}


def test_recent_events_after_a_restart(spark):
    """The list state goes on where the job stopped, and stays short."""
    path, rows = many(spark, 6)
    out = work_path(spark, "restarted")
    live = jobs.recent_stream(stream(spark, path), "user_id", keep=4)
    jobs.finished(jobs.upsert_stream(live, out, ["user_id"], every=2))
    more = [(9000 + i, i % 9, 4000.0 + i, i % 2) for i in range(60)]
    put(spark, path, more)
    live = jobs.recent_stream(stream(spark, path), "user_id", keep=4)
    jobs.finished(jobs.upsert_stream(live, out, ["user_id"], every=2))
    table = jobs.recent_table(spark, out, live.schema, "user_id")
    assert {r["user_id"]: (r["rows"], r["flagged"]) for r in table.collect()} == last_of(rows + more, 4)
    state = (spark.read.format("statestore").option("stateVarName", "events").option("flattenCollectionTypes", False)
             .load(f"{out}/checkpoint"))
    sizes = [len(r["list_value"]) for r in state.select("list_value").collect()]
    assert len(sizes) == 9 and max(sizes) <= 8


def test_expired_entities_leave_the_table(spark):
    path = work_path(spark, "expiring")
    for start, users in ((0, (1, 2)), (10_000, (2,)), (20_000, (2,))):
        put(spark, path, [(start + 10 * i + u, u, float(start + i), 1) for u in users for i in range(3)])
    out = work_path(spark, "expired")
    live = jobs.recent_stream(stream(spark, path), "user_id", keep=5, expire="1 hour")
    jobs.finished(jobs.upsert_stream(live, out))
    assert [(r["user_id"], r["rows"]) for r in jobs.recent_table(spark, out, live.schema, "user_id").collect()] == [(2, 5)]
    gone = jobs.latest_table(spark, out, live.schema, ["user_id"]).where("user_id = 1").first()
    assert (gone["rows"], gone["flagged"], gone["last_at"]) == (0, 0, None)


def test_entities_that_never_expire(spark):
    path, rows = many(spark, 3)
    out = work_path(spark, "kept")
    live = jobs.recent_stream(stream(spark, path), "user_id", keep=3, expire=None)
    jobs.finished(jobs.upsert_stream(live, out))
    assert {r["user_id"]: (r["rows"], r["flagged"]) for r in jobs.recent_table(spark, out, live.schema, "user_id").collect()} == last_of(rows, 3)


def test_labels_meet_rows_in_time(spark):
    scores, labels = work_path(spark, "scores"), work_path(spark, "labels")
    put(spark, scores, [(1, 1, 9000.0, 1), (2, 1, 9010.0, 0), (3, 1, 9020.0, 1), (4, 1, 9030.0, 0)])
    put(spark, scores, [(5, 1, 50_000.0, 1)])
    put(spark, scores, [(6, 1, 100_000.0, 1)])
    kind = "row_id bigint, s double, label int"
    for part in ([(1, 9060.0, 1), (2, 16_000.0, 1), (3, 9005.0, 0)], [(5, 50_100.0, 0), (4, 9040.0, 1)], [(9, 100_000.0, 1)]):
        rows = spark.createDataFrame(part, kind).select("row_id", F.timestamp_seconds("s").alias("label_ts"), "label")
        rows.coalesce(1).write.mode("append").parquet(labels)
    joined = jobs.label_stream(stream(spark, scores), stream(spark, labels), horizon="1 hour", delay="1 hour")
    out = work_path(spark, "joined")
    jobs.finished(jobs.append_stream(joined, out))
    got = {r["row_id"]: r["label"] for r in jobs.appended_table(spark, out, joined.schema).collect()}
    # 2: too late for the horizon; 3: before its row; 6: still open when the stream ends.
    assert got == {1: 1, 2: None, 3: None, 4: 1, 5: 0}


class Held:
    """A list state and timers in memory, with the number of calls."""

    def __init__(self):
        self.value, self.timers, self.calls = [], [], 0

    def getListState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return iter(self.value)

    def put(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.value = []

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


def test_an_entity_costs_few_state_calls():
    """One read and one write a micro-batch, whatever came; the timer is set once and moves when it fires."""
    held, recent = Held(), jobs.RecentEvents("user_id", 3, 1000)
    recent.init(held)
    come = Row("at", "row_id", "pred")
    for batch in range(10):
        rows = [come((batch * 100 + i) * 1000, batch * 100 + i, i % 2) for i in range(50)]
        shown, = recent.handleInputRows((7,), iter(rows[::-1]), TimerValues(0, batch * 100))
        assert tuple(shown) == (7, 3, 2, (batch * 100 + 49) * 1000)
    assert held.calls == 21 and held.timers == [1049]
    assert list(recent.handleExpiredTimer((7,), TimerValues(0, 1500), None)) == [] and held.timers[1:] == [1949]
    gone, = recent.handleExpiredTimer((7,), TimerValues(0, 1949), None)
    assert tuple(gone) == (7, 0, 0, None) and held.value == []
