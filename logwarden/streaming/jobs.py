"""Streaming jobs: scoring, windowed alerts, recent activity and privacy.

Each job takes a streaming table and a folder, runs until the query stops, and leaves a
table that ``spark.read`` can use. Model cut-offs come from the fitted model, never from the
micro-batch. Checkpoints live beside the table, so a restarted job goes on where it was.

Tables of changed rows keep one folder per micro-batch; every few of them are merged into a snapshot,
and a manifest, put in place by one rename, says which snapshot and which newer folders count.
"""

from __future__ import annotations

import json
import uuid
from array import array
from collections.abc import Callable, Iterator
from itertools import chain
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from logwarden.common import settings
from logwarden.detectors.base import Model
from logwarden.detectors.sequence import SequenceModel
from logwarden.functions.features import micros
from logwarden.functions.pii import anonymise, redact

BATCH = "_batch"
RECENT_ROWS = 100
HELD_ROWS = 100_000  # rows that a task holds while it looks for the last ones
EXPIRE = "90 days"  # silence after which an entity is forgotten
COMPACT_EVERY = 8  # micro-batches between two snapshots of an upsert table
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def stream_table(spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet",
                 max_files: int | None = None) -> DataFrame:
    """A Parquet folder as a stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def event_time(df: DataFrame, time: str = "ts") -> DataFrame:
    """Watermarks need a timestamp with time zone; zone-free ones are read in session time."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def append_stream(df: DataFrame, path: str) -> StreamingQuery:
    """Append to a Parquet table, exactly once, until the source is read."""
    return (df.writeStream.format("parquet").outputMode("append").option("path", f"{path}/table")
            .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())


def upsert_stream(df: DataFrame, path: str, keys: list[str] | None = None, every: int = COMPACT_EVERY) -> StreamingQuery:
    """Write each micro-batch of changed rows to its own folder, so that a repeated batch replaces itself.

    With ``keys`` every ``every``-th micro-batch merges what is there into a snapshot, so that readers never meet
    more than that many folders. State, where the job has any, lives in RocksDB.
    """
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table/{BATCH}={number}")
        if keys and number - Manifest.read(batch.sparkSession, path).upto >= every:
            compact(batch.sparkSession, path, df.schema, keys, number)

    with settings(df.sparkSession, STATE_STORE):  # a query keeps the settings it was started with
        return (df.writeStream.outputMode("update").foreachBatch(save)
                .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())


def finished(query: StreamingQuery) -> None:
    query.awaitTermination()


def appended_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/table")


class Files:
    """Folder listing, small files and renames in whatever file system the path is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.system = self.at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, path: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self.at(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(self.at(folder)))

    def text(self, path: str) -> str:
        stream = self.system.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def place(self, path: str, text: str) -> None:
        """A file that appears whole or not at all: written aside, then renamed."""
        aside = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self.system.create(self.at(aside))
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.system.rename(self.at(aside), self.at(path)):
            self.remove(aside)  # a repeated batch finds the manifest of its number in place

    def remove(self, path: str) -> None:
        self.system.delete(self.at(path), True)


class Manifest:
    """Which snapshot holds all micro-batches up to which number; -1 and none before the first one."""

    def __init__(self, upto: int, snapshot: str | None):
        self.upto, self.snapshot = upto, snapshot

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Manifest:
        """The newest one in place. One that is swept away while it is read was followed by a newer."""
        files = Files(spark, path)
        names = [n for n in files.names(f"{path}/manifest") if n.endswith(".json")]
        if not names:
            return cls(-1, None)
        told = json.loads(files.text(f"{path}/manifest/{names[-1]}"))
        return cls(told["upto"], told["snapshot"])

    def write(self, spark: SparkSession, path: str) -> None:
        Files(spark, path).place(f"{path}/manifest/{self.upto:012d}.json", json.dumps({"upto": self.upto, "snapshot": self.snapshot}))


def _versions(spark: SparkSession, path: str, schema: T.StructType, manifest: Manifest, upto: int | None = None) -> DataFrame:
    """The snapshot's rows and those of newer micro-batches, each with the number of its micro-batch."""
    fields = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    numbers = sorted(int(n.split("=")[1]) for n in Files(spark, path).names(f"{path}/table") if n.startswith(f"{BATCH}="))
    newer = [n for n in numbers if n > manifest.upto and (upto is None or n <= upto)]
    parts = [spark.createDataFrame([], fields)]
    if manifest.snapshot:
        parts.append(spark.read.schema(fields).parquet(f"{path}/{manifest.snapshot}"))
    if newer:
        read = spark.read.schema(fields).option("basePath", f"{path}/table")
        parts.append(read.parquet(*[f"{path}/table/{BATCH}={n}" for n in newer]))
    out = parts[-1] if len(parts) == 2 else parts[0]
    return parts[1].unionByName(parts[2]) if len(parts) == 3 else out


def _newest(versions: DataFrame, names: list[str], keys: list[str | Column]) -> DataFrame:
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*names), BATCH).alias("_row"))
    return newest.select(*[F.col("_row")[n].alias(n) for n in names])


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], upto: int) -> None:
    """Merge all micro-batches up to ``upto`` into a snapshot.

    Readers see the old manifest until the new one is renamed into place; a crash before that leaves an unused
    folder, a crash after it leaves folders that nobody reads. What the manifest before this one needed is
    swept only now, so that a reader that has just opened it still finds its files.
    """
    before = Manifest.read(spark, path)
    if upto <= before.upto:
        return
    names = [f.name for f in schema.fields]
    snapshot = f"snapshots/{upto:012d}-{uuid.uuid4().hex}"
    _newest(_versions(spark, path, schema, before, upto), [*names, BATCH], list(keys)).write.parquet(f"{path}/{snapshot}")
    Manifest(upto, snapshot).write(spark, path)
    files, now = Files(spark, path), Manifest.read(spark, path)
    for name in files.names(f"{path}/table"):
        if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) <= before.upto:
            files.remove(f"{path}/table/{name}")
    for name in files.names(f"{path}/manifest"):
        if name < f"{before.upto:012d}.json":
            files.remove(f"{path}/manifest/{name}")
    wanted = {m.snapshot for m in (before, now)}
    for name in files.names(f"{path}/snapshots"):
        if f"snapshots/{name}" not in wanted and int(name.split("-")[0]) <= now.upto:
            files.remove(f"{path}/snapshots/{name}")


def latest_table(spark: SparkSession, path: str, schema: T.StructType, keys: list[str | Column]) -> DataFrame:
    """The newest version of every key of an upsert table."""
    versions = _versions(spark, path, schema, Manifest.read(spark, path))
    return _newest(versions, [f.name for f in schema.fields], keys)


def recent_table(spark: SparkSession, path: str, schema: T.StructType, entity: str) -> DataFrame:
    """The newest row of every entity that has not been forgotten."""
    return latest_table(spark, path, schema, [entity]).where(F.col("rows") > 0)


def score_stream(stream: DataFrame, model: Model, on_null: str = "error") -> DataFrame:
    """The batch scoring path on a stream; sequence models need rows of several batches."""
    if not row_wise(model):
        raise ValueError("a stream needs a row-wise model with a stored cut-off")
    return model.score(stream, on_null=on_null)


def row_wise(model: Model) -> bool:
    """Whether a model and all its members score a row by itself, with a cut-off fitted before."""
    if isinstance(model, SequenceModel) or getattr(model, "threshold_on", "fit") == "batch":
        return False
    return all(row_wise(m) for m in getattr(model, "members", ()))


def alert_windows(scored: DataFrame, time: str = "ts", length: str = "1 hour", slide: str | None = None,
                  delay: str = "10 minutes", by: tuple[str, ...] = ()) -> DataFrame:
    """Events and alerts per event-time window; rows later than the delay are dropped."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return (event_time(scored, time).withWatermark(time, delay).groupBy(window, *by)
            .agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("pred") == 1).alias("alerts"))
            .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "events", "alerts"))


def _last_rows(keep: int, entity: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The last rows per entity of a whole partition, as long as they are few enough to hold."""
    def trim(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            both = frame if held is None else pd.concat([held, frame])
            held = both.sort_values([entity, "at", "row_id"]).groupby(entity, sort=False).tail(keep)
            if len(held) > HELD_ROWS:
                yield held
                held = None
        if held is not None:
            yield held
    return trim


class RecentEvents(StatefulProcessor):
    """The last events of an entity as list state of one element: their numbers, when to forget the entity, and its timer.

    An entity costs one read and one write a micro-batch. Its timer stays where it is while rows come; when it fires
    before the silence is over it is set again, else the entity is forgotten and a row that counts nothing says so.
    """

    def __init__(self, entity: str, keep: int, silence: int | None):
        self.keep, self.silence = keep, silence
        self.shown = Row(entity, "rows", "flagged", "last_at")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "numbers binary, until bigint, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = [(int(r["at"]), int(r["row_id"]), int(r["pred"])) for r in rows]
        timer = until = None
        for held, _, timer in self.events.get():
            numbers = array("q", bytes(held))
            last += zip(numbers[0::3], numbers[1::3], numbers[2::3])
        last = sorted(last)[-self.keep:]
        if self.silence is not None:
            until = max(last[-1][0] // 1000 + self.silence, timerValues.getCurrentWatermarkInMs() + 1)
            if timer is None:
                self.handle.registerTimer(until)
                timer = until
        self.events.put([(array("q", chain.from_iterable(last)).tobytes(), until, timer)])
        yield self.shown(key[0], len(last), sum(e[2] for e in last), last[-1][0])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (held, until, _), = self.events.get()
        if until > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(until)
            self.events.put([(bytes(held), until, until)])
        else:
            self.events.clear()
            yield self.shown(key[0], 0, 0, None)

    def close(self) -> None:
        pass


def recent_stream(scored: DataFrame, entity: str, time: str = "ts", row_id: str = "row_id", keep: int = RECENT_ROWS,
                  expire: str | None = EXPIRE, delay: str = "10 minutes") -> DataFrame:
    """Flagged rows among each entity's last ``keep`` events, updated with every micro-batch.

    Before the shuffle each task keeps only the last ``keep`` rows per entity, so an entity with most of the rows
    sends few of them. State per entity is at most ``keep`` events. An entity that has been silent for
    ``expire`` of event time is forgotten, with a last row that counts none; None keeps all. (State that ages by the
    clock needs processing time, in which a query that should read what is there and stop never stops.) Start it
    with ``upsert_stream``.
    """
    slim = event_time(scored, time).select(entity, micros(time).alias("at"), F.col(row_id).cast("bigint").alias("row_id"),
                                           F.col("pred").cast("bigint").alias("pred"))
    trimmed = slim.mapInPandas(_last_rows(keep, entity), slim.schema)
    silence = pd.Timedelta(expire).value // 1_000_000 if expire else None
    if expire:
        trimmed = trimmed.withColumn("event_time", F.timestamp_micros("at")).withWatermark("event_time", delay)
    output = T.StructType([T.StructField(entity, slim.schema[entity].dataType), T.StructField("rows", T.LongType()),
                           T.StructField("flagged", T.LongType()), T.StructField("last_at", T.LongType())])
    return trimmed.groupBy(entity).transformWithState(RecentEvents(entity, keep, silence), output, "update",
                                                      "eventTime" if expire else "none")


def label_stream(scored: DataFrame, labels: DataFrame, horizon: str = "3 hours", delay: str = "1 hour", time: str = "ts",
                 row_id: str = "row_id", label_time: str = "label_ts") -> DataFrame:
    """Scored rows with the label that arrives for them, at most ``horizon`` of event time after them.

    A row whose label does not come in time is given out with a null label once the watermark has passed its
    horizon; both sides forget what can meet nothing any more. Rows and labels behind the watermark are dropped.
    ``labels``: ``row_id, label_ts, label``.
    """
    left = event_time(scored, time).withWatermark(time, delay)
    right = event_time(labels, label_time).select(F.col(row_id).alias("_labelled"), F.col(label_time).alias("_label_ts"), "label")
    right = right.withWatermark("_label_ts", delay)
    within = (F.col("_labelled") == F.col(row_id)) & (F.col("_label_ts") >= F.col(time)) & (F.col("_label_ts") <= F.col(time) + F.expr(f"INTERVAL {horizon}"))
    return left.join(right, within, "leftOuter").drop("_labelled", "_label_ts")


def private_stream(stream: DataFrame, texts: tuple[str, ...] = (), user_ids: str | None = "user_id",
                   addresses: str | None = "source_ip", salt: str = "") -> DataFrame:
    """Redaction and hashing before any sink; the same columns as in batch."""
    clean = stream.withColumns({c: redact(F.col(c)) for c in texts}) if texts else stream
    return anonymise(clean, user_ids, addresses, salt=salt)
