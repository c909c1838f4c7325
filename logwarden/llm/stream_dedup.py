"""Exact deduplication with keyed state that lives on disk and never expires.

Every row is reduced to its SHA-256 digest, its stable identifier and the place of its content
(file and row). These slim rows pass through a Structured Streaming aggregation by digest, kept in
RocksDB with its checkpoint in the shared folder: per digest the identifier and locator of the row
that stays, and the number of rows. A digest seen twice is a hit, and all bytes of its rows are
compared; rows that share a digest but not their bytes are separated and grouped by the text itself.

A later call with the same ``state_dir`` continues: its result has one row for each of its own
documents, and ``keep`` and ``group_size`` speak of all rows of all calls (so a row that an earlier
call kept can lose its place to a later one). The folder holds the staged digests, the stream's
checkpoint, the digests with collisions, and the rows of inputs that were no files. A row counts once
for its place, so a call that is repeated, or was cut short, changes nothing: files are taken not to
change, while a table that is no file is new at every call. On a hit, one older row of each digest is
read again through its locator and compared; every older row of a digest with collisions is.

Defined cases: null text counts as empty; of equal texts the row with the largest doc_id stays, null
being the smallest; of rows equal in doc_id and text the one last in file and row order stays; an
empty table gives no rows; other columns of the input are not touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.common import work_path, written
from logwarden.llm.tables import free_name, whole_text

FILES_PER_BATCH = 1024
STATE = "spark.sql.streaming.stateStore."
STORE = {
    STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Space claimed ahead for the logs of every small store would exceed the state itself.
    STATE + "rocksdb.allowFAllocate": "false",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def located(docs: DataFrame, state_dir: str | None = None) -> DataFrame:
    """``docs`` read from files that tell each row's place; any other table is written first, into the state if there is one."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        if not state_dir:
            return located(written(docs, "documents"))
        path = f"{state_dir}/documents-{uuid.uuid4().hex}"
        docs.write.parquet(path)
        return docs.sparkSession.read.schema(docs.schema).parquet(path)
    return docs


def place(docs: DataFrame) -> Column:
    meta = docs.metadataColumn("_metadata")
    return F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("row"))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there and holds anything but hidden files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(folder) and any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(folder))


def stored(like: DataFrame, path: str) -> DataFrame:
    """A table of the state folder; empty where no call has written it."""
    spark = like.sparkSession
    return spark.read.schema(like.schema).parquet(path) if has_files(spark, path) else like.limit(0)


def run_state(spark: SparkSession, staged: DataFrame, path: str, state_dir: str, files_per_batch: int) -> DataFrame:
    """Pass the files under ``path`` through the keyed state; returns the hits, ``_digest, keep, group_size``."""
    seen = spark.readStream.schema(staged.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    state = seen.groupBy("_digest").agg(F.max(F.struct("doc_id", "_place")).alias("keep"),
                                        F.count(F.lit(1)).alias("group_size"))
    with settings(spark, STORE):
        query = (state.writeStream.outputMode("update").format("noop").option("checkpointLocation", state_dir)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        if not (query.lastProgress or has_files(spark, f"{state_dir}/commits")):
            empty = staged.select("_digest", F.struct("doc_id", "_place").alias("keep"), F.lit(0).cast("bigint").alias("group_size"))
            return empty.limit(0)
        held = spark.read.format("statestore").load(state_dir)
        hits = held.select("key._digest", F.col("value.max").alias("keep"), F.col("value.count").alias("group_size"))
        return written(hits.where("group_size > 1"), "hits")


def collisions(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests whose rows do not agree in all bytes; ``texts``: _digest, _text.

    Texts meet their hit in a join whose hot partitions can be split; each task then reduces a
    digest to its smallest and largest text, so one row per task and digest is shuffled on.
    """
    met = texts.join(hits.select("_digest").hint("shuffle_hash"), "_digest")
    again = met.groupBy(F.concat(F.col("_digest"), F.lit("").cast("binary")).alias("_digest"))
    ends = again.agg(F.min(F.col("_text").cast("binary")).alias("_low"), F.max(F.col("_text").cast("binary")).alias("_high"))
    return ends.where("_low != _high").select("_digest")


def older_texts(older: DataFrame) -> DataFrame:
    """``older`` (rows with ``_place``) with ``_text``, read again through the places."""
    files = [r.file for r in older.select("_place.file").distinct().toLocalIterator()]
    if not files:
        return older.withColumn("_text", F.lit(""))
    source = older.sparkSession.read.schema("text string").parquet(*files)
    texts = source.select(place(source).alias("_place"), whole_text(source).alias("_text"))
    return texts.join(older, "_place")


def groups(docs: DataFrame, state_dir: str | None = None, files_per_batch: int = FILES_PER_BATCH,
           digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: ``doc_id, _place, _digest, keep`` (id and place of the row that stays), ``group_size``."""
    spark, docs = docs.sparkSession, located(docs, state_dir)
    text = whole_text(docs)
    rows = docs.select(docs["doc_id"].alias("doc_id"), place(docs).alias("_place"), digest(text).alias("_digest"))
    own = docs.select(digest(text).alias("_digest"), text.alias("_text"))
    if state_dir:
        path, staged = f"{state_dir}/digests", written(rows, "digests")
        before = stored(staged, path)
        files = staged.select("_place.file").distinct()
        again = before.select("_place", F.col("_place.file").alias("file")).join(files, "file", "left_semi")
        staged.join(again, "_place", "left_anti").select(*staged.columns).write.mode("append").parquet(path)
        hits = run_state(spark, staged, path, f"{state_dir}/state", files_per_batch)
        older = before.join(staged, "_place", "left_anti").join(
            staged.select("_digest").distinct(), "_digest", "left_semi")
        one = written(older.groupBy("_digest").agg(F.min("_place").alias("_place")), "older")
        compared = own.unionByName(older_texts(one).select("_digest", "_text"))
        fresh = written(collisions(compared, hits), "collisions")
        known = stored(fresh, f"{state_dir}/collisions")
        fresh.join(known, "_digest", "left_anti").write.mode("append").parquet(f"{state_dir}/collisions")
        mixed = stored(fresh, f"{state_dir}/collisions").join(staged, "_digest", "left_semi")
    else:
        path = work_path(spark, "digests")
        rows.write.parquet(path)
        staged = spark.read.parquet(path)
        hits = run_state(spark, staged, path, work_path(spark, "dedup-state"), files_per_batch)
        mixed = written(collisions(own, hits), "collisions")
    alone = F.struct("doc_id", "_place")
    out = staged.join(hits, "_digest", "left").select(
        "doc_id", "_place", "_digest", F.coalesce("keep", alone).alias("keep"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"))
    if mixed.isEmpty():
        return out
    every = docs.select(docs["doc_id"].alias("doc_id"), place(docs).alias("_place"), digest(text).alias("_digest"), text.alias("_text"))
    apart = every.join(mixed, "_digest", "left_semi")
    held = apart.select("doc_id", "_place", "_digest", "_text")
    if state_dir:
        rest = written(older.join(mixed, "_digest", "left_semi"), "older-collisions")
        held = held.unionByName(older_texts(rest).select(*held.columns))
    keepers = held.groupBy("_digest", "_text").agg(F.max(alone).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    split = apart.join(keepers, ["_digest", "_text"]).select(*out.columns)
    return out.join(mixed, "_digest", "left_anti").unionByName(split)


def flagged(found: DataFrame) -> DataFrame:
    """``groups`` with ``keep_id`` and ``kept``."""
    return found.select("doc_id", "_place", "_digest", F.col("keep.doc_id").alias("keep_id"), "group_size",
                        F.col("keep._place").eqNullSafe(F.col("_place")).alias("kept"))


def deduplicate(docs: DataFrame, state_dir: str | None = None, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    docs = located(docs, state_dir)
    name = free_name(docs, "_place")
    gone = flagged(groups(docs, state_dir, files_per_batch)).where("not kept").select(F.col("_place").alias(name))
    rows = docs.withColumn(name, place(docs))
    return rows.join(gone, name, "left_anti").drop(name)
