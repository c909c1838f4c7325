"""Shared helpers: column checks, stable hashes, and the shared work folder."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that describe a row but are never measurements.
NOT_FEATURES = ("row_id", "timestamp", "anomaly_label", "label", "score", "pred")


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Fail before any job starts when a column is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f) and f.name not in skip]


def feature_columns(df: DataFrame, features: Sequence[str] | None = None) -> list[str]:
    """The numeric measurements of a log table; a named non-numeric column is an error."""
    if features is None:
        return numeric_columns(df, NOT_FEATURES)
    require_columns(df, features)
    numeric = set(numeric_columns(df))
    bad = [c for c in features if c not in numeric]
    if bad:
        raise ValueError(f"Features must be numeric: {bad}")
    return list(features)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0.0 where the denominator is zero or null."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def clean_feature(name: str, on_null: str = "error") -> Column:
    """A feature as double, with the null policy applied (NaN counts as null)."""
    value = F.col(name).cast("double")
    missing = value.isNull() | F.isnan(value)
    if on_null == "error":
        stop = F.raise_error(F.lit(f"null feature value in column {name}")).cast("double")
        return F.when(missing, stop).otherwise(value)
    if on_null == "zero":
        return F.when(missing, F.lit(0.0)).otherwise(value)
    return value


def drop_missing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(names))


def row_hash(*keys: str, seed: int = 0) -> Column:
    """Cheap 64-bit hash of a row key; the same for any partitioning or row order."""
    return F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])


def portable_hash(*keys: str, seed: int = 0) -> Column:
    """52-bit hash built on SHA-256, so any SQL engine gives the same value.

    52 bits are exact in a double, which the quantile search relies on.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint")


def portable_number(*keys, seed: int = 0) -> int:
    """``portable_hash`` of given values, in Python."""
    text = "|".join([*map(str, keys), str(seed)])
    return int(hashlib.sha256(text.encode()).hexdigest()[:13], 16)


_work_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The application's folder in the shared folder the cluster names; a private one only on a local master.

    It goes when the application ends.
    """
    application = spark.sparkContext.applicationId
    if application not in _work_roots:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            shared = tempfile.mkdtemp(prefix="logwarden-")
        root = f"{shared.rstrip('/')}/logwarden-{application}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _work_roots[application] = root
    return _work_roots[application]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the application's work folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends at the files."""
    path = work_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


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
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def kept(df: DataFrame) -> DataFrame:
    """Keep a table on disk for several passes; lost blocks are computed again."""
    return df.persist(StorageLevel.DISK_ONLY)


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan of fewer pieces than cores out to all cores, for work that is heavy per row.

    A scan that already has a piece per core, as any large table has, is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def assert_unique(df: DataFrame, key: str) -> None:
    if df.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"{key} has duplicate values")
