"""Log tables in and out (Parquet)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden.common import feature_columns, require_columns

# The columns of a host log table, in order.
LOG_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("cpu_usage", T.DoubleType()),
    T.StructField("memory_usage", T.DoubleType()),
    T.StructField("disk_usage", T.DoubleType()),
    T.StructField("bytes_sent", T.DoubleType()),
    T.StructField("bytes_received", T.DoubleType()),
    T.StructField("active_connections", T.LongType()),
    T.StructField("process_count", T.DoubleType()),
    T.StructField("packet_size_variance", T.DoubleType()),
    T.StructField("connection_duration", T.DoubleType()),
    T.StructField("failed_login_attempts", T.LongType()),
    T.StructField("privilege_escalation_attempts", T.LongType()),
    T.StructField("suspicious_file_access", T.LongType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("source_ip", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("anomaly_label", T.IntegerType()),
    T.StructField("cpu_memory_ratio", T.DoubleType()),
    T.StructField("network_activity", T.DoubleType()),
    T.StructField("resource_pressure", T.DoubleType()),
])

EVENT_DATE = "event_date"


@dataclass(frozen=True)
class LogTable:
    """A log table with its measurement columns and, where present, its label column."""

    data: DataFrame
    features: list[str]
    label: str | None


def load_logs(spark: SparkSession, path: str, schema: T.StructType | None = LOG_SCHEMA) -> LogTable:
    """Lazy scan; filters and the chosen columns reach the Parquet reader."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    data = reader.parquet(path)
    label = "anomaly_label" if "anomaly_label" in data.columns else None
    return LogTable(data, feature_columns(data), label)


def save_logs(df: DataFrame, path: str, mode: str = "errorifexists", time: str | None = "timestamp") -> None:
    """Write Parquet, one folder per event date when a time column is named.

    Rows are spread within each date by the shuffle that AQE splits, so a hot date does not
    end in one file.
    """
    if time is None:
        df.write.mode(mode).parquet(path)
        return
    require_columns(df, [time])
    dated = df.withColumn(EVENT_DATE, F.to_date(time))
    dated.hint("rebalance", EVENT_DATE).write.mode(mode).partitionBy(EVENT_DATE).parquet(path)


def append_batch(table: DataFrame, batch: DataFrame) -> DataFrame:
    """The table with a new batch of rows; the columns must agree by name."""
    return table.unionByName(batch, allowMissingColumns=False)
