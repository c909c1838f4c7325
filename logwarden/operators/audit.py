"""The audit table: events built as rows, appended once per job, read back as tail and summary."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.functions.pii import anonymise, sanitise
from logwarden.operators.quality import validate_table

AUDIT_SCHEMA = ("timestamp timestamp, event_type string, description string, user_id string, "
                "ip_address string, additional_data map<string,string>")
RECENT_EVENTS = 10


def _map(values: Mapping[str, Column | str]) -> Column:
    if not values:
        return F.expr("cast(map() as map<string,string>)")
    cells = [c for k, v in values.items() for c in (F.lit(k), (v if isinstance(v, Column) else F.lit(v)).cast("string"))]
    return F.create_map(*cells)


def event_columns(event_type: str, description: Column | str, user_id: Column | str | None = None,
                  ip_address: Column | str | None = None, extra: Mapping[str, Column | str] | None = None,
                  at: Column | None = None) -> list[Column]:
    """The six audit columns, from constants or from columns of a table."""
    def text(value):
        return (value if isinstance(value, Column) else F.lit(value)).cast("string")

    return [(F.current_timestamp() if at is None else at).cast("timestamp").alias("timestamp"),
            F.lit(event_type).alias("event_type"), text(description).alias("description"),
            text(user_id).alias("user_id"), text(ip_address).alias("ip_address"),
            _map(extra or {}).alias("additional_data")]


def _one(spark: SparkSession, columns: list[Column]) -> DataFrame:
    return spark.range(1).select(*columns)


def security_event(spark: SparkSession, event_type: str, description: str, **details) -> DataFrame:
    return _one(spark, event_columns(event_type, description, **details))


def data_access(spark: SparkSession, data_type: str, access_type: str, user_id: str | None = None,
                at: Column | None = None) -> DataFrame:
    extra = {"data_type": data_type, "access_type": access_type}
    return _one(spark, event_columns("data_access", f"{access_type} access to {data_type}", user_id, None, extra, at))


def model_operation(spark: SparkSession, operation: str, model_type: str, user_id: str | None = None,
                    at: Column | None = None) -> DataFrame:
    extra = {"operation": operation, "model_type": model_type}
    return _one(spark, event_columns("model_operation", f"{operation} operation on {model_type} model",
                                     user_id, None, extra, at))


@dataclass(frozen=True)
class PrivacySettings:
    hash_user_ids: bool = True
    hash_ip_addresses: bool = True
    remove_pii: bool = True
    audit_trail: bool = True
    gdpr_compliant: bool = True
    ccpa_compliant: bool = True
    hipaa_compliant: bool = False
    # Not part of the report: flooring of the time column, and redaction of free text in tables.
    anonymize_timestamps: bool = False
    redact_text: bool = False


def privacy_protection_setup(spark: SparkSession, settings: PrivacySettings | None = None, user_id: str | None = None,
                             at: Column | None = None) -> DataFrame:
    """The protection measures that were switched on, one event."""
    on = {k: str(v).lower() for k, v in asdict(settings or PrivacySettings()).items()}
    return _one(spark, event_columns("privacy_protection_setup", "Privacy protection measures initialized", user_id, None, on, at))


def anomaly_detection(scored: DataFrame, method: Column | str, user_id: str | None = None,
                      at: Column | None = None) -> DataFrame:
    """One event per method with its number of flagged rows."""
    named = scored.select((method if isinstance(method, Column) else F.lit(method)).alias("m"), "pred")
    counts = named.groupBy("m").agg(F.sum(F.col("pred").cast("bigint")).alias("n"))
    text = F.concat(F.lit("Detected "), F.col("n"), F.lit(" anomalies using "), F.col("m"))
    extra = {"anomaly_count": F.col("n"), "detection_method": F.col("m")}
    return counts.select(*event_columns("anomaly_detection", text, user_id, None, extra, at))


def append_events(events: DataFrame, path: str) -> None:
    """Add the events of a job in one write."""
    events.write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def audit_tail(audit: DataFrame, limit: int) -> DataFrame:
    """The last events; equal times are ordered by type and description."""
    return audit.orderBy(F.col("timestamp").desc(), F.col("event_type").desc(), F.col("description").desc()).limit(limit)


def privacy_report(audit: DataFrame, settings: PrivacySettings = PrivacySettings()) -> DataFrame:
    """One row: the settings, event counts and the compliance status."""
    total = F.count(F.lit(1))
    flags = [F.lit(v).alias(k) for k, v in asdict(settings).items() if k not in ("anonymize_timestamps", "redact_text")]
    return audit.agg(total.alias("total_events"), F.least(total, F.lit(RECENT_EVENTS)).alias("recent_events")).select(
        *flags, "total_events", "recent_events", F.lit("ACTIVE").alias("data_protection_status"),
        F.lit("COMPLIANT" if settings.gdpr_compliant else "NON_COMPLIANT").alias("compliance_status"))


class InvalidData(ValueError):
    """Raised by ``process``; ``audit`` holds the events up to the failure."""

    def __init__(self, message: str, audit: DataFrame):
        super().__init__(message)
        self.audit = audit


def process(df: DataFrame, operation: str = "process", data_type: str = "DataFrame",
            settings: PrivacySettings = PrivacySettings(), user_id: str | None = None,
            required: tuple[str, ...] | None = None, time: str = "timestamp") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Access event, validation, sanitising: ``(clean table, findings, audit events)``.

    Sanitising hashes the id columns; times are floored and free text is redacted where the settings say so.
    """
    spark = df.sparkSession
    audit = data_access(spark, data_type, operation, user_id)
    findings = validate_table(df) if required is None else validate_table(df, required)
    # A few rows at most per column of the table.
    known = findings.collect()
    errors = [r["detail"] for r in known if r["severity"] == "error"]
    if errors:
        failed = security_event(spark, "data_validation_failed", f"Data validation failed: {errors}")
        raise InvalidData(f"Data validation failed: {errors}", audit.unionByName(failed))
    clean = df
    if settings.remove_pii:
        users = "user_id" if settings.hash_user_ids else None
        addresses = "source_ip" if settings.hash_ip_addresses else None
        if settings.redact_text:
            clean = sanitise(clean, None, None, keep=("user_id", "source_ip"))
        clean = anonymise(clean, users, addresses, time if settings.anonymize_timestamps else None)
    warnings = [r["detail"] for r in known if r["severity"] == "warning"]
    if warnings:
        audit = audit.unionByName(security_event(spark, "data_validation_warning",
                                                 f"Data validation warnings: {warnings}"))
    return clean, findings, audit
