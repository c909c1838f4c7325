"""Registered queries: personal data in texts, identifiers, guarded processing, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.common import work_path
from logwarden.functions import pii
from logwarden.operators import audit, quality
from logwarden.plans.base import SCORED, heavy_table, scored_events, table

_TEXTS = {"documents": ("doc_id", "text"), "pages": ("page_id", "html")}


def _detect(name: str):
    key, text = _TEXTS[name]

    def run(spark, sf_dir):
        """Number of matches and the matches themselves per type."""
        found = heavy_table(spark, sf_dir, name).select(
            key, *[pii.pii_matches(F.col(text), k).alias(k) for k in pii.PII_PATTERNS])
        return found.select(key, *[c for k in pii.PII_PATTERNS for c in (
            F.size(k).alias(f"n_{k}"), F.array_join(k, "|").alias(k))])

    return run


def pii_findings(spark, sf_dir):
    """Findings map in long form: one row per text and type that occurs."""
    found = heavy_table(spark, sf_dir, "documents").select("doc_id", F.explode(pii.pii_findings(F.col("text"))).alias("type", "hits"))
    return found.select("doc_id", "type", F.size("hits").alias("n"), F.array_join("hits", "|").alias("matches"))


def _redact(name: str):
    key, text = _TEXTS[name]
    return lambda spark, sf: heavy_table(spark, sf, name).select(key, pii.redact(F.col(text)).alias("redacted"))


def anonymise(spark, sf_dir):
    logs = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.concat_ws(".", F.lit("10.0"), F.col("user_id") % 7, F.col("user_id") % 200).alias("source_ip"),
        "ts")
    clean = pii.anonymise(logs, times="ts", salt="s1", n_chars=12)
    return clean.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def customer_hash(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", pii.masked_identifier(F.col("c_name"), "usr_").alias("user_id"),
        pii.hash_identifier(F.col("c_name")).alias("hash"))


def sanitise_nested(spark, sf_dir):
    """Texts as arrays of lines inside structs and maps, cleaned at every depth."""
    docs = heavy_table(spark, sf_dir, "documents").select(
        "doc_id", F.struct(F.split("text", "\n").alias("lines"), F.col("lang")).alias("body"),
        F.create_map(F.lit("text"), F.col("text")).alias("extra"))
    clean = pii.sanitise(docs)
    return clean.select("doc_id", F.array_join("body.lines", "\n").alias("lines"), F.col("body.lang").alias("lang"),
                        F.element_at("extra", F.lit("text")).alias("extra"))


def text_validate(spark, sf_dir):
    return quality.validate_text(heavy_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def _guarded_rows(spark, sf_dir):
    """Host events with ids, a note and a time; some values are missing, some far out."""
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return table(spark, sf_dir, "events").select(
        "event_id", value.alias("cpu_usage"), (value * F.when(F.col("event_id") % 50 == 0, 100.0).otherwise(1.0)).alias("memory_usage"),
        F.col("user_id").cast("string").alias("user_id"), F.concat_ws(
            "", F.lit("from user"), F.col("user_id"), F.lit("@ex.com at 10.0.0."), F.col("user_id") % 250).alias("note"),
        F.col("ts").cast("timestamp").alias("timestamp"))


def process_guarded(spark, sf_dir):
    """After validation and sanitising, free text included."""
    clean, _, _ = audit.process(_guarded_rows(spark, sf_dir), settings=audit.PrivacySettings(redact_text=True))
    return clean.drop("timestamp")


def process_floor_times(spark, sf_dir):
    """Ids hashed and times floored to the hour; the note stays."""
    clean, _, _ = audit.process(_guarded_rows(spark, sf_dir), settings=audit.PrivacySettings(anonymize_timestamps=True))
    return clean.select("event_id", "user_id", "note", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def process_findings(spark, sf_dir):
    _, findings, _ = audit.process(_guarded_rows(spark, sf_dir))
    return findings


def process_audit(spark, sf_dir):
    """The events of a guarded run after those of the setup."""
    _, _, events = audit.process(_guarded_rows(spark, sf_dir), "score", "events", user_id="u7")
    both = audit.privacy_protection_setup(spark, user_id="u7").unionByName(events)
    return both.select("event_type", "description", "user_id")


def pii_hits(spark, sf_dir):
    """Texts with at least one hit of every type, made from customer rows; the order effect of redaction included."""
    c = F.col("c_custkey")
    number = F.lpad((c % 10000).cast("string"), 4, "0")
    texts = table(spark, sf_dir, "customer").select("c_custkey", F.concat(
        F.lit("ssn 123-45-"), number, F.lit(" mac 00:1A:2b:3c:4D:"), F.lpad((c % 90 + 10).cast("string"), 2, "0"),
        F.lit(" see http://10.0.0."), (c % 250).cast("string"), F.lit("/a?b=1 or https://ex"), c.cast("string"),
        F.lit(".com/p mail u"), c.cast("string"), F.lit("@ex.com card 4111 1111 1111 "), number, F.lit(" call 555-123-"), number).alias("text"))
    return texts.select("c_custkey", *[F.size(pii.pii_matches(F.col("text"), k)).alias(f"n_{k}") for k in pii.PII_PATTERNS],
                        pii.redact(F.col("text")).alias("redacted"))


def _audit_table(spark, sf_dir) -> DataFrame:
    """An audit table on disk: accesses, operations, and detections per event type."""
    path = work_path(spark, "audit")
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    scored = scored_events(spark, sf_dir)
    days = scored.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    audit.append_events(audit.data_access(spark, "events", "read", at=at), path)
    audit.append_events(audit.model_operation(spark, "train", "deviation", at=at), path)
    audit.append_events(audit.anomaly_detection(days, F.concat(F.lit("value on "), F.col("day")), at=at), path)
    return audit.read_audit(spark, path)


def audit_tail(spark, sf_dir):
    tail = audit.audit_tail(_audit_table(spark, sf_dir), 10)
    return tail.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "event_type", "description",
                       F.to_json("additional_data").alias("additional_data"))


QUERIES = {
    "pii_detect": _detect("documents"),
    "pii_detect_pages": _detect("pages"),
    "pii_findings": pii_findings,
    "pii_keywords": lambda s, d: heavy_table(s, d, "documents").select(
        "doc_id", F.array_join(pii.keyword_matches(F.col("text")), ",").alias("keywords")),
    "pii_keywords_whole": lambda s, d: heavy_table(s, d, "pages").select(
        "page_id", F.array_join(pii.keyword_matches(F.col("html"), whole_word=True), ",").alias("keywords")),
    "pii_redact": _redact("documents"),
    "pii_redact_pages": _redact("pages"),
    "text_validate": text_validate,
    "anonymise": anonymise,
    "customer_hash": customer_hash,
    "pseudonymous_ip": lambda s, d: table(s, d, "customer").select(
        "c_custkey", pii.pseudonymous_ip(F.col("c_name")).alias("source_ip")),
    "sanitise_nested": sanitise_nested,
    "process_guarded": process_guarded,
    "process_floor_times": process_floor_times,
    "process_findings": process_findings,
    "process_audit": process_audit,
    "pii_hits": pii_hits,
    "audit_summary": lambda s, d: audit.privacy_report(_audit_table(s, d)),
    "audit_tail": audit_tail,
}


def _hits(text: str, kind: str) -> str:
    return f"regexp_extract_all({text}, '{pii.PII_PATTERNS[kind]}', 0, 'i')"


def redact_sql(text: str) -> str:
    for pattern in pii.PII_PATTERNS.values():
        text = f"regexp_replace({text}, '{pattern}', '{pii.REDACTED}', 'gi')"
    return text


def _detect_sql(name: str) -> str:
    key, text = _TEXTS[name]
    cells = ", ".join(f"CAST(len({_hits(text, k)}) AS INTEGER) AS n_{k}, COALESCE(array_to_string({_hits(text, k)}, '|'), '') AS {k}"
                      for k in pii.PII_PATTERNS)
    return f"SELECT {key}, {cells} FROM {name}"


_KEYWORDS = ", ".join(f"'{k}'" for k in pii.SENSITIVE_KEYWORDS)
_FOUND = f"list_filter([{_KEYWORDS}], lambda k: contains(lower(text), k))"
_ANY = " OR ".join([f"regexp_matches(text, '{p}', 'i')" for p in pii.PII_PATTERNS.values()] + [f"len({_FOUND}) > 0"])
_AUDIT_SQL = f"""WITH {SCORED}, a AS (
    SELECT TIMESTAMP '2024-02-01 00:00:00' AS timestamp, 'data_access' AS event_type, 'read access to events' AS description,
        '{{"data_type":"events","access_type":"read"}}' AS additional_data
    UNION ALL SELECT TIMESTAMP '2024-02-01 00:00:00', 'model_operation', 'train operation on deviation model',
        '{{"operation":"train","model_type":"deviation"}}'
    UNION ALL SELECT TIMESTAMP '2024-02-01 00:00:00', 'anomaly_detection',
        'Detected ' || CAST(sum(pred) AS BIGINT) || ' anomalies using value on ' || strftime(ts, '%Y-%m-%d'),
        '{{"anomaly_count":"' || CAST(sum(pred) AS BIGINT) || '","detection_method":"value on ' || strftime(ts, '%Y-%m-%d') || '"}}'
        FROM scored GROUP BY strftime(ts, '%Y-%m-%d'))"""

_NUMERIC = ["event_id", "cpu_usage", "memory_usage"]
_FINDINGS = f"""WITH g AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS cpu_usage,
        CASE WHEN event_id % 7 <> 0 THEN value * CASE WHEN event_id % 50 = 0 THEN 100 ELSE 1 END END AS memory_usage FROM events),
    nul AS (SELECT CAST({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in _NUMERIC)} AS BIGINT) AS n FROM g),
    {', '.join(f"""q{i} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM g),
    o{i} AS (SELECT count(*) AS n FROM g, q{i} WHERE {c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1))"""
        for i, c in enumerate(_NUMERIC))},
    found AS (SELECT 0 AS place, 'warning' AS severity, 'missing_values' AS "check", CAST(NULL AS VARCHAR) AS "column", n,
            'Found ' || n || ' missing values' AS detail FROM nul WHERE n > 0
        {' '.join(f"UNION ALL SELECT {i + 1}, 'warning', 'outliers', '{c}', n, 'Found ' || n || ' outliers in column {c}' FROM o{i} WHERE n > 0"
                  for i, c in enumerate(_NUMERIC))})"""

ORACLES = {
    "pii_detect": _detect_sql("documents"),
    "pii_detect_pages": _detect_sql("pages"),
    "pii_findings": " UNION ALL ".join(
        [f"""SELECT doc_id, '{k}' AS type, CAST(len({_hits('text', k)}) AS INTEGER) AS n,
        array_to_string({_hits('text', k)}, '|') AS matches FROM documents WHERE len({_hits('text', k)}) > 0"""
         for k in pii.PII_PATTERNS]
        + [f"""SELECT doc_id, 'sensitive_keywords', CAST(len({_FOUND}) AS INTEGER), array_to_string({_FOUND}, '|')
        FROM documents WHERE len({_FOUND}) > 0"""]),
    "pii_keywords": f"SELECT doc_id, COALESCE(array_to_string({_FOUND}, ','), '') AS keywords FROM documents",
    "pii_keywords_whole": "SELECT page_id, COALESCE(array_to_string(list_filter(["
        + ", ".join(f"CASE WHEN regexp_matches(lower(html), '\\b{k}\\b') THEN '{k}' END" for k in pii.SENSITIVE_KEYWORDS)
        + "], lambda k: k IS NOT NULL), ','), '') AS keywords FROM pages",
    "pii_redact": f"SELECT doc_id, {redact_sql('text')} AS redacted FROM documents",
    "pii_redact_pages": f"SELECT page_id, {redact_sql('html')} AS redacted FROM pages",
    "text_validate": f"SELECT doc_id, ({_ANY}) AS pii_detected, {redact_sql('text')} AS sanitized_text FROM documents",
    "anonymise": """SELECT event_id, 'usr_' || substr(sha256(user_id || 's1'), 1, 12) AS user_id,
        'ip_' || substr(sha256('10.0.' || user_id % 7 || '.' || user_id % 200 || 's1'), 1, 12) AS source_ip,
        date_trunc('hour', ts) AS ts FROM events""",
    "customer_hash": """SELECT c_custkey, 'usr_' || substr(sha256(c_name), 1, 8) AS user_id,
        substr(sha256(c_name), 1, 8) AS hash FROM customer""",
    "pseudonymous_ip": """SELECT c_custkey, '192.168.' || CAST('0x' || substr(sha256(c_name), 1, 2) AS INTEGER) || '.'
        || CAST('0x' || substr(sha256(c_name), 3, 2) AS INTEGER) AS source_ip FROM customer""",
    "sanitise_nested": f"""SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)),
        lambda x: {redact_sql('x')}), chr(10)) AS lines, lang, {redact_sql('text')} AS extra FROM documents""",
    "process_guarded": f"""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS cpu_usage,
        CASE WHEN event_id % 7 <> 0 THEN value * CASE WHEN event_id % 50 = 0 THEN 100 ELSE 1 END END AS memory_usage, 'usr_' || substr(sha256(CAST(user_id AS VARCHAR)), 1, 8) AS user_id,
        {redact_sql("'from user' || user_id || '@ex.com at 10.0.0.' || user_id % 250")} AS note FROM events""",
    "process_floor_times": """SELECT event_id, 'usr_' || substr(sha256(CAST(user_id AS VARCHAR)), 1, 8) AS user_id,
        'from user' || user_id || '@ex.com at 10.0.0.' || user_id % 250 AS note, date_trunc('hour', ts)::TIMESTAMP AS timestamp FROM events""",
    "process_findings": f"{_FINDINGS} SELECT severity, \"check\", \"column\", n, detail FROM found",
    "process_audit": f"""{_FINDINGS} SELECT 'privacy_protection_setup' AS event_type,
            'Privacy protection measures initialized' AS description, 'u7' AS user_id
        UNION ALL SELECT 'data_access', 'score access to events', 'u7'
        UNION ALL SELECT 'data_validation_warning', 'Data validation warnings: [' || string_agg(chr(39) || detail || chr(39), ', ' ORDER BY place) || ']',
            NULL FROM found""",
    "pii_hits": f"""WITH t AS (SELECT c_custkey, 'ssn 123-45-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || ' mac 00:1A:2b:3c:4D:'
            || lpad(CAST(c_custkey % 90 + 10 AS VARCHAR), 2, '0') || ' see http://10.0.0.' || c_custkey % 250 || '/a?b=1 or https://ex' || c_custkey
            || '.com/p mail u' || c_custkey || '@ex.com card 4111 1111 1111 ' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
            || ' call 555-123-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS text FROM customer)
        SELECT c_custkey, {', '.join(f"CAST(len({_hits('text', k)}) AS INTEGER) AS n_{k}" for k in pii.PII_PATTERNS)},
            {redact_sql('text')} AS redacted FROM t""",
    "audit_summary": f"""{_AUDIT_SQL} SELECT true AS hash_user_ids, true AS hash_ip_addresses, true AS remove_pii,
        true AS audit_trail, true AS gdpr_compliant, true AS ccpa_compliant, false AS hipaa_compliant,
        count(*) AS total_events, least(count(*), 10) AS recent_events, 'ACTIVE' AS data_protection_status,
        'COMPLIANT' AS compliance_status FROM a""",
    "audit_tail": f"""{_AUDIT_SQL} SELECT timestamp, event_type, description, additional_data FROM a
        ORDER BY timestamp DESC, event_type DESC, description DESC LIMIT 10""",
}
