"""Personal data in text and identifiers: detection, redaction, hashing. No Python workers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pattern per type, in the order in which redaction applies them.
PII_PATTERNS = {
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "phone": r"\b(?:\+?1[-.\s]?)?\(?([0-9]{3})\)?[-.\s]?([0-9]{3})[-.\s]?([0-9]{4})\b",
    "ssn": r"\b\d{3}-?\d{2}-?\d{4}\b",
    "credit_card": r"\b(?:\d{4}[-\s]?){3}\d{4}\b",
    "ip_address": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "mac_address": r"\b([0-9A-Fa-f]{2}[:-]){5}([0-9A-Fa-f]{2})\b",
    "url": r"https?://(?:[-\w.])+(?:[:\d]+)?(?:/(?:[\w/_.])*(?:\?(?:[\w&=%.])*)?(?:#(?:[\w.])*)?)?",
}

# Words that hint at secrets.
SENSITIVE_KEYWORDS = (
    "password", "passwd", "pwd", "secret", "key", "token", "api_key", "access_token",
    "refresh_token", "auth", "credential", "login", "username", "user_id",
)

REDACTED = "[REDACTED]"
_FLAGS = "(?iU)"  # ignore case; digits, words and boundaries by Unicode


def pii_matches(text: Column, kind: str) -> Column:
    """All matches of one type, as whole matches."""
    return F.regexp_extract_all(text, F.lit(_FLAGS + PII_PATTERNS[kind]), F.lit(0))


def keyword_matches(text: Column, whole_word: bool = False) -> Column:
    """Sensitive words in the text; by substring, or as whole words."""
    low = F.lower(text)
    if whole_word:
        hits = [F.when(low.rlike(rf"(?U)\b{k}\b"), F.lit(k)) for k in SENSITIVE_KEYWORDS]
    else:
        hits = [F.when(F.contains(low, F.lit(k)), F.lit(k)) for k in SENSITIVE_KEYWORDS]
    return F.array_compact(F.array(*hits))


def pii_findings(text: Column) -> Column:
    """Map of type to matches, without the types that have none."""
    kinds = list(PII_PATTERNS) + ["sensitive_keywords"]
    found = [pii_matches(text, k) for k in PII_PATTERNS] + [keyword_matches(text)]
    whole = F.map_from_arrays(F.array(*map(F.lit, kinds)), F.array(*found))
    return F.map_filter(whole, lambda _, hits: F.size(hits) > 0)


def has_pii(text: Column) -> Column:
    """True when any type or keyword occurs; stops at the first hit."""
    tests = [text.rlike(_FLAGS + p) for p in PII_PATTERNS.values()]
    tests += [F.contains(F.lower(text), F.lit(k)) for k in SENSITIVE_KEYWORDS]
    any_hit = tests[0]
    for test in tests[1:]:
        any_hit = any_hit | test
    return F.coalesce(any_hit, F.lit(False))


def redact(text: Column, replacement: str = REDACTED) -> Column:
    """Replace every pattern, one type after the other in the fixed order."""
    plain = replacement.replace("\\", "\\\\").replace("$", "\\$")
    for pattern in PII_PATTERNS.values():
        text = F.regexp_replace(text, F.lit(_FLAGS + pattern), F.lit(plain))
    return text


def hash_identifier(value: Column, salt: str = "", n_chars: int = 8) -> Column:
    """Leading hex digits of SHA-256 over value and salt; empty or null gives an empty text."""
    text = value.cast("string")
    digest = F.substring(F.sha2(F.concat(text, F.lit(salt)), 256), 1, n_chars)
    return F.when(text.isNull() | (text == ""), F.lit("")).otherwise(digest)


def masked_identifier(value: Column, prefix: str, salt: str = "", n_chars: int = 8) -> Column:
    """``prefix`` + hash; null stays null."""
    return F.when(value.isNotNull(), F.concat(F.lit(prefix), hash_identifier(value, salt, n_chars)))


def pseudonymous_ip(value: Column) -> Column:
    """A private address built from the first two bytes of the hash; null stays null."""
    digest = F.sha2(value.cast("string"), 256)
    octets = [F.conv(F.substring(digest, at, 2), 16, 10) for at in (1, 3)]
    return F.when(value.isNotNull(), F.concat_ws(".", F.lit("192.168"), *octets))


def anonymise(df: DataFrame, user_ids: str | None = "user_id", addresses: str | None = "source_ip",
              times: str | None = None, salt: str = "", n_chars: int = 8) -> DataFrame:
    """Hash the named user and address columns where present; floor ``times`` to the hour."""
    changes = {}
    if user_ids in df.columns:
        changes[user_ids] = masked_identifier(F.col(user_ids), "usr_", salt, n_chars)
    if addresses in df.columns:
        changes[addresses] = masked_identifier(F.col(addresses), "ip_", salt, n_chars)
    if times in df.columns:
        changes[times] = F.date_trunc("hour", F.col(times))
    return df.withColumns(changes) if changes else df


def _sanitised(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return redact(value)
    if isinstance(kind, T.ArrayType) and _holds_text(kind):
        return F.transform(value, lambda item: _sanitised(item, kind.elementType))
    if isinstance(kind, T.MapType) and _holds_text(kind.valueType):
        return F.transform_values(value, lambda _, item: _sanitised(item, kind.valueType))
    if isinstance(kind, T.StructType) and _holds_text(kind):
        parts = [_sanitised(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value


def _holds_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_text(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_holds_text(f.dataType) for f in kind.fields)
    return isinstance(kind, T.StringType)


def sanitise(df: DataFrame, user_ids: str | None = "user_id", addresses: str | None = "source_ip",
             keep: Sequence[str] = (), salts: Mapping[str, str] | None = None) -> DataFrame:
    """Redact every text at any depth (map keys stay) and hash the id columns.

    The walk follows the schema, so it is decided before any row is read. Columns in
    ``keep`` are left alone.
    """
    salt = (salts or {}).get("identifiers", "")
    ids = {c for c in (user_ids, addresses) if c}
    changes = {f.name: _sanitised(F.col(f.name), f.dataType) for f in df.schema.fields
               if f.name not in ids and f.name not in keep and _holds_text(f.dataType)}
    clean = df.withColumns(changes) if changes else df
    return anonymise(clean, user_ids, addresses, salt=salt)
