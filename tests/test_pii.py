import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logwarden.functions import pii

CASES = [
    ("mail bob@ex.com or call 555-123-4567", {"email": ["bob@ex.com"], "phone": ["555-123-4567"]},
     "mail [REDACTED] or call [REDACTED]"),
    ("ssn 123-45-6789 id 123456789", {"ssn": ["123-45-6789", "123456789"]}, "ssn [REDACTED] id [REDACTED]"),
    ("card 4111 1111 1111 1111", {"credit_card": ["4111 1111 1111 1111"]}, "card [REDACTED]"),
    ("mac 00:1A:2b:3c:4D:5e end", {"mac_address": ["00:1A:2b:3c:4D:5e"]}, "mac [REDACTED] end"),
    ("see http://10.0.0.1/a?b=1 and https://ex.com:80/p/q?x=1#t",
     {"ip_address": ["10.0.0.1"], "url": ["http://10.0.0.1/a?b=1", "https://ex.com:80/p/q?x=1#t"]},
     "see http://[REDACTED]/a?b=1 and [REDACTED]"),
    ("+1 (555) 123-4567 MONKEY auth", {"phone": ["1 (555) 123-4567"], "sensitive_keywords": ["key", "auth"]},
     "+[REDACTED] MONKEY auth"),
    ("é123-45-6789", {}, "é123-45-6789"),
    ("http://exämple.com/ü", {"url": ["http://exämple.com/ü"]}, "[REDACTED]"),
    ("١٢٣-٤٥-٦٧٨٩",
     {"ssn": ["١٢٣-٤٥-٦٧٨٩"]}, "[REDACTED]"),
    ("", {}, ""),
]


def test_detection_and_redaction_goldens(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")
    rows = df.select("i", pii.pii_findings(F.col("t")).alias("f"), pii.redact(F.col("t")).alias("r"),
                     pii.has_pii(F.col("t")).alias("h")).orderBy("i").collect()
    for row, (_, found, clean) in zip(rows, CASES):
        assert row["f"] == found
        assert row["r"] == clean
        assert row["h"] == bool(found)


def test_whole_words_and_replacement_text(spark):
    df = spark.createDataFrame([("MONKEY auth $1 a@b.cd",)], "t string")
    row = df.select(pii.keyword_matches(F.col("t"), whole_word=True).alias("k"),
                    pii.redact(F.col("t"), "<$1\\>").alias("r")).first()
    assert row["k"] == ["auth"] and row["r"] == "MONKEY auth $1 <$1\\>"


PIECES = st.lists(st.sampled_from(["a@b.co", "1", "-", " ", "555", "123-45-6789", "10.0.0.1", "http://x.y/z?q=1",
                                   "é", "AB:", "00:", "(", ")", "4111 ", "K", ".", "@", "+1 "]), max_size=14)


@settings(max_examples=6, deadline=None)
@given(st.lists(PIECES.map("".join), min_size=25, max_size=40))
def test_same_as_python_patterns(spark, texts):
    def clean(t):
        for p in pii.PII_PATTERNS.values():
            t = re.sub(p, pii.REDACTED, t, flags=re.IGNORECASE)
        return t

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", pii.redact(F.col("t")).alias("r"),
                     *[pii.pii_matches(F.col("t"), k).alias(k) for k in pii.PII_PATTERNS]).orderBy("i").collect()
    for row, text in zip(rows, texts):
        assert row["r"] == clean(text)
        for kind, pattern in pii.PII_PATTERNS.items():
            assert row[kind] == [m.group(0) for m in re.finditer(pattern, text, re.IGNORECASE)]


def test_hash_goldens(spark):
    df = spark.createDataFrame([("user_0", "10.0.0.1", "ip_0"), (None, "", "ip_0")],
                               "user_id string, source_ip string, raw string")
    a, b = pii.anonymise(df.withColumn("ip", pii.pseudonymous_ip(F.col("raw")))).collect()
    assert (a["user_id"], a["source_ip"], a["ip"]) == ("usr_4e68080f", "ip_f5047344", "192.168.107.203")
    assert b["user_id"] is None and b["source_ip"] == "ip_"
    one = df.select(pii.hash_identifier(F.lit(None).cast("string")).alias("n"),
                    pii.hash_identifier(F.lit("x"), salt="s", n_chars=12).alias("s")).first()
    assert one["n"] == "" and len(one["s"]) == 12


def test_nested_sanitise(spark):
    df = spark.createDataFrame(
        [("u1", ["a@b.co", None], {"k": "call 555-123-4567"}, [("x 10.0.0.1", 3)], 7)],
        "user_id string, a array<string>, m map<string,string>, s array<struct<t:string,n:int>>, n int")
    row = pii.sanitise(df).first()
    assert row["a"] == ["[REDACTED]", None] and row["m"] == {"k": "call [REDACTED]"}
    assert row["s"][0]["t"] == "x [REDACTED]" and row["s"][0]["n"] == 3 and row["n"] == 7
    assert row["user_id"].startswith("usr_") and pii.sanitise(df).schema["n"] == df.schema["n"]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("a", "b")], "user_id string, t string")
    plan = pii.sanitise(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    with pytest.raises(KeyError):
        pii.pii_matches(F.col("t"), "unknown")
