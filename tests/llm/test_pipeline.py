"""The pipeline against plain versions of its stages, one after the other."""

from collections import Counter

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from logwarden.llm import factor_quality
from tests.llm.plain import awkward, frame, links
from tests.llm.test_text import linked, low, packed

LABELS = "doc_id long, quality int, toxic int"


def good(model, rows):
    """Rows with a score of one half or more, by the sum over all pairs of features."""
    out = []
    for i, t in rows:
        index, value = factor_quality.features(t, None if t is None else len(t))
        factors = model.factors[index].astype(float) * value[:, None]
        raw = model.bias + model.weights[index].astype(float) @ value + np.triu(factors @ factors.T, 1).sum()
        assert abs(raw) > 1e-3
        out += [(i, t)] * bool(raw > 0)
    return out


def distinct(rows):
    """Of equal texts the row with the largest id; null texts count as empty."""
    best = {}
    for i, t in sorted(rows, key=lambda r: low(r[0])):
        best[t or ""] = (i, t)
    return list(best.values())


def unlike(rows):
    """Of each class of near copies the row with the smallest id."""
    up = list(range(len(rows)))
    for a, b in links(rows):
        old, new = up[a], up[b]
        up = [new if u == old else u for u in up]
    classes = {}
    for k, u in enumerate(up):
        classes.setdefault(u, []).append(rows[k])
    return [min(c, key=lambda r: (r[0] is None, r[0] or 0)) for c in classes.values()]


def clean(text):
    out, at = "", 0
    for start, _, end, _, *_ in linked(text or ""):
        if start >= at and not (start == at and at):
            out += text[at:start] + "[REDACTED]"
        at = max(at, end)
    return out + text[at:] if at else text


def test_run(spark, tmp_path):
    rows = awkward()
    frame(spark, rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, k % 4 != 3, 0) for k, i in enumerate(range(5, 27))] + [(None, True, 0), (16, None, 0), (999, False, 0)],
                          "doc_id long, quality boolean, toxic int").selectExpr("doc_id", "int(quality) quality", "toxic").write.parquet(
        str(tmp_path / "labels.parquet"))
    read = spark.read.parquet
    model = factor_quality.fit(read(str(tmp_path / "documents.parquet")), read(str(tmp_path / "labels.parquet")))
    scored = good(model, rows)
    unlikely = unlike(distinct(scored))
    assert 0 < len(scored) < len(rows) and len(unlikely) < len(distinct(scored)) < len(scored)
    expect = [(i, clean(t)) for i, t in unlikely]
    assert Counter(expect) != Counter(unlikely)
    packed(expect, corpus_pipeline.run(spark, str(tmp_path)).collect())


def test_empty_tables(spark, tmp_path):
    """Every stage but the last hands on the columns of the documents, clashing ones too."""
    spark.createDataFrame([], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark, [(1, "one")]).where(F.lit(False))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        assert name == "packing" or out.dtypes == docs.dtypes
        path = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
