"""The text pipeline: stages in order, each reading the whole result of the one before.

Defined cases: a null text counts as empty in every stage and stays null in what a stage hands on;
rows with a null doc_id are scored, compared and packed like others, and stay only where no row with
an id stays for them; of rows equal in doc_id and text one stays; empty tables give empty results;
without labels of both classes the classifier gives every document the smoothed share of good labels,
one half if there are none; extra columns are handed on as they are, whatever their names, to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.common import work_path
from logwarden.llm import chosen_path, factor_quality, lexical_packing, secret_links, stream_dedup
from logwarden.llm.tables import free_name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below one half go."""
    model = factor_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "fm_score")
    return factor_quality.score(docs, model, name=name).where(F.col(name) >= 0.5).drop(name)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return stream_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one document stays."""
    return chosen_path.deduplicate(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets and linked credentials are cut out of the texts; every document stays."""
    return secret_links.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, by sequence."""
    return lexical_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near duplicates", near),
    ("secret scans", secrets),
    ("packing", packing),
]
# A trained classifier and a tokenizer are no SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
