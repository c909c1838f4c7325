"""Fitted models as tables: one JSON row of parameters, one Parquet row per array."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import SparkSession

from logwarden.detectors.base import Model
from logwarden.detectors.factory import restore_model

ARRAY_SCHEMA = "name string, shape array<int>, data array<double>"


def save_model(spark: SparkSession, model: Model, path: str) -> None:
    rows = [(name, list(a.shape), [float(v) for v in a.ravel()]) for name, a in model.arrays().items()]
    spark.createDataFrame([(json.dumps(model.params()),)], "params string").coalesce(1) \
        .write.mode("errorifexists").json(f"{path}/params")
    spark.createDataFrame(rows, ARRAY_SCHEMA).write.mode("errorifexists").parquet(f"{path}/arrays")


def load_model(spark: SparkSession, path: str) -> Model:
    params = json.loads(spark.read.schema("params string").json(f"{path}/params").first()["params"])
    rows = spark.read.schema(ARRAY_SCHEMA).parquet(f"{path}/arrays").collect()  # model-sized
    arrays = {r["name"]: np.array(r["data"]).reshape(r["shape"]) for r in rows}
    return restore_model(params, arrays)
