"""Value ranges as bucket numbers, found by binary search inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_bucket(df: DataFrame, column: str, edges: Iterable[float], out: str) -> DataFrame:
    """``out`` = number of distinct finite edges that are <= the value (NaN is refused)."""
    inner = sorted({float(e) for e in edges if math.isfinite(e)})
    if not inner:
        return df.withColumn(out, F.lit(0))
    cut = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol=column, outputCol=out,
                     handleInvalid="error")
    return cut.transform(df).withColumn(out, F.col(out).cast("int"))
