"""Stored sketches against exact answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.operators import sketches


@pytest.fixture(scope="module")
def daily(spark):
    draw = np.random.default_rng(2)
    rows = [(int(i), float(v), int(u)) for i, v, u in zip(range(40_000), draw.lognormal(size=40_000), draw.integers(0, 9000, 40_000))]
    df = spark.createDataFrame(rows, "id long, v double, u long").withColumn("ts", F.timestamp_seconds(F.col("id") * 60))
    df = df.unionByName(df.limit(5).withColumn("v", F.lit(float("nan")))).unionByName(df.limit(5).withColumn("v", F.lit(None).cast("double")))
    return df, written(sketches.daily_sketches(df, "ts", ["v"], ["u"]), "sketches")


def test_cut_over_many_days(daily):
    df, stored = daily
    assert stored.count() == 28
    for contamination in (0.5, 0.1, 0.01):
        cut = sketches.sketch_cut(stored, "v", contamination)
        below = df.where(~F.isnan("v") & (F.col("v") <= cut)).count() / 40_000
        assert abs(below - (1 - contamination)) <= sketches.rank_error()
    week = stored.where("day < '1970-01-08'")
    assert sketches.merged(week, ["v"]).first()["days"] == 7
    with pytest.raises(ValueError):
        sketches.sketch_cut(stored, "v", 1.0)


def test_distinct_over_many_days(daily):
    df, stored = daily
    exact = df.select("u").distinct().count()
    (row,) = sketches.sketch_distinct(stored, ["u"]).collect()
    assert row["column"] == "u" and abs(row["estimate"] - exact) <= 4 * sketches.distinct_error() * exact
