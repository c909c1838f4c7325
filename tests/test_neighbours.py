import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.operators.neighbours import large_entities, previous_gap_seconds, sequence_table


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(8)
    users = np.where(rng.random(900) < 0.35, 0, rng.integers(1, 30, 900))  # one user holds a third
    times = rng.integers(0, 400, 900)  # many equal times
    rows = [(i, int(u), float(t), float(rng.normal())) for i, (u, t) in enumerate(zip(users, times))]
    df = spark.createDataFrame(rows, "row_id bigint, user_id bigint, s double, v double")
    return df.withColumn("ts", F.timestamp_seconds("s")).repartition(6).persist()


def ordered(events):
    by_user = {}
    for r in sorted(events.collect(), key=lambda r: (r["s"], r["row_id"])):
        by_user.setdefault(r["user_id"], []).append(r)
    return by_user


@pytest.mark.parametrize("limit", [None, 100, 20, 4])
def test_gap_is_exact_when_large_entities_are_split(events, limit):
    assert (large_entities(events, "user_id", "ts", limit) is not None) == (limit is not None)
    expect = {}
    for rows in ordered(events).values():
        for i, r in enumerate(rows):
            expect[r["row_id"]] = r["s"] - rows[i - 1]["s"] if i else 0.0
    got = previous_gap_seconds(events, "user_id", "ts", "row_id", limit=limit)
    assert got.columns == [*events.columns, "gap"]
    assert {r["row_id"]: r["gap"] for r in got.collect()} == expect


@pytest.mark.parametrize("assign", ["first", "last"])
@pytest.mark.parametrize("limit", [None, 40, 3])
def test_windows_are_exact_when_large_entities_are_split(events, assign, limit):
    length = 5
    wide, steps = sequence_table(events, ["v"], "user_id", "ts", "row_id", length, assign, limit)
    got = {r["row_id"]: [r[s[0]] for s in steps] for r in wide.where("_full").collect()}
    expect = {}
    for rows in ordered(events).values():
        for i in range(len(rows) - length + 1):
            owner = rows[i if assign == "first" else i + length - 1]
            expect[owner["row_id"]] = [r["v"] for r in rows[i:i + length]]
    assert got == expect
    assert wide.count() == 900


@pytest.mark.parametrize("times", [1, 10])
def test_pieces_keep_their_size_when_the_table_grows(spark, times):
    rows = spark.range(3000 * times).select((F.col("id") % 3).alias("user_id"), F.timestamp_seconds("id").alias("ts"), "id")
    cuts = large_entities(rows, "user_id", "ts", 400).collect()
    assert len(cuts) == 3
    for user in cuts:
        edges = [0, *[c // 1_000_000 for c in user["_cuts"]], 3000 * times]
        assert max(b - a for a, b in zip(edges, edges[1:])) / 3 < 3 * 400


@pytest.mark.parametrize("kind", ["one time", "no entity"])
def test_pieces_of_equal_times_and_null_entities(spark, kind):
    """Nearly all rows of one entity at one time, or without an entity: the plain windows, in bounded pieces."""
    from pyspark.sql import Window

    from logwarden.operators.neighbours import _with_pieces

    odd = F.col("id") % 100 == 0
    user = F.when(odd, F.col("id") % 7) if kind == "no entity" else F.when(odd, F.col("id") % 7).otherwise(50)
    second = F.lit(5) if kind == "one time" else F.col("id") % 11
    rows = spark.range(4000).select(F.col("id").alias("row_id"), user.alias("user_id"), F.timestamp_seconds(second).alias("ts"),
                                    F.col("id").cast("double").alias("v")).repartition(5).persist()
    placed, split = _with_pieces(rows, "user_id", "ts", "row_id", 60)
    assert split and placed.groupBy("user_id", "_piece").count().agg(F.max("count")).first()[0] < 3 * 60
    order = Window.partitionBy("user_id").orderBy("ts", "row_id")
    plain = rows.select("row_id", *[F.lead("v", k).over(order).alias(f"v__{k}") for k in (1, 2)])
    wide, _ = sequence_table(rows, ["v"], "user_id", "ts", "row_id", 3, "first", 60)
    assert sorted(wide.select("row_id", "v__1", "v__2").collect()) == sorted(plain.collect())
    gap = previous_gap_seconds(rows, "user_id", "ts", "row_id", limit=60)
    before = rows.select("row_id", F.coalesce(F.col("ts").cast("double") - F.lag("ts").over(order).cast("double"), F.lit(0.0)).alias("gap"))
    assert sorted(gap.select("row_id", "gap").collect()) == sorted(before.collect())


def test_bad_arguments(events):
    with pytest.raises(ValueError):
        sequence_table(events, ["v"], "user_id", "ts", "row_id", 1)
    with pytest.raises(ValueError):
        sequence_table(events, ["v"], "user_id", "ts", "row_id", 5, "middle")
