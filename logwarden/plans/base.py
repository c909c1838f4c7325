"""Views that the registered queries share, in Spark and, under the same name, in SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.common import spread
from logwarden.functions.features import above
from logwarden.operators.neighbours import previous_gap_seconds
from logwarden.operators.quantiles import contamination_cut

FEATURES = ["value", "k", "hour", "gap"]
STREAM_FEATURES = ["value", "k", "hour"]
CONTAMINATION = 0.1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def heavy_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows take long to process, on all cores."""
    return spread(table(spark, sf_dir, name))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that engines can be compared.

    A nudge far below the last digit makes every engine break ties the same way; adding zero
    removes the sign of a negative zero.
    """
    return df.select(*[(F.round(F.col(c) + F.lit(1e-9), digits) + F.lit(0.0)).alias(c) if kind == "double" else F.col(c)
                       for c, kind in df.dtypes])


def r(expression: str, digits: int = 6) -> str:
    return f"(ROUND({expression} + 1e-9::DOUBLE, {digits}) + 0.0::DOUBLE)"


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row_id, ts, user_id, label, score, pred``: errors are the anomalies, the value is the score."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"), "ts", "user_id",
        (F.col("event_type") == "error").cast("int").alias("label"), F.col("value").alias("score"))
    return events.withColumn("pred", above("score", contamination_cut(events, "score", CONTAMINATION)))


def cut_sql(column: str, source: str, p: str = "0.9") -> str:
    """A linearly interpolated quantile that gives tied values back unchanged."""
    return f"""(SELECT CASE WHEN lo = hi THEN lo ELSE lo + (hi - lo) * (spot - floor(spot)) END FROM (
    SELECT spot, l[CAST(floor(spot) AS BIGINT) + 1] AS lo, l[CAST(ceil(spot) AS BIGINT) + 1] AS hi FROM (
    SELECT list_sort(list({column}) FILTER ({column} IS NOT NULL)) AS l, {p}::DOUBLE * (count({column}) - 1) AS spot
    FROM {source}) l1) l2)"""


SCORED = f"""
cut AS (SELECT {cut_sql('value', 'events')} AS c),
scored AS (SELECT event_id AS row_id, ts, user_id, CAST(event_type = 'error' AS INTEGER) AS label,
                  value AS score, CAST(value > c AS INTEGER) AS pred FROM events, cut)"""


def event_rows(events: DataFrame) -> DataFrame:
    """Events as log rows with the measurements that need no other row."""
    return events.select(
        F.col("event_id").alias("row_id"), "ts", "user_id",
        (F.col("event_type") == "error").cast("int").alias("label"), "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"), F.hour("ts").cast("double").alias("hour"))


def log_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with measurements, including the gap to the user's previous event."""
    return previous_gap_seconds(event_rows(table(spark, sf_dir, "events")), "user_id", "ts", "row_id")


FEATS = """
feats AS (SELECT event_id AS row_id, ts, user_id, CAST(event_type = 'error' AS INTEGER) AS label, value,
    CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS DOUBLE) AS k,
    CAST(extract(hour FROM ts) AS DOUBLE) AS hour,
    COALESCE((epoch_us(ts) - LAG(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6::DOUBLE,
             0.0::DOUBLE) AS gap
  FROM events)"""


def stats_sql(features: list[str], source: str = "feats", name: str = "st") -> str:
    parts = ", ".join(f"avg({f}) AS m_{f}, CASE WHEN stddev_pop({f}) > 0 THEN stddev_pop({f}) ELSE 1 END AS s_{f}"
                      for f in features)
    return f"{name} AS (SELECT {parts} FROM {source})"


def deviation_sql(features: list[str], source: str = "feats") -> str:
    """CTEs ``st, dev, dcut, dscored`` for the deviation detector."""
    sizes = ", ".join(f"abs(({f} - m_{f}) / s_{f})" for f in features)
    return f"""{stats_sql(features, source)},
dev AS (SELECT {source}.*, greatest({sizes}) AS score FROM {source}, st),
dcut AS (SELECT {cut_sql('score', 'dev')} AS c),
dscored AS (SELECT dev.*, CAST(score > c AS INTEGER) AS pred FROM dev, dcut)"""


def forest_samples_sql(x: str, source: str, trees: int, samples: int, seed: int = 42) -> str:
    """CTEs up to ``drawn``: the rows every tree grows from."""
    return f"""sizes AS (SELECT least({samples}, count(*)) AS take,
            CAST(least({trees}, greatest(1, ceil({trees} * (2 * least({samples}, count(*)) + 40) / count(*)::DOUBLE))) AS BIGINT) AS copies FROM {source}),
        dealt AS (SELECT row_id, x, ({hash_sql('row_id', seed)} + copy) % {trees} AS tree
            FROM (SELECT row_id, {x} AS x, unnest(range(copies)) AS copy FROM {source}, sizes) d),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY {hash_sql("(row_id || '|' || tree)", seed + 1)}, row_id) AS rn FROM dealt),
        drawn AS (SELECT tree, row_id, x FROM ranked, sizes WHERE rn <= take)"""


def forest_sql(features: list[str], source: str = "feats", trees: int = 100, samples: int = 256, seed: int = 42) -> str:
    """CTEs up to ``fscored``: the isolation forest, grown and walked with the same hashes. Needs WITH RECURSIVE."""
    depth = max(1, math.ceil(math.log2(samples)))
    x = "[" + ", ".join(f"CAST({f} AS DOUBLE)" for f in features) + "]"
    n = range(1, len(features) + 1)
    low, high = ("[" + ", ".join(f"{k}(x[{i}]) OVER w" for i in n) + "]" for k in ("min", "max"))
    tree_node = "CAST('0x' || substr(sha256(tree || '|' || node || '|{}'), 1, 13) AS BIGINT)"
    split = f"""SELECT *, lo[f] + {tree_node.format(seed + 1)} / 4503599627370496.0::DOUBLE * (hi[f] - lo[f]) AS cut FROM (
        SELECT *, varied[CAST({tree_node.format(seed)} % greatest(len(varied), 1) AS BIGINT) + 1] AS f FROM (
        SELECT *, list_filter({list(n)}, lambda i: hi[i] > lo[i]) AS varied FROM (
        SELECT tree, level, node, x, count(*) OVER w AS size, {low} AS lo, {high} AS hi FROM {{}} WINDOW w AS (PARTITION BY tree, node)) a) b) c"""
    inner = f"level < {depth} AND size > 1 AND len(varied) > 0"
    mean = f"CASE WHEN {{0}} <= 1 THEN 0 WHEN {{0}} = 2 THEN 1 ELSE 2 * (ln({{0}} - 1.0::DOUBLE) + 0.5772156649::DOUBLE) - 2 * ({{0}} - 1.0::DOUBLE) / {{0}} END"
    return f"""{forest_samples_sql(x, source, trees, samples, seed)},
        grow AS (SELECT tree, 0 AS level, CAST(0 AS BIGINT) AS node, x FROM drawn
            UNION ALL SELECT tree, level + 1, CASE WHEN x[f] <= cut THEN 2 * node + 1 ELSE 2 * node + 2 END, x
            FROM ({split.format('grow')}) s WHERE {inner}),
        nodes AS (SELECT DISTINCT tree, node, {inner} AS goes, f, cut, size, level + {mean.format('size')} AS path
            FROM ({split.format('(SELECT *, level AS l FROM grow)')}) s),
        walk AS (SELECT row_id, {x} AS x, tree, CAST(0 AS BIGINT) AS node FROM {source}, range({trees}) r(tree)
            UNION ALL SELECT row_id, x, w.tree, CASE WHEN x[f] <= cut THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END
            FROM walk w JOIN nodes k ON w.tree = k.tree AND w.node = k.node WHERE goes),
        fraw AS (SELECT row_id, pow(2, -(avg(path) / any_value({mean.format('take')}))) AS score
            FROM walk w JOIN nodes k ON w.tree = k.tree AND w.node = k.node, sizes WHERE NOT goes GROUP BY row_id),
        fcut AS (SELECT {cut_sql('score', 'fraw')} AS c),
        fscored AS (SELECT row_id, score - c AS score, CAST(score > c AS INTEGER) AS pred FROM fraw, fcut)"""


def host_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines seen as host metrics; some values are missing, some below zero or above 100."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") * 4 - 60).alias("cpu_usage"), (F.col("l_discount") * 1500).alias("memory_usage"),
        F.when(F.col("l_tax") != 0.08, F.col("l_tax") * 1000).alias("disk_usage"),
        F.col("l_extendedprice").alias("bytes_sent"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("bytes_received"),
        F.col("l_linenumber").cast("bigint").alias("active_connections"),
        (F.col("l_partkey") % 300).cast("double").alias("process_count"))


HOST_LINEITEM = """
host AS (SELECT l_quantity * 4 - 60 AS cpu_usage, l_discount * 1500 AS memory_usage,
    CASE WHEN l_tax <> 0.08::DOUBLE THEN l_tax * 1000 END AS disk_usage, l_extendedprice AS bytes_sent,
    l_extendedprice * (1 - l_discount) AS bytes_received, CAST(l_linenumber AS BIGINT) AS active_connections,
    CAST(l_partkey % 300 AS DOUBLE) AS process_count FROM lineitem)"""


def host_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events seen as host metrics, with a row id."""
    rows = event_rows(table(spark, sf_dir, "events"))
    return rows.select(
        "row_id", F.col("value").alias("cpu_usage"), F.col("k").alias("memory_usage"),
        (F.col("hour") * 4).alias("disk_usage"), (F.col("value") * 1000).alias("bytes_sent"),
        (F.col("k") * 500).alias("bytes_received"), (F.col("user_id") % 40).alias("active_connections"),
        (F.col("row_id") % 200).cast("double").alias("process_count"))


HOST_EVENTS = f"""{FEATS},
hostev AS (SELECT row_id, value AS cpu_usage, k AS memory_usage, hour * 4 AS disk_usage, value * 1000 AS bytes_sent,
    k * 500 AS bytes_received, user_id % 40 AS active_connections, CAST(row_id % 200 AS DOUBLE) AS process_count
  FROM feats)"""


def hash_sql(key: str, seed: int) -> str:
    """The portable 52-bit hash of a key."""
    return f"CAST('0x' || substr(sha256(CAST({key} AS VARCHAR) || '|{seed}'), 1, 13) AS BIGINT)"


