"""Registered queries: derived columns, injection, profiles, histograms, plot tables, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.detectors import make_detector
from logwarden.functions import features as ft
from logwarden.operators import inject, profile, quality, sketches
from logwarden.operators.metrics import precision_at_k
from logwarden.operators.scaling import fit_scale
from logwarden.operators.neighbours import sequence_table
from logwarden.plans.base import (
    CONTAMINATION, FEATS, FEATURES, HOST_EVENTS, HOST_LINEITEM, SCORED, hash_sql, host_events, host_lineitem,
    log_features, r, rounded, scored_events, stats_sql, table)
from logwarden.sources.tables import append_batch

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def derive_features(spark, sf_dir):
    return rounded(log_features(spark, sf_dir).select("row_id", "user_id", *FEATURES))


def host_features(spark, sf_dir):
    return rounded(ft.derive_features(host_events(spark, sf_dir)).select(
        "row_id", "cpu_memory_ratio", "network_activity", "resource_pressure"))


def clamp_bounds(spark, sf_dir):
    host = ft.floor_at_zero(host_lineitem(spark, sf_dir))
    return rounded(ft.cap_percentages(host))


def inject_patterns(spark, sf_dir):
    return rounded(inject.inject_anomalies(host_events(spark, sf_dir), CONTAMINATION))


def lines_by_class(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select((F.col("l_returnflag") == "R").cast("int").alias("label"), *LINE_NUMBERS)


def standardise(spark, sf_dir):
    rows = log_features(spark, sf_dir)
    scale = fit_scale(rows, FEATURES)
    return rounded(rows.select("row_id", *[z.alias(c) for c, z in zip(
        FEATURES, scale.scaled([F.col(c) for c in FEATURES]), strict=True)]))



def numeric_view(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") - 25).alias("shifted"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_discount") == 0, float("nan")).otherwise(F.col("l_discount")).alias("holes"),
        F.when(F.col("l_tax") == 0, float("inf")).otherwise(F.col("l_tax")).alias("endless"))


def append_batches(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    early, late = events.where(F.dayofmonth("ts") <= 15), events.where(F.dayofmonth("ts") > 15)
    return append_batch(early, late)


def sequence_windows(spark, sf_dir, assign="first"):
    """Mean of the value over each window of ten events of a user."""
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_id"), "ts", "user_id", "value")
    wide, steps = sequence_table(events, ["value"], "user_id", "ts", "row_id", 10, assign)
    total = sum((F.col(step[0]) for step in steps), F.lit(0.0))
    return rounded(wide.select("row_id", F.when(F.col("_full"), total / 10).otherwise(0.0).alias("score"),
                               F.col("_full").cast("int").alias("complete")))


def _ntz(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _daily(spark, sf_dir):
    """Sketches per day, stored and read back."""
    events = table(spark, sf_dir, "events")
    return events, written(sketches.daily_sketches(events, "ts", ["value"], ["user_id", "event_id"]), "daily-sketches")


def sketched_cut(spark, sf_dir):
    """The cut-off of all days from stored sketches, and whether its rank is as near as stated."""
    events, daily = _daily(spark, sf_dir)
    cut = sketches.sketch_cut(daily, "value", 0.1)
    # The value itself takes a range of ranks; the nearer end counts.
    seen = events.agg(F.count("value").alias("n"), F.count_if(F.col("value") < cut).alias("below"), F.count_if(F.col("value") <= cut).alias("upto"))
    off = F.greatest(F.lit(0.0), F.col("below") / F.col("n") - 0.9, 0.9 - F.col("upto") / F.col("n"))
    days = daily.agg(F.count(F.lit(1)).alias("days"), F.sum("rows").alias("rows"))
    return days.crossJoin(seen).select("days", "rows", (off <= sketches.rank_error()).alias("within"))


def sketched_distinct(spark, sf_dir):
    """Distinct users and events of all days from stored sketches, and whether they lie within four standard errors."""
    events, daily = _daily(spark, sf_dir)
    exact = events.agg(*[F.countDistinct(c).alias(c) for c in ("user_id", "event_id")]).unpivot([], ["user_id", "event_id"], "column", "exact")
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.col("exact") * (4 * sketches.distinct_error())
    return exact.join(sketches.sketch_distinct(daily, ["user_id", "event_id"]), "column").select("column", "exact", near.alias("within"))


def refused_parameters(spark, sf_dir):
    """Which of the values found in the order lines are refused as which parameter."""
    values = [r["v"] for r in table(spark, sf_dir, "lineitem").select(
        ((F.col("l_discount") * 100).cast("int") / 2 - 1.0).alias("v")).distinct().orderBy("v").collect()]  # eleven discounts
    scored = scored_events(spark, sf_dir)
    uses = {"contamination": lambda v: make_detector("deviation", contamination=v), "trees": lambda v: make_detector("isolation_forest", n_trees=v),
            "samples": lambda v: make_detector("isolation_forest", max_samples=v),
            "sequence_length": lambda v: sequence_table(scored, ["score"], "user_id", "ts", "row_id", int(v)), "k": lambda v: precision_at_k(scored, [int(v)])}

    def refused(use, value: float) -> bool:
        try:
            use(value)
        except ValueError:
            return True
        return False

    kind = "value double, " + ", ".join(f"{name} boolean" for name in uses)
    return spark.createDataFrame([(v, *[refused(use, v) for use in uses.values()]) for v in values], kind)


QUERIES = {
    "sketched_cut": sketched_cut,
    "sketched_distinct": sketched_distinct,
    "derive_features": derive_features,
    "host_features": host_features,
    "clamp_bounds": clamp_bounds,
    "inject_patterns": inject_patterns,
    "outcome_tags": lambda s, d: profile.outcome_counts(scored_events(s, d)),
    "unpivot_summary": lambda s, d: rounded(profile.class_summary(lines_by_class(s, d), LINE_NUMBERS)),
    "unpivot_rows": lambda s, d: ft.to_long(scored_events(s, d), ["row_id", "label"], ["score", "pred"]),
    "hours_since_start": lambda s, d: rounded(ft.hours_since(
        table(s, d, "events").select("event_id", "ts"), "ts").select("event_id", "hours")),
    "standardise": standardise,
    "anomalies_only": lambda s, d: profile.anomalies_only(scored_events(s, d)).select("row_id", "score", "label"),
    "feature_and_label": lambda s, d: log_features(s, d).select("gap", "label").transform(rounded),
    "describe": lambda s, d: rounded(profile.describe(table(s, d, "lineitem").select(*LINE_NUMBERS)), 4),
    "class_counts": lambda s, d: profile.class_counts(scored_events(s, d)),
    "key_figures": lambda s, d: rounded(profile.key_figures(scored_events(s, d))),
    "distinct_counts": lambda s, d: profile.distinct_counts(table(s, d, "events"), ["user_id", "event_type"]),
    "validate_table": lambda s, d: quality.validate_table(host_lineitem(s, d)),
    "validate_missing_column": lambda s, d: quality.validate_table(host_lineitem(s, d).drop("cpu_usage")),
    "validate_no_numbers": lambda s, d: quality.validate_table(table(s, d, "events").select("event_type", "ts")),
    "refused_parameters": refused_parameters,
    "missing_values": lambda s, d: quality.missing_cells(host_lineitem(s, d)),
    "iqr_outliers": lambda s, d: rounded(quality.iqr_outliers(log_features(s, d), FEATURES), 4),
    "iqr_outlier_rows": lambda s, d: _outlier_rows(s, d),
    "numeric_checks": lambda s, d: quality.numeric_checks(numeric_view(s, d)),
    "validate_matrix": lambda s, d: quality.validate_matrix(numeric_view(s, d)),
    "dataset_completeness": lambda s, d: quality.label_completeness(
        table(s, d, "documents"), table(s, d, "labels"), "doc_id"),
    "score_histogram": lambda s, d: rounded(profile.score_histogram(scored_events(s, d))),
    "feature_histogram": lambda s, d: rounded(profile.feature_histogram(log_features(s, d), "gap")),
    "recent_activity": lambda s, d: rounded(profile.recent_activity(scored_events(s, d))),
    "recent_rows": lambda s, d: profile.recent_rows(scored_events(s, d)),
    "explain_candidates": lambda s, d: profile.explain_candidates(scored_events(s, d)).select("row_id", "score"),
    "explain_candidates_by_score": lambda s, d: profile.explain_candidates(
        scored_events(s, d), by_score=True).select("row_id", "score"),
    "append_batches": append_batches,
    "sequence_windows": sequence_windows,
    "sequence_windows_causal": lambda s, d: sequence_windows(s, d, "last"),
    "time_series": lambda s, d: _ntz(rounded(profile.time_series(
        log_features(s, d), "value", every="6 hours")), "start"),
    "network_panel": lambda s, d: _ntz(rounded(profile.panel(log_features(s, d), FEATURES)), "start"),
    "scatter_grid": lambda s, d: profile.scatter_grid(
        scored_events(s, d).withColumn("hour", F.hour("ts")), "score", "hour"),
    "scatter_sample": lambda s, d: profile.scatter_sample(
        scored_events(s, d).withColumn("hour", F.hour("ts")), "score", "hour", 300),
}


def _outlier_rows(spark, sf_dir):
    rows = log_features(spark, sf_dir)
    _, _, low, high = quality.iqr_bounds(rows, ["value"])["value"]
    return rows.where(quality.outside("value", low, high)).select("row_id", "value")


def _describe_sql() -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})', 4)} AS mean,
        {r(f'stddev_samp({c})', 4)} AS std, {r(f'min({c})', 4)} AS min, {r(f'quantile_cont({c}, 0.25)', 4)} AS p25,
        {r(f'quantile_cont({c}, 0.5)', 4)} AS p50, {r(f'quantile_cont({c}, 0.75)', 4)} AS p75, {r(f'max({c})', 4)} AS max
        FROM lineitem""" for c in LINE_NUMBERS)


def _summary_sql() -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS feature, CAST(l_returnflag = 'R' AS INTEGER) AS class, count({c}) AS n,
        {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max,
        {r(f'quantile_cont({c}, 0.25)')} AS p25, {r(f'quantile_cont({c}, 0.5)')} AS p50,
        {r(f'quantile_cont({c}, 0.75)')} AS p75 FROM lineitem GROUP BY 2""" for c in LINE_NUMBERS)


_HOST = ["cpu_usage", "memory_usage", "disk_usage", "bytes_sent", "bytes_received", "active_connections", "process_count"]


def _iqr_sql(columns: list[str], source: str) -> str:
    parts = []
    for c in columns:
        parts.append(f"""SELECT '{c}' AS "column", any_value(q1) AS q1, any_value(q3) AS q3,
            any_value(q1 - 1.5::DOUBLE * (q3 - q1)) AS low, any_value(q3 + 1.5::DOUBLE * (q3 - q1)) AS high,
            count(*) FILTER ({c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers
            FROM {source}, (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {source}) q""")
    return " UNION ALL ".join(parts)


def _inject_sql() -> str:
    cpu = "CASE pattern WHEN 'cpu_spike' THEN 3.0::DOUBLE WHEN 'memory_leak' THEN 1.2::DOUBLE " \
          "WHEN 'process_explosion' THEN 2.0::DOUBLE WHEN 'disk_full' THEN 1.3::DOUBLE ELSE 1 END"
    memory = "CASE pattern WHEN 'cpu_spike' THEN 1.5::DOUBLE WHEN 'memory_leak' THEN 2.5::DOUBLE ELSE 1 END"
    disk = "CASE pattern WHEN 'disk_full' THEN 2.0::DOUBLE ELSE 1 END"
    flood = "CASE pattern WHEN 'network_flood' THEN 5.0::DOUBLE ELSE 1 END"
    links = "CASE pattern WHEN 'network_flood' THEN 4 ELSE 1 END"
    many = "CASE pattern WHEN 'process_explosion' THEN 3.0::DOUBLE ELSE 1 END"

    def capped(c, f):
        return f"CASE WHEN anomaly_label = 1 THEN least({c} * {f}, 100) ELSE {c} END AS {c}"

    return f"""WITH {HOST_EVENTS},
h AS (SELECT *, {hash_sql('row_id', 42)} AS h1, {hash_sql('row_id', 43)} AS h2 FROM hostev),
p AS (SELECT *, CAST(row_number() OVER (ORDER BY h1, row_id)
        <= CAST(floor((SELECT count(*) FROM hostev) * 0.1::DOUBLE) AS BIGINT) AS INTEGER) AS anomaly_label FROM h),
q AS (SELECT * EXCLUDE (h1, h2), CASE WHEN anomaly_label = 1 THEN
        ['cpu_spike', 'memory_leak', 'network_flood', 'process_explosion', 'disk_full'][h2 % 5 + 1] END AS pattern FROM p),
m AS (SELECT row_id, anomaly_label, pattern, {capped('cpu_usage', cpu)}, {capped('memory_usage', memory)},
        {capped('disk_usage', disk)}, bytes_sent * {flood} AS bytes_sent, bytes_received * {flood} AS bytes_received,
        active_connections * {links} AS active_connections, process_count * {many} AS process_count FROM q)
SELECT row_id, anomaly_label, pattern, CAST(active_connections AS BIGINT) AS active_connections,
    {', '.join(f'{r(c)} AS {c}' for c in _HOST if c != 'active_connections')},
    {r('cpu_usage / (memory_usage + 1e-6::DOUBLE)')} AS cpu_memory_ratio,
    {r('bytes_sent + bytes_received')} AS network_activity,
    {r('(cpu_usage + memory_usage + disk_usage) / 3')} AS resource_pressure FROM m"""


def _bin_sql(v: str, lo: str, hi: str) -> str:
    return f"greatest(0, least(49, CAST(floor(COALESCE(({v} - {lo}) * 50 / NULLIF({hi} - {lo}, 0), 0)) AS INTEGER)))"


def _sequence_sql(frame: str) -> str:
    return f"""SELECT event_id AS row_id, {r('CASE WHEN n = 10 THEN m ELSE 0 END')} AS score,
        CAST(n = 10 AS INTEGER) AS complete FROM (SELECT event_id, avg(value) OVER w AS m, count(*) OVER w AS n FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {frame})) t"""


_OUTCOME = "CASE WHEN label = 1 AND pred = 1 THEN 'TP' WHEN pred = 1 THEN 'FP' WHEN label = 1 THEN 'FN' ELSE 'TN' END"
_CHECKS = {"shifted": "l_quantity - 25", "price": "l_extendedprice",
           "holes": "CASE WHEN l_discount = 0 THEN 'NaN'::DOUBLE ELSE l_discount END",
           "endless": "CASE WHEN l_tax = 0 THEN 'Infinity'::DOUBLE ELSE l_tax END"}
_CHECK_ROWS = " UNION ALL ".join(f"""SELECT '{n}' AS "column", count(*) FILTER (isnan({x})) AS nan,
    count(*) FILTER (isinf({x})) AS infinite, count(*) FILTER ({x} < 0) AS negative FROM lineitem"""
                                 for n, x in _CHECKS.items())

def _findings_sql(columns: list[str]) -> str:
    return f"""WITH {HOST_LINEITEM}, i AS ({_iqr_sql(columns, 'host')}),
        nul AS (SELECT CAST({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in columns)} AS BIGINT) AS n FROM host)
        SELECT 'warning' AS severity, 'missing_values' AS "check", CAST(NULL AS VARCHAR) AS "column", n,
            'Found ' || n || ' missing values' AS detail FROM nul WHERE n > 0
        UNION ALL SELECT 'warning', 'outliers', "column", outliers, 'Found ' || outliers || ' outliers in column ' || "column"
            FROM i WHERE outliers > 0"""


ORACLES = {
    "sketched_cut": "SELECT count(DISTINCT CAST(ts AS DATE)) AS days, CAST(count(*) AS BIGINT) AS rows, true AS within FROM events",
    "sketched_distinct": """SELECT 'user_id' AS "column", count(DISTINCT user_id) AS exact, true AS within FROM events
        UNION ALL SELECT 'event_id', count(DISTINCT event_id), true FROM events""",
    "derive_features": f"WITH {FEATS} SELECT row_id, user_id, {r('value')} AS value, {r('k')} AS k, {r('hour')} AS hour, {r('gap')} AS gap FROM feats",
    "host_features": f"""WITH {HOST_EVENTS} SELECT row_id, {r('cpu_usage / (memory_usage + 1e-6::DOUBLE)')} AS cpu_memory_ratio,
        {r('bytes_sent + bytes_received')} AS network_activity,
        {r('(cpu_usage + memory_usage + disk_usage) / 3')} AS resource_pressure FROM hostev""",
    "clamp_bounds": f"""WITH {HOST_LINEITEM} SELECT {', '.join(
        f"{r(f'CASE WHEN {c} < 0 THEN 0 WHEN {c} > 100 THEN 100 ELSE {c} END')} AS {c}" for c in _HOST[:3])}, {', '.join(
        f"{r(f'CASE WHEN {c} < 0 THEN 0 ELSE {c} END')} AS {c}" for c in _HOST[3:] if c != 'active_connections')},
        CASE WHEN active_connections < 0 THEN 0 ELSE active_connections END AS active_connections FROM host""",
    "inject_patterns": _inject_sql(),
    "outcome_tags": f"WITH {SCORED} SELECT {_OUTCOME} AS outcome, count(*) AS n FROM scored GROUP BY 1",
    "unpivot_summary": _summary_sql(),
    "unpivot_rows": f"""WITH {SCORED} SELECT row_id, label, 'score' AS feature, score AS value FROM scored
        UNION ALL SELECT row_id, label, 'pred', CAST(pred AS DOUBLE) FROM scored""",
    "hours_since_start": f"""SELECT event_id, {r('(epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) / 3.6e9::DOUBLE')} AS hours
        FROM events""",
    "standardise": f"WITH {FEATS}, {stats_sql(FEATURES)} SELECT row_id, " + ", ".join(
        f"{r(f'({f} - m_{f}) / s_{f}')} AS {f}" for f in FEATURES) + " FROM feats, st",
    "anomalies_only": f"WITH {SCORED} SELECT row_id, score, label FROM scored WHERE label = 1",
    "feature_and_label": f"WITH {FEATS} SELECT {r('gap')} AS gap, label FROM feats",
    "describe": _describe_sql(),
    "class_counts": f"WITH {SCORED} SELECT label, count(*) AS n FROM scored GROUP BY label",
    "key_figures": f"""WITH {SCORED} SELECT count(*) AS "rows", count(*) FILTER (label = 1) AS anomalies,
        {r('count(*) FILTER (label = 1)::DOUBLE / count(*)')} AS anomaly_share, count(*) FILTER (pred = 1) AS detected,
        {r('count(*) FILTER (pred = 1)::DOUBLE / count(*)')} AS detected_share,
        {r('count(*) FILTER (pred = label)::DOUBLE / count(*)')} AS accuracy FROM scored""",
    "distinct_counts": """SELECT count(DISTINCT user_id) AS distinct_user_id, count(DISTINCT event_type) AS distinct_event_type
        FROM events""",
    "validate_table": _findings_sql(_HOST),
    "validate_missing_column": _findings_sql([c for c in _HOST if c != "cpu_usage"])
    + " UNION ALL SELECT 'error', 'required_column', 'cpu_usage', 1, 'Missing required column: cpu_usage'",
    "validate_no_numbers": """SELECT 'error' AS severity, 'required_column' AS "check", c AS "column", CAST(1 AS BIGINT) AS n,
            'Missing required column: ' || c AS detail FROM (SELECT unnest(['cpu_usage', 'memory_usage']) AS c) t
        UNION ALL SELECT 'warning', 'numeric_columns', NULL, 0, 'No numeric columns found'
        UNION ALL SELECT 'warning', 'missing_values', NULL, n, 'Found ' || n || ' missing values' FROM (
            SELECT count(*) FILTER (event_type IS NULL) + count(*) FILTER (ts IS NULL) AS n FROM events) m WHERE n > 0""",
    "refused_parameters": """SELECT v AS "value", v <= 0 OR v >= 1 AS contamination, v < 1 AS trees, v < 2 AS samples, v < 2 AS sequence_length, v < 1 AS k
        FROM (SELECT DISTINCT CAST(l_discount * 100 AS INTEGER) / 2 - 1.0::DOUBLE AS v FROM lineitem) t""",
    "missing_values": f"""WITH {HOST_LINEITEM}
        SELECT CAST({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in _HOST)} AS BIGINT) AS missing FROM host""",
    "iqr_outliers": f"""WITH {FEATS}, i AS ({_iqr_sql(FEATURES, 'feats')}) SELECT "column", {r('q1', 4)} AS q1, {r('q3', 4)} AS q3,
        {r('low', 4)} AS low, {r('high', 4)} AS high, outliers FROM i""",
    "iqr_outlier_rows": """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
        SELECT event_id AS row_id, value FROM events, q
        WHERE value < q1 - 1.5::DOUBLE * (q3 - q1) OR value > q3 + 1.5::DOUBLE * (q3 - q1)""",
    "numeric_checks": _CHECK_ROWS,
    "validate_matrix": f"""WITH c AS ({_CHECK_ROWS}) SELECT 'warning' AS severity, 'nan' AS "check", "column", nan AS n,
            'values are NaN' AS detail FROM c WHERE nan > 0
        UNION ALL SELECT 'warning', 'infinite', "column", infinite, 'values are infinite' FROM c WHERE infinite > 0
        UNION ALL SELECT 'warning', 'negative', "column", negative, 'values are negative' FROM c WHERE negative > 0""",
    "dataset_completeness": """SELECT (SELECT count(*) FROM documents) AS "rows",
        (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS labelled,
        (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS unlabelled,
        (SELECT count(DISTINCT doc_id) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS orphan_labels""",
    "score_histogram": f"""WITH {SCORED}, e AS (SELECT label AS class, min(score) AS lo, max(score) AS hi, count(*) AS total
            FROM scored GROUP BY label),
        b AS (SELECT class, {_bin_sql('score', 'lo', 'hi')} AS bin, count(*) AS n FROM scored JOIN e ON label = class GROUP BY 1, 2),
        grid AS (SELECT e.*, CAST(i AS INTEGER) AS bin, (hi - lo) / 50 AS width FROM e, range(50) t(i))
        SELECT class, bin, {r('lo + bin * width')} AS left_edge, COALESCE(n, 0) AS n,
            {r('COALESCE(n, 0) / (total * width)')} AS density FROM grid LEFT JOIN b USING (class, bin)""",
    "feature_histogram": f"""WITH {FEATS}, e AS (SELECT min(gap) AS lo, max(gap) AS hi FROM feats),
        b AS (SELECT label AS class, {_bin_sql('gap', 'lo', 'hi')} AS bin, count(*) AS n FROM feats, e GROUP BY 1, 2),
        grid AS (SELECT c AS class, CAST(i AS INTEGER) AS bin, lo, hi FROM e, range(50) t(i), (VALUES (0), (1)) x(c))
        SELECT class, bin, {r('lo + bin * ((hi - lo) / 50)')} AS left_edge, COALESCE(n, 0) AS n FROM grid LEFT JOIN b USING (class, bin)""",
    "recent_activity": f"""WITH {SCORED}, l AS (SELECT * FROM scored ORDER BY ts DESC, row_id DESC LIMIT 100)
        SELECT count(*) AS "rows", count(*) FILTER (pred = 1) AS flagged, count(*) FILTER (label = 1) AS anomalies,
        {r('count(*) FILTER (label = 1)::DOUBLE / count(*)')} AS anomaly_rate,
        CASE WHEN count(*) FILTER (pred = 1) > 0 THEN 'ALERT' ELSE 'NORMAL' END AS status FROM l""",
    "recent_rows": f"WITH {SCORED} SELECT * FROM scored ORDER BY ts DESC, row_id DESC LIMIT 100",
    "explain_candidates": f"WITH {SCORED} SELECT row_id, score FROM scored WHERE pred = 1 ORDER BY row_id LIMIT 10",
    "explain_candidates_by_score": f"""WITH {SCORED} SELECT row_id, score FROM scored WHERE pred = 1
        ORDER BY score DESC, row_id LIMIT 10""",
    "append_batches": "SELECT event_id, ts, value FROM events",
    "sequence_windows": _sequence_sql("CURRENT ROW AND 9 FOLLOWING"),
    "sequence_windows_causal": _sequence_sql("9 PRECEDING AND CURRENT ROW"),
    "time_series": f"""WITH {FEATS} SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS "start", label AS class,
        count(*) AS n, {r('avg(value)')} AS mean, {r('min(value)')} AS min, {r('max(value)')} AS max FROM feats GROUP BY 1, 2""",
    "network_panel": f"WITH {FEATS} " + " UNION ALL ".join(
        f"""SELECT date_trunc('day', ts)::TIMESTAMP AS "start", label AS class, '{f}' AS feature, {r(f'avg({f})')} AS mean
        FROM feats GROUP BY 1, 2""" for f in FEATURES),
    "scatter_grid": f"""WITH {SCORED}, p AS (SELECT *, extract(hour FROM ts)::DOUBLE AS hour FROM scored),
        e AS (SELECT min(score) AS lx, max(score) AS hx, min(hour) AS ly, max(hour) AS hy FROM p)
        SELECT {_bin_sql('score', 'lx', 'hx')} AS bin_x, {_bin_sql('hour', 'ly', 'hy')} AS bin_y, {_OUTCOME} AS outcome,
        count(*) AS n FROM p, e GROUP BY 1, 2, 3""",
    "scatter_sample": f"""WITH {SCORED} SELECT row_id, score, CAST(extract(hour FROM ts) AS INTEGER) AS hour, {_OUTCOME} AS outcome
        FROM scored ORDER BY {hash_sql('row_id', 42)}, row_id LIMIT 300""",
}
