"""Registered queries: detectors, ensembles, reconstruction, explanation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.common import written
from logwarden.detectors import make_detector
from logwarden.detectors.linear import pca_points
from logwarden.functions.features import micros
from logwarden.operators import explain, profile
from logwarden.operators.metrics import flag_metrics
from logwarden.plans.base import FEATS, FEATURES, STREAM_FEATURES, cut_sql, deviation_sql, forest_samples_sql, forest_sql, hash_sql, log_features, r, rounded, table

LINES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MONEY = ["qty", "price", "net", "gross"]
TREES = 12


def _scored(spark, sf_dir) -> DataFrame:
    return make_detector("deviation", features=FEATURES).fit_score(log_features(spark, sf_dir))


def _shown(scored: DataFrame) -> DataFrame:
    return rounded(scored.select("row_id", "score", "pred"))


def zscore_explain(spark, sf_dir):
    return rounded(explain.zscore_explanation(_scored(spark, sf_dir), FEATURES, max_features=3), 4)


def zscore_explain_asked(spark, sf_dir):
    """Explain the first ten flagged rows against all other rows."""
    scored = _scored(spark, sf_dir)
    asked = profile.explain_candidates(scored).select("row_id")
    return rounded(explain.zscore_explanation(scored, FEATURES, asked, baseline="asked"), 4)


def explain_dispatch(spark, sf_dir):
    """The z-score explanation through the dispatcher."""
    return rounded(explain.explain(_scored(spark, sf_dir), method="zscore", features=FEATURES, max_features=3), 4)


def default_features(spark, sf_dir):
    """A detector that chooses its features: every numeric column that is no key, label or score."""
    return _shown(make_detector("deviation").fit_score(log_features(spark, sf_dir)))


def explanation_report(spark, sf_dir):
    long = explain.zscore_explanation(_scored(spark, sf_dir), FEATURES, max_features=2)
    return explain.explanation_report(long).select("row_id", "rank", "feature", "flag")


def nested_explanation(spark, sf_dir):
    nested = explain.nested_explanation(_scored(spark, sf_dir), FEATURES, max_features=3)
    return nested.select("row_id", F.array_join("top_features.feature", ">").alias("features"))


def feature_importance(spark, sf_dir):
    return rounded(profile.feature_importance(explain.zscore_explanation(_scored(spark, sf_dir), FEATURES)), 4)


def _members():
    return [make_detector("deviation", features=["value", "k"]), make_detector("deviation", features=["gap"])]


def _ensemble(**settings):
    return lambda s, d: _shown(make_detector("ensemble", detectors=_members(), **settings).fit_score(log_features(s, d)))


def pca_2d(spark, sf_dir):
    points = pca_points(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINES), LINES)
    return rounded(points.select("l_orderkey", "l_linenumber", "pc1", "pc2", "explained_1", "explained_2"), 4)


def linear_reconstruction(spark, sf_dir):
    """Order lines whose price, net and gross amounts do not fit together as usual."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        net.alias("net"), (net * (1 + F.col("l_tax"))).alias("gross"))
    scored = make_detector("linear", features=MONEY, components=2).fit_score(lines)
    return rounded(scored.select("l_orderkey", "l_linenumber", "score", "pred"))


def isolation_forest(spark, sf_dir):
    return _shown(make_detector("isolation_forest", features=FEATURES).fit_score(log_features(spark, sf_dir)))


def forest_samples(spark, sf_dir):
    """The samples of a thousand small trees."""
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"), "l_quantity")
    detector = make_detector("isolation_forest", features=["l_quantity"], n_trees=1000, max_samples=8)
    return detector.samples(lines, lines.count(), 8).select(F.col("_tree").cast("bigint").alias("tree"), "row_id")


def _autoencoder(spark, sf_dir):
    return make_detector("autoencoder", features=FEATURES).fit(log_features(spark, sf_dir))


def autoencoder(spark, sf_dir):
    return _shown(make_detector("autoencoder", features=FEATURES).fit_score(log_features(spark, sf_dir)))


def sequence_detector(spark, sf_dir):
    rows = log_features(spark, sf_dir)
    return _shown(make_detector("sequence", features=["value", "k"], base="linear", components=5).fit_score(rows))


def sequence_autoencoder(spark, sf_dir):
    rows = log_features(spark, sf_dir)
    return _shown(make_detector("lstm", features=["value", "k"]).fit_score(rows))


def ensemble_default(spark, sf_dir):
    """The default members: a forest and an autoencoder."""
    rows = written(log_features(spark, sf_dir), "log-rows")  # read in many passes
    return _shown(make_detector("ensemble", features=FEATURES).fit_score(rows))


def sequence_linear(spark, sf_dir):
    """Pairs of consecutive events of a user; their times, which move together, are the explained direction."""
    rows = log_features(spark, sf_dir).withColumn("day", micros("ts") / F.lit(8.64e10))
    return _shown(make_detector("sequence", features=["day", "value"], base="linear", components=1, sequence_length=2).fit_score(rows))


def learned_checks(spark, sf_dir):
    """What can be known of a trained forest, autoencoder and default ensemble without their weights.

    Some rows are moved far out; the forest must flag all of them, and the flagged share must be that
    of the contamination. The network must have learnt more than the mean of each feature.
    """
    planted = F.col("row_id") % 997 == 0
    rows = log_features(spark, sf_dir).withColumn("value", F.when(planted, F.col("value") + 1e5).otherwise(F.col("value")))
    rows = written(rows, "log-rows")  # read in many passes
    model = make_detector("ensemble", features=FEATURES).fit(rows)
    scored = model._with_members(rows, "error").select("row_id", F.col("_f0").alias("forest"), F.col("_f1").alias("autoencoder"))
    scored = scored.join(model.score(rows).select("row_id", F.col("pred").alias("ensemble")), "row_id")
    counts = {"rows": F.count(F.lit(1))}
    for name in ("forest", "autoencoder", "ensemble"):
        counts[f"{name}_flagged"] = F.sum(name)
    counts["forest_planted"] = F.sum(F.when(planted, F.col("forest")))
    loss = model.members[1].history
    known = {"epochs": len(loss), "loss_fell": int(loss[-1] < loss[0]), "loss_below_mean_predictor": int(loss[-1] < 1.0)}
    row = scored.agg(*[c.cast("bigint").alias(n) for n, c in counts.items()]).select(
        "*", *[F.lit(v).cast("bigint").alias(n) for n, v in known.items()])
    return row.unpivot([], row.columns, "check", "n")


def shapley_explain(spark, sf_dir):
    rows = log_features(spark, sf_dir)
    model = make_detector("deviation", features=FEATURES).fit(rows)
    asked = profile.explain_candidates(model.score(rows), by_score=True).select("row_id")
    return rounded(explain.explain(rows, asked, "shapley", model))


def tree_explain(spark, sf_dir):
    """Exact contributions of the features of a small forest for the first flagged rows."""
    rows = log_features(spark, sf_dir)
    model = make_detector("isolation_forest", features=STREAM_FEATURES, n_trees=TREES).fit(rows)
    asked = profile.explain_candidates(model.score(rows)).select("row_id")
    return rounded(explain.explain(rows, asked, "tree", model))


QUERIES = {
    "contamination_flags": lambda s, d: _shown(_scored(s, d)),
    "deviation_metrics": lambda s, d: rounded(flag_metrics(_scored(s, d)).select(
        "tp", "fp", "tn", "fn", "precision", "recall", "accuracy")),
    "zscore_explain": zscore_explain,
    "zscore_explain_asked": zscore_explain_asked,
    "explain_dispatch": explain_dispatch,
    "default_features": default_features,
    "explanation_report": explanation_report,
    "nested_explanation": nested_explanation,
    "feature_importance": feature_importance,
    "ensemble_soft": _ensemble(),
    "ensemble_hard": _ensemble(voting_method="hard"),
    "ensemble_zscore": _ensemble(normalise="zscore"),
    "ensemble_rank": _ensemble(normalise="rank"),
    "ensemble_batch_cut": _ensemble(threshold_on="batch"),
    "ensemble_default": ensemble_default,
    "pca_2d": pca_2d,
    "linear_reconstruction": linear_reconstruction,
    "isolation_forest": isolation_forest,
    "forest_samples": forest_samples,
    "autoencoder": autoencoder,
    "training_loss": lambda s, d: _autoencoder(s, d).loss_history(s),
    "sequence_detector": sequence_detector,
    "sequence_linear": sequence_linear,
    "learned_checks": learned_checks,
    "sequence_autoencoder": sequence_autoencoder,
    "shapley_explain": shapley_explain,
    "tree_explain": tree_explain,
}


_DEVIATION = f"WITH {FEATS}, {deviation_sql(FEATURES)}"


def _cells(source: str) -> str:
    """Rows x features with their distance from the baseline in ``b``."""
    return " UNION ALL ".join(
        f"""SELECT row_id, {i} AS place, '{f}' AS feature, {f} AS value, abs(({f} - bm_{f}) / (bs_{f} + 1e-8::DOUBLE)) AS z_score,
        bm_{f} AS normal_mean, bs_{f} AS normal_std FROM {source}, b""" for i, f in enumerate(FEATURES))


def _explained(asked: str, baseline: str) -> str:
    base = ", ".join(f"avg({f}) AS bm_{f}, stddev_pop({f}) AS bs_{f}" for f in FEATURES)
    return f"""{_DEVIATION}, asked AS ({asked}), b AS (SELECT {base} FROM {baseline}), cells AS ({_cells('asked')}),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY z_score DESC, place DESC) AS rank FROM cells)"""


_FLAGGED = _explained("SELECT * FROM dscored WHERE pred = 1", "dscored WHERE pred = 0")
_ASKED = _explained("SELECT * FROM dscored WHERE pred = 1 ORDER BY row_id LIMIT 10",
                    "dscored WHERE row_id NOT IN (SELECT row_id FROM asked)")
_ROW = (f"row_id, CAST(rank AS INTEGER) AS rank, feature, {r('value', 4)} AS value, {r('z_score', 4)} AS z_score, "
        f"{r('normal_mean', 4)} AS normal_mean, {r('normal_std', 4)} AS normal_std, 'Z-Score' AS method")

_VOTES = f"""{_DEVIATION},
m AS (SELECT row_id, greatest(abs((value - m_value) / s_value), abs((k - m_k) / s_k)) AS s0, abs((gap - m_gap) / s_gap) AS s1
      FROM feats, st),
mc AS (SELECT {cut_sql('s0', 'm')} AS c0, {cut_sql('s1', 'm')} AS c1),
f AS (SELECT m.*, CAST(s0 > c0 AS INTEGER) AS f0, CAST(s1 > c1 AS INTEGER) AS f1, (s0 + s1) / 2 AS score FROM m, mc),
fc AS (SELECT {cut_sql('score', 'f')} AS c)"""
_SOFT = f"{_VOTES} SELECT row_id, {r('score')} AS score, CAST(score > c AS INTEGER) AS pred FROM f, fc"


def _axes_sql(names: list[str], source: str, scaled: bool, rounds: int) -> str:
    """Two principal axes by power iteration and deflation: CTEs ``mo, v (a0.., lead), w (b0..)``."""
    n = range(len(names))
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(names))
    scale = "s{i} * s{j}" if scaled else "1"
    cov = ", ".join(f"covar_pop({names[i]}, {names[j]}) / any_value({scale.format(i=i, j=j)}) AS c{i}{j}" for i in n for j in n)

    def power(name: str, matrix: str, c: str, x: str) -> str:
        product = [" + ".join(f"{c}{i}{j} * {x}{j}" for j in n) for i in n]
        size = "sqrt(" + " + ".join(f"y{i} * y{i}" for i in n) + ")"
        start = ", ".join(f"{1.0 + 0.1 * i}::DOUBLE AS {x}{i}" for i in n)
        moved = ", ".join(f"{p} AS y{i}" for i, p in enumerate(product))
        unit = ", ".join(f"y{i} / {size} AS {x}{i}" for i in n)
        inner = ", ".join(f"{x}{i}" for i in n)
        return f"""{name}_all AS (SELECT 0 AS step, {start} UNION ALL
            SELECT step + 1, {unit} FROM (SELECT step, {moved} FROM {name}_all, {matrix}) y WHERE step < {rounds}),
        {name}_last AS (SELECT {inner} FROM {name}_all WHERE step = {rounds}),
        {name} AS (SELECT {', '.join(f'{x}{i} * g AS {x}{i}' for i in n)} FROM (SELECT *, sign(CASE greatest({
            ', '.join(f'abs({x}{i})' for i in n)}) {' '.join(f'WHEN abs({x}{i}) THEN {x}{i}' for i in n)} END) AS g FROM {name}_last) t)"""

    first = " + ".join(f"a{i} * c{i}{j} * a{j}" for i in n for j in n)
    rest = ", ".join(f"c{i}{j} - lam * a{i} * a{j} AS d{i}{j}" for i in n for j in n)
    second = " + ".join(f"b{i} * d{i}{j} * b{j}" for i in n for j in n)
    trace = " + ".join(f"c{i}{i}" for i in n)
    return f"""mo AS (SELECT {stats} FROM {source}), co AS (SELECT {cov} FROM {source}, mo),
        {power('v', 'co', 'c', 'a')}, l1 AS (SELECT {first} AS lam, {trace} AS trace FROM v, co),
        de AS (SELECT {rest} FROM co, v, l1), {power('w', 'de', 'd', 'b')}, l2 AS (SELECT {second} AS lam2 FROM w, de)"""


def _dot(names: list[str], axis: str, scaled: bool) -> str:
    return " + ".join(f"({c} - m{i}){f' / s{i}' if scaled else ''} * {axis}{i}" for i, c in enumerate(names))


def _shapley_sql() -> str:
    """Sampled Shapley values of the deviation score with the same hashes: draws, feature orders, one switch at a time."""
    n = len(FEATURES)
    hashes = ", ".join(f"{hash_sql(chr(39) * 2 + ' || d.row_id || ' + chr(39) + '|' + chr(39) + ' || draw', 43 + i)} AS h{i}" for i in range(n))
    place = ", ".join(f"1 + {' + '.join(f'CAST(h{j} < h{i} AS INTEGER)' for j in range(n) if j != i)} AS p{i}" for i in range(n))

    def value(step: str) -> str:
        return "greatest(" + ", ".join(f"abs((CASE WHEN p{i} <= {step} THEN x.{f} ELSE b.{f} END - m_{f}) / s_{f})"
                                       for i, f in enumerate(FEATURES)) + ")"
    moved = " UNION ALL ".join(f"SELECT row_id, '{f}' AS feature, v1 - v0 AS change FROM sw WHERE p{i} = step" for i, f in enumerate(FEATURES))
    pick = hash_sql("'' || d.row_id || '|' || draw", 42)
    return f"""{_DEVIATION}, asked AS (SELECT row_id FROM dscored WHERE pred = 1 ORDER BY score DESC, row_id LIMIT 10),
        base AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS pick, {', '.join(FEATURES)}
                 FROM (SELECT * FROM feats ORDER BY {hash_sql('row_id', 42)}, row_id LIMIT {explain.BACKGROUND_ROWS}) t),
        drawn AS (SELECT d.row_id, draw, {pick} % (SELECT count(*) FROM base) AS pick, {hashes} FROM asked d, range(64) r(draw)),
        ordered AS (SELECT *, {place} FROM drawn),
        sw AS (SELECT o.*, step, {value('step')} AS v1, {value('step - 1')} AS v0 FROM ordered o JOIN feats x ON x.row_id = o.row_id
               JOIN base b ON b.pick = o.pick, st, range(1, {n + 1}) t(step)),
        mean AS (SELECT row_id, feature, avg(change) AS c FROM ({moved}) m GROUP BY 1, 2)
        SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY abs(c) DESC, feature) AS INTEGER) AS rank, feature,
            {r('c')} AS contribution, {r('abs(c)')} AS importance, {r('sum(c) OVER (PARTITION BY row_id)')} AS prediction_score,
            'Shapley' AS method FROM mean"""


def _tree_shapley_sql(features: list[str], trees: int) -> str:
    """Shapley values of the forest by all sets of three features: known splits are followed, the others weighed by their rows."""
    mean = "CASE WHEN take <= 1 THEN 1 WHEN take = 2 THEN 1 ELSE 2 * (ln(take - 1.0::DOUBLE) + 0.5772156649::DOUBLE) - 2 * (take - 1.0::DOUBLE) / take END"
    parts = " UNION ALL ".join(
        f"""SELECT a.row_id, '{f}' AS feature, -sum((CASE bit_count(a.mask) WHEN 1 THEN 1 / 6.0::DOUBLE ELSE 1 / 3.0::DOUBLE END) * (b.v - a.v)) AS c
        FROM val a JOIN val b ON a.row_id = b.row_id AND b.mask = a.mask + {1 << i} WHERE (a.mask >> {i}) & 1 = 0 GROUP BY a.row_id""" for i, f in enumerate(features))
    return f"""WITH RECURSIVE {FEATS.lstrip()}, {forest_sql(features, trees=trees)},
        asked AS (SELECT row_id, [{', '.join(f'CAST({f} AS DOUBLE)' for f in features)}] AS x FROM feats
            WHERE row_id IN (SELECT row_id FROM fscored WHERE pred = 1 ORDER BY row_id LIMIT 10)),
        follow AS (SELECT row_id, x, CAST(mask AS BIGINT) AS mask, tree, CAST(0 AS BIGINT) AS node, 1.0::DOUBLE AS w
                FROM asked, range({1 << len(features)}) m(mask), range({trees}) r(tree)
            UNION ALL SELECT row_id, x, mask, w.tree, c.node, w * CASE WHEN (mask >> CAST(k.f - 1 AS BIGINT)) & 1 = 1 THEN 1.0::DOUBLE ELSE c.size / k.size::DOUBLE END
            FROM follow w JOIN nodes k ON w.tree = k.tree AND w.node = k.node AND k.goes JOIN nodes c ON c.tree = k.tree AND (c.node - 1) // 2 = k.node
            WHERE c.node > 0 AND ((mask >> CAST(k.f - 1 AS BIGINT)) & 1 = 0 OR c.node = CASE WHEN x[k.f] <= k.cut THEN 2 * k.node + 1 ELSE 2 * k.node + 2 END)),
        val AS (SELECT row_id, mask, sum(w.w * path) / {trees} / any_value({mean}) AS v FROM follow w
            JOIN nodes k ON w.tree = k.tree AND w.node = k.node AND NOT k.goes, sizes GROUP BY row_id, mask),
        phi AS ({parts})
        SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY abs(c) DESC, feature) AS INTEGER) AS rank, feature, {r('c')} AS contribution,
            {r('abs(c)')} AS importance, {r('sum(c) OVER (PARTITION BY row_id)')} AS prediction_score, 'Tree Shapley' AS method FROM phi"""


_PAIR = ["a", "b", "c", "d"]
_Z2 = " + ".join(f"(({c} - m{i}) / s{i}) * (({c} - m{i}) / s{i})" for i, c in enumerate(MONEY))

ORACLES = {
    "contamination_flags": f"{_DEVIATION} SELECT row_id, {r('score')} AS score, pred FROM dscored",
    "deviation_metrics": f"""{_DEVIATION}, c AS (SELECT count(*) FILTER (label = 1 AND pred = 1) AS tp,
        count(*) FILTER (label = 0 AND pred = 1) AS fp, count(*) FILTER (label = 0 AND pred = 0) AS tn,
        count(*) FILTER (label = 1 AND pred = 0) AS fn FROM dscored) SELECT tp, fp, tn, fn,
        {r('tp::DOUBLE / (tp + fp)')} AS "precision", {r('tp::DOUBLE / (tp + fn)')} AS recall,
        {r('(tp + tn)::DOUBLE / (tp + fp + tn + fn)')} AS accuracy FROM c""",
    "explain_dispatch": f"{_FLAGGED} SELECT {_ROW} FROM ranked WHERE rank <= 3",
    "default_features": f"WITH {FEATS}, {deviation_sql(['user_id', *FEATURES])} SELECT row_id, {r('score')} AS score, pred FROM dscored",
    "zscore_explain": f"{_FLAGGED} SELECT {_ROW} FROM ranked WHERE rank <= 3",
    "zscore_explain_asked": f"{_ASKED} SELECT {_ROW} FROM ranked",
    "explanation_report": f"""{_FLAGGED} SELECT row_id, CAST(rank AS INTEGER) AS rank, feature,
        CASE WHEN z_score > 2 THEN 'high' ELSE 'normal' END AS flag FROM ranked WHERE rank <= 2""",
    "nested_explanation": f"""{_FLAGGED} SELECT row_id, string_agg(feature, '>' ORDER BY rank) AS features
        FROM ranked WHERE rank <= 3 GROUP BY row_id""",
    "feature_importance": f"{_FLAGGED} SELECT feature, {r('avg(abs(z_score))', 4)} AS importance FROM ranked GROUP BY feature",
    "forest_samples": f"""WITH lines AS (SELECT l_orderkey * 8 + l_linenumber AS row_id, l_quantity FROM lineitem),
        {forest_samples_sql('[l_quantity]', 'lines', 1000, 8)} SELECT tree, row_id FROM drawn""",
    "isolation_forest": f"WITH RECURSIVE {FEATS.lstrip()}, {forest_sql(FEATURES)} SELECT row_id, {r('score')} AS score, pred FROM fscored",
    "sequence_linear": f"""WITH RECURSIVE {FEATS.lstrip()},
        two AS (SELECT row_id, user_id, ts, value, epoch_us(ts) / 8.64e10::DOUBLE AS day FROM feats),
        pairs AS (SELECT row_id, day AS a, value AS b, LEAD(day) OVER u AS c, LEAD(value) OVER u AS d FROM two
                  WINDOW u AS (PARTITION BY user_id ORDER BY ts, row_id)),
        li AS (SELECT * FROM pairs WHERE c IS NOT NULL), {_axes_sql(_PAIR, 'li', True, 60)},
        p AS (SELECT row_id, {' + '.join(f'(({c} - m{i}) / s{i}) * (({c} - m{i}) / s{i})' for i, c in enumerate(_PAIR))} AS size,
              {_dot(_PAIR, 'a', True)} AS p1 FROM li, mo, v),
        sc AS (SELECT row_id, greatest(size - p1 * p1, 0) / 4 AS score FROM p), cu AS (SELECT {cut_sql('score', 'sc')} AS c)
        SELECT t.row_id, {r('COALESCE(score, 0.0::DOUBLE)')} AS score, CAST(COALESCE(score, 0.0::DOUBLE) > cu.c AS INTEGER) AS pred
        FROM two t LEFT JOIN sc USING (row_id), cu""",
    "learned_checks": f"""WITH c AS (SELECT count(*) AS n, count(*) - 1 - CAST(floor(0.9::DOUBLE * (count(*) - 1)) AS BIGINT) AS flagged,
            count(*) FILTER (event_id % 997 = 0) AS planted FROM events)
        SELECT 'rows' AS "check", n FROM c UNION ALL SELECT 'epochs', 100 UNION ALL SELECT 'loss_fell', 1
        UNION ALL SELECT 'loss_below_mean_predictor', 1 UNION ALL SELECT 'forest_planted', planted FROM c
        {' '.join(f"UNION ALL SELECT '{m}_flagged', flagged FROM c" for m in ('forest', 'autoencoder', 'ensemble'))}""",
    "shapley_explain": _shapley_sql(),
    "tree_explain": _tree_shapley_sql(STREAM_FEATURES, TREES),
    "ensemble_soft": _SOFT,
    "ensemble_batch_cut": _SOFT,
    "ensemble_hard": f"""{_VOTES} SELECT row_id, {r('score')} AS score,
        CAST((f0 + f1) / 2.0::DOUBLE > 0.5::DOUBLE AS INTEGER) AS pred FROM f""",
    "ensemble_zscore": f"""{_VOTES}, ms AS (SELECT avg(s0) AS a0, stddev_pop(s0) AS d0, avg(s1) AS a1, stddev_pop(s1) AS d1 FROM m),
        n AS (SELECT row_id, ((s0 - a0) / d0 + (s1 - a1) / d1) / 2 AS score FROM m, ms), nc AS (SELECT {cut_sql('score', 'n')} AS c)
        SELECT row_id, {r('score')} AS score, CAST(score > c AS INTEGER) AS pred FROM n, nc""",
    "ensemble_rank": f"""{_VOTES}, {', '.join(f"l{i} AS (SELECT list_sort(list(s{i})) AS l FROM m), g{i} AS (SELECT list_transform(range(101), "
            f"lambda k: l[CAST(k * (len(l) - 1) // 100 AS BIGINT) + 1]) AS g FROM l{i})" for i in (0, 1))},
        n AS (SELECT row_id, (len(list_filter(g0.g, lambda x: x <= s0)) / 101.0::DOUBLE
            + len(list_filter(g1.g, lambda x: x <= s1)) / 101.0::DOUBLE) / 2 AS score FROM m, g0, g1),
        nc AS (SELECT {cut_sql('score', 'n')} AS c)
        SELECT row_id, {r('score')} AS score, CAST(score > c AS INTEGER) AS pred FROM n, nc""",
    "pca_2d": f"""WITH RECURSIVE {_axes_sql(LINES, 'lineitem', False, 40)}
        SELECT l_orderkey, l_linenumber, {r(_dot(LINES, 'a', False), 4)} AS pc1, {r(_dot(LINES, 'b', False), 4)} AS pc2,
        {r('lam / trace', 4)} AS explained_1, {r('lam2 / trace', 4)} AS explained_2 FROM lineitem, mo, v, w, l1, l2""",
    "linear_reconstruction": f"""WITH RECURSIVE li AS (SELECT l_orderkey, l_linenumber, l_quantity AS qty, l_extendedprice AS price,
            l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem),
        {_axes_sql(MONEY, 'li', True, 80)},
        p AS (SELECT l_orderkey, l_linenumber, {_Z2} AS size, {_dot(MONEY, 'a', True)} AS p1, {_dot(MONEY, 'b', True)} AS p2
              FROM li, mo, v, w),
        sc AS (SELECT *, greatest(size - p1 * p1 - p2 * p2, 0) / 4 AS score FROM p), c AS (SELECT {cut_sql('score', 'sc')} AS c)
        SELECT l_orderkey, l_linenumber, {r('score')} AS score, CAST(score > c AS INTEGER) AS pred FROM sc, c""",
}
