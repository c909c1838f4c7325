"""Why a row was flagged: distance from normal rows, and sampled Shapley contributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logwarden.common import feature_columns, portable_hash, written
from logwarden.detectors.base import Model
from logwarden.operators.scaling import Scale, fit_scale, z_score

BACKGROUND_ROWS = 100


def normal_rows(table: DataFrame, asked: DataFrame | None, row_id: str, baseline: str) -> DataFrame:
    """Rows that count as normal: not flagged (``pred``), or not asked about (``asked``)."""
    if baseline == "pred":
        return table.where("pred = 0")
    if baseline == "asked":
        if asked is None:
            raise ValueError("baseline 'asked' needs the asked ids")
        return table.join(asked.select(row_id), row_id, "left_anti")
    raise ValueError("baseline must be 'pred' or 'asked'")


def asked_rows(table: DataFrame, asked: DataFrame | None, row_id: str) -> DataFrame:
    """The asked rows, or every flagged one; Spark picks the join by the size of the ids."""
    if asked is None:
        return table.where("pred = 1")
    return table.join(asked.select(row_id).distinct(), row_id, "left_semi")


def zscore_explanation(table: DataFrame, features: Sequence[str] | None = None, asked: DataFrame | None = None,
                       row_id: str = "row_id", baseline: str = "pred", max_features: int = 10) -> DataFrame:
    """Top features per row: ``row_id, rank, feature, value, z_score, normal_mean, normal_std, method``.

    One aggregate gives the baseline; each row then sorts its own few features, so the
    explanation adds no shuffle. Equal z-scores put the later feature first.
    """
    names = [c for c in feature_columns(table, features) if c != row_id]
    base = fit_scale(normal_rows(table, asked, row_id, baseline), names)
    return _top_features(asked_rows(table, asked, row_id), names, base, row_id, max_features)


def _top_features(rows: DataFrame, names: Sequence[str], base: Scale, row_id: str, k: int) -> DataFrame:
    return _top_array(rows, names, base, row_id, k).select(row_id, F.explode("top_features").alias("cell"), "method").select(
        row_id, "cell.rank", "cell.feature", "cell.value", "cell.z_score", "cell.normal_mean", "cell.normal_std", "method")


def _top_array(rows: DataFrame, names: Sequence[str], base: Scale, row_id: str, k: int) -> DataFrame:
    cells = []
    for i, (c, m, s) in enumerate(zip(names, base.means, base.stds, strict=True)):
        value = F.col(c).cast("double")
        cells.append(F.struct(z_score(value, F.lit(m), F.lit(s)).alias("z_score"), F.lit(i).alias("place"),
                              F.lit(c).alias("feature"), value.alias("value"),
                              F.lit(m).alias("normal_mean"), F.lit(s).alias("normal_std")))
    top = F.slice(F.sort_array(F.array(*cells), asc=False), 1, k)
    ranked = F.transform(top, lambda c, i: F.struct((i + 1).alias("rank"), *[
        c[n].alias(n) for n in ("feature", "value", "z_score", "normal_mean", "normal_std")]))
    return rows.select(row_id, F.lit("Z-Score").alias("method"), ranked.alias("top_features"))


def nested_explanation(table: DataFrame, features: Sequence[str] | None = None, asked: DataFrame | None = None,
                       row_id: str = "row_id", baseline: str = "pred", max_features: int = 10) -> DataFrame:
    """The z-score explanation with one row per explained row and ``top_features`` as an array; no shuffle."""
    names = [c for c in feature_columns(table, features) if c != row_id]
    base = fit_scale(normal_rows(table, asked, row_id, baseline), names)
    return _top_array(asked_rows(table, asked, row_id), names, base, row_id, max_features)


def explanation_report(long: DataFrame, row_id: str = "row_id", limit: float = 2.0) -> DataFrame:
    """The explanation with a flag per feature, in reading order."""
    return long.withColumn("flag", F.when(F.col("z_score") > limit, "high").otherwise("normal")) \
        .orderBy(row_id, "rank")


def explain(table: DataFrame, asked: DataFrame | None = None, method: str = "zscore", model: Model | None = None,
            **settings) -> DataFrame:
    """Explain by the named method; a method that cannot run is an error, never replaced."""
    if method == "zscore":
        return zscore_explanation(table, asked=asked, **settings)
    if method == "shapley":
        if model is None or asked is None:
            raise ValueError("shapley needs a fitted model and the asked ids")
        return shapley_explanation(table, model, asked, **settings)
    if method == "tree":
        if not hasattr(model, "with_contributions") or asked is None:
            raise ValueError("tree needs a fitted forest and the asked ids")
        return tree_explanation(table, model, asked, **settings)
    raise ValueError(f"Unknown explanation method: {method}")


def tree_explanation(table: DataFrame, model: Model, asked: DataFrame, row_id: str = "row_id", max_features: int = 10) -> DataFrame:
    """Exact Shapley contributions of a forest's features to log2 of a row's score; no sampling, no background.

    They add up to ``prediction_score``, the distance of the row's log2 score from that of the forest's own rows.
    """
    rows = asked_rows(table.select(row_id, *model.features), asked, row_id)
    names = F.array(*map(F.lit, model.features))
    cells = F.arrays_zip(names.alias("feature"), F.col("_each").alias("contribution"))
    ranked = F.array_sort(cells, lambda a, b: F.when(F.abs(a["contribution"]) > F.abs(b["contribution"]), -1).when(
        F.abs(a["contribution"]) < F.abs(b["contribution"]), 1).when(a["feature"] < b["feature"], -1).otherwise(1))
    scored = model.with_contributions(rows, "_each").select(row_id, F.posexplode(F.slice(ranked, 1, max_features)).alias("_at", "_cell"),
                                                           F.aggregate("_each", F.lit(0.0), lambda a, b: a + b).alias("prediction_score"))
    return scored.select(row_id, (F.col("_at") + 1).alias("rank"), F.col("_cell.feature").alias("feature"),
                         F.col("_cell.contribution").alias("contribution"), F.abs("_cell.contribution").alias("importance"),
                         "prediction_score", F.lit("Tree Shapley").alias("method"))


def background_rows(table: DataFrame, row_id: str, size: int = BACKGROUND_ROWS, seed: int = 42) -> DataFrame:
    """A repeatable sample of ``size`` rows without replacement."""
    return table.orderBy(portable_hash(row_id, seed=seed), row_id).limit(size)


def shapley_explanation(table: DataFrame, model: Model, asked: DataFrame, row_id: str = "row_id",
                        permutations: int = 64, background: int = BACKGROUND_ROWS, seed: int = 42,
                        max_features: int = 10) -> DataFrame:
    """Sampled Shapley contributions (Strumbelj and Kononenko 2014) of each feature.

    For every asked row and every random feature order, features switch one by one from a
    background row to the asked row; a feature's contribution is the mean change of the raw
    score when it switches. The result is signed, ``importance`` is its size, and
    ``prediction_score`` the sum over the features.
    """
    names = list(model.features)
    plain = [F.col(c).cast("double").alias(c) for c in names]
    # The background is a fixed number of rows; written so that every row is drawn once.
    base = written(background_rows(table.select(row_id, *plain), row_id, background, seed), "background")
    numbered = base.select(*[F.col(c).alias(f"_b_{c}") for c in names],
                           (F.row_number().over(Window.orderBy(row_id)) - 1).alias("_pick"))
    have = base.count()
    if have == 0:
        raise ValueError("no background rows")
    rows = asked_rows(table.select(row_id, *plain), asked, row_id)
    draws = rows.withColumn("_draw", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    draws = draws.withColumn("_pick", F.pmod(portable_hash(row_id, "_draw", seed=seed), F.lit(have)).cast("int"))
    order = F.transform(F.array_sort(F.array(*[
        F.struct(portable_hash(row_id, "_draw", seed=seed + 1 + i).alias("h"), F.lit(i).alias("i"))
        for i in range(len(names))])), lambda s: s["i"])
    draws = draws.withColumn("_order", order).join(F.broadcast(numbered), "_pick")
    steps = draws.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(names)))))
    mixed = steps.select(row_id, "_draw", "_step", "_order", *[
        F.when(F.array_position("_order", F.lit(i)) <= F.col("_step"), F.col(c)).otherwise(F.col(f"_b_{c}")).alias(c)
        for i, c in enumerate(names)])
    scored = model.with_raw(mixed, "_value")
    path = Window.partitionBy(row_id, "_draw").orderBy("_step")
    change = F.col("_value") - F.lag("_value").over(path)
    moved = scored.withColumn("_change", change).where("_step > 0").withColumn(
        "feature", F.element_at(F.array(*map(F.lit, names)), F.element_at("_order", F.col("_step")) + 1))
    mean = moved.groupBy(row_id, "feature").agg(F.avg("_change").alias("contribution"))
    every = Window.partitionBy(row_id)
    ranked = mean.withColumns({
        "importance": F.abs("contribution"),
        "prediction_score": F.sum("contribution").over(every),
        "rank": F.row_number().over(every.orderBy(F.abs("contribution").desc(), "feature"))})
    return ranked.where(F.col("rank") <= max_features).select(
        row_id, "rank", "feature", "contribution", "importance", "prediction_score", F.lit("Shapley").alias("method"))
