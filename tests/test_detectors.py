import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.common import work_path
from logwarden.detectors import make_detector
from logwarden.detectors.autoencoder import AdamState, Network, layer_sizes
from logwarden.detectors.ensemble import hard_vote
from logwarden.detectors.forest import average_path, grow_tree, mean_path
from logwarden.detectors.linear import pca_points
from logwarden.sources.models import load_model, save_model

AE = dict(hidden_dims=(8, 4), epochs=6)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 3))
    x[:, 2] = x[:, 0] + 0.05 * x[:, 2]
    x[0] = [9.0, -9.0, -9.0]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "row_id bigint, a double, b double, c double").persist()


def as_dict(df):
    return {r["row_id"]: (r["score"], r["pred"]) for r in df.select("row_id", "score", "pred").collect()}


def test_average_path_goldens():
    assert average_path(1) == 0.0 and average_path(2) == 1.0
    assert average_path(256) == pytest.approx(10.244771, abs=1e-6)


def test_tree_path_lengths_match_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(64, 3))
    feature, threshold, path = grow_tree(x, 3, 1, 6)
    got = mean_path(x, feature[None], threshold[None], path[None])

    def walk(members):
        out = {}
        todo = [(0, 0, list(members))]
        while todo:
            node, level, part = todo.pop()
            same = node >= len(threshold) or not np.isfinite(threshold[node])
            if same:
                out |= {i: level + average_path(len(part)) for i in part}
                continue
            left = [i for i in part if x[i, feature[node]] <= threshold[node]]
            right = [i for i in part if i not in left]
            assert left and right
            todo += [(2 * node + 1, level + 1, left), (2 * node + 2, level + 1, right)]
        return out

    expect = walk(range(64))
    assert got == pytest.approx([expect[i] for i in range(64)])


@pytest.mark.parametrize("sizes", [dict(n_trees=20, max_samples=64), dict(n_trees=20, max_samples=256)])
def test_forest_invariants(spark, table, sizes):
    # 20 * 64 rows fit into the table (disjoint samples), 20 * 256 do not (ranked per tree).
    model = make_detector("isolation_forest", **sizes).fit(table)
    scored = as_dict(model.score(table))
    assert scored[0][0] > np.quantile([s for s, _ in scored.values()], 0.97)  # the far outlier
    assert 0.05 < sum(p for _, p in scored.values()) / 1500 <= 0.101
    assert all(0 < s + model.cut < 1 for s, _ in scored.values())
    shuffled = table.orderBy(F.rand(1)).repartition(3)
    again = as_dict(make_detector("isolation_forest", **sizes).fit(shuffled).score(shuffled))
    assert again == scored


def test_forest_samples(spark):
    """A thousand trees draw a thousand samples that share no row; few rows are dealt to several trees."""
    detector = make_detector("isolation_forest", n_trees=1000, max_samples=8)
    rows = spark.range(60_000).withColumnRenamed("id", "row_id").withColumn("x", F.col("row_id") % 7)
    drawn = detector.samples(rows, 60_000, 8).collect()
    assert len(drawn) == 8000 and len({r.row_id for r in drawn}) == 8000 and len({r._tree for r in drawn}) == 1000
    few = detector.samples(rows.limit(300), 300, 8).groupBy("_tree").count().collect()
    assert len(few) == 1000 and {r["count"] for r in few} == {8}
    alone = detector.samples(rows.limit(3), 3, 3).groupBy("_tree").count().collect()
    assert len(alone) == 1000 and {r["count"] for r in alone} == {3}


def test_tree_contributions_by_enumeration():
    """Against the definition: every set of known features, every path weighed by its rows."""
    from itertools import combinations
    from math import factorial

    from logwarden.detectors.forest import node_covers, tree_contributions

    x = np.random.default_rng(5).integers(0, 9, (60, 4)).astype(float)
    tree = grow_tree(x, 3, 1, 5)
    cover = node_covers(x, *tree[:2])
    feature, threshold, path = tree

    def value(row, known, node=0):
        if node >= len(threshold):
            return path[node - len(threshold)]
        sides = [2 * node + 1, 2 * node + 2]
        if feature[node] in known or cover[sides[1]] == 0:
            return value(row, known, sides[int(row[feature[node]] > threshold[node])])
        return sum(cover[s] / cover[node] * value(row, known, s) for s in sides if cover[s])

    got = tree_contributions(x[:5], *tree, cover)
    for row, phi in zip(x[:5], got):
        for i in range(4):
            others = [j for j in range(4) if j != i]
            expect = sum(factorial(k) * factorial(3 - k) / 24 * (value(row, {*s, i}) - value(row, set(s)))
                         for k in range(4) for s in combinations(others, k))
            assert phi[i] == pytest.approx(expect, abs=1e-12)
        assert phi.sum() == pytest.approx(mean_path(row[None], feature[None], threshold[None], path[None])[0] - value(row, set()))


def test_gradient_by_finite_differences():
    sizes = layer_sizes(3, (4, 2))
    assert sizes == [3, 4, 2, 2, 4, 3]
    net = Network(sizes, Network.initial(sizes, 1).flat.astype(np.float64))
    x = np.random.default_rng(2).normal(size=(5, 3))
    _, grad = net.loss_and_gradient(x)
    for i in range(0, len(grad), 5):
        moved = []
        for h in (1e-6, -1e-6):
            flat = net.flat.copy()
            flat[i] += h
            moved.append(Network(sizes, flat).loss_and_gradient(x)[0])
        assert grad[i] == pytest.approx((moved[0] - moved[1]) / 2e-6, abs=1e-6)


def test_adam_first_step_moves_by_the_rate():
    sizes = layer_sizes(2, (2,))
    net = Network.initial(sizes, 1)
    state = AdamState(sizes, AdamState.start(net))
    state.step(np.ones((4, 2), dtype=np.float32), 1e-3)
    moved = np.abs(state.net.flat - net.flat)
    assert state.steps == 1 and moved.max() == pytest.approx(1e-3, rel=1e-2)


@pytest.mark.parametrize("shards", [1, 5])
def test_autoencoder_learns_and_ignores_layout(spark, table, shards):
    detector = make_detector("autoencoder", shards=shards, **AE)
    model = detector.fit(table)
    assert model.history[-1] < model.history[0]
    history = model.loss_history(spark)
    assert history.count() == 6
    scored = as_dict(model.score(table))
    assert sum(p for _, p in scored.values()) <= 151
    assert max(scored, key=lambda i: scored[i][0]) == 0
    again = as_dict(make_detector("autoencoder", shards=shards, **AE)
                    .fit(table.repartition(3)).score(table))
    assert np.allclose([scored[i][0] for i in scored], [again[i][0] for i in scored], rtol=1e-3)


def test_linear_matches_numpy(spark, table):
    x = np.array([r[1:] for r in table.orderBy("row_id").collect()])
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(z.T @ z / len(z))
    top = vectors[:, np.argsort(values)[::-1][:2]]
    expect = np.mean((z - z @ top @ top.T) ** 2, axis=1)
    scored = as_dict(make_detector("linear", components=2).fit(table).score(table))
    assert np.allclose([scored[i][0] for i in range(1500)], expect, atol=1e-9)


def test_wide_covariance_path_agrees(spark, table, monkeypatch):
    few = as_dict(make_detector("linear", components=1).fit(table).score(table))
    monkeypatch.setattr("logwarden.detectors.linear.SQL_COVARIANCE_COLUMNS", 1)
    many = as_dict(make_detector("linear", components=1).fit(table).score(table))
    assert np.allclose([few[i][0] for i in few], [many[i][0] for i in few], atol=1e-9)


def test_pca_points_match_numpy(spark, table):
    x = np.array([r[1:] for r in table.orderBy("row_id").collect()])
    c = x - x.mean(0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    order = np.argsort(values)[::-1][:2]
    rows = pca_points(table, ["a", "b", "c"]).orderBy("row_id").collect()
    for j, name in enumerate(["pc1", "pc2"]):
        axis = vectors[:, order[j]]
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert np.allclose([r[name] for r in rows], c @ axis, atol=1e-9)
    assert rows[0]["explained_1"] == pytest.approx(values[order[0]] / values.sum())


def test_soft_and_hard_votes(spark):
    df = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (1, 1, 1), (0, 0, 1)], "a int, b int, c int")
    assert [r[0] for r in df.select(hard_vote(["a", "b"])).collect()] == [0, 1, 1, 0]
    assert [r[0] for r in df.select(hard_vote(["a", "b", "c"])).collect()] == [0, 1, 1, 0]


@pytest.mark.parametrize("normalise", ["none", "zscore", "rank"])
def test_ensemble(spark, table, normalise):
    members = [make_detector("deviation"), make_detector("linear", components=1)]
    model = make_detector("ensemble", detectors=members, normalise=normalise).fit(table)
    scored = as_dict(model.score(table))
    # Ranks are shares of reference points, so rows tie at the cut-off and the flagged share may be smaller.
    flagged = sum(p for _, p in scored.values())
    assert flagged == 150 if normalise != "rank" else 100 <= flagged <= 150
    batch = make_detector("ensemble", detectors=members, normalise=normalise, threshold_on="batch").fit(table)
    assert as_dict(batch.score(table)) == scored
    half = batch.score(table.where("row_id < 500"))
    assert half.agg(F.sum("pred")).first()[0] == 50 or normalise == "rank"


def test_rank_is_the_share_of_rows(spark):
    """Ties count as often as they occur: 95 % zeros, so a zero has rank 0.95."""
    rows = spark.range(2000).select(F.col("id").alias("row_id"), F.when(F.col("id") >= 1900, F.col("id").cast("double")).otherwise(0.0).alias("v"))
    member = make_detector("deviation", features=["v"])
    got = as_dict(make_detector("ensemble", detectors=[member], normalise="rank").fit(rows).score(rows))
    assert got[0][0] == got[1899][0] == pytest.approx(0.95, abs=0.011) and got[1949][0] == pytest.approx(0.975, abs=0.011)
    assert got[0][0] <= got[1900][0] < got[1999][0] == 1.0


def test_duplicate_row_ids_are_refused(spark, table):
    with pytest.raises(ValueError, match="duplicate"):
        make_detector("isolation_forest").fit(table.unionByName(table.limit(1)))


def test_ensemble_of_one_is_that_member(spark, table):
    member = make_detector("deviation")
    alone = as_dict(member.fit_score(table))
    assert as_dict(make_detector("ensemble", detectors=[member]).fit_score(table)) == alone


def events(spark, lengths):
    rows = [(1000 * u + i, u, float(i % 4) + 0.01 * u, float(60 * i)) for u, n in enumerate(lengths) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id bigint, user_id bigint, v double, s double")
    return df.select("row_id", "user_id", "v", F.timestamp_seconds("s").alias("ts"))


def test_sequence_assignment(spark):
    df = events(spark, [12, 30])
    for assign, scored_rows in (("first", {0, 1, 2}), ("last", {9, 10, 11})):
        model = make_detector("sequence", base="linear", assign=assign, components=2).fit(df)
        rows = as_dict(model.score(df).where("user_id = 0"))
        assert {i for i, (s, _) in rows.items() if s > 0} <= scored_rows
        assert len(rows) == 12
    short = events(spark, [9])
    with pytest.raises(ValueError, match="Not enough data"):
        make_detector("sequence", base="linear").fit(short)
    assert as_dict(model.score(short)) == {i: (0.0, 0) for i in range(9)}


def test_models_survive_a_round_trip(spark, table):
    seq = events(spark, [25, 40])
    cases = [
        (make_detector("deviation"), table),
        (make_detector("linear"), table),
        (make_detector("isolation_forest", n_trees=10, max_samples=32), table),
        (make_detector("autoencoder", **AE), table),
        (make_detector("lstm", epochs=2, hidden_dims=(8,)), seq),
        (make_detector("ensemble", detectors=[make_detector("deviation"),
                                              make_detector("isolation_forest", n_trees=5, max_samples=32)]), table),
    ]
    for detector, df in cases:
        model = detector.fit(df)
        path = work_path(spark, "model")
        save_model(spark, model, path)
        assert as_dict(load_model(spark, path).score(df)) == as_dict(model.score(df))


def test_bad_settings_and_null_features(spark, table):
    with pytest.raises(ValueError, match="Unknown method"):
        make_detector("nope")
    with pytest.raises(ValueError):
        make_detector("deviation", contamination=1.5)
    with pytest.raises(ValueError, match="numeric"):
        make_detector("deviation", features=["s"]).fit(table.withColumn("s", F.lit("x")))
    holes = table.withColumn("a", F.when(F.col("row_id") != 5, F.col("a")))
    with pytest.raises(Exception, match="null feature"):
        make_detector("deviation").fit(holes)
    assert make_detector("deviation", on_null="drop").fit_score(holes).count() == 1499
    assert make_detector("deviation", on_null="zero").fit_score(holes).count() == 1500
