"""Synchronous training: the same network for any layout, and exact sums."""

import tracemalloc

import numpy as np
import pytest

from logwarden.detectors import autoencoder, make_detector
from logwarden.detectors.autoencoder import Network, carried, from_limbs, layer_sizes, to_limbs

SETTINGS = dict(hidden_dims=(8, 4), epochs=2, steps=3)


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(3)
    rows = draw.normal(size=(900, 3)) * [1e3, 1, 1e-3]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], "row_id long, a double, b double, c double")


def trained(table, **settings):
    model, _ = make_detector("autoencoder", **{**SETTINGS, **settings}).learn(table)
    return model


def test_same_network_for_any_layout(spark, table, monkeypatch):
    """Partitions, shuffle partitions, Arrow batches, the shape of the tree: not one bit changes."""
    monkeypatch.setattr(autoencoder, "BLOCK_ROWS", 60)
    first = trained(table)
    conf, changed = spark.conf, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2", "spark.sql.shuffle.partitions": "3"}
    before = {k: conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            conf.set(k, v)
        monkeypatch.setattr(autoencoder, "FAN_IN", 2)
        again = trained(table.repartition(7))
    finally:
        for k, v in before.items():
            conf.set(k, v)
    assert again.scale == first.scale and again.history == first.history
    assert np.array_equal(again.network.flat, first.network.flat)


def test_against_plain_steps(spark, table):
    """The same epochs in one process, batch by batch."""
    model = trained(table, shards=6)
    rows = table.orderBy("row_id").collect()
    from logwarden.common import portable_number

    x = np.array([r[1:] for r in rows])
    x = (x - model.scale.means) / model.scale.stds
    batch = np.array([portable_number(r.row_id, seed=42) % 6 % 3 for r in rows])
    sizes = layer_sizes(3, (8, 4))
    state = autoencoder.AdamState(sizes, autoencoder.AdamState.start(Network.initial(sizes, 42)))
    history = []
    for _ in range(2):
        lost = [state.step(x[batch == b], 1e-3) * (batch == b).sum() for b in range(3)]
        history.append(sum(lost) / len(x))
    np.testing.assert_allclose(model.network.flat, state.net.flat, atol=1e-9)
    np.testing.assert_allclose(model.history, history, rtol=1e-9)


def test_a_block_is_passed_in_pieces():
    """The layers of a long block are never held whole, and its pieces add up to the plain gradient."""
    sizes = layer_sizes(3, (64, 32, 16))
    net = Network.initial(sizes, 5)
    x = np.random.default_rng(2).normal(size=(20_011, 3))
    tracemalloc.start()
    loss, grad = net.summed(x)
    wrong = net.errors(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6  # all layers of all rows take 37 MB forth and as much back
    layers = [x]
    for i, (weight, bias) in enumerate(net.layers):
        layers.append(layers[-1] @ weight + bias)
        if i < len(net.layers) - 1:
            layers[-1] = np.maximum(layers[-1], 0)
    back, parts = 2 * (layers[-1] - x), []
    for i in range(len(net.layers) - 1, -1, -1):
        parts = [layers[i].T @ back, back.sum(axis=0), *parts]
        back = (back @ net.layers[i][0].T) * (layers[i] > 0)
    np.testing.assert_allclose(grad, np.concatenate([p.ravel() for p in parts]), rtol=1e-9, atol=1e-7)
    np.testing.assert_allclose(wrong, ((layers[-1] - x) ** 2).mean(axis=1), rtol=1e-12)
    assert loss == pytest.approx(((layers[-1] - x) ** 2).sum(), rel=1e-12)


def test_limbs_add_exactly():
    values = np.random.default_rng(1).normal(size=(40, 5)) * np.array([1e-9, 1.0, 1e6, 1e12, 1e3])
    limbs = [to_limbs(v) for v in values]
    forth, back = limbs[0], limbs[-1]
    for a, b in zip(limbs[1:], limbs[-2::-1]):
        forth, back = carried(forth + a), carried(back + b)
    assert np.array_equal(forth, back)
    np.testing.assert_allclose(from_limbs(forth), values.sum(axis=0), rtol=1e-9, atol=40 * 2.0**-40)
    with pytest.raises(ValueError, match="diverged"):
        to_limbs(np.array([np.nan]))


def test_few_rows(spark, table):
    """Fewer rows than a batch are one batch; an empty table is refused."""
    assert len(trained(table.limit(5)).history) == 2
    with pytest.raises(ValueError, match="empty"):
        trained(table.limit(0))
    with pytest.raises(ValueError, match="positive"):
        make_detector("autoencoder", steps=0)
