"""Registered queries: training step by step, on a network small enough for SQL to follow."""

from __future__ import annotations

from pyspark.sql import functions as F

from logwarden.detectors import make_detector
from logwarden.detectors.autoencoder import (
    BETA1, BETA2, BLOCK_ROWS, EPSILON, LEARNING_RATE, AutoencoderModel, Network, layer_sizes)
from logwarden.operators.quantiles import contamination_cut
from logwarden.operators.scaling import fit_scale
from logwarden.plans.base import CONTAMINATION, FEATS, FEATURES, cut_sql, event_rows, hash_sql, log_features, r, rounded, stats_sql, table

SMALL, HIDDEN, EPOCHS, STEPS, SEED = ["value", "k", "hour"], (2,), 2, 2, 42


def _trained(spark, sf_dir, epochs: int = EPOCHS):
    detector = make_detector("autoencoder", features=SMALL, hidden_dims=HIDDEN, epochs=epochs, steps=STEPS, seed=SEED)
    return detector.learn(event_rows(table(spark, sf_dir, "events")))[0]


def training_steps(spark, sf_dir):
    """Every weight after two epochs of two synchronous steps each."""
    weights = _trained(spark, sf_dir).network.flat.tolist()
    return rounded(spark.createDataFrame(list(enumerate(weights, 1)), "place int, weight double"), 8)


def training_one_step(spark, sf_dir):
    """Every weight after one step over the whole table."""
    detector = make_detector("autoencoder", features=SMALL, hidden_dims=HIDDEN, epochs=1, steps=1, seed=SEED)
    weights = detector.learn(event_rows(table(spark, sf_dir, "events")))[0].network.flat.tolist()
    return rounded(spark.createDataFrame(list(enumerate(weights, 1)), "place int, weight double"), 8)


def training_loss_steps(spark, sf_dir):
    """The loss log of the small network."""
    return rounded(_trained(spark, sf_dir).loss_history(spark), 8)


def network_scores(spark, sf_dir):
    """Scores and flags of a given network of the default size, with weights from hashes."""
    rows = log_features(spark, sf_dir)
    scale = fit_scale(rows, FEATURES)
    model = AutoencoderModel(scale, Network.initial(layer_sizes(len(FEATURES), (8, 4)), SEED))
    scored = model.with_raw(rows, "raw")
    model.cut = contamination_cut(scored, "raw", CONTAMINATION)
    return rounded(scored.select("row_id", F.col("raw").alias("score"), (F.col("raw") > model.cut).cast("int").alias("pred")))


QUERIES = {
    "training_one_step": training_one_step,
    "training_steps": training_steps,
    "training_loss_steps": training_loss_steps,
    "network_scores": network_scores,
}


def _initial_sql(sizes: list[int], seed: int) -> str:
    """The starting weights as a list, from the same hashes."""
    parts, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:], strict=True):
        for _ in range(a * b + b):
            parts.append(f"(2.0::DOUBLE * {hash_sql(str(at), seed)} / 4503599627370496.0::DOUBLE - 1) / sqrt({a}.0::DOUBLE)")
            at += 1
    return "[" + ", ".join(parts) + "]"


def _forward_sql(sizes: list[int]) -> tuple[list[list[str]], list[str]]:
    """Chained projections: per layer the names of its values and the select list that makes them from list ``w``."""
    names, steps, at = [[f"x{i}" for i in range(sizes[0])]], [], 0
    for layer, (a, b) in enumerate(zip(sizes[:-1], sizes[1:], strict=True), 1):
        own = [f"a{layer}_{j}" for j in range(b)]
        terms = []
        for j in range(b):
            total = " + ".join([f"w[{at + a * b + j + 1}]", *[f"{names[-1][i]} * w[{at + i * b + j + 1}]" for i in range(a)]])
            terms.append(f"{total if layer == len(sizes) - 1 else f'greatest({total}, 0)'} AS {own[j]}")
        at += a * b + b
        names.append(own)
        steps.append(", ".join(terms))
    return names, steps


def _nested(source: str, steps: list[str]) -> str:
    for i, step in enumerate(steps):
        source = f"(SELECT *, {step} FROM {source}) n{i}"
    return source


def _chain_sql(sizes: list[int], batches: int, steps: int) -> str:
    """CTEs ``s0 .. s<steps>`` (w, m, v, loss, cells): Adam steps, one global batch each, by hand-written back-propagation."""
    names, forward = _forward_sql(sizes)
    backward, gradient, at = [], {}, sum(a * b + b for a, b in zip(sizes[:-1], sizes[1:], strict=True))
    out = len(sizes) - 1
    backward.append(", ".join(f"2 * ({o} - {x}) AS d{out}_{j}" for j, (o, x) in enumerate(zip(names[-1], names[0], strict=True))))
    for layer in range(out, 0, -1):
        a, b = sizes[layer - 1], sizes[layer]
        at -= a * b + b
        for i in range(a):
            for j in range(b):
                gradient[at + i * b + j] = f"sum({names[layer - 1][i]} * d{layer}_{j})"
        for j in range(b):
            gradient[at + a * b + j] = f"sum(d{layer}_{j})"
        if layer > 1:
            backward.append(", ".join(
                f"CASE WHEN {names[layer - 1][i]} > 0 THEN {' + '.join(f'd{layer}_{j} * w[{at + i * b + j + 1}]' for j in range(b))} ELSE 0 END AS d{layer - 1}_{i}"
                for i in range(a)))
    cells = f"(count(*) * {sizes[0]})"
    grad = "[" + ", ".join(f"{gradient[k]} / {cells}" for k in sorted(gradient)) + "]"
    lost = " + ".join(f"({o} - {x}) * ({o} - {x})" for o, x in zip(names[-1], names[0], strict=True))
    zeros = f"list_transform(range({len(gradient)}), lambda i: 0.0::DOUBLE)"
    out_sql = [f"s0 AS (SELECT {_initial_sql(sizes, SEED)} AS w, {zeros} AS m, {zeros} AS v, 0.0::DOUBLE AS loss, 0 AS cells)"]
    for step in range(steps):
        n = step + 1
        rows = _nested(f"(SELECT z.*, w, m, v FROM z, s{step} WHERE batch = {step % batches}) b", [*forward, *backward])
        out_sql.append(f"""g{n} AS (SELECT {grad} AS g, any_value(w) AS w, any_value(m) AS m, any_value(v) AS v, sum({lost}) AS loss, {cells} AS cells FROM {rows}),
        u{n} AS (SELECT w, loss, cells, list_transform(m, lambda x, i: x + (1 - {BETA1}::DOUBLE) * (g[i] - x)) AS m,
            list_transform(v, lambda x, i: x + (1 - {BETA2}::DOUBLE) * (g[i] * g[i] - x)) AS v FROM g{n}),
        s{n} AS (SELECT list_transform(w, lambda x, i: x - {LEARNING_RATE}::DOUBLE * (m[i] / (1 - pow({BETA1}::DOUBLE, {n})))
            / (sqrt(v[i] / (1 - pow({BETA2}::DOUBLE, {n}))) + {EPSILON}::DOUBLE)) AS w, m, v, loss, cells FROM u{n})""")
    return ", ".join(out_sql)


def _small_sql(batches: int, steps: int) -> str:
    scaled = ", ".join(f"({f} - m_{f}) / s_{f} AS x{i}" for i, f in enumerate(SMALL))
    blocks = f"({batches} * CAST(ceil((SELECT count(*) FROM feats) / ({batches} * {BLOCK_ROWS}.0::DOUBLE)) AS BIGINT))"
    return f"""WITH {FEATS}, {stats_sql(SMALL)},
        z AS (SELECT {scaled}, {hash_sql('row_id', SEED)} % {blocks} % {batches} AS batch FROM feats, st),
        {_chain_sql(layer_sizes(len(SMALL), HIDDEN), batches, steps)}"""


def _weights_sql(batches: int, steps: int) -> str:
    return f"""{_small_sql(batches, steps)} SELECT CAST(i AS INTEGER) AS place, {r('w[i]', 8)} AS weight
        FROM (SELECT w, unnest(generate_series(1, len(w))) AS i FROM s{steps}) t"""


def _network_sql() -> str:
    sizes = layer_sizes(len(FEATURES), (8, 4))
    names, forward = _forward_sql(sizes)
    scaled = ", ".join(f"({f} - m_{f}) / s_{f} AS x{i}" for i, f in enumerate(FEATURES))
    error = " + ".join(f"({o} - {x}) * ({o} - {x})" for o, x in zip(names[-1], names[0], strict=True))
    return f"""WITH {FEATS}, {stats_sql(FEATURES)}, w AS (SELECT {_initial_sql(sizes, SEED)} AS w),
        z AS (SELECT row_id, {scaled}, w FROM feats, st, w), e AS (SELECT row_id, ({error}) / {len(FEATURES)} AS score FROM {_nested('z', forward)}),
        c AS (SELECT {cut_sql('score', 'e')} AS c) SELECT row_id, {r('score')} AS score, CAST(score > c AS INTEGER) AS pred FROM e, c"""


_LOSSES = " UNION ALL ".join(
    f"SELECT {e + 1} AS epoch, {r('sum(loss) / sum(cells)', 8)} AS loss FROM ({' UNION ALL '.join(f'SELECT loss, cells FROM s{e * STEPS + k + 1}' for k in range(STEPS))}) e{e}"
    for e in range(EPOCHS))

ORACLES = {
    "training_one_step": _weights_sql(1, 1),
    "training_steps": _weights_sql(STEPS, EPOCHS * STEPS),
    "training_loss_steps": f"{_small_sql(STEPS, EPOCHS * STEPS)} {_LOSSES}",
    "network_scores": _network_sql(),
}
