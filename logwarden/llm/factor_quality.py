"""Text quality by a factorisation machine.

A document is a sparse vector: hashed words weighted by frequency, binned statistics of its
structure, and its binned recorded length (metadata). The machine scores it as

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

so all pairwise interactions cost time linear in the non-zero entries. It is fitted by AdaGrad on
logistic loss, on at most ``fit_rows`` labelled documents chosen by the hash of their id: this
bounds the fit, which runs in one task, at any size of the table. Scoring is a single pass over the
documents with the model broadcast; its size is fixed by ``BUCKETS`` and ``FACTORS``.

Defined cases: null text is an empty text and gets a score from its structure; a null recorded length
is taken from the text; without labels of both kinds every score is the smoothed share of good ones;
labels that disagree are averaged; repeated rows are scored one by one; other columns of the input
are not touched. Language, source and doc_id never enter a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.tables import small_batches, whole_text

BUCKETS = 1 << 16
FACTORS = 8
BINS = 12
FIT_ROWS = 8192  # most labelled documents that the fit reads
EPOCHS = 12
LEAST_STEPS = 1500  # small samples are read more often, so that every fit takes at least this many steps
BATCH = 64
RATE, DECAY_WORDS, DECAY_STATS, WORD_SCALE = 0.1, 1e-4, 1e-6, 0.5
STATS = ("log_words", "log_chars", "log_recorded", "word_length", "distinct", "top_word", "same_neighbour", "symbols",
         "capitals", "digits", "bars", "line_words", "same_lines", "ends", "odd_ends", "commas", "no_letters", "braces")
WIDTH = BUCKETS + len(STATS) * BINS
SYMBOLS = "#*$%&<>"
KEPT_WORDS = 200_000

_buckets: dict[str, int] = {}


def _bucket(word: str) -> int:
    found = crc32(word.encode("utf-8", "replace")) % BUCKETS
    if len(_buckets) >= KEPT_WORDS:
        _buckets.clear()
    _buckets[word] = found
    return found


def statistics(text: str, words: list[str], counts: Counter, recorded: int | None) -> list[float]:
    """The structure of a text, each entry scaled to about 0 to 1; the order is that of ``STATS``."""
    n, chars = len(words), len(text)
    some, size = max(n, 1), max(chars, 1)
    lines = [line for line in text.split("\n") if line.strip()]
    ends = Counter(word[-1] for word in words)
    full = ends["."] + ends["?"] + ends["!"]
    odd = sum(k for end, k in ends.items() if not end.isalnum() and end not in ".,;:?\"')")
    return [
        math.log2(n + 1) / 16, math.log2(chars + 1) / 20, math.log2((chars if recorded is None else max(recorded, 0)) + 1) / 20,
        sum(map(len, words)) / some / 12, len(counts) / some, 2 * max(counts.values(), default=0) / some,
        2 * sum(map(eq, words, words[1:])) / some, 8 * sum(map(text.count, SYMBOLS)) / size, sum(map(str.isupper, words)) / some,
        4 * sum(map(str.isdigit, words)) / some, 4 * text.count("|") / some, math.log2(some / max(1, len(lines)) + 1) / 12,
        1 - len(set(lines)) / max(1, len(lines)), 5 * full / some, 2 * odd / some, 5 * ends[","] / some,
        4 * sum(not any(map(str.isalpha, w)) * k for w, k in counts.items()) / some, 20 * (text.count("{") + text.count("(")) / size,
    ]


def features(text: str | None, recorded: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the non-zero entries of a document."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    known = _buckets.get
    ids = [known(w) or _bucket(w) for w in counts]
    weights = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    if len(ids):
        weights *= WORD_SCALE / np.sqrt(np.dot(weights, weights))
    stats = statistics(text, words, counts, recorded)
    bins = [BUCKETS + i * BINS + min(BINS - 1, max(0, int(v * BINS))) for i, v in enumerate(stats)]
    index = np.array(ids + bins, np.int32)
    value = np.concatenate([weights, np.full(len(bins), 1 / math.sqrt(len(bins)), np.float32)])
    return index, value.astype(np.float32)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the logistic function; ``starts`` cuts the entries into documents."""
        vx = self.factors[index] * value[:, None]
        total = np.add.reduceat(vx, starts, axis=0)
        square = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), starts)
        linear = np.add.reduceat(self.weights[index] * value, starts)
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - square)


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Fit by AdaGrad in small batches; the result depends on the rows and their order alone."""
    labels = np.array([label for _, _, label in rows], np.float32)
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    model = Machine(bias, np.zeros(WIDTH, np.float32), np.zeros((WIDTH, FACTORS), np.float32))
    if not len(rows) or labels.min() >= 0.5 or labels.max() < 0.5:
        return model
    draw = np.random.default_rng(seed)
    model.factors = draw.normal(0, 0.05, (WIDTH, FACTORS)).astype(np.float32)
    w_sum, v_sum, b_sum = np.full(WIDTH, 1e-2, np.float32), np.full((WIDTH, FACTORS), 1e-2, np.float32), 1e-2
    decay = np.full(WIDTH, DECAY_WORDS, np.float32)
    decay[BUCKETS:] = DECAY_STATS
    steps = -(-len(rows) // BATCH)
    for _ in range(max(epochs, -(-LEAST_STEPS // steps))):
        order = draw.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            own = order[at:at + BATCH]
            index = np.concatenate([rows[i][0] for i in own])
            value = np.concatenate([rows[i][1] for i in own])
            sizes = np.array([len(rows[i][0]) for i in own])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            error = 1 / (1 + np.exp(-model.raw(index, value, starts))) - labels[own]
            per = np.repeat(error, sizes).astype(np.float32) / len(own)
            vx = model.factors[index] * value[:, None]
            total = np.repeat(np.add.reduceat(vx, starts, axis=0), sizes, axis=0)
            slots, where = np.unique(index, return_inverse=True)
            w_step = np.bincount(where, per * value, len(slots)).astype(np.float32) + decay[slots] * model.weights[slots]
            push = (per * value)[:, None] * (total - vx)
            v_step = np.stack([np.bincount(where, push[:, f], len(slots)) for f in range(FACTORS)], axis=1).astype(np.float32)
            v_step += decay[slots, None] * model.factors[slots]
            w_sum[slots] += w_step * w_step
            v_sum[slots] += v_step * v_step
            model.weights[slots] -= RATE * w_step / np.sqrt(w_sum[slots])
            model.factors[slots] -= RATE * v_step / np.sqrt(v_sum[slots])
            b_step = float(error.mean())
            b_sum += b_step * b_step
            model.bias -= RATE * b_step / math.sqrt(b_sum)
    return model


def _recorded(docs: DataFrame) -> Column:
    return docs["n_chars"].cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """Rows that a fit must not see; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS) -> Machine:
    """A machine for ``label``, from labelled documents that are not held out."""
    known = labels.where(labels[label].isNotNull() & labels["doc_id"].isNotNull() & ~held_out(labels["doc_id"]))
    known = known.groupBy(labels["doc_id"].alias("_id")).agg(F.avg(labels[label]).alias("_label"))
    # At most fit_rows ids, so the broadcast is bounded.
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    text = whole_text(docs)
    met = small_batches(docs).select(docs["doc_id"].alias("_id"), text.alias("_text"), _recorded(docs).alias("_recorded")).join(
        F.broadcast(sample), "_id")
    bounded = met.orderBy(F.xxhash64("_id"), "_id", F.xxhash64("_text")).limit(fit_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for one in batch.to_pylist():
                rows.append((one["_id"], one["_text"], *features(one["_text"], one["_recorded"]), one["_label"]))
        rows.sort(key=lambda r: (crc32(str(r[0]).encode()), r[0], r[1]))
        model = train([r[2:] for r in rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.bias]), pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.factors.tobytes()], pa.binary())],
            ["bias", "weights", "factors"])

    found = bounded.coalesce(1).mapInArrow(run, "bias double, weights binary, factors binary").first()
    if found is None:
        return train([])
    return Machine(found["bias"], np.frombuffer(found["weights"], np.float32).copy(),
                   np.frombuffer(found["factors"], np.float32).reshape(WIDTH, FACTORS).copy())


def score(docs: DataFrame, model: Machine, keep: list[str] | None = None, name: str = "fm_score") -> DataFrame:
    """``docs`` (or its columns ``keep``) with a new column ``name`` between 0 and 1."""
    names = docs.columns if keep is None else keep
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            texts, recorded = batch.column(len(names)), batch.column(len(names) + 1)
            scores: list[np.ndarray] = []
            for at in range(0, batch.num_rows, 256):
                rows = [features(t.as_py(), r.as_py()) for t, r in zip(texts[at:at + 256], recorded[at:at + 256])]
                starts = np.cumsum([0, *[len(i) for i, _ in rows[:-1]]])
                raw = own.raw(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), starts)
                scores.append(1 / (1 + np.exp(-np.clip(raw.astype(np.float64), -500, 500))))
            out = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(out)], [f"c{i}" for i in range(len(names) + 1)])

    plain = small_batches(docs).select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)], whole_text(docs).alias("t"), _recorded(docs).alias("r"))
    shape = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    done = plain.mapInArrow(run, f"{shape}, c{len(names)} double" if names else "c0 double")
    return done.toDF(*names, name)
