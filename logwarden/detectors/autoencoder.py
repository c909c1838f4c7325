"""Autoencoder trained by synchronous gradient descent.

Rows are dealt into blocks by hash and packed, one block a row, on disk; a block belongs to one global
batch. Each step is one job: every task sums the gradient over the blocks of the batch that it holds, the
sums of all tasks are added in a tree, and one Adam step moves the weights. Gradients are added as
integers (units of 2 ** -40, in two limbs), so their sum is the same in any order: the trained network
does not depend on partitions, cores or Arrow batches. A batch is ``1 / steps`` of the table, so the number
of jobs stays fixed and every core takes part, whatever the size. All rows are used in every epoch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.common import portable_hash, portable_number, work_path
from logwarden.detectors.base import RAW, Detector, Model
from logwarden.operators.scaling import Scale, fit_scale

# Fixed values of the training recipe.
HIDDEN = (64, 32, 16)
EPOCHS, BATCH, LEARNING_RATE = 100, 32, 1e-3
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8

STEPS = 2  # global batches, and so Adam steps, per epoch
BLOCK_ROWS = 2048
PIECE_ROWS = 512  # rows whose layers are held at a time; with the default widths they fit a core's caches
LIMB = 40  # binary places of a summed gradient
PART_SCHEMA = "part int, sums array<bigint>"
FAN_IN = 64  # task sums that one step of the tree adds


def layer_sizes(inputs: int, hidden: Sequence[int]) -> list[int]:
    """Encoder widths, then the same in reverse: the narrowest layer appears twice."""
    return [inputs, *hidden, *reversed(hidden), inputs]


class Network:
    """A dense network whose weights are views into one flat vector."""

    def __init__(self, sizes: Sequence[int], flat: np.ndarray):
        self.sizes, self.flat = list(sizes), flat
        self.layers, at = [], 0
        for a, b in zip(sizes[:-1], sizes[1:], strict=True):
            self.layers.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
            at += a * b + b

    @staticmethod
    def length(sizes: Sequence[int]) -> int:
        return sum(a * b + b for a, b in zip(sizes[:-1], sizes[1:], strict=True))

    @classmethod
    def initial(cls, sizes: Sequence[int], seed: int) -> Network:
        """Uniform weights from portable hashes of their places."""
        bound = np.concatenate([np.full(a * b + b, 1 / np.sqrt(a)) for a, b in zip(sizes[:-1], sizes[1:], strict=True)])
        draws = np.array([portable_number(i, seed=seed) for i in range(len(bound))]) / 2.0**52
        return cls(sizes, (2 * draws - 1) * bound)

    def errors(self, x: np.ndarray) -> np.ndarray:
        """Mean squared reconstruction error per row."""
        return Passes(self).errors(x.T)

    def summed(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Squared errors of all cells added up, and the gradient of that sum."""
        return Passes(self).summed(x.T)

    def loss_and_gradient(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """The mean squared error of all cells, and its gradient."""
        loss, grad = self.summed(x)
        return loss / x.size, grad / x.size


class Passes:
    """Forward and backward passes of a network over pieces of ``PIECE_ROWS`` rows, given as columns.

    The room for a piece is made once, and its layers stay in the caches. A last line of ones takes the biases
    through the products: weights and bias of a layer stand one below the other in the flat vector.
    """

    def __init__(self, net: Network):
        self.layers, at = [], 0
        for a, b in zip(net.sizes[:-1], net.sizes[1:], strict=True):
            self.layers.append(net.flat[at:at + (a + 1) * b].reshape(a + 1, b))
            at += (a + 1) * b
        self.forth = [np.ascontiguousarray(layer.T) for layer in self.layers]
        self.values = [np.ones((width + 1, PIECE_ROWS)) for width in net.sizes]
        self.backs = [np.empty((width, PIECE_ROWS)) for width in net.sizes]
        self.alive = [np.empty((width, PIECE_ROWS), bool) for width in net.sizes]
        self.parts = [np.empty_like(layer) for layer in self.layers]

    def _wrong(self, x: np.ndarray) -> np.ndarray:
        """Reconstruction minus input of a piece."""
        n, last = x.shape[1], len(self.layers) - 1
        self.values[0][:-1, :n] = x
        for i, layer in enumerate(self.forth):
            out = np.matmul(layer, self.values[i][:, :n], out=self.values[i + 1][:-1, :n])
            if i < last:
                np.maximum(out, 0.0, out=out)
        return np.subtract(out, x, out=out)

    def errors(self, x: np.ndarray) -> np.ndarray:
        """Mean squared reconstruction error per column."""
        out = np.empty(x.shape[1])
        for at in range(0, len(out), PIECE_ROWS):
            wrong = self._wrong(x[:, at:at + PIECE_ROWS])
            out[at:at + PIECE_ROWS] = np.mean(wrong * wrong, axis=0)
        return out

    def summed(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Squared errors of all cells added up, and the gradient of that sum."""
        loss, grads = 0.0, [np.zeros_like(layer) for layer in self.layers]
        for at in range(0, x.shape[1], PIECE_ROWS):
            wrong = self._wrong(x[:, at:at + PIECE_ROWS])
            n = wrong.shape[1]
            loss += float(np.sum(wrong * wrong))
            back = np.multiply(wrong, 2.0, out=self.backs[-1][:, :n])
            for i in range(len(self.layers) - 1, -1, -1):
                values = self.values[i][:, :n]
                grads[i] += np.matmul(values, back.T, out=self.parts[i])
                if i:
                    back = np.matmul(self.layers[i][:-1], back, out=self.backs[i][:, :n])
                    back *= np.greater(values[:-1], 0.0, out=self.alive[i][:, :n])
        return loss, np.concatenate([grad.ravel() for grad in grads])


class AdamState:
    """Weights, both moments and the step count as one vector of doubles."""

    def __init__(self, sizes: Sequence[int], state: np.ndarray):
        n = Network.length(sizes)
        self.net = Network(sizes, state[:n].copy())
        self.first, self.second = state[n:2 * n].copy(), state[2 * n:3 * n].copy()
        self.steps = float(state[3 * n])

    @staticmethod
    def start(net: Network) -> np.ndarray:
        n = len(net.flat)
        return np.concatenate([net.flat, np.zeros(2 * n + 1)]).astype(np.float64)

    def move(self, grad: np.ndarray, rate: float) -> None:
        self.steps += 1
        self.first += (1 - BETA1) * (grad - self.first)
        self.second += (1 - BETA2) * (grad * grad - self.second)
        slope = self.first / (1 - BETA1**self.steps)
        width = np.sqrt(self.second / (1 - BETA2**self.steps)) + EPSILON
        self.net.flat -= rate * slope / width

    def step(self, batch: np.ndarray, rate: float) -> float:
        loss, grad = self.net.loss_and_gradient(batch)
        self.move(grad, rate)
        return loss

    def vector(self) -> np.ndarray:
        return np.concatenate([self.net.flat, self.first, self.second, [self.steps]])


def to_limbs(values: np.ndarray) -> np.ndarray:
    """Whole parts and binary places as integers, whose sums are exact."""
    if not np.all(np.abs(values) < 2.0**52):
        raise ValueError("training diverged: a gradient is not finite")
    whole = np.floor(values)
    return np.concatenate([whole, np.rint((values - whole) * 2.0**LIMB)]).astype(np.int64)


def carried(limbs: np.ndarray) -> np.ndarray:
    """The same value with binary places below one, so that long sums cannot overflow."""
    whole, places = limbs[:len(limbs) // 2], limbs[len(limbs) // 2:]
    return np.concatenate([whole + (places >> LIMB), places & ((1 << LIMB) - 1)])


def from_limbs(limbs: np.ndarray) -> np.ndarray:
    return limbs[:len(limbs) // 2] + limbs[len(limbs) // 2:] / 2.0**LIMB


def _gradient_task(sizes: Sequence[int], flat: np.ndarray):
    """Rows, loss and gradient summed over the blocks of a task, in limbs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes, total, part = Passes(Network(sizes, flat)), None, 0
        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells"), strict=True):
                x = cells.values.to_numpy(zero_copy_only=False).reshape(-1, sizes[0])
                loss, grad = passes.summed(x.T)
                limbs = to_limbs(np.concatenate([[len(x), loss], grad]))
                total, part = limbs if total is None else carried(total + limbs), block
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part % (1 << 20)], pa.int32()),
                                              "sums": pa.array([total], pa.list_(pa.int64()))})
    return run


def _add(table: pa.Table) -> pa.Table:
    """The sum of some task sums."""
    return pa.table({"part": table.column("part")[:1], "sums": pa.array([_total(table)], pa.list_(pa.int64()))})


def _total(table: pa.Table) -> np.ndarray:
    rows = table.column("sums").combine_chunks()
    return carried(rows.flatten().to_numpy().reshape(len(rows), -1).sum(axis=0))


def _tree_sum(sums: DataFrame, tasks: int) -> np.ndarray:
    """All task sums added, level by level; at most ``FAN_IN`` rows come to the driver."""
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        sums = sums.groupBy(F.pmod(F.hash("part"), F.lit(tasks)).alias("above")).applyInArrow(_add, PART_SCHEMA)
    return from_limbs(_total(sums.toArrow()))


def batch_count(rows: int, steps: int, batch_rows: int) -> int:
    """Global batches per epoch; none is smaller than ``batch_rows`` on average."""
    return max(1, min(steps, rows // batch_rows))


def _packed(table: DataFrame, names: Sequence[str], row_id: str, batches: int, blocks: int, seed: int) -> list[tuple[DataFrame, int]]:
    """One table of packed blocks per global batch, and in how many tasks it is read.

    Rows stand in the order of their ids within a block; blocks are dealt out evenly to the partitions.
    """
    spark = table.sparkSession
    per_batch = -(-blocks // batches)
    parts = min(per_batch, max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    row = F.struct(F.col(row_id), F.array(*[F.col(c).cast("double") for c in names]).alias("x"))
    block = F.pmod(portable_hash(row_id, seed=seed), F.lit(blocks)).cast("int").alias("block")
    packed = table.groupBy(block).agg(F.sort_array(F.collect_list(row)).alias("rows")).select(
        F.pmod("block", F.lit(batches)).alias("batch"), "block", F.flatten(F.transform("rows", lambda r: r["x"])).alias("cells"))
    path = work_path(spark, "training")
    dealt = packed.repartitionById(parts, F.pmod(F.floor(F.col("block") / batches), F.lit(parts)).cast("int"))
    dealt.write.partitionBy("batch").parquet(path)
    found = []
    for batch in range(batches):
        part = spark.read.schema("block int, cells array<double>").option("recursiveFileLookup", "true").parquet(f"{path}/batch={batch}")
        found.append((part, part.rdd.getNumPartitions()))
    return found


def train(table: DataFrame, names: Sequence[str], row_id: str, hidden: Sequence[int], epochs: int, batch_rows: int, rate: float, seed: int,
          steps: int = STEPS, shards: int | None = None) -> tuple[Network, list[float]]:
    """Train on every row of ``(row_id, names...)``; gives the network and the loss per epoch.

    ``shards`` is the number of blocks that the rows are packed into; by default a block has about ``BLOCK_ROWS``.
    The loss of an epoch is the mean over its rows, each under the weights its batch was met with.
    """
    n = table.count()
    if not n:
        raise ValueError("cannot fit an empty table")
    batches = batch_count(n, steps, batch_rows)
    blocks = shards or batches * -(-n // (batches * BLOCK_ROWS))
    batches = min(batches, blocks)
    sizes = layer_sizes(len(names), hidden)
    state = AdamState(sizes, AdamState.start(Network.initial(sizes, seed)))
    packed = _packed(table, names, row_id, batches, blocks, seed)
    history = []
    for _ in range(epochs):
        seen = lost = 0.0
        for part, tasks in packed:
            if not tasks:
                continue
            sums = _tree_sum(part.mapInArrow(_gradient_task(sizes, state.net.flat.copy()), PART_SCHEMA), tasks)
            rows, loss, grad = sums[0], sums[1], sums[2:]
            state.move(grad / (rows * sizes[0]), rate)
            seen, lost = seen + rows, lost + loss
        history.append(float(lost / (seen * sizes[0])))
    return Network(sizes, state.net.flat), history


class AutoencoderModel(Model):
    method = "autoencoder"

    def __init__(self, scale: Scale, network: Network, history: Sequence[float] = (), cut: float | None = None):
        super().__init__(scale.features, cut)
        self.scale, self.network, self.history = scale, network, list(history)

    def with_raw(self, df: DataFrame, out: str = RAW, on_null: str = "error") -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((self.network.sizes, self.network.flat))

        @F.pandas_udf("double")
        def error(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])
            return pd.Series(Network(*shared.value).errors(x))

        return df.withColumn(out, error(*self.scale.scaled(self.inputs(on_null))))

    def loss_history(self, spark) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.history, 1)), "epoch int, loss double")

    def params(self) -> dict:
        return {**super().params(), "means": list(self.scale.means), "stds": list(self.scale.stds),
                "sizes": self.network.sizes, "history": self.history}

    def arrays(self):
        return {"weights": self.network.flat}

    @classmethod
    def restore(cls, params, arrays):
        scale = Scale(tuple(params["features"]), tuple(params["means"]), tuple(params["stds"]))
        return cls(scale, Network(params["sizes"], arrays["weights"].astype(np.float64)),
                   params["history"], params["cut"])


class AutoencoderDetector(Detector):
    def __init__(self, features: Sequence[str] | None = None, contamination: float = 0.1,
                 row_id: str = "row_id", seed: int = 42, on_null: str = "error",
                 hidden_dims: Sequence[int] = HIDDEN, epochs: int = EPOCHS, batch_size: int = BATCH,
                 learning_rate: float = LEARNING_RATE, steps: int = STEPS, shards: int | None = None):
        super().__init__(features, contamination, row_id, seed, on_null)
        if min(epochs, batch_size, steps, shards or 1) < 1 or shards == 0 or not hidden_dims:
            raise ValueError("epochs, batch_size, steps, shards and hidden_dims must be positive")
        self.hidden_dims, self.epochs, self.batch_size = tuple(hidden_dims), epochs, batch_size
        self.learning_rate, self.steps, self.shards = learning_rate, steps, shards

    def learn(self, df: DataFrame) -> tuple[AutoencoderModel, DataFrame]:
        names = self.training_features(df)
        table = self.training_table(df, names, self.row_id)
        scale = fit_scale(table, names).rounded()  # sums of doubles depend on their order in the last digits
        scaled = scale.scaled([F.col(c) for c in names])
        network, history = train(
            table.select(self.row_id, *[z.alias(c) for c, z in zip(names, scaled, strict=True)]), names,
            self.row_id, self.hidden_dims, self.epochs, self.batch_size, self.learning_rate,
            self.seed, self.steps, self.shards)
        return AutoencoderModel(scale, network, history), table
