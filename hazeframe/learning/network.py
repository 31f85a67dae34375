"""Feed-forward regression network trained by distributed gradients.

spark.ml has no neural regressor. The rows are dealt into blocks by a hash of their key, about BLOCK_ROWS each, in an order of
their own. Every pass sends the parameters to the blocks; each gives the sums of its errors and gradients, and these are
added up block by block in a fixed order, so that the fitted weights depend on the rows alone: not on tasks, partitions or
reruns. The driver reads at most FAN sums of a few thousand numbers and takes a limited-memory quasi-Newton step (Nocedal, 1980).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeframe.session import cut_lineage

# Task functions travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DECAY = 1e-4
#: Rows of a block on average, and sums that are added up at once.
BLOCK_ROWS, FAN = 1024, 256
#: Steps whose curvature is remembered, and what a step must at least gain of what its slope promises.
MEMORY, GAIN = 12, 1e-4
VALIDATION_SHARE, PATIENCE, TOLERANCE = 0.1, 10, 1e-4


def initial_weights(sizes: Sequence[int], seed: int) -> np.ndarray:
    """Glorot-uniform weights and biases of all layers in one vector."""
    rng = np.random.default_rng(seed)
    parts = []
    for n_in, n_out in zip(sizes, sizes[1:]):
        bound = np.sqrt(6.0 / (n_in + n_out))
        parts += [rng.uniform(-bound, bound, n_in * n_out), rng.uniform(-bound, bound, n_out)]
    return np.concatenate(parts)


def layers_of(vector: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views (weights, bias) of each layer into the vector."""
    layers, at = [], 0
    for n_in, n_out in zip(sizes, sizes[1:]):
        end = at + n_in * n_out
        layers.append((vector[at:end].reshape(n_in, n_out), vector[end : end + n_out]))
        at = end + n_out
    return layers


def forward(x: np.ndarray, vector: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """Activations of every layer, input first; hidden layers are rectified."""
    outputs = [x]
    layers = layers_of(vector, sizes)
    for depth, (weights, bias) in enumerate(layers):
        z = outputs[-1] @ weights + bias
        outputs.append(z if depth == len(layers) - 1 else np.maximum(z, 0.0))
    return outputs


def gradient(x: np.ndarray, y: np.ndarray, vector: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """Gradient of half the mean squared error plus the weight penalty."""
    return (gradient_sum(x, y, vector, sizes)[1] + decay(vector, sizes)) / len(y)


def gradient_sum(x: np.ndarray, y: np.ndarray, vector: np.ndarray, sizes: Sequence[int]) -> tuple[float, np.ndarray]:
    """Half the sum of squared errors, and its gradient."""
    outputs = forward(x, vector, sizes)
    delta = (outputs[-1][:, 0] - y)[:, None]
    error = float(delta[:, 0] @ delta[:, 0]) / 2
    result = np.empty_like(vector)
    layers, slots = layers_of(vector, sizes), layers_of(result, sizes)
    for depth in reversed(range(len(layers))):
        slots[depth][0][:] = outputs[depth].T @ delta
        slots[depth][1][:] = delta.sum(axis=0)
        if depth:
            delta = (delta @ layers[depth][0].T) * (outputs[depth] > 0)
    return error, result


def decay(vector: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """Gradient of the weight penalty, which leaves biases alone."""
    result = np.zeros_like(vector)
    for (slot, _), (weights, _) in zip(layers_of(result, sizes), layers_of(vector, sizes)):
        slot[:] = DECAY * weights
    return result


#: What a block's sums begin with: half its squared error, its rows, and of the rows held out the squared error, the sum of
#: the truth and of its squares, and their number. The gradient follows.
HEAD = 6


def _block_sums(shared, sizes: Sequence[int]):
    """Task: the sums of each block."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vector = shared.value
        for frame in frames:
            totals = []
            for rows in frame["rows"]:
                table = np.array([(*r["x"], r["target"], r["held_out"]) for r in rows], dtype=float)
                held = table[:, -1] > 0
                x, y = table[:, :-2], table[:, -2]
                error, slope = gradient_sum(x[~held], y[~held], vector, sizes)
                missed = forward(x[held], vector, sizes)[-1][:, 0] - y[held]
                head = [error, (~held).sum(), missed @ missed, y[held].sum(), y[held] @ y[held], held.sum()]
                totals.append(np.concatenate([head, slope]))
            yield pd.DataFrame({"block": frame["block"], "sums": totals})

    return run


def _added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of neighbouring rows of one group, from the first to the last."""
    group, total = None, None
    for frame in frames:
        for block, sums in zip(frame["block"].tolist(), frame["sums"]):
            if block // FAN != group:
                if group is not None:
                    yield pd.DataFrame({"block": [group], "sums": [total]})
                group, total = block // FAN, np.array(sums)
            else:
                total = total + sums
    if group is not None:
        yield pd.DataFrame({"block": [group], "sums": [total]})


SUMS = "block long, sums array<double>"


def total_of(sums: DataFrame, blocks: int) -> np.ndarray:
    """The sum over numbered blocks, in order: groups of FAN first, then groups of groups; the driver adds the last ones."""
    while blocks > FAN:
        group = F.floor(F.col("block") / FAN)
        sums = sums.withColumn("group", group).repartition("group").sortWithinPartitions("group", "block").drop("group")
        sums, blocks = sums.mapInPandas(_added, SUMS), -(-blocks // FAN)
    rows = sorted((row.block, row.sums) for row in sums.collect())
    total = np.zeros(len(rows[0][1]))
    for _, row in rows:
        total = total + np.array(row)
    return total


class Descent:
    """Directions of a limited-memory quasi-Newton method, from the last steps and the changes of slope they made."""

    def __init__(self):
        self.steps: list[tuple[np.ndarray, np.ndarray]] = []

    def learn(self, step: np.ndarray, change: np.ndarray) -> None:
        if step @ change > 1e-10 * np.sqrt((step @ step) * (change @ change)):
            self.steps = [*self.steps[1 - MEMORY :], (step, change)]

    def direction(self, slope: np.ndarray) -> np.ndarray:
        towards, shares = -slope, []
        for step, change in reversed(self.steps):
            share = (step @ towards) / (step @ change)
            shares.append(share)
            towards = towards - share * change
        if self.steps:
            step, change = self.steps[-1]
            towards = towards * ((step @ change) / (change @ change))
        else:
            towards = towards / max(1.0, float(np.sqrt(slope @ slope)))
        for (step, change), share in zip(self.steps, reversed(shares)):
            towards = towards + (share - (change @ towards) / (step @ change)) * step
        return towards


@dataclass
class NetworkModel:
    """Preprocessing pipeline plus trained parameters; behaves like a fitted spark.ml model."""

    preparation: PipelineModel
    sizes: list[int]
    weights: np.ndarray
    scores: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `prediction`. The parameters sent along are a few thousand numbers."""
        shared = df.sparkSession.sparkContext.broadcast(self.weights)
        sizes = self.sizes

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series(dtype=float)
            return pd.Series(forward(np.stack(x.to_numpy()), shared.value, sizes)[-1][:, 0])

        prepared = self.preparation.transform(df)
        return prepared.withColumn("prediction", predict(vector_to_array("features")))

    def save(self, path: str) -> None:
        """Replace the model folder, whatever it held: the pipeline, and the parameters as a small table beside it."""
        self.preparation.write().overwrite().save(path)
        spark = SparkSession.active()
        row = (json.dumps(self.sizes), self.weights.tolist())
        table = spark.createDataFrame([row], "sizes string, weights array<double>")
        table.write.mode("overwrite").parquet(f"{path}/parameters")

    @classmethod
    def load(cls, path: str) -> NetworkModel:
        row = SparkSession.active().read.parquet(f"{path}/parameters").first()
        preparation = PipelineModel.load(path)
        return cls(preparation, json.loads(row.sizes), np.array(row.weights))


def fit_network(
    train: DataFrame,
    preparation: PipelineModel,
    key: Sequence[Column | str],
    hidden: Sequence[int] = (64, 32),
    epochs: int = 60,
    seed: int = 42,
    tasks: int | None = None,
) -> NetworkModel:
    """Train on `features` of the prepared rows against `target`, with early stopping.

    A tenth of the rows, chosen by a hash of `key`, is held out; training ends when R2 on it has not
    improved for ten steps, or after `epochs` passes, and the best parameters are returned. `tasks` says how many tasks
    share the blocks (by default what the cluster runs at once, four times over); the weights don't depend on it.
    """
    spark = train.sparkSession
    in_tenth = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1000)) < int(1000 * VALIDATION_SHARE)
    mixed = F.xxhash64(*key)
    prepared = preparation.transform(train).select(
        mixed.alias("mixed"), vector_to_array("features").alias("x"), "target", in_tenth.alias("held_out")
    )
    blocks = max(1, -(-prepared.count() // BLOCK_ROWS))
    # Rows of equal key stand in the order of their values.
    rows = F.array_sort(F.collect_list(F.struct("mixed", "target", "held_out", "x"))).alias("rows")
    dealt = prepared.groupBy(F.pmod("mixed", F.lit(blocks)).alias("block")).agg(rows)
    tasks = min(blocks, tasks or 4 * spark.sparkContext.defaultParallelism)
    dealt = cut_lineage(dealt.repartition(tasks, "block"))
    first = dealt.first()
    if first is None:
        raise ValueError("no rows to train on")
    sizes = [len(first.rows[0].x), *hidden, 1]

    def measured(vector: np.ndarray) -> tuple[float, np.ndarray, float, bool]:
        """Loss and slope on the rows to learn from, R2 on the others, and whether there is anything to learn from."""
        shared = spark.sparkContext.broadcast(vector)
        total = total_of(dealt.mapInPandas(_block_sums(shared, sizes), SUMS), blocks)
        shared.destroy()
        error, n, missed, truth, squares, n_held = total[:HEAD]
        penalty = decay(vector, sizes)
        loss = (error + vector @ penalty / 2) / max(n, 1)
        spread = squares - truth**2 / n_held if n_held else 0.0
        return loss, (total[HEAD:] + penalty) / max(n, 1), 1.0 - missed / spread if spread > 0 else -np.inf, n > 0

    weights = initial_weights(sizes, seed)
    loss, slope, score, some = measured(weights)
    best, best_score, stale, scores, descent, passes = weights, score, 0, [float(score)], Descent(), 0
    while some and passes < epochs and stale < PATIENCE:
        towards, length = descent.direction(slope), 1.0
        if towards @ slope >= 0:
            descent = Descent()
            towards = descent.direction(slope)
        while passes < epochs:
            passes += 1
            there = weights + length * towards
            new_loss, new_slope, score, _ = measured(there)
            if new_loss <= loss + GAIN * length * (towards @ slope):
                break
            length /= 4
        else:
            break
        if not np.isfinite(new_loss) or new_loss >= loss:
            break
        descent.learn(there - weights, new_slope - slope)
        weights, loss, slope = there, new_loss, new_slope
        scores.append(float(score))
        stale = 0 if score > best_score + TOLERANCE else stale + 1
        if score > best_score:
            best, best_score = weights, score
    if not np.isfinite(best_score):
        best = weights
    return NetworkModel(preparation, sizes, best, scores)
