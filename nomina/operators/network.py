"""A pair classifier of two hidden layers, trained by synchronous steps over partitions.

The training rows are dealt to as many mini-batches as an epoch has steps and stored by
batch. A step is one job over its batch: tasks sum the gradients of their rows with the
weights of the last step, the sums are added up, and Adam moves the weights. Only sums of
the size of the weights leave a task, so rows may be many; a lost task is run again from
the stored batch.

Batch normalisation takes its mean and variance from runs of ``ROWS`` rows inside a task
(the driver keeps their running averages for scoring), so no step needs a second pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from nomina.session import scratch_path

ROWS = 64  # rows that are normalised together
FEWEST_SUMS = 32  # sums of tasks that the driver adds up itself
MOMENTUM = 0.1  # fixed value: share of the newest step in the running averages
EPSILON = 1e-5  # fixed value: keeps variances off zero
ADAM_DECAY = (0.9, 0.999)  # fixed values: of the gradient and of its square
ADAM_EPSILON = 1e-8  # fixed value


@dataclass
class Weights:
    """All parameters as one vector with views into it, and the running averages of the layers."""

    sizes: tuple[int, ...]  # inputs, then the hidden layers
    vector: np.ndarray
    means: list[np.ndarray] = field(default_factory=list)
    variances: list[np.ndarray] = field(default_factory=list)

    @staticmethod
    def drawn(sizes: Sequence[int], seed: int) -> Weights:
        """Uniform weights and biases within 1 / sqrt(inputs of the layer); scales are one and shifts zero."""
        rng = np.random.default_rng(seed)
        parts = []
        for n, m in zip(sizes[:-1], sizes[1:]):
            bound = n**-0.5
            parts += [rng.uniform(-bound, bound, n * m), rng.uniform(-bound, bound, m), np.ones(m), np.zeros(m)]
        bound = sizes[-1] ** -0.5
        parts += [rng.uniform(-bound, bound, sizes[-1]), rng.uniform(-bound, bound, 1)]
        layers = sizes[1:]
        return Weights(tuple(sizes), np.concatenate(parts), [np.zeros(m) for m in layers], [np.ones(m) for m in layers])

    def layers(self, vector: np.ndarray) -> tuple[list[tuple[np.ndarray, ...]], tuple[np.ndarray, np.ndarray]]:
        """Matrix, bias, scale and shift of each hidden layer and matrix and bias of the output, as views of ``vector``."""
        hidden, at = [], 0
        for n, m in zip(self.sizes[:-1], self.sizes[1:]):
            ends = np.cumsum([at, n * m, m, m, m])
            w, b, scale, shift = (vector[i:j] for i, j in zip(ends[:-1], ends[1:]))
            hidden.append((w.reshape(n, m), b, scale, shift))
            at = int(ends[-1])
        return hidden, (vector[at : at + self.sizes[-1]], vector[at + self.sizes[-1] :])

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row, with the running averages and without dropout."""
        hidden, (w_out, b_out) = self.layers(self.vector)
        for (w, b, scale, shift), mean, variance in zip(hidden, self.means, self.variances):
            x = (np.maximum(x @ w + b, 0) - mean) / np.sqrt(variance + EPSILON) * scale + shift
        return _sigmoid(x @ w_out + b_out)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def gradient(weights: Weights, x: np.ndarray, y: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, float, int, list[np.ndarray]]:
    """Of rows normalised together: gradient and cross entropy summed over them, right answers, mean and variance by layer.

    ``kept`` multiplies the last hidden layer: zero where dropout falls, 1 / share kept elsewhere.
    """
    hidden, (w_out, b_out) = weights.layers(weights.vector)
    steps, moments, a = [], [], x
    for w, b, scale, shift in hidden:
        rectified = np.maximum(a @ w + b, 0)
        mean, variance = rectified.mean(axis=0), rectified.var(axis=0)
        spread = np.sqrt(variance + EPSILON)
        normal = (rectified - mean) / spread
        steps.append((a, rectified, normal, spread))
        moments += [mean, variance]
        a = normal * scale + shift
    dropped = a * kept
    z = dropped @ w_out + b_out
    loss = float(np.sum(np.logaddexp(0, z) - y * z))
    right = int(np.sum((z > 0) == (y == 1)))

    out = np.zeros_like(weights.vector)
    d_hidden, (d_w_out, d_b_out) = weights.layers(out)
    d_z = _sigmoid(z) - y
    d_w_out += dropped.T @ d_z
    d_b_out += d_z.sum()
    d_a = np.outer(d_z, w_out) * kept
    for (w, _, scale, _), (d_w, d_b, d_scale, d_shift), (a, rectified, normal, spread) in zip(
        reversed(hidden), reversed(d_hidden), reversed(steps)
    ):
        d_scale += (d_a * normal).sum(axis=0)
        d_shift += d_a.sum(axis=0)
        d_normal = d_a * scale
        d_rectified = (d_normal - d_normal.mean(axis=0) - normal * (d_normal * normal).mean(axis=0)) / spread
        d_linear = d_rectified * (rectified > 0)
        d_w += a.T @ d_linear
        d_b += d_linear.sum(axis=0)
        if a is not x:  # nothing lies below the first layer
            d_a = d_linear @ w.T
    return out, loss, right, moments


def _sums(weights: Weights, dropout: float, seed: tuple[int, ...]):
    """Task of a step: one row with the sums over all rows of a part.

    The vector holds the gradient, then means and variances of all layers times rows, then
    loss, right answers and rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng((*seed, TaskContext.get().partitionId()))
        total = None
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, weights.sizes[0])
            y = batch.column("y").to_numpy()
            for at in range(0, len(y), ROWS):
                part_x, part_y = x[at : at + ROWS], y[at : at + ROWS]
                kept = (rng.random((len(part_y), weights.sizes[-1])) >= dropout) / (1 - dropout)
                out, loss, right, moments = gradient(weights, part_x, part_y, kept)
                counted = np.concatenate([m * len(part_y) for m in moments])
                sums = np.concatenate([out, counted, [loss, right, len(part_y)]])
                total = sums if total is None else total + sums
        if total is not None:
            yield _one_row(total)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for row in batch.column("sums"):
            values = row.values.to_numpy()
            total = values.copy() if total is None else total + values
    if total is not None:
        yield _one_row(total)


def _one_row(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values], pa.list_(pa.float64()))], names=["sums"])


def _numbers() -> Column:
    return F.when(F.col("features").isNotNull(), vector_to_array("features"))


@dataclass
class NetworkModel:
    """A trained network; ``epochs`` is its log: ``(epoch, loss, accuracy)``, as long as there are epochs."""

    weights: Weights
    epochs: DataFrame

    def transform(self, pairs: DataFrame) -> DataFrame:
        """Add ``score``, the probability that a pair is a duplicate; pairs without features have none."""
        weights = self.weights

        def score(vectors: pd.Series) -> pd.Series:
            known = vectors.notna().to_numpy()
            out = pd.Series(np.full(len(vectors), np.nan))
            if known.any():
                out[known] = weights.scores(np.stack(vectors[known].to_list()))
            return out

        scored = F.pandas_udf(score, DoubleType())
        return pairs.withColumn("score", F.nanvl(scored(_numbers()), F.lit(None).cast("double")))


def train_network(
    train: DataFrame,
    inputs: int,
    hidden: Sequence[int] = (64, 64),
    epochs: int = 20,
    steps: int = 8,
    learning_rate: float = 0.005,
    dropout: float = 0.1,
    seed: int = 69,
) -> NetworkModel:
    """Fit on ``features`` (a vector of ``inputs`` numbers) and ``is_duplicate``.

    ``steps`` mini-batches make an epoch; rows are dealt to them at random, once, and the
    batches come in a new order each epoch. Rows without features or label take no part.
    Without any row the drawn weights stay and the log is empty. Sums of tasks arrive in any
    order, so two runs agree up to rounding.
    """
    spark = train.sparkSession
    path = scratch_path(spark, "network-batches")
    known = train.filter(F.col("features").isNotNull() & F.col("is_duplicate").isNotNull())
    rows = known.select(_numbers().alias("x"), F.col("is_duplicate").cast("double").alias("y"))
    dealt = rows.withColumn("batch", F.floor(F.rand(seed) * steps).cast("int"))
    for b in range(steps):  # a pass each: writing all at once would sort a task's vectors, far larger than their files, by batch
        dealt.filter(F.col("batch") == b).drop("batch").write.parquet(f"{path}/batch={b}")
    weights = Weights.drawn((inputs, *hidden), seed)
    schema = "epoch int, loss double, accuracy double"
    stored = spark.read.schema("x array<double>, y double, batch int").parquet(path)
    present = sorted(r.batch for r in stored.select("batch").distinct().collect())  # at most ``steps``
    batches = {b: spark.read.schema("x array<double>, y double").parquet(f"{path}/batch={b}") for b in present}
    many = {b: frame.rdd.getNumPartitions() > FEWEST_SUMS for b, frame in batches.items()}
    first, second, moved = np.zeros_like(weights.vector), np.zeros_like(weights.vector), 0
    order, log, n = np.random.default_rng(seed), [], len(weights.vector)
    for epoch in range(1, epochs + 1 if batches else 1):
        loss = right = count = 0.0
        for b in order.permutation(present).tolist():
            sums = batches[b].mapInArrow(_sums(weights, dropout, (seed, epoch, b)), "sums array<double>")
            if many[b]:
                sums = sums.repartition(FEWEST_SUMS).mapInArrow(_added, "sums array<double>")
            total = np.sum([row.sums for row in sums.collect()], axis=0)  # at most FEWEST_SUMS vectors
            loss, right, count = loss + total[-3], right + total[-2], count + total[-1]
            mean_gradient = total[:n] / total[-1]
            moved += 1
            first = ADAM_DECAY[0] * first + (1 - ADAM_DECAY[0]) * mean_gradient
            second = ADAM_DECAY[1] * second + (1 - ADAM_DECAY[1]) * mean_gradient**2
            step = first / (1 - ADAM_DECAY[0] ** moved) / (np.sqrt(second / (1 - ADAM_DECAY[1] ** moved)) + ADAM_EPSILON)
            moments = np.split(total[n:-3] / total[-1], np.cumsum(np.repeat(hidden, 2))[:-1])
            weights = Weights(
                weights.sizes,
                weights.vector - learning_rate * step,
                [(1 - MOMENTUM) * old + MOMENTUM * new for old, new in zip(weights.means, moments[0::2])],
                [(1 - MOMENTUM) * old + MOMENTUM * new for old, new in zip(weights.variances, moments[1::2])],
            )
        log.append((epoch, float(loss / count), float(right / count)))
    return NetworkModel(weights, spark.createDataFrame(log, schema))
