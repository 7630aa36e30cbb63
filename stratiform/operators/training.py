"""Training of multilayer perceptrons: every step is one Spark job that adds up gradients over a batch of rows.

The driver holds the weights, their moments and one gradient, all of the model's size; rows stay where they are. A step's tasks, one a
core at most, stream their rows and hand on sums in blocks of BLOCK numbers. A lost executor costs the tasks of one step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.algebra import finite
from ..sources.tables import shared_path
from .inference import Layers, predicted, sigmoid

BLOCK = 1024
SLOPE = 0.01


@dataclass
class Model:
    """Layers with leaky ReLU between them and a sigmoid at the end; inputs and outputs are scaled by the ranges of the training rows."""

    layers: Layers
    in_range: tuple[np.ndarray, np.ndarray]
    out_range: tuple[np.ndarray, np.ndarray]
    #: One dict an epoch: epoch, rate, train_mse, val_mae, val_mse.
    history: list[dict] = field(default_factory=list)

    def inputs(self, x: np.ndarray) -> np.ndarray:
        low, high = self.in_range
        return 2 * (x - low) / np.maximum(high - low, 1e-8) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        return forward(self, x)[0]


def forward(model: Model, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Outputs, with what goes into each layer and what comes out of it before its function."""
    given, sums = [model.inputs(x)], []
    for i, (w, b) in enumerate(model.layers):
        sums.append(given[-1] @ w + b)
        given.append(np.where(sums[-1] > 0, sums[-1], SLOPE * sums[-1]) if i < len(model.layers) - 1 else sigmoid(sums[-1]))
    low, high = model.out_range
    return low + given[-1] * (high - low), given, sums


def gradient(model: Model, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Of the sum of squared errors: its derivative by every weight, as one vector in the order of ``flat``, and the sum."""
    out, given, sums = forward(model, x)
    error = out - y
    low, high = model.out_range
    back = 2 * error * (high - low) * given[-1] * (1 - given[-1])
    parts: list[np.ndarray] = []
    for i in range(len(model.layers) - 1, -1, -1):
        parts = [given[i].T @ back, back.sum(0), *parts]
        if i:
            back = (back @ model.layers[i][0].T) * np.where(sums[i - 1] > 0, 1.0, SLOPE)
    return np.concatenate([p.ravel() for p in parts]), float((error**2).sum())


def flat(layers: Layers) -> np.ndarray:
    return np.concatenate([p.ravel() for layer in layers for p in layer])


def shaped(vector: np.ndarray, like: Layers) -> Layers:
    out, at = [], 0
    for w, b in like:
        out.append((vector[at : at + w.size].reshape(w.shape), vector[at + w.size : at + w.size + b.size]))
        at += w.size + b.size
    return out


def widths(inputs: int, outputs: int, hidden: int = 256, layers: int = 5) -> tuple[int, ...]:
    """Sizes of a network whose second half narrows by two a layer, to no less than its outputs."""
    sizes = [inputs, hidden]
    for i in range(layers):
        sizes.append(max(sizes[-1] // 2, outputs) if i >= layers // 2 else sizes[-1])
    return (*sizes, outputs)


def initial(sizes: tuple[int, ...], seed: int) -> Layers:
    """Weights and biases drawn evenly within one over the root of a layer's inputs."""
    rng = np.random.default_rng(seed)
    return [(rng.uniform(-1, 1, (a, b)) / a**0.5, rng.uniform(-1, 1, b) / a**0.5) for a, b in zip(sizes, sizes[1:], strict=False)]


@dataclass
class AdamW:
    """Adam with decay of the weights themselves."""

    size: int
    decay: float = 0.0
    betas: tuple[float, float] = (0.9, 0.999)
    steps: int = 0

    def __post_init__(self) -> None:
        self.mean, self.square = np.zeros(self.size), np.zeros(self.size)

    def step(self, weights: np.ndarray, slope: np.ndarray, rate: float) -> np.ndarray:
        self.steps += 1
        a, b = self.betas
        self.mean = a * self.mean + (1 - a) * slope
        self.square = b * self.square + (1 - b) * slope**2
        move = (self.mean / (1 - a**self.steps)) / (np.sqrt(self.square / (1 - b**self.steps)) + 1e-8)
        return weights * (1 - rate * self.decay) - rate * move


def summed_gradient(rows: DataFrame, model: Model) -> tuple[np.ndarray, float, int]:
    """The gradient over all rows (features, targets), the sum of squared errors and the number of rows."""
    size = flat(model.layers).size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2)
        for batch in batches:
            if batch.num_rows:
                x, y = (np.stack(batch.column(i).to_numpy(zero_copy_only=False)).astype(float) for i in (0, 1))
                slope, error = gradient(model, x, y)
                total[:-2] += slope
                total[-2:] += error, len(x)
        if total[-1]:
            starts = range(0, size + 2, BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array([total[i : i + BLOCK].tolist() for i in starts], pa.list_(pa.float64()))], names=["at", "sums"])

    def added(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": part["at"].iloc[:1], "sums": [np.sum(np.stack(part["sums"].to_numpy()), axis=0)]})

    tasks = rows.sparkSession.sparkContext.defaultParallelism
    parts = rows.select("features", "targets").coalesce(tasks).mapInArrow(run, "at long, sums array<double>")
    found = parts.groupBy("at").applyInPandas(added, "at long, sums array<double>").collect()  # as many numbers as the model has weights
    total = np.zeros(size + 2)
    for row in found:
        total[row["at"] : row["at"] + len(row["sums"])] = row["sums"]
    return total[:-2], float(total[-2]), int(total[-1])


def whole(rows: DataFrame, features: str, targets: str) -> DataFrame:
    """(features, targets) of rows in which no number is missing."""
    rows = rows.select(F.col(features).cast("array<double>").alias("features"), F.col(targets).cast("array<double>").alias("targets"))
    return rows.where(F.forall("features", finite) & F.forall("targets", finite))


def ranges(rows: DataFrame, column: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest value of each element."""
    ends = rows.agg(*(f(F.get(column, F.lit(i))).alias(f"{k}{i}") for k, f in (("lo", F.min), ("hi", F.max)) for i in range(n))).first()
    return np.array(ends[:n], float), np.array(ends[n:], float)


def errors(rows: DataFrame, model: Model, n: int) -> tuple[float, float]:
    """Mean absolute and mean squared error of the model over rows (features, targets) of n targets."""
    out = predicted(F.col("features"), model.predict)
    each = F.zip_with("out", "targets", lambda a, b: a - b)
    sums = rows.withColumn("out", out).select(F.aggregate(each, F.lit(0.0), lambda s, e: s + F.abs(e)).alias("a"), F.aggregate(each, F.lit(0.0), lambda s, e: s + e * e).alias("s"))
    got = sums.agg(F.avg("a").alias("a"), F.avg("s").alias("s")).first()
    return (float("nan"), float("nan")) if got["a"] is None else (got["a"] / n, got["s"] / n)


def trained(
    train: DataFrame, validation: DataFrame, features: str, targets: str, sizes: tuple[int, ...], epochs: int = 100, batches: int = 16, rate: float = 1e-3, halve_every: int = 30,
    decay: float = 1e-5, patience: int = 15, seed: int = 0, report: Callable[[dict], None] | None = None,
) -> Model:
    """The model of least validation error (mean absolute) among the epochs, trained by AdamW on the mean squared error.

    Rows with a missing number are left out; without any, ValueError. Rows are dealt to ``batches`` batches once, written in one folder
    each, so that a step reads its batch alone; each epoch takes them in another order. The rate halves every ``halve_every`` epochs;
    after ``patience`` epochs without a better error training ends. Without validation rows the last epoch counts.
    """
    rows, held = whole(train, features, targets), whole(validation, features, targets)
    path = shared_path(train.sparkSession, "batches")
    rows.withColumn("batch", F.floor(F.rand(seed) * batches).cast("int")).write.partitionBy("batch").parquet(path)
    dealt = train.sparkSession.read.schema("features array<double>, targets array<double>, batch int").parquet(path)
    counts = {r["batch"]: r["count"] for r in dealt.groupBy("batch").count().collect()}  # one row a batch
    if not counts:
        raise ValueError("no row to learn from")
    model = Model(initial(sizes, seed), ranges(dealt, "features", sizes[0]), ranges(dealt, "targets", sizes[-1]))
    order, moments = np.random.default_rng(seed), AdamW(flat(model.layers).size, decay)
    best, best_error, waited = model.layers, float("inf"), 0
    for epoch in range(epochs):
        now, error = rate * 0.5 ** (epoch // halve_every), 0.0
        for batch in order.permutation(sorted(counts)):
            slope, squares, n = summed_gradient(dealt.where(F.col("batch") == int(batch)), model)
            error += squares
            model.layers = shaped(moments.step(flat(model.layers), slope / (n * sizes[-1]), now), model.layers)
        mae, mse = errors(held, model, sizes[-1])
        model.history.append({"epoch": epoch, "rate": now, "train_mse": error / (sum(counts.values()) * sizes[-1]), "val_mae": mae, "val_mse": mse})
        if report:
            report(model.history[-1])
        waited = waited + 1 if mae >= best_error else 0
        if mae < best_error or np.isnan(mae):
            best, best_error = model.layers, best_error if np.isnan(mae) else mae
        if waited >= patience:
            break
    model.layers = best
    return model
