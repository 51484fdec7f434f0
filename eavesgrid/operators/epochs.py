"""Training by epochs and mini-batches: a softmax layer on feature vectors, with a rate schedule, weights kept per epoch, and resuming.

The rows are dealt out to fixed parts by their key, ordered, and written once.  In every epoch a number counted off the key and the epoch
deals them to mini-batches.  A step is one job: each part adds up its gradient in Arrow batches, the parts' sums are added in a fixed tree of
nodes, and the driver gets the sums of the last level, at most ``FAN`` rows of the weights' size.  So a run gives the same numbers
however its tasks are scheduled, and one that is resumed the same as one that never stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import counted_uniform
from ..session import cut, ship_package

FAN = 16
PARTIAL = "part int, grad array<double>, loss double, n long"


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    """Feature lists of equal length as rows, with a constant 1 behind."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.column_stack([flat.reshape(len(column), -1), np.ones(len(column))])


def _gradients(batch: DataFrame, weights: np.ndarray) -> DataFrame:
    """One row for each task: sums of the gradient and of the cross-entropy, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grad, loss, n = np.zeros_like(weights), 0.0, 0
        for rows in batches:
            if rows.num_rows:
                x, y = _matrix(rows.column("x")), rows.column("y").to_numpy()
                p = softmax(x @ weights.T)
                loss -= float(np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum())
                p[np.arange(len(y)), y] -= 1
                grad += p.T @ x
                n += len(y)
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "grad": [grad.ravel().tolist()], "loss": [loss], "n": [n]})

    return batch.select("x", "y").mapInArrow(run, PARTIAL)


def _added(rows: Column) -> list[Column]:
    """Sums over an ordered array of (part, grad, loss, n)."""
    rest, first = F.slice(rows, F.lit(2), F.size(rows) - 1), rows[0]
    grad = F.aggregate(rest, first["grad"], lambda a, r: F.zip_with(a, r["grad"], lambda x, y: x + y))
    loss = F.aggregate(rest, first["loss"], lambda a, r: a + r["loss"])
    n = F.aggregate(rest, first["n"], lambda a, r: a + r["n"])
    return [grad.alias("grad"), loss.alias("loss"), n.alias("n")]


def _total(partial: DataFrame, parts: int) -> tuple[np.ndarray, float, int]:
    """The sum over all parts, up a tree whose nodes have ``FAN`` children each."""
    while parts > FAN:
        node = F.floor(F.col("part") / FAN).cast("int")
        rows = partial.groupBy(node.alias("part")).agg(F.array_sort(F.collect_list(F.struct("part", "grad", "loss", "n"))).alias("rows"))
        partial, parts = rows.select("part", *_added(F.col("rows"))), -(-parts // FAN)
    top = sorted(partial.collect())  # at most FAN rows
    grad = np.zeros(len(top[0]["grad"]))
    for row in top:
        grad += np.array(row["grad"])
    return grad, sum(r["loss"] for r in top), sum(r["n"] for r in top)


def train_by_epochs(
    rows: DataFrame,
    key: str,
    path: str,
    n_classes: int,
    epochs: int,
    batches: int = 1,
    rate: Callable[[int], float] = lambda epoch: 0.1,
    initial_epoch: int = 0,
    features: str = "features",
    label: str = "label",
    parts: int = 64,
) -> DataFrame:
    """Fit on ``features`` (arrays of one length) and ``label`` (class index); returns what stands below ``path``.

    That is ``epoch, rate, loss, n, weights`` for every epoch: the mean cross-entropy before each step, and the weights after the last, a row of
    features and a constant for each class.  ``rate(epoch)`` is the schedule.  With ``initial_epoch`` training goes on from the weights
    that epoch ``initial_epoch - 1`` left there; later epochs are written over.  Rows without a label or features are left out.
    """
    if not 0 <= initial_epoch <= epochs:
        raise ValueError(f"initial_epoch must be between 0 and {epochs}, got {initial_epoch}")
    spark = rows.sparkSession
    ship_package(spark)
    usable = rows.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("key"), F.col(features).cast("array<double>").alias("x"), F.col(label).cast("int").alias("y")
    )
    dealt = usable.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    data = cut(dealt.repartition(parts, "part").sortWithinPartitions("part", "key", "y", "x"))
    width = data.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if width[0] is None or width[0] != width[1]:
        raise ValueError("features must be there and of one length")
    weights = np.zeros((n_classes, width[0] + 1))
    if initial_epoch:
        weights = np.array(spark.read.parquet(f"{path}/epoch={initial_epoch - 1}").first()["weights"]).reshape(weights.shape)
    for epoch in range(initial_epoch, epochs):
        turned = data.withColumn("turn", F.floor(counted_uniform(F.col("key"), epoch) * batches).cast("int"))
        loss, seen = 0.0, 0
        for turn in range(batches):
            grad, cost, n = _total(_gradients(turned.where(F.col("turn") == turn), weights), data.rdd.getNumPartitions())
            if n:
                weights = weights - rate(epoch) * grad.reshape(weights.shape) / n
                loss, seen = loss + cost, seen + n
        row = (float(rate(epoch)), loss / max(seen, 1), seen, weights.ravel().tolist())
        spark.createDataFrame([row], "rate double, loss double, n long, weights array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    kept = [f"{path}/epoch={e}" for e in range(epochs)]
    return spark.read.option("basePath", path).parquet(*kept).select("epoch", "rate", "loss", "n", "weights")


def predict(rows: DataFrame, weights: list[float], n_classes: int, features: str = "features") -> DataFrame:
    """Adds ``probs``: the probabilities of the classes, NULL without features."""
    table = np.array(weights).reshape(n_classes, -1).tolist()
    scores = []
    for own in table:
        terms = F.zip_with(F.col(features).cast("array<double>"), F.lit(own[:-1]), lambda x, w: x * w)
        scores.append(F.aggregate(terms, F.lit(float(own[-1])), lambda a, v: a + v))
    highest = F.greatest(*scores)
    raised = [F.exp(s - highest) for s in scores]
    total = sum(raised[1:], raised[0])
    return rows.withColumn("probs", F.when(F.col(features).isNotNull(), F.array(*[e / total for e in raised])))
