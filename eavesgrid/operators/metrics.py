"""Classification metrics as one conditional aggregation each.

Inputs are frames with ``y_true`` (class index) and ``p``: the probability of class 1 (two classes), or an array of
class probabilities.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import argmax_class, threshold_class

EPSILON = 1e-7  # Fixed value: guard of the denominators and clip of the probabilities.


def predicted(n_classes: int, p: Column | None = None) -> Column:
    p = F.col("p") if p is None else p
    return threshold_class(p) if n_classes == 2 else argmax_class(p)


def _counts(class_id: int) -> tuple[Column, Column, Column]:
    true, pred = F.col("y_true") == class_id, F.col("y_pred") == class_id
    one = lambda cond: F.sum(F.when(cond, 1.0).otherwise(0.0))
    return one(true & pred), one(pred), one(true)


def precision(class_id: int) -> Column:
    hits, pred, _ = _counts(class_id)
    return hits / (pred + F.lit(EPSILON))


def recall(class_id: int) -> Column:
    hits, _, true = _counts(class_id)
    return hits / (true + F.lit(EPSILON))


def cross_entropy(n_classes: int) -> Column:
    """Mean -ln of the clipped probability of the true class."""
    lo, hi = F.lit(EPSILON), F.lit(1 - EPSILON)
    if n_classes == 2:
        p = F.least(F.greatest(F.col("p"), lo), hi)
        return F.avg(-F.when(F.col("y_true") == 1, F.ln(p)).otherwise(F.ln(1 - p)))
    p = F.element_at("p", F.col("y_true").cast("int") + 1)
    return F.avg(-F.ln(F.least(F.greatest(p, lo), hi)))


def _per_class(df: DataFrame, class_names: Sequence[str], build, name: str, batch: str | None) -> DataFrame:
    """``class_name, <name>``: over all rows, or averaged over batches when a batch column is given."""
    labelled = df.withColumn("y_pred", predicted(len(class_names)))
    aggs = [build(i).alias(f"c{i}") for i in range(len(class_names))]
    if batch is None:
        wide = labelled.agg(*aggs)
    else:
        wide = labelled.groupBy(batch).agg(*aggs).agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(class_names))])
    pairs = [F.struct(F.lit(n).alias("class_name"), F.col(f"c{i}").alias(name)) for i, n in enumerate(class_names)]
    return wide.select(F.inline(F.array(*pairs)))


def precision_by_class(df: DataFrame, class_names: Sequence[str], batch: str | None = None) -> DataFrame:
    return _per_class(df, class_names, precision, "precision", batch)


def recall_by_class(df: DataFrame, class_names: Sequence[str], batch: str | None = None) -> DataFrame:
    return _per_class(df, class_names, recall, "recall", batch)


def log_loss(df: DataFrame, n_classes: int) -> DataFrame:
    return df.agg(cross_entropy(n_classes).alias("log_loss"))


def evaluate(df: DataFrame, class_names: Sequence[str]) -> DataFrame:
    """``metric, value``: the loss, then precision and recall of every class, from a single pass."""
    n = len(class_names)
    named = [("loss", cross_entropy(n))]
    named += [(f"Precision (class: {c})", precision(i)) for i, c in enumerate(class_names)]
    named += [(f"Recall (class: {c})", recall(i)) for i, c in enumerate(class_names)]
    wide = df.withColumn("y_pred", predicted(n)).agg(*[col.alias(f"m{i}") for i, (_, col) in enumerate(named)])
    rows = [F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("value")) for i, (name, _) in enumerate(named)]
    return wide.select(F.inline(F.array(*rows)))


def confusion_matrix(df: DataFrame, n_classes: int) -> DataFrame:
    return (
        df.withColumn("y_pred", predicted(n_classes)).groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))
    )
