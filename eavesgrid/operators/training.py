"""A classifier trained with cross-entropy on feature vectors, and its evaluation.

Two classes give a sigmoid output, more a softmax: binomial or multinomial logistic regression of ``pyspark.ml``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

DEFAULT_CLASSES = ("no_PV", "PV")  # Fixed values: default class names.
DEFAULT_SIZE = (250, 250)  # Fixed value: default image size.


@dataclass(frozen=True)
class ModelInfo:
    """What has to be kept beside the weights: name, image size, classes in index order."""

    name: str
    img_size: tuple[int, int] = DEFAULT_SIZE
    class_names: tuple[str, ...] = DEFAULT_CLASSES

    @property
    def mode(self) -> str:
        return "BINARY" if len(self.class_names) == 2 else "CATEGORICAL"

    @property
    def class_index(self) -> dict[str, int]:
        return {c: i for i, c in enumerate(self.class_names)}


def train_classifier(
    rows: DataFrame, info: ModelInfo, features: str = "features", label: str = "label", max_iter: int = 50, reg: float = 0.01
) -> PipelineModel:
    """Fit on ``features`` (array of numbers) and ``label`` (class index)."""
    family = "binomial" if info.mode == "BINARY" else "multinomial"
    data = rows.select(array_to_vector(F.col(features).cast("array<double>")).alias("features"), F.col(label).cast("double").alias("label"))
    model = LogisticRegression(family=family, maxIter=max_iter, regParam=reg).fit(data)
    # A freshly fitted model drags its training summary, and with it the session, into every task that predicts.  Saved
    # and loaded, it holds the weights alone.
    path = scratch_path(rows.sparkSession, "fitted")
    model.save(path)
    return PipelineModel(stages=[LogisticRegressionModel.load(path)])


def predict_classifier(model: PipelineModel, rows: DataFrame, info: ModelInfo, features: str = "features") -> DataFrame:
    """Adds ``p``: the probability of class 1, or the array of class probabilities."""
    vectors = rows.withColumn("_v", array_to_vector(F.col(features).cast("array<double>")))
    stage = model.stages[-1].copy()
    stage.setFeaturesCol("_v")
    probs: Column = vector_to_array(F.col("probability"))
    out = probs[1] if info.mode == "BINARY" else probs
    return stage.transform(vectors).withColumn("p", out).drop("_v", "rawPrediction", "probability", "prediction")
