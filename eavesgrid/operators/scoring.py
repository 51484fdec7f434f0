"""Scoring images with a user's model and turning probabilities into the scores table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import (
    argmax_class,
    class_name,
    keep_plain_names,
    path_stem,
    round7,
    softmax_score,
    threshold_class,
)
from ..session import ship_package
from .images import COLOR_CHANNELS, map_images, preparer, share_sample
from .tiles import MAX_ATTEMPTS, fetch_tiles, tile_grid

BATCH_SIZE = 32


def predict_probabilities(
    images: DataFrame, make_predict_fn: Callable, n_classes: int, tensor: str = "tensor", batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Adds ``probs``: what the model gives for each prepared image, the path travelling along with its row.

    ``make_predict_fn`` loads the model once per worker and returns a function from a (batch, n_values) float array
    to a (batch, n) array; n is 1 for two classes (probability of class 1), else the number of classes.
    """
    ship_package(images.sparkSession)
    n_out = 1 if n_classes == 2 else n_classes
    score = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    probs = F.slice(score(F.col(tensor)), 1, n_out)
    return images.withColumn("probs", F.when(F.col(tensor).isNotNull(), probs))


def postprocess(
    scored: DataFrame,
    class_names: Sequence[str],
    name: Column | None = None,
    double_softmax: bool = False,
    drop_suffixed: bool | Column | None = None,
    keep: Sequence[str] = ("path",),
) -> DataFrame:
    """``building_name, score, predicted_class`` from ``probs``, and the columns to ``keep`` as far as there are any.

    Two classes: one probability, class 1 strictly above 0.5, the score is the probability itself.  More classes:
    largest probability, first class on a tie.  An image without probabilities has a NULL score and class.

    Rows with a ``suffix`` column stay where it is 0, others all stay.  ``drop_suffixed`` True goes by the name instead
    and drops suffixed names and names with a dot; False keeps all rows; a boolean column says which rows stay.
    """
    binary = len(class_names) == 2
    best = threshold_class(F.col("probs")[0]) if binary else argmax_class(F.col("probs"))
    score = round7(F.col("probs")[0]) if binary else softmax_score(F.col("probs"), double_softmax)
    name = path_stem(F.col("path")) if name is None else name
    named = scored.withColumn("building_name", name)
    if drop_suffixed is None and "suffix" in named.columns:
        drop_suffixed = F.col("suffix") == 0
    if isinstance(drop_suffixed, Column):
        named = named.where(drop_suffixed)
    elif drop_suffixed:
        named = named.where(keep_plain_names(F.col("building_name")))
    return named.select(
        "building_name", score.alias("score"), class_name(best, class_names).alias("predicted_class"),
        *[c for c in keep if c in scored.columns],
    )


def score_images(
    images: DataFrame,
    make_predict_fn: Callable,
    class_names: Sequence[str],
    img_size: tuple[int, int] = (250, 250),
    color_mode: str = "rgb",
    share: float = 1.0,
    name: Column | None = None,
    double_softmax: bool = False,
    drop_suffixed: bool | Column | None = None,
    batch_size: int = BATCH_SIZE,
    keep: Sequence[str] = ("path",),
) -> DataFrame:
    """Prepare, predict, post-process.  The model gets raw tensor bytes per image (see ``bytes_model``).

    With ``keep=("path", "data", ...)`` the images travel along and can be written by class without a join.
    """
    if color_mode not in COLOR_CHANNELS:
        raise ValueError(f"color_mode must be one of {sorted(COLOR_CHANNELS)}")
    chosen = share_sample(images, share)
    prepare, n_out = preparer(img_size, color_mode), 1 if len(class_names) == 2 else len(class_names)

    def start():
        # Preparing and predicting in one hop: tensors never leave the worker, only probabilities do.
        predict = make_predict_fn()

        def convert(rows):
            tensors = [prepare(*row) for row in rows]
            found = np.asarray(predict(tensors), dtype=np.float64).reshape(len(rows), -1)
            probs = [None if t is None else p[:n_out].tolist() for t, p in zip(tensors, found, strict=True)]
            return pa.array(probs, pa.list_(pa.float64()))

        return convert

    needed = {"path", "suffix", *keep} if name is None and not isinstance(drop_suffixed, Column) else set(chosen.columns)
    probs = map_images(chosen, [c for c in chosen.columns if c in needed], "probs array<double>", start, batch_size)
    return postprocess(probs, class_names, name, double_softmax, drop_suffixed, keep)


def score_areas(
    boxes: DataFrame,
    fetch: Callable[[DataFrame, int], DataFrame],
    path: str,
    make_predict_fn: Callable,
    class_names: Sequence[str],
    img_size: tuple[int, int] = (250, 250),
    color_mode: str = "rgb",
    max_attempts: int = MAX_ATTEMPTS,
) -> tuple[DataFrame, DataFrame]:
    """Areas to scores: lay the tile grid, fetch its images with retries (see ``fetch_tiles``), prepare, predict, post-process.

    Returns the scores with ``box_id, tile_name, attempt`` beside them, and the tiles that never came.
    """
    grid = tile_grid(boxes)
    arrived, failed = fetch_tiles(grid, fetch, path, max_attempts)
    if arrived is None:
        nothing = "building_name string, score double, predicted_class string, box_id long, tile_name string, attempt int"
        return boxes.sparkSession.createDataFrame([], nothing), failed
    named = arrived.withColumn("path", F.concat(F.lit("images/"), F.col("box_id").cast("string"), F.lit("-"), "tile_name", F.lit(".jpg")))
    kept = ("box_id", "tile_name", "attempt")
    # tiles of a grid carry no suffix, whatever their names look like
    return score_images(named, make_predict_fn, class_names, img_size, color_mode, drop_suffixed=False, keep=kept), failed


def _on_present(batch, run: Callable):
    """``run`` on the rows that are there; the others get NaN, which ``predict_probabilities`` turns into NULL."""
    there = [i for i, b in enumerate(batch) if b is not None]
    if not there:
        return np.full((len(batch), 1), np.nan)
    found = np.asarray(run([batch[i] for i in there]), dtype=np.float64)
    out = np.full((len(batch), *found.shape[1:]), np.nan)
    out[there] = found
    return out


def bytes_model(model: Callable) -> Callable:
    """Wrap ``model(batch of (n, n_values) float arrays) -> (n, k)`` for tensors that arrive as bytes."""

    def make():
        def predict(batch):
            return _on_present(batch, lambda rows: model(np.stack([np.frombuffer(b, np.uint8) for b in rows]).astype(np.float64)))

        return predict

    return make


def onnx_model(model_bytes: bytes) -> Callable:
    """``make_predict_fn`` for an ONNX model whose first input takes (n, n_values) floats."""

    def make():
        import onnxruntime

        session = onnxruntime.InferenceSession(model_bytes)
        feed = session.get_inputs()[0].name

        def predict(batch):
            def run(rows):
                return session.run(None, {feed: np.stack([np.frombuffer(b, np.uint8) for b in rows]).astype(np.float32)})[0]

            return _on_present(batch, run)

        return predict

    return make


def route_by_class(scores: DataFrame, images: DataFrame) -> DataFrame:
    """Scored images with their class, to be written partitioned by ``predicted_class``.

    Images are found by path where both sides have it: names repeat across folders, paths don't.
    """
    key = "path" if "path" in scores.columns and "path" in images.columns else "building_name"
    wanted = [c for c in ("building_name", "predicted_class") if c != key]
    return scores.select(key, *wanted).join(images.drop(*wanted), key)


def formatted_scores(scores: DataFrame) -> DataFrame:
    """The scores table as it goes to CSV: seven decimals."""
    return scores.select(
        F.col("building_name").alias("Building name"),
        F.format_string("%.7f", "score").alias("Score"),
        F.col("predicted_class").alias("Predicted class"),
    )
