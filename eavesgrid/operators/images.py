"""Labelled image tables: listing, labels, splits and pixel preparation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import class_index, counted_uniform, encode_label, seeded_fraction
from ..session import ship_package
from .indexing import with_row_index
from .preprocessing import require_columns

IMAGE_EXTENSIONS = ("bmp", "gif", "jpeg", "jpg", "png")  # Fixed values: image file extensions.
COLOR_CHANNELS = {"grayscale": 1, "rgb": 3, "rgba": 4}

# ---------------------------------------------------------------- listing and labels


def image_paths(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Rows whose path has an image extension, in any case."""
    return paths.where(F.lower(F.regexp_extract(path_col, r"\.([^./]+)$", 1)).isin(*IMAGE_EXTENSIONS))


def class_of(path: Column) -> Column:
    """Name of the folder a file lies in."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def inferred_class_names(paths: DataFrame, path_col: str = "path") -> list[str]:
    """The class folders in alphanumeric order: one short name per class comes to the driver."""
    rows = image_paths(paths, path_col).select(class_of(F.col(path_col)).alias("c")).distinct().collect()
    return sorted(r["c"] for r in rows if r["c"])


def index_images(
    paths: DataFrame, label_mode: str | None = "int", class_names: Sequence[str] | None = None, path_col: str = "path"
) -> DataFrame:
    """Images with ``class_name``, ``label_idx`` and ``label``, classes taken from their folders.

    ``class_names`` fixes the classes and their order; images of other folders stay, with NULL labels.
    ``label_mode=None`` gives the images alone.
    """
    images = image_paths(paths, path_col)
    if label_mode is None:
        return images
    if label_mode not in ("int", "binary", "categorical"):
        raise ValueError(f"label mode must be int, binary, categorical or None, got {label_mode!r}")
    names = list(class_names) if class_names else inferred_class_names(paths, path_col)
    named = images.withColumn("class_name", class_of(F.col(path_col)))
    named = named.withColumn("label_idx", class_index(F.col("class_name"), names))
    return named.withColumn("label", encode_label(F.col("label_idx"), label_mode, names))


def image_labels_list(
    images: DataFrame, labels: DataFrame | None, path_col: str = "path", class_names: Sequence[str] | None = None
) -> DataFrame:
    """Labels from a keyed table instead of the folders; ``labels=None`` gives unlabelled images.

    An image without a label is an error of the input and shows as NULL.
    """
    if class_names:
        raise ValueError("class_names only go with labels inferred from the folders")
    listed = image_paths(images, path_col)
    if labels is None:
        return listed
    require_columns(labels, path_col, "label")
    return listed.join(labels.select(path_col, "label"), path_col, "left")


def require_images(images: DataFrame) -> DataFrame:
    if images.isEmpty():
        raise ValueError(f"no images found, allowed extensions: {', '.join(IMAGE_EXTENSIONS)}")
    return images


# ---------------------------------------------------------------- order, samples, splits


def sorted_paths(images: DataFrame, path_col: str = "path") -> DataFrame:
    return images.orderBy(path_col)


def share_sample(images: DataFrame, share: float = 1.0, path_col: str = "path") -> DataFrame:
    """The last ``floor(share * n)`` images in path order; ``share`` in (0, 1], 1 keeps all.

    Only the paths are sorted; the first path to keep comes back as one value, so the images themselves are read
    with a plain filter.
    """
    if not 0 < share <= 1:
        raise ValueError(f"a share lies above 0 and is 1 at most; this one is {share}")
    if share == 1:
        return images
    indexed, total = with_row_index(images.select(path_col), [path_col], "_rank")
    keep = int(share * total)
    if keep == 0:
        return images.limit(0)
    first = indexed.where(F.col("_rank") == total - keep).first()[path_col]
    return images.where(F.col(path_col) >= first)


def check_share(name: str, share: float) -> None:
    if not 0 < share < 1:
        raise ValueError(f"{name} lies between 0 and 1, both excluded; it is {share}")


def split_rank(images: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Adds ``fraction`` in [0, 1), the place of a row in a seeded shuffle."""
    return images.withColumn("fraction", seeded_fraction(F.col(key), seed))


def train_val_split(
    images: DataFrame,
    key: str,
    training_share: float,
    validation_share: float,
    seed: int = 42,
    validation_images: DataFrame | None = None,
) -> DataFrame:
    """Adds ``split`` = train or validation; rows in neither share are left out.

    One table is cut into disjoint shares: fractions below ``training_share``, then the next ``validation_share``.
    With ``validation_images`` each table gives its own share.
    """
    check_share("training_share", training_share)
    check_share("validation_share", validation_share)
    ranked = split_rank(images, key, seed)
    train = F.col("fraction") < training_share
    if validation_images is None:
        if training_share + validation_share > 1:
            raise ValueError("the shares of one table must not add up to more than 1")
        # 0.8 + 0.2 must reach 1 whatever the rounding of the sum is.
        end = min(1.0, round(training_share + validation_share, 12))
        split = F.when(train, "train").when(F.col("fraction") < end, "validation")
        return ranked.withColumn("split", split).where(F.col("split").isNotNull())
    other = split_rank(validation_images, key, seed).where(F.col("fraction") < validation_share)
    return ranked.where(train).withColumn("split", F.lit("train")).unionByName(other.withColumn("split", F.lit("validation")))


def exact_split(images: DataFrame, key: str, training_share: float, validation_share: float, seed: int = 42) -> DataFrame:
    """Like ``train_val_split`` with exact counts, by position in the seeded shuffle."""
    check_share("training_share", training_share)
    check_share("validation_share", validation_share)
    if training_share + validation_share > 1:
        raise ValueError("the shares of one table must not add up to more than 1")
    ranked = split_rank(images, key, seed)
    indexed, total = with_row_index(ranked.select("fraction", key), ["fraction", key], "_rank")
    n_train = int(round(training_share * total, 9))
    ends = [n_train, n_train + int(round(validation_share * total, 9))]
    found = {r["_rank"]: r for r in indexed.where(F.col("_rank").isin(ends)).collect()}  # two rows at most

    def before(rank: int) -> Column:
        edge = found.get(rank)  # none when the share reaches the last row
        if edge is None:
            return F.lit(True)
        same = F.col("fraction") == edge["fraction"]
        return (F.col("fraction") < edge["fraction"]) | (same & (F.col(key) < edge[key]))

    split = F.when(before(ends[0]), "train").when(before(ends[1]), "validation")
    return ranked.withColumn("split", split).where(F.col("split").isNotNull())


def split_disjoint(split: DataFrame, key: str) -> DataFrame:
    """One row ``n_train, n_validation, n_both``: keys on each side and on both."""
    sides = split.groupBy(key).agg(
        F.max((F.col("split") == "train").cast("int")).alias("t"),
        F.max((F.col("split") == "validation").cast("int")).alias("v"),
    )
    return sides.agg(
        F.coalesce(F.sum("t"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("v"), F.lit(0)).alias("n_validation"),
        F.coalesce(F.sum(F.col("t") * F.col("v")), F.lit(0)).alias("n_both"),
    )


# ---------------------------------------------------------------- pixels


def to_channels(img: np.ndarray, channels: int) -> np.ndarray:
    """(h, w, c) to 1, 3 or 4 channels: grey by ITU-R 601 luma, grey repeated to colour, opaque alpha added."""
    have = img.shape[2]
    if have == channels:
        return img
    if channels == 1:
        if have == 2:
            return img[:, :, :1]
        luma = img[:, :, 0] * 0.299 + img[:, :, 1] * 0.587 + img[:, :, 2] * 0.114
        return np.rint(luma)[:, :, None].astype(np.uint8)
    color = img[:, :, :3] if have >= 3 else np.repeat(img[:, :, :1], 3, axis=2)
    if channels == 3:
        return color
    alpha = img[:, :, 1:2] if have == 2 else np.full((*img.shape[:2], 1), 255, np.uint8)
    return np.concatenate([color, alpha], axis=2)


def crop_or_pad(img: np.ndarray, height: int, width: int) -> np.ndarray:
    """Central crop of what is too large, zero padding around what is too small."""
    h, w, c = img.shape
    top, left = max((h - height) // 2, 0), max((w - width) // 2, 0)
    img = img[top:top + height, left:left + width]
    out = np.zeros((height, width, c), img.dtype)
    y, x = max((height - h) // 2, 0), max((width - w) // 2, 0)
    out[y:y + img.shape[0], x:x + img.shape[1]] = img
    return out


BRIGHTNESS, CONTRAST = 0.125, 0.875  # Fixed values: ranges of the random brightness and contrast.


def augment(img: np.ndarray, for_brightness: float, for_contrast: float) -> np.ndarray:
    """Random brightness (a shift of up to 12.5 % of 255) and contrast around the channel means, from two numbers in [0, 1)."""
    shift = (2 * for_brightness - 1) * BRIGHTNESS * 255.0
    bright = np.clip(img.astype(np.float64) + shift, 0, 255)
    mean = bright.mean(axis=(0, 1), keepdims=True) if img.size else 0.0
    factor = 1 - CONTRAST + 2 * CONTRAST * for_contrast
    return np.rint(np.clip((bright - mean) * factor + mean, 0, 255)).astype(np.uint8)


BATCH_BYTES = 64 << 20  # Arrow batches of tensors end at this size: one binary array holds 2 GiB at most.


def preparer(img_size: tuple[int, int], color_mode: str, bgr: bool = False, transform=None):
    """A function (height, width, channels, raw bytes, two random numbers or None) -> tensor bytes, None for no bytes."""
    if color_mode not in COLOR_CHANNELS:
        raise ValueError(f"color_mode must be one of {sorted(COLOR_CHANNELS)}, got {color_mode!r}")
    (height, width), channels = img_size, COLOR_CHANNELS[color_mode]

    def prepare(h, w, c, raw, random):
        if raw is None:
            return None
        img = np.frombuffer(raw, np.uint8).reshape(h, w, c)
        if bgr and c >= 3:
            img = img[:, :, [2, 1, 0, *range(3, c)]]
        if transform is not None:
            img = transform(img)
        img = crop_or_pad(to_channels(img, channels), height, width)
        return (img if random is None else augment(img, *random)).tobytes()

    return prepare


def map_images(images: DataFrame, kept: Sequence[str], made: str, start, per_batch: int, random: Column | None = None) -> DataFrame:
    """``kept`` columns and one made in Python, in bounded batches.

    ``made`` is the new column's definition.  ``start()`` runs once per task and returns a function from a list of
    ``(height, width, n_channels, data, random)`` to an Arrow array; it is given at most ``per_batch`` images at a time.
    """
    require_columns(images, "height", "width", "n_channels", "data")
    ship_package(images.sparkSession)
    name = made.split(" ")[0]
    kept = [c for c in kept if c != name]
    fields = ", ".join(f"`{c}` {images.schema[c].dataType.simpleString()}" for c in kept)
    inputs = [F.col(c).alias(f"_in_{c}") for c in ("height", "width", "n_channels", "data")]
    inputs.append((F.lit(None).cast("array<double>") if random is None else random).alias("_in_random"))

    def run(batches):
        convert = start()
        for batch in batches:
            for at in range(0, batch.num_rows, per_batch):
                part = batch.slice(at, per_batch)
                rows = list(zip(*(part.column(f"_in_{c}").to_pylist() for c in ("height", "width", "n_channels", "data", "random")), strict=True))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), convert(rows)], names=[*kept, name])

    return images.select(*kept, *inputs).mapInArrow(run, f"{fields}, {made}" if kept else made)


def prepare_images(
    images: DataFrame,
    img_size: tuple[int, int] = (250, 250),
    color_mode: str = "rgb",
    augment_key: Column | None = None,
    bgr: bool = False,
    transform=None,
) -> DataFrame:
    """Adds ``tensor``: the image as height x width x channels bytes of one fixed size.

    Input columns ``height, width, n_channels, data`` (pixels row by row, bands interleaved; ``bgr`` for the order
    of Spark's image source).  ``augment_key`` turns on random brightness and contrast, by numbers counted off the
    key (``counted_uniform``), so results do not hang on partitioning and SQL can repeat them.  ``transform`` is a function (h, w, c) array -> array applied
    before colours and size are fixed.
    """
    prepare = preparer(img_size, color_mode, bgr, transform)

    def start():
        return lambda rows: pa.array([prepare(*row) for row in rows], type=pa.binary())

    per_batch = max(1, BATCH_BYTES // (img_size[0] * img_size[1] * COLOR_CHANNELS[color_mode]))
    random = None if augment_key is None else F.array(counted_uniform(augment_key, 0), counted_uniform(augment_key, 1))
    return map_images(images, images.columns, "tensor binary", start, per_batch, random)


def prepare_fit_images(
    images: DataFrame, key: str, training_share: float, validation_share: float, epoch: int = 0,
    img_size: tuple[int, int] = (250, 250), color_mode: str = "rgb", data_augmentation: bool = True, seed: int = 42,
) -> DataFrame:
    """Split and prepared images of one epoch, ready to be written partitioned by split and class."""
    split = train_val_split(images, key, training_share, validation_share, seed)
    augment_key = F.concat_ws("#", F.col(key), F.lit(str(epoch))) if data_augmentation else None
    return prepare_images(split, img_size, color_mode, augment_key)
