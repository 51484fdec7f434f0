"""Reading image folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.images import IMAGE_EXTENSIONS, index_images


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """``path, content`` of every file below the folder; the content is read only where it is used."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "content")
    )


def scan_image_folder(
    spark: SparkSession, folder: str, label_mode: str | None = "int", class_names: Sequence[str] | None = None
) -> DataFrame:
    """Decoded images ``path, height, width, n_channels, data, error`` with labels from their folders.

    A file that can't be decoded stays, with ``error`` and NULL in place of size and pixels.

    Decoding runs in Spark's image source, which gives colour images in blue-green-red order (``bgr=True`` for
    ``prepare_images``).  Files of other extensions are not read.
    """
    pattern = "*.{" + ",".join(e for x in IMAGE_EXTENSIONS for e in (x, x.upper())) + "}"
    df = (
        spark.read.format("image")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("dropInvalid", False)
        .load(folder)
    )
    readable = F.coalesce(F.col("image.height") > 0, F.lit(False))
    parts = (("height", "height"), ("width", "width"), ("nChannels", "n_channels"), ("data", "data"))
    flat = df.select(
        F.col("image.origin").alias("path"),
        *[F.when(readable, F.col(f"image.{c}")).alias(name) for c, name in parts],
        F.when(~readable, "not a readable image").alias("error"),
    )
    return index_images(flat, label_mode, class_names)


def scan_prediction_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Unlabelled images of ``<folder>/images``, as scoring expects them."""
    path = f"{folder.rstrip('/')}/images"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        raise FileNotFoundError(f"{folder} must have a sub-folder 'images'")
    return scan_image_folder(spark, path, label_mode=None)
