"""Writing layers, attributes, manifests, scores and models.  Output paths are folders, as Spark writes them."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import BBOX, to_wkt
from ..operators.crops import crop_manifest
from ..operators.scoring import formatted_scores, route_by_class
from ..operators.training import ModelInfo
from ..sources.layers import finish_layer, read_layer, srid_of


CELL_SIDE = 4096.0  # metres; the files of a layer are ranges of such cells
FILES_PER_RASTER = 4


def write_attributes(layer: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The attribute table alone, as CSV with a header; the path ends in ``csv``."""
    if not path.endswith("csv"):
        raise AttributeError("the path of an attribute table must end in 'csv'")
    layer.drop("geom", "is_box", *BBOX).write.mode(mode).option("header", True).csv(path)


def write_layer(layer: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Attributes and geometry: Parquet with the bbox columns, or CSV with a ``wkt`` column.

    The Parquet files hold ranges of grid cells, their rows in order of the cells, so that bbox filters skip files and
    row groups.
    """
    if fmt == "parquet":
        cells = [F.floor(F.col(c) / CELL_SIDE) for c in ("xmin", "ymin")]
        ranged = layer.repartitionByRange(*cells).sortWithinPartitions(*cells, "xmin", "ymin")
        ranged.write.mode(mode).parquet(path)
    elif fmt == "csv":
        text = layer.withColumn("wkt", to_wkt(F.col("geom"))).drop("geom", "is_box", *BBOX)
        text.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError(f"layers are written as parquet or csv, got {fmt!r}")


def read_back(spark: SparkSession, path: str, layer: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Read what ``write_layer`` wrote, with the coordinate system of ``layer``."""
    if fmt == "parquet":
        return finish_layer(spark.read.parquet(path), srid_of(layer))
    attributes = [f for f in layer.schema.fields if f.name not in ("geom", "is_box", *BBOX)]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in attributes)
    return read_layer(spark, path, f"{ddl}, wkt string", "csv", "wkt", srid_of(layer)).drop("_corrupt_record")


def write_crop_manifest(named: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One sub-folder per raster with ``Suffixed file name, File name``."""
    out = crop_manifest(named).select(
        "raster_id", F.col("suffixed_name").alias("Suffixed file name"), F.col("file_name").alias("File name")
    )
    spread = F.pmod(F.xxhash64("Suffixed file name"), F.lit(FILES_PER_RASTER))
    out.repartition("raster_id", spread).write.mode(mode).partitionBy("raster_id").option("header", True).csv(path)


def write_scores(scores: DataFrame, path: str, mode: str = "errorifexists") -> None:
    formatted_scores(scores).write.mode(mode).option("header", True).csv(path)


def write_images_by_class(scores: DataFrame, images: DataFrame, path: str, mode: str = "errorifexists") -> None:
    route_by_class(scores, images).write.mode(mode).partitionBy("predicted_class").parquet(path)


def export_prediction(
    scores: DataFrame, path: str, images: DataFrame | None = None, save_scores: bool = True, mode: str = "errorifexists"
) -> None:
    """Scores, images by class, or both; asking for neither is an error."""
    if not save_scores and images is None:
        raise ValueError("neither scores nor images are to be saved")
    if save_scores:
        write_scores(scores, f"{path}/scores.csv", mode)
    if images is not None:
        write_images_by_class(scores, images, f"{path}/images", mode)


def write_raster_tiles(tiles: DataFrame, table: str, buckets: int) -> None:
    """Tiles as a table bucketed on the join key, so that cutting crops never shuffles pixels."""
    tiles.write.bucketBy(buckets, "raster_id", "tile_row", "tile_col").sortBy("raster_id", "tile_row", "tile_col").saveAsTable(table)


# ---------------------------------------------------------------- models


def save_model(spark: SparkSession, model: PipelineModel, info: ModelInfo, path: str) -> None:
    """The fitted pipeline and a JSON row with name, image size and class names."""
    model.write().overwrite().save(f"{path}/{info.name}.model")
    row = json.dumps({"name": info.name, "img_size": list(info.img_size), "class_names": list(info.class_names)})
    spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{info.name}.metadata")


def load_metadata(spark: SparkSession, path: str) -> ModelInfo:
    """Metadata written by ``save_model``; anything else raises ``ValueError``."""
    rows = spark.read.text(path).limit(2).collect()
    try:
        (row,) = rows
        data = json.loads(row["value"])
        return ModelInfo(data["name"], tuple(data["img_size"]), tuple(data["class_names"]))
    except (ValueError, KeyError, TypeError) as error:
        raise ValueError(f"{path} is not model metadata written by save_model") from error


def load_model(spark: SparkSession, metadata_path: str, model_path: str) -> tuple[PipelineModel, ModelInfo]:
    if not model_path.rstrip("/").endswith(".model"):
        raise ValueError("the model path must end in '.model'")
    return PipelineModel.load(model_path), load_metadata(spark, metadata_path)
