"""Every operator as a query over the driver's tables: name -> function (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import kernels as K
from ..functions import scalars as S
from ..functions.projection import reproject_lambert93
from ..operators import components, crops, enrich, epochs, images, merge, metrics, pixels, preprocessing, scoring, spatial_join, tiles, training
from ..sinks import tables as sinks
from ..session import cut, scratch_path
from ..sources.layers import read_layer as read_from_file, scan_roof_csv
from ..streaming.incremental import CROPS, cut_batch, cut_pending, run_stream
from . import fixtures as X
from .enrichment import enrich_footprints

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
MIN_AREA = 60
CLASSES3 = ("c0", "c1", "c2")
CLASSES2 = ("no_PV", "PV")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _general(df: DataFrame) -> DataFrame:
    """Forget that the rectangles are rectangles, so the general kernels do the work."""
    return df.withColumn("is_box", F.lit(False))


def _wkt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.layer(spark, sf_dir).select("id", G.to_wkt(F.col("geom")).alias("wkt"))


# ---------------------------------------------------------------- sources


@query
def read_layer(spark, sf_dir):
    """A CSV layer written and read: WKT parsed into geometry; every 9th row is malformed and keeps a NULL geometry."""
    k = F.substring("id", 2, 10).cast("long")
    text = _wkt_rows(spark, sf_dir).withColumn("wkt", F.when(k % 9 == 0, F.lit("POLYGON ((0 0, 1")).otherwise(F.col("wkt")))
    path = scratch_path(spark, "wkt-layer")
    text.write.option("header", True).option("escape", '"').csv(path)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in text.schema)
    df = read_from_file(spark, path, ddl, "csv", "wkt", srid=2154)
    return df.select("id", "xmin", "ymin", "xmax", "ymax", F.size(G.points_of(F.col("geom"))).alias("n_points"))


@query
def scan_roof_csv_file(spark, sf_dir):
    path = scratch_path(spark, "roofs")
    raw = X.roofs(spark, sf_dir).select("mat_toit_txt", F.lit("x").alias("other"), "batiment_groupe_id")
    raw.write.option("header", True).csv(path)
    return scan_roof_csv(spark, path)


QUERIES["scan_roof_csv"] = QUERIES.pop("scan_roof_csv_file")


@query
def scan_image_folder(spark, sf_dir):
    df = images.index_images(X.image_files(spark, sf_dir), "int", ("no_PV", "PV", "other"))
    return df.select("path", "class_name", "label_idx")


@query
def image_labels_list(spark, sf_dir):
    files = X.image_files(spark, sf_dir)
    labels = files.where("vec_id % 5 <> 0").select("path", F.col("label").alias("label"))
    return images.image_labels_list(files.select("path"), labels)


@query
def raster_catalog(spark, sf_dir):
    s = F.col("s_suppkey")
    ext = F.element_at(F.array(*[F.lit(e) for e in ("jp2", "tiff", "tif", "JP2")]), (s % 4 + 1).cast("int"))
    files = X.table(spark, sf_dir, "supplier").select(F.concat(F.lit("/r/R"), s.cast("string"), F.lit("."), ext).alias("path"))
    return crops.raster_catalog(files).select("path", "raster_id", "raster_name")


@query
def tile_manifest(spark, sf_dir):
    return tiles.tile_manifest(tiles.tile_grid(X.area_boxes(spark, sf_dir)))


# ---------------------------------------------------------------- sinks


@query
def write_attributes(spark, sf_dir):
    path = scratch_path(spark, "attributes") + ".csv"
    sinks.write_attributes(X.layer(spark, sf_dir), path)
    return spark.read.schema("id string, commune string, score int").option("header", True).csv(path)


@query
def write_layer(spark, sf_dir):
    """Written and read back twice, as Parquet and as CSV with WKT."""
    df = X.layer(spark, sf_dir).withMetadata("geom", {"srid": 2154})
    parts = []
    for fmt in ("parquet", "csv"):
        path = scratch_path(spark, "layer")
        sinks.write_layer(df, path, fmt)
        back = preprocessing.compute_area(sinks.read_back(spark, path, df, fmt))
        parts.append(back.select("id", "score", "xmin", "ymax", "area", F.lit(fmt).alias("fmt")))
    return parts[0].unionByName(parts[1])


def _named_crops(spark, sf_dir):
    pairs = spatial_join.footprint_raster_join(X.layer(spark, sf_dir), X.rasters(spark, sf_dir))
    return crops.crop_suffix(pairs.select("id", "raster_id"))


@query
def crop_manifest(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    sinks.write_crop_manifest(_named_crops(spark, sf_dir), path)
    back = spark.read.option("header", True).csv(path)
    return back.select("raster_id", F.col("Suffixed file name").alias("suffixed_name"), F.col("File name").alias("file_name"))


def _post3(spark, sf_dir):
    return scoring.postprocess(X.vectors(spark, sf_dir), CLASSES3, drop_suffixed=True, keep=())


@query
def write_scores(spark, sf_dir):
    path = scratch_path(spark, "scores") + ".csv"
    sinks.write_scores(_post3(spark, sf_dir), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(
        F.col("Building name").alias("building_name"), F.col("Score").alias("score_text"),
        F.col("Predicted class").alias("predicted_class"),
    )


@query
def route_by_class(spark, sf_dir):
    vec = X.vectors(spark, sf_dir)
    source = vec.select(S.path_stem(F.col("path")).alias("building_name"), "vec_id")
    path = scratch_path(spark, "routed")
    sinks.write_images_by_class(_post3(spark, sf_dir), source, path)
    return spark.read.parquet(path).groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n"), F.sum("vec_id").alias("id_sum"))


# ---------------------------------------------------------------- projections and filters


@query
def add_id(spark, sf_dir):
    df = preprocessing.add_id(X.footprints(spark, sf_dir), ["p_partkey"], prefix="75")
    return df.select("p_partkey", "ID")


@query
def add_xy(spark, sf_dir):
    return preprocessing.add_xy_coordinates(X.layer(spark, sf_dir)).select("id", "X", "Y")


@query
def compute_area(spark, sf_dir):
    return preprocessing.compute_area(_general(X.layer(spark, sf_dir))).select("id", "area")


@query
def remove_small(spark, sf_dir):
    return preprocessing.remove_small_features(X.layer(spark, sf_dir), MIN_AREA).select("id", "area")


@query
def removal_counts(spark, sf_dir):
    return preprocessing.removal_counts(X.layer(spark, sf_dir), MIN_AREA)


@query
def subset_filter(spark, sf_dir):
    df = X.layer(spark, sf_dir).withColumn("score", F.when(F.col("score") % 10 != 0, F.col("score")))
    return preprocessing.subset(df, "score", 25).select("id", "score")


@query
def drop_prefix(spark, sf_dir):
    df = X.layer(spark, sf_dir).select("id", "score", F.lit("x").alias("joint_zone"), F.lit(1).alias("joint_n"))
    return preprocessing.drop_prefixed(df)


@query
def copy_layer(spark, sf_dir):
    return preprocessing.copy_layer(X.layer(spark, sf_dir), "buildings").select("id", "score")


@query
def drop_suffix_names(spark, sf_dir):
    df = X.vectors(spark, sf_dir).select(S.path_stem(F.col("path")).alias("name"))
    k = F.regexp_extract("name", r"B(\d+)", 1).cast("long")
    df = df.withColumn("name", F.when(k % 13 == 0, F.concat("name", F.lit(".old"))).otherwise(F.col("name")))
    return df.where(S.keep_plain_names(F.col("name")))


@query
def threshold_class(spark, sf_dir):
    return X.vectors(spark, sf_dir).select("vec_id", S.threshold_class(F.col("p")).alias("predicted"))


@query
def class_name_map(spark, sf_dir):
    return X.vectors(spark, sf_dir).select("vec_id", S.class_name(F.col("truth"), CLASSES3).alias("class_name"))


@query
def bbox_overlap_filter(spark, sf_dir):
    return spatial_join.bbox_overlap_filter(X.layer(spark, sf_dir), 500.0, 1000.0, 1000.0, 1500.0).select("id")


# ---------------------------------------------------------------- joins


@query
def spatial_intersects(spark, sf_dir):
    return spatial_join.spatial_join(X.layer(spark, sf_dir), X.zones(spark, sf_dir), "id", "zone_id")


QUERIES["spatial_join"] = QUERIES.pop("spatial_intersects")


def _with_dense(spark, sf_dir):
    """Footprints and shapes of 20,000 points in one table; the points are worked out once."""
    return X.layer(spark, sf_dir).select("id", *G.BBOX, "geom", "is_box").unionByName(cut(X.dense(spark, sf_dir)))


@query
def spatial_join_dense(spark, sf_dir):
    """Shapes of many points on both sides; pairs that touch, and pairs that overlap."""
    left = _with_dense(spark, sf_dir)
    right = left.withColumnRenamed("id", "other")
    right = right.where(F.col("other").startswith("D") | F.col("other").endswith("7"))
    found = [
        spatial_join.spatial_join(left, right, "id", "other", p).withColumn("predicate", F.lit(p)) for p in ("intersects", "overlaps")
    ]
    return found[0].unionByName(found[1])


@query
def self_overlap_dense(spark, sf_dir):
    pairs = spatial_join.self_overlap_pairs(_with_dense(spark, sf_dir))
    return pairs.select("id_a", "id_b", F.round("overlap", 3).alias("overlap"))


@query
def flag_protected(spark, sf_dir):
    return enrich.flag_protected(X.layer(spark, sf_dir), X.zones(spark, sf_dir)).select("id", "protected")


@query
def dominant_roof(spark, sf_dir):
    """Layer rows with the dominant type of their commune; some communes are unknown to the roof table."""
    df = X.layer(spark, sf_dir).withColumn("commune", F.when(F.col("score") % 17 == 0, "99999").otherwise(F.col("commune")))
    return enrich.add_roof_type(df, X.roofs(spark, sf_dir)).select("id", "commune", "toiture")


@query
def dominant_per_commune(spark, sf_dir):
    return enrich.dominant_roof(X.roofs(spark, sf_dir))


@query
def unknown_share(spark, sf_dir):
    return enrich.unknown_share(X.roofs(spark, sf_dir))


@query
def roof_counts(spark, sf_dir):
    return enrich.roof_counts(X.roofs(spark, sf_dir))


@query
def update_on_id(spark, sf_dir):
    k = F.substring("id", 2, 10).cast("long")
    df = X.layer(spark, sf_dir).select("id", "score", (k * 1.0).alias("new_score"))
    return enrich.update_on_id(df, X.updates(spark, sf_dir), "id")


@query
def footprint_raster_join(spark, sf_dir):
    pairs = spatial_join.footprint_raster_join(X.layer(spark, sf_dir), X.rasters(spark, sf_dir))
    return pairs.select("id", "raster_id")


@query
def self_overlap_pairs(spark, sf_dir):
    return spatial_join.self_overlap_pairs(X.layer(spark, sf_dir))


@query
def pair_dedup(spark, sf_dir):
    """Each unordered pair once, from the general overlap kernel."""
    return spatial_join.self_overlap_pairs(_general(X.layer(spark, sf_dir))).select("id_a", "id_b")


@query
def pending_rasters(spark, sf_dir):
    return crops.pending_rasters(X.rasters(spark, sf_dir), X.ledger(spark, sf_dir)).select("raster_id")


def _fetched(grid: DataFrame) -> DataFrame:
    return grid.where((F.col("box_id") + F.col("col") * 3 + F.col("row") * 5) % 4 != 0).select("box_id", "tile_name")


@query
def pending_tiles(spark, sf_dir):
    grid = tiles.tile_grid(X.area_boxes(spark, sf_dir))
    return tiles.pending_tiles(grid, _fetched(grid), attempt=1).select("box_id", "tile_name")


# ---------------------------------------------------------------- merging


@query
def connected_components(spark, sf_dir):
    return components.connected_components(merge.overlap_links(X.layer(spark, sf_dir)))


@query
def merge_overlaps(spark, sf_dir):
    """Groups with their leader, size and summed area of the collected parts."""
    df = X.layer(spark, sf_dir)
    groups = cut(merge.overlap_groups(df))
    leaders = merge.group_leaders(df, groups)
    parts = merge.merged_parts(df, merge.with_leaders(groups, leaders))
    geom = F.col("geom")
    return parts.groupBy("group_id", "leader_id").agg(
        F.count(F.lit(1)).alias("members"), F.sum(F.size(geom)).alias("n_parts"), F.sum(G.area(geom)).alias("part_area")
    )


@query
def merged_parts(spark, sf_dir):
    """The parts of the merged geometries, one row per member."""
    df = X.layer(spark, sf_dir)
    groups = cut(merge.overlap_groups(df))
    parts = merge.merged_parts(df, merge.with_leaders(groups, merge.group_leaders(df, groups)))
    return parts.select("group_id", "leader_id", "id", G.area(F.col("geom")).alias("area"))


@query
def merge_overlapped(spark, sf_dir):
    merged = merge.merge_overlapped(X.layer(spark, sf_dir), "score", min_value=5)
    return merged.select("id", "commune", "score", "members", "xmin", "ymin", "xmax", "ymax", "area")


# ---------------------------------------------------------------- geometry functions


@query
def commune_code(spark, sf_dir):
    return X.roofs(spark, sf_dir).select("batiment_groupe_id", S.commune_code(F.col("batiment_groupe_id")).alias("commune"))


@query
def fill_unknown(spark, sf_dir):
    return X.roofs(spark, sf_dir).select("batiment_groupe_id", S.fill_unknown(F.col("mat_toit_txt")).alias("roof"))


@query
def bbox(spark, sf_dir):
    return X.layer(spark, sf_dir).select("id", *G.bbox_columns(F.col("geom")))


@query
def min_rotated_rect(spark, sf_dir):
    rect = _general(X.layer(spark, sf_dir)).withColumn("geom", K.min_rotated_rect())
    return rect.select("id", G.area(F.col("geom")).alias("rect_area"), *G.bbox_columns(F.col("geom")))


@query
def buffer(spark, sf_dir):
    grown = preprocessing.add_buffer_distance(_general(X.layer(spark, sf_dir)), 4)
    return preprocessing.compute_area(grown).select("id", "xmin", "ymin", "xmax", "ymax", "area", "buffer_simple")


@query
def buffer_concave(spark, sf_dir):
    """U-shapes whose notch the buffer narrows or closes."""
    grown = preprocessing.compute_area(preprocessing.add_buffer_distance(X.courts(spark, sf_dir), 4))
    rings = F.size(F.flatten("geom"))
    return grown.select("id", "xmin", "ymin", "xmax", "ymax", F.round("area", 6).alias("area"), rings.alias("n_rings"), "buffer_simple")


@query
def reproject(spark, sf_dir):
    s = F.col("s_suppkey")
    lon, lat = -5 + (s * 37 % 1500) / 100.0, 41 + (s * 53 % 1000) / 100.0
    geom = G.box_geom(lon, lat, lon + 0.25, lat + 0.25)
    moved = X.table(spark, sf_dir, "supplier").select(s, reproject_lambert93(geom).alias("geom"))
    corner, opposite = F.col("geom")[0][0][0], F.col("geom")[0][0][2]
    return moved.select(
        "s_suppkey", F.round(corner["x"], 3).alias("x"), F.round(corner["y"], 3).alias("y"),
        F.round(opposite["x"], 3).alias("x2"), F.round(opposite["y"], 3).alias("y2"),
    )


QUERIES["reproject_lambert93"] = QUERIES.pop("reproject")


# ---------------------------------------------------------------- crops


@query
def distinct_ids(spark, sf_dir):
    """Ten footprints share an id."""
    k = F.substring("id", 2, 10).cast("long")
    df = X.layer(spark, sf_dir).withColumn("id", F.concat(F.lit("G"), F.floor(k / 10).cast("string")))
    return crops.distinct_ids(spatial_join.footprint_raster_join(df, X.rasters(spark, sf_dir)))


@query
def crop_suffix(spark, sf_dir):
    return _named_crops(spark, sf_dir).select("id", "raster_id", "suffix", "suffixed_name")


def _byte(data: Column, i: Column) -> Column:
    return F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10).cast("long")


def _weighted(data: Column) -> Column:
    """Sum of position times value over the bytes, positions from 1: tells apart any moved pixel."""
    terms = F.when(F.length(data) > 0, F.transform(F.sequence(F.lit(1), F.length(data)), lambda i: i * _byte(data, i)))
    return F.coalesce(F.aggregate(terms, F.lit(0).cast("long"), lambda a, v: a + v), F.lit(0))


def _crops(spark, sf_dir):
    return crops.crop_rasters(X.layer(spark, sf_dir), X.rasters(spark, sf_dir), X.raster_tiles(spark, sf_dir), X.TILE)


@query
def crop_rasters(spark, sf_dir):
    return _crops(spark, sf_dir).select(
        "id", "raster_id", "height", "width", F.length("data").alias("n_bytes"), _weighted(F.col("data")).alias("checksum")
    )


@query
def zonal_pixels(spark, sf_dir):
    return crops.zonal_pixels(X.layer(spark, sf_dir), X.rasters(spark, sf_dir), X.raster_tiles(spark, sf_dir), X.TILE)


def _crops_16(spark, sf_dir):
    return crops.crop_rasters(X.layer(spark, sf_dir), X.rasters_16(spark, sf_dir), X.raster_tiles_16(spark, sf_dir), X.TILE)


def _weighted_16(data: Column) -> Column:
    """Sum of position times value over 16-bit samples, positions from 1."""
    steps = F.sequence(F.lit(1), F.floor(F.length(data) / 2).cast("int"))
    terms = F.when(F.length(data) > 0, F.transform(steps, lambda i: i * (_byte(data, 2 * i - 1) + 256 * _byte(data, 2 * i))))
    return F.coalesce(F.aggregate(terms, F.lit(0).cast("long"), lambda a, v: a + v), F.lit(0))


@query
def crop_rasters_16(spark, sf_dir):
    return _crops_16(spark, sf_dir).select(
        "id", "raster_id", "height", "width", "dtype", F.length("data").alias("n_bytes"), _weighted_16(F.col("data")).alias("checksum")
    )


@query
def zonal_pixels_16(spark, sf_dir):
    return crops.zonal_statistics(X.layer(spark, sf_dir), X.rasters_16(spark, sf_dir), X.raster_tiles_16(spark, sf_dir), X.TILE)


@query
def stretch_pixels(spark, sf_dir):
    """16-bit crops brought to bytes, as images are prepared and scored from."""
    small = pixels.stretched(_crops_16(spark, sf_dir), 0.0, 65520.0, nodata=float(X.NODATA_16))
    return small.select("id", "raster_id", "dtype", F.length("data").alias("n_bytes"), _weighted(F.col("data")).alias("checksum"))


@query
def incremental_crops(spark, sf_dir):
    """The rasters of the ledger cut in a first batch, then all others in one call that goes by the written ledger."""
    out, tile_path = scratch_path(spark, "batches"), scratch_path(spark, "tiles")
    layer, catalog = X.layer(spark, sf_dir), X.rasters(spark, sf_dir)
    X.raster_tiles(spark, sf_dir).write.parquet(tile_path)
    tiles_ = spark.read.parquet(tile_path)
    cut_batch(catalog.join(X.ledger(spark, sf_dir), "raster_id", "left_semi"), 0, layer, tiles_, X.TILE, out)
    batch = cut_pending(catalog, layer, tiles_, X.TILE, out)
    named = spark.read.parquet(f"{out}/{CROPS}").where(F.col("batch") == batch)
    return named.select("id", "raster_id", "suffix", "suffixed_name", _weighted(F.col("data")).alias("checksum"))


@query
def incremental_stream(spark, sf_dir):
    """All rasters through the stream in two runs: the second run finds the files of the first already done."""
    out, folder = scratch_path(spark, "stream"), scratch_path(spark, "catalog")
    catalog = X.rasters(spark, sf_dir)
    tile_path = scratch_path(spark, "tiles")
    X.raster_tiles(spark, sf_dir).write.parquet(tile_path)
    stored = spark.read.parquet(tile_path)
    for low in (True, False):
        part = catalog.where((F.col("i") < 3) if low else (F.col("i") >= 3))
        part.coalesce(1).write.mode("append").parquet(folder)
        run_stream(spark, folder, catalog.schema, X.layer(spark, sf_dir), stored, X.TILE, out)
    return spark.read.parquet(f"{out}/{CROPS}").groupBy("id").agg(
        F.count(F.lit(1)).alias("n_crops"), F.max("suffix").alias("last_suffix"), F.sum(F.length("data")).alias("n_bytes"),
        F.sum(_weighted(F.col("data"))).alias("checksum"),
    )


# ---------------------------------------------------------------- tiles


@query
def tile_grid(spark, sf_dir):
    return tiles.tile_grid(X.area_boxes(spark, sf_dir)).select("box_id", "tile_name", "min_x", "min_y", "max_x", "max_y")


# ---------------------------------------------------------------- images and scoring

_SIDE = 4


def _mean_model(values: np.ndarray) -> np.ndarray:
    """A fixed two-class model: logistic of the mean brightness."""
    return 1.0 / (1.0 + np.exp(-(values.mean(axis=1, keepdims=True) - 20.0) / 10.0))


@query
def prepare_images(spark, sf_dir):
    ready = images.prepare_images(_crops(spark, sf_dir), (_SIDE, _SIDE), "rgb")
    return ready.select("id", "raster_id", F.length("tensor").alias("n_values"), _weighted(F.col("tensor")).alias("checksum"))


@query
def prepare_fit_images(spark, sf_dir):
    """Crops labelled by footprint area, split, augmented and written as tensors partitioned by split and class."""
    labelled = (
        _crops(spark, sf_dir)
        .withColumn("path", F.concat_ws("/", "raster_id", "id"))
        .withColumn("class_name", F.when(F.col("height") * F.col("width") >= 6, "PV").otherwise("no_PV"))
    )
    ready = images.prepare_fit_images(labelled, "path", 0.6, 0.3, epoch=1, img_size=(_SIDE, _SIDE))
    path = scratch_path(spark, "tensors")
    ready.select("path", "split", "class_name", "tensor").write.partitionBy("split", "class_name").parquet(path)
    sums = spark.read.parquet(path).withColumn("checksum", _weighted(F.col("tensor")))
    return sums.groupBy("split", "class_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("tensor")).alias("n_values"), F.min("path").alias("first_path"), F.sum("checksum").alias("checksum")
    )


@query
def score_images(spark, sf_dir):
    named = crops.named_crops(X.layer(spark, sf_dir), X.rasters(spark, sf_dir), X.raster_tiles(spark, sf_dir), X.TILE)
    named = named.withColumn("path", F.concat(F.lit("images/"), "suffixed_name"))
    return scoring.score_images(
        named, scoring.bytes_model(_mean_model), CLASSES2, (_SIDE, _SIDE), "grayscale", keep=()
    )


def _arriving(pending: DataFrame, attempt: int) -> DataFrame:
    """A stand-in for the image service: a tile comes in the attempt that hangs on its place, two kinds in seven never."""
    base = F.col("box_id") * 7 + F.col("col") * 13 + F.col("row") * 29
    pixels = F.transform(F.sequence(F.lit(0), F.lit(_SIDE * _SIDE - 1)), lambda i: F.lpad(F.hex((base + i * 3) % 64), 2, "0"))
    here = (F.col("box_id") * 3 + F.col("col") * 5 + F.col("row") * 2) % 7 == attempt
    return pending.where(here).select(
        "box_id", "tile_name", F.lit(_SIDE).alias("height"), F.lit(_SIDE).alias("width"), F.lit(1).alias("n_channels"),
        F.unhex(F.array_join(pixels, "")).alias("data"),
    )


@query
def score_tiles(spark, sf_dir):
    """Areas to scores with retries: tiles that come in one of five attempts, and those that never come (without a score)."""
    scores, failed = scoring.score_areas(
        X.area_boxes(spark, sf_dir), _arriving, scratch_path(spark, "tiles"), scoring.bytes_model(_mean_model), CLASSES2, (_SIDE, _SIDE), "grayscale"
    )
    return scores.unionByName(failed, allowMissingColumns=True)


@query
def score_postprocess(spark, sf_dir):
    return _post3(spark, sf_dir)


@query
def softmax_score(spark, sf_dir):
    p = F.col("probs")
    return X.vectors(spark, sf_dir).select(
        "vec_id", S.softmax_score(p).alias("plain"), S.softmax_score(p, True).alias("twice")
    )


@query
def argmax_class(spark, sf_dir):
    return X.vectors(spark, sf_dir).select("vec_id", S.argmax_class(F.col("probs")).alias("predicted"))


@query
def path_stem(spark, sf_dir):
    return X.table(spark, sf_dir, "pages").select("page_id", S.path_stem(F.col("url")).alias("stem"))


@query
def encode_labels(spark, sf_dir):
    idx = F.col("truth")
    return X.vectors(spark, sf_dir).select(
        "vec_id",
        S.encode_label(idx, "int", CLASSES3).alias("as_int"),
        S.encode_label(idx % 2, "binary", CLASSES2).cast("double").alias("as_binary"),
        F.array_join(F.transform(S.encode_label(idx, "categorical", CLASSES3), lambda v: v.cast("int").cast("string")), ",").alias("one_hot"),
    )


@query
def round7(spark, sf_dir):
    return X.table(spark, sf_dir, "customer").select("c_custkey", S.round7(F.col("c_acctbal") / 1000.0).alias("r"))


@query
def sorted_paths(spark, sf_dir):
    return images.sorted_paths(X.image_files(spark, sf_dir).select("path"))


@query
def share_sample(spark, sf_dir):
    return images.share_sample(X.image_files(spark, sf_dir).select("path"), 0.3)


# ---------------------------------------------------------------- splits, metrics, training


@query
def split_rank(spark, sf_dir):
    return images.split_rank(X.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 42)


@query
def train_val_split(spark, sf_dir):
    return images.train_val_split(X.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.7, 0.2).select("doc_id", "split")


@query
def exact_split(spark, sf_dir):
    return images.exact_split(X.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.7, 0.2).select("doc_id", "split")


@query
def split_disjoint(spark, sf_dir):
    return images.split_disjoint(images.train_val_split(X.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.7, 0.3), "doc_id")


@query
def precision_by_class(spark, sf_dir):
    df = metrics.precision_by_class(X.binary_eval(spark, sf_dir), ("bad", "good"))
    return df.withColumn("precision", F.round("precision", 9))


@query
def recall_by_class(spark, sf_dir):
    """Averaged over batches of 32 documents."""
    df = X.binary_eval(spark, sf_dir).withColumn("batch_id", F.floor(F.col("doc_id") / 32))
    return metrics.recall_by_class(df, ("bad", "good"), "batch_id").withColumn("recall", F.round("recall", 9))


@query
def log_loss(spark, sf_dir):
    return metrics.log_loss(X.binary_eval(spark, sf_dir), 2).withColumn("log_loss", F.round("log_loss", 9))


def _eval3(spark, sf_dir):
    return X.vectors(spark, sf_dir).select(F.col("truth").alias("y_true"), F.col("probs").alias("p"))


@query
def evaluate(spark, sf_dir):
    return metrics.evaluate(_eval3(spark, sf_dir), CLASSES3).withColumn("value", F.round("value", 9))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_eval3(spark, sf_dir), 3)


@query
def train_classifier(spark, sf_dir):
    """Split and fit: rows by split and class, and how far the mean probability of the training rows is from their share of
    class 1, which a fit with a free intercept meets."""
    info = training.ModelInfo("quality", class_names=CLASSES2)
    rows = X.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"), (F.col("label") % 2).alias("label"))
    split = images.train_val_split(rows, "vec_id", 0.8, 0.2)
    model = training.train_classifier(split.where("split = 'train'"), info)
    judged = cut(training.predict_classifier(model, split, info).select("split", "label", "p"))
    gap = judged.where("split = 'train'").agg(F.round(F.abs(F.avg("p") - F.avg("label")), 2).alias("gap")).first()["gap"]
    return judged.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min((F.col("p") > 0) & (F.col("p") < 1)).alias("probabilities"), F.lit(gap).alias("gap")
    )


EPOCHS, STEPS = 3, 2


def epoch_rate(epoch: int) -> float:
    """Half the rate after the first epoch, a quarter after the next."""
    return 1.0 / 2**epoch


@query
def train_epochs(spark, sf_dir):
    """A softmax layer on four numbers that decide the class, in two runs: the second goes on where the first stopped."""
    e = F.transform(F.slice("embedding", 1, 4), lambda v: v.cast("double") * 8)
    rows = X.table(spark, sf_dir, "embeddings").select(
        "vec_id", e.alias("features"), F.when(e[0] + e[1] > 0.5, 0).when(e[2] > 0, 1).otherwise(2).alias("label")
    )
    path = scratch_path(spark, "epochs")
    epochs.train_by_epochs(rows, "vec_id", path, 3, EPOCHS - 1, STEPS, epoch_rate)
    kept = epochs.train_by_epochs(rows, "vec_id", path, 3, EPOCHS, STEPS, epoch_rate, initial_epoch=EPOCHS - 1)
    weight = F.posexplode("weights").alias("place", "weight")
    return kept.select("epoch", "rate", F.round("loss", 6).alias("loss"), "n", weight).withColumn("weight", F.round("weight", 6))


# ---------------------------------------------------------------- the whole chain


@query
def enrich_chain(spark, sf_dir):
    """Small shapes out, numbers, centroids, zones and roof types in, scores written back, overlapping shapes merged."""
    layer = X.layer(spark, sf_dir).withColumn("new_score", F.substring("id", 2, 10).cast("long") * 1.0)
    df = enrich_footprints(
        layer, X.zones(spark, sf_dir), X.roofs(spark, sf_dir), min_area=MIN_AREA,
        number="number", prefix="75", updates=X.updates(spark, sf_dir), merge_by="new_score",
    )
    return df.select("id", "number", "commune", "area", "X", "Y", "protected", "toiture", "new_score", "members")
