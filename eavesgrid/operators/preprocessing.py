"""Row-wise clean-up of a footprint layer: area filter, buffer, ids, centroids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import kernels as K
from .indexing import with_row_index


def require_columns(df: DataFrame, *names: str) -> None:
    """Fail from the schema alone, before any job runs."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"the layer needs the columns {missing}")


def with_geometry(df: DataFrame, geom: Column | None = None) -> DataFrame:
    """Attach ``geom``, its bbox columns and the rectangle flag."""
    if geom is not None:
        df = df.withColumn("geom", geom)
    return G.with_box_flag(G.with_bbox(df))


def compute_area(df: DataFrame) -> DataFrame:
    """Adds ``area``; rectangles by their bbox, the rest by the shoelace sum."""
    require_columns(df, "geom")
    general = G.area(F.col("geom"))
    if "is_box" in df.columns:
        box = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
        return df.withColumn("area", F.when(F.col("is_box"), box).otherwise(general))
    return df.withColumn("area", general)


def remove_small_features(df: DataFrame, min_area: float = 10, observation: Observation | None = None) -> DataFrame:
    """Drops rows with ``area <= min_area``; ``area`` stays in the result.

    ``observation`` collects ``total`` and ``removed`` while the result is computed, without a second pass.
    """
    with_area = compute_area(df)
    if observation is not None:
        small = F.when(F.col("area") <= min_area, 1).otherwise(0)
        with_area = with_area.observe(
            observation, F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(small), F.lit(0)).alias("removed")
        )
    return with_area.where(F.col("area") > min_area)


def removal_counts(df: DataFrame, min_area: float = 10) -> DataFrame:
    """One row ``total, removed, kept`` for the area filter, as a plain aggregate."""
    small = F.sum(F.when(F.col("area") <= min_area, 1).otherwise(0))
    return (
        compute_area(df)
        .agg(F.count(F.lit(1)).alias("total"), F.coalesce(small, F.lit(0)).alias("removed"))
        .withColumn("kept", F.col("total") - F.col("removed"))
    )


def add_buffer_distance(df: DataFrame, distance: float = 4) -> DataFrame:
    """Grows (or shrinks) every geometry by ``distance``, rows stay separate.

    Gaps narrower than the buffer close, and shrunk shapes may fall apart; ``buffer_simple`` says that no ring crosses itself, which
    is so for every geometry that was simple before.
    """
    require_columns(df, "geom")
    if not set(G.BBOX) <= set(df.columns) or "is_box" not in df.columns:
        df = with_geometry(df)
    grown = df.withColumn("_b", K.buffer(F.lit(float(distance))))
    kept = grown.withColumn("geom", F.col("_b.geom")).withColumn("buffer_simple", F.col("_b.simple")).drop("_b")
    return with_geometry(kept)


def add_id(df: DataFrame, order: list[str], prefix: str = "", name: str = "ID") -> DataFrame:
    """String ids ``prefix || position``, from 0, along an explicit order that leaves no ties."""
    indexed, _ = with_row_index(df, order, "_pos")
    return indexed.withColumn(name, F.concat(F.lit(prefix), F.col("_pos").cast("string"))).drop("_pos")


def add_xy_coordinates(df: DataFrame) -> DataFrame:
    """``X`` and ``Y``: centroid rounded to one decimal."""
    require_columns(df, "geom")
    center = G.centroid(F.col("geom"))
    return df.withColumn("_c", center).withColumn("X", F.round("_c.x", 1)).withColumn("Y", F.round("_c.y", 1)).drop("_c")


def subset(df: DataFrame, field: str, minimum: float) -> DataFrame:
    """Rows with ``field >= minimum``; NULL drops."""
    require_columns(df, field)
    return df.where(F.col(field) >= minimum)


def drop_prefixed(df: DataFrame, prefix: str = "joint_") -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(prefix)])


def copy_layer(df: DataFrame, name: str) -> DataFrame:
    """DataFrames never change, so a copy is the same plan under another alias."""
    return df.alias(f"{name}_copy")
