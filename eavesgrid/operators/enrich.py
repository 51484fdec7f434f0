"""Adding outside information to a footprint layer: protected zones, roof types, updates by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import BBOX
from ..functions.projection import reproject_lambert93
from ..functions.scalars import UNKNOWN, commune_code, fill_unknown
from ..session import cut
from .preprocessing import require_columns, with_geometry
from .skew import broadcast_if_small, shuffled
from .spatial_join import FILL, HOT_CELL, bbox_is_finite, fill_cells, fills_in_use, spatial_join, touched_cells

# ---------------------------------------------------------------- protected zones


def reproject_zones(zones: DataFrame) -> DataFrame:
    """Zones in degrees to Lambert-93, bbox and rectangle flag renewed."""
    return with_geometry(zones, reproject_lambert93(F.col("geom")))


def flag_protected(
    layer: DataFrame, zones: DataFrame, id_col: str = "id", lonlat: bool = False, hot_cell: int = HOT_CELL
) -> DataFrame:
    """Adds ``protected``: the footprint meets some zone, contact included.

    A zone counts whatever its attributes are.  ``lonlat`` zones are reprojected first.  Most footprints are settled by a cell
    that lies wholly inside a zone and holds a point of theirs, however many zones lie on each other; only the others are joined.
    """
    require_columns(layer, id_col, "geom", "is_box", *BBOX)
    zones = reproject_zones(zones) if lonlat else zones
    zones = zones.withColumn("_zone", F.xxhash64(*BBOX))
    # Id and shape together: rows that share an id are flagged each by its own shape.
    keyed = layer.withColumn("_row", F.struct(id_col, *BBOX, F.xxhash64("geom").alias("shape")))
    sure = _in_covered_cells(keyed, cut(fill_cells(zones).distinct()))
    rest = keyed if sure is None else keyed.join(shuffled(sure), "_row", "left_anti")
    hits = spatial_join(rest, zones, "_row", "_zone", "intersects", hot_cell).select("_row").distinct()
    hits = hits if sure is None else hits.unionByName(sure)
    flagged = keyed.join(shuffled(hits.withColumn("protected", F.lit(True))), "_row", "left").drop("_row")
    return flagged.withColumn("protected", F.coalesce("protected", F.lit(False)))


def _in_covered_cells(keyed: DataFrame, cells: DataFrame) -> DataFrame | None:
    """``_row`` of the footprints with a point in one of the cells, or None without cells.

    Any point of a rectangle will do; other shapes are looked up by their first point alone.
    """
    fills = fills_in_use(cells)
    if not fills:
        return None
    spot = {"x": F.col("geom")[0][0][0]["x"], "y": F.col("geom")[0][0][0]["y"]}
    reach = F.greatest(*[F.abs(F.col(c)) for c in BBOX])
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    # A large rectangle has too many small cells: it is looked up in the grids that it covers with few.
    known = F.filter(
        F.array(*[F.lit(f) for f in fills]),
        lambda f: (side < F.pow(F.lit(2.0), f + 3)) & (reach < F.pow(F.lit(2.0), f + 50)),
    )
    ends = {f"_{c}": F.when(F.col("is_box"), F.col(c)).otherwise(spot[c[0]]) for c in BBOX}
    spots = keyed.where(bbox_is_finite()).select("_row", *[v.alias(k) for k, v in ends.items()], known.alias("_fills"))
    spots = spots.where(F.col("_xmin").isNotNull())
    touched = touched_cells(spots, F.col("_fills"), ("_xmin", "_ymin"), ("_xmax", "_ymax")).select("_row", *FILL)
    return cut(touched.join(broadcast_if_small(cells, cells.count()), list(FILL), "left_semi").select("_row").distinct())


# ---------------------------------------------------------------- roof types


def roof_table(roofs: DataFrame) -> DataFrame:
    """``commune, roof`` from the raw columns, bound by name; a missing type becomes UNKNOWN."""
    require_columns(roofs, "batiment_groupe_id", "mat_toit_txt")
    return roofs.select(
        commune_code(F.col("batiment_groupe_id")).alias("commune"), fill_unknown(F.col("mat_toit_txt")).alias("roof")
    )


def dominant_roof(roofs: DataFrame) -> DataFrame:
    """``commune, toiture, n``: most frequent roof type, alphabetically first on a tie.

    Counting by (commune, type) first leaves one row per type for the second step, however large a commune is.
    """
    counts = roof_table(roofs).where(F.col("commune").isNotNull()).groupBy("commune", "roof").agg(
        F.count(F.lit(1)).alias("n")
    )
    best = counts.groupBy("commune").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("roof").alias("roof"))).alias("b"))
    return best.select("commune", F.col("b.roof").alias("toiture"), (-F.col("b.neg")).alias("n"))


def add_roof_type(layer: DataFrame, roofs: DataFrame) -> DataFrame:
    """Left join of each commune's dominant type; communes without data get UNKNOWN.

    One row per commune: the optimizer broadcasts it when its measured size allows.
    """
    require_columns(layer, "commune")
    best = dominant_roof(roofs).select("commune", "toiture")
    return layer.join(best, "commune", "left").withColumn("toiture", fill_unknown(F.col("toiture")))


def unknown_share(roofs: DataFrame) -> DataFrame:
    """``toiture, communes, share``: how many communes each type dominates."""
    per_type = dominant_roof(roofs).groupBy("toiture").agg(F.count(F.lit(1)).alias("communes"))
    total = per_type.agg(F.sum("communes")).scalar()
    return per_type.select("toiture", "communes", (F.col("communes") / total).alias("share"))


def roof_counts(roofs: DataFrame) -> DataFrame:
    """``roof, n, share`` over rows with a commune, most frequent first."""
    per_type = roof_table(roofs).groupBy("roof").agg(F.count("commune").alias("n"))
    total = per_type.agg(F.sum("n")).scalar()
    return per_type.select("roof", "n", (F.col("n") / total).alias("share")).orderBy(F.desc("n"), "roof")


# ---------------------------------------------------------------- updates by id

_UPDATABLE = (T.StringType, T.IntegralType, T.FractionalType, T.BooleanType)


def update_on_id(layer: DataFrame, updates: DataFrame, id_col: str = "ID", key: str | None = None) -> DataFrame:
    """Columns of ``updates`` written into the layer rows with the same id.

    Rows without an update keep their values, updates without a row are ignored, a NULL update overwrites.  All
    layer rows sharing an id are updated.  ``key`` names the key column of ``updates``; with another key, a
    column called ``id_col`` in it is ignored.  Two updates for one id raise when the job runs.
    """
    require_columns(layer, id_col)
    key = key or id_col
    require_columns(updates, key)
    fields = [f for f in updates.schema.fields if f.name not in (key, id_col)]
    for f in fields:
        if not isinstance(f.dataType, _UPDATABLE):
            raise TypeError(f"column {f.name!r} of type {f.dataType.simpleString()} cannot be written to a layer")
    values = F.struct(F.lit(True).alias("matched"), *[F.col(f"`{f.name}`") for f in fields])
    picked = updates.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.first(values).alias("_u"), F.count(F.lit(1)).alias("_n")
    )
    message = F.concat(F.lit("more than one update for id "), F.col("_key").cast("string"))
    checked = picked.select("_key", F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col("_u")).alias("_u"))
    joined = layer.join(shuffled(checked), layer[id_col] == checked["_key"], "left")
    columns = []
    for name in layer.columns:
        if name in [f.name for f in fields]:
            columns.append(F.when(F.col("_u.matched"), F.col(f"_u.`{name}`")).otherwise(F.col(f"`{name}`")).alias(name))
        else:
            columns.append(layer[name])
    columns += [F.col(f"_u.`{f.name}`").alias(f.name) for f in fields if f.name not in layer.columns]
    return joined.select(*columns)
