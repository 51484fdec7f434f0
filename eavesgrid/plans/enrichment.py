"""The footprint chain: clean, number, enrich, write scores back by id, merge what overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.enrich import add_roof_type, flag_protected, update_on_id
from ..operators.merge import merge_overlapped
from ..operators.preprocessing import add_id, add_xy_coordinates, remove_small_features


def enrich_footprints(
    layer: DataFrame,
    zones: DataFrame,
    roofs: DataFrame,
    id_col: str = "id",
    min_area: float = 10,
    lonlat: bool = False,
    number: str | None = None,
    prefix: str = "",
    updates: DataFrame | None = None,
    merge_by: str | None = None,
    min_value: float | None = None,
) -> DataFrame:
    """Small footprints out, centroids, protected flag and the commune's roof type in.

    ``number`` names a column of running numbers behind ``prefix``, in order of the ids.  ``updates`` are written to the
    rows with the same id.  With ``merge_by`` overlapping footprints become one row each, led by the highest value.
    """
    rows = add_xy_coordinates(remove_small_features(layer, min_area))
    if number:
        rows = add_id(rows, [id_col], prefix, number)
    rows = add_roof_type(flag_protected(rows, zones, id_col, lonlat), roofs)
    if updates is not None:
        rows = update_on_id(rows, updates, id_col)
    return rows if merge_by is None else merge_overlapped(rows, merge_by, min_value, id_col)
