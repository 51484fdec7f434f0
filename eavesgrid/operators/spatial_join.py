"""Spatial joins as equi-joins on grid cells.

Each row picks a grid whose cell is just larger than its own bbox (cell sides are powers of 4), so it covers at most
four cells of that grid however large it is.  A pair meets on the coarser of its two grids: the smaller
shape also looks itself up there.  A meeting is kept only in the cell that holds the lower left corner of the bbox
intersection, so each pair appears once without a ``distinct``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import BBOX
from ..functions.kernels import AREA_EPS, intersects, overlap_area
from . import divided
from .skew import salted_pair

STEP = 4.0
LEVEL_MIN, LEVEL_MAX = -20, 25
LARGEST = STEP**LEVEL_MAX / 2  # no box is larger than a cell of the coarsest grid
CELL = ("level", "cx", "cy")
HOT_CELL = 5_000
MAX_POINTS = 512


def grid_level(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    # Far from the origin the finest grids would need cell numbers beyond 64 bits.
    reach = F.greatest(*[F.abs(c) for c in (xmin, ymin, xmax, ymax)]) / F.lit(2.0**60)
    side = F.greatest(xmax - xmin, ymax - ymin, reach, F.lit(1e-12))
    level = F.ceil(F.ln(side) / F.lit(math.log(STEP))).cast("int")
    return F.greatest(F.least(level, F.lit(LEVEL_MAX)), F.lit(LEVEL_MIN))


def cell_side(level: Column) -> Column:
    return F.pow(F.lit(STEP), level.cast("double"))


def _cell_index(value: Column, level: Column) -> Column:
    return F.floor(value / cell_side(level)).cast("long")


def bbox_is_finite() -> Column:
    """All four sides are numbers below the size a grid can number; an infinite box would cover cells without end."""
    ok = F.lit(True)
    for c in BBOX:
        ok = ok & F.col(c).isNotNull() & (F.abs(F.col(c)) < F.lit(LARGEST))  # NaN is above all numbers
    return ok


def broken_boxes(df: DataFrame) -> DataFrame:
    """The rows that no spatial join can place: empty, infinite or NaN extents.  All joins leave them out."""
    return df.where(~bbox_is_finite())


def with_level(df: DataFrame) -> DataFrame:
    return df.where(bbox_is_finite()).withColumn("own_level", grid_level(*(F.col(c) for c in BBOX)))


def levels_in_use(*frames: DataFrame) -> list[list[int]]:
    """Grids each frame uses, from the bbox columns alone: one job, one bit per level."""
    bit = F.expr(f"shiftleft(1L, own_level - ({LEVEL_MIN}))")
    tagged = [
        f.where(F.col("xmin").isNotNull()).select(*[(bit if i == k else F.lit(0).cast("long")).alias(f"m{k}") for k in range(len(frames))])
        for i, f in enumerate(frames)
    ]
    rows = tagged[0]
    for other in tagged[1:]:
        rows = rows.unionByName(other)
    masks = rows.agg(*[F.bit_or(f"m{k}") for k in range(len(frames))]).first()
    return [[LEVEL_MIN + i for i in range(LEVEL_MAX - LEVEL_MIN + 1) if (mask or 0) >> i & 1] for mask in masks]


def cell_rows(df: DataFrame, levels: Column) -> DataFrame:
    """One row per covered cell of each listed grid."""
    lv = F.col("level")
    return (
        df.withColumn("level", F.explode(levels))
        .withColumn("cx", F.explode(F.sequence(_cell_index(F.col("xmin"), lv), _cell_index(F.col("xmax"), lv))))
        .withColumn("cy", F.explode(F.sequence(_cell_index(F.col("ymin"), lv), _cell_index(F.col("ymax"), lv))))
    )


def _from_own_up(levels: Sequence[int]) -> Column:
    """The listed levels that are not finer than the row's own."""
    known = F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<int>")
    return F.filter(known, lambda v: v >= F.col("own_level"))


def _above_own(levels: Sequence[int]) -> Column:
    known = F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<int>")
    return F.filter(known, lambda v: v > F.col("own_level"))


def _once() -> Column:
    """True in the one cell where a pair is kept."""
    lv = F.col("l.level")
    x = F.greatest(F.col("l.xmin"), F.col("r.xmin"))
    y = F.greatest(F.col("l.ymin"), F.col("r.ymin"))
    return (F.col("l.cx") == _cell_index(x, lv)) & (F.col("l.cy") == _cell_index(y, lv))


def bbox_meets(closed: bool) -> Column:
    """Bbox test of rows aliased l and r: contact counts if closed, else a positive area is needed."""
    lo = [(F.col(f"{a}.{c}min"), F.col(f"{b}.{c}max")) for c in "xy" for a, b in (("l", "r"), ("r", "l"))]
    tests = [(p <= q) if closed else (p < q) for p, q in lo]
    return tests[0] & tests[1] & tests[2] & tests[3]


def _equi(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    return cond


def bbox_join(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    closed: bool,
    hot_cell: int = HOT_CELL,
    weight: int = 1,
) -> DataFrame:
    """Pairs whose bboxes meet, as a frame of two structs aliased ``l`` and ``r``.

    Both inputs carry only the columns wanted in the result plus the bbox.  ``weight``: how many plain rows a row is worth, see ``salted_pair``.
    """
    lv, rv = with_level(left), with_level(right)
    l_levels, r_levels = levels_in_use(lv, rv)
    # side 0: left looks up right's own cells; side 1: right looks up strictly coarser left cells.
    l_rows = cell_rows(lv, _from_own_up(r_levels)).withColumn("side", F.lit(0))
    r_rows = cell_rows(rv, F.array("own_level")).withColumn("side", F.lit(0))
    if any(a > b for a in l_levels for b in r_levels):
        l_rows = l_rows.unionByName(cell_rows(lv, F.array("own_level")).withColumn("side", F.lit(1)))
        r_rows = r_rows.unionByName(cell_rows(rv, _above_own(l_levels)).withColumn("side", F.lit(1)))
    l_rows, r_rows, keys = salted_pair(l_rows, r_rows, [*CELL, "side"], left_id, right_id, hot_cell, weight)
    pairs = l_rows.alias("l").join(r_rows.alias("r"), _equi(keys) & _once() & bbox_meets(closed))
    return pairs


def self_bbox_join(df: DataFrame, id_col: str, hot_cell: int = HOT_CELL) -> DataFrame:
    """Pairs of one table whose bboxes overlap with positive area, each unordered pair once."""
    lv = with_level(df)
    (levels,) = levels_in_use(lv)
    l_rows = cell_rows(lv, _from_own_up(levels))
    r_rows = cell_rows(lv, F.array("own_level"))
    l_rows, r_rows, keys = salted_pair(l_rows, r_rows, CELL, id_col, id_col, hot_cell)
    # Rows of one grid would meet in both orders; rows of two grids meet with the finer one on the left only.
    one_order = (F.col("l.own_level") < F.col("r.own_level")) | (F.col(f"l.{id_col}") < F.col(f"r.{id_col}"))
    differ = F.col(f"l.{id_col}") != F.col(f"r.{id_col}")
    return l_rows.alias("l").join(
        r_rows.alias("r"), _equi(keys) & differ & one_order & _once() & bbox_meets(closed=False)
    )


# ---------------------------------------------------------------- cells inside rectangles

MOST_STRETCHED = 8  # rectangles longer than so many times their width are not cut into cells
FILL_MIN, FILL_MAX = -9, 48  # powers of two; two shapes that share the smallest cell share more than AREA_EPS
FILL = ("fill", "fx", "fy")


def fill_cells(df: DataFrame, *columns: str | Column) -> DataFrame:
    """``columns, fill, fx, fy``: for every rectangle the cells that lie wholly inside it, on a power-of-2 grid of its own size.

    The cell side is between a quarter and half of the shorter side, so there are 1 to about ``12 * MOST_STRETCHED`` cells of each.
    Shapes that are no rectangles, or too long, or too far out for the grid, have none.
    """
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    level = F.floor(F.log2(F.least(w, h) / 2)).cast("int")
    reach = F.greatest(*[F.abs(F.col(c)) for c in BBOX])
    ok = F.col("is_box") & bbox_is_finite() & (F.least(w, h) * MOST_STRETCHED >= F.greatest(w, h)) & level.between(FILL_MIN, FILL_MAX)
    rows = df.where(ok & (reach < F.pow(F.lit(2.0), level + 50))).withColumn("fill", level)
    side = F.pow(F.lit(2.0), F.col("fill").cast("double"))

    def inside(lo: str, hi: str) -> Column:
        first, last = F.ceil(F.col(lo) / side).cast("long"), F.floor(F.col(hi) / side).cast("long") - 1
        # an end below the start would count down
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    rows = rows.withColumn("fx", F.explode(inside("xmin", "xmax"))).withColumn("fy", F.explode(inside("ymin", "ymax")))
    return rows.select(*columns, *FILL)


def fills_in_use(cells: DataFrame) -> list[int]:
    return sorted(r[0] for r in cells.select("fill").distinct().collect())  # at most FILL_MAX - FILL_MIN + 1


def touched_cells(df: DataFrame, fills: Column, lo: tuple[str, str] = ("xmin", "ymin"), hi: tuple[str, str] = ("xmax", "ymax")) -> DataFrame:
    """One row for each cell of the listed power-of-2 grids that holds a point of the row's bbox."""
    side = F.pow(F.lit(2.0), F.col("fill").cast("double"))
    rows = df.withColumn("fill", F.explode(fills))
    for name, a, b in zip(FILL[1:], lo, hi):
        rows = rows.withColumn(name, F.explode(F.sequence(F.floor(F.col(a) / side).cast("long"), F.floor(F.col(b) / side).cast("long"))))
    return rows


_SHAPE = [*BBOX, "geom", "is_box"]


def slim_shape() -> list[Column]:
    """Shape columns for a shuffle: a rectangle travels as its bbox alone, the kernels rebuild it if needed."""
    return [*[F.col(c) for c in BBOX], F.when(~F.col("is_box"), F.col("geom")).alias("geom"), F.col("is_box")]


def spatial_join(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    predicate: str = "intersects",
    hot_cell: int = HOT_CELL,
    max_points: int = MAX_POINTS,
) -> DataFrame:
    """``left_id, right_id`` of the pairs that intersect (contact counts) or overlap (positive area).

    The two id columns need different names, and ids name one row each.  Both tables have ``geom``, ``is_box`` and the bbox columns.
    Shapes of more than ``max_points`` points, on either side, never travel or are tested whole (``divided``).
    """
    if predicate not in ("intersects", "overlaps"):
        raise ValueError(f"predicate must be intersects or overlaps, got {predicate!r}")
    if left_id == right_id:
        raise ValueError("the two id columns need different names")
    closed = predicate == "intersects"
    lights, heavies = zip(*(_by_points(df, key, max_points) for df, key in ((left, left_id), (right, right_id))))
    pairs = bbox_join(*lights, left_id, right_id, closed, hot_cell)
    test = intersects("l", "r") if closed else overlap_area("l", "r") > AREA_EPS
    found = pairs.where(test).select(F.col(f"l.{left_id}"), F.col(f"r.{right_id}"))
    some = (not heavies[0].isEmpty(), not heavies[1].isEmpty())
    if not any(some):
        return found
    if closed:
        more = divided.contact_pairs(lights, heavies, some, left_id, right_id, hot_cell, max_points)
    else:
        more = divided.overlap_sums(lights, heavies, some, left_id, right_id, hot_cell, max_points).where(F.col("overlap") > AREA_EPS)
    return found.unionByName(more.select(left_id, right_id))


def _by_points(df: DataFrame, id_col: str, max_points: int) -> tuple[DataFrame, DataFrame]:
    """The rows with few points, slim, and those with many."""
    points = F.aggregate(F.flatten("geom"), F.lit(0), lambda n, ring: n + F.size(ring))
    heavy = F.coalesce(~F.col("is_box") & (points > max_points), F.lit(False))
    return df.where(~heavy).select(id_col, *slim_shape()), df.where(heavy).select(id_col, *slim_shape())


def self_overlap_pairs(df: DataFrame, id_col: str = "id", hot_cell: int = HOT_CELL, max_points: int = MAX_POINTS) -> DataFrame:
    """``id_a, id_b, overlap`` with ``id_a < id_b``: every pair of rows that overlap with positive area.

    Ids name one row each.  Shapes of more than ``max_points`` points are divided; overlaps with these are sums of decimals, so they don't hang on the order of the parts.
    """
    light, heavy = _by_points(df, id_col, max_points)
    pairs = self_bbox_join(light, id_col, hot_cell)
    a, b = F.col(f"l.{id_col}"), F.col(f"r.{id_col}")
    found = (
        pairs.select(F.least(a, b).alias("id_a"), F.greatest(a, b).alias("id_b"), overlap_area("l", "r").alias("overlap"))
        .where(F.col("overlap") > AREA_EPS)
    )
    if heavy.isEmpty():
        return found
    # Heavy with light, and heavy with heavy in one order: as a join of two tables whose ids have names of their own.
    a_side, b_side = ([frame.withColumnRenamed(id_col, name) for frame in (light, heavy)] for name in ("_a", "_b"))
    sums = divided.overlap_sums(
        (None, b_side[0]), (a_side[1], b_side[1]), (True, True), "_a", "_b", hot_cell, max_points, in_order=True
    )
    more = sums.select(F.least("_a", "_b").alias("id_a"), F.greatest("_a", "_b").alias("id_b"), "overlap").where(F.col("overlap") > AREA_EPS)
    return found.unionByName(more)


def footprint_raster_join(footprints: DataFrame, catalog: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per footprint and raster whose extent and footprint bbox overlap with positive area.

    Works on bboxes alone, so no geometry is shuffled.  The result has the two keys and both extents.
    """
    left = footprints.select(id_col, *BBOX)
    right = catalog.select("raster_id", *BBOX)
    finite = bbox_area_is_finite()
    pairs = bbox_join(left.where(finite), right.where(finite), id_col, "raster_id", closed=False)
    own = [F.col(f"l.{c}").alias(c) for c in BBOX]
    ext = [F.col(f"r.{c}").alias(f"raster_{c}") for c in BBOX]
    return pairs.select(F.col(f"l.{id_col}"), F.col("r.raster_id"), *own, *ext)


def bbox_area_is_finite() -> Column:
    size = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    return size.isNotNull() & ~F.isnan(size) & (size < F.lit(float("inf")))


def bbox_overlap_filter(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose bbox overlaps one given extent with a positive, finite area."""
    return df.where(
        (F.col("xmin") < xmax) & (F.col("xmax") > xmin) & (F.col("ymin") < ymax) & (F.col("ymax") > ymin)
        & (F.col("xmax") > F.col("xmin")) & (F.col("ymax") > F.col("ymin")) & bbox_area_is_finite()
    )
