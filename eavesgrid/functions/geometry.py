"""Geometry as native columns.

A geometry is ``array<array<array<struct<x,y>>>>``: parts, rings (outer first, then holes), points.
Rings are closed, first point equal to last.  Everything here is a Catalyst expression, no Python runs
per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEOM_TYPE = "array<array<array<struct<x:double,y:double>>>>"
BBOX = ("xmin", "ymin", "xmax", "ymax")


def _zero() -> Column:
    return F.lit(0.0)


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_geom(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A one-part geometry: the rectangle, counter-clockwise from its lower left corner."""
    ring = F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin))
    return F.array(F.array(ring))


def first(array: Column) -> Column:
    """First element, NULL of an empty array."""
    return F.get(array, F.lit(0))


def points_of(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def bbox_columns(geom: Column) -> list[Column]:
    pts = points_of(geom)
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return [
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    ]


def with_bbox(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Materialise the four bbox doubles once, so that joins and filters never open the geometry."""
    return df.withColumns({name: col for name, col in zip(BBOX, bbox_columns(F.col(geom)))})


def ring_area(ring: Column) -> Column:
    """Signed shoelace area, counter-clockwise positive, taken relative to the first point."""
    ox, oy = first(ring)["x"], first(ring)["y"]
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    cross = F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: (a["x"] - ox) * (b["y"] - oy) - (b["x"] - ox) * (a["y"] - oy),
    )
    return F.aggregate(cross, _zero(), lambda acc, v: acc + v) / 2


def _signed_by_role(rings: Column) -> Column:
    """Areas of one part's rings, outer ring positive and holes negative, whatever their direction."""
    return F.transform(rings, lambda r, i: F.when(i == 0, F.abs(ring_area(r))).otherwise(-F.abs(ring_area(r))))


def area(geom: Column) -> Column:
    """Planar area: holes subtracted, parts summed."""
    per_part = F.transform(geom, lambda part: F.aggregate(_signed_by_role(part), _zero(), lambda acc, v: acc + v))
    return F.aggregate(per_part, _zero(), lambda acc, v: acc + v)


def _ring_moments(ring: Column, role: Column) -> Column:
    """(area, first moments) of a ring relative to its first point, with the sign of its role."""
    ox, oy = first(ring)["x"], first(ring)["y"]
    n = F.greatest(F.size(ring) - 1, F.lit(0))

    def edge(a: Column, b: Column) -> Column:
        ax, ay, bx, by = a["x"] - ox, a["y"] - oy, b["x"] - ox, b["y"] - oy
        c = ax * by - bx * ay
        return F.struct(c.alias("c"), ((ax + bx) * c).alias("mx"), ((ay + by) * c).alias("my"))

    edges = F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), edge)
    total = F.aggregate(
        edges,
        F.struct(_zero().alias("c"), _zero().alias("mx"), _zero().alias("my")),
        lambda s, e: F.struct(
            (s["c"] + e["c"]).alias("c"), (s["mx"] + e["mx"]).alias("mx"), (s["my"] + e["my"]).alias("my")
        ),
        lambda s: F.struct(
            F.abs(s["c"] / 2).alias("a"),
            (ox + F.when(s["c"] != 0, s["mx"] / (3 * s["c"])).otherwise(_zero())).alias("cx"),
            (oy + F.when(s["c"] != 0, s["my"] / (3 * s["c"])).otherwise(_zero())).alias("cy"),
        ),
    )
    sign = F.when(role == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    return first(F.transform(F.array(total), lambda t: F.struct((t["a"] * sign).alias("a"), t["cx"].alias("cx"), t["cy"].alias("cy"))))


def centroid(geom: Column) -> Column:
    """``struct<x,y>``: area-weighted centroid over all rings; NULL for a geometry without area."""
    moments = F.flatten(F.transform(geom, lambda part: F.transform(part, lambda r, i: _ring_moments(r, i))))
    # Weighting offsets from the first ring's centroid keeps small shapes exact at large coordinates.
    rx, ry = first(moments)["cx"], first(moments)["cy"]
    zero = F.struct(_zero().alias("a"), _zero().alias("x"), _zero().alias("y"))
    return F.aggregate(
        moments,
        zero,
        lambda s, m: F.struct(
            (s["a"] + m["a"]).alias("a"),
            (s["x"] + m["a"] * (m["cx"] - rx)).alias("x"),
            (s["y"] + m["a"] * (m["cy"] - ry)).alias("y"),
        ),
        lambda s: F.when(s["a"] != 0, point(rx + s["x"] / s["a"], ry + s["y"] / s["a"])),
    )


def is_box(geom: Column, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """True where the geometry is exactly its bbox: one part, one ring, four corners in turn."""
    part = first(geom)
    ring = first(part)
    on_corner = F.forall(
        ring, lambda p: ((p["x"] == xmin) | (p["x"] == xmax)) & ((p["y"] == ymin) | (p["y"] == ymax))
    )
    return (
        (F.size(geom) == 1)
        & (F.size(part) == 1)
        & (F.size(ring) == 5)
        & on_corner
        & (F.abs(ring_area(ring)) == (xmax - xmin) * (ymax - ymin))
        & (xmax > xmin)
        & (ymax > ymin)
    )


def with_box_flag(df: DataFrame, geom: str = "geom") -> DataFrame:
    return df.withColumn("is_box", is_box(F.col(geom), *(F.col(c) for c in BBOX)))


def map_points(geom: Column, fn) -> Column:
    """Apply ``fn(point) -> point`` to every vertex."""
    return F.transform(geom, lambda part: F.transform(part, lambda ring: F.transform(ring, fn)))


# ---------------------------------------------------------------- WKT

_WKT = r"(?i)^\s*(MULTIPOLYGON|POLYGON)\s*\(.*\)\s*$"


def from_wkt(wkt: Column) -> Column:
    """Parse POLYGON / MULTIPOLYGON text; anything else, or a bad number, gives NULL."""
    multi = F.upper(F.ltrim(wkt)).startswith("MULTI")
    inner = F.regexp_replace(F.regexp_replace(wkt, r"(?i)^\s*(MULTI)?POLYGON\s*\(", ""), r"\)\s*$", "")
    # The part list of a polygon is the polygon itself; wrapping it lets one expression serve both.
    parts = F.split(F.when(multi, inner).otherwise(F.concat(F.lit("("), inner, F.lit(")"))), r"\)\s*\)\s*,\s*\(\s*\(")

    def to_point(text: Column) -> Column:
        xy = F.split(F.trim(F.regexp_replace(text, r"[()]", "")), r"\s+")
        return point(F.get(xy, F.lit(0)).try_cast("double"), F.get(xy, F.lit(1)).try_cast("double"))

    geom = F.transform(
        parts,
        lambda part: F.transform(
            F.split(part, r"\)\s*,\s*\("), lambda ring: F.transform(F.split(ring, ","), to_point)
        ),
    )
    good = F.forall(
        points_of(geom), lambda p: p["x"].isNotNull() & p["y"].isNotNull()
    ) & F.forall(F.flatten(geom), lambda r: (F.size(r) >= 4) & (first(r) == F.get(r, F.size(r) - 1)))
    return F.when(wkt.rlike(_WKT) & good, geom)


def to_wkt(geom: Column) -> Column:
    def ring_text(ring: Column) -> Column:
        pts = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
        return F.concat(F.lit("("), F.array_join(pts, ", "), F.lit(")"))

    def part_text(part: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(part, ring_text), ", "), F.lit(")"))

    return F.when(F.size(geom) == 1, F.concat(F.lit("POLYGON "), part_text(first(geom)))).otherwise(
        F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(geom, part_text), ", "), F.lit(")"))
    )
