"""Hand-made geometries and slow, independent answers to compare with."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from eavesgrid.functions.geometry import GEOM_TYPE
from eavesgrid.operators.preprocessing import with_geometry


def poly(*rings):
    """One part; the first ring is the outer one.  Rings are closed here."""
    return [[[(float(x), float(y)) for x, y in [*r, r[0]]] for r in rings]]


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


def rect(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def rotate(ring, degrees, cx=0.0, cy=0.0):
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    return [(cx + c * (x - cx) - s * (y - cy), cy + s * (x - cx) + c * (y - cy)) for x, y in ring]


TRIANGLE = poly([(0, 0), (4, 0), (0, 4)])
L_SHAPE = poly([(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)])
HOLED = poly(square(0, 0, 10), square(3, 3, 4))


def layer(spark, rows, extra="score double"):
    """rows: (id, geometry, extra columns...)"""
    schema = f"id string, geom {GEOM_TYPE}" + (f", {extra}" if extra else "")
    width = 2 + (len(extra.split(",")) if extra else 0)
    rows = [tuple(r) + (None,) * (width - len(r)) for r in rows]
    return with_geometry(spark.createDataFrame(rows, schema))


def general(df):
    return df.withColumn("is_box", F.lit(False))


# ---- brute force by clipping against convex pieces, plain Python

def _clip(poly_pts, a, b):
    def side(p):
        return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])

    out = []
    for p, q in zip(poly_pts, poly_pts[1:] + poly_pts[:1]):
        sp, sq = side(p), side(q)
        if sp >= 0:
            out.append(p)
        if (sp < 0 <= sq) or (sq < 0 <= sp):
            t = sp / (sp - sq)
            out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
    return out


def _area(pts):
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(pts, pts[1:] + pts[:1]))) / 2


def convex_overlap(a, b):
    """Overlap area of two convex counter-clockwise rings."""
    pts = list(b)
    for p, q in zip(a, a[1:] + a[:1]):
        pts = _clip(pts, p, q)
        if not pts:
            return 0.0
    return _area(pts)


def groups_of(pairs):
    """Union-find over id pairs: id -> smallest id of its group."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}
