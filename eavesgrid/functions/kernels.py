"""Arrow UDFs for the few geometry computations SQL expressions cannot state.

Geometries reach Python as Arrow list arrays and are viewed as flat numpy coordinate arrays plus offsets,
so the exact overlap and intersection tests run on whole batches instead of row by row.
Axis-aligned rectangles never get here: the column builders at the end answer them in the JVM and hand the UDF
a NULL for those rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import ship_package
from . import offset, sweep
from .geometry import BBOX, GEOM_TYPE, box_geom

# Overlaps of less than a square millimetre are rounding noise at Lambert-93 coordinates.
AREA_EPS = 1e-6
BOXES_PER_CHUNK = 1 << 18
HEAVY = 1 << 14  # a row with more combinations of edges than this is swept


class Flat:
    """Flat view of a geometry column: points, and offsets ring -> points, part -> rings, row -> parts."""

    def __init__(self, column: pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        self.rows = len(column)
        self.valid = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
        self.row_part = _offsets(column)
        parts = column.flatten()
        self.part_ring = _offsets(parts)
        rings = parts.flatten()
        self.ring_pt = _offsets(rings)
        pts = rings.flatten()
        self.x = pts.field("x").to_numpy(zero_copy_only=False).astype(np.float64)
        self.y = pts.field("y").to_numpy(zero_copy_only=False).astype(np.float64)
        self.row_ring = self.part_ring[self.row_part]
        self.row_pt = self.ring_pt[self.row_ring]

    def parts_of(self, row: int) -> list[list[np.ndarray]]:
        out = []
        for p in range(self.row_part[row], self.row_part[row + 1]):
            part = []
            for r in range(self.part_ring[p], self.part_ring[p + 1]):
                s, e = self.ring_pt[r], self.ring_pt[r + 1]
                part.append(np.column_stack([self.x[s:e], self.y[s:e]]))
            out.append(part)
        return out

    def edges(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of every edge's first point, its ring, and offsets row -> edges."""
        per_ring = np.maximum(np.diff(self.ring_pt) - 1, 0)
        first = _ranges(self.ring_pt[:-1], per_ring)
        ring = np.repeat(np.arange(len(per_ring)), per_ring)
        ring_edge = np.concatenate([[0], np.cumsum(per_ring)])
        return first, ring, ring_edge[self.row_ring]

    def ring_weights(self) -> np.ndarray:
        """+1 / -1 per ring so that weight * signed area is positive for outer rings, negative for holes."""
        first, ring, _ = self.edges()
        n_rings = len(self.ring_pt) - 1
        ox, oy = self._ring_origin()
        ax, ay = self.x[first] - ox[ring], self.y[first] - oy[ring]
        bx, by = self.x[first + 1] - ox[ring], self.y[first + 1] - oy[ring]
        signed = np.bincount(ring, weights=ax * by - bx * ay, minlength=n_rings)
        outer = np.zeros(n_rings, dtype=bool)
        starts = self.part_ring[:-1][np.diff(self.part_ring) > 0]
        outer[starts] = True
        return np.where(outer, 1.0, -1.0) * np.where(signed < 0, -1.0, 1.0)

    def _ring_origin(self) -> tuple[np.ndarray, np.ndarray]:
        has = np.diff(self.ring_pt) > 0
        ox, oy = np.zeros(len(has)), np.zeros(len(has))
        ox[has], oy[has] = self.x[self.ring_pt[:-1][has]], self.y[self.ring_pt[:-1][has]]
        return ox, oy


def _offsets(lists: pa.Array) -> np.ndarray:
    """Offsets into ``lists.flatten()``, which leaves out what NULL entries cover."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``starts[i] .. starts[i] + counts[i] - 1``."""
    counts = counts.astype(np.int64)
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def _row_chunks(work: np.ndarray):
    """Slices of consecutive rows whose summed work stays near the chunk budget."""
    if len(work) == 0:
        return
    cum = np.cumsum(work)
    start = 0
    while start < len(work):
        base = cum[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(cum, base + BOXES_PER_CHUNK, side="right")))
        yield start, end
        start = end


def _halfplane(px: np.ndarray, py: np.ndarray, ax, ay, bx, by) -> tuple[np.ndarray, np.ndarray]:
    """Clip closed chains (rows of px, py) to the left of the directed lines a -> b.

    Points outside are moved onto the line by projection instead of being removed.  What lies on the line
    encloses no area, so the signed area of the result is the area of the clipped shape, concave or not.
    """
    dx, dy = (bx - ax)[:, None], (by - ay)[:, None]
    norm = dx * dx + dy * dy
    norm = np.where(norm == 0, 1.0, norm)
    s = dx * (py - ay[:, None]) - dy * (px - ax[:, None])
    qx, qy, t = np.roll(px, -1, 1), np.roll(py, -1, 1), np.roll(s, -1, 1)
    out = s < 0
    cx = np.where(out, px + s * dy / norm, px)
    cy = np.where(out, py - s * dx / norm, py)
    cross = out != (t < 0)
    span = np.where(cross, s - t, 1.0)
    f = np.where(cross, s / np.where(span == 0, 1.0, span), 0.0)
    mx = np.where(cross, px + f * (qx - px), cx)
    my = np.where(cross, py + f * (qy - py), cy)
    n, k = px.shape
    rx, ry = np.empty((n, 2 * k)), np.empty((n, 2 * k))
    rx[:, 0::2], rx[:, 1::2], ry[:, 0::2], ry[:, 1::2] = cx, mx, cy, my
    return rx, ry


def _chain_area(px: np.ndarray, py: np.ndarray) -> np.ndarray:
    return 0.5 * (px * np.roll(py, -1, 1) - np.roll(px, -1, 1) * py).sum(1)


def _padded(flat: Flat, rings: np.ndarray, ox: np.ndarray, oy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rings as rows of equal length (last point repeated), relative to the given origins."""
    start, size = flat.ring_pt[rings], np.diff(flat.ring_pt)[rings]
    width = int(size.max())
    idx = start[:, None] + np.minimum(np.arange(width)[None, :], (size - 1)[:, None])
    return flat.x[idx] - ox[:, None], flat.y[idx] - oy[:, None]


def overlap_area_batch(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Area of a ∩ b per row.

    A shape is the signed sum of the strips below its edges, and two strips share the strip below the lower of both edges (see
    ``sweep.overlap_area``).  Upright edges have no strip.  Rows with equal numbers of edges are worked on together.
    """
    fa, fb = Flat(a), Flat(b)
    result = np.full(fa.rows, np.nan)
    ok = fa.valid & fb.valid & (np.diff(fa.row_pt) > 0) & (np.diff(fb.row_pt) > 0)
    result[ok] = 0.0
    if not ok.any():
        return result
    rows = np.flatnonzero(ok)
    sa, sb = Strips(fa), Strips(fb)
    heavy = sa.count[rows] * sb.count[rows] > HEAVY
    for row in rows[heavy]:
        result[row] = _swept_overlap(fa.parts_of(row), fb.parts_of(row))
    rows = rows[~heavy]
    result[rows] = strip_overlaps(sa, rows, sb, rows)
    return result


class Strips:
    """The edges of each row that are not upright, from left to right: ends, and the weight of the strip below."""

    def __init__(self, flat: Flat):
        first, ring, row_edge = flat.edges()
        weight = flat.ring_weights()[ring]
        x1, y1, x2, y2 = flat.x[first], flat.y[first], flat.x[first + 1], flat.y[first + 1]
        leans = x1 != x2
        self.start = np.concatenate([[0], np.cumsum(leans)])[row_edge]
        self.count = np.diff(self.start)
        x1, y1, x2, y2, weight = x1[leans], y1[leans], x2[leans], y2[leans], weight[leans]
        left = x1 < x2
        self.x1, self.y1 = np.where(left, x1, x2), np.where(left, y1, y2)
        self.x2, self.y2 = np.where(left, x2, x1), np.where(left, y2, y1)
        self.rise = (self.y2 - self.y1) / (self.x2 - self.x1)
        self.weight = np.where(left, -weight, weight)


def strip_overlaps(a: Strips, rows_a: np.ndarray, b: Strips, rows_b: np.ndarray) -> np.ndarray:
    """Overlap of each row of ``a`` with the row of ``b`` beside it."""
    out = np.zeros(len(rows_a))
    size = np.stack([a.count[rows_a], b.count[rows_b]], 1)
    some = np.flatnonzero((size > 0).all(1))
    kind = size[some, 0] * (int(size[:, 1].max(initial=0)) + 1) + size[some, 1]
    order = np.argsort(kind, kind="stable")
    some, kind = some[order], kind[order]
    ends = np.flatnonzero(np.diff(kind, append=-1)) + 1
    for begin, end in zip(np.concatenate([[0], ends[:-1]]).astype(int), ends):
        na, nb = size[some[begin]]
        step = max(1, BOXES_PER_CHUNK // int(na * nb) // 4)
        for at in range(begin, end, step):
            part = some[at : min(at + step, end)]
            i = a.start[rows_a[part]][:, None] + np.arange(na)
            j = b.start[rows_b[part]][:, None] + np.arange(nb)
            out[part] = _shared_strips(a, i, b, j)
    return out


def _shared_strips(a: Strips, i: np.ndarray, b: Strips, j: np.ndarray) -> np.ndarray:
    """Sums over all pairs of an edge in a line of ``i`` with one in the same line of ``j``."""
    base = a.y1[i[:, :1]]  # heights from a point of the shape, so that far coordinates cost no digits
    al, ay, ar, a_rise, aw = (v[:, :, None] for v in (a.x1[i], a.y1[i] - base, a.x2[i], a.rise[i], a.weight[i]))
    bl, by, br, b_rise, bw = (v[:, None, :] for v in (b.x1[j], b.y1[j] - base, b.x2[j], b.rise[j], b.weight[j]))
    lo = np.maximum(al, bl)
    wide = np.maximum(np.minimum(ar, br) - lo, 0.0)
    p, r = ay + a_rise * (lo - al), by + b_rise * (lo - bl)
    q, s = p + a_rise * wide, r + b_rise * wide
    before, after = p - r, q - s
    high = (np.minimum(p, r) + np.minimum(q, s)) / 2
    cross = before * after < 0
    if cross.any():  # where the edges cross, the lower side is bent
        before, after = np.abs(before[cross]), np.abs(after[cross])
        high[cross] += before * after / (2 * (before + after))
    return (high * wide * aw * bw).sum((1, 2))


def _swept_overlap(a: list[list[np.ndarray]], b: list[list[np.ndarray]]) -> float:
    """Both shapes are cut to their common extent first, so that rounding goes with the size of the overlap."""
    (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = sweep.Edges(a).extent(), sweep.Edges(b).extent()
    box = max(ax0, bx0), max(ay0, by0), min(ax1, bx1), min(ay1, by1)
    if box[0] >= box[2] or box[1] >= box[3]:
        return 0.0
    return sweep.overlap_area(*(sweep.Edges(clip_parts(parts, *box)).moved(*box[:2]) for parts in (a, b)))


def clip_area_batch(geom: pa.Array, x0, y0, x1, y1) -> np.ndarray:
    """Area of each geometry inside its rectangle."""
    g = Flat(geom)
    result = np.full(g.rows, np.nan)
    ok = g.valid & (np.diff(g.row_pt) > 0)
    result[ok] = 0.0
    w = g.ring_weights()
    ring_row = np.repeat(np.arange(g.rows), np.diff(g.row_ring))
    sizes = np.diff(g.ring_pt)
    order = np.argsort(sizes, kind="stable")
    order = order[sizes[order] > 0]
    for s, e in _row_chunks(sizes[order]):
        rings = order[s:e]
        row = ring_row[rings]
        lo_x, lo_y = np.asarray(x0)[row], np.asarray(y0)[row]
        wide, high = np.asarray(x1)[row] - lo_x, np.asarray(y1)[row] - lo_y
        zero = np.zeros(len(rings))
        px, py = _padded(g, rings, lo_x, lo_y)
        px, py = _halfplane(px, py, zero, zero, wide, zero)
        px, py = _halfplane(px, py, wide, zero, wide, high)
        px, py = _halfplane(px, py, wide, high, zero, high)
        px, py = _halfplane(px, py, zero, high, zero, zero)
        result += np.where(ok, np.bincount(row, weights=_chain_area(px, py) * w[rings], minlength=g.rows), 0.0)
    return result


def touch_batch(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Per row whether an edge of one crosses or touches an edge of the other; rings may be open lines."""
    fa, fb = Flat(a), Flat(b)
    ok = fa.valid & fb.valid & (np.diff(fa.row_pt) > 0) & (np.diff(fb.row_pt) > 0)
    return _touching(fa, fb, ok, fa.edges(), fb.edges())


def _touching(fa: Flat, fb: Flat, ok: np.ndarray, edges_a, edges_b) -> np.ndarray:
    hit = np.zeros(fa.rows, dtype=bool)
    (ea, _, row_ea), (eb, _, row_eb) = edges_a, edges_b
    na, nb = np.diff(row_ea), np.diff(row_eb)
    rows = np.flatnonzero(ok)
    heavy = na[rows] * nb[rows] > HEAVY
    for row in rows[heavy]:
        hit[row] = sweep.any_contact(sweep.Edges(fa.parts_of(row)), sweep.Edges(fb.parts_of(row)), _segments_meet)
    rows = rows[~heavy]
    for s, e in _row_chunks(na[rows] * nb[rows]):
        sel = rows[s:e]
        combos = na[sel] * nb[sel]
        row = np.repeat(sel, combos)
        within = _ranges(np.zeros(len(sel), dtype=np.int64), combos)
        p, q = ea[row_ea[row] + within // nb[row]], eb[row_eb[row] + within % nb[row]]
        met = _segments_meet(fa.x[p], fa.y[p], fa.x[p + 1], fa.y[p + 1], fb.x[q], fb.y[q], fb.x[q + 1], fb.y[q + 1])
        hit[row[met]] = True
    return hit


def crossings_batch(geom: pa.Array, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    """Per row how many edges the ray from a point to the right crosses."""
    g = Flat(geom)
    first, _, row_edge = g.edges()
    n = np.diff(row_edge)
    row = np.repeat(np.arange(g.rows), n)
    hits = _ray_crosses(px[row], py[row], g.x[first], g.y[first], g.x[first + 1], g.y[first + 1])
    return np.bincount(row, weights=hits, minlength=g.rows).astype(np.int64)


def intersects_batch(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Closed intersection per row: edges that cross or touch, or one shape inside the other."""
    fa, fb = Flat(a), Flat(b)
    ok = fa.valid & fb.valid & (np.diff(fa.row_pt) > 0) & (np.diff(fb.row_pt) > 0)
    (ea, _, row_ea), (eb, _, row_eb) = fa.edges(), fb.edges()
    hit = _touching(fa, fb, ok, (ea, None, row_ea), (eb, None, row_eb))
    # No boundary contact: each part lies wholly inside or outside the other shape, one vertex decides.
    for one, other, edges, row_edges in ((fa, fb, eb, row_eb), (fb, fa, ea, row_ea)):
        part_row = np.repeat(np.arange(one.rows), np.diff(one.row_part))
        start = one.ring_pt[one.part_ring[:-1]]
        usable = (np.diff(one.part_ring) > 0) & (ok & ~hit)[part_row]
        part_row, start = part_row[usable], start[usable]
        n_other = np.diff(row_edges)
        for s, e in _row_chunks(n_other[part_row]):
            rows_, st = part_row[s:e], start[s:e]
            counts = n_other[rows_]
            which = np.repeat(np.arange(len(rows_)), counts)
            q = edges[_ranges(row_edges[rows_], counts)]
            vx, vy = one.x[st][which], one.y[st][which]
            crossing = _ray_crosses(vx, vy, other.x[q], other.y[q], other.x[q + 1], other.y[q + 1])
            odd = np.bincount(which, weights=crossing, minlength=len(rows_)).astype(np.int64) % 2 == 1
            hit[rows_[odd]] = True
    return hit


def _segments_meet(ax, ay, bx, by, cx, cy, dx, dy) -> np.ndarray:
    def turn(px, py, qx, qy, rx, ry):
        return (qx - px) * (ry - py) - (qy - py) * (rx - px)

    def on_box(px, py, qx, qy, rx, ry):
        return (
            (np.minimum(px, qx) <= rx) & (rx <= np.maximum(px, qx))
            & (np.minimum(py, qy) <= ry) & (ry <= np.maximum(py, qy))
        )

    c, d = turn(ax, ay, bx, by, cx, cy), turn(ax, ay, bx, by, dx, dy)
    a, b = turn(cx, cy, dx, dy, ax, ay), turn(cx, cy, dx, dy, bx, by)
    proper = (np.sign(c) * np.sign(d) < 0) & (np.sign(a) * np.sign(b) < 0)
    return (
        proper
        | ((c == 0) & on_box(ax, ay, bx, by, cx, cy))
        | ((d == 0) & on_box(ax, ay, bx, by, dx, dy))
        | ((a == 0) & on_box(cx, cy, dx, dy, ax, ay))
        | ((b == 0) & on_box(cx, cy, dx, dy, bx, by))
    )


def _ray_crosses(px, py, ax, ay, bx, by) -> np.ndarray:
    straddles = (ay > py) != (by > py)
    rise = np.where(straddles, by - ay, 1.0)
    return (straddles & (px < ax + (py - ay) / rise * (bx - ax))).astype(float)


# ---------------------------------------------------------------- oriented minimum box


def convex_hull(points: np.ndarray) -> np.ndarray:
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts

    def half(seq):
        chain: list[np.ndarray] = []
        for p in seq:
            while len(chain) > 1:
                u, v = chain[-1] - chain[-2], p - chain[-2]
                if u[0] * v[1] - u[1] * v[0] > 0:
                    break
                chain.pop()
            chain.append(p)
        return chain

    return np.array(half(pts)[:-1] + half(pts[::-1])[:-1])


HULL_FROM = 12  # with more points than this the convex hull is worth computing first


def _smallest_boxes(x: np.ndarray, y: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """Per row of points the smallest box parallel to one of the row's directions, as (rows, 4, 2) corners.

    Ties go to the lowest angle.  Any direction gives an enclosing box and an edge of the hull gives the smallest, so
    extra directions do no harm.
    """
    angle = np.mod(np.arctan2(dy, dx), np.pi / 2)
    angle = np.where(angle > np.pi / 2 - 1e-12, 0.0, angle)
    c, s = np.cos(angle)[:, :, None], np.sin(angle)[:, :, None]
    u, v = c * x[:, None, :] + s * y[:, None, :], c * y[:, None, :] - s * x[:, None, :]
    u0, u1, v0, v1 = u.min(2), u.max(2), v.min(2), v.max(2)
    size = (u1 - u0) * (v1 - v0)
    near = size <= size.min(1, keepdims=True) * (1 + 1e-12)
    best = np.where(near, angle, np.inf).argmin(1)
    pick = np.arange(len(x)), best
    cc, ss = c[..., 0][pick][:, None], s[..., 0][pick][:, None]
    cu = np.stack([u0[pick], u1[pick], u1[pick], u0[pick]], 1)
    cv = np.stack([v0[pick], v0[pick], v1[pick], v1[pick]], 1)
    return np.stack([cc * cu - ss * cv, ss * cu + cc * cv], 2)


def min_rotated_boxes(flat: Flat) -> np.ndarray:
    """(rows, 4, 2) corners, counter-clockwise, of the smallest enclosing boxes; NaN for rows without points."""
    out = np.full((flat.rows, 4, 2), np.nan)
    count = np.diff(flat.row_pt)
    for n in np.unique(count[count > 0]):
        rows = np.flatnonzero(count == n)
        at = flat.row_pt[rows][:, None] + np.arange(n)[None, :]
        pts = np.stack([flat.x[at], flat.y[at]], 2)
        if n > HULL_FROM:
            for row, one in zip(rows, pts):
                out[row] = min_rotated_box(one)
            continue
        rel = pts - pts[:, :1]
        i, j = np.triu_indices(n, 1) if n > 1 else (np.zeros(1, int), np.zeros(1, int))
        way = rel[:, j] - rel[:, i]
        out[rows] = _smallest_boxes(rel[:, :, 0], rel[:, :, 1], way[:, :, 0], way[:, :, 1]) + pts[:, :1]
    return out


def min_rotated_box(points: np.ndarray) -> np.ndarray:
    """The same for one set of points, by way of its convex hull."""
    origin = points[0]
    hull = convex_hull(points - origin)
    edge = np.roll(hull, -1, 0) - hull
    step = max(1, BOXES_PER_CHUNK // len(hull))
    found = [
        _smallest_boxes(hull[None, :, 0], hull[None, :, 1], edge[None, k : k + step, 0], edge[None, k : k + step, 1])[0]
        for k in range(0, len(hull), step)
    ]  # a round shape has as many directions as points: in steps
    area = [np.hypot(*(box[1] - box[0])) * np.hypot(*(box[3] - box[0])) for box in found]
    return found[int(np.argmin(area))] + origin


def _to_arrow(geoms: list) -> pa.Array:
    """Geometry column from rows of parts of closed ring arrays (points x 2), or None."""
    row_off, part_off, ring_off, rings = [0], [0], [0], []
    for geom in geoms:
        for part in geom or ():
            for ring in part:
                rings.append(ring)
                ring_off.append(ring_off[-1] + len(ring))
            part_off.append(part_off[-1] + len(part))
        row_off.append(row_off[-1] + len(geom or ()))
    xy = np.concatenate(rings) if rings else np.zeros((0, 2))
    x, y = (pa.array(np.ascontiguousarray(xy[:, k])) for k in (0, 1))
    nested = pa.ListArray.from_arrays(pa.array(ring_off, pa.int32()), pa.StructArray.from_arrays([x, y], ["x", "y"]))
    nested = pa.ListArray.from_arrays(pa.array(part_off, pa.int32()), nested)
    missing = pa.array([g is None for g in geoms], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(row_off, pa.int32()), nested, mask=missing).cast(_GEOM_ARROW)


def _closed(ring: np.ndarray) -> np.ndarray:
    return np.concatenate([ring, ring[:1]])


# ---------------------------------------------------------------- buffer

MITRE_LIMIT = 2.0  # Fixed value: mitre limit of the buffer.


def offset_ring(ring: np.ndarray, distance: float) -> list[list[np.ndarray]]:
    """Ring moved outwards (left side is inside) by ``distance``: parts of open rings, the outer one first, none if it has vanished.

    Corners sharper than the mitre limit are cut off square to their bisector.  Where the moved ring crosses itself it is cleaned
    up (``offset``): a filled gap may leave a hole, a shrunk shape may fall apart.
    """
    pts = ring[:-1]
    step = np.roll(pts, -1, 0) - pts
    keep = (step != 0).any(1)
    pts = pts[keep]
    n = len(pts)
    if n < 3:
        return []
    x, y = pts[:, 0], pts[:, 1]
    if (x * np.roll(y, -1) - np.roll(x, -1) * y).sum() < 0:
        pts = pts[::-1]
    if distance == 0:
        return [[pts]]
    if distance < 0 and 2 * -distance >= min(np.ptp(pts[:, 0]), np.ptp(pts[:, 1])):
        return []
    step = np.roll(pts, -1, 0) - pts
    unit = step / np.hypot(step[:, 0], step[:, 1])[:, None]
    normal = np.column_stack([unit[:, 1], -unit[:, 0]])
    new, owner = _corners(pts, unit, normal, distance, through=False)
    if new is not None and _keeps_directions(new, owner, unit, n) and not _self_crossing(new):
        return [[new]]
    return offset.outlines(_corners(pts, unit, normal, distance, through=True)[0])


def _corners(pts: np.ndarray, unit: np.ndarray, normal: np.ndarray, distance: float, through: bool):
    """The corners of the moved ring, and the edges (before, after) each lies on, -1 for none.

    Where moved edges overlap they meet in one point, or each keeps its length and both are joined ``through`` the old corner.  Without
    that a spike that folds back gives no ring.
    """
    out: list[np.ndarray] = []
    owner: list[tuple[int, int]] = []
    for i in range(len(pts)):
        before, after = normal[i - 1], normal[i]
        dot = float(before @ after)
        turn = float(unit[i - 1][0] * unit[i][1] - unit[i - 1][1] * unit[i][0])
        ratio = np.sqrt(2 / (1 + dot)) if dot > -1 + 1e-12 else np.inf
        if turn * distance > 0 and ratio > MITRE_LIMIT:
            bis = before + after
            size = np.hypot(*bis)
            bis = unit[i - 1] if size < 1e-9 else bis / size
            cap = pts[i] + bis * MITRE_LIMIT * distance
            for n_, u_ in ((before, unit[i - 1]), (after, unit[i])):
                base = pts[i] + n_ * distance
                speed = float(u_ @ bis)
                out.append(base + u_ * (float((cap - base) @ bis) / speed if abs(speed) > 1e-12 else 0.0))
            owner += [(i - 1, -1), (-1, i)]
        elif through and (turn * distance < 0 or not np.isfinite(ratio)):
            out += [pts[i] + before * distance, pts[i], pts[i] + after * distance]
            owner += [(i - 1, -1), (-1, -1), (-1, i)]
        elif not np.isfinite(ratio):
            return None, owner
        else:
            out.append(pts[i] + (before + after) * (distance / (1 + dot)))
            owner.append((i - 1, i))
    return np.array(out), owner


def _keeps_directions(new: np.ndarray, owner: list[tuple[int, int]], unit: np.ndarray, n: int) -> bool:
    """Every edge still runs the way of the edge it came from."""
    for k in range(len(new)):
        out_edge, in_edge = owner[k][1], owner[(k + 1) % len(new)][0] % n
        if out_edge >= 0 and out_edge == in_edge:
            if float((new[(k + 1) % len(new)] - new[k]) @ unit[out_edge]) <= 0:
                return False
    return True


def _self_crossing(ring: np.ndarray) -> bool:
    return sweep.ring_meets_itself(ring, _segments_meet)


def buffer_parts(parts: list[list[np.ndarray]], distance: float) -> list[list[np.ndarray]]:
    result = []
    for part in parts:
        shells = offset_ring(part[0], distance)
        holes = [moved[0][::-1] for hole in part[1:] for moved in offset_ring(hole, -distance)]
        for rings in shells:
            own = [h for h in holes if len(shells) == 1 or offset._winding(h[:1, 0], h[:1, 1], rings[0])[0] > 0]
            result.append([*rings, *own])
    return result


def buffer_batch(flat: Flat, distance: np.ndarray) -> tuple[list, np.ndarray]:
    """Buffered rows (parts of closed rings, None for NULL) and whether each is simple, which all are after clean-up.

    Single rings that grow and have no sharp corner are done together, by number of points, and so are those of them that cross themselves
    and have one outline; the others one by one.
    """
    geoms: list = [None] * flat.rows
    simple = np.ones(flat.rows, dtype=bool)
    done = np.zeros(flat.rows, dtype=bool)
    plain = flat.valid & (np.diff(flat.row_part) == 1) & (np.diff(flat.row_ring) == 1) & (distance > 0)
    size = np.diff(flat.row_pt) - 1
    for n in np.unique(size[plain]):
        if not 3 <= n <= 64:
            continue
        rows = np.flatnonzero(plain & (size == n))
        at = flat.row_pt[rows][:, None] + np.arange(n)[None, :]
        new, fits, ok = _mitred(np.stack([flat.x[at], flat.y[at]], 2), distance[rows])
        for k in np.flatnonzero(fits & ok):
            geoms[rows[k]] = [[new[k]]]
        done[rows[fits & ok]] = True
        rest = rows[fits & ~ok]
        for part, moved in _joined_through(np.stack([flat.x, flat.y], 1)[flat.row_pt[rest][:, None] + np.arange(n)], distance[rest]):
            for row, ring in zip(rest[part], offset.outlines_together(moved)):
                if ring is not None:
                    geoms[row] = [[_closed(ring)]]
                    done[row] = True
    for row in np.flatnonzero(flat.valid & ~done):
        parts = buffer_parts(flat.parts_of(row), float(distance[row]))
        geoms[row] = [[_closed(ring) for ring in part] for part in parts]
    return geoms, simple


def _mitred(pts: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Growing rings of equal length: closed new rings, rows this covers (no sharp corner), and simplicity."""
    origin = pts[:, :1]
    p = pts - origin
    q = np.roll(p, -1, 1)
    turned = (p[:, :, 0] * q[:, :, 1] - q[:, :, 0] * p[:, :, 1]).sum(1) < 0
    p = np.where(turned[:, None, None], p[:, ::-1], p)
    step = np.roll(p, -1, 1) - p
    length = np.hypot(step[:, :, 0], step[:, :, 1])
    unit = step / np.where(length == 0, 1.0, length)[:, :, None]
    normal = np.stack([unit[:, :, 1], -unit[:, :, 0]], 2)
    before, u0 = np.roll(normal, 1, 1), np.roll(unit, 1, 1)
    spread = 1 + (before * normal).sum(2)
    back = spread <= 1e-12
    spread = np.where(back, 1.0, spread)
    turn = u0[:, :, 0] * unit[:, :, 1] - u0[:, :, 1] * unit[:, :, 0]
    sharp = back | ((turn > 0) & (2 / spread > MITRE_LIMIT**2))
    fits = ~(sharp | (length == 0)).any(1)
    new = p + (before + normal) * (distance[:, None] / spread)[:, :, None]
    follow = np.roll(new, -1, 1)
    ok = (((follow - new) * unit).sum(2) > 0).all(1)
    n = p.shape[1]
    i, j = np.triu_indices(n, 2)
    apart = ~((i == 0) & (j == n - 1))
    i, j = i[apart], j[apart]
    if len(i):
        a, b, c, d = new[:, i], follow[:, i], new[:, j], follow[:, j]
        ends = [v for corner in (a, b, c, d) for v in (corner[..., 0], corner[..., 1])]
        ok &= ~_segments_meet(*ends).any(1)
    return np.concatenate([new, new[:, :1]], 1) + origin, fits, ok


def _joined_through(pts: np.ndarray, distance: np.ndarray):
    """``_corners(..., through=True)`` of growing rings without a sharp corner: the rows and rings of each number of corners, at most 64."""
    x, y = pts[:, :, 0], pts[:, :, 1]
    turned = (x * np.roll(y, -1, 1) - np.roll(x, -1, 1) * y).sum(1) < 0
    pts = np.where(turned[:, None, None], pts[:, ::-1], pts)
    step = np.roll(pts, -1, 1) - pts
    unit = step / np.hypot(step[:, :, 0], step[:, :, 1])[:, :, None]
    after, u0 = np.stack([unit[:, :, 1], -unit[:, :, 0]], 2), np.roll(unit, 1, 1)
    before = np.roll(after, 1, 1)
    inward = u0[:, :, 0] * unit[:, :, 1] - u0[:, :, 1] * unit[:, :, 0] < 0
    far = distance[:, None, None]
    mitre = pts + (before + after) * (far / (1 + (before * after).sum(2, keepdims=True)))
    corners = np.stack([pts + before * far, np.where(inward[:, :, None], pts, mitre), pts + after * far], 2)
    used = np.stack([inward, np.ones_like(inward), inward], 2)
    size = used.sum((1, 2))
    for n in np.unique(size[size <= 64]):
        part = np.flatnonzero(size == n)
        yield part, corners[part][used[part]].reshape(len(part), n, 2)


# ---------------------------------------------------------------- cutting to a rectangle


def clip_ring(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray | None:
    """The closed ring inside a rectangle; pieces stay connected along the rectangle's sides.  None if nothing is left."""
    for axis, bound, sign in ((0, x0, 1.0), (0, x1, -1.0), (1, y0, 1.0), (1, y1, -1.0)):
        ring = _clip_ring_side(ring, axis, bound, sign)
        if len(ring) == 0:
            return None
    return ring if _has_area(ring) else None


def _clip_ring_side(ring: np.ndarray, axis: int, bound: float, sign: float) -> np.ndarray:
    """The closed ring on one side of a line parallel to an axis, ``sign`` 1 above and -1 below; without points if nothing is left."""
    side = (ring[:-1, axis] - bound) * sign
    keep = side >= 0
    if not keep.any():
        return ring[:0]
    if not keep.all():
        pts = ring[:-1]
        at = np.flatnonzero(keep != np.roll(keep, -1))  # edges that cross the line
        after = (at + 1) % len(pts)
        share = side[at] / (side[at] - side[after])
        met = pts[at] + share[:, None] * (pts[after] - pts[at])
        met[:, axis] = bound
        kept = np.flatnonzero(keep)
        order = np.argsort(np.concatenate([2 * kept, 2 * at + 1]), kind="stable")
        pts = np.concatenate([pts[kept], met])[order]
        ring = _closed(pts)
    return ring


def _has_area(ring: np.ndarray) -> bool:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return len(ring) > 3 and (x[:-1] * y[1:] - x[1:] * y[:-1]).sum() != 0


def clip_parts(parts: list[list[np.ndarray]], x0: float, y0: float, x1: float, y1: float) -> list[list[np.ndarray]]:
    out = []
    for part in parts:
        shell = clip_ring(part[0], x0, y0, x1, y1)
        if shell is not None:
            holes = (clip_ring(hole, x0, y0, x1, y1) for hole in part[1:])
            out.append([shell, *[h for h in holes if h is not None]])
    return out


def cut_up(parts: list[list[np.ndarray]], max_points: int, least_side: float):
    """``(bbox, parts)`` of pieces that share no area and have ``max_points`` points at most, unless a side is below ``least_side``.

    A piece is halved near the middle of its longer side, along a line of a power-of-2 grid.  A piece's border may run along such a line where
    the shape's did not.
    """
    todo = [[part for part in parts if part]]
    while todo:
        piece = todo.pop()
        points = np.concatenate([ring for part in piece for ring in part])
        lo, hi = points.min(0), points.max(0)
        wide = hi - lo
        axis = int(wide[1] > wide[0])
        if len(points) > max_points and wide[axis] >= least_side:
            step = 2.0 ** (math.floor(math.log2(wide[axis])) - 1)
            line = math.floor((lo[axis] + hi[axis]) / 2 / step + 0.5) * step
            if lo[axis] < line < hi[axis]:
                halves = ([[_clip_ring_side(ring, axis, line, sign) for ring in part] for part in piece] for sign in (-1.0, 1.0))
                halves = ([[r for r in part if len(r) and _has_area(r)] for part in half if len(part[0]) and _has_area(part[0])] for half in halves)
                todo += [half for half in halves if half]
                continue
        yield (float(lo[0]), float(lo[1]), float(hi[0]), float(hi[1])), piece


def is_rectangle(bbox: tuple[float, float, float, float], parts: list[list[np.ndarray]]) -> bool:
    """Whether a geometry is just its bbox, see ``geometry.is_box``; corners may be repeated."""
    x0, y0, x1, y1 = bbox
    if len(parts) != 1 or len(parts[0]) != 1 or not (x1 > x0 and y1 > y0):
        return False
    ring = parts[0][0]
    ring = ring[np.concatenate([[True], (np.diff(ring, axis=0) != 0).any(1)])]
    if len(ring) != 5:
        return False
    x, y = ring[:, 0], ring[:, 1]
    on_corner = (((x == x0) | (x == x1)) & ((y == y0) | (y == y1))).all()
    rel_x, rel_y = x - x[0], y - y[0]
    return bool(on_corner and abs((rel_x[:-1] * rel_y[1:] - rel_x[1:] * rel_y[:-1]).sum()) / 2 == (x1 - x0) * (y1 - y0))


# ---------------------------------------------------------------- column builders

_OVERLAP = _CLIP = _INTERSECTS = _OMBB = _BUFFER = _TOUCH = _RAY = None


def _udfs():
    """Built on first use, when there is a session whose workers can be given the package."""
    ship_package()
    global _OVERLAP, _CLIP, _INTERSECTS, _OMBB, _BUFFER, _TOUCH, _RAY
    if _OVERLAP is not None:
        return

    @F.arrow_udf("double")
    def overlap(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(overlap_area_batch(a, b), from_pandas=True)

    @F.arrow_udf("double")
    def clip(g: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
        sides = [c.to_numpy(zero_copy_only=False) for c in (x0, y0, x1, y1)]
        return pa.array(clip_area_batch(g, *sides), from_pandas=True)

    @F.arrow_udf("boolean")
    def intersects(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(intersects_batch(a, b))

    @F.arrow_udf(GEOM_TYPE)
    def ombb(g: pa.Array) -> pa.Array:
        boxes = min_rotated_boxes(Flat(g))
        missing = np.isnan(boxes[:, 0, 0])
        return _to_arrow([None if gone else [[_closed(box)]] for gone, box in zip(missing, boxes)])

    @F.arrow_udf(f"struct<geom:{GEOM_TYPE},simple:boolean>")
    def buffered(g: pa.Array, distance: pa.Array) -> pa.Array:
        flat = Flat(g)
        geoms, simple = buffer_batch(flat, distance.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([_to_arrow(geoms), pa.array(simple)], ["geom", "simple"], mask=pa.array(~flat.valid))

    @F.arrow_udf("boolean")
    def touch(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(touch_batch(a, b))

    @F.arrow_udf("long")
    def ray(g: pa.Array, px: pa.Array, py: pa.Array) -> pa.Array:
        return pa.array(crossings_batch(g, px.to_numpy(zero_copy_only=False), py.to_numpy(zero_copy_only=False)))

    # Marked nondeterministic so that the optimizer evaluates each once instead of copying it into a filter as well.
    _OVERLAP, _CLIP, _INTERSECTS, _OMBB, _BUFFER, _TOUCH, _RAY = (
        f.asNondeterministic() for f in (overlap, clip, intersects, ombb, buffered, touch, ray)
    )


_GEOM_ARROW = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def _span(lo: tuple[Column, Column], hi: tuple[Column, Column]) -> Column:
    return F.least(hi[0], hi[1]) - F.greatest(lo[0], lo[1])


def _full_geom(col) -> Column:
    """Geometry of a row, rebuilt from the bbox for rectangles that were shipped without."""
    return F.when(col("is_box"), box_geom(*[col(c) for c in BBOX])).otherwise(col("geom"))


def overlap_area(a: str, b: str) -> Column:
    """Overlap area of two aliased rows having ``geom, is_box`` and the bbox columns."""
    _udfs()
    ca, cb = (lambda n: F.col(f"{a}.{n}")), (lambda n: F.col(f"{b}.{n}"))
    boxes = ca("is_box") & cb("is_box")
    w = F.greatest(_span((ca("xmin"), cb("xmin")), (ca("xmax"), cb("xmax"))), F.lit(0.0))
    h = F.greatest(_span((ca("ymin"), cb("ymin")), (ca("ymax"), cb("ymax"))), F.lit(0.0))
    exact = _OVERLAP(F.when(~boxes, _full_geom(ca)), F.when(~boxes, _full_geom(cb)))
    return F.when(boxes, w * h).otherwise(exact)


def intersects(a: str, b: str) -> Column:
    """Closed intersection of two aliased rows whose bboxes are already known to meet."""
    _udfs()
    ca, cb = (lambda n: F.col(f"{a}.{n}")), (lambda n: F.col(f"{b}.{n}"))
    boxes = ca("is_box") & cb("is_box")
    return boxes | _INTERSECTS(F.when(~boxes, _full_geom(ca)), F.when(~boxes, _full_geom(cb)))


def edges_touch(a: str, b: str) -> Column:
    """Whether edges of two aliased rows meet; their ``geom`` must be there, and may hold open lines."""
    _udfs()
    return _TOUCH(F.col(f"{a}.geom"), F.col(f"{b}.geom"))


def ray_crossings(geom: str, px: str, py: str) -> Column:
    """How many edges of ``geom`` the ray from a point to the right crosses."""
    _udfs()
    return _RAY(F.col(geom), F.col(px), F.col(py))


def clip_area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Area inside a rectangle of a row having ``geom, is_box`` and the bbox columns."""
    _udfs()
    w = F.greatest(_span((F.col("xmin"), x0), (F.col("xmax"), x1)), F.lit(0.0))
    h = F.greatest(_span((F.col("ymin"), y0), (F.col("ymax"), y1)), F.lit(0.0))
    exact = _CLIP(F.when(~F.col("is_box"), F.col("geom")), x0, y0, x1, y1)
    return F.when(F.col("is_box"), w * h).otherwise(exact)


def min_rotated_rect(geom: str = "geom") -> Column:
    """Oriented minimum bounding box; a rectangle parallel to the axes is its own."""
    _udfs()
    box = box_geom(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    return F.when(F.col("is_box"), box).otherwise(_OMBB(F.when(~F.col("is_box"), F.col(geom))))


def buffer(distance: Column, geom: str = "geom") -> Column:
    """``struct<geom, simple>``: mitred per-row buffer; a ring that would cross itself is cleaned up.

    A shape shrunk to nothing has an empty geometry.
    """
    _udfs()
    d = distance.cast("double")
    x0, y0, x1, y1 = F.col("xmin") - d, F.col("ymin") - d, F.col("xmax") + d, F.col("ymax") + d
    empty = F.array().cast(GEOM_TYPE)
    grown = F.when((x0 < x1) & (y0 < y1), box_geom(x0, y0, x1, y1)).otherwise(empty)
    native = F.struct(grown.alias("geom"), F.lit(True).alias("simple"))
    return F.when(F.col("is_box"), native).otherwise(_BUFFER(F.when(~F.col("is_box"), F.col(geom)), d))


def register_sql_functions(spark) -> None:
    """Make the kernels callable from SQL text (non-box geometries included)."""
    _udfs()
    for name, fn in (
        ("geom_overlap_area", _OVERLAP),
        ("geom_intersects", _INTERSECTS),
        ("geom_min_rotated_rect", _OMBB),
        ("geom_buffer", _BUFFER),
    ):
        spark.udf.register(name, fn)
