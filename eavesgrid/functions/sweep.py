"""Overlap, contact and self-crossing of shapes with many points, by sweeping their edges along one axis.

Only edges whose ranges on the axis overlap are looked at.  These pairs are two runs of a sorted list for each edge: the edges of the
other shape that begin inside its range, and the other way round.  The axis is the one with fewer pairs.  Pairs are worked on in
steps, so memory is linear in the points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PAIRS_PER_STEP = 1 << 18


def _runs(first: np.ndarray, count: np.ndarray, per_step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(owner, place)`` for ``count[i]`` consecutive places from ``first[i]`` on, in steps of about ``per_step``."""
    ends = np.cumsum(count)
    at = 0
    while at < len(count):
        base = int(ends[at - 1]) if at else 0
        last = max(at + 1, int(np.searchsorted(ends, base + per_step, "right")))
        n, own = count[at:last], np.arange(at, last)
        if count[at] > per_step:  # one edge beside very many: its run in steps of its own
            for a in range(0, int(count[at]), per_step):
                place = np.arange(a, min(a + per_step, int(count[at])))
                yield np.full(len(place), at), first[at] + place
            at += 1
            continue
        owner = np.repeat(own, n)
        yield owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at:last], n)
        at = last


class Ranges:
    """Pairs of ranges ``[lo, hi]`` of two lists that overlap, ends included, each once."""

    def __init__(self, lo_a, hi_a, lo_b, hi_b):
        self.order_a, self.order_b = np.argsort(lo_a, kind="stable"), np.argsort(lo_b, kind="stable")
        by_a, by_b = lo_a[self.order_a], lo_b[self.order_b]
        self.b_first = np.searchsorted(by_b, lo_a, "right")  # b begins after a began and before it ends
        self.b_count = np.maximum(np.searchsorted(by_b, hi_a, "right") - self.b_first, 0)
        self.a_first = np.searchsorted(by_a, lo_b, "left")  # a begins with b or later, before b ends
        self.a_count = np.maximum(np.searchsorted(by_a, hi_b, "right") - self.a_first, 0)

    def total(self) -> int:
        return int(self.b_count.sum() + self.a_count.sum())

    def pairs(self, per_step: int = PAIRS_PER_STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, place in _runs(self.b_first, self.b_count, per_step):
            yield a, self.order_b[place]
        for b, place in _runs(self.a_first, self.a_count, per_step):
            yield self.order_a[place], b


class Edges:
    """Edges of closed rings: end points, and per edge a weight that makes outer rings count +1 and holes -1 whatever way they turn."""

    def __init__(self, parts: list[list[np.ndarray]]):
        rings = [(ring, 1.0 if k == 0 else -1.0) for part in parts for k, ring in enumerate(part) if len(ring) > 1]
        none = np.zeros(0)
        self.x1 = np.concatenate([none, *(r[:-1, 0] for r, _ in rings)])
        self.y1 = np.concatenate([none, *(r[:-1, 1] for r, _ in rings)])
        self.x2 = np.concatenate([none, *(r[1:, 0] for r, _ in rings)])
        self.y2 = np.concatenate([none, *(r[1:, 1] for r, _ in rings)])
        self.weight = np.concatenate([none, *(np.full(len(r) - 1, w * _turn(r)) for r, w in rings)])

    def __len__(self) -> int:
        return len(self.x1)

    def take(self, keep: np.ndarray) -> Edges:
        out = object.__new__(Edges)
        for name in ("x1", "y1", "x2", "y2", "weight"):
            setattr(out, name, getattr(self, name)[keep])
        return out

    def turned(self) -> Edges:
        """The same with the axes exchanged; areas keep their sign."""
        out = object.__new__(Edges)
        out.x1, out.y1, out.x2, out.y2, out.weight = self.y1, self.x1, self.y2, self.x2, -self.weight
        return out

    def moved(self, x: float, y: float) -> Edges:
        out = object.__new__(Edges)
        out.x1, out.y1, out.x2, out.y2, out.weight = self.x1 - x, self.y1 - y, self.x2 - x, self.y2 - y, self.weight
        return out

    def extent(self) -> tuple[float, float, float, float]:
        return float(self.x1.min()), float(self.y1.min()), float(self.x1.max()), float(self.y1.max())


def _turn(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return -1.0 if (x[:-1] * y[1:] - x[1:] * y[:-1]).sum() < 0 else 1.0


def _shared_ranges(a: Edges, b: Edges) -> Ranges:
    return Ranges(np.minimum(a.x1, a.x2), np.maximum(a.x1, a.x2), np.minimum(b.x1, b.x2), np.maximum(b.x1, b.x2))


def _better_axis(a: Edges, b: Edges) -> tuple[Edges, Edges, Ranges]:
    flat, upright = _shared_ranges(a, b), _shared_ranges(a.turned(), b.turned())
    return (a, b, flat) if flat.total() <= upright.total() else (a.turned(), b.turned(), upright)


def overlap_area(a: Edges, b: Edges) -> float:
    """Area of the overlap, from edges inside the common extent (see ``clip_parts``), near the origin.

    A shape is the signed sum of the strips below its edges.  Two strips share the strip below the lower of both edges, over
    the range they have in common.
    """
    total = 0.0
    if not len(a) or not len(b):
        return total
    one, other, ranges = _better_axis(a, b)
    floor = min(one.y1.min(), one.y2.min(), other.y1.min(), other.y2.min())
    sides = []
    for e in (one, other):
        left = e.x1 <= e.x2
        sides.append((
            np.where(left, e.x1, e.x2), np.where(left, e.y1, e.y2) - floor, np.where(left, e.x2, e.x1), np.where(left, e.y2, e.y1) - floor,
            e.weight * np.where(left, -1.0, 1.0),
        ))
    (al, ay, ar, az, aw), (bl, by, br, bz, bw) = sides
    a_rise, b_rise = (az - ay) / np.where(ar > al, ar - al, 1.0), (bz - by) / np.where(br > bl, br - bl, 1.0)
    for i, j in ranges.pairs():
        lo, hi = np.maximum(al[i], bl[j]), np.minimum(ar[i], br[j])
        some = hi > lo
        i, j, lo, hi = i[some], j[some], lo[some], hi[some]
        wide = hi - lo
        p, q = ay[i] + a_rise[i] * (lo - al[i]), ay[i] + a_rise[i] * (hi - al[i])
        r, s = by[j] + b_rise[j] * (lo - bl[j]), by[j] + b_rise[j] * (hi - bl[j])
        before, after = p - r, q - s
        cross = before * after < 0
        share = np.where(cross, np.abs(before) / np.where(cross, np.abs(before) + np.abs(after), 1.0), 0.5)
        at_cross = p + (q - p) * share
        start, end = np.minimum(p, r), np.minimum(q, s)
        straight = (start + end) / 2
        bent = ((start + at_cross) * share + (at_cross + end) * (1 - share)) / 2
        total += float((np.where(cross, bent, straight) * wide * aw[i] * bw[j]).sum())
    return total


def any_contact(a: Edges, b: Edges, segments_meet) -> bool:
    """Whether an edge of one touches or crosses an edge of the other."""
    if not len(a) or not len(b):
        return False
    (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = a.extent(), b.extent()
    x0, y0, x1, y1 = max(ax0, bx0), max(ay0, by0), min(ax1, bx1), min(ay1, by1)

    def near(e: Edges) -> Edges:
        return e.take((np.maximum(e.x1, e.x2) >= x0) & (np.minimum(e.x1, e.x2) <= x1) & (np.maximum(e.y1, e.y2) >= y0) & (np.minimum(e.y1, e.y2) <= y1))

    a, b = near(a), near(b)
    if not len(a) or not len(b):
        return False
    a, b, ranges = _better_axis(a, b)
    for i, j in ranges.pairs():
        level = (np.minimum(a.y1[i], a.y2[i]) <= np.maximum(b.y1[j], b.y2[j])) & (np.minimum(b.y1[j], b.y2[j]) <= np.maximum(a.y1[i], a.y2[i]))
        i, j = i[level], j[level]
        if segments_meet(a.x1[i], a.y1[i], a.x2[i], a.y2[i], b.x1[j], b.y1[j], b.x2[j], b.y2[j]).any():
            return True
    return False


def ring_meets_itself(ring: np.ndarray, segments_meet) -> bool:
    """Whether edges of an open ring (the last point joins the first) meet that are no neighbours."""
    n = len(ring)
    e = Edges([[np.concatenate([ring, ring[:1]])]])
    turned = e.turned()
    flat, upright = _shared_ranges(e, e), _shared_ranges(turned, turned)
    e, ranges = (e, flat) if flat.total() <= upright.total() else (turned, upright)
    for i, j in ranges.pairs():
        gap = np.abs(i - j)
        apart = (gap > 1) & (gap < n - 1)
        i, j = i[apart], j[apart]
        if segments_meet(e.x1[i], e.y1[i], e.x2[i], e.y2[i], e.x1[j], e.y1[j], e.x2[j], e.y2[j]).any():
            return True
    return False


def crossings_right(px: float, py: float, e: Edges) -> int:
    """How many edges the ray from a point to the right crosses; odd inside."""
    straddles = (e.y1 > py) != (e.y2 > py)
    x1, y1, x2, y2 = e.x1[straddles], e.y1[straddles], e.x2[straddles], e.y2[straddles]
    return int((px < x1 + (py - y1) / (y2 - y1) * (x2 - x1)).sum())
