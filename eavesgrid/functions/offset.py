"""Clean-up of offset curves: a moved ring that crosses itself becomes the outlines of what it really covers.

Edges are split where they meet (pairs from the sweep).  Between two such places the winding number on either side of a ring is the same
all along, so one point for each stretch is enough.  Stretches with covered ground on the left only are outline; they are joined to
rings at their ends.  Ground is covered where the ring winds around it counter-clockwise.  That is right for rings whose edges keep their length and are
joined through the corner they came from where they overlap: such a ring winds once around the shape, once more for each edge that sweeps over
a place on its way out, and once less for each on its way in.
"""

from __future__ import annotations

import numpy as np

from . import sweep

NEAR = 1e-9  # of the extent: places closer than this are one
POINTS_PER_STEP = 1 << 20
PAIRS_PER_STEP = 1 << 17  # pairs of edges, or of pieces, looked at together


def _splits(pts: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """``(edge, position along it)`` of the places, ends left out, where edges of the open ring meet other edges."""
    nxt = np.roll(pts, -1, 0)
    e = sweep.Edges([[np.concatenate([pts, pts[:1]])]])
    turned = e.turned()
    flat, upright = sweep._shared_ranges(e, e), sweep._shared_ranges(turned, turned)
    edges, at = [np.zeros(0, np.int64)], [np.zeros(0)]
    for i, j in (flat if flat.total() <= upright.total() else upright).pairs():
        i, j = i[i != j], j[i != j]
        a, b, c, d = pts[i], nxt[i], pts[j], nxt[j]
        near = ((np.minimum(a, b) <= np.maximum(c, d) + tolerance) & (np.minimum(c, d) <= np.maximum(a, b) + tolerance)).all(1)
        i, j, a, b, c, d = i[near], j[near], a[near], b[near], c[near], d[near]
        u, v, w = b - a, d - c, c - a
        cross = u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]
        length, other = np.hypot(u[:, 0], u[:, 1]), np.hypot(v[:, 0], v[:, 1])
        plain = np.abs(cross) > 1e-12 * length * other
        safe = np.where(plain, cross, 1.0)
        s, t = (w[:, 0] * v[:, 1] - w[:, 1] * v[:, 0]) / safe, (w[:, 0] * u[:, 1] - w[:, 1] * u[:, 0]) / safe
        hit = plain & (s >= 0) & (s <= 1) & (t >= 0) & (t <= 1)
        edges += [i[hit], j[hit]]
        at += [s[hit], t[hit]]
        for point, rest, size, edge in ((c, a, length, i), (d, a, length, i), (a, c, other, j), (b, c, other, j)):
            way = (u if edge is i else v) / np.where(size == 0, 1.0, size)[:, None]
            off = point - rest
            along, beside = (off * way).sum(1), np.abs(off[:, 0] * way[:, 1] - off[:, 1] * way[:, 0])
            on = (beside <= tolerance) & (along > tolerance) & (along < size - tolerance)  # ends that lie on the other edge
            edges.append(edge[on])
            at.append(along[on] / size[on])
    edges, at = np.concatenate(edges), np.concatenate(at)
    size = np.hypot(*(nxt - pts).T)[edges]
    inner = (at * size > tolerance) & ((1 - at) * size > tolerance)
    return edges[inner], at[inner]


def _winding(px: np.ndarray, py: np.ndarray, pts: np.ndarray) -> np.ndarray:
    """How often the ring goes counter-clockwise around each point."""
    x1, y1 = pts[:, 0], pts[:, 1]
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    out = np.zeros(len(px), np.int64)
    step = max(1, POINTS_PER_STEP // max(len(pts), 1))
    rise = np.where(y1 == y2, 1.0, y2 - y1)
    for k in range(0, len(px), step):
        x, y = px[k : k + step, None], py[k : k + step, None]
        up, down = (y1 <= y) & (y2 > y), (y1 > y) & (y2 <= y)
        right = x1 + (y - y1) / rise * (x2 - x1) > x
        out[k : k + step] = (up & right).sum(1) - (down & right).sum(1)
    return out


def outlines(ring: np.ndarray) -> list[list[np.ndarray]]:
    """Parts (outer ring, then holes, all open) of what an open ring covers."""
    origin = ring[0]
    pts = ring - origin
    extent = float(np.abs(pts).max())
    tolerance = NEAR * max(extent, 1e-300)
    edge, at = _splits(pts, tolerance)
    n = len(pts)
    # every edge as its pieces, in order
    all_edge, all_at = np.concatenate([np.arange(n), edge]), np.concatenate([np.zeros(n), at])
    order = np.lexsort([all_at, all_edge])
    all_edge, all_at = all_edge[order], all_at[order]
    start = pts[all_edge] + all_at[:, None] * (np.roll(pts, -1, 0) - pts)[all_edge]
    node = _nodes(start, tolerance)
    end_node = np.roll(node, -1)
    real = node != end_node
    node, end_node, start = node[real], end_node[real], start[real]
    place = np.zeros((int(node.max()) + 1, 2)) if len(node) else np.zeros((0, 2))
    place[node] = start
    a, b = place[node], place[end_node]
    # stretches between nodes where more than two pieces meet
    busy = np.bincount(np.concatenate([node, end_node]), minlength=len(place)) > 2
    head = busy[node].copy()
    if len(head):
        head[0] = True
    stretch = np.cumsum(head) - 1
    size = np.hypot(*(b - a).T)
    first = np.lexsort([-size, stretch])
    pick = first[np.concatenate([[True], np.diff(stretch[first]) > 0])] if len(first) else first  # the longest piece of each
    way = (b - a)[pick] / size[pick][:, None]
    middle = (a + b)[pick] / 2
    aside = np.column_stack([-way[:, 1], way[:, 0]]) * (4 * tolerance)
    left, right = (_winding(*(middle + k * aside).T, pts) for k in (1, -1))
    outline = ((left > 0) & (right <= 0))[stretch]
    node, end_node, a, b = node[outline], end_node[outline], a[outline], b[outline]
    _, once = np.unique(np.column_stack([node, end_node]), axis=0, return_index=True)  # pieces that lie on each other
    rings = _rings(node[once], end_node[once], (b - a)[once], place)
    return [[r + origin for r in part] for part in _parts(rings)]


def _nodes(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Numbers of places; points within the tolerance share one."""
    grid = np.round(points / (4 * tolerance)).astype(np.int64)
    found: dict[tuple[int, int], int] = {}
    out = np.empty(len(points), np.int64)
    for k, (x, y) in enumerate(grid.tolist()):
        known = next((found[(x + i, y + j)] for i in (0, -1, 1) for j in (0, -1, 1) if (x + i, y + j) in found), None)
        out[k] = found.setdefault((x, y), len(found)) if known is None else known
    _, out = np.unique(out, return_inverse=True)
    return out


def _rings(start: np.ndarray, end: np.ndarray, way: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    """Pieces joined end to start; where several go on, the one that turns most to the left, so that rings touch but never cross."""
    leaving: dict[int, list[int]] = {}
    for k, s in enumerate(start.tolist()):
        leaving.setdefault(s, []).append(k)
    angle, used, out = np.arctan2(way[:, 1], way[:, 0]), np.zeros(len(start), bool), []
    for k in range(len(start)):
        if used[k]:
            continue
        path, here = [], k
        while not used[here]:
            used[here] = True
            path.append(here)
            go_on = [m for m in leaving.get(int(end[here]), ()) if not used[m]]
            if not go_on:
                break
            back = angle[here] + np.pi
            here = max(go_on, key=lambda m: (angle[m] - back) % (2 * np.pi))
        if int(end[path[-1]]) == int(start[path[0]]) and len(path) > 2:
            out.append(place[start[path]])
    return out


def _parts(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Outer rings (counter-clockwise) with the holes that lie in them."""

    def area(r: np.ndarray) -> float:
        x, y = r[:, 0], r[:, 1]
        return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)

    areas = [area(r) for r in rings]
    outer = sorted((k for k, s in enumerate(areas) if s > 0), key=lambda k: areas[k])
    parts = {k: [rings[k]] for k in outer}
    for k, s in enumerate(areas):
        if s < 0:
            middle = (rings[k][:1] + rings[k][1:2]) / 2
            owner = next((o for o in outer if areas[o] >= -s and _winding(middle[:, 0], middle[:, 1], rings[o])[0] > 0), None)
            if owner is not None:
                parts[owner].append(rings[k])
    return [parts[k] for k in sorted(parts)]


# ---------------------------------------------------------------- many short rings at once


def outlines_together(rings: np.ndarray) -> list[np.ndarray | None]:
    """``outlines`` of open rings of equal length (rows x points x 2) whose outline is one ring; None for the others, which need ``outlines``.

    The same steps on arrays of all rings.  Left to the other way are outlines of several rings or none, outlines that touch themselves, places that
    are neither one nor apart, and rings cut into very many pieces.
    """
    n, out = rings.shape[1], []
    step = max(1, PAIRS_PER_STEP // (n * n))
    for k in range(0, len(rings), step):
        out += _outlines_step(rings[k : k + step])
    return out


def _splits_together(pts: np.ndarray, nxt: np.ndarray, tolerance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, edge, position along it)``, as ``_splits`` finds them."""
    lo, hi = np.minimum(pts, nxt), np.maximum(pts, nxt) + tolerance[:, None, None]
    i, j = np.triu_indices(pts.shape[1], 1)
    row, pair = np.nonzero(((lo[:, i] <= hi[:, j]) & (lo[:, j] <= hi[:, i])).all(2))
    i, j, near = i[pair], j[pair], tolerance[row]
    a, b, c, d = pts[row, i], nxt[row, i], pts[row, j], nxt[row, j]
    u, v, w = b - a, d - c, c - a
    cross = u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]
    length, other = np.hypot(u[:, 0], u[:, 1]), np.hypot(v[:, 0], v[:, 1])
    plain = np.abs(cross) > 1e-12 * length * other
    safe = np.where(plain, cross, 1.0)
    s, t = (w[:, 0] * v[:, 1] - w[:, 1] * v[:, 0]) / safe, (w[:, 0] * u[:, 1] - w[:, 1] * u[:, 0]) / safe
    hit = plain & (s >= 0) & (s <= 1) & (t >= 0) & (t <= 1)
    rows, edges, at, sizes = [row[hit], row[hit]], [i[hit], j[hit]], [s[hit], t[hit]], [length[hit], other[hit]]
    for point, rest, size, edge, along_edge in ((c, a, length, i, u), (d, a, length, i, u), (a, c, other, j, v), (b, c, other, j, v)):
        way = along_edge / np.where(size == 0, 1.0, size)[:, None]
        off = point - rest
        along, beside = (off * way).sum(1), np.abs(off[:, 0] * way[:, 1] - off[:, 1] * way[:, 0])
        on = (beside <= near) & (along > near) & (along < size - near)
        rows.append(row[on])
        edges.append(edge[on])
        at.append(along[on] / size[on])
        sizes.append(size[on])
    row, edge, at, size = (np.concatenate(x) for x in (rows, edges, at, sizes))
    inner = (at * size > tolerance[row]) & ((1 - at) * size > tolerance[row])
    return row[inner], edge[inner], at[inner]


def _winding_each(px: np.ndarray, py: np.ndarray, pts: np.ndarray) -> np.ndarray:
    """``_winding`` of one point around each ring."""
    x1, y1 = pts[:, :, 0], pts[:, :, 1]
    x2, y2 = np.roll(x1, -1, 1), np.roll(y1, -1, 1)
    x, y = px[:, None], py[:, None]
    up, down = (y1 <= y) & (y2 > y), (y1 > y) & (y2 <= y)
    right = x1 + (y - y1) / np.where(y1 == y2, 1.0, y2 - y1) * (x2 - x1) > x
    return (up & right).sum(1) - (down & right).sum(1)


def _outlines_step(rings: np.ndarray) -> list[np.ndarray | None]:
    count, n = rings.shape[:2]
    origin = rings[:, :1]
    pts = rings - origin
    nxt = np.roll(pts, -1, 1)
    tolerance = NEAR * np.maximum(np.abs(pts).max((1, 2)), 1e-300)
    row, edge, at = _splits_together(pts, nxt, tolerance)
    ok = np.bincount(row, minlength=count) <= 2 * n
    known = ok[row]
    # every edge as its pieces, in order, at the same places of a table with a line for each ring
    row = np.concatenate([np.repeat(np.arange(count), n), row[known]])
    edge, at = np.concatenate([np.tile(np.arange(n), count), edge[known]]), np.concatenate([np.zeros(count * n), at[known]])
    order = np.lexsort([at, edge, row])
    row, edge, at = row[order], edge[order], at[order]
    pieces = np.bincount(row, minlength=count)
    width = int(pieces.max())
    col = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start, there, after = np.zeros((count, width, 2)), np.zeros((count, width), bool), np.zeros((count, width), np.int64)
    start[row, col] = pts[row, edge] + at[:, None] * (nxt - pts)[row, edge]
    there[row, col] = True
    after[row, col] = np.where(col + 1 < pieces[row], col + 1, 0)
    # places: pieces whose starts fall into one small square; squares side by side are left to the other way
    grid = np.round(start / (4 * tolerance)[:, None, None]).astype(np.int64)
    across, along = (np.abs(g[:, :, None] - g[:, None]) for g in (grid[:, :, 0], grid[:, :, 1]))
    both = there[:, :, None] & there[:, None]
    one = both & (across + along == 0)
    ok &= (both & (across <= 1) & (along <= 1)).sum((1, 2)) == one.sum((1, 2))
    node = one.argmax(2)
    end_node = np.take_along_axis(node, after, 1)
    real = there & (node != end_node)
    line = np.arange(count)[:, None] * width
    met = np.bincount((line + node)[real], minlength=count * width) + np.bincount((line + end_node)[real], minlength=count * width)
    head = real & (met.reshape(count, width)[np.arange(count)[:, None], node] > 2)
    begin = real.argmax(1)
    head[np.arange(count), begin] |= real[np.arange(count), begin]
    stretch = line + np.cumsum(head, 1) - 1
    row, col = np.nonzero(real)
    node, end_node, stretch = node[row, col], end_node[row, col], stretch[row, col]
    place = np.zeros((count, width, 2))
    place[row, node] = start[row, col]
    a, b = place[row, node], place[row, end_node]
    size = np.hypot(*(b - a).T)
    first = np.lexsort([-size, stretch])
    pick = first[np.concatenate([[True], np.diff(stretch[first]) > 0])] if len(first) else first
    way = (b - a)[pick] / size[pick][:, None]
    middle = (a + b)[pick] / 2
    aside = np.column_stack([-way[:, 1], way[:, 0]]) * (4 * tolerance[row[pick]])[:, None]
    left, right = (_winding_each(*(middle + k * aside).T, pts[row[pick]]) for k in (1, -1))
    outside = np.zeros(count * width, bool)
    outside[stretch[pick]] = (left > 0) & (right <= 0)
    outline = outside[stretch]
    row, node, end_node = row[outline], node[outline], end_node[outline]
    _, once = np.unique((row * width + node) * width + end_node, return_index=True)  # pieces that lie on each other
    row, node, end_node = row[once], node[once], end_node[once]
    # one way on from each place, round to the beginning through all pieces
    length = np.bincount(row, minlength=count)
    leaving, coming = (np.bincount(row * width + k, minlength=count * width).reshape(count, width) for k in (node, end_node))
    ok &= (length > 2) & (leaving == coming).all(1) & (leaving <= 1).all(1)
    follow = np.zeros((count, width), np.int64)
    follow[row, node] = end_node
    begin = (leaving > 0).argmax(1)
    path = np.zeros((count, int(length.max(initial=1)) + 1), np.int64)
    path[:, 0] = begin
    for k in range(1, path.shape[1]):
        path[:, k] = follow[np.arange(count), path[:, k - 1]]
    back = (path[:, 1:] == begin[:, None]).argmax(1) + 1
    ok &= back == length
    found: list[np.ndarray | None] = [None] * count
    for r in np.flatnonzero(ok):
        ring = place[r, path[r, : length[r]]]
        x, y = ring[:, 0], ring[:, 1]
        if (x[:-1] * y[1:] - x[1:] * y[:-1]).sum() + x[-1] * y[0] - x[0] * y[-1] > 0:
            found[r] = ring + origin[r]
    return found
