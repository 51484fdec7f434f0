"""The sweep kernels against all pairs of edges, and on rings of 20,000 points."""

import resource
import time

import numpy as np
import pytest

from eavesgrid.functions import kernels as K
from eavesgrid.functions import sweep


def star(rng, n, x=0.0, y=0.0, size=10.0):
    """A simple ring: points at growing angles and random distances."""
    angle = np.sort(rng.random(n)) * 2 * np.pi
    far = size * (0.4 + 0.6 * rng.random(n))
    ring = np.column_stack([x + far * np.cos(angle), y + far * np.sin(angle)])
    return np.concatenate([ring, ring[:1]])


def both(monkeypatch, run):
    """Results of the batch kernels with every row swept and with none."""
    out = []
    for heavy in (-1, 1 << 60):
        monkeypatch.setattr(K, "HEAVY", heavy)
        out.append(run())
    return out


def test_overlap_equals_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    a, b = [], []
    for _ in range(60):
        hole = star(rng, 9, size=3.0)
        a.append([[star(rng, int(rng.integers(3, 40))), hole[::-1]]] if rng.random() < 0.5 else [[star(rng, 12)], [star(rng, 7, 25, 0)]])
        b.append([[star(rng, int(rng.integers(3, 40)), *rng.normal(0, 8, 2))]])
    square = np.array([[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], float)
    for other in (square, square + [4, 0], square + [2, 0], square[::-1], square * 0.5, square + [4, 4], square + [9, 9]):
        a.append([[square]])
        b.append([[other]])
    one, other = K._to_arrow(a), K._to_arrow(b)
    swept, plain = both(monkeypatch, lambda: K.overlap_area_batch(one, other))
    np.testing.assert_allclose(swept, plain, atol=1e-9)
    swept, plain = both(monkeypatch, lambda: K.intersects_batch(one, other))
    assert swept.tolist() == plain.tolist()


def test_contact_at_points_and_sides(monkeypatch):
    square = np.array([[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]], float)
    cases = {"corner": square + [4, 4], "side": square + [4, 0], "inside": square * 0.25 + 1, "apart": square + [4.001, 0], "around": square * 3 - 2}
    one, other = K._to_arrow([[[square]]] * len(cases)), K._to_arrow([[[c]] for c in cases.values()])
    swept, plain = both(monkeypatch, lambda: K.intersects_batch(one, other))
    assert swept.tolist() == plain.tolist() == [True, True, True, False, True]


@pytest.mark.parametrize("n", [2, 5, 40])
def test_ranges_give_each_pair_once(n):
    rng = np.random.default_rng(n)
    lo_a, lo_b = rng.integers(0, 12, n), rng.integers(0, 12, n + 3)
    hi_a, hi_b = lo_a + rng.integers(0, 4, n), lo_b + rng.integers(0, 4, n + 3)
    got = [(int(i), int(j)) for a, b in sweep.Ranges(lo_a, hi_a, lo_b, hi_b).pairs(per_step=3) for i, j in zip(a, b)]
    want = {(i, j) for i in range(n) for j in range(n + 3) if lo_a[i] <= hi_b[j] and lo_b[j] <= hi_a[i]}
    assert len(got) == len(set(got)) and set(got) == want


def test_self_crossing():
    bow = np.array([[0, 0], [2, 2], [2, 0], [0, 2]], float)
    assert K._self_crossing(bow) and not K._self_crossing(np.array([[0, 0], [2, 0], [2, 2], [0, 2]], float))
    ring = star(np.random.default_rng(1), 3000)[:-1]
    assert not K._self_crossing(ring)
    ring[[10, 1500]] = ring[[1500, 10]]
    assert K._self_crossing(ring)


def test_large_rings_in_bounded_time_and_memory():
    rng = np.random.default_rng(5)
    a, b = star(rng, 20_000, 650_000, 6_860_000, 500.0), star(rng, 20_000, 650_120, 6_860_080, 500.0)
    one, other = K._to_arrow([[[a]]]), K._to_arrow([[[b]]])
    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.thread_time()
    area = K.overlap_area_batch(one, other)[0]
    apart = K.intersects_batch(one, K._to_arrow([[[b + [2000.0, 0]]]]))[0]
    assert K.intersects_batch(one, other)[0] and not apart
    assert time.thread_time() - start < 4 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000
    # the area by counting lines: lengths of the overlap along many horizontals
    grid = np.linspace(6_859_400, 6_860_700, 4001)

    def spans(ring, y):
        p, q = ring[:-1], ring[1:]
        cut = (p[:, 1] > y) != (q[:, 1] > y)
        p, q = p[cut], q[cut]
        return np.sort(p[:, 0] + (y - p[:, 1]) / (q[:, 1] - p[:, 1]) * (q[:, 0] - p[:, 0]))

    total = 0.0
    for y in grid:
        s, t = spans(a, y), spans(b, y)
        marks = np.sort(np.concatenate([s, t]))
        mid = (marks[1:] + marks[:-1]) / 2
        inside = (np.searchsorted(s, mid) % 2 == 1) & (np.searchsorted(t, mid) % 2 == 1)
        total += float((np.diff(marks) * inside).sum())
    assert area == pytest.approx(total * (grid[1] - grid[0]), rel=2e-2)


def test_box_of_a_round_shape():
    angle = np.linspace(0, 2 * np.pi, 5001)[:-1]
    box = K.min_rotated_box(np.column_stack([3 * np.cos(angle), 2 * np.sin(angle)]))
    sides = sorted(np.hypot(*(box[1] - box[0])) for box in (box, np.roll(box, -1, 0)))
    assert sides == pytest.approx([4, 6], rel=1e-4)


def test_strips_far_out_and_nearly_upright():
    far = np.array([7e5 + 0.1, 6.6e6])
    leaning = np.array([[0, 0], [4, 0], [4 + 1e-9, 4], [1e-9, 4], [0, 0]])
    other = np.array([[1.0, 1], [9, 1], [9, 3], [1, 3], [1, 1]])
    for ring in (leaning, leaning[::-1]):
        got = K.overlap_area_batch(K._to_arrow([[[ring + far]], [[ring]], None]), K._to_arrow([[[other + far]], [[other]], [[other]]]))
        assert got[:2] == pytest.approx(6.0, abs=1e-7) and np.isnan(got[2])


def test_cut_up_shapes_keep_their_area_in_small_pieces():
    turn = np.linspace(0, 2 * np.pi, 4001)
    ring = np.column_stack([np.cos(turn), np.sin(turn)]) * (100 + 20 * np.cos(9 * turn))[:, None] + [7e5, 6.6e6]
    ring[-1] = ring[0]
    found = list(K.cut_up([[ring]], 200, 1e-6))
    area = [sum(K.sweep._turn(r) * 0.5 * ((r[:-1, 0] - x0) * (r[1:, 1] - y0) - (r[1:, 0] - x0) * (r[:-1, 1] - y0)).sum() for part in parts for r in part)
            for (x0, y0, _, _), parts in found]
    whole = ring - ring[0]
    assert sum(area) == pytest.approx(0.5 * (whole[:-1, 0] * whole[1:, 1] - whole[1:, 0] * whole[:-1, 1]).sum(), rel=1e-9)
    assert 20 < len(found) < 200 and max(sum(len(r) for part in parts for r in part) for _, parts in found) <= 200
    assert any(K.is_rectangle(*piece) for piece in found)
