import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eavesgrid.functions import geometry as G
from eavesgrid.functions import kernels as K, offset
from eavesgrid.functions.projection import lambert93_xy, reproject_lambert93
from eavesgrid.operators import preprocessing as P
from eavesgrid.sources.layers import finish_layer, read_layer, same_srid, srid_of
from shapes import HOLED, L_SHAPE, TRIANGLE, convex_overlap, general, layer, poly, rect, rotate, square

TYPE = K._GEOM_ARROW


def arrow(*geoms):
    return pa.array(
        [None if g is None else [[[{"x": x, "y": y} for x, y in r] for r in part] for part in g] for g in geoms], type=TYPE
    )


def overlap(a, b):
    return K.overlap_area_batch(arrow(a), arrow(b))[0]


def meets(a, b):
    return bool(K.intersects_batch(arrow(a), arrow(b))[0])


AWAY = poly(square(50, 50, 1))


@pytest.mark.parametrize(
    "a, b, area, touch",
    [
        (TRIANGLE, poly(square(0, 0, 2)), 4.0, True),
        (TRIANGLE, poly(square(2, 2, 3)), 0.0, True),  # corner on the long side
        (L_SHAPE, poly(square(1, 1, 2)), 3.0, True),
        (L_SHAPE, poly(square(2, 2, 2)), 0.0, True),  # in the notch, two shared sides
        (L_SHAPE, poly(square(2.5, 2.5, 1)), 0.0, False),  # in the notch, no contact
        (HOLED, poly(square(4, 4, 2)), 0.0, False),  # wholly inside the hole
        (HOLED, poly(square(3, 3, 4)), 0.0, True),  # fills the hole exactly
        (HOLED, poly(square(2, 2, 6)), 36 - 16.0, True),
        (HOLED, poly(square(-5, -5, 30)), 84.0, True),
        (poly(square(0, 0, 2)), poly(square(2, 0, 2)), 0.0, True),  # shared edge
        (poly(square(0, 0, 2)), poly(square(2, 2, 2)), 0.0, True),  # shared corner
        (poly(square(0, 0, 2)), poly(square(0, 0, 2)), 4.0, True),  # identical
        (poly(square(0, 0, 8)), poly(square(2, 2, 2)), 4.0, True),  # containment
        (poly(square(0, 0, 4)), poly(rect(2, 0, 4, 4)), 8.0, True),  # collinear sides
        (poly(square(0, 0, 2)), AWAY, 0.0, False),
        (poly(rect(0, 3, 10, 1)), poly(rect(4, 0, 1, 10)), 1.0, True),  # cross, no vertex inside the other
        (poly(square(0, 0, 4)[::-1]), poly(square(2, 2, 4)), 4.0, True),  # clockwise ring
    ],
)
def test_overlap_and_contact(a, b, area, touch):
    assert overlap(a, b) == pytest.approx(area, abs=1e-9)
    assert overlap(b, a) == pytest.approx(area, abs=1e-9)
    assert meets(a, b) is touch and meets(b, a) is touch


def test_null_geometry_gives_null():
    assert math.isnan(K.overlap_area_batch(arrow(None, TRIANGLE), arrow(TRIANGLE, TRIANGLE))[0])
    assert K.overlap_area_batch(arrow(None, TRIANGLE), arrow(TRIANGLE, TRIANGLE))[1] == pytest.approx(8)


def test_multipart_overlap():
    two = [poly(square(0, 0, 2))[0], poly(square(10, 0, 2))[0]]
    assert overlap(two, poly(rect(1, 0, 10, 2))) == pytest.approx(4)


def test_large_coordinates_keep_small_overlaps():
    a = poly([(x + 652000, y + 6862000) for x, y in square(0, 0, 2)])
    b = poly([(x + 652000, y + 6862000) for x, y in square(1.999, 0, 2)])
    assert overlap(a, b) == pytest.approx(0.002, abs=1e-6)


angles = st.lists(st.integers(0, 359), min_size=3, max_size=9, unique=True)
spot = st.floats(-3, 3, allow_nan=False)


@settings(max_examples=150, deadline=None)
@given(angles, angles, spot, spot, st.floats(0.5, 3), st.floats(0.5, 3))
def test_overlap_of_convex_polygons(one, two, dx, dy, ra, rb):
    def ring(degs, cx, cy, r):
        return [(cx + r * math.cos(math.radians(d)), cy + r * math.sin(math.radians(d))) for d in sorted(degs)]

    a, b = ring(one, 0, 0, ra), ring(two, dx, dy, rb)
    want = convex_overlap(a, b)
    got = overlap(poly(a), poly(b))
    assert got == pytest.approx(want, abs=1e-9)
    if want > 1e-6:
        assert meets(poly(a), poly(b))
    clip = K.clip_area_batch(arrow(poly(b)), [-1.0], [-1.0], [1.0], [1.0])[0]
    assert clip == pytest.approx(convex_overlap(square(-1, -1, 2), b), abs=1e-9)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), min_size=3, max_size=15, unique=True))
def test_min_rotated_box_contains_all_and_is_no_larger_than_the_bbox(points):
    pts = np.array(points, float)
    box = K.min_rotated_box(pts)
    u, v = box[1] - box[0], box[3] - box[0]
    area = abs(u[0] * v[1] - u[1] * v[0])
    assert area <= np.prod(np.ptp(pts, axis=0)) + 1e-6
    for a, b in zip(box, np.roll(box, -1, 0)):
        side = (b[0] - a[0]) * (pts[:, 1] - a[1]) - (b[1] - a[1]) * (pts[:, 0] - a[0])
        assert (side >= -1e-6).all()


def test_min_rotated_box_of_a_turned_rectangle():
    box = K.min_rotated_box(np.array(rotate(rect(0, 0, 6, 2), 30)))
    sides = sorted(np.hypot(*(box[i + 1] - box[i])) for i in (0, 1))
    assert sides == pytest.approx([2, 6])


@pytest.mark.parametrize("turn", [0, 17, 45, 88])
def test_buffer_of_a_rectangle(turn):
    ((new,),) = K.offset_ring(np.array([*rotate(rect(0, 0, 6, 2), turn), rotate(rect(0, 0, 6, 2), turn)[0]]), 1.5)
    area = abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(new, np.roll(new, -1, 0)))) / 2
    assert area == pytest.approx(9 * 5)


def test_buffer_cuts_sharp_corners_and_closes_gaps():
    ((sharp,),) = K.offset_ring(np.array([(0, 0), (10, 0), (0, 1), (0, 0)], float), 1.0)
    assert len(sharp) == 4 and sharp[:, 0].max() < 10 + 2 + 0.2
    slot = np.array([(0, 0), (10, 0), (10, 10), (5.5, 10), (5.5, 2), (4.5, 2), (4.5, 10), (0, 10), (0, 0)], float)
    assert areas_of(K.offset_ring(slot, 2.0)) == [[pytest.approx(14 * 14)]]
    assert areas_of(K.offset_ring(slot, 0.25)) == [[pytest.approx(10.5 * 10.5 - 0.5 * 8)]]
    assert areas_of(K.offset_ring(slot, 0.5)) == [[pytest.approx(11 * 11)]]  # the sides of the gap just meet


def shoelace(ring):
    x, y = ring[:, 0], ring[:, 1]
    return abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2


def areas_of(parts):
    return [[shoelace(ring) for ring in part] for part in parts]


def test_closed_courts_and_shapes_that_fall_apart():
    court = np.array([(0, 0), (20, 0), (20, 20), (11, 20), (11, 15), (15, 15), (15, 5), (5, 5), (5, 15), (9, 15), (9, 20), (0, 20), (0, 0)], float)
    assert areas_of(K.offset_ring(court, 1.5)) == [[pytest.approx(23 * 23), pytest.approx(7 * 7)]]  # the gate closes, the court stays
    assert areas_of(K.offset_ring(court, 6.0)) == [[pytest.approx(32 * 32)]]
    dumbbell = np.array([(0, 0), (6, 0), (6, 2), (12, 2), (12, 0), (18, 0), (18, 6), (12, 6), (12, 4), (6, 4), (6, 6), (0, 6), (0, 0)], float)
    assert sorted(areas_of(K.offset_ring(dumbbell, -1.5))) == [[pytest.approx(9)], [pytest.approx(9)]]
    assert K.offset_ring(dumbbell, -3.0) == [] and areas_of(K.offset_ring(dumbbell[::-1], 0)) == [[pytest.approx(36 + 36 + 12)]]


FARTHEST = math.hypot(K.MITRE_LIMIT, 1)  # of a square cut from its corner, in distances


@pytest.mark.parametrize("distance", [-0.8, -0.2, 0.3, 1.0, 3.0])
def test_buffers_against_counted_cells(distance):
    """Concave rings: covered is what lies within the distance of the shape, but for the corners, which a mitre makes larger."""
    rng = np.random.default_rng(11)
    for _ in range(12):
        n = int(rng.integers(5, 40))
        angle, far = np.sort(rng.random(n)) * 2 * np.pi, 4 + 6 * rng.random(n)
        ring = np.column_stack([far * np.cos(angle), far * np.sin(angle)])
        ring = np.concatenate([ring, ring[:1]])
        parts = K.offset_ring(ring, distance)
        x, y = (g.ravel() for g in np.meshgrid(np.arange(-18, 18, 0.22) + 0.013, np.arange(-18, 18, 0.22) + 0.017))
        covered = sum((sum(offset._winding(x, y, r) for r in part) > 0).astype(int) for part in parts) if parts else np.zeros(len(x), int)
        p, q = ring[:-1], ring[1:]
        along = np.clip(((x[:, None] - p[:, 0]) * (q - p)[:, 0] + (y[:, None] - p[:, 1]) * (q - p)[:, 1]) / ((q - p) ** 2).sum(1), 0, 1)
        gap = np.hypot(x[:, None] - p[:, 0] - along * (q - p)[:, 0], y[:, None] - p[:, 1] - along * (q - p)[:, 1]).min(1)
        inside = offset._winding(x, y, ring[:-1]) > 0
        signed = np.where(inside, -gap, gap)
        assert covered.max(initial=0) <= 1  # parts don't overlap
        if distance > 0:
            assert covered[signed < distance - 1e-6].all() and not covered[signed > FARTHEST * distance + 1e-6].any()
        else:
            assert not covered[signed > distance + 1e-6].any() and covered[signed < FARTHEST * distance - 1e-6].all()
        assert all(not K._self_crossing(r) or len(r) > 3 for part in parts for r in part)


def test_clean_up_of_long_rings_is_linear_in_memory():
    angle = np.linspace(0, 2 * np.pi, 8001)
    ring = np.column_stack([(300 + 20 * np.cos(40 * angle)) * np.cos(angle), (300 + 20 * np.cos(40 * angle)) * np.sin(angle)])
    ring[-1] = ring[0]
    parts = K.offset_ring(ring, 25.0)
    assert len(parts) == 1 and 345 ** 2 * np.pi * 0.8 < shoelace(parts[0][0]) < 346 ** 2 * np.pi


def test_buffer_of_holes(spark):
    df = layer(spark, [("h", HOLED), ("s", poly(square(0, 0, 4))), ("t", TRIANGLE)])
    rows = {r["id"]: r for r in P.compute_area(P.add_buffer_distance(df, 1)).collect()}
    assert rows["h"]["area"] == pytest.approx(144 - 4) and rows["h"]["buffer_simple"]
    assert rows["s"]["area"] == pytest.approx(36)
    assert rows["t"]["area"] > 8
    gone = {r["id"]: r for r in P.compute_area(P.add_buffer_distance(df, -3)).collect()}
    assert gone["s"]["area"] == 0 and len(gone["s"]["geom"]) == 0
    closed = {r["id"]: r for r in P.compute_area(P.add_buffer_distance(df, 2.5)).collect()}
    assert closed["h"]["area"] == pytest.approx(15 * 15)


def test_area_and_centroid(spark):
    two = [poly(square(0, 0, 2))[0], poly(square(10, 0, 2))[0]]
    rows = [("t", TRIANGLE), ("l", L_SHAPE), ("h", HOLED), ("2", two), ("r", poly(square(0, 0, 2)[::-1]))]
    df = P.compute_area(layer(spark, rows)).withColumn("c", G.centroid(F.col("geom")))
    got = {r["id"]: (r["area"], r["c"]["x"], r["c"]["y"]) for r in df.collect()}
    assert got["t"] == pytest.approx((8, 4 / 3, 4 / 3))
    assert got["l"] == pytest.approx((12, 5 / 3, 5 / 3))
    assert got["h"] == pytest.approx((84, 5, 5))
    assert got["2"] == pytest.approx((8, 6, 1))
    assert got["r"] == pytest.approx((4, 1, 1))


def test_box_flag(spark):
    rows = [("b", poly(square(0, 0, 2))), ("t", TRIANGLE), ("h", HOLED), ("d", poly(rotate(square(0, 0, 2), 45)))]
    rows.append(("x", [[[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]]]))
    flags = {r["id"]: r["is_box"] for r in layer(spark, rows).collect()}
    assert flags == {"b": True, "t": False, "h": False, "d": False, "x": False}


def test_native_and_kernel_agree(spark):
    df = layer(spark, [("a", poly(square(0, 0, 4)))])
    for frame in (df, general(df)):
        grown = P.compute_area(P.add_buffer_distance(frame, 2)).first()
        assert grown["area"] == pytest.approx(64)
        box = frame.select(G.area(K.min_rotated_rect()).alias("a")).first()
        assert box["a"] == pytest.approx(16)


def test_lambert93_origin(spark):
    x, y = lambert93_xy(F.lit(3.0), F.lit(46.5))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert (row["x"], row["y"]) == pytest.approx((700000, 6600000), abs=1e-6)


def test_lambert93_known_point(spark):
    # Paris, IGN circular 2.3522 E 48.8566 N -> about (652469, 6862035)
    x, y = lambert93_xy(F.lit(2.3522), F.lit(48.8566))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert row["x"] == pytest.approx(652469, abs=2) and row["y"] == pytest.approx(6862035, abs=2)


@pytest.mark.parametrize(
    "text, parts, rings, points",
    [
        ("POLYGON ((0 0, 1 0, 1 1, 0 0))", 1, 1, 4),
        ("polygon((0 0,1 0,1 1,0 0))", 1, 1, 4),
        ("POLYGON ((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 1))", 1, 2, 8),
        ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5.1 5, 5.2 5, 5.2 5.1, 5.1 5)))", 2, 3, 12),
        ("POLYGON ((-1.5e2 0, 1 0, 1 1, -1.5e2 0))", 1, 1, 4),
    ],
)
def test_wkt(spark, text, parts, rings, points):
    df = spark.createDataFrame([(text,)], "wkt string").withColumn("geom", G.from_wkt(F.col("wkt")))
    row = df.select("geom", G.to_wkt(F.col("geom")).alias("again")).first()
    assert len(row["geom"]) == parts
    assert sum(len(p) for p in row["geom"]) == rings
    assert sum(len(r) for p in row["geom"] for r in p) == points
    back = spark.createDataFrame([(row["again"],)], "wkt string").select(G.from_wkt(F.col("wkt")).alias("g")).first()
    assert back["g"] == row["geom"]


@pytest.mark.parametrize("bad", [None, "", "POINT (1 2)", "POLYGON ((0 0, 1 0, 1 1))", "POLYGON ((0 0, a 0, 1 1, 0 0))", "POLYGON EMPTY"])
def test_bad_wkt_is_null(spark, bad):
    assert spark.createDataFrame([(bad,)], "wkt string").select(G.from_wkt(F.col("wkt")).alias("g")).first()["g"] is None


def test_read_layer_csv(spark, tmp_path):
    (tmp_path / "l.csv").write_text('id,wkt,n\na,"POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))",1\nb,nothing,2\n')
    args = (spark, str(tmp_path / "l.csv"), "id string, wkt string, n int", "csv", "wkt", 2154)
    df = read_layer(*args)
    assert srid_of(df) == 2154 and df.where("geom is null").count() == 1
    assert df.where("id = 'a'").first()["is_box"] is True
    assert read_layer(*args, on_bad="drop").count() == 1
    with pytest.raises(Exception, match="valid geometry"):
        read_layer(*args, on_bad="raise").collect()
    with pytest.raises(ValueError, match="geometry"):
        read_layer(spark, str(tmp_path / "l.csv"), "id string, wkt string, n int", "csv")


def test_srid_mismatch(spark):
    a = finish_layer(layer(spark, [("a", TRIANGLE)]), 2154)
    b = finish_layer(layer(spark, [("b", TRIANGLE)]), 3857)
    same_srid(a, a)
    with pytest.raises(ValueError, match="2154"):
        same_srid(a, b)


def test_reprojected_zone_keeps_points(spark):
    df = layer(spark, [("z", poly(square(2, 46, 1)))])
    row = df.select(reproject_lambert93(F.col("geom")).alias("g")).first()
    assert len(row["g"][0][0]) == 5 and row["g"][0][0][0] == row["g"][0][0][4]


def test_sql_functions(spark):
    K.register_sql_functions(spark)
    layer(spark, [("a", TRIANGLE), ("b", poly(square(0, 0, 2)))]).createOrReplaceTempView("shapes")
    row = spark.sql("select geom_overlap_area(a.geom, b.geom) s, geom_intersects(a.geom, b.geom) t from shapes a, shapes b where a.id='a' and b.id='b'").first()
    assert row["s"] == pytest.approx(4) and row["t"] is True


def _cross(box):
    u, v = box[1] - box[0], box[3] - box[0]
    return u[0] * v[1] - u[1] * v[0]


def _turned(rng, n):
    shapes = []
    for _ in range(n):
        x, y, w, h = rng.uniform(0, 50, 4)
        ring = rotate(rect(x, y, w + 1, h + 1), rng.uniform(0, 90), x, y)
        if rng.random() < 0.5:
            ring = [*ring[:2], (ring[1][0] + 3, ring[1][1] + 9), *ring[2:]]
        if rng.random() < 0.5:
            ring = ring[::-1]
        shapes.append(ring)
    return shapes


def test_batches_agree_with_single_shapes():
    rings = _turned(np.random.default_rng(2), 60)
    flat = K.Flat(arrow(*[poly(r) for r in rings], None, TRIANGLE, L_SHAPE, HOLED))
    boxes = K.min_rotated_boxes(flat)
    assert np.isnan(boxes[60]).all()
    for ring, box in zip(rings, boxes):
        one = K.min_rotated_box(np.array(ring))
        assert abs(_cross(one)) == pytest.approx(abs(_cross(box)))
    distance = np.full(flat.rows, 0.7)
    geoms, simple = K.buffer_batch(flat, distance)
    assert simple.all()
    assert geoms[60] is None
    for row in [i for i in range(flat.rows) if i != 60]:
        parts = K.buffer_parts(flat.parts_of(row), 0.7)
        got = sorted(map(tuple, np.round(np.concatenate([r[:-1] for p in geoms[row] for r in p]), 6)))
        want = sorted(map(tuple, np.round(np.concatenate([r for p in parts for r in p]), 6)))
        assert np.allclose(got, want, atol=1e-5)


def _as_court(k, gap):
    x, y, w, h = 650_000 + k * 31 % 977, 6_860_000 + k * 53 % 991, 5 + k % 20, 4 + k % 13
    return [(x, y), (x + 4 * w, y), (x + 4 * w, y + 4 * h), (x + w + gap, y + 4 * h), (x + w + gap, y + 2 * h), (x + w, y + 2 * h), (x + w, y + 4 * h), (x, y + 4 * h)]


def test_courts_are_cleaned_up_together(monkeypatch):
    """Notches that close are no work of single rows, and batches give the very points of single rings."""
    single, alone = K.buffer_parts, []
    monkeypatch.setattr(K, "buffer_parts", lambda parts, distance: alone.append(1) or single(parts, distance))
    courts = [_as_court(k, 2.0 + k % 13) for k in range(400)]
    turned = [rotate(c, 7 * k, *c[0])[:: -1 if k % 2 else 1] for k, c in enumerate(courts[:60])]
    rng = np.random.default_rng(3)
    stars = []
    for _ in range(60):
        angle, far = np.sort(rng.random(9)) * 2 * np.pi, 4 + 6 * rng.random(9)
        stars.append(list(zip(far * np.cos(angle), far * np.sin(angle))))
    for rings, limit in ((courts, 0), (turned, 6), (stars, len(stars))):  # turned: places on the border of two squares
        flat = K.Flat(arrow(*[poly(r) for r in rings]))
        alone.clear()
        geoms, _ = K.buffer_batch(flat, np.full(flat.rows, 4.0))
        assert len(alone) <= limit
        for row, geom in enumerate(geoms):
            want = single(flat.parts_of(row), 4.0)
            assert [len(p) for p in geom] == [len(p) for p in want]
            for got, ring in zip((r for p in geom for r in p), (r for p in want for r in p)):
                np.testing.assert_allclose(got[:-1], ring, rtol=0, atol=1e-6)


def test_outlines_left_to_single_rings():
    """A court behind a closed gate has two rings, and a ring turned inside out has none."""
    court = np.array([(0, 0), (20, 0), (20, 20), (11, 20), (11, 15), (15, 15), (15, 5), (5, 5), (5, 15), (9, 15), (9, 20), (0, 20)], float)
    geoms, _ = K.buffer_batch(K.Flat(arrow(poly(court), poly(court))), np.array([1.5, 6.0]))
    assert areas_of([[r[:-1] for r in p] for g in geoms for p in g]) == [[pytest.approx(23 * 23), pytest.approx(7 * 7)], [pytest.approx(32 * 32)]]
    assert offset.outlines_together(np.array([square(0, 0, 1)[::-1]] * 2, float)) == [None, None]


def test_box_of_many_points_takes_the_hull():
    pts = [(math.cos(t / 10) * 5, math.sin(t / 10) * 2) for t in range(62)]
    box = K.min_rotated_boxes(K.Flat(arrow(poly(pts))))[0]
    assert abs(_cross(box)) == pytest.approx(40, rel=0.01)
