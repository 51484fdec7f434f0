import math
import random

import pytest
from pyspark.sql import functions as F

from eavesgrid.functions import geometry as G
from eavesgrid.operators import divided as D
from eavesgrid.operators import spatial_join as S
from eavesgrid.operators.components import connected_components
from eavesgrid.operators.skew import hot_keys, salted_pair
from shapes import HOLED, convex_overlap, general, groups_of, layer, poly, rect, rotate, square


def random_rings(n, seed, spread, sizes):
    rng = random.Random(seed)
    rings = {}
    for i in range(n):
        w, h = rng.choice(sizes), rng.choice(sizes)
        x, y = rng.uniform(-spread, spread), rng.uniform(-spread, spread)
        rings[f"p{i:03d}"] = rotate(rect(x, y, w, h), rng.choice([0, 0, rng.uniform(0, 90)]), x, y)
    return rings


MIXES = [(1, 60, [2, 5, 9]), (2, 300, [0.5, 4, 40, 400]), (3, 5, [1, 2, 3]), (4, 2000, [1, 1000, 5000])]


@pytest.mark.parametrize("hot, seed, spread, sizes", [(3, *MIXES[0]), (3, *MIXES[2])] + [(5000, *m) for m in MIXES])
def test_self_overlaps_equal_brute_force(spark, seed, spread, sizes, hot):
    rings = random_rings(70, seed, spread, sizes)
    df = layer(spark, [(k, poly(r)) for k, r in rings.items()])
    want = {}
    names = sorted(rings)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            area = convex_overlap(rings[a], rings[b])
            if area > 1e-6:
                want[a, b] = area
    rows = S.self_overlap_pairs(df, hot_cell=hot).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r["overlap"] == pytest.approx(want[r["id_a"], r["id_b"]], rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("hot, seed, spread, sizes", [(2, *MIXES[1]), (2, *MIXES[2])] + [(5000, *m) for m in MIXES])
def test_two_tables_equal_brute_force(spark, seed, spread, sizes, hot):
    left = random_rings(40, seed + 10, spread, sizes)
    right = random_rings(30, seed + 20, spread, sizes[::-1])
    a = layer(spark, [(k, poly(r)) for k, r in left.items()])
    b = layer(spark, [(k, poly(r)) for k, r in right.items()]).withColumnRenamed("id", "zone")
    want = {(x, z) for x in left for z in right if convex_overlap(left[x], right[z]) > 1e-6}
    got = {tuple(r) for r in S.spatial_join(a, b, "id", "zone", "overlaps", hot).collect()}
    assert got == want
    if hot > 2:
        touching = S.spatial_join(a, b, "id", "zone", "intersects", hot).collect()
        assert len(touching) == len(set(touching)) and want <= {tuple(r) for r in touching}


def test_contact_and_holes(spark):
    a = layer(spark, [("edge", poly(square(10, 0, 2))), ("corner", poly(square(10, 10, 2))), ("in_hole", poly(square(4, 4, 2))),
                      ("far", poly(square(11, 0, 2))), ("inside", poly(square(1, 1, 1)))])
    z = layer(spark, [("z", HOLED)]).withColumnRenamed("id", "zone")
    got = {r["id"] for r in S.spatial_join(a, z, "id", "zone").collect()}
    assert got == {"edge", "corner", "inside"}
    assert {r["id"] for r in S.spatial_join(a, z, "id", "zone", "overlaps").collect()} == {"inside"}


def test_contact_across_cell_borders(spark):
    """Boxes that meet exactly on multiples of the grid sides, on both signs."""
    rows = [(f"a{i}", poly(square(x, 0, 4))) for i, x in enumerate((-8, -4, 0, 4, 12, 60))]
    z = layer(spark, [("z", poly(square(0, -64, 64)))]).withColumnRenamed("id", "zone")
    got = {r["id"] for r in S.spatial_join(layer(spark, rows), z, "id", "zone").collect()}
    assert got == {"a1", "a2", "a3", "a4", "a5"}


def test_empty_sides(spark):
    some = layer(spark, [("a", poly(square(0, 0, 1)))])
    none = some.limit(0)
    z = some.withColumnRenamed("id", "zone")
    assert S.spatial_join(none, z, "id", "zone").count() == 0
    assert S.spatial_join(some, z.limit(0), "id", "zone").count() == 0
    assert S.self_overlap_pairs(none).count() == 0


def test_null_geometry_joins_nothing(spark):
    df = layer(spark, [("a", poly(square(0, 0, 1))), ("b", None), ("c", poly(square(0.5, 0, 1)))])
    assert [tuple(r)[:2] for r in S.self_overlap_pairs(df).collect()] == [("a", "c")]


def test_raster_join_wants_area(spark):
    fp = layer(spark, [("in", poly(square(1, 1, 2))), ("both", poly(square(9, 1, 2))), ("touch", poly(square(-2, 0, 2)))])
    cat = spark.createDataFrame([("r0", 0.0, 0.0, 10.0, 10.0), ("r1", 10.0, 0.0, 20.0, 10.0)], "raster_id string, xmin double, ymin double, xmax double, ymax double")
    got = {(r["id"], r["raster_id"]) for r in S.footprint_raster_join(fp, cat).collect()}
    assert got == {("in", "r0"), ("both", "r0"), ("both", "r1")}


def test_argument_checks(spark):
    df = layer(spark, [("a", poly(square(0, 0, 1)))])
    with pytest.raises(ValueError, match="predicate"):
        S.spatial_join(df, df, "id", "other", "contains")
    with pytest.raises(ValueError, match="different names"):
        S.spatial_join(df, df, "id", "id")


def test_kernel_and_native_agree(spark):
    rows = [(f"b{i}", poly(rect(i * 3 % 17, i * 5 % 13, 4, 3))) for i in range(30)]
    df = layer(spark, rows)
    native = {tuple(r) for r in S.self_overlap_pairs(df).collect()}
    kernel = {(a, b, round(v, 9)) for a, b, v in S.self_overlap_pairs(general(df)).collect()}
    assert native == kernel and native


def test_salting_keeps_every_pair_once(spark):
    left = spark.createDataFrame([("hot", f"l{i}") for i in range(50)] + [("cold", "l_"), ("left_only", "x")], "k string, l string")
    right = spark.createDataFrame([("hot", f"r{i}") for i in range(20)] + [("cold", "r_")], "k string, r string")
    plain = left.join(right, "k").select("l", "r")
    a, b, keys = salted_pair(left, right, ["k"], "l", "r", 7)
    assert keys == ["k", "salt_l", "salt_r"]
    salted = a.join(b, keys).select("l", "r")
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    assert a.where("k = 'hot'").groupBy("salt_l", "salt_r").count().agg(F.max("count")).first()[0] < 50
    assert {r["k"] for r in hot_keys(left, right, ["k"], 7).collect()} == {"hot"}


@pytest.mark.parametrize("hot_minimum, parts", [(1, 7), (3, 1), (100000, 1), (100000, 7)])
def test_components(spark, hot_minimum, parts):
    rng = random.Random(hot_minimum)
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("hub", f"s{i:03d}") for i in range(80)]
    noise = [(f"n{rng.randrange(40):02d}", f"n{rng.randrange(40):02d}") for _ in range(30)]
    edges = chain + star + noise + [("a", "a"), ("start", "end"), ("x", "y"), ("y", "x")]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "id_a string, id_b string").repartition(parts)
    got = {r["id"]: r["component"] for r in connected_components(df, hot_minimum=hot_minimum).collect()}
    assert got == groups_of((a, b) for a, b in edges if a != b)


def test_components_of_nothing(spark):
    df = spark.createDataFrame([], "id_a string, id_b string")
    assert connected_components(df).count() == 0


def star(rng, cx, cy, r, n):
    """A ring that doesn't cross itself: one distance for each angle."""
    far = [r * rng.uniform(0.4, 1) for _ in range(n)]
    return [(cx + d * math.cos(2 * math.pi * i / n), cy + d * math.sin(2 * math.pi * i / n)) for i, d in enumerate(far)]


@pytest.mark.parametrize("predicate, hot", [("intersects", 5000), ("overlaps", 3)])
def test_divided_shapes_give_the_same_pairs(spark, predicate, hot):
    rng = random.Random(9)
    zones = [(f"z{i}", poly(star(rng, rng.uniform(-80, 80), rng.uniform(-80, 80), r, 60))) for i, r in enumerate((5, 20, 60, 90))]
    zones.append(("holed", [[[*r, r[0]] for r in (star(rng, 0, 0, 100, 80), star(rng, 5, 5, 20, 30)[::-1])]]))
    zones.append(("two", [poly(star(rng, -200, 0, 40, 50))[0], poly(star(rng, -90, 0, 40, 50))[0]]))
    zones.append(("plain", poly(square(0, 0, 64))))
    fps = [(f"f{i:03d}", poly(rotate(rect(x, y, w, h), rng.choice([0, 20]), x, y)))
           for i in range(150) for x, y, w, h in [(rng.randrange(-240, 160), rng.randrange(-120, 120), rng.choice([1, 4, 16, 40, 200]), rng.choice([1, 4, 16, 64]))]]
    left, right = layer(spark, fps), layer(spark, zones).withColumnRenamed("id", "zone")
    whole = {tuple(r) for r in S.spatial_join(left, right, "id", "zone", predicate, max_points=10**6).collect()}
    rows = S.spatial_join(left, right, "id", "zone", predicate, hot, max_points=20).collect()
    assert len(rows) == len(set(rows)) and {tuple(r) for r in rows} == whole and len(whole) > 100


def test_pieces_are_small_and_keep_the_area(spark):
    rng = random.Random(4)
    ring = star(rng, 10, 10, 300, 2000)
    zone = layer(spark, [("z", poly(ring, star(rng, 10, 10, 40, 300)[::-1]))])
    parts = D.pieces(zone.select("id", *S.BBOX, "geom"), "id", 100).withColumn("geom", F.coalesce("geom", G.box_geom(*[F.col(c) for c in S.BBOX])))
    points = F.aggregate(F.flatten("geom"), F.lit(0), lambda n, r: n + F.size(r))
    most, area = parts.agg(F.max(points), F.sum(G.area(F.col("geom")))).first()
    assert most <= 100 and area == pytest.approx(zone.select(G.area(F.col("geom"))).first()[0], rel=1e-9)


def test_edge_runs_cover_every_edge_once(spark):
    shape = layer(spark, [("a", poly(star(random.Random(1), 0, 0, 9, 37), star(random.Random(2), 0, 0, 2, 10)))])
    runs = [r["geom"][0][0] for r in D.edge_runs(shape, "id", 5).collect()]
    edges = [(tuple(p), tuple(q)) for run in runs for p, q in zip(run, run[1:])]
    rings = shape.first()["geom"][0]
    assert sorted(edges) == sorted((tuple(p), tuple(q)) for ring in rings for p, q in zip(ring, ring[1:])) and max(map(len, runs)) == 6


@pytest.mark.parametrize("predicate", ["intersects", "overlaps"])
def test_shapes_divided_on_both_sides(spark, predicate):
    """Either side, or both, with shapes above the limit of points; also inside each other, in a hole, and touching."""
    rng = random.Random(12)
    rows = [(f"s{i:02d}", poly(star(rng, rng.uniform(-60, 60), rng.uniform(-60, 60), rng.choice([4, 15, 40]), rng.choice([6, 50, 90])))) for i in range(40)]
    rows += [("hole", poly(star(rng, 0, 0, 120, 80), square(-50, -50, 30))), ("in hole", poly(square(-45, -45, 10))), ("box", poly(square(-3, -3, 2)))]
    rows += [("two", [poly(star(rng, -30, 0, 9, 60))[0], poly(star(rng, 40, 10, 9, 60))[0]]), ("none", []), ("flat", poly([(1, 1), (3, 1), (2, 1)]))]
    left = layer(spark, rows)
    right = left.withColumnRenamed("id", "other")
    whole = {tuple(r) for r in S.spatial_join(left, right, "id", "other", predicate, max_points=10**6).collect()}
    for limit in (20, 60):
        got = [tuple(r) for r in S.spatial_join(left, right, "id", "other", predicate, 7, max_points=limit).collect()]
        assert len(got) == len(set(got)) and set(got) == whole
    assert len(whole) > 300


def test_self_overlap_of_divided_shapes(spark):
    rng = random.Random(8)
    rows = [(f"s{i:02d}", poly(star(rng, rng.uniform(-40, 40), rng.uniform(-40, 40), rng.choice([4, 15, 40]), rng.choice([4, 50, 90])))) for i in range(30)]
    df = layer(spark, rows)
    whole = {(a, b): v for a, b, v in S.self_overlap_pairs(df, max_points=10**6).collect()}
    got = [tuple(r) for r in S.self_overlap_pairs(df, max_points=30).collect()]
    assert len(got) == len(whole) > 50 and {(a, b): pytest.approx(v, abs=1e-6) for a, b, v in got} == whole


def test_divided_shapes_are_cut_up_once_and_where_they_lie(spark, monkeypatch):
    cut_up, dealt = [], []
    pieces, pair = D.pieces, S.salted_pair
    monkeypatch.setattr(D, "pieces", lambda *args: cut_up.append(pieces(*args)) or cut_up[-1])
    monkeypatch.setattr(S, "salted_pair", lambda *args: dealt.append(pair(*args)) or dealt[-1])
    ring = star(random.Random(3), 0, 0, 300, 3000)
    df = layer(spark, [("big", poly(ring)), ("also", poly(star(random.Random(5), 50, 50, 300, 3000))), ("box", poly(square(-3, -3, 2)))])
    assert S.self_overlap_pairs(df, max_points=100).count() == 3
    assert len(cut_up) == 1  # the pieces serve both sides of the join
    plan = cut_up[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    assert len(dealt) == 2 and dealt[-1][0].rdd.getNumPartitions() > 2  # pairs of pieces cost more than a bbox test


def test_dense_shapes_are_spread_and_worked_out_once(spark, monkeypatch):
    from eavesgrid.plans import queries as Q

    made = []
    dense = Q.X.dense
    monkeypatch.setattr(Q.X, "dense", lambda *args: made.append(dense(*args)) or made[-1])
    Q.spatial_join_dense(spark, "/root/testdata/sf0.01")
    assert len(made) == 1 and made[0].rdd.getNumPartitions() == 2


def test_growing_sides_are_shuffled(spark):
    df = general(layer(spark, [(f"b{i}", poly(rect(i * 3 % 17, i * 5 % 13, 4, 3))) for i in range(30)]))
    plan = S.self_overlap_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_cells_inside_rectangles(spark):
    df = layer(spark, [("a", poly(rect(0.5, 0.25, 9, 5))), ("thin", poly(rect(0, 0, 90, 5))), ("flat", poly(rect(1, 1, 0, 4)))])
    cells = sorted(tuple(r) for r in S.fill_cells(df, "id").collect())
    assert cells == [("a", 1, x, y) for x in (1, 2, 3) for y in (1,)]
