import random

import pytest
from pyspark.sql import functions as F

from eavesgrid.operators import merge as M
from eavesgrid.operators.components import connected_components, contracted
from shapes import convex_overlap, general, groups_of, layer, poly, rect, rotate, square


def merged(spark, rows, **kw):
    df = M.merge_overlapped(layer(spark, rows), **kw)
    return {r["id"]: r for r in df.collect()}


def test_chain_becomes_one_group(spark):
    rows = [("a", poly(square(0, 0, 2)), 1.0), ("b", poly(square(1, 0, 2)), 9.0), ("c", poly(square(2.5, 0, 2)), 3.0), ("d", poly(square(20, 0, 2)), 5.0)]
    out = merged(spark, rows)
    assert set(out) == {"b", "d"}
    assert out["b"]["members"] == 3 and out["b"]["geom"] is None
    assert out["b"]["area"] == 12  # parts are collected, overlaps count twice
    assert (out["b"]["xmin"], out["b"]["xmax"]) == (0, 4.5) and out["b"]["is_box"] is False
    assert out["d"]["members"] == 1 and out["d"]["is_box"] is True and len(out["d"]["geom"]) == 1


def test_contact_alone_does_not_merge(spark):
    rows = [("a", poly(square(0, 0, 2)), 1.0), ("b", poly(square(2, 0, 2)), 1.0), ("c", poly(square(4, 2, 2)), 1.0)]
    assert set(merged(spark, rows)) == {"a", "b", "c"}


def test_leader_rules(spark):
    rows = [
        ("tie2", poly(square(0, 0, 2)), 7.0), ("tie1", poly(square(1, 0, 2)), 7.0),
        ("null", poly(square(10, 0, 2)), None), ("neg", poly(square(11, 0, 2)), -5.0),
        ("n2", poly(square(20, 0, 2)), -9.0), ("n1", poly(square(21, 0, 2)), -8.0),
    ]
    assert set(merged(spark, rows)) == {"tie1", "null", "n1"}


def test_min_value_needs_both(spark):
    rows = [("a", poly(square(0, 0, 2)), 0.9), ("b", poly(square(1, 0, 2)), 0.5), ("c", poly(square(1.5, 0, 2)), 0.8), ("d", poly(square(3, 0, 2)), None)]
    assert set(merged(spark, rows, min_value=0.6)) == {"a", "b", "d"}


def test_one_row_per_group_and_a_row_per_part(spark):
    df = layer(spark, [(f"m{i}", poly(square(i, 0, 2)), float(i)) for i in range(9)])
    assert [r["id"] for r in M.merge_overlapped(df).collect()] == ["m8"]
    groups = M.overlap_groups(df)
    parts = M.merged_parts(df, M.with_leaders(groups, M.group_leaders(df, groups))).collect()
    assert {r["leader_id"] for r in parts} == {"m8"}
    assert sorted(r["geom"][0][0][0]["x"] for r in parts) == list(range(9))


@pytest.mark.parametrize("crowded", [1, 4, 256, 10**9])
def test_groups_do_not_depend_on_crowding(spark, crowded):
    """Overlaps around the least one that counts, copies of flat shapes, and slivers in cells that others cover."""
    shapes = {f"o{k}{side}": rect(100 * k + side * (2 - w), 0, 2, 2) for k, w in enumerate((5e-9, 5e-8, 4e-7, 6e-7, 5e-6)) for side in (0, 1)}
    shapes |= {"flat1": rect(50, 50, 3, 0), "flat2": rect(50, 50, 3, 0), "hub": rect(900, 0, 64, 64)}
    shapes |= {f"s{i}": rect(900 + 64 - (1e-8 if i % 2 else 1e-6), 3 * i, 5, 2) for i in range(12)}
    df = layer(spark, [(k, poly(r), 1.0) for k, r in shapes.items()])
    got = {r["id"]: r["component"] for r in connected_components(M.overlap_links(df, crowded=crowded)).collect()}
    linked = {"o30", "o31", "o40", "o41", "hub", *(f"s{i}" for i in range(0, 12, 2))}
    assert set(got) == linked and got["o30"] == "o30" and got["s2"] == "hub"


def test_empty_layer(spark):
    assert M.merge_overlapped(layer(spark, [("a", poly(square(0, 0, 1)), 1.0)]).limit(0)).count() == 0


def brute(rings):
    names = sorted(rings)
    return groups_of((a, b) for i, a in enumerate(names) for b in names[i + 1:] if convex_overlap(rings[a], rings[b]) > 1e-6)


def crowd(kind, seed):
    rng = random.Random(seed)
    rings = {}
    for i in range(60):
        if kind == "copies":
            ring = square(0, 0, 10) if i % 3 else rect(rng.uniform(0, 200), rng.uniform(0, 200), 10, 10)
        elif kind == "near copies":
            ring = rotate(square(rng.uniform(0, 0.3), rng.uniform(0, 0.3), 10), rng.uniform(0, 2))
        elif kind == "fans":  # thin shapes around one point that hardly overlap
            ring = rotate(rect(1, 0, 9, 0.3), i * 6)
        elif kind == "strips":  # long parallel strips side by side, every other one overlapping the next
            ring = rect(0, i * 1.0, 50, 1.0 if i % 2 else 1.2)
        else:
            ring = rotate(rect(rng.uniform(0, 40), rng.uniform(0, 40), rng.choice([1, 6, 30]), rng.choice([1, 6, 30])), rng.uniform(0, 90), 20, 20)
        rings[f"p{i:02d}"] = ring
    return rings


KINDS = ["copies", "near copies", "fans", "strips", "mixed"]


@pytest.mark.parametrize("kind, crowded", [(k, 4) for k in KINDS] + [("mixed", 1), ("mixed", 256)])
def test_crowded_cells_keep_the_groups(spark, kind, crowded):
    rings = crowd(kind, 5)
    df = layer(spark, [(k, poly(r), 1.0) for k, r in rings.items()])
    links = M.overlap_links(df, crowded=crowded)
    got = {r["id"]: r["component"] for r in connected_components(links).collect()}
    assert got == brute(rings)


def test_crowded_boxes_by_native_and_kernel(spark):
    rings = {f"b{i:02d}": rect(i % 7 * 0.5, i % 11 * 0.5, 6, 4) for i in range(40)} | {f"z{i}": rect(500 + 9 * i, 0, 10, 3) for i in range(5)}
    df = layer(spark, [(k, poly(r), 1.0) for k, r in rings.items()])
    for frame in (df, general(df)):
        got = {r["id"]: r["component"] for r in connected_components(M.overlap_links(frame, crowded=2)).collect()}
        assert got == brute(rings)


def test_stack_needs_few_links(spark):
    """A pile of jittered copies is linked by far fewer than all pairs."""
    rng = random.Random(3)
    n = 400
    rows = [(f"p{i:03d}", poly(square(rng.uniform(0, 0.5), rng.uniform(0, 0.5), 10)), 1.0) for i in range(n)]
    links = M.overlap_links(layer(spark, rows), crowded=16)
    assert links.count() < 20 * n
    assert connected_components(links).select("component").distinct().count() == 1


def test_group_of_leaders_survives_salting(spark):
    groups = spark.createDataFrame([(f"i{k}", "g" if k % 3 else "h") for k in range(60)], "id string, group_id string")
    leaders = spark.createDataFrame([("g", "i1", 40), ("h", "i0", 20)], "group_id string, leader_id string, members long")
    out = M.with_leaders(groups, leaders, limit=5)
    assert out.count() == 60 and out.where("leader_id = 'i1'").count() == 40
    assert out.select(F.sum("members")).first()[0] == 40 * 40 + 20 * 20


def test_large_piles_of_copies_are_salted(spark, monkeypatch):
    monkeypatch.setattr(M, "HOT_GROUP", 4)
    rows = [(f"a{i:02d}", poly(square(0, 0, 4)), 1.0) for i in range(30)]
    rows += [(f"t{i}", poly(rotate(square(50, 50, 4), 10)), 1.0) for i in range(9)] + [("x", poly(square(90, 0, 4)), 1.0)]
    reps, links = M._copies(layer(spark, rows).select("id", *M.slim_shape()))
    assert sorted(r["id"] for r in reps.collect()) == ["a00", "t0", "x"]
    assert sorted(map(tuple, links.collect())) == sorted([(f"a{i:02d}", "a00") for i in range(1, 30)] + [(f"t{i}", "t0") for i in range(1, 9)])


def test_edges_are_contracted_to_stars(spark):
    rng = random.Random(4)
    edges = [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}") for _ in range(200)]
    found = contracted(spark.createDataFrame(edges, "u string, v string").coalesce(1)).collect()
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = set()
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for other in near[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        if node != min(seen):
            want.add((node, min(seen)))
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_rectangles_on_each_other_need_few_links(spark):
    df = layer(spark, [(f"b{i:03d}", poly(rect(i % 20 * 0.125, i // 20 * 0.125, 8, 6))) for i in range(200)])
    assert M.overlap_links(df).count() == 199
