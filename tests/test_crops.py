import numpy as np
import pytest

from eavesgrid.operators import crops as C
from shapes import general, layer, poly, rect, rotate, square

RES, SIZE, TILE = 1.0, 40, 16
GRID = "raster_id string, xmin double, ymin double, xmax double, ymax double, res double, width int, height int, n_bands int"


def make_raster(spark, bands, origins):
    rng = np.random.default_rng(1)
    catalog, tiles, pixels = [], [], {}
    for name, (x, y) in origins.items():
        img = rng.integers(1, 255, (SIZE, SIZE, bands), dtype=np.uint8)
        pixels[name] = img
        catalog.append((name, float(x), float(y), float(x + SIZE), float(y + SIZE), RES, SIZE, SIZE, bands))
        for tr in range(0, SIZE, TILE):
            for tc in range(0, SIZE, TILE):
                cut = img[tr:tr + TILE, tc:tc + TILE]
                tiles.append((name, tr // TILE, tc // TILE, tr, tc, cut.shape[0], cut.shape[1], bytearray(cut.tobytes())))
    schema = "raster_id string, tile_row int, tile_col int, row0 int, col0 int, rows int, cols int, data binary"
    return spark.createDataFrame(catalog, GRID), spark.createDataFrame(tiles, schema), pixels


def inside(ring, x, y):
    """Centre in a counter-clockwise convex ring, off its sides."""
    return all((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) > 0 for a, b in zip(ring, ring[1:] + ring[:1]))


def expected(rings, img, origin):
    x0, y0 = origin
    centre = lambda r, c: (x0 + c + 0.5, y0 + SIZE - r - 0.5)
    hit = np.array([[any(inside(g, *centre(r, c)) for g in rings) for c in range(SIZE)] for r in range(SIZE)])
    xs, ys = [p[0] for g in rings for p in g], [p[1] for g in rings for p in g]
    rows = [r for r in range(SIZE) if min(ys) <= centre(r, 0)[1] < max(ys)]
    cols = [c for c in range(SIZE) if min(xs) <= centre(0, c)[0] < max(xs)]
    if not rows or not cols:
        return (0, 0), b""
    part = np.where(hit[:, :, None], img, 0)[rows[0]:rows[-1] + 1, cols[0]:cols[-1] + 1]
    return part.shape[:2], part.astype(np.uint8).tobytes()


SHAPES = {
    "upright": [rect(3.2, 5.1, 9, 7)],
    "turned": [rotate(rect(18.3, 12.1, 14.2, 9.3), 31)],
    "steep": [rotate(rect(30.7, 22.2, 12.4, 3.1), 77)],
    "border": [rect(35.3, 30.2, 9.9, 6.2)],
    "outside corner": [rotate(rect(-4.1, -3.3, 9, 9), 20)],
    "tiny": [rect(7.6, 7.6, 0.2, 0.2)],
    "twice": [rect(20.2, 30.1, 6, 6), rotate(rect(23.3, 32.7, 6, 4), 15)],
    "apart": [rect(2.2, 30.1, 3, 3), rect(10.4, 35.6, 4, 2)],
}


@pytest.mark.parametrize("bands", [1, 3])
def test_crops_equal_pixelwise_cutting(spark, bands):
    origins = {"r0": (0, 0), "r1": (40, 0)}
    catalog, tiles, pixels = make_raster(spark, bands, origins)
    fp = layer(spark, [(name, poly(g)) for name, gs in SHAPES.items() for g in gs])
    got = {(r["id"], r["raster_id"]): r for r in C.crop_rasters(fp, catalog, tiles, TILE).collect()}
    for (name, raster), row in got.items():
        touching = [g for g in SHAPES[name]]
        shape, data = expected(touching, pixels[raster], origins[raster])
        assert (row["height"], row["width"], row["n_channels"]) == (*shape, bands), name
        assert bytes(row["data"]) == data, name
    assert ("border", "r0") in got and ("border", "r1") in got and ("tiny", "r0") in got
    assert ("upright", "r1") not in got
    sums = {(r["id"], r["raster_id"]): r for r in C.zonal_pixels(fp, catalog, tiles, TILE).collect()}
    for key, r in sums.items():
        values = np.frombuffer(got[key]["data"], np.uint8)
        assert r["pixel_sum"] == values.sum() and r["n_pixels"] == (values > 0).sum()
    assert ("tiny", "r0") not in sums


def test_unique_ids_and_kernel_path_agree(spark):
    catalog, tiles, _ = make_raster(spark, 1, {"r0": (0, 0)})
    fp = layer(spark, [(n, poly(g[0])) for n, g in SHAPES.items()])
    frames = [C.crop_rasters(f, catalog, tiles, TILE, unique_ids=u) for f in (fp, general(fp)) for u in (True, False)]
    results = [{(r["id"], r["raster_id"]): bytes(r["data"]) for r in f.collect()} for f in frames]
    assert all(r == results[0] for r in results[1:])


def test_copies_under_one_id_are_cut_once(spark):
    catalog, tiles, _ = make_raster(spark, 1, {"r0": (0, 0)})
    one = layer(spark, [("a", poly(square(3, 3, 5)))])
    many = layer(spark, [("a", poly(square(3, 3, 5)))] * 30)
    cut = [C.crop_rasters(f, catalog, tiles, TILE).collect() for f in (one, many)]
    assert cut[0] == cut[1] and len(cut[0]) == 1


def test_missing_tile_is_black_and_reported(spark):
    catalog, tiles, pixels = make_raster(spark, 1, {"r0": (0, 0)})
    fp = layer(spark, [("a", poly(rect(14, 30, 4, 2)))])
    row = C.crop_rasters(fp, catalog, tiles.where("tile_col <> 1"), TILE).first()
    data = np.frombuffer(row["data"], np.uint8).reshape(2, 4)
    assert (data[:, 2:] == 0).all() and (data[:, :2] == pixels["r0"][8:10, 14:16, 0]).all()
    assert row["missing_tiles"] == 1 and C.crop_rasters(fp, catalog, tiles, TILE).first()["missing_tiles"] == 0
    assert len(C.crop_rasters(fp, catalog, tiles.limit(0), TILE).first()["data"]) == 8
    sums = C.zonal_pixels(fp, catalog, tiles.where("tile_col <> 1"), TILE).first()
    assert (sums["n_pixels"], sums["missing_tiles"]) == (4, 1)
    none = C.zonal_pixels(fp, catalog, tiles.limit(0), TILE).first()
    assert (none["n_pixels"], none["pixel_sum"]) == (0, 0) and none["missing_tiles"] > 0


def test_catalog(spark):
    paths = ["/d/a.jp2", "/d/b.tiff", "/d/c.tif", "/d/e.JP2", "/d/jp2", "/d/x.jp2.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert {r["raster_name"] for r in C.raster_catalog(df).collect()} == {"a", "b"}
    assert {r["raster_name"] for r in C.raster_catalog(df, any_case=True).collect()} == {"a", "b", "e"}
    twins = spark.createDataFrame([("/d/R1.jp2",), ("/d/R1.tiff",)], "path string")
    ledger = C.raster_catalog(twins.limit(1))
    assert C.pending_rasters(C.raster_catalog(twins), ledger).count() == 1  # one name, two rasters
    with pytest.raises(FileNotFoundError):
        C.require_rasters(C.raster_catalog(df.where("path like '%tif'")))


def test_suffixes(spark):
    crops = spark.createDataFrame([("a", "r2"), ("a", "r1"), ("b", "r2"), ("c", "r3")], "id string, raster_id string")
    earlier = spark.createDataFrame([("a", 0), ("a", 1), ("c", 0)], "id string, suffix int")
    got = {(r["id"], r["raster_id"]): r["suffixed_name"] for r in C.crop_suffix(crops, earlier).collect()}
    assert got == {("a", "r1"): "a_2.jpg", ("a", "r2"): "a_3.jpg", ("b", "r2"): "b.jpg", ("c", "r3"): "c_1.jpg"}
    first = {(r["id"], r["raster_id"]) for r in C.crop_suffix(crops, with_suffix=False).collect()}
    assert first == {("a", "r1"), ("b", "r2"), ("c", "r3")}


def test_pending(spark):
    cat = spark.createDataFrame([("a",), ("b",)], "raster_id string")
    led = spark.createDataFrame([("b",), ("other",)], "raster_id string")
    assert [r[0] for r in C.pending_rasters(cat, led).collect()] == ["a"]
    assert C.distinct_ids(spark.createDataFrame([("r", "x"), ("r", "x")], "raster_id string, id string")).first()["n_features"] == 2


def test_plan_has_no_nested_loop(spark, capsys):
    catalog, tiles, _ = make_raster(spark, 1, {"r0": (0, 0)})
    fp = layer(spark, [("a", poly(square(3, 3, 5)))])
    C.crop_rasters(fp, catalog, tiles, TILE).explain()
    text = capsys.readouterr().out
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_bucketed_tiles_are_not_shuffled(spark):
    from eavesgrid.sinks.tables import write_raster_tiles

    catalog, tiles, _ = make_raster(spark, 1, {"r0": (0, 0), "r1": (40, 0)})
    write_raster_tiles(tiles, "tiles_in_buckets", 4)
    fp = layer(spark, [(n, poly(g[0])) for n, g in SHAPES.items()])
    stored = spark.table("tiles_in_buckets")
    plan = C.crop_plan(C.crop_boxes(fp, catalog), True)
    want = {(r["id"], r["raster_id"]): r["data"] for r in C.crop_rasters(fp, catalog, tiles, TILE).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = C.crop_fragments(plan, stored, TILE)._jdf.queryExecution().executedPlan().toString()
        got = {(r["id"], r["raster_id"]): r["data"] for r in C.crop_rasters(fp, catalog, stored, TILE).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    tile_side = text[:text.index("tiles_in_buckets")].splitlines()[-8:]
    assert not any("Exchange" in line for line in tile_side), text
    assert got == want
