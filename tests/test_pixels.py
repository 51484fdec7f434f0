"""Samples of every type against numpy, and tiles pruned at the scan."""

import re

import numpy as np
import pytest

from eavesgrid.operators import crops as C
from eavesgrid.operators import pixels as P
from eavesgrid.operators.images import prepare_images
from shapes import layer, poly, rect, rotate
from test_crops import GRID, RES, SHAPES, SIZE, TILE, inside

TILES = "raster_id string, tile_row int, tile_col int, row0 int, col0 int, rows int, cols int, data binary"


def typed_raster(spark, kinds, bands=1):
    """One raster per (sample type, no-data value), side by side, and their pixels."""
    rng = np.random.default_rng(7)
    catalog, tiles, pixels = [], [], {}
    for at, (kind, nodata) in enumerate(kinds):
        dtype = np.dtype(P.SAMPLE_TYPES[kind])
        name = f"r{at}-{kind}"
        img = rng.normal(0, 900, (SIZE, SIZE, bands)) if dtype.kind == "f" else rng.integers(np.iinfo(dtype).min, np.iinfo(dtype).max, (SIZE, SIZE, bands), endpoint=True)
        img = img.astype(dtype)
        if nodata is not None:
            img[rng.random(img.shape) < 0.2] = nodata
        pixels[name] = img, nodata
        catalog.append((name, float(at * SIZE), 0.0, float((at + 1) * SIZE), float(SIZE), RES, SIZE, SIZE, bands, kind, nodata))
        for tr in range(0, SIZE, TILE):
            for tc in range(0, SIZE, TILE):
                part = img[tr:tr + TILE, tc:tc + TILE]
                tiles.append((name, tr // TILE, tc // TILE, tr, tc, part.shape[0], part.shape[1], bytearray(part.tobytes())))
    schema = f"{GRID}, dtype string, nodata double"
    return spark.createDataFrame(catalog, schema), spark.createDataFrame(tiles, TILES).repartition(3), pixels


KINDS = [("u8", None), ("u8", 7.0), ("u16", 65535.0), ("i16", -32768.0), ("u32", None), ("i32", -1.0), ("f32", -9999.0), ("f32", float("nan")), ("f64", None)]


@pytest.mark.parametrize("bands", [1, 4])
def test_types_against_numpy(spark, bands):
    catalog, tiles, pixels = typed_raster(spark, KINDS, bands)
    turned = rotate(rect(12.3, 9.1, 19.4, 11.3), 27)
    rings = {name: [(x + at * SIZE, y) for x, y in turned] for at, name in enumerate(pixels)}
    fp = layer(spark, [(f"f-{name}", poly(ring)) for name, ring in rings.items()])
    crops = {r["id"]: r for r in C.crop_rasters(fp, catalog, tiles, TILE).collect()}
    sums = {r["id"]: r for r in C.zonal_statistics(fp, catalog, tiles, TILE).collect()}
    hit = np.array([[inside(turned, c + 0.5, SIZE - r - 0.5) for c in range(SIZE)] for r in range(SIZE)])
    rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    for name, (img, nodata) in pixels.items():
        row, empty = crops[f"f-{name}"], 0 if nodata is None else nodata
        want = np.where(hit[:, :, None], img, np.array(empty).astype(img.dtype))
        got = np.frombuffer(row["data"], P.SAMPLE_TYPES[row["dtype"]]).reshape(row["height"], row["width"], bands)
        r0, c0 = row["r0"], row["c0"]
        assert r0 <= rows[0] and c0 <= cols[0] and r0 + row["height"] > rows[-1] and c0 + row["width"] > cols[-1]
        np.testing.assert_array_equal(got, want[r0:r0 + row["height"], c0:c0 + row["width"]])
        values = img[hit].astype(np.float64).ravel()
        bad = np.isnan(values) | (values == (np.inf if nodata is None else nodata))
        found = sums[f"f-{name}"]
        assert (found["n_pixels"], found["n_nodata"], found["missing_tiles"]) == ((~bad).sum(), bad.sum(), 0)
        assert found["pixel_sum"] == pytest.approx(values[~bad].sum(), rel=1e-12)
        assert (found["pixel_min"], found["pixel_max"]) == (values[~bad].min(), values[~bad].max())


def test_missing_tiles_are_without_data(spark):
    catalog, tiles, _ = typed_raster(spark, [("i16", -5.0)])
    fp = layer(spark, [("a", poly(rect(10.2, 10.2, 12, 4)))])
    row = C.crop_rasters(fp, catalog, tiles.where("tile_col <> 0"), TILE).first()
    assert row["missing_tiles"] > 0 and np.frombuffer(row["data"], "<i2")[0] == -5
    nothing = C.zonal_statistics(fp, catalog, tiles.limit(0), TILE).first()
    assert (nothing["n_pixels"], nothing["pixel_sum"], nothing["pixel_min"]) == (0, 0.0, None) and nothing["missing_tiles"] > 0


def test_unknown_type_fails(spark):
    catalog, tiles, _ = typed_raster(spark, [("u16", None)])
    fp = layer(spark, [("a", poly(rect(10.2, 10.2, 12, 4)))])
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="unknown sample type c64"):
        C.crop_rasters(fp, catalog.withColumn("dtype", F.lit("c64")), tiles, TILE).collect()


def test_stretched_crops_can_be_prepared(spark):
    catalog, tiles, pixels = typed_raster(spark, [("u16", 65535.0)])
    fp = layer(spark, [("a", poly(rect(4, 4, 8, 8)))])
    crops = C.crop_rasters(fp, catalog, tiles, TILE)
    (img, _), row = next(iter(pixels.values())), P.stretched(crops, 0, 65534, nodata=65535).first()
    part = img[SIZE - 12:SIZE - 4, 4:12, 0].astype(np.float64)
    want = np.rint(np.where(part == 65535, 0, part) / 65534 * 255).astype(np.uint8)
    np.testing.assert_array_equal(np.frombuffer(row["data"], np.uint8).reshape(8, 8), want)
    assert len(prepare_images(P.stretched(crops, 0, 65534), (8, 8), "grayscale").first()["tensor"]) == 64
    with pytest.raises(ValueError):
        P.stretched(crops, 3, 3)


def _above_scan(plan: str, column: str) -> list[str]:
    """Names of the operators above the scan that reads ``column``, the nearest first."""
    lines = [(len(m.group(1)), m.group(2)) for m in re.finditer(r"^([ :+|*()\d-]*?)(?=[A-Z])(.*)$", plan, re.M)]
    at = next(i for i, (_, text) in enumerate(lines) if "FileScan parquet" in text and column in text)
    depth, out = lines[at][0], []
    for indent, text in reversed(lines[:at]):
        if indent < depth:
            out.append(text)
            depth = indent
    return out


def test_no_exchange_above_an_unfiltered_tile_scan(spark, tmp_path):
    catalog, tiles, _ = typed_raster(spark, [("u16", None), ("u16", 3.0), ("u8", None)])
    folder = str(tmp_path / "tile-store")
    tiles.write.parquet(folder)
    stored = spark.read.parquet(folder)
    fp = layer(spark, [(n, poly(g[0])) for n, g in SHAPES.items()])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for make in (C.crop_rasters, C.zonal_statistics):
            made = make(fp, catalog, stored, TILE)
            above = _above_scan(made._jdf.queryExecution().executedPlan().toString(), "tile_row")
            names = [re.match(r"\w+", x).group(0) for x in above]
            assert "BroadcastHashJoin" in names, above
            assert names.index("BroadcastHashJoin") < next(i for i, n in enumerate(names) if n == "Exchange"), above
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bitmaps_name_just_the_wanted_tiles(spark):
    rows = [("r", 0, 0, 9), ("r", 7, 3, 9), ("r", 7, 3, 9), ("s", 200, 99, 100), ("s", 0, 63, 100)]
    wanted = spark.createDataFrame(rows, "raster_id string, tile_row int, tile_col int, n_cols int")
    every = [(r, a, b, bytearray(b"x")) for r, n, m in (("r", 9, 9), ("s", 201, 100), ("t", 2, 2)) for a in range(n) for b in range(m)]
    tiles = spark.createDataFrame(every, "raster_id string, tile_row int, tile_col int, data binary")
    got = {tuple(r)[:3] for r in C.wanted_only(tiles, wanted).collect()}
    assert got == {r[:3] for r in rows}
