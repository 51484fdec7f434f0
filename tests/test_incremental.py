import pytest
from pyspark.sql import functions as F

from eavesgrid.operators.crops import crop_rasters, crop_suffix
from eavesgrid.streaming import incremental as N
from shapes import layer, poly, rect, square
from test_crops import TILE, make_raster


@pytest.fixture
def world(spark):
    catalog, tiles, _ = make_raster(spark, 1, {"r0": (0, 0), "r1": (40, 0), "r2": (80, 0)})
    fp = layer(spark, [("a", poly(square(3, 3, 5))), ("ab", poly(rect(35, 3, 10, 5))), ("bc", poly(rect(75, 3, 10, 5))), ("wide", poly(rect(30, 20, 60, 4)))])
    return fp, catalog, tiles


def names(spark, out):
    return sorted((r["raster_id"], r["suffixed_name"]) for r in spark.read.parquet(f"{out}/crops").collect())


def test_stream_resumes(spark, world, tmp_path):
    fp, catalog, tiles = world
    src, out = str(tmp_path / "cat"), str(tmp_path / "out")

    def run():
        N.run_stream(spark, src, catalog.schema, fp, tiles, TILE, out)

    catalog.where("raster_id <> 'r1'").coalesce(1).write.parquet(src)
    run()
    first = names(spark, out)
    run()
    assert names(spark, out) == first  # nothing new, nothing done
    catalog.where("raster_id <> 'r2'").coalesce(1).write.mode("append").parquet(src)  # r0 again, r1 new
    run()
    got = names(spark, out)
    assert got[:2] == [("r0", "a.jpg"), ("r0", "ab.jpg")]
    assert ("r1", "ab_1.jpg") in got and ("r1", "bc_1.jpg") in got and ("r1", "wide_2.jpg") in got
    assert len(got) == len(set(got)) == crop_rasters(fp, catalog, tiles, TILE).count()
    assert {r["raster_id"] for r in spark.read.parquet(f"{out}/ledger").collect()} == {"r0", "r1", "r2"}


def test_failed_batch_leaves_no_duplicate(spark, world, tmp_path):
    fp, catalog, tiles = world
    out = str(tmp_path / "out")
    N.cut_batch(catalog.where("raster_id = 'r0'"), 0, fp, tiles, TILE, out)
    # The crops of batch 1 get written, its ledger does not.
    rest = catalog.where("raster_id <> 'r0'")
    named = N.named_crops(fp, rest, tiles, TILE, earlier=N._finished(spark, out, 1))
    named.write.parquet(f"{out}/crops/batch=1")
    N.cut_batch(rest, 1, fp, tiles, TILE, out)
    N.cut_batch(rest, 1, fp, tiles, TILE, out)
    got = names(spark, out)
    assert len(got) == len(set(got)) == crop_rasters(fp, catalog, tiles, TILE).count()
    N.cut_batch(catalog, 2, fp, tiles, TILE, out)
    assert names(spark, out) == got


def test_first_image_only(spark, world, tmp_path):
    fp, catalog, tiles = world
    out = str(tmp_path / "out")
    for i, r in enumerate(("r0", "r1", "r2")):
        N.cut_batch(catalog.where(F.col("raster_id") == r), i, fp, tiles, TILE, out, with_suffix=False)
    got = names(spark, out)
    assert [n for _, n in got] == ["a.jpg", "ab.jpg", "wide.jpg", "bc.jpg"]
    assert N.read_or_none(spark, str(tmp_path / "nothing")) is None


def test_a_batch_touches_only_its_own_footprints(spark, world, tmp_path, monkeypatch):
    """Suffixes come from the state store: earlier crops are never read, and footprints elsewhere are not planned."""
    fp, catalog, tiles = world
    src, out, seen, planned = str(tmp_path / "cat"), str(tmp_path / "out"), [], []
    read, boxes = N.read_or_none, N.crop_boxes
    monkeypatch.setattr(N, "read_or_none", lambda session, path: seen.append(path) or read(session, path))
    monkeypatch.setattr(N, "crop_boxes", lambda some, rasters: planned.append(sorted(r["id"] for r in some.collect())) or boxes(some, rasters))
    for name in ("r0", "r1", "r2"):
        catalog.where(F.col("raster_id") == name).coalesce(1).write.mode("append").parquet(src)
        N.run_stream(spark, src, catalog.schema, fp, tiles, TILE, out)
    assert planned == [["a", "ab", "wide"], ["ab", "bc", "wide"], ["bc", "wide"]]
    assert seen and not any(path.endswith(N.CROPS) for path in seen)
    assert [n for r, n in names(spark, out) if "wide" in n] == ["wide.jpg", "wide_1.jpg", "wide_2.jpg"]
    assert spark.read.parquet(f"{out}/crops").where("batch = 2").count() == 2


def test_stream_of_first_images_only(spark, world, tmp_path):
    fp, catalog, tiles = world
    src, out = str(tmp_path / "cat"), str(tmp_path / "out")
    for name in ("r2", "r0", "r1"):
        catalog.where(F.col("raster_id") == name).coalesce(1).write.mode("append").parquet(src)
        N.run_stream(spark, src, catalog.schema, fp, tiles, TILE, out, with_suffix=False)
    assert names(spark, out) == [("r0", "a.jpg"), ("r0", "ab.jpg"), ("r2", "bc.jpg"), ("r2", "wide.jpg")]


def test_the_stream_counts_without_a_call_for_each_footprint(spark, world, tmp_path, monkeypatch):
    """A Python call for each footprint made the stream's time; the state is a plain count now."""
    def refused(*_):
        raise AssertionError("one Python call for each footprint")

    monkeypatch.setattr("pyspark.sql.GroupedData.applyInPandasWithState", refused)
    fp, catalog, tiles = world
    src, out = str(tmp_path / "cat"), str(tmp_path / "out")
    for some in (["r2"], ["r0", "r1"]):
        catalog.where(F.col("raster_id").isin(some)).coalesce(1).write.mode("append").parquet(src)
        N.run_stream(spark, src, catalog.schema, fp, tiles, TILE, out)
    got = names(spark, out)
    assert [n for _, n in got if "wide" in n] == ["wide_1.jpg", "wide_2.jpg", "wide.jpg"] and len(got) == crop_rasters(fp, catalog, tiles, TILE).count()


def test_a_batch_broadcasts_no_footprints(spark, world, tmp_path, monkeypatch):
    """Footprints with earlier crops were gathered in the driver where their files looked small."""
    fp, catalog, tiles = world
    out = str(tmp_path / "out")
    spark.createDataFrame([("wide", 0)], "id string, suffix int").write.parquet(f"{out}/crops/batch=0")
    plans = []

    def names_only(some, rasters, *_, earlier, with_suffix):
        named = crop_suffix(rasters.select("raster_id", F.when(F.col("raster_id") == "r1", "wide").alias("id")), earlier)
        plans.append(named._jdf.queryExecution().executedPlan().toString())
        return named

    monkeypatch.setattr(N, "named_crops", names_only)
    N.cut_batch(catalog.where("raster_id = 'r1'"), 1, fp, tiles, TILE, out)
    assert [r["suffix"] for r in spark.read.parquet(f"{out}/crops").where("batch = 1").collect()] == [1]
    by_id = [line for line in plans[0].splitlines() if "Join [id#" in line or "Join [coalesce(id#" in line]
    assert len(by_id) == 2 and all("SortMergeJoin" in line for line in by_id), by_id
