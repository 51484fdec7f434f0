import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from eavesgrid.operators import metrics as M
from eavesgrid.operators import tiles as T
from eavesgrid.operators import training as L
from eavesgrid.sinks import tables as K


def binary(spark):
    rows = [(0, 0.1), (0, 0.5), (0, 0.9), (1, 0.6), (1, 0.2), (1, 1.0), (1, 0.0)]
    return spark.createDataFrame(rows, "y_true int, p double")


def test_binary_metrics(spark):
    df = binary(spark)
    prec = {r["class_name"]: r["precision"] for r in M.precision_by_class(df, ("n", "y")).collect()}
    rec = {r["class_name"]: r["recall"] for r in M.recall_by_class(df, ("n", "y")).collect()}
    assert prec == pytest.approx({"n": 2 / 4, "y": 2 / 3}, abs=1e-6)
    assert rec == pytest.approx({"n": 2 / 3, "y": 2 / 4}, abs=1e-6)
    clip = lambda p: min(max(p, 1e-7), 1 - 1e-7)
    want = sum(-math.log(clip(p) if y else 1 - clip(p)) for y, p in map(tuple, df.collect())) / 7
    assert M.log_loss(df, 2).first()[0] == pytest.approx(want)
    table = {(r["y_true"], r["y_pred"]): r["n"] for r in M.confusion_matrix(df, 2).collect()}
    assert table == {(0, 0): 2, (0, 1): 1, (1, 1): 2, (1, 0): 2}
    wide = {r["metric"]: r["value"] for r in M.evaluate(df, ("n", "y")).collect()}
    assert wide["loss"] == pytest.approx(want) and wide["Recall (class: y)"] == pytest.approx(0.5, abs=1e-6)
    assert list(r["metric"] for r in M.evaluate(df, ("n", "y")).collect()) == [
        "loss", "Precision (class: n)", "Precision (class: y)", "Recall (class: n)", "Recall (class: y)"]


def test_absent_class_gives_zero(spark):
    df = spark.createDataFrame([(0, [0.7, 0.2, 0.1]), (0, [0.5, 0.5, 0.0])], "y_true int, p array<double>")
    prec = {r["class_name"]: r["precision"] for r in M.precision_by_class(df, ("a", "b", "c")).collect()}
    assert prec == pytest.approx({"a": 1, "b": 0, "c": 0}, abs=1e-6)


def test_batch_average_differs_from_the_whole(spark):
    df = binary(spark).withColumn("batch", F.when(F.col("p") < 0.55, 0).otherwise(1))
    whole = {r["class_name"]: r["recall"] for r in M.recall_by_class(df, ("n", "y")).collect()}
    mean = {r["class_name"]: r["recall"] for r in M.recall_by_class(df, ("n", "y"), "batch").collect()}
    assert mean["n"] == pytest.approx((2 / 2 + 0 / 1) / 2, abs=1e-6) and mean["n"] != pytest.approx(whole["n"], abs=1e-3)


def box(spark, *rows):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)],
                                 "box_id long, min_x double, min_y double, max_x double, max_y double, resolution double")


def test_tile_grid(spark):
    df = box(spark, (0, 0, 50, 50, 0.2), (0, 0, 100, 50, 0.2), (0, 0, 130, 60, 0.2), (0, 0, 30, 10, 0.2), (1e6, 5e6, 1e6 + 500, 5e6 + 500, 0.2))
    rows = T.tile_grid(df).collect()
    by = {}
    for r in rows:
        by.setdefault(r["box_id"], {})[r["tile_name"]] = (r["min_x"], r["min_y"], r["max_x"], r["max_y"])
    assert set(by[0]) == {"0-0"} and set(by[1]) == {"0-0", "1-0"}
    assert by[2]["1-0"] == pytest.approx((65, 5, 115, 55)) and len(by[2]) == 2
    assert by[3] == {"0-0": (0, 0, 30, 10)}
    assert len(by[4]) == 100  # no extra tile from adding up floats


def test_huge_box_is_spread(spark):
    grid = T.tile_grid(box(spark, (0, 0, 400 * 50, 300 * 50, 0.2), (0, 0, 50, 50, 0.2)))
    assert grid.count() == 120001 and grid.where("box_id = 0").select("tile_name").distinct().count() == 120000
    by_task = grid.where("box_id = 0").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert by_task < 120000


def test_manifest(spark):
    url = T.tile_manifest(T.tile_grid(box(spark, (0, 0, 30.1, 10, 0.2)))).first()["url"]
    assert "&WIDTH=151&HEIGHT=50&BBOX=0.0,0.0,30.1,10.0" in url
    assert T.tile_manifest(T.tile_grid(box(spark, (0, 0, 30, 10, 0.2))), "http://x?").first()["url"].startswith("http://x?&WIDTH")


def test_world_bounds(spark):
    df = box(spark, (0, 0, 1, 1, 1), (3e7, 0, 4e7, 1, 1), (2, 0, 1, 1, 1))
    assert [r["in_world"] for r in T.check_world_bounds(df).orderBy("box_id").collect()] == [True, False, False]


def test_attempts(spark):
    grid = T.tile_grid(box(spark, (0, 0, 100, 50, 0.2)))
    got = grid.where("tile_name = '0-0'").select("box_id", "tile_name")
    assert T.pending_tiles(grid, got, 4).count() == 1 and T.pending_tiles(grid, got, 5).count() == 0
    assert [r["tile_name"] for r in T.failed_tiles(grid, got).collect()] == ["1-0"]


def blobs(spark, k):
    rows = [(i, [float(i % k) * 4 + (i % 7) / 10, float((i * 3) % k) + (i % 5) / 10], i % k) for i in range(150)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


@pytest.mark.parametrize("k", [2, 3])
def test_train_save_load(spark, tmp_path, k):
    info = L.ModelInfo("roofs", (100, 80), tuple("abc"[:k]))
    df = blobs(spark, k)
    seen = Observation()  # a session that has observed something must still be able to predict
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 150}
    model = L.train_classifier(df, info)
    K.save_model(spark, model, info, str(tmp_path))
    again, meta = K.load_model(spark, str(tmp_path / "roofs.metadata"), str(tmp_path / "roofs.model"))
    assert meta == info and meta.class_index["b"] == 1 and meta.mode == ("BINARY" if k == 2 else "CATEGORICAL")
    first, second = (
        {r["id"]: r["p"] for r in L.predict_classifier(m, df, info).collect()} for m in (model, again)
    )
    assert first == second
    result = {r["metric"]: r["value"] for r in M.evaluate(L.predict_classifier(again, df, info).withColumnRenamed("label", "y_true"), info.class_names).collect()}
    assert result["Precision (class: b)"] > 0.9


def test_bad_metadata(spark, tmp_path):
    (tmp_path / "x.metadata").write_text("not json")
    with pytest.raises(ValueError, match="save_model"):
        K.load_metadata(spark, str(tmp_path / "x.metadata"))
    with pytest.raises(ValueError, match=".model"):
        K.load_model(spark, str(tmp_path / "x.metadata"), str(tmp_path / "x.keras"))
    assert L.ModelInfo("m").class_names == ("no_PV", "PV") and L.ModelInfo("m").img_size == (250, 250)
