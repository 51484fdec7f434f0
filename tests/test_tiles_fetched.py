"""Fetching with retries: attempts, resuming after a failure, and scores of what came."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavesgrid.operators import scoring, tiles


def grid_of(spark, n=12):
    return spark.createDataFrame([(i % 3, f"{i}-0", i) for i in range(n)], "box_id long, tile_name string, k int")


def service(calls, comes):
    """Tiles with ``comes(k) == attempt`` arrive, each twice; foreign ones come along."""

    def fetch(pending, attempt):
        calls.append((attempt, pending.count()))
        here = [r for r in pending.collect() if comes(r["k"]) == attempt]
        rows = [(r["box_id"], r["tile_name"], 1, 1, 1, bytearray([r["k"]])) for r in here for _ in range(2)] + [(99, "x", 1, 1, 1, bytearray([0]))]
        return pending.sparkSession.createDataFrame(rows, "box_id long, tile_name string, height int, width int, n_channels int, data binary")

    return fetch


def test_attempts_until_all_have_come(spark, tmp_path):
    calls = []
    came, failed = tiles.fetch_tiles(grid_of(spark), service(calls, lambda k: k % 3), str(tmp_path / "a"))
    assert calls == [(0, 12), (1, 8), (2, 4)] and failed.count() == 0  # no fourth attempt
    assert sorted((r["tile_name"], r["attempt"], r["data"][0]) for r in came.collect()) == sorted((f"{k}-0", k % 3, k) for k in range(12))


def test_tiles_that_never_come(spark, tmp_path):
    calls = []
    came, failed = tiles.fetch_tiles(grid_of(spark), service(calls, lambda k: k), str(tmp_path / "a"), max_attempts=4)
    assert [c[0] for c in calls] == [0, 1, 2, 3] and came.count() == 4
    assert {r["tile_name"] for r in failed.collect()} == {f"{k}-0" for k in range(4, 12)}
    nothing, failed = tiles.fetch_tiles(grid_of(spark), service([], lambda k: k), str(tmp_path / "b"), max_attempts=0)
    assert nothing is None and failed.count() == 12


def test_a_broken_attempt_is_made_again(spark, tmp_path):
    calls, good = [], service([], lambda k: k % 2)

    def broken(pending, attempt):
        calls.append(attempt)
        if attempt == 1 and calls.count(1) == 1:
            return good(pending, attempt).withColumn("data", F.raise_error(F.lit("cut off")).cast("binary"))
        return good(pending, attempt)

    path = str(tmp_path / "a")
    with pytest.raises(Exception, match="cut off"):
        tiles.fetch_tiles(grid_of(spark), broken, path)
    came, failed = tiles.fetch_tiles(grid_of(spark), broken, path)
    assert calls == [0, 1, 1] and came.count() == 12 and failed.count() == 0
    again, _ = tiles.fetch_tiles(grid_of(spark), broken, path)
    assert calls == [0, 1, 1] and again.count() == 12  # nothing is asked for twice


def test_areas_to_scores(spark, tmp_path):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 50.0, 0.2)], "box_id long, min_x double, min_y double, max_x double, max_y double, resolution double")

    def fetch(pending, attempt):
        some = pending.where((F.col("col") != 1) & (F.col("col") % 2 == attempt))
        return some.select("box_id", "tile_name", *[F.lit(1).alias(c) for c in ("height", "width", "n_channels")], F.unhex(F.lit("FF")).alias("data"))

    model = scoring.bytes_model(lambda values: values.mean(axis=1, keepdims=True) / 255.0)
    scores, failed = scoring.score_areas(boxes, fetch, str(tmp_path / "a"), model, ("no", "yes"), (1, 1), "grayscale", max_attempts=2)
    n = tiles.tile_grid(boxes).count()
    assert scores.count() + failed.count() == n > 1 and all(r["tile_name"].startswith("1-") for r in failed.collect())
    assert {(r["score"], r["predicted_class"]) for r in scores.collect()} == {(1.0, "yes")} and np.isfinite(scores.first()["score"])
    empty, failed = scoring.score_areas(boxes, fetch, str(tmp_path / "b"), model, ("no", "yes"), (1, 1), "grayscale", max_attempts=0)
    assert empty.count() == 0 and failed.count() == n and empty.columns == scores.columns
