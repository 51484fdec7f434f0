"""Physical plans: no nested loops, no window over one partition, pruned scans, one evaluation per kernel."""

import re

import pytest

from eavesgrid.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"

# What may come to one partition: aggregates over everything, after partial aggregation.
TOTALS = {"removal_counts", "unknown_share", "roof_counts", "split_disjoint", "precision_by_class", "recall_by_class", "log_loss", "evaluate", "train_classifier"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def big_tables(spark):
    """Plans as for large inputs: nothing is broadcast for its size."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def plans(big_tables):
    return {name: plan_of(fn(big_tables, SF)) for name, fn in QUERIES.items() if name != "incremental_stream"}


def test_no_nested_loops(plans):
    assert [n for n, p in plans.items() if "NestedLoop" in p or "Cartesian" in p] == []


def test_single_partition_only_for_totals(plans):
    assert {n for n, p in plans.items() if "SinglePartition" in p} <= TOTALS
    for name, p in plans.items():
        for m in re.finditer(r"\+- Window ", p):
            assert "SinglePartition" not in p[m.start():m.start() + 2000], name


def test_no_row_at_a_time_python(plans):
    assert [n for n, p in plans.items() if "BatchEvalPython" in p] == []


def test_kernels_run_once(plans):
    counts = {n: p.count("ArrowEvalPython [") for n, p in plans.items()}
    assert counts["pair_dedup"] == counts["buffer"] == counts["min_rotated_rect"] == 1
    # One step puts crops together, one prepares and predicts.
    assert counts["score_images"] == 0 and plans["score_images"].count("MapInArrow") == 2 and plans["crop_rasters"].count("MapInArrow") == 1


def test_rectangles_need_no_python(plans):
    assert all("ArrowEvalPython" not in plans[n] for n in ("self_overlap_pairs", "spatial_join", "flag_protected", "crop_rasters"))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("dominant_per_commune", {"p_partkey", "p_brand", "p_type"}),
        ("footprint_raster_join", {"p_partkey", "p_size"}),
        ("train_val_split", {"doc_id"}),
        ("log_loss", {"doc_id", "quality", "n_chars"}),
        ("tile_grid", {"c_custkey"}),
        ("update_on_id", {"p_partkey", "p_size"}),
    ],
)
def test_scans_read_only_what_they_need(plans, name, columns):
    read = set()
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plans[name]):
        read |= {c.split(":")[0] for c in schema.split(",")}
    assert read == columns


def test_filters_reach_the_scan(spark):
    from eavesgrid.operators.images import share_sample
    from eavesgrid.operators.preprocessing import subset

    part = spark.read.parquet(f"{SF}/part.parquet")
    assert "GreaterThanOrEqual(p_size,25" in plan_of(subset(part, "p_size", 25))
    sample = share_sample(part, 0.5, "p_name") if part.select("p_name").distinct().count() == part.count() else None
    if sample is not None:
        assert "GreaterThanOrEqual(p_name" in plan_of(sample)


def test_stored_bbox_filter_reaches_the_scan(spark, tmp_path):
    from eavesgrid.operators.spatial_join import bbox_overlap_filter
    from eavesgrid.plans.fixtures import layer
    from eavesgrid.sinks.tables import write_layer

    write_layer(layer(spark, SF), str(tmp_path / "l"))
    plan = plan_of(bbox_overlap_filter(spark.read.parquet(str(tmp_path / "l")), 0.0, 0.0, 500.0, 500.0).select("id"))
    assert "LessThan(xmin,500.0)" in plan and "geom" not in re.search(r"ReadSchema: (\S+)", plan).group(1)
