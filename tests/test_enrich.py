import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from eavesgrid.functions import scalars as S
from eavesgrid.operators import enrich as E
from eavesgrid.operators import preprocessing as P
from eavesgrid.operators.indexing import with_row_index
from eavesgrid.plans.enrichment import enrich_footprints
from eavesgrid.sinks import tables as K
from eavesgrid.sources.layers import scan_roof_csv
from shapes import TRIANGLE, layer, poly, rect, square


def roofs(spark, rows):
    return spark.createDataFrame(rows, "batiment_groupe_id string, mat_toit_txt string")


ROOFS = [("75001-a", "tile"), ("75001-b", "tile"), ("75001-c", "slate"), ("2A004-a", None), ("2A004-b", None), ("2A004-c", "tile"),
         ("13055-a", "zinc"), ("13055-b", "slate"), (None, "tile")]


def test_dominant_roof(spark):
    got = {r["commune"]: (r["toiture"], r["n"]) for r in E.dominant_roof(roofs(spark, ROOFS)).collect()}
    assert got == {"75001": ("tile", 2), "2A004": ("UNKNOWN", 2), "13055": ("slate", 1)}


def test_roof_join_and_counts(spark):
    df = spark.createDataFrame([("a", "75001"), ("b", "99999"), ("c", None)], "id string, commune string")
    got = {r["id"]: r["toiture"] for r in E.add_roof_type(df, roofs(spark, ROOFS)).collect()}
    assert got == {"a": "tile", "b": "UNKNOWN", "c": "UNKNOWN"}
    counts = [(r["roof"], r["n"]) for r in E.roof_counts(roofs(spark, ROOFS)).collect()]
    assert counts == [("tile", 3), ("UNKNOWN", 2), ("slate", 2), ("zinc", 1)]  # rows without a commune are not counted
    shares = {r["toiture"]: r["share"] for r in E.unknown_share(roofs(spark, ROOFS)).collect()}
    assert shares["UNKNOWN"] == pytest.approx(1 / 3)


def test_roof_csv_binds_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("mat_toit_txt,extra,batiment_groupe_id\ntile,1,75001-a\n,2,75001-b\n")
    rows = scan_roof_csv(spark, str(tmp_path / "r.csv")).collect()
    assert [(r["batiment_groupe_id"], r["mat_toit_txt"]) for r in rows] == [("75001-a", "tile"), ("75001-b", None)]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="mat_toit_txt"):
        scan_roof_csv(spark, str(tmp_path / "bad.csv"))


def test_update_on_id(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), ("c", 4.0)], "ID string, score double")
    upd = spark.createDataFrame([("a", 9.0, "x"), ("b", None, None), ("zz", 1.0, "n")], "ID string, score double, kind string")
    got = sorted((r["ID"], r["score"], r["kind"]) for r in E.update_on_id(df, upd).collect() if r["ID"] != "c")
    assert got == [("a", 9.0, "x"), ("a", 9.0, "x"), ("b", None, None)]
    assert [tuple(r) for r in E.update_on_id(df, upd).where("ID = 'c'").collect()] == [("c", 4.0, None)]


def test_update_key_other_than_id(spark):
    df = spark.createDataFrame([("a", 1.0)], "ID string, score double")
    upd = spark.createDataFrame([("a", "ignored", 5.0)], "name string, ID string, score double")
    assert [tuple(r) for r in E.update_on_id(df, upd, key="name").collect()] == [("a", 5.0)]


def test_update_refuses(spark):
    df = spark.createDataFrame([("a", 1.0)], "ID string, score double")
    twice = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "ID string, score double")
    with pytest.raises(Exception, match="more than one update for id a"):
        E.update_on_id(df, twice).collect()
    dated = spark.createDataFrame([("a",)], "ID string").withColumn("d", F.current_date())
    with pytest.raises(TypeError, match="date"):
        E.update_on_id(df, dated)
    with pytest.raises(KeyError, match="ID"):
        E.update_on_id(df.drop("ID"), twice)
    assert E.update_on_id(df, spark.createDataFrame([("a", True)], "ID string, ok boolean")).first()["ok"] is True


def test_flag_protected(spark):
    df = layer(spark, [("in", poly(square(1, 1, 1))), ("touch", poly(square(4, 0, 1))), ("out", poly(square(9, 9, 1))), ("diag", poly(square(3, 3, 1)))])
    zones = layer(spark, [("z1", TRIANGLE), ("z2", poly(square(0, 0, 2)))])
    got = {r["id"]: r["protected"] for r in E.flag_protected(df, zones).collect()}
    assert got == {"in": True, "touch": True, "out": False, "diag": False}
    assert E.flag_protected(df.limit(0), zones).count() == 0
    assert not any(r["protected"] for r in E.flag_protected(df, zones.limit(0)).collect())


def test_flag_is_per_row(spark):
    """Rows sharing an id, or without one, are flagged by their own shape."""
    df = layer(spark, [("a", poly(square(0, 0, 1))), ("a", poly(square(50, 0, 1))), (None, poly(square(1, 1, 1))), (None, poly(square(60, 0, 1))), ("n", None)])
    out = E.flag_protected(df, layer(spark, [("z", poly(square(0, 0, 4)))]))
    got = sorted((r["id"] or "-", r["xmin"] if r["xmin"] is not None else -1, r["protected"]) for r in out.collect())
    assert got == [("-", 1, True), ("-", 60, False), ("a", 0, True), ("a", 50, False), ("n", -1, False)]


def test_flag_protected_in_degrees(spark):
    """A zone around 3 E 46.5 N lies around the Lambert-93 origin."""
    df = layer(spark, [("near", poly(square(700000, 6600000, 10))), ("away", poly(square(800000, 6600000, 10)))])
    zones = layer(spark, [("z", poly(rect(2.99, 46.49, 0.02, 0.02)))])
    got = {r["id"]: r["protected"] for r in E.flag_protected(df, zones, lonlat=True).collect()}
    assert got == {"near": True, "away": False}


def test_remove_small_counts_without_a_second_pass(spark):
    df = layer(spark, [("ten", poly(rect(0, 0, 5, 2))), ("more", poly(rect(0, 0, 5, 3))), ("tri", TRIANGLE)])
    seen = Observation()
    kept = P.remove_small_features(df, 10, seen)
    assert [r["id"] for r in kept.collect()] == ["more"]  # an area equal to the limit goes
    assert seen.get == {"total": 3, "removed": 2}
    assert tuple(P.removal_counts(df, 10).first()) == (3, 2, 1)


def test_subset_drops_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (0.5,)], "s double")
    assert P.subset(df, "s", 0.5).count() == 2


def test_drop_prefix_of_awkward_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, joint_x int, my_joint_ int")
    assert P.drop_prefixed(df).columns == ["a.b", "my_joint_"]


@pytest.mark.parametrize("parts", [1, 5])
def test_ids_follow_the_order(spark, parts):
    df = spark.range(1000).withColumn("k", F.col("id") * 37 % 1000).drop("id").repartition(parts)
    rows = {r["k"]: r["ID"] for r in P.add_id(df, ["k"], "75").collect()}
    assert rows == {k: f"75{k}" for k in range(1000)}


def test_row_index_of_nothing(spark):
    df, total = with_row_index(spark.range(0), ["id"])
    assert total == 0 and df.count() == 0


def test_row_index_with_a_frequent_key(spark):
    df = spark.range(900).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    rows, total = with_row_index(df, ["k", "id"])
    got = [r["row_index"] for r in rows.orderBy("k", "id").collect()]
    assert total == 900 and got == list(range(900))


def test_missing_columns_fail_early(spark):
    with pytest.raises(KeyError, match="geom"):
        P.compute_area(spark.range(1))


def test_copy_is_the_same_rows(spark):
    df = spark.range(3)
    assert P.copy_layer(df, "x").select("x_copy.id").count() == 3


def test_chain(spark):
    df = layer(spark, [("a", poly(square(0, 0, 4)), "75001"), ("s", poly(square(0, 0, 1)), "75001"), ("b", poly(square(50, 0, 5)), "xx")], "commune string")
    out = {r["id"]: r for r in enrich_footprints(df, layer(spark, [("z", TRIANGLE)]), roofs(spark, ROOFS)).collect()}
    assert set(out) == {"a", "b"}
    assert (out["a"]["protected"], out["a"]["toiture"], out["a"]["X"]) == (True, "tile", 2.0)
    assert (out["b"]["protected"], out["b"]["toiture"]) == (False, "UNKNOWN")


def test_sinks(spark, tmp_path):
    df = layer(spark, [("a", poly(square(0, 0, 4)), 1.5), ("t", TRIANGLE, None)])
    with pytest.raises(AttributeError, match="csv"):
        K.write_attributes(df, str(tmp_path / "out.txt"))
    K.write_attributes(df, str(tmp_path / "out.csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out.csv")).columns == ["id", "score"]
    for fmt in ("parquet", "csv"):
        K.write_layer(df, str(tmp_path / fmt), fmt)
        back = {r["id"]: r for r in K.read_back(spark, str(tmp_path / fmt), df, fmt).collect()}
        assert back["t"]["geom"] == [[[(0, 0), (4, 0), (0, 4), (0, 0)]]] and back["a"]["is_box"] and back["a"]["score"] == 1.5
    with pytest.raises(ValueError, match="shp"):
        K.write_layer(df, str(tmp_path / "x"), "shp")


@pytest.mark.parametrize(
    "path, stem",
    [("/a/b/12.jpg", "12"), ("12_3.png", "12_3"), ("/a/x.y.jpg", "x.y"), ("/a/.hidden", ".hidden"), ("/a/none", "none"), ("/a.b/c", "c")],
)
def test_path_stem(spark, path, stem):
    assert spark.createDataFrame([(path,)], "p string").select(S.path_stem(F.col("p")).alias("s")).first()["s"] == stem


@pytest.mark.parametrize("name, kept", [("12", True), ("12_3", False), ("ab_1", True), ("x.y", False), ("75_12", False), ("a_b", True)])
def test_plain_names(spark, name, kept):
    assert spark.createDataFrame([(name,)], "p string").select(S.keep_plain_names(F.col("p")).alias("s")).first()["s"] is kept


def test_cells_inside_zones_settle_footprints(spark):
    from eavesgrid.operators.spatial_join import fill_cells

    zones = layer(spark, [(f"z{i}", poly(rect(0, 0, 60, 60 + i))) for i in range(5)])
    df = layer(spark, [("in", poly(rect(20, 20, 5, 4))), ("edge", poly(rect(60, 20, 5, 4))), ("out", poly(rect(90, 20, 5, 4)))])
    keyed = df.withColumn("_row", F.struct("id"))
    sure = E._in_covered_cells(keyed, fill_cells(zones).distinct())
    assert [r["_row"]["id"] for r in sure.collect()] == ["in"]
    assert {r["id"]: r["protected"] for r in E.flag_protected(df, zones).collect()} == {"in": True, "edge": True, "out": False}
