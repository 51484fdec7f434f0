import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavesgrid.functions import scalars as S
from eavesgrid.operators import images as I
from eavesgrid.operators import scoring as M
from eavesgrid.sinks import tables as K
from eavesgrid.sources.images import list_images, scan_image_folder, scan_prediction_folder

IMG = "path string, height int, width int, n_channels int, data binary"


def bmp(rgb: np.ndarray) -> bytes:
    h, w, _ = rgb.shape
    pad = (-3 * w) % 4
    body = b"".join(rgb[r, :, ::-1].tobytes() + b"\0" * pad for r in range(h - 1, -1, -1))
    head = b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54)
    return head + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 2835, 2835, 0, 0) + body


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(0)
    pixels = {}
    for cls in ("PV", "no_PV"):
        (tmp_path / cls).mkdir()
        for i in range(3):
            img = rng.integers(0, 255, (5 + i, 4, 3), dtype=np.uint8)
            (tmp_path / cls / f"{cls}{i}.bmp").write_bytes(bmp(img))
            pixels[f"{cls}{i}"] = img
    (tmp_path / "PV" / "notes.txt").write_text("no image")
    return tmp_path, pixels


def test_scan_decode_and_prepare(spark, folder):
    path, pixels = folder
    df = scan_image_folder(spark, str(path), "int", ("no_PV", "PV"))
    ready = I.prepare_images(df, (6, 6), "rgb", bgr=True).withColumn("stem", S.path_stem(F.col("path")))
    rows = {r["stem"]: r for r in ready.collect()}
    assert set(rows) == set(pixels)
    for stem, r in rows.items():
        assert r["label"] == (0 if stem.startswith("no") else 1)
        want = I.crop_or_pad(pixels[stem], 6, 6)
        assert r["tensor"] == want.tobytes()
    assert list_images(spark, str(path)).count() == 7
    inferred = scan_image_folder(spark, str(path))
    assert I.inferred_class_names(inferred) == ["PV", "no_PV"]


def test_prediction_folder(spark, folder, tmp_path):
    with pytest.raises(FileNotFoundError, match="images"):
        scan_prediction_folder(spark, str(tmp_path))
    (tmp_path / "images").mkdir()
    (tmp_path / "images" / "12.bmp").write_bytes(bmp(np.zeros((2, 2, 3), np.uint8)))
    df = scan_prediction_folder(spark, str(tmp_path))
    assert df.count() == 1 and "label" not in df.columns


@pytest.mark.parametrize("h, w", [(2, 2), (4, 4), (7, 9), (3, 8), (5, 2)])
def test_crop_or_pad(h, w):
    img = np.arange(1, h * w + 1, dtype=np.uint8).reshape(h, w, 1)
    out = I.crop_or_pad(img, 4, 4)
    assert out.shape == (4, 4, 1)
    want = np.zeros((4, 4), np.uint8)
    for r in range(4):
        for c in range(4):
            rr = r + (h - 4) // 2 if h > 4 else r - (4 - h) // 2
            cc = c + (w - 4) // 2 if w > 4 else c - (4 - w) // 2
            if 0 <= rr < h and 0 <= cc < w:
                want[r, c] = img[rr, cc, 0]
    assert (out[:, :, 0] == want).all()


def test_channels():
    rgba = np.array([[[10, 20, 30, 40]]], np.uint8)
    assert I.to_channels(rgba, 3).tolist() == [[[10, 20, 30]]]
    assert I.to_channels(rgba, 1).tolist() == [[[18]]]
    grey = np.array([[[7]]], np.uint8)
    assert I.to_channels(grey, 3).tolist() == [[[7, 7, 7]]]
    assert I.to_channels(grey, 4).tolist() == [[[7, 7, 7, 255]]]
    assert I.to_channels(rgba[:, :, :3], 4).tolist() == [[[10, 20, 30, 255]]]


def some_images(spark, n=20):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        h, w, c = rng.integers(1, 8), rng.integers(1, 8), rng.choice([1, 3, 4])
        rows.append((f"/d/{'PV' if i % 2 else 'no_PV'}/{i}.png", int(h), int(w), int(c), bytearray(rng.integers(0, 255, h * w * c, dtype=np.uint8).tobytes())))
    return spark.createDataFrame(rows, IMG)


def test_augmentation_hangs_on_the_key_alone(spark):
    df = some_images(spark)
    key = lambda epoch: F.concat_ws("#", "path", F.lit(str(epoch)))
    a, b, c = (
        {r["path"]: r["tensor"] for r in I.prepare_images(df.repartition(n), (4, 4), "rgb", key(e)).collect()}
        for n, e in ((1, 0), (7, 0), (7, 1))
    )
    assert a == b and a != c
    plain = {r["path"]: r["tensor"] for r in I.prepare_images(df, (4, 4), "rgb").collect()}
    assert all(len(plain[k]) == len(a[k]) == 48 for k in a) and plain != a


def test_user_transform_runs_first(spark):
    df = some_images(spark, 4)
    out = I.prepare_images(df, (2, 2), "grayscale", transform=lambda img: np.full((2, 2, 1), 9, np.uint8)).collect()
    assert all(r["tensor"] == b"\t" * 4 for r in out)
    with pytest.raises(ValueError, match="color_mode"):
        I.prepare_images(df, (2, 2), "cmyk")


def test_fit_images_are_written_by_split_and_class(spark, tmp_path):
    df = I.index_images(some_images(spark, 60), "binary", ("no_PV", "PV"))
    ready = I.prepare_fit_images(df, "path", 0.6, 0.3, img_size=(4, 4))
    ready.write.partitionBy("split", "class_name").parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert {r[0] for r in back.select("split").distinct().collect()} == {"train", "validation"}
    assert I.split_disjoint(back, "path").first()["n_both"] == 0


def test_index_images(spark):
    paths = ["/d/b/1.jpg", "/d/a/2.JPEG", "/d/c/3.gif", "/d/a/4.txt", "5.jpg"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    auto = {r["path"]: r["label"] for r in I.index_images(df.where("path like '/%'")).collect()}
    assert auto == {"/d/a/2.JPEG": 0, "/d/b/1.jpg": 1, "/d/c/3.gif": 2}
    picked = {r["path"]: r["label"] for r in I.index_images(df, "int", ("c", "a")).collect()}
    assert picked == {"/d/a/2.JPEG": 1, "/d/c/3.gif": 0, "/d/b/1.jpg": None, "5.jpg": None}
    hot = I.index_images(df, "categorical", ("c", "a")).where("class_name = 'a'").first()["label"]
    assert hot == [0.0, 1.0]
    assert I.index_images(df, None).count() == 4
    with pytest.raises(ValueError, match="exactly 2"):
        I.index_images(df, "binary", ("a", "b", "c"))
    with pytest.raises(ValueError, match="label mode"):
        I.index_images(df, "other")
    with pytest.raises(ValueError, match="no images"):
        I.require_images(I.image_paths(df.where("path like '%txt'")))


def test_labels_list(spark):
    df = spark.createDataFrame([("a.jpg",), ("b.png",), ("c.txt",)], "path string")
    labels = spark.createDataFrame([("b.png", 4)], "path string, label int")
    assert {r["path"]: r["label"] for r in I.image_labels_list(df, labels).collect()} == {"a.jpg": None, "b.png": 4}
    assert I.image_labels_list(df, None).columns == ["path"]
    with pytest.raises(ValueError, match="class_names"):
        I.image_labels_list(df, labels, class_names=("x",))


def test_shares(spark):
    df = spark.createDataFrame([(f"{i:03d}.jpg",) for i in range(50)], "path string").repartition(5)
    assert I.share_sample(df, 1.0).count() == 50
    assert sorted(r[0] for r in I.share_sample(df, 0.1).collect()) == [f"{i:03d}.jpg" for i in range(45, 50)]
    assert [r[0] for r in I.sorted_paths(df).collect()] == [f"{i:03d}.jpg" for i in range(50)]
    for bad in (0, -1, 1.5):
        with pytest.raises(ValueError, match="share"):
            I.share_sample(df, bad)


def test_splits(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("path"))
    split = I.train_val_split(df, "path", 0.8, 0.2)
    assert split.count() == 2000 and I.split_disjoint(split, "path").first()["n_both"] == 0
    assert split.where("split = 'train'").count() == pytest.approx(1600, abs=80)
    assert {r["split"]: r["count"] for r in I.exact_split(df, "path", 0.8, 0.2).groupBy("split").count().collect()} == {"train": 1600, "validation": 400}
    assert I.train_val_split(df, "path", 0.1, 0.1).count() < 600
    two = I.train_val_split(df, "path", 0.9, 0.9, validation_images=df)
    assert two.where("split = 'validation'").count() > 1700
    for a, b in ((0.8, 0.3), (1.0, 0.1), (0.5, 0.0)):
        with pytest.raises(ValueError):
            I.train_val_split(df, "path", a, b)
    other = I.train_val_split(df, "path", 0.8, 0.2, seed=1).where("split = 'train'")
    assert other.exceptAll(split.where("split = 'train'")).count() > 0


def test_scores(spark, tmp_path):
    def model(values):
        return 1 / (1 + np.exp(-(values.mean(axis=1, keepdims=True) - 100) / 20))

    rows = [(f"images/{n}.jpg", 2, 2, 1, bytearray([v] * 4)) for n, v in (("1", 50), ("2", 200), ("3_1", 200), ("4.x", 200), ("5", 100))]
    df = spark.createDataFrame([*rows, ("images/broken.jpg", None, None, None, None)], IMG)
    scores = M.score_images(df, M.bytes_model(model), ("no_PV", "PV"), (2, 2), "grayscale")
    got = {r["building_name"]: r for r in scores.collect()}
    assert set(got) == {"1", "2", "3_1", "4.x", "5", "broken"}
    assert got["broken"]["score"] is None and got["broken"]["predicted_class"] is None
    plain = M.score_images(df, M.bytes_model(model), ("no_PV", "PV"), (2, 2), "grayscale", drop_suffixed=True)
    assert {r["building_name"] for r in plain.collect()} == {"1", "2", "5", "broken"}
    scores = plain.where("score is not null")
    got = {r["building_name"]: got[r["building_name"]] for r in scores.collect()}
    assert got["2"]["predicted_class"] == "PV" and got["2"]["score"] == pytest.approx(1 / (1 + np.exp(-5)), abs=1e-7)
    assert got["5"]["predicted_class"] == "no_PV" and got["5"]["score"] == 0.5  # the threshold is strict
    K.export_prediction(scores, str(tmp_path / "o"), df.withColumn("building_name", S.path_stem(F.col("path"))))
    text = spark.read.option("header", True).csv(str(tmp_path / "o" / "scores.csv"))
    assert text.columns == ["Building name", "Score", "Predicted class"]
    assert {r["Score"] for r in text.collect()} == {f"{got[k]['score']:.7f}" for k in got}
    routed = spark.read.parquet(str(tmp_path / "o" / "images"))
    assert {(r["building_name"], r["predicted_class"]) for r in routed.collect()} == {("1", "no_PV"), ("2", "PV"), ("5", "no_PV")}
    with pytest.raises(ValueError, match="neither"):
        K.export_prediction(scores, str(tmp_path / "p"), None, save_scores=False)


def test_more_classes(spark):
    df = spark.createDataFrame([("a.jpg", [0.2, 0.5, 0.3]), ("b.jpg", [0.4, 0.4, 0.2])], "path string, probs array<double>")
    plain = {r["building_name"]: (r["score"], r["predicted_class"]) for r in M.postprocess(df, ("x", "y", "z")).collect()}
    assert plain == {"a": (0.5, "y"), "b": (0.4, "x")}
    twice = M.postprocess(df, ("x", "y", "z"), double_softmax=True).where("building_name = 'a'").first()["score"]
    e = np.exp([0.2, 0.5, 0.3])
    assert twice == pytest.approx(e.max() / e.sum(), abs=1e-7)
    total = df.select(F.aggregate(S.softmax(F.col("probs")), F.lit(0.0), lambda a, b: a + b).alias("t")).collect()
    assert all(r["t"] == pytest.approx(1) for r in total)


def test_suffix_column_instead_of_names(spark):
    df = spark.createDataFrame([("75_12.jpg", 0, [0.9]), ("76.jpg", 1, [0.9])], "path string, suffix int, probs array<double>")
    for choice in (F.col("suffix") == 0, None):
        out = M.postprocess(df, ("n", "y"), drop_suffixed=choice)
        assert [(r["building_name"], r["path"]) for r in out.collect()] == [("75_12", "75_12.jpg")]
    assert M.postprocess(df, ("n", "y"), drop_suffixed=False).count() == 2


def test_equal_names_are_routed_by_path(spark):
    images = spark.createDataFrame([("/a/x.jpg", [0.9]), ("/b/x.jpg", [0.1])], "path string, probs array<double>")
    routed = M.route_by_class(M.postprocess(images, ("n", "y")), images)
    assert sorted((r["path"], r["predicted_class"]) for r in routed.collect()) == [("/a/x.jpg", "y"), ("/b/x.jpg", "n")]


def test_three_class_model(spark):
    df = some_images(spark, 9)

    def three(values):
        z = np.column_stack([values.mean(1), values.max(1), values.min(1)]) / 50
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    out = M.score_images(df, M.bytes_model(three), ("a", "b", "c"), (4, 4), "rgb").collect()
    assert len(out) == 9 and all(1 / 3 <= r["score"] <= 1 for r in out)


def test_augmentation_by_numbers_counted_off_the_key(spark):
    import hashlib

    row = I.prepare_images(some_images(spark, 1), (4, 4), "rgb", F.lit("a key")).first()
    plain = np.frombuffer(I.prepare_images(some_images(spark, 1), (4, 4), "rgb").first()["tensor"], np.uint8).reshape(4, 4, 3)
    u = [int(hashlib.md5(f"a key#{k}".encode()).hexdigest()[:8], 16) / 2**32 for k in (0, 1)]
    assert row["tensor"] == I.augment(plain, *u).tobytes()
    assert I.augment(np.full((2, 2, 1), 100, np.uint8), 1.0, 0.5).tolist() == [[[132]] * 2] * 2  # brighter by 12.5 % of 255, no contrast
