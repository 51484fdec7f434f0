"""Footprints, zones, rasters and scores derived from the driver's tables by integer arithmetic.

All coordinates are multiples of 1/8, so areas, overlaps and centroids of these rectangles are exact doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import BBOX, box_geom
from ..operators.preprocessing import with_geometry

RASTER_SIDE, PIXEL, RASTER_PIXELS, TILE = 500, 5.0, 100, 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(df: DataFrame, x0: Column, y0: Column, w: Column, h: Column) -> DataFrame:
    """Rectangles: bbox columns, geometry and flag directly from their corners."""
    sides = {"xmin": x0, "ymin": y0, "xmax": x0 + w, "ymax": y0 + h}
    df = df.withColumns({k: v.cast("double") for k, v in sides.items()})
    return df.withColumn("geom", box_geom(*[F.col(c) for c in BBOX])).withColumn("is_box", F.lit(True))


def commune(brand: Column) -> Column:
    """Brand number as a five-digit code."""
    return F.lpad(F.substring(brand, 7, 10), 5, "0")


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    base = part.select(
        "p_partkey",
        F.concat(F.lit("B"), k.cast("string")).alias("id"),
        commune(F.col("p_brand")).alias("commune"),
        F.col("p_size").alias("score"),
    )
    shaped = boxes(
        base,
        ((k * k * 31 + k * 17) % 20011) / 8.0,
        ((k * k * 53 + k * 101 + 7) % 20011) / 8.0,
        5 + F.col("score") % 20,
        4 + F.col("score") % 13,
    )
    return shaped


def layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footprints(spark, sf_dir).drop("p_partkey")


def courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U-shaped footprints: a rectangle of four times the size with a notch from above, 2 to 14 m wide."""
    base = footprints(spark, sf_dir)
    k = F.col("p_partkey")
    x0, y0 = F.col("xmin"), F.col("ymin")
    w, h, gap = F.col("xmax") - x0, F.col("ymax") - y0, 2.0 + k % 13
    corners = [
        (x0, y0), (x0 + 4 * w, y0), (x0 + 4 * w, y0 + 4 * h), (x0 + w + gap, y0 + 4 * h), (x0 + w + gap, y0 + 2 * h),
        (x0 + w, y0 + 2 * h), (x0 + w, y0 + 4 * h), (x0, y0 + 4 * h), (x0, y0),
    ]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])
    shaped = base.select("id", F.array(F.array(ring)).alias("geom"))
    return with_geometry(shaped)


DENSE_POINTS = 5000  # on each side of a dense shape
DENSE_PER_TASK = 8


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large rectangles with 20,000 points on their sides, as shapes that no kernel may take whole."""
    k = F.col("p_partkey")
    keys = table(spark, sf_dir, "part").where(k % 199 == 0).select(k)
    # A few bytes of a key make a shape of 320 KB, so the keys are dealt to tasks by their number.
    dealt = keys.repartition(keys.count() // DENSE_PER_TASK + 1, k)
    base = dealt.select(F.concat(F.lit("D"), k.cast("string")).alias("id"), k)
    x0, y0 = ((k * k * 41 + k * 13) % 20011) / 8.0, ((k * k * 67 + k * 7 + 3) % 20011) / 8.0
    w, h = (150 + k % 300).cast("double"), (100 + k % 250).cast("double")
    steps = F.sequence(F.lit(0), F.lit(DENSE_POINTS - 1))

    def side(x: Column, y: Column, dx: Column, dy: Column) -> Column:
        return F.transform(steps, lambda i: F.struct((x + dx * i / DENSE_POINTS).alias("x"), (y + dy * i / DENSE_POINTS).alias("y")))

    none = F.lit(0.0)
    corners = (x0, y0, w, none), (x0 + w, y0, none, h), (x0 + w, y0 + h, -w, none), (x0, y0 + h, none, -h)
    ring = F.concat(*[side(*c) for c in corners], F.array(F.struct(x0.alias("x"), y0.alias("y"))))
    sides = {"xmin": x0, "ymin": y0, "xmax": x0 + w, "ymax": y0 + h}
    shaped = base.withColumns(sides).withColumn("geom", F.array(F.array(ring)))
    return shaped.select("id", *BBOX, "geom", F.lit(False).alias("is_box"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    base = table(spark, sf_dir, "supplier").select("s_suppkey")
    return boxes(
        base,
        ((s * s * 37 + s * 11) % 20011) / 8.0,
        ((s * s * 59 + s * 29) % 20011) / 8.0,
        50 + (s % 7) * 25,
        50 + (s % 5) * 25,
    ).select(F.concat(F.lit("Z"), F.col("s_suppkey").cast("string")).alias("zone_id"), *BBOX, "geom", "is_box")


def roofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw roof rows: group id starting with the commune code, type missing for one of the kinds."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.concat(commune(F.col("p_brand")), F.lit("-"), F.col("p_partkey").cast("string")).alias("batiment_groupe_id"),
        F.nullif(F.col("p_type"), F.lit("PROMO")).alias("mat_toit_txt"),
    )


def rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 500 m raster squares that footprints reach into."""
    side = F.lit(RASTER_SIDE)
    cells = (
        layer(spark, sf_dir)
        .select(*BBOX)
        .withColumn("i", F.explode(F.sequence(F.floor(F.col("xmin") / side).cast("int"), F.floor(F.col("xmax") / side).cast("int"))))
        .withColumn("j", F.explode(F.sequence(F.floor(F.col("ymin") / side).cast("int"), F.floor(F.col("ymax") / side).cast("int"))))
        .select("i", "j")
        .distinct()
    )
    i, j = F.col("i"), F.col("j")
    return cells.select(
        F.concat(F.lit("R"), i, F.lit("_"), j).alias("raster_id"),
        "i",
        "j",
        (i * RASTER_SIDE).cast("double").alias("xmin"),
        (j * RASTER_SIDE).cast("double").alias("ymin"),
        ((i + 1) * RASTER_SIDE).cast("double").alias("xmax"),
        ((j + 1) * RASTER_SIDE).cast("double").alias("ymax"),
        F.lit(PIXEL).alias("res"),
        F.lit(RASTER_PIXELS).alias("width"),
        F.lit(RASTER_PIXELS).alias("height"),
        F.lit(1).alias("n_bands"),
    )


def _tiles(spark: SparkSession, sf_dir: str, encode) -> DataFrame:
    """Tiles of the rasters; ``encode`` makes the hex digits of a pixel from its global column and row (rows counted upwards)."""
    steps = F.sequence(F.lit(0), F.lit((RASTER_PIXELS - 1) // TILE))
    cells = (
        rasters(spark, sf_dir)
        .select("raster_id", "i", "j")
        .withColumn("tile_row", F.explode(steps))
        .withColumn("tile_col", F.explode(steps))
        .withColumn("row0", F.col("tile_row") * TILE)
        .withColumn("col0", F.col("tile_col") * TILE)
        .withColumn("rows", F.least(F.lit(TILE), RASTER_PIXELS - F.col("row0")))
        .withColumn("cols", F.least(F.lit(TILE), RASTER_PIXELS - F.col("col0")))
    )

    def value(p: Column) -> Column:
        col = F.col("i") * RASTER_PIXELS + F.col("col0") + p % F.col("cols")
        row = (F.col("j") + 1) * RASTER_PIXELS - 1 - (F.col("row0") + F.floor(p / F.col("cols")).cast("int"))
        return encode(col, row)

    data = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.col("rows") * F.col("cols") - 1), value), ""))
    return cells.select("raster_id", "tile_row", "tile_col", "row0", "col0", "rows", "cols", data.alias("data"))


def _hex_byte(value: Column) -> Column:
    return F.lpad(F.hex(value), 2, "0")


def raster_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8-bit tiles; the value hangs on the global column and row."""
    return _tiles(spark, sf_dir, lambda col, row: _hex_byte((col * 7 + row * 13) % 256))


NODATA_16 = 65535


def rasters_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rasters with 16-bit samples and a value for no data."""
    return rasters(spark, sf_dir).withColumns({"dtype": F.lit("u16"), "nodata": F.lit(float(NODATA_16))})


def raster_tiles_16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16-bit tiles, little-endian; one pixel in eleven is without data."""

    def encode(col: Column, row: Column) -> Column:
        value = F.when((col + 2 * row) % 11 == 0, NODATA_16).otherwise((col * 701 + row * 1303) % 65521)
        return F.concat(_hex_byte(value % 256), _hex_byte(F.floor(value / 256)))

    return _tiles(spark, sf_dir, encode)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rasters(spark, sf_dir).where((F.col("i") + F.col("j")) % 3 == 0).select("raster_id")


def area_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area per customer, smaller than, equal to or no multiple of a 250 pixel image."""
    k = F.col("c_custkey")
    wide = F.when(k % 5 == 0, 250 * (1 + k % 3)).otherwise(100 + (137 * k) % 1100)
    high = F.when(k % 4 == 0, 250 * (1 + k % 2)).otherwise(100 + (211 * k) % 900)
    x, y = 200000.0 + 1000 * (k % 2000), 5400000.0 + 700 * (k % 2000)
    return table(spark, sf_dir, "customer").select(
        k.alias("box_id"), x.alias("min_x"), y.alias("min_y"), (x + wide * 0.25).alias("max_x"),
        (y + high * 0.25).alias("max_y"), F.lit(0.25).alias("resolution"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class probabilities and truths from the embeddings."""
    e = F.col("embedding")
    z = F.transform(F.slice(e, 1, 3), lambda v: F.exp(v.cast("double") * 10))
    total = F.aggregate(z, F.lit(0.0), lambda a, b: a + b)
    suffix = F.when(F.col("vec_id") % 11 == 0, F.lit("_1")).otherwise(F.lit(""))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.concat(F.lit("images/B"), F.col("vec_id").cast("string"), suffix, F.lit(".jpg")).alias("path"),
        F.transform(z, lambda v: v / total).alias("probs"),
        (1 / (1 + F.exp(-e[0].cast("double") * 10))).alias("p"),
        (F.col("label") % 3).alias("truth"),
        F.col("label"),
        F.col("embedding"),
    )


def binary_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.least(F.col("n_chars") / 1000.0, F.lit(1.0)).alias("p"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y_true"))
    return labels.join(docs, "doc_id")


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates for some footprints, for ids the layer does not have, and with missing values."""
    k = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select(k)
    value = F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(k * 0.5)
    known = part.where(k % 3 != 0).select(F.concat(F.lit("B"), k.cast("string")).alias("id"), value.alias("new_score"))
    unknown = part.where(k % 10 == 0).select(F.concat(F.lit("X"), k.cast("string")).alias("id"), value.alias("new_score"))
    return known.unionByName(unknown)


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File paths of a labelled image folder, some of them no images."""
    v = F.col("vec_id")
    folder = F.element_at(F.array(F.lit("no_PV"), F.lit("PV"), F.lit("other")), F.col("label") % 3 + 1)
    ext = F.element_at(F.array(*[F.lit(x) for x in ("jpg", "PNG", "bmp", "txt", "jpeg", "gif", "csv")]), (v % 7 + 1).cast("int"))
    return table(spark, sf_dir, "embeddings").select(
        v, "label", F.concat(F.lit("/data/"), folder, F.lit("/im"), v.cast("string"), F.lit("."), ext).alias("path")
    )
