"""Tile grids over bounding boxes and the bookkeeping of fetching them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, read_or_none

# The image service asked for tiles and its request parameters.
SERVICE = (
    "https://data.geopf.fr/wms-r?LAYERS=HR.ORTHOIMAGERY.ORTHOPHOTOS&FORMAT=image/jpeg"
    "&SERVICE=WMS&VERSION=1.3.0&REQUEST=GetMap&STYLES&CRS=EPSG:3857"
)
MAX_ATTEMPTS = 5
KEY = ["box_id", "tile_name"]
TILES, LEDGER = "tiles", "ledger"
MANY_TILES = 100_000
WORLD_3857 = 20037508.342789244  # half the side of the EPSG:3857 world square, metres


def check_world_bounds(boxes: DataFrame) -> DataFrame:
    """Adds ``in_world``: the box is not empty and lies inside the EPSG:3857 square."""
    w = F.lit(WORLD_3857)
    return boxes.withColumn(
        "in_world",
        (F.col("min_x") >= -w) & (F.col("max_x") <= w) & (F.col("min_y") >= -w) & (F.col("max_y") <= w)
        & (F.col("min_x") < F.col("max_x")) & (F.col("min_y") < F.col("max_y")),
    )


def _axis(lo: str, hi: str, res: Column, img: int) -> tuple[Column, Column, Column]:
    """(number of tiles, first corner, pixels per tile) along one axis."""
    pixels = F.round((F.col(hi) - F.col(lo)) / res, 6)  # resolutions such as 0.2 are not exact in binary
    single = pixels <= img
    count = F.when(single, F.lit(1)).otherwise(F.floor(pixels / img).cast("int"))
    # What does not fill a whole image is trimmed equally on both sides.
    trim = F.when(single, F.lit(0.0)).otherwise((pixels - count * img) / 2 * res)
    return count, F.col(lo) + trim, F.when(single, pixels).otherwise(F.lit(float(img)))


def tile_grid(boxes: DataFrame, img_height: int = 250, img_width: int = 250) -> DataFrame:
    """All tiles of all boxes (``box_id, min_x, min_y, max_x, max_y, resolution``).

    Result: ``box_id, tile_name, col, row, min_x, min_y, max_x, max_y, used_width, used_height``, tiles named
    ``<col>-<row>`` from the lower left.
    """
    res = F.col("resolution")
    nx, x0, w = _axis("min_x", "max_x", res, img_width)
    ny, y0, h = _axis("min_y", "max_y", res, img_height)
    sized = boxes.select(
        "box_id", "resolution", nx.alias("nx"), x0.alias("x0"), w.alias("used_width"),
        ny.alias("ny"), y0.alias("y0"), h.alias("used_height"),
    )
    by_col = sized.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
    wide = F.col("nx").cast("long") * F.col("ny") > MANY_TILES
    # The columns of a huge box are spread over the cluster before each gives its tiles.  The number is given because
    # the adaptive planner would put these few small rows together again.
    parts = int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = by_col.where(wide).repartition(parts, "box_id", "col")
    grid = by_col.where(~wide).unionByName(spread)
    grid = grid.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    dx, dy = F.col("used_width") * res, F.col("used_height") * res
    return grid.select(
        "box_id",
        F.concat_ws("-", "col", "row").alias("tile_name"),
        "col",
        "row",
        (F.col("x0") + F.col("col") * dx).alias("min_x"),
        (F.col("y0") + F.col("row") * dy).alias("min_y"),
        (F.col("x0") + (F.col("col") + 1) * dx).alias("max_x"),
        (F.col("y0") + (F.col("row") + 1) * dy).alias("max_y"),
        "used_width",
        "used_height",
    )


def _plain_number(value: Column) -> Column:
    """Shortest fixed-point text with at least one and at most six decimals."""
    return F.regexp_replace(value.cast("decimal(24,6)").cast("string"), r"(\.\d+?)0+$", "$1")


def tile_manifest(tiles: DataFrame, service: str = SERVICE) -> DataFrame:
    """``box_id, tile_name, url``: one request per tile, pixel sizes rounded up to whole numbers."""
    size = [F.ceil(c).cast("string") for c in ("used_width", "used_height")]
    corners = F.concat_ws(",", *[_plain_number(F.col(c)) for c in ("min_x", "min_y", "max_x", "max_y")])
    url = F.concat(F.lit(service + "&WIDTH="), size[0], F.lit("&HEIGHT="), size[1], F.lit("&BBOX="), corners)
    return tiles.select("box_id", "tile_name", url.alias("url"))


def pending_tiles(tiles: DataFrame, fetched: DataFrame, attempt: int = 0, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Tiles still to be asked for in this attempt (0-based); none after the last one."""
    missing = tiles.join(fetched.select(*KEY), KEY, "left_anti")
    return missing if attempt < max_attempts else missing.limit(0)


def fetch_tiles(
    tiles: DataFrame, fetch: Callable[[DataFrame, int], DataFrame], path: str, max_attempts: int = MAX_ATTEMPTS
) -> tuple[DataFrame | None, DataFrame]:
    """Ask for the missing tiles again and again until all have come or ``max_attempts`` are over.

    ``fetch(pending, attempt)`` returns the rows of ``pending`` that came, with their image columns; how it gets them is its own matter (a
    ``mapInArrow`` over HTTP, a table).  What came is written below ``path`` attempt by attempt, and an attempt counts only once its ledger row is
    there: a run that broke off, or another call with the same path, goes on with the first attempt not in the ledger.  Returns the tiles
    that came with the number of their ``attempt`` (None if there are none) and ``box_id, tile_name`` of those that failed.
    """
    spark = tiles.sparkSession
    ledger = read_or_none(spark, f"{path}/{LEDGER}")
    done = set() if ledger is None else {r["attempt"] for r in ledger.select("attempt").collect()}
    arrived = _arrived(spark, path, done)
    for attempt in range(max_attempts):
        if attempt in done:
            continue
        pending = cut(tiles if arrived is None else pending_tiles(tiles, arrived, attempt, max_attempts))
        if pending.isEmpty():
            break
        came = fetch(pending, attempt).join(pending.select(*KEY), KEY, "left_semi").dropDuplicates(KEY)
        came.write.mode("overwrite").parquet(f"{path}/{TILES}/attempt={attempt}")
        spark.createDataFrame([(attempt,)], "attempt int").write.mode("append").parquet(f"{path}/{LEDGER}")
        done.add(attempt)
        arrived = _arrived(spark, path, done)
    return arrived, tiles.select(*KEY) if arrived is None else failed_tiles(tiles, arrived)


def _arrived(spark: SparkSession, path: str, done: set[int]) -> DataFrame | None:
    if not done:
        return None
    return spark.read.option("basePath", f"{path}/{TILES}").parquet(*[f"{path}/{TILES}/attempt={k}" for k in sorted(done)])


def failed_tiles(tiles: DataFrame, fetched: DataFrame) -> DataFrame:
    """What is still missing after the last attempt, to be kept as an error table."""
    return pending_tiles(tiles, fetched).select("box_id", "tile_name")
