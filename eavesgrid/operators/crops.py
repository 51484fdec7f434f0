"""One image crop per footprint and raster, cut from a table of raster tiles.

Rasters are rows of tiles: ``raster_id, tile_row, tile_col, row0, col0, rows, cols, data`` with pixels stored row by
row and bands interleaved, of the sample type the catalog names (``pixels``).  A crop needs, for every pixel row, the run of pixels whose centres lie in the oriented
box; a box is convex, so that is one run.  Runs are cut out of the tiles with ``substring`` right after the tile
join, so only the pixels of the crops are shuffled, never whole tiles per footprint.  Tiles no crop needs are dropped at
the scan by a bitmap per raster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import BBOX, first
from ..functions.kernels import min_rotated_rect
from ..session import cut
from .pixels import assembled_crops, fragment_sums, sample_bytes, with_sample_type
from .preprocessing import require_columns
from .skew import shuffled
from .spatial_join import bbox_area_is_finite, bbox_join

RASTER_EXTENSIONS = ("jp2", "tiff")  # Fixed values: file extensions of raster files.
SPAN_TYPE = "array<struct<r:int,c0:int,c1:int>>"
FRAG_TYPE = "array<struct<off:int,data:binary>>"

# ---------------------------------------------------------------- catalog


def raster_catalog(files: DataFrame, path_col: str = "path", any_case: bool = False) -> DataFrame:
    """Rows whose path ends in ``.jp2`` or ``.tiff``; ``.tif`` is not a raster.

    ``raster_id`` is the whole path, since file names repeat; ``raster_name`` is the file name without extension.
    """
    ext = F.regexp_extract(path_col, r"\.([^./]+)$", 1)
    ext = F.lower(ext) if any_case else ext
    name = F.regexp_extract(path_col, r"([^/]+)\.[^./]+$", 1)
    return files.where(ext.isin(*RASTER_EXTENSIONS)).withColumns({"raster_id": F.col(path_col), "raster_name": name})


def require_rasters(catalog: DataFrame) -> DataFrame:
    """The catalog itself, or ``FileNotFoundError`` when it is empty."""
    if catalog.isEmpty():
        raise FileNotFoundError("no raster in the catalog")
    return catalog


def pending_rasters(catalog: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rasters the ledger does not list; ledger rows of other rasters do not matter."""
    return catalog.join(ledger.select("raster_id"), "raster_id", "left_anti")


# ---------------------------------------------------------------- boxes and pixel runs

_GRID = ("raster_xmin", "raster_ymax", "res", "width", "height", "n_bands", "dtype", "nodata")


def crop_boxes(footprints: DataFrame, catalog: DataFrame, id_col: str = "id") -> DataFrame:
    """``id, raster_id, box`` and the raster's grid: the oriented box of every footprint that meets a raster.

    Which rasters a footprint meets is decided on its upright bbox.  The oriented box is computed once per footprint and
    goes through the join in place of the geometry.
    """
    require_columns(footprints, id_col, "geom", "is_box", *BBOX)
    left = footprints.where(F.col(id_col).isNotNull() & bbox_area_is_finite()).select(
        F.col(id_col).alias("id"), *BBOX, first(first(min_rotated_rect("geom"))).alias("box")
    )
    right = with_sample_type(catalog).select("raster_id", *BBOX, "res", "width", "height", "n_bands", "dtype", "nodata")
    pairs = bbox_join(left, right, "id", "raster_id", closed=False)
    return pairs.select(
        "l.id", "l.box", "r.raster_id", F.col("r.xmin").alias("raster_xmin"), F.col("r.ymax").alias("raster_ymax"),
        "r.res", "r.width", "r.height", "r.n_bands", "r.dtype", "r.nodata",
    )


# A pixel belongs to a box when its centre does; centres on the left or lower side count, those on the right or
# upper side do not, so boxes side by side never share a pixel.


def _from(value: Column) -> Column:
    """First index whose centre is at or after the position."""
    return F.ceil(value - 0.5).cast("int")


def _after(value: Column) -> Column:
    """First index whose centre is after the position."""
    return F.floor(value - 0.5).cast("int") + 1


def with_window(boxes: DataFrame) -> DataFrame:
    """Rows and columns ``r0..r1, c0..c1`` of the raster whose pixel centres lie in the box's extent."""
    xs, ys = F.transform("box", lambda p: p["x"]), F.transform("box", lambda p: p["y"])
    x = lambda v: (v - F.col("raster_xmin")) / F.col("res")
    y = lambda v: (F.col("raster_ymax") - v) / F.col("res")
    return boxes.withColumns(
        {
            "r0": F.greatest(_after(y(F.array_max(ys))), F.lit(0)),
            "r1": F.least(_after(y(F.array_min(ys))), F.col("height")) - 1,
            "c0": F.greatest(_from(x(F.array_min(xs))), F.lit(0)),
            "c1": F.least(_from(x(F.array_max(xs))), F.col("width")) - 1,
        }
    )


def with_sides(windows: DataFrame) -> DataFrame:
    """The box's four sides as ``side0`` .. ``side3``: start point, slope dx/dy, and whether the side runs up or down."""
    corner = [F.get("box", F.lit(k)) for k in range(5)]

    def side(p: Column, q: Column) -> Column:
        dx, dy = q["x"] - p["x"], q["y"] - p["y"]
        slope = F.when(dy != 0, dx / F.nullif(dy, F.lit(0.0)))
        return F.struct(p["x"].alias("x"), p["y"].alias("y"), slope.alias("slope"), F.signum(dy).alias("way"))

    return windows.withColumns({f"side{k}": side(corner[k], corner[k + 1]) for k in range(4)})


def pixel_runs() -> Column:
    """``array<struct<r, c0, c1>>``: per pixel row the columns with their centre in the convex box.

    Going round counter-clockwise, sides that run up bound a row on the right, those that run down on the left.
    """
    sides = [F.col(f"side{k}") for k in range(4)]

    def run(r: Column) -> Column:
        y = F.col("raster_ymax") - (r + 0.5) * F.col("res")
        at = [s["x"] + s["slope"] * (y - s["y"]) for s in sides]
        hi = F.least(*[F.when(s["way"] > 0, x) for s, x in zip(sides, at)])
        lo = F.greatest(*[F.when(s["way"] < 0, x) for s, x in zip(sides, at)])
        x = lambda v: (v - F.col("raster_xmin")) / F.col("res")
        c0 = F.greatest(_from(x(lo)), F.col("c0"))
        c1 = F.least(_from(x(hi)) - 1, F.col("c1"))
        return F.struct(r.alias("r"), c0.alias("c0"), c1.alias("c1"))

    rows = F.sequence(F.col("r0"), F.col("r1"))
    empty = (F.col("r1") < F.col("r0")) | (F.col("c1") < F.col("c0"))
    return F.when(empty, F.array().cast(SPAN_TYPE)).otherwise(
        F.filter(F.transform(rows, run), lambda s: s["c0"] <= s["c1"])
    )


def _merged_runs(runs: Column) -> Column:
    """Sorted, disjoint column runs of one pixel row."""
    kind = "array<struct<c0:int,c1:int>>"

    def fold(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        widened = F.concat(
            F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
            F.array(F.struct(last["c0"].alias("c0"), F.greatest(last["c1"], s["c1"]).alias("c1"))),
        )
        return F.when((F.size(acc) > 0) & (s["c0"] <= last["c1"] + 1), widened).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.array_sort(runs), F.array().cast(kind), fold)


def ids_are_unique(footprints: DataFrame, id_col: str = "id") -> bool:
    """Whether no id repeats, from the id column alone."""
    return footprints.groupBy(id_col).count().where(F.col("count") > 1).isEmpty()


def crop_plan(boxes: DataFrame, unique_ids: bool = False) -> DataFrame:
    """One row per (id, raster): the pixel window and the runs inside it.

    Footprints sharing an id are cut together.  Their runs are joined pixel row by pixel row after removing
    repeated ones, so no group grows with the number of footprints.  ``unique_ids`` skips this.
    """
    planned = with_sides(with_window(boxes)).withColumn("runs", pixel_runs())
    keep = ["id", "raster_id", *_GRID, "r0", "r1", "c0", "c1", "runs"]
    if unique_ids:
        return planned.select(*keep)
    planned = cut(planned.select(*keep))
    key = ["id", "raster_id"]
    same = [F.first(c).alias(c) for c in _GRID]
    windows = planned.groupBy(*key).agg(*same, F.min("r0").alias("r0"), F.max("r1").alias("r1"), F.min("c0").alias("c0"), F.max("c1").alias("c1"))
    runs = planned.select(*key, F.explode("runs").alias("s")).select(*key, "s.r", F.struct("s.c0", "s.c1").alias("run"))
    rows = runs.groupBy(*key, "r").agg(F.collect_set("run").alias("found"))
    with_row = F.transform(
        _merged_runs(F.col("found")), lambda m: F.struct(F.col("r").alias("r"), m["c0"].alias("c0"), m["c1"].alias("c1"))
    )
    per_crop = rows.select(*key, with_row.alias("p")).groupBy(*key).agg(
        F.array_sort(F.flatten(F.collect_list("p"))).alias("runs")
    )
    joined = windows.join(per_crop, key, "left")
    return joined.withColumn("runs", F.coalesce("runs", F.array().cast(SPAN_TYPE))).select(*keep)


# ---------------------------------------------------------------- cutting

_SIZE = ("r0", "c0", "r1", "c1", "n_bands", "dtype", "nodata")
MOST_BITMAP_BYTES = 128 << 20
_WORD = 64


def tile_bitmaps(wanted: DataFrame) -> DataFrame:
    """``raster_id, n_cols, bits``: one row per raster, bit ``tile_row * n_cols + tile_col`` set for the tiles that crops need."""
    number = F.col("tile_row") * F.col("n_cols") + F.col("tile_col")
    words = (
        wanted.select("raster_id", "n_cols", F.floor(number / _WORD).cast("int").alias("word"), (number % _WORD).cast("int").alias("bit"))
        .groupBy("raster_id", "n_cols", "word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
    )
    found = words.groupBy("raster_id", "n_cols").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    steps = F.sequence(F.lit(0), F.array_max(F.map_keys("m")))
    return found.select("raster_id", "n_cols", F.transform(steps, lambda w: F.coalesce(F.col("m")[w], F.lit(0).cast("long"))).alias("bits"))


def wanted_only(tiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """The tiles some crop needs, picked at the scan by a broadcast bitmap per raster, so that no other pixel is shuffled.

    Bitmaps are measured first; beyond ``MOST_BITMAP_BYTES`` the tiles are joined as they are.
    """
    bitmaps = cut(tile_bitmaps(wanted))
    n_bytes = bitmaps.agg(F.sum(F.size("bits") * 8 + F.length("raster_id") + 64)).first()[0] or 0
    if n_bytes > MOST_BITMAP_BYTES:
        return tiles
    number = F.col("tile_row") * F.col("n_cols") + F.col("tile_col")
    word = F.get("bits", F.floor(number / _WORD).cast("int"))
    hit = F.getbit(F.coalesce(word, F.lit(0).cast("long")), (number % _WORD).cast("int")) == 1
    return tiles.join(F.broadcast(bitmaps), "raster_id").where(hit & (F.col("tile_col") < F.col("n_cols"))).select(*tiles.columns)


def crop_fragments(plan: DataFrame, tiles: DataFrame, tile_size: int, extra: Sequence[str] = (), places: bool = False) -> DataFrame:
    """One row per (crop, tile) with the bytes of its runs: ``frags array<struct<off, data>>``, and the window.

    ``off`` is the byte position in the finished crop.  Crops without pixels, or whose tile is missing, keep a row with
    NULL ``frags``; ``missing`` is 1 for a tile that isn't there.  The tile side has one row per key, and a tile many footprints share is a skewed key the adaptive
    join splits on the crop side.
    """
    plan = cut(plan)  # asked twice: for the bitmaps, and for the cutting
    size, pixel = F.lit(tile_size), F.col("n_bands") * sample_bytes(F.col("dtype"))

    def cover(lo: Column, hi: Column) -> Column:
        return F.when(F.size("runs") > 0, F.sequence(F.floor(lo / size).cast("int"), F.floor(hi / size).cast("int")))

    wanted = (
        plan.withColumn("tile_row", F.explode_outer(cover(F.col("r0"), F.col("r1"))))
        .withColumn("tile_col", F.explode_outer(cover(F.col("c0"), F.col("c1"))))
        .withColumn("top", F.col("tile_row") * size)
        .withColumn("left", F.col("tile_col") * size)
        .withColumn("n_cols", F.ceil(F.col("width") / size).cast("int"))
    )
    inside = F.filter(
        "runs",
        lambda s: (s["r"] >= F.col("top")) & (s["r"] < F.col("top") + size)
        & (s["c1"] >= F.col("left")) & (s["c0"] < F.col("left") + size),
    )
    wanted = (
        wanted.withColumn("runs", inside)
        .withColumn("first_r", F.get("runs", F.lit(0))["r"])
        .withColumn("last_r", F.get("runs", F.size("runs") - 1)["r"])
    )
    cells = wanted_only(tiles.select("raster_id", "tile_row", "tile_col", "cols", "data"), wanted.where(F.size("runs") > 0))
    stride = F.col("cols") * pixel
    # First the pixel rows of the crop as one slice, in the generated code of the join: the tile itself is never copied
    # into a joined row.  Then the runs out of that slice.
    band = F.substring("data", (F.col("first_r") - F.col("top")) * stride + 1, (F.col("last_r") - F.col("first_r") + 1) * stride)
    place = ("tile_row", "tile_col") if places else ()
    joined = wanted.join(cells, ["raster_id", "tile_row", "tile_col"], "left").select(
        "id", "raster_id", *place, *_SIZE, *extra, "runs", "left", "first_r", "cols", band.alias("band")
    )

    def piece(s: Column) -> Column:
        a = F.greatest(s["c0"], F.col("left"))
        b = F.least(s["c1"], F.col("left") + F.col("cols") - 1)
        start = (s["r"] - F.col("first_r")) * stride + (a - F.col("left")) * pixel
        off = ((s["r"] - F.col("r0")) * (F.col("c1") - F.col("c0") + 1) + (a - F.col("c0"))) * pixel
        return F.struct(off.cast("int").alias("off"), F.substring("band", start + 1, (b - a + 1) * pixel).alias("data"))

    frags = F.when(F.col("band").isNotNull(), F.transform("runs", piece))
    missing = (F.col("band").isNull() & (F.size("runs") > 0)).cast("int")
    return joined.select("id", "raster_id", *place, *_SIZE, *extra, frags.alias("frags"), missing.alias("missing"))


def crop_rasters(
    footprints: DataFrame,
    catalog: DataFrame,
    tiles: DataFrame,
    tile_size: int,
    id_col: str = "id",
    unique_ids: bool | None = None,
) -> DataFrame:
    """``id, raster_id, r0, c0, height, width, n_channels, dtype, missing_tiles, data``: the crops, without data outside the oriented box.

    No data is the catalog's ``nodata`` value, or black.  Pixels of a tile that isn't there are the same; ``missing_tiles`` tells such crops apart.

    A footprint too small to hold a pixel centre still has its row, with no pixels.  ``unique_ids`` says whether ids may
    repeat; by default one pass over the ids finds out.
    """
    return _assembled(crop_fragments(_plan_of(footprints, catalog, id_col, unique_ids), tiles, tile_size))


def named_crops(
    footprints: DataFrame,
    catalog: DataFrame,
    tiles: DataFrame,
    tile_size: int,
    id_col: str = "id",
    unique_ids: bool | None = None,
    earlier: DataFrame | None = None,
    with_suffix: bool = True,
) -> DataFrame:
    """``crop_rasters`` with the names of ``crop_suffix``.

    Names are given to the plan, before any pixel is cut: pixels are not shuffled by id, and images that are not kept
    are never cut.
    """
    return cut_planned(crop_suffix(_plan_of(footprints, catalog, id_col, unique_ids), earlier, with_suffix), tiles, tile_size)


def cut_planned(named_plan: DataFrame, tiles: DataFrame, tile_size: int) -> DataFrame:
    """The crops of a plan that has names already."""
    names = ("suffix", "file_name", "suffixed_name")
    return _assembled(crop_fragments(named_plan, tiles, tile_size, names), names)


def _plan_of(footprints: DataFrame, catalog: DataFrame, id_col: str, unique_ids: bool | None) -> DataFrame:
    if unique_ids is None:
        unique_ids = ids_are_unique(footprints, id_col)
    return crop_plan(crop_boxes(footprints, catalog, id_col), unique_ids)


def _assembled(frags: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """All pieces of a crop in one row; their total size is that of the crop."""
    whole = frags.groupBy("id", "raster_id").agg(
        *[F.first(c).alias(c) for c in (*_SIZE, *extra)],
        F.array_sort(F.flatten(F.collect_list(F.coalesce("frags", F.array().cast(FRAG_TYPE))))).alias("frags"),
        F.sum("missing").cast("int").alias("missing_tiles"),
    )
    blank = (F.col("r1") < F.col("r0")) | (F.col("c1") < F.col("c0"))
    sized = whole.select(
        "id", "raster_id", "r0", "c0", *extra, "frags", "dtype", "nodata",
        F.when(blank, 0).otherwise(F.col("r1") - F.col("r0") + 1).alias("height"),
        F.when(blank, 0).otherwise(F.col("c1") - F.col("c0") + 1).alias("width"),
        F.col("n_bands").alias("n_channels"),
        "missing_tiles",
    )
    kept = ["id", "raster_id", *extra, "r0", "c0", "height", "width", "n_channels", "dtype", "missing_tiles"]
    return assembled_crops(sized, kept)


def zonal_pixels(
    footprints: DataFrame,
    catalog: DataFrame,
    tiles: DataFrame,
    tile_size: int,
    id_col: str = "id",
    unique_ids: bool | None = None,
) -> DataFrame:
    """``id, raster_id, n_pixels, pixel_sum, missing_tiles`` over the samples in the oriented box, for rasters of whole numbers.

    Pairs without pixels are left out; pairs with a tile that isn't there stay, their counts lacking its pixels.
    """
    found = zonal_statistics(footprints, catalog, tiles, tile_size, id_col, unique_ids)
    return found.select("id", "raster_id", "n_pixels", F.col("pixel_sum").cast("long").alias("pixel_sum"), "missing_tiles")


def zonal_statistics(
    footprints: DataFrame,
    catalog: DataFrame,
    tiles: DataFrame,
    tile_size: int,
    id_col: str = "id",
    unique_ids: bool | None = None,
) -> DataFrame:
    """``id, raster_id, n_pixels, n_nodata, pixel_sum, pixel_min, pixel_max, missing_tiles`` over the samples in the oriented box.

    Samples equal to the raster's ``nodata`` (and NaN) are only counted.  Sums of a crop's tiles are added in the order of the tiles, so results
    of floating samples don't hang on partitioning; the tiles of one crop are as many as it covers.
    """
    frags = crop_fragments(_plan_of(footprints, catalog, id_col, unique_ids), tiles, tile_size, places=True)
    frags = frags.where((F.size("frags") > 0) | (F.col("missing") > 0))
    frags = frags.withColumn("frags", F.coalesce("frags", F.array().cast(FRAG_TYPE)))
    per_tile = fragment_sums(frags, ["id", "raster_id", "tile_row", "tile_col", "missing"])
    in_order = F.array_sort(F.collect_list(F.struct("tile_row", "tile_col", "total")))
    return per_tile.groupBy("id", "raster_id").agg(
        F.sum("n").alias("n_pixels"), F.sum("n_nodata").alias("n_nodata"),
        F.aggregate(in_order, F.lit(0.0), lambda a, t: a + t["total"]).alias("pixel_sum"),
        F.min("least").alias("pixel_min"), F.max("most").alias("pixel_max"), F.sum("missing").cast("int").alias("missing_tiles"),
    )


# ---------------------------------------------------------------- names and manifests


def distinct_ids(pairs: DataFrame) -> DataFrame:
    """``raster_id, id, n_features``: the ids to cut per raster; rows sharing an id are cut together."""
    return pairs.groupBy("raster_id", "id").agg(F.count(F.lit(1)).alias("n_features"))


def crop_suffix(crops: DataFrame, earlier: DataFrame | None = None, with_suffix: bool = True) -> DataFrame:
    """Adds ``suffix``, ``file_name`` and ``suffixed_name``.

    The first raster of a footprint (by raster id) gives ``<id>.jpg``, the next ``<id>_1.jpg`` and so on; rasters of
    earlier runs come first.  ``with_suffix=False`` keeps the first image only.  Groups are as long as the number
    of rasters a footprint touches.
    """
    rank = F.row_number().over(Window.partitionBy("id").orderBy("raster_id")) - 1
    ranked = crops.withColumn("suffix", rank)
    if earlier is not None:
        used = earlier.groupBy("id").agg((F.max("suffix") + 1).alias("_used"))
        ranked = ranked.join(shuffled(used), "id", "left").withColumn("suffix", F.col("suffix") + F.coalesce("_used", F.lit(0))).drop("_used")
    named = with_names(ranked)
    return named if with_suffix else named.where(F.col("suffix") == 0)


def with_names(ranked: DataFrame) -> DataFrame:
    """File names from ``id`` and ``suffix``."""
    numbered = F.concat("id", F.lit("_"), F.col("suffix").cast("string"), F.lit(".jpg"))
    return ranked.withColumn("file_name", F.concat("id", F.lit(".jpg"))).withColumn(
        "suffixed_name", F.when(F.col("suffix") == 0, F.col("file_name")).otherwise(numbered)
    )


def crop_manifest(named: DataFrame) -> DataFrame:
    """``raster_id, suffixed_name, file_name``, to be written partitioned by raster."""
    return named.select("raster_id", "suffixed_name", "file_name")
