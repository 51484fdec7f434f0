"""Cutting crops raster by raster, picking up where the last run stopped.

The ledger of finished rasters and the crops are written under the same batch id.  A batch that failed half-way is
written again over itself, so no raster is lost or cut twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.crops import crop_boxes, crop_plan, cut_planned, ids_are_unique, named_crops, pending_rasters, with_names
from ..operators.skew import broadcast_if_small, shuffled
from ..operators.spatial_join import bbox_overlap_filter, footprint_raster_join
from ..session import cut, read_or_none, ship_package

CROPS, LEDGER, PLANS = "crops", "ledger", "plans"


def incremental_names(pairs: DataFrame, ledger: DataFrame, with_suffix: bool = True) -> DataFrame:
    """Names of the crops of pending rasters, suffixes counted on from the rasters in the ledger.

    ``pairs`` holds ``id, raster_id`` of all rasters and is read once: finished rasters take the first ranks of a
    footprint, pending ones the next.  With ``with_suffix=False`` a footprint that has an image already gets no other.
    """
    marked = pairs.join(ledger.select("raster_id").distinct().withColumn("done", F.lit(True)), "raster_id", "left")
    order = Window.partitionBy("id").orderBy(F.col("done").isNull(), "raster_id")
    ranked = marked.withColumn("suffix", F.row_number().over(order) - 1).where(F.col("done").isNull()).drop("done")
    named = with_names(ranked)
    return named if with_suffix else named.where(F.col("suffix") == 0)


def _finished(spark: SparkSession, out: str, batch_id: int) -> DataFrame | None:
    """What earlier batches wrote; rows of this batch are a failed attempt and do not count."""
    crops = read_or_none(spark, f"{out}/{CROPS}")
    return None if crops is None else crops.where(F.col("batch") < batch_id)


def cut_batch(
    rasters: DataFrame, batch_id: int, footprints: DataFrame, tiles: DataFrame, tile_size: int, out: str, with_suffix: bool = True
) -> None:
    """Crops and ledger rows of one batch of rasters, each in its own ``batch=<id>`` folder, written idempotently."""
    spark = rasters.sparkSession
    footprints = _near(footprints, rasters)
    ledger = read_or_none(spark, f"{out}/{LEDGER}")
    todo = rasters if ledger is None else pending_rasters(rasters, ledger.where(F.col("batch") < batch_id))
    earlier = _finished(spark, out, batch_id)
    if earlier is not None:
        # Only footprints of this batch need their earlier names; these are as many as the batch has, whatever their files are reckoned to hold.
        touched = footprint_raster_join(footprints, todo).select("id").distinct()
        earlier = earlier.select("id", "suffix").join(shuffled(touched), "id", "left_semi")
    # Tiles of other rasters go before anything is shuffled, as long as the batch's list of rasters is small.
    wanted = cut(todo.select("raster_id").distinct())
    tiles = tiles.join(broadcast_if_small(wanted, wanted.count()), "raster_id", "left_semi")
    named = named_crops(footprints, todo, tiles, tile_size, earlier=earlier, with_suffix=with_suffix)
    named.write.mode("overwrite").parquet(f"{out}/{CROPS}/batch={batch_id}")
    # The ledger goes last: a raster counts as done only once its crops are there.
    todo.select("raster_id").write.mode("overwrite").parquet(f"{out}/{LEDGER}/batch={batch_id}")


def cut_pending(
    catalog: DataFrame, footprints: DataFrame, tiles: DataFrame, tile_size: int, out: str, with_suffix: bool = True
) -> int:
    """All rasters of the catalog that the written ledger doesn't list, cut and entered as the next batch, whose id is returned."""
    ledger = read_or_none(catalog.sparkSession, f"{out}/{LEDGER}")
    last = None if ledger is None else ledger.agg(F.max("batch")).first()[0]
    batch_id = 0 if last is None else int(last) + 1
    cut_batch(catalog.dropDuplicates(["raster_id"]), batch_id, footprints, tiles, tile_size, out, with_suffix)
    return batch_id


def _near(footprints: DataFrame, rasters: DataFrame) -> DataFrame:
    """The footprints in the common extent of some rasters, as a filter that reaches the scan."""
    box = rasters.agg(F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    return footprints.where(F.lit(False)) if box[0] is None else bbox_overlap_filter(footprints, *box)


def plan_batch(rasters: DataFrame, batch_id: int, footprints: DataFrame, out: str) -> None:
    """What to cut from one batch of rasters, written to its own folder; footprints elsewhere aren't looked at."""
    near = _near(footprints, rasters)
    plan = crop_plan(crop_boxes(near, rasters), ids_are_unique(near))
    plan.write.mode("overwrite").parquet(f"{out}/{PLANS}/batch={batch_id}")


def _numbered(batch: DataFrame) -> DataFrame:
    """Suffixes of the new crops of each footprint, counted on from those it has.

    ``batch`` holds the new rows, and for each footprint of theirs a row with its ``total`` of crops, new ones included, and no raster.
    """
    own = Window.partitionBy("id")
    used = F.max("total").over(own) - F.count("raster_id").over(own)
    rank = F.row_number().over(own.orderBy(F.col("raster_id").asc_nulls_last()))
    numbered = batch.withColumn("suffix", (used + rank - 1).cast("int"))
    return numbered.where(F.col("raster_id").isNotNull()).drop("total", "batch")


def run_stream(
    spark: SparkSession,
    catalog_folder: str,
    catalog_schema,
    footprints: DataFrame,
    tiles: DataFrame,
    tile_size: int,
    out: str,
    with_suffix: bool = True,
    files_per_batch: int = 100,
) -> None:
    """Process the catalog files that arrived since the last call, then stop.

    Two streams in a row.  The first plans the crops of the new rasters, which is one row per footprint and raster.  The second reads
    these rows; its state store counts the crops of each footprint, so a batch touches the footprints it has and nothing that
    was cut before; then it cuts and writes them.  Each stream's checkpoint remembers its files, and a repeated batch overwrites itself.
    """
    ship_package(spark)
    rasters = spark.readStream.schema(catalog_schema).option("maxFilesPerTrigger", files_per_batch).parquet(catalog_folder)

    def plan(batch: DataFrame, batch_id: int) -> None:
        batch = cut(batch.dropDuplicates(["raster_id"]))
        done = read_or_none(spark, f"{out}/{LEDGER}")
        todo = batch if done is None else pending_rasters(batch, done.where(F.col("batch") < batch_id))
        plan_batch(todo, batch_id, footprints, out)
        todo.select("raster_id").write.mode("overwrite").parquet(f"{out}/{LEDGER}/batch={batch_id}")

    _run(rasters.writeStream.foreachBatch(plan).option("checkpointLocation", f"{out}/_plan_stream"))
    plans = read_or_none(spark, f"{out}/{PLANS}")
    if plans is None:
        return
    new = spark.readStream.schema(plans.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{out}/{PLANS}")
    new = new.withColumn("total", F.lit(None).cast("long"))
    totals = new.groupBy("id").agg(F.count(F.lit(1)).alias("total"))

    def cut_named(batch: DataFrame, batch_id: int) -> None:
        rows = _numbered(batch)
        rows = rows if with_suffix else rows.where(F.col("suffix") == 0)
        crops = cut_planned(with_names(rows), tiles, tile_size)
        crops.write.mode("overwrite").parquet(f"{out}/{CROPS}/batch={batch_id}")

    # In update mode only the totals that a batch changes come out.
    numbered = new.unionByName(totals, allowMissingColumns=True)
    _run(numbered.writeStream.outputMode("update").foreachBatch(cut_named).option("checkpointLocation", f"{out}/_cut_stream"))


def _run(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()
