"""Mixing sources to target weights by weighted fair queueing.

Each source is shuffled by a hash of the id and read up to twice.  A document finishes at the virtual time *tokens of its source
up to its end / target of the source*, so all sources run through their targets at the same pace.  The documents are
put in global order of that time and taken whole up to the total budget.

Both running sums (in a source, and over all) are taken in two steps, so that no source and no stretch of time has to fit a
task: sums per slot of the order, running sums over the slots (a fixed number of them), running sums within a slot.  Only ids,
sizes and sources move.  The sources themselves are ranked in one small window: one row per source.

Defined results: a null text has size 0; a null source ranks last; documents of size 0 are never taken; rows equal in id,
source and text count one by one; no words at all give targets of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import join_keyed, one_column, whole, words_of

WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
MOST_REPEATS = 2
SLOT_DIGITS = 3  # hexadecimal digits of the shuffle key that name a slot: 4096 slots in a source
TIME_SLOTS = 4096  # for each unit of virtual time
LATEST = 2  # later documents are never reached: at time 1 every source has had its target


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = BUDGET_PERCENT, repeats: int = MOST_REPEATS
) -> DataFrame:
    """``source, source_size, target`` from ``source, size``: shares by weight, none above ``repeats`` times its source.

    What a source can't take is shared again by weight.  In order of ``full / weight`` the sources fill up one after
    the other, so the first one that its share doesn't fill settles the level of all later ones.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    name = [F.col("source").isNull(), F.encode("source", "UTF-8")]
    kinds = F.array(*[F.lit(int(w)) for w in weights])
    rank = F.row_number().over(Window.orderBy(*name)) - 1
    per = per.withColumn("w", F.element_at(kinds, (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("full", F.col("source_size") * repeats)
    order = Window.orderBy(F.col("full") / F.col("w"), *name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) * percent / 100 - F.coalesce(F.sum("full").over(before), F.lit(0))
    w_left = F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0))
    per = per.withColumn("level", left / w_left)
    per = per.withColumn("open", F.when(F.col("full") / F.col("w") >= F.col("level"), F.col("level")))
    level = F.first("open", ignorenulls=True).over(all_rows)
    target = F.least(F.col("full").cast("double"), F.col("w") * F.coalesce(level, F.lit(float("inf"))))
    return per.select("source", "source_size", target.alias("target"))


def _queue(rows: DataFrame, targets: DataFrame, repeats: int) -> DataFrame:
    """``uid, key, size, finish``: a row for each document and reading of its source."""
    rows = join_keyed(rows.withColumn("slot", F.substring("key", 1, SLOT_DIGITS)), targets, ["source"])
    slots = rows.groupBy("source", "slot").agg(F.sum("size").alias("in_slot"))
    earlier = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("source", "slot", F.coalesce(F.sum("in_slot").over(earlier), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("source", "slot").orderBy("key", "id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    rows = join_keyed(rows, slots, ["source", "slot"]).withColumn("upto", F.col("ahead") + F.sum("size").over(within))
    turns = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn")
    rows = rows.where("size > 0").select("uid", "id", "key", "size", "source_size", "target", "upto", turns)
    finish = (F.col("turn") * F.col("source_size") + F.col("upto")) / F.col("target")
    return rows.select("uid", "id", "key", "size", finish.alias("finish")).where(F.col("finish") < LATEST)


def _truncated(queue: DataFrame, budget: DataFrame) -> DataFrame:
    """``uid, taken``: words taken in order of ``finish``, as long as the total stays within the budget."""
    queue = queue.withColumn("slot", F.floor(F.col("finish") * TIME_SLOTS).cast("int"))
    slots = queue.groupBy("slot").agg(F.sum("size").alias("in_slot"))
    # At most LATEST * TIME_SLOTS rows, whatever the input: one window, and safe to broadcast.
    earlier = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select("slot", F.coalesce(F.sum("in_slot").over(earlier), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("slot").orderBy("finish", "key", "id", "size", "uid").rowsBetween(Window.unboundedPreceding, 0)
    placed = queue.join(F.broadcast(slots), "slot").withColumn("upto", F.col("ahead") + F.sum("size").over(within))
    total = budget.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    return placed.where(F.col("upto") <= F.lit(float(total))).groupBy("uid").agg(F.sum("size").alias("taken"))


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, source_col, text_hash, size, source_size, target, taken``."""
    text = whole(F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.xxhash64(text).alias("text_hash"),
        F.size(words_of(text)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"),
    )
    rows = cut(rows.withColumn("uid", F.monotonically_increasing_id()))
    targets = cut(source_targets(rows, weights, percent, repeats))
    taken = _truncated(_queue(rows, targets, repeats), targets)
    out = join_keyed(rows, targets, ["source"]).join(taken, "uid", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "text_hash",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    percent: int = BUDGET_PERCENT,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """The rows of ``docs`` that the mixture takes, with all their columns, as often as it takes them."""
    plan = mixture(docs, id_col, text_col, source_col, weights, percent, repeats)
    keys = ["__id", "__source", "__hash"]
    plan = plan.groupBy(
        F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.col("text_hash").alias("__hash")
    ).agg(F.count(F.lit(1)).alias("__rows"), F.sum(F.try_divide("taken", "size")).cast("int").alias("__times"))
    plan = plan.where(F.col("__times") > 0)
    text_hash = F.xxhash64(whole(F.col(text_col)))
    keyed = docs.select(one_column(docs), F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), text_hash.alias("__hash"))
    joined = join_keyed(keyed, plan, keys, "inner")
    single = joined.where(F.col("__rows") == 1)
    repeated = joined.where(F.col("__rows") > 1).dropDuplicates(keys)  # the copies of a row are taken together
    out = single.unionByName(repeated)
    return out.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__times")))).select("row.*")
