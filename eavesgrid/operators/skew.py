"""Splitting hot keys before a join, and dealing the join to tasks by its candidate pairs.

A key with many rows becomes a grid of blocks of at most about ``limit * limit`` candidate pairs and ``200 * limit`` rows
of one side.  Every pair still meets exactly once, in the block given by the two salts.

The sides of such a join are small beside what it compares, so neither file sizes nor shuffled bytes tell how many tasks it
needs: the counts of the keys do.  A side is never broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

BROADCAST_ROWS = 100_000
LONG_SIDE = 200
PAIRS_PER_TASK = 20_000_000  # candidate pairs of two bboxes, answered in the JVM
ROWS_PER_TASK = 250_000


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only for a table whose row count was measured and is small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input and must not be broadcast.

    What a file or a checkpoint is reckoned to hold comes from compressed bytes, which says little about rows that are worked out.
    """
    return df.hint("merge")


def key_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, nl, nr``: rows of each side."""
    both = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r"))
    both = both.unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    return both.groupBy(*keys).agg(F.sum("l").alias("nl"), F.sum("r").alias("nr"))


def hot_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """``keys, sl, sr``: number of salts per side, for the keys that need more than one block."""
    return _hot(key_counts(left, right, keys), keys, limit)


def _salts(own: str, other: str, limit: int) -> Column:
    # Against few partners a block may hold more rows of its own, up to LONG_SIDE times the limit.
    partners = F.greatest(F.least(F.col(other), F.lit(limit)), F.lit(limit / LONG_SIDE))
    return F.greatest(F.ceil(F.col(own) * partners / F.lit(float(limit) ** 2)), F.lit(1)).cast("int")


def _is_hot(limit: int) -> Column:
    """A key missing on one side joins nothing, however many rows it has."""
    met = (F.col("nl") > 0) & (F.col("nr") > 0)
    return met & ((_salts("nl", "nr", limit) > 1) | (_salts("nr", "nl", limit) > 1))


def _hot(counts: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    return counts.where(_is_hot(limit)).select(*keys, _salts("nl", "nr", limit).alias("sl"), _salts("nr", "nl", limit).alias("sr"))


def salted_pair(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    limit: int,
    weight: int = 1,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides ready for an equi-join on the returned keys, hot keys spread over salt blocks, dealt to tasks of bounded work.

    One pass over the key columns counts the candidate pairs and finds the hot keys.  Rows whose pairs cost ``weight`` times what a bbox test
    does are dealt to so many more tasks.
    """
    counts = cut(key_counts(left, right, keys))
    pairs, rows, n_hot = counts.agg(
        F.sum(F.col("nl").cast("double") * F.col("nr")), F.sum(F.col("nl") + F.col("nr")), F.count_if(_is_hot(limit))
    ).first()
    on = list(keys)
    if n_hot:
        left, right, on = salted_by(left, right, keys, left_id, right_id, broadcast_if_small(cut(_hot(counts, keys, limit)), n_hot))
    n = int(2 + (pairs or 0) * weight // PAIRS_PER_TASK + (rows or 0) * weight // ROWS_PER_TASK)
    # A number of its own keeps the adaptive execution from laying the tasks together by their few bytes.
    return shuffled(left.repartition(n, *on)), right.repartition(n, *on), on


def salted_by(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str, hot: DataFrame
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Salt both sides by a known table ``keys, sl, sr``."""

    def salted(df: DataFrame, own: str, other: str, id_col: str, own_salt: str, other_salt: str) -> DataFrame:
        joined = df.join(hot, list(keys), "left")
        own_n, other_n = F.coalesce(F.col(own), F.lit(1)), F.coalesce(F.col(other), F.lit(1))
        return (
            joined.withColumn(own_salt, F.pmod(F.xxhash64(id_col), own_n).cast("int"))
            .withColumn(other_salt, F.explode(F.sequence(F.lit(0), other_n - 1)))
            .drop("sl", "sr")
        )

    return (
        salted(left, "sl", "sr", left_id, "salt_l", "salt_r"),
        salted(right, "sr", "sl", right_id, "salt_r", "salt_l"),
        [*keys, "salt_l", "salt_r"],
    )
