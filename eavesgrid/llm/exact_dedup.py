"""Exact duplicates by a heavy-hitter split.

Misra-Gries counters (``DataFrame.freqItems``) name at most ``1 / support`` digests that can own more than that share of all
rows.  Their true sizes and winners are then counted exactly and broadcast: a table of at most ``1 / support`` rows, however
large the corpus is.  Rows of these digests are decided map-side.  All other digests own less than that share each and take the
ordinary shuffle, aggregated before they move.  Only ids and digests move, never texts.

Defined results: a null text equals the empty one; a null id is smaller than any other; of rows equal in id and text, one
stays; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import ascii_lower, join_keyed, one_column, whole

SUPPORT = 0.001


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: ``id_col, keep_id, group_size, kept, text_sha256``."""
    slim = docs.select(
        F.col(id_col).alias("__id"), F.sha2(ascii_lower(whole(F.col(text_col))), 256).alias("__digest")
    )
    # The row number settles ties between rows equal in id and text; the checkpoint fixes it.
    slim = cut(slim.withColumn("__row", F.monotonically_increasing_id()))
    frequent = slim.freqItems(["__digest"], support).select(F.explode("__digest_freqItems").alias("__digest"))
    best = F.max(F.struct(F.col("__id"), F.col("__row"))).alias("__best")
    size = F.count(F.lit(1)).alias("group_size")
    winners = cut(slim.join(F.broadcast(frequent), "__digest", "left_semi").groupBy("__digest").agg(best, size))
    hot = slim.join(F.broadcast(winners), "__digest")
    rest = slim.join(F.broadcast(winners.select("__digest")), "__digest", "left_anti")
    cold = rest.join(rest.groupBy("__digest").agg(best, size), "__digest")
    return hot.unionByName(cold).select(
        F.col("__id").alias(id_col),
        F.col("__best.__id").alias("keep_id"),
        "group_size",
        (F.col("__row") == F.col("__best.__row")).alias("kept"),
        F.col("__digest").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = SUPPORT
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: the largest id of each group of equal texts."""
    groups = exact_groups(docs, id_col, text_col, support)
    # Rows equal in id and text count as often as they occur; such an id is settled below.
    winners = groups.where(F.col(id_col).eqNullSafe(F.col("keep_id")))
    winners = winners.groupBy(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__digest")).agg(F.count(F.lit(1)).alias("__n"))
    digest = F.sha2(ascii_lower(whole(F.col(text_col))), 256)
    keyed = docs.select(one_column(docs), F.col(id_col).alias("__id"), digest.alias("__digest"))
    joined = join_keyed(keyed, winners, ["__id", "__digest"], "inner")
    single = joined.where(F.col("__n") == 1)
    repeated = joined.where(F.col("__n") > 1).dropDuplicates(["__id", "__digest"])
    return single.unionByName(repeated).select("row.*")
