"""Expressions and helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WHITE = " \t\n\x0b\f\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def whole(text: Column) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else untouched.  ``lower`` does just that to pure ASCII, and is faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Array of the runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, WHITE_CLASS + "+"), "")


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Join condition in which nulls equal nulls."""
    out = F.lit(True)
    for key in keys:
        out = out & left[key].eqNullSafe(right[key])
    return out


def join_keyed(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equal keys, null equal to null, with the left side's key columns only."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"__r_{key}"))
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def one_column(docs: DataFrame) -> Column:
    """All columns of a table as one, ``row``: whatever their names are, they can't meet those made beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def fresh(name: str, docs: DataFrame) -> str:
    """``name``, made longer until no column has it."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def keep_rows(docs: DataFrame, winners: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` named by ``winners``, with all their columns.

    ``winners`` has ``id, text`` (hash of the text) and ``n``, the number of rows with that id and text.  Where there are
    several, one of them stays.
    """
    right = winners.select(F.col("id").alias("__id"), F.col("text").alias("__text"), F.col("n").alias("__n"))
    keyed = docs.select(one_column(docs), F.col(id_col).alias("__id"), F.xxhash64(whole(F.col(text_col))).alias("__text"))
    joined = join_keyed(keyed, right, ["__id", "__text"], "inner")
    single = joined.where(F.col("__n") == 1)
    repeated = joined.where(F.col("__n") > 1).dropDuplicates(["__id", "__text"])
    return single.unionByName(repeated).select("row.*")
