"""License notices found by an exact set-similarity join of text blocks with templates.

A block is a sentence: what stands between line feeds or after ``.``, ``!``, ``?`` with white space.  A block meets a template when it
contains at least ``percent`` of the template's distinct words.  The join finds every such pair by three exact filters:

* *Prefix.*  The templates' words are put in one order by the number of blocks that hold them, rarest first.  A block that holds
  ``c`` of a template's ``s`` words holds one of its first ``s - c + 1``; only these are indexed.
* *Length.*  A block with fewer template words than the smallest ``c`` is never kept; the pair needs ``c`` of its own.
* *Position.*  A shared word at position ``i`` of the template and ``j`` of the block leaves at most ``min(s - i, words - j)``
  shared words from there on.

A pair is taken at its first shared word only, so no ``distinct`` is needed, and then counted in full.

The texts are read once: what is written between the steps has one slim row per document, with its template words per block.
Frequencies are sums over all of it.  Words of no template cannot change an overlap and are left out at the scan.  The templates' words are
in the plan, and the index is broadcast; both are bounded by the templates, at most ``MOST_TEMPLATE_WORDS`` words (else an error).  Labels
come back by one shuffle on the row number, aggregated before, so a word or notice in a third of all texts is no hot key.

Exact phrases are looked for beside it, word by word over the whole text (they may cross sentences).

Defined results: a null or empty text has no words, no label and score 0; rows are judged one by one, also equal ones or such with equal or
null ids; an empty table gives an empty result.  Texts of any length are taken whole; one text has to fit in a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import ascii_lower, whole

#: What separates words, what separates blocks
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_END = r"\n|[.!?][\x20\x09-\x0D]"

#: Phrases and their labels
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Usual wordings of license notices
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
]

PERCENT = 90
MOST_TEMPLATE_WORDS = 100_000


def _split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATOR), "")


def _needed(size: int, percent: int) -> int:
    return max(1, -(-size * percent // 100))


def _phrase_starts(words: Column, phrases: Sequence[tuple[str, str]]) -> Column:
    """``(place, label)`` of each phrase in an array of words, in the order of the places of each phrase."""

    def of(phrase: str, label: str) -> Column:
        parts = phrase.split()

        def stands(i: Column) -> Column:
            return reduce(lambda a, b: a & b, [F.get(words, i + k) == part for k, part in enumerate(parts)])

        places = F.filter(F.transform(words, lambda w, i: F.when((w == parts[0]) & stands(i), i)), lambda i: i.isNotNull())
        return F.transform(places, lambda i: F.struct(i.cast("long").alias("place"), F.lit(label).alias("label")))

    return F.concat(*[of(*p) for p in phrases])


def _rough_pattern(phrases: Sequence[tuple[str, str]]) -> str:
    """A text without a match of this has none of the phrases."""
    return "|".join(SEPARATOR.join(phrase.split()) for phrase, _ in phrases)


def profiles(
    docs: DataFrame, phrases: Sequence[tuple[str, str]], vocabulary: Sequence[str], least: int, id_col: str, text_col: str
) -> DataFrame:
    """``id, n_words, found, blocks`` per row: places of phrases, and per block its distinct words of the vocabulary if these are ``least`` or more."""
    text = docs.select(F.col(id_col).alias("id"), ascii_lower(whole(F.col(text_col))).alias("t"))
    none = F.array().cast("array<struct<place:bigint,label:string>>")
    found = F.when(F.col("t").rlike(_rough_pattern(phrases)), _phrase_starts(_split_words(F.col("t")), phrases)).otherwise(none) if phrases else none
    of_block = F.transform(F.split("t", BLOCK_END), lambda b: F.array_distinct(F.filter(F.split(b, SEPARATOR), lambda w: w.isin(*vocabulary))))
    blocks = F.filter(of_block, lambda b: F.size(b) >= least) if vocabulary else F.array().cast("array<array<string>>")
    return text.select("id", F.size(_split_words(F.col("t"))).cast("long").alias("n_words"), found.alias("found"), blocks.alias("blocks"))


def matches(blocks: DataFrame, sets: Sequence[tuple[str, Sequence[str]]], percent: int = PERCENT) -> DataFrame:
    """``uid, label, overlap, size`` for each pair of a block (``uid, block, words``) and a template (label, words) that meets the threshold."""
    spark = blocks.sparkSession
    counts = dict(blocks.select(F.explode("words").alias("w")).groupBy("w").count().collect())  # a row for each word of the templates at most
    order = sorted({w for _, s in sets for w in s}, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for label, words in sets:
        ranks = sorted(rank[w] for w in words)
        c = _needed(len(ranks), percent)
        index += [(r, i, len(ranks), c, ranks, label) for i, r in enumerate(ranks[: len(ranks) - c + 1])]
    index = spark.createDataFrame(index, "word int, i int, size int, needed int, ranks array<int>, label string")
    ranks = spark.createDataFrame([(w, i) for w, i in rank.items()], "w string, r int")
    ranked = (
        blocks.select("uid", "block", F.explode("words").alias("w"))
        .join(F.broadcast(ranks), "w").groupBy("uid", "block").agg(F.sort_array(F.collect_list("r")).alias("own"))
    )  # as many rows of a block as templates have words, at most
    probes = ranked.select("uid", "own", F.posexplode("own").alias("j", "word"))
    pairs = probes.join(F.broadcast(index), "word").where(
        (F.size("own") >= F.col("needed")) & (F.least(F.col("size") - F.col("i"), F.size("own") - F.col("j")) >= F.col("needed"))
    )
    shared = pairs.select("uid", "label", "size", "needed", "word", F.array_intersect("own", "ranks").alias("both"))
    return shared.where((F.col("both")[0] == F.col("word")) & (F.size("both") >= F.col("needed"))).select(
        "uid", "label", F.size("both").alias("overlap"), "size"
    )


def scan_licenses(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = tuple(PHRASES),
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``score`` is the largest share of a template's words found in one block among the templates met, 1 with a phrase, else 0.
    """
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    sets = [(label, words) for label, words in sets if words]
    vocabulary = sorted({w for _, words in sets for w in words})
    if sum(len(words) for _, words in sets) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MOST_TEMPLATE_WORDS} words in all: scan in parts")
    least = min((_needed(len(words), percent) for _, words in sets), default=1)
    slim = cut(profiles(docs, phrases, vocabulary, least, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()))
    met = matches(slim.select("uid", F.posexplode("blocks").alias("block", "words")), sets, percent) if sets else None
    out = slim.select("uid", "id", "n_words", "found", F.array_sort(F.array_distinct("found.label")).alias("base"))
    if met is None:
        out = out.withColumn("more", F.array().cast("array<string>")).withColumn("best", F.lit(0.0))
    else:
        own = met.groupBy("uid").agg(F.collect_set("label").alias("more"), F.max(F.col("overlap") / F.col("size")).alias("best"))
        out = out.join(own, "uid", "left")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("found").cast("long").alias("n_base"),
        F.array_min("found.place").alias("first_word"),
        F.array_max("found.place").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("found") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
