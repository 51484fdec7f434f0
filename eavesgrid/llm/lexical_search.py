"""Ranked lexical search by scanning documents with an Aho-Corasick automaton; no index of the documents is built.

The terms of all items become patterns of one automaton, each guarded by a blank on both sides.  A document is lower-cased (A-Z only),
everything that is no term character becomes a blank, and one walk over the text finds all whole terms, since neighbours
share their blank.  That gives the term frequencies (tf) of the item terms and, from the same bytes, the length of the document.  They are
written once as a slim table of one row per document.

Number of documents, total length and document frequencies are Spark aggregates over that table.  A second, short step maps
the automaton's outputs to items: each (document, term) weight is added to the items with the term, and each batch
hands on only its ``k`` best documents per item.  These meet in a ranking by item and slice, and then by item.

Scores are integers, so ranks do not depend on the order of rows; the additions are exact in two halves of 32 bits.

Bounds: automaton and outputs are broadcast.  The items are divided into parts of about ``MOST_TERM_BYTES`` of terms and
``MOST_PAIRS`` (item, term) pairs, measured before; each part is a scan of its own, so many items cost time, not memory.  One item is never
divided.  Sums of one item are exact up to 2 million different terms.

Defined results: a null or empty text has no terms and is in no result and in neither average; rows that share an item id are one item
with the terms of all; a null item id is an item; rows of ``docs`` are ranked one by one, also such with equal ids; a null document id comes after all
others of its score; an item without terms, or an empty table on either side, gives no rows.  Texts of any length are scanned whole; one text
has to fit in a task.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..session import cut, scratch_path, ship_package
from .arrays import buffer_of, slices
from .common import ascii_lower, whole

#: What separates terms, the constants of the score
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, TF_SCALE, TF_SHIFT, BASE_LENGTH, LENGTH_SHARE = 1_000_000_000, 1000, 20, 100, 50

BEST = 50
MOST_TERM_BYTES = 4 << 20
MOST_PAIRS = 4_000_000
_CELLS = 2_000_000  # sums of documents x items that are worked on at a time
_SLICES = 32

_BLANK = 0x20
_FOLDED = np.full(256, _BLANK, np.uint8)
for _a, _b in (("0", "9"), ("a", "z")):
    _FOLDED[ord(_a) : ord(_b) + 1] = np.arange(ord(_a), ord(_b) + 1)
_FOLDED[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLDED[128:] = np.arange(128, 256)

_MACHINES: dict[str, object] = {}


def terms_of(text: Column) -> Column:
    """Array of the terms of a text, in order, with repeats."""
    return F.regexp_extract_all(ascii_lower(whole(text)), F.lit(f"({TERM_PATTERN})"), 1)


def _machine(key: str, terms: list[str]):
    """The automaton of the terms; a worker builds it once and keeps only the latest."""
    import ahocorasick

    if key not in _MACHINES:
        _MACHINES.clear()
        machine = ahocorasick.Automaton()
        for number, term in enumerate(terms):
            machine.add_word(f" {term} ", number)
        machine.make_automaton()
        _MACHINES[key] = machine
    return _MACHINES[key]


def _count_batch(ids: pa.Array, texts: pa.Array, machine) -> Iterator[pa.RecordBatch]:
    """Length in terms, and number and frequency of each pattern, row by row."""
    for first, last in slices(texts):
        data, starts = buffer_of(texts.slice(first, last - first))
        folded = _FOLDED[data]
        solid = folded != _BLANK
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        heads = starts[:-1][starts[:-1] < len(data)]
        begins[heads] = solid[heads]
        lengths = np.diff(np.concatenate([[0], np.cumsum(begins)])[starts])
        numbers, counts, ends = [], [], [0]
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b > a and machine is not None:
                text = folded[a:b].tobytes().decode("utf-8", "replace")
                found = Counter(map(itemgetter(1), machine.iter(f" {text} ")))
                numbers.extend(found.keys())
                counts.extend(found.values())
            ends.append(len(numbers))
        ends = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                ids.slice(first, last - first),
                pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(numbers, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
            ],
            ["id", "n", "terms", "tf"],
        )


def term_counts(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """``id, n, terms, tf`` for each row of ``docs``: its length, and the frequencies of those of ``terms`` (by number) it has."""
    ship_package(docs.sparkSession)
    shared, key = docs.sparkSession.sparkContext.broadcast(terms), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(key, shared.value) if shared.value else None
        for batch in batches:
            yield from _count_batch(batch.column(0), batch.column(1), machine)

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = StructType([
        StructField("id", slim.schema["id"].dataType),
        StructField("n", LongType()),
        StructField("terms", ArrayType(IntegerType())),
        StructField("tf", ArrayType(LongType())),
    ])
    return slim.mapInArrow(run, schema)


def term_weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of ``starts[i] .. starts[i] + lengths[i] - 1``, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _best(item: np.ndarray, row: np.ndarray, score: np.ndarray, order: np.ndarray, k: int):
    """The ``k`` highest scores of each item, equal ones by the order of the rows."""
    by = np.lexsort((order[row], -score, item))
    item, row, score = item[by], row[by], score[by]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return item[place < k], row[place < k], score[place < k]


def _score_rows(n, ends, terms, tf, order, weights, item_ends, item_of, n_items: int, n_docs: int, total: int, k: int):
    """Best rows of a batch for each item: item number, row, score."""
    norm = np.fromiter((BASE_LENGTH - LENGTH_SHARE + LENGTH_SHARE * x * n_docs // total for x in n.tolist()), np.int64, len(n)) if total else n
    rows = np.repeat(np.arange(len(n)), np.diff(ends))
    worth = weights[terms] * ((SCALE * tf) // (TF_SCALE * tf + TF_SHIFT * norm[rows]))
    fan = item_ends[terms + 1] - item_ends[terms]
    work = np.concatenate([[0], np.cumsum(fan)])[ends]
    out, first = [], 0
    while first < len(n):
        last = int(np.searchsorted(work, work[first] + _CELLS, "right")) - 1
        last = min(max(first + 1, min(last, first + _CELLS // max(n_items, 1))), len(n))
        here = slice(ends[first], ends[last])
        items = item_of[_ranges(item_ends[terms[here]], fan[here])]
        cell = np.repeat(rows[here] - first, fan[here]) * n_items + items
        value = np.repeat(worth[here], fan[here])
        size = (last - first) * n_items
        low = np.bincount(cell, (value & 0xFFFFFFFF).astype(np.float64), size).astype(np.int64)
        high = np.bincount(cell, (value >> 32).astype(np.float64), size).astype(np.int64)
        score = ((high << 32) + low).reshape(last - first, n_items)
        least = np.maximum(np.partition(score, -k, axis=0)[-k], 1) if last - first > k else 1
        row, item = np.nonzero(score >= least)
        out.append(_best(item, row + first, score[row, item], order, k))
        first = last
    if not out:
        zero = np.zeros(0, np.int64)
        return zero, zero, zero
    return _best(*(np.concatenate(x) for x in zip(*out)), order, k)


def _rank_part(counts: DataFrame, items: list, terms: list[str], pairs: list[tuple[int, int]], item_type, n_docs: int, total: int, k: int) -> DataFrame:
    """``item, id, score``: of each batch of ``counts`` the best documents per item.  ``pairs``: (term, item) numbers, sorted."""
    spark = counts.sparkSession
    holding = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row for each term of this part
    weights = np.array([term_weight(n_docs, holding.get(t, 0)) for t in range(len(terms))], np.int64)
    of_term = np.array([t for t, _ in pairs], np.int64)
    shared = spark.sparkContext.broadcast(
        (weights, np.searchsorted(of_term, np.arange(len(terms) + 1)), np.array([i for _, i in pairs], np.int64), items)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, item_ends, item_of, names = shared.value
        names = None if names is None else pa.array(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, lists, tf = batch.column("id"), batch.column("terms"), batch.column("tf")
            ends = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)[ends[0] : ends[-1]]
            freq = tf.values.to_numpy(zero_copy_only=False)[tf.offsets[0].as_py() : tf.offsets[-1].as_py()]
            order = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64)
            item, row, score = _score_rows(
                batch.column("n").to_numpy(), ends - ends[0], flat, freq, order, weights, item_ends, item_of, len(names), n_docs, total, k
            )
            yield pa.RecordBatch.from_arrays([names.take(pa.array(item)), ids.take(pa.array(row)), pa.array(score)], ["item", "id", "score"])

    schema = StructType([StructField("item", item_type), counts.schema["id"], StructField("score", LongType())])
    return counts.mapInArrow(run, schema)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_col, rank, id_col, score``: the ``k`` highest-scoring documents for each item, scores above 0 only."""
    spark = docs.sparkSession
    wanted = cut(items.select(F.col(item_col).alias("item"), F.explode(F.array_distinct(terms_of(F.col(item_text_col)))).alias("term")).distinct())
    n_pairs = wanted.count()
    n_bytes = wanted.select("term").distinct().agg(F.sum(F.octet_length("term"))).first()[0] or 0
    parts = max(1, math.ceil(n_bytes / MOST_TERM_BYTES), math.ceil(n_pairs / MOST_PAIRS))
    found = None
    for part in range(parts):
        rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect()  # bounded by the number of parts
        names = sorted({r["item"] for r in rows}, key=lambda x: (x is None, x))
        terms = sorted({r["term"] for r in rows})
        number, place = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(names)}
        pairs = sorted((number[r["term"]], place[r["item"]]) for r in rows)
        path = scratch_path(spark, "term-counts")
        term_counts(docs, terms, id_col, text_col).write.parquet(path)
        counts = spark.read.parquet(path)
        n_docs, total = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        best = _rank_part(counts.where(F.size("terms") > 0), names, terms, pairs, wanted.schema["item"].dataType, n_docs, total, k)
        found = best if found is None else found.unionByName(best)
    order = [F.desc("score"), F.asc_nulls_last("id")]
    slice_no = F.pmod(F.spark_partition_id(), F.lit(_SLICES))
    first = found.withColumn("slice", slice_no).withColumn("rank", F.row_number().over(Window.partitionBy("item", "slice").orderBy(*order)))
    last = first.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return last.where(F.col("rank") <= k).select(
        F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )
