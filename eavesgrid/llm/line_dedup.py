"""Line deduplication with keep bitmaps.

Every line becomes a row of two 64-bit hashes of its key, its document and its position.  The rows are range-partitioned and sorted by
(hashes, document, position), so that the lines of one key follow each other, first occurrences per document in order.  The range
keys include the document: a line that a third of all documents have is spread over as many partitions as it needs.  Each partition
is read as a stream; it holds back a key only until its limit of documents is reached.  What a key had in neighbouring partitions
is settled by two counts per partition, the only thing the driver sees.

What comes back to the documents is no text but a compressed bitmap of the lines to keep, for documents that lose any.

Defined results: a null or empty text is one empty line; empty keys are never dropped; rows equal in id and text are one document;
null ids are an id of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..session import cut, ship_package
from .arrays import buffer_of, fold, line_spans, slices, span_hashes
from .common import join_keyed, one_column, whole

LIMIT = 10  # documents in which a line may not be found
ORDER = ["a", "b", "id", "text", "pos"]
ROWS_OUT = 200_000


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last in slices(batch.column("body")):
            part = batch.slice(first, last - first)
            data, starts = buffer_of(part.column("body"))
            begin, end, n = line_spans(data, starts)
            some = np.flatnonzero(begin < end)
            row = np.repeat(np.arange(len(n)), n)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            folded = fold(data)
            for at in range(0, len(some), ROWS_OUT):
                take = some[at : at + ROWS_OUT]
                mine = pa.array(row[take])
                hashes = [
                    pa.array(span_hashes(folded, begin[take], end[take], other).view(np.int64)) for other in (False, True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*hashes, part.column("id").take(mine), part.column("text").take(mine),
                     pa.array(pos[take].astype(np.int32)), pa.array(n[row[take]].astype(np.int32))],
                    names=[*ORDER, "n"],
                )


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``a, b, id, text, pos, n``: hashes of a line's key, document, position, and lines in the document."""
    body = whole(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(body).alias("text"), body.alias("body"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_line_rows, f"a long, b long, id {kind}, text long, pos int, n int")


def _columns(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    out = {}
    for name in batch.schema.names:
        column = batch.column(name)
        if name == "id":  # a code per id is enough to see where it changes; the id itself travels as Arrow
            code = column.dictionary_encode()
            out[name] = np.asarray(code.indices.fill_null(-1), dtype=np.int64)
        else:
            out[name] = column.to_numpy(zero_copy_only=False)
    return out


def _steps(cols: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where a new key begins, and where a new document of a key begins."""
    n = len(cols["a"])
    key = np.ones(n, bool)
    key[1:] = (cols["a"][1:] != cols["a"][:-1]) | (cols["b"][1:] != cols["b"][:-1])
    doc = key.copy()
    doc[1:] |= (cols["id"][1:] != cols["id"][:-1]) | (cols["text"][1:] != cols["text"][:-1])
    return key, doc


ENDS = "part int, first_a long, first_b long, first_docs long, last_a long, last_b long, last_docs long, keys long"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with the first and with the last key of the partition."""
    first = last = None
    first_docs = last_docs = keys = 0
    tail = None  # the last row so far, to see whether the next batch goes on with its document
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([tail, batch] if tail is not None else [batch]).combine_chunks().to_batches()[0]
        skip = int(tail is not None)
        cols = _columns(table)
        key, doc = _steps(cols)
        group = np.cumsum(key) - 1
        docs = np.bincount(group[skip:], weights=doc[skip:], minlength=group[-1] + 1).astype(np.int64)
        heads = np.flatnonzero(key)
        for g in {0, len(heads) - 1}:
            at = (int(cols["a"][heads[g]]), int(cols["b"][heads[g]]))
            if at != last:
                last, last_docs = at, 0
                keys += 1
            last_docs += int(docs[g])
            if first is None:
                first = at
            if at == first:
                first_docs = last_docs
        tail = batch.slice(batch.num_rows - 1, 1)
    if first is not None:
        row = [TaskContext.get().partitionId(), *first, first_docs, *last, last_docs, keys]
        types = [pa.int32()] + [pa.int64()] * 7
        names = [x.split()[0] for x in ENDS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=names)


def _totals(ends: list) -> dict[tuple[int, int], int]:
    """Documents over all partitions, for the keys at the ends of partitions."""
    out: dict[tuple[int, int], int] = {}
    for r in ends:
        out[r.first_a, r.first_b] = out.get((r.first_a, r.first_b), 0) + r.first_docs
        if (r.last_a, r.last_b) != (r.first_a, r.first_b):
            out[r.last_a, r.last_b] = out.get((r.last_a, r.last_b), 0) + r.last_docs
    return out


def _dropped(limit: int, totals: dict[tuple[int, int], int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # rows of the last key, while it is undecided
        hot: tuple[int, int] | None = None  # the last key, once it is known to be over the limit
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            cols = _columns(batch)
            key, doc = _steps(cols)
            group = np.cumsum(key) - 1
            heads = np.flatnonzero(key)
            docs = np.bincount(group, weights=doc)
            for g in {0, len(heads) - 1}:
                at = (int(cols["a"][heads[g]]), int(cols["b"][heads[g]]))
                docs[g] = max(docs[g], totals.get(at, 0), limit if at == hot else 0)
            over = docs >= limit
            last = (int(cols["a"][heads[-1]]), int(cols["b"][heads[-1]]))
            held = None
            if over[-1]:
                hot = last
            elif last not in totals:  # fewer than ``limit`` documents so far: more may come
                held = batch.slice(int(heads[-1]))
            out = batch.filter(pa.array(over[group]))
            if out.num_rows:
                yield out.select(["id", "text", "pos", "n"])

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for n, gone in zip(batch.column("n").to_pylist(), batch.column("gone"), strict=True):
            bits = np.ones(n, np.uint8)
            bits[gone.values.to_numpy()] = 0
            keep.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("text"), batch.column("n"), pa.array(keep, pa.binary())],
            names=["id", "text", "n_lines", "keep"],
        )


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """``id, text, n_lines, keep`` for the documents that lose lines; ``text`` is the hash of the text, ``keep`` a
    zlib-compressed bitmap with the first line in the highest bit of the first byte."""
    spark = docs.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cut(line_rows(docs, id_col, text_col))  # sampled for the ranges and then dealt out: the text is read once
    rows = cut(rows.repartitionByRange(parts, *ORDER[:4]).sortWithinPartitions(*ORDER))  # both passes below see the same partitions
    totals = _totals(rows.mapInArrow(_ends, ENDS).collect())
    id_type = rows.schema["id"].dataType.simpleString()
    gone = rows.mapInArrow(_dropped(limit, totals), f"id {id_type}, text long, pos int, n int")
    gone = gone.groupBy("id", "text").agg(F.max("n").alias("n"), F.collect_set("pos").alias("gone"))
    return gone.mapInArrow(_bitmaps, f"id {id_type}, text long, n_lines int, keep binary")


def kept_lines(text: str, keep: bytes | None) -> tuple[str, int, int]:
    """The text without the dropped lines, the number of lines, and how many were dropped."""
    lines = text.split("\n")
    if keep is None:
        return text, len(lines), 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    left = [line for line, bit in zip(lines, bits, strict=True) if bit]
    return "\n".join(left), len(lines), len(lines) - len(left)


def _applied(made: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keeps = batch.column("text").to_pylist(), batch.column("keep").to_pylist()
            found = [kept_lines(t or "", k) for t, k in zip(texts, keeps, strict=True)]
            out = [x[0] if made == "kept" else hashlib.sha256(x[0].encode()).hexdigest() for x in found]
            columns = [batch.column("row"), pa.array(out, pa.string()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", made, "n_lines", "n_dropped"])

    return run


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """``docs`` with its texts cut to the lines to keep, ``n_lines`` and ``n_dropped``; instead of the text
    ``kept_sha256`` if ``with_text`` is false.  All other columns stay, but for those with the new names."""
    ship_package(docs.sparkSession)
    new = ["n_lines", "n_dropped"] if with_text else ["n_lines", "n_dropped", "kept_sha256"]
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text_col and (c not in new or c == id_col)])
    text = F.col(text_col)
    keyed = docs.select(one_column(rest), text.cast("string").alias("text"), F.xxhash64(whole(text)).alias("__text"), F.col(id_col).alias("__id"))
    right = bitmaps.select(F.col("id").alias("__id"), F.col("text").alias("__text"), "keep")
    joined = join_keyed(keyed, right.hint("shuffle_hash"), ["__id", "__text"]).select("row", "text", "keep")
    made = "kept" if with_text else "kept_sha256"
    schema = StructType([joined.schema["row"], StructField(made, StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    out = joined.mapInArrow(_applied(made), schema)
    own = [F.col(f"row.`{c}`") for c in rest.columns]
    return out.select(*own, F.col(made).alias(text_col if with_text else made), "n_lines", "n_dropped")
