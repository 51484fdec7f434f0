"""Removal of repeated passages by suffix arrays of shards.

Every window of ``length`` bytes is named by the smallest hash among its grams of ``GRAM`` bytes.  Equal windows have equal names, so
all places of a window meet in the shard of its name.  Neighbouring windows with one name travel together as a segment.

1. Segments are numbers at first (name, hash, document, place).  Names that occur once are dropped, unless a gram comes again
   nearby (as in ``a a a a``), so that windows of one segment may be equal; segments equal to an earlier one are repeats as a whole.
2. Of each kind of segment that is not alone with its name the first one sends its bytes to the shard of its name.  A shard's segments, laid end to
   end, get a suffix array by induced sorting and its permuted common prefixes; neighbours in the array that share ``length``
   bytes are equal windows, and all but the earliest are repeats.
3. Repeats are put together for each document and cut out of its text.

A shard takes whole names up to about ``SHARD_BYTES``.  A name with more than ``MOST_KINDS`` kinds of segments, such as the edge of a
passage that a third of all documents have, is not one shard: its windows are dealt out one by one, by their own hashes, as
segments of a single window in step 1.

A text is read in parts of ``PART_BYTES`` that overlap by a window, so that its length does not matter.

Defined results: a null text is empty; nothing repeats in texts below ``length`` bytes; earlier means smaller id (null first),
among rows with one id smaller hash of the text, and then the smaller place; rows equal in id and text are one document and
lose the same; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship_package
from .arrays import buffer_of, slices, span_hashes, window_hashes
from .common import join_keyed, whole
from .suffix_array import common_prefixes, suffix_array

LENGTH = 100
GRAM = 24
MOST_STARTS = 128  # windows in a segment
PART_BYTES = 2 << 20
SHARD_BYTES = 1 << 18
MOST_KINDS = 20_000
BROADCAST_ROWS = 500_000
BROADCAST_ENTRIES = 4_000_000  # of 16 bytes


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values, by doubling."""
    out, span = values, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if width > span else out


def _parts(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, bytes left out before, data, row starts)`` of stretches that hold every window once."""
    for first, last in slices(column, PART_BYTES):
        data, starts = buffer_of(column.slice(first, last - first))
        if last - first > 1 or len(data) <= 2 * PART_BYTES:
            yield first, 0, data, starts
            continue
        for at in range(0, len(data), PART_BYTES):
            part = data[at : at + PART_BYTES + length - 1]
            if len(part) >= length:
                yield first, at, part, np.array([0, len(part)])


def _recurring(grams: np.ndarray, width: int) -> np.ndarray:
    """Sorted places, one in each stretch of ``step``, whose gram comes again within a segment's reach.

    Two equal windows of a segment lie less than ``MOST_STARTS`` apart, and so do all grams in them; a window holds
    ``width`` grams, so one of these places is among them.
    """
    step = min(64, width)
    base = grams[::step]
    again = np.zeros(len(base), bool)
    for apart in range(1, MOST_STARTS):
        other = grams[apart::step][: len(base)]
        again[: len(other)] |= other == base[: len(other)]
    return np.flatnonzero(again) * step


def segments(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``row, at, name, hash`` of all segments.

    ``at`` holds three numbers: the start in the row (times 512), 256 if windows of the segment may be equal, and the number
    of windows.
    """
    empty = tuple(np.zeros(0, np.int64) for _ in range(2)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    gram = min(GRAM, length)
    if len(data) < length:
        return empty
    grams = window_hashes(data, gram)
    names = _smallest(grams, length - gram + 1)
    place = np.arange(len(names))
    row = np.searchsorted(starts, place, "right") - 1
    fits = place + length <= starts[row + 1]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1]) | ~fits[:-1]
    begin = np.flatnonzero(new & fits)
    if not len(begin):
        return empty
    edge = np.flatnonzero(new | ~fits)
    end = np.append(edge, len(names))[np.searchsorted(edge, begin, "right")]
    pieces = -(-(end - begin) // MOST_STARTS)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(begin, pieces) + nth * MOST_STARTS
    windows = np.minimum(np.repeat(end, pieces) - start, MOST_STARTS)
    hashes = span_hashes(data, start, start + windows + length - 1)
    recurring = np.append(_recurring(grams, length - gram + 1), len(data))
    doubtful = recurring[np.searchsorted(recurring, start)] <= start + windows - 1 + length - gram
    at = ((start - starts[row[start]]) << 9) | (doubtful.astype(np.int64) << 8) | windows
    return row[start], at, names[start], hashes


def _occurrences(docs: DataFrame, length: int) -> DataFrame:
    """``name, hash, id, text, at``: every segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, left_out, data, starts in _parts(batch.column("body"), length):
                row, at, names, hashes = segments(data, starts, length)
                rows = pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(hashes.view(np.int64)), batch.column("id").take(rows),
                     batch.column("text").take(rows), pa.array(at + (left_out << 9))],
                    names=["name", "hash", "id", "text", "at"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"name long, hash long, id {kind}, text long, at long")


def _with_body(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``id, text`` and lists to work on, one row a document) with the texts.

    Up to ``BROADCAST_ROWS`` documents and ``BROADCAST_ENTRIES`` entries of their lists are sent to the texts; otherwise both
    sides are shuffled.
    """
    wanted = cut(wanted)
    rows, entries = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("todo")), F.lit(0))).first()
    small = rows <= BROADCAST_ROWS and entries <= BROADCAST_ENTRIES
    return join_keyed(docs, F.broadcast(wanted) if small else wanted.hint("shuffle_hash"), ["id", "text"], "inner")


def _doubtful(at: str) -> Column:
    return F.col(at).bitwiseAND(256) > 0


def _copies(rows: DataFrame, kinds: DataFrame, keys: list[str]) -> DataFrame:
    """``id, text, at`` of the rows that are not the first of their kind."""
    later = rows.join(kinds.where("n > 1").select(*keys, "first"), keys)
    return later.where(~F.struct("id", "text", "at").eqNullSafe(F.col("first"))).select("id", "text", "at")


def _kinds(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min(F.struct("id", "text", "at")).alias("first"), F.count(F.lit(1)).alias("n"))


def _single_windows(docs: DataFrame, reps: DataFrame, length: int) -> DataFrame:
    """``hash, other, id, text, at`` for each window of the segments, as segments of one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, todo in enumerate(batch.column("todo").to_pylist()):
                body = np.frombuffer(batch.column("body")[i].as_buffer(), np.uint8)
                for item in todo:
                    start, windows = item["at"] >> 9, item["at"] & 255
                    data = body[start : start + windows + length - 1]
                    begin = np.arange(windows)
                    hashes = [span_hashes(data, begin, begin + length, other).view(np.int64) for other in (False, True)]
                    where = pa.array(np.full(windows, i))
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, hashes), batch.column("id").take(where), batch.column("text").take(where),
                         pa.array(((start + begin) << 9) | 1)],
                        names=["hash", "other", "id", "text", "at"],
                    )

    kind = docs.schema["id"].dataType.simpleString()
    wanted = reps.groupBy("id", "text").agg(F.collect_list(F.struct("at")).alias("todo"))
    return _with_body(docs, wanted).select("id", "text", "body", "todo").mapInArrow(run, f"hash long, other long, id {kind}, text long, at long")


def _bytes(docs: DataFrame, reps: DataFrame, length: int) -> DataFrame:
    """``name, id, text, at, data`` of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names, ats, data = [], [], [], []
            for i, todo in enumerate(batch.column("todo").to_pylist()):
                body = batch.column("body")[i].as_buffer().to_pybytes()
                for item in todo:
                    start, windows = item["at"] >> 9, item["at"] & 255
                    rows.append(i)
                    names.append(item["name"])
                    ats.append(item["at"])
                    data.append(body[start : start + windows + length - 1])
            where = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), batch.column("id").take(where), batch.column("text").take(where),
                 pa.array(ats, pa.int64()), pa.array(data, pa.binary())],
                names=["name", "id", "text", "at", "data"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    wanted = reps.groupBy("id", "text").agg(F.collect_list(F.struct("name", "at")).alias("todo"))
    return _with_body(docs, wanted).select("id", "text", "body", "todo").mapInArrow(run, f"name long, id {kind}, text long, at long, data binary")


def repeated_windows(parts: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(part, start)`` of the windows of ``length`` bytes that also start earlier: in an earlier part, or earlier in the same."""
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(parts) + 1, np.int64)
    raw = np.zeros(len(text), np.uint8)
    valid = np.zeros(len(text), bool)
    for part, begin in zip(parts, begins, strict=True):
        text[begin : begin + len(part)] = part
        text[begin : begin + len(part)] += 2
        text[begin + len(part)] = 1
        raw[begin : begin + len(part)] = part
        valid[begin : begin + max(0, len(part) - length + 1)] = True
    order = suffix_array(text, 258)
    shared = common_prefixes(raw, order, length)
    # Only windows inside a part count; between equal ones lie no others, since a part's end is a letter of its own.
    order = order[valid[order]]
    new = shared[order] < length
    new[:1] = True
    group = np.cumsum(new) - 1
    earliest = np.full(group[-1] + 1 if len(group) else 0, len(text))
    np.minimum.at(earliest, group, order)
    again = np.sort(order[order != earliest[group]])
    part = np.searchsorted(begins, again, "right") - 1
    return part, again - begins[part]


def _sharded(length: int):
    def solve(rows: pa.Table) -> pa.RecordBatch | None:
        parts = [np.frombuffer(x.as_buffer(), np.uint8) for x in rows.column("data")]
        part, start = repeated_windows(parts, length)
        if not len(part):
            return None
        new = np.ones(len(part), bool)
        new[1:] = (part[1:] != part[:-1]) | (start[1:] != start[:-1] + 1)
        head = np.flatnonzero(new)
        windows = np.diff(np.append(head, len(part)))
        base = rows.column("at").to_numpy()[part[head]] >> 9
        mine = rows.select(["id", "text"]).take(pa.array(part[head])).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [mine.column("id").combine_chunks(), mine.column("text").combine_chunks(), pa.array(((base + start[head]) << 9) | windows)],
            names=["id", "text", "at"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("name").to_numpy()
            lengths = np.diff(buffer_of(batch.column("data"))[1])
            edges = np.append(np.flatnonzero(names[1:] != names[:-1]) + 1, batch.num_rows)
            if held and held[-1].column("name")[held[-1].num_rows - 1].as_py() != names[0]:
                edges = np.append(0, edges)
            done = 0
            for at, total in zip(edges, np.append(0, np.cumsum(lengths))[edges], strict=True):
                if at == batch.num_rows:  # the name may go on in the next batch
                    break
                if size + total >= SHARD_BYTES:
                    out = solve(pa.Table.from_batches([*held, batch.slice(done, at - done)]))
                    held, size, done = [], -int(total), int(at)
                    if out:
                        yield out
            held.append(batch.slice(done))
            size += int(lengths.sum())
        if held:
            out = solve(pa.Table.from_batches(held))
            if out:
                yield out

    return run


def _merged(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for ats in batch.column("ats"):
                at = np.sort(ats.values.to_numpy())
                start = at >> 9
                end = np.maximum.accumulate(start + (at & 255) + length - 1)
                new = np.ones(len(at), bool)
                new[1:] = start[1:] > end[:-1]
                heads = np.flatnonzero(new)
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(start[heads], np.append(end[heads[1:] - 1], end[-1]), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text"), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["id", "text", "todo"],
            )

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, body``: the hash of the text tells rows with one id apart; where ids are unique it is left 0."""
    body = whole(F.col(text_col))
    unique = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    text = F.lit(0).cast("long") if unique else F.xxhash64(body)
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), body.cast("binary").alias("body"))


def _spans(docs: DataFrame, length: int) -> DataFrame:
    found = _occurrences(docs, length)
    shared = found.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max(_doubtful("at")).alias("d"))
    shared = shared.where("n > 1 or d").select("name")
    rows = cut(found.join(shared, "name", "left_semi"))
    kinds = cut(_kinds(rows, ["name", "hash"]))
    many = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("k"), F.max(_doubtful("first.at")).alias("d")).where("k > 1 or d")
    reps = cut(kinds.join(many.drop("d"), "name").select("name", "k", "first.*"))
    again = _copies(rows, kinds, ["name", "hash"])
    data = _bytes(docs, reps.where(F.col("k") <= MOST_KINDS), length)
    # Within a name the segments come in the order of what is earlier.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sharded = data.repartition(parts, "name").sortWithinPartitions("name", "id", "text", "at")
    kind = docs.schema["id"].dataType.simpleString()
    again = again.unionByName(sharded.mapInArrow(_sharded(length), f"id {kind}, text long, at long"))
    hot = reps.where(F.col("k") > MOST_KINDS)
    if not hot.isEmpty():
        windows = cut(_single_windows(docs, hot, length))
        again = again.unionByName(_copies(windows, _kinds(windows, ["hash", "other"]), ["hash", "other"]))
    lists = again.groupBy("id", "text").agg(F.collect_list("at").alias("ats"))
    span = "array<struct<start: long, end: long>>"
    return lists.mapInArrow(_merged(length), f"id {kind}, text long, todo {span}")


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for body, spans in zip(batch.column("body"), batch.column("todo").to_pylist(), strict=True):
            data, at, left = body.as_buffer().to_pybytes(), 0, []
            for span in spans or ():
                left.append(data[at : span["start"]])
                at = span["end"]
            kept.append(b"".join([*left, data[at:]]) if spans else data)
        columns = {c: batch.column(c) for c in batch.schema.names if c != "body"}
        yield pa.RecordBatch.from_pydict({**columns, "kept": pa.array(kept, pa.binary())})


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_bytes, spans, kept``.

    ``spans`` are the maximal removed runs (start, end exclusive, in bytes of the text in UTF-8), ``kept`` the bytes left.
    """
    ship_package(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    spans = cut(_spans(keyed, length))
    rows, entries = spans.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("todo")), F.lit(0))).first()
    small = rows <= BROADCAST_ROWS and entries <= BROADCAST_ENTRIES
    joined = join_keyed(keyed, F.broadcast(spans) if small else spans.hint("shuffle_hash"), ["id", "text"])
    kind = keyed.schema["id"].dataType.simpleString()
    span = "array<struct<start: long, end: long>>"
    out = joined.select("id", F.octet_length("body").cast("long").alias("n_bytes"), "body", "todo").mapInArrow(
        _cut_out, f"id {kind}, n_bytes long, todo {span}, kept binary"
    )
    return out.select(F.col("id").alias(id_col), "n_bytes", F.coalesce("todo", F.array().cast(span)).alias("spans"), "kept")
