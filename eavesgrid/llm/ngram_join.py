"""Jaccard join of word n-grams, and the classes of documents it links.

Documents with equal sets are one class from the start.  A link needs a shared token among the first few of both sets in a common
order (hash order, tokens that a sample shows to be frequent last), so an index of those tokens finds every candidate.

*Block skipping by position.*  Each index list is divided into blocks of sizes.  From the position of a token in a set follows the
largest set it can still link with; blocks beyond are never met, since the join is on (token, block).

*Answers from similar sets.*  In each block one leader is chosen, first the set that meets the most others: of many copies, the original.  Each
set is compared with one of its leaders.  A set that links with its leader takes over the leader's class, so pairs inside a class are
never made, however large it is.  Leaders change as long as one in 20 of their pairs is a link and many pairs between classes are left.  Then the
pairs between classes are all made, and the leaders' answers bound their overlap: ``|x & y| <= |x - leader| + |leader & y|``.  So no link between
classes is lost, and a pile of near copies costs one pair each.

Tests are graded: the bound from the leader, then parity sketches of ``n / 4`` bytes (the number of differing bits never
exceeds the symmetric difference), then the exact overlap.  Only sets that pass are built again from their texts.

The sample decides only the order, and with it the work, never the result.  Shingles are compared by 64-bit hashes.

Defined results: a null text, or one without words, has an empty set and links with nothing; rows equal in id and text are equal
documents; a null id is smaller than any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut, release, ship_package
from .arrays import buffer_of, give_back, shingle_hashes, slices, word_hashes
from .common import join_keyed, keep_rows, whole

SAMPLE = 16  # one text of so many is looked at for frequent shingles
HOT_IN_SAMPLE = 4
MOST_HOT = 200_000
BROADCAST_ROWS = 500_000
PAIRS_PER_ROW = 4  # with more pairs than that left between classes, new leaders are tried first,
LINKS_IN_PAIRS = 20  # as long as one in so many of their pairs is a link
FEW_ROWS = 100_000  # pairs and links up to so many rows (of 40 bytes or less) are broadcast, or worked on by one task without a shuffle
SKETCH_BYTES = 32 << 20  # leaders' sketches are broadcast up to this size


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first, last in slices(column):
        shingles, counts = shingle_hashes(*word_hashes(*buffer_of(column.slice(first, last - first))), size)
        for part in np.split(shingles, np.cumsum(counts)[:-1]):
            yield np.unique(part)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def prefix_length(n: int, percent: int) -> int:
    """Of two linked sets one token at least is among the first so many of each; 0 if only equal sets can link."""
    return 0 if 100 * n < percent * (n + 1) else n - -(-percent * n // 100) + 1


def sketch(values: np.ndarray) -> bytes:
    """Parity of the number of hashes in each of at least ``2 n`` ranges (a power of two)."""
    bits = max(6, (2 * len(values) - 1).bit_length())
    at = (values >> np.uint64(64 - bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=1 << bits) & 1).astype(np.uint8)).tobytes()


def sketch_overlap(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """An upper bound of the overlap: the symmetric difference is at least the number of ranges of different parity."""
    if len(a) < len(b):
        a, b = b, a
    x, y = np.unpackbits(np.frombuffer(a, np.uint8)), np.unpackbits(np.frombuffer(b, np.uint8))
    if len(x) > len(y):
        x = x.reshape(len(y), -1).sum(axis=1, dtype=np.int64).astype(np.uint8) & 1
    return min(n_a, n_b, (n_a + n_b - int(np.count_nonzero(x != y))) // 2)


def _frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of the texts shows to be frequent, sorted by hash, and their ranks, rarest first."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values in _sets(batch.column("body"), size):
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], names=["token"])

    rows = docs.where(F.pmod("text", F.lit(SAMPLE)) == 0).select("body").mapInArrow(tokens, "token long")
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= HOT_IN_SAMPLE)
    found = counts.orderBy(F.desc("c"), "token").limit(MOST_HOT).toPandas()
    values = found["token"].to_numpy(np.int64).view(np.uint64)[::-1]
    order = np.argsort(values)
    return values[order], np.arange(len(values))[order]


def _profiles(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``uid, id, text, n, digest, prefix, sketch`` for every row."""
    hot = docs.sparkSession.sparkContext.broadcast(_frequent(docs, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_values, hot_ranks = hot.value
        for batch in batches:
            n, digests, prefixes, sketches = [], [], [], []
            for values in _sets(batch.column("body"), size):
                length = prefix_length(len(values), percent)
                n.append(len(values))
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                sketches.append(sketch(values) if length else b"")
                if length and len(hot_values):
                    at = np.minimum(np.searchsorted(hot_values, values), len(hot_values) - 1)
                    is_hot = hot_values[at] == values
                    cold = values[~is_hot][:length]
                    if len(cold) < length:
                        late = values[is_hot][np.argsort(hot_ranks[at[is_hot]])]
                        cold = np.concatenate([cold, late[: length - len(cold)]])
                    values = cold
                prefixes.append(values[:length].copy())  # not a view, which would keep the whole set
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text"), pa.array(n, pa.int32()), pa.array(digests, pa.binary()),
                 _lists(prefixes), pa.array(sketches, pa.binary())],
                names=["id", "text", "n", "digest", "prefix", "sketch"],
            )
            del n, digests, prefixes, sketches, batch
            give_back()

    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.mapInArrow(run, f"id {kind}, text long, n int, digest binary, prefix array<long>, sketch binary")
    return cut(rows.withColumn("uid", F.monotonically_increasing_id()))


def _needed_overlap(n_a: Column, n_b: Column, percent: int) -> Column:
    return F.ceil(percent * (n_a + n_b) / F.lit(100.0 + percent) - 1e-6)


def _few(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if a count shows that they are few."""
    return F.broadcast(rows) if rows.count() <= FEW_ROWS else rows


class _Join:
    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        wide = _profiles(docs, size, percent)
        self.profiles = cut(wide.select("uid", "id", "text", "n", "digest"))
        self.reps = cut(self.profiles.where("n > 0").groupBy("digest").agg(F.min("uid").alias("rep")))
        classes = wide.where(F.size("prefix") > 0).select("uid", "n", "prefix", "sketch")
        self.classes = cut(classes.join(self.reps.select(F.col("rep").alias("uid")), "uid", "left_semi"))
        rows = self.classes.select("uid", "n", F.posexplode("prefix").alias("pos", "token"))
        shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        # Sizes of linked sets differ by the factor percent / 100 at most, hence by one block.
        width = -math.log(percent / 100 - 0.01)
        block = F.floor(F.log(F.col("n")) / width).cast("int")
        rows = cut(rows.join(shared, "token").withColumn("block", block))
        # How many rows a set meets in all its lists: the original of many copies has none of their changes, and meets the most.
        middle = rows.groupBy("uid").agg(F.sum("c").alias("rank"))
        self.index = cut(rows.drop("c").join(middle, "uid"))
        self.sketches = self.classes.select("uid", "sketch")
        del wide, classes, rows, shared
        release(docs.sparkSession)

    def _can_link(self, a: str, b: str) -> Column:
        """Sizes and positions allow a link."""
        n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
        rest = F.least(n_a - F.col(f"{a}.pos"), n_b - F.col(f"{b}.pos"))
        return (
            (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * self.percent) & (rest >= _needed_overlap(n_a, n_b, self.percent))
        )

    def _open(self, roots: DataFrame | None) -> DataFrame:
        """Index rows with their class so far, of the lists that still hold several classes."""
        if roots is None:
            return self.index.withColumn("root", F.col("uid"))
        rows = self.index.join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
        mixed = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("token")
        return rows.join(mixed, "token", "left_semi")

    def _reach(self, rows: DataFrame) -> DataFrame:
        """Each row in its own block, and in the next one if its position leaves room for sets of that size."""
        largest = (F.col("n") - F.col("pos")) * F.lit((100.0 + self.percent) / self.percent) - F.col("n") + 1e-6
        width = -math.log(self.percent / 100 - 0.01)
        next_starts = F.exp((F.col("block") + 1) * F.lit(width)) - 1
        blocks = F.when(largest >= next_starts, F.array("block", F.col("block") + 1)).otherwise(F.array("block"))
        return rows.withColumn("at", F.explode(blocks))

    def leader_pairs(self, rows: DataFrame, turn: int) -> DataFrame:
        """``a, b``: each set with one leader of its blocks, of another class, that it can link with.

        Leaders of a block are the sets that meet the most others, in later turns any; of its leaders a set takes the first.
        """
        rows = self._reach(rows)
        place = -F.col("rank") if turn == 0 else F.lit(0).cast("long")
        first = F.min(F.struct(place.alias("place"), F.xxhash64("uid", F.lit(turn)).alias("h"), "uid", "n", "pos", "root")).alias("l")
        leaders = rows.groupBy("token", "at").agg(first).select("token", "at", "l.*")
        pairs = rows.alias("x").join(
            leaders.alias("l"),
            (F.col("x.token") == F.col("l.token")) & (F.col("x.at") == F.col("l.at")) & (F.col("x.root") != F.col("l.root"))
            & self._can_link("x", "l"),
        )
        one = F.min(F.struct("l.place", "l.h", F.col("l.uid").alias("a"), F.col("l.n").alias("n_a"))).alias("one")
        return pairs.groupBy(F.col("x.uid").alias("b"), F.col("x.n").alias("n_b")).agg(one).select("one.a", "b", "one.n_a", "n_b")

    def all_pairs(self, rows: DataFrame) -> DataFrame:
        """``a, b``: all pairs of different classes that can link."""
        left = rows.withColumn("at", F.col("block"))
        right = self._reach(rows)
        own = F.col("x.block") == F.col("y.block")
        pairs = left.alias("x").join(
            right.alias("y"),
            (F.col("x.token") == F.col("y.token")) & (F.col("x.at") == F.col("y.at")) & (F.col("x.root") != F.col("y.root"))
            & (~own | (F.col("x.uid") < F.col("y.uid"))) & self._can_link("x", "y"),
        )
        return pairs.select(F.col("x.uid").alias("a"), F.col("y.uid").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")).distinct()

    def sketched(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with ``most``, an upper bound of the overlap."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("s_a", "s_b", "n_a", "n_b")]
                most = pa.array([sketch_overlap(*row) for row in zip(*columns, strict=True)], pa.int32())
                kept = [batch.column(c) for c in ("a", "b", "n_a", "n_b")]
                yield pa.RecordBatch.from_arrays([*kept, most], names=["a", "b", "n_a", "n_b", "most"])

        pairs = _few(cut(pairs))
        firsts = cut(self.sketches.join(_few(cut(pairs.select(F.col("a").alias("uid")).distinct())), "uid"))
        n_bytes = firsts.agg(F.sum(F.length("sketch") + 16)).first()[0] or 0
        firsts = F.broadcast(firsts) if n_bytes <= SKETCH_BYTES else firsts
        both = self.sketches.select(F.col("uid").alias("b"), F.col("sketch").alias("s_b")).join(pairs, "b")
        both = both.join(firsts.select(F.col("uid").alias("a"), F.col("sketch").alias("s_a")), "a")
        return both.mapInArrow(run, "a long, b long, n_a int, n_b int, most int")

    def tested(self, pairs: DataFrame) -> DataFrame:
        """``a, b, overlap`` of the linked ones among ``pairs``, by their whole sets."""
        need = pairs.select(F.col("a").alias("uid")).union(pairs.select("b")).distinct()
        named = self.profiles.select("uid", "id", "text").join(need, "uid", "left_semi")
        named = cut(named)
        if named.count() <= BROADCAST_ROWS:
            named = F.broadcast(named)
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, last in slices(batch.column("body")):
                    part = batch.slice(first, last - first)
                    values = _lists(list(_sets(part.column("body"), size)))
                    yield pa.RecordBatch.from_arrays([part.column("uid"), values], names=["uid", "values"])
                    del part, values
                give_back()

        sets = join_keyed(self.docs, named, ["id", "text"], "inner").select("uid", "body").mapInArrow(run, "uid long, values array<long>")
        sets = sets.groupBy("uid").agg(F.first("values").alias("values"))
        both = pairs.join(sets.select(F.col("uid").alias("b"), F.col("values").alias("v_b")), "b")
        both = both.join(sets.select(F.col("uid").alias("a"), F.col("values").alias("v_a")), "a")
        both = both.withColumn("overlap", F.size(F.array_intersect("v_a", "v_b")))
        linked = 100 * F.col("overlap") >= self.percent * (F.col("n_a") + F.col("n_b") - F.col("overlap"))
        return both.where(linked).select("a", "b", "overlap")

    def _promising(self, pairs: DataFrame) -> DataFrame:
        return pairs.where(F.col("most") >= _needed_overlap(F.col("n_a"), F.col("n_b"), self.percent))

    def _bounded(self, pairs: DataFrame, answers: DataFrame, links: DataFrame) -> DataFrame:
        """``pairs`` without those that the answers of a leader of ``b`` rule out."""
        own = links.groupBy(F.col("b").alias("x")).agg(F.max_by(F.struct("a", "overlap"), "overlap").alias("own"))
        known = _few(cut(answers.groupBy(F.col("a").alias("leader"), F.col("b").alias("other")).agg(F.min("most").alias("most"))))
        own = _few(cut(own))
        out = pairs
        for x, y in (("a", "b"), ("b", "a")):
            out = out.join(own.withColumnRenamed("x", x), x, "left")
            out = out.withColumns({"leader": F.col("own.a"), "apart": F.col(f"n_{x}") - F.col("own.overlap")}).drop("own")
            out = out.join(known.withColumnRenamed("other", y), ["leader", y], "left")
            bound = F.col("apart") + F.col("most")
            out = out.where(F.col("most").isNull() | (bound >= _needed_overlap(F.col("n_a"), F.col("n_b"), self.percent)))
            out = out.drop("leader", "apart", "most")
        return out

    def _classes_so_far(self, links: DataFrame) -> DataFrame:
        """``uid, root``: a set's best leader, then the best one that leader's sets have, and once more.

        Equal roots are connected; connected sets may differ in root, which costs pairs but no links, and saves all rounds
        of a full search for components.
        """
        links = links.coalesce(1 + links.count() // FEW_ROWS)  # in one part there is nothing to shuffle
        both = cut(links.select(F.explode(F.array("a", "b")).alias("uid"), F.col("a").alias("leader")).distinct())

        def smallest(column: str) -> Column:
            return F.min_by(column, F.xxhash64(column)).alias("root")

        best = both.groupBy("uid").agg(smallest("leader"))
        for _ in range(2):
            up = both.join(best, "uid").groupBy("leader").agg(smallest("root"))
            best = cut(both.join(up, "leader").groupBy("uid").agg(smallest("root")))
        return best

    def links(self) -> DataFrame:
        """``a, b``: enough links to connect every class of linked sets."""
        links = answers = roots = None
        n_rows, turn, useful = self.index.count(), 0, True
        while True:
            rows = self._open(roots) if roots is None else cut(self._open(roots))
            if roots is not None:
                per = rows.groupBy("token", "root").agg(F.count(F.lit(1)).cast("double").alias("k"))
                per = per.groupBy("token").agg(F.sum("k").alias("s"), F.sum(F.col("k") * F.col("k")).alias("q"))
                left = per.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()[0] or 0
                if left <= PAIRS_PER_ROW * n_rows or not useful:
                    break
            asked = self.leader_pairs(rows, turn)
            if answers is not None:  # connected sets whose roots differ would ask, and link, again and again
                both = [answers.select("a", "b"), answers.select(F.col("b").alias("a"), F.col("a").alias("b"))]
                asked = asked.join(_few(cut(both[0].unionByName(both[1]).distinct())), ["a", "b"], "left_anti")
            new_answers = cut(self.sketched(asked))
            new = cut(self.tested(self._promising(new_answers)))
            answers = new_answers if answers is None else answers.unionByName(new_answers)
            links = new if links is None else links.unionByName(new)
            useful = new.count() * LINKS_IN_PAIRS > new_answers.count()
            roots = self._classes_so_far(links)
            turn += 1
            release(self.docs.sparkSession)
        pairs = cut(self._promising(self.sketched(self._bounded(self.all_pairs(rows), answers, links))))
        links = cut(links.unionByName(self.tested(pairs)))
        release(self.docs.sparkSession)
        return links


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: ``id, text`` (hash), ``n_shingles, component_id, stays``.

    ``component_id`` is the smallest id reachable by links of ``100 * |a & b| >= percent * |a | b|``; of each
    component the row with that id ``stays``.
    """
    ship_package(docs.sparkSession)
    body = whole(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(body).alias("text"), body.alias("body"))
    join = _Join(keyed, size, percent)
    found = connected_components(join.links(), "a", "b").select(F.col("id").alias("rep"), F.col("component").alias("root"))
    rows = join.profiles.select("uid", "id", "text", "n", "digest").join(join.reps, "digest", "left")
    rows = rows.join(found, "rep", "left")
    # A set without links is its own root, an empty one is linked with nothing: its row stands alone.
    root = F.when(F.col("n") > 0, F.coalesce("root", "rep")).otherwise(F.col("uid"))
    rows = cut(rows.select("uid", "id", "text", "n", root.alias("root")))
    best = rows.groupBy("root").agg(F.min(F.struct("id", "uid")).alias("best"))
    return rows.join(best, "root").select(
        "id", "text", F.col("n").cast("long").alias("n_shingles"), F.col("best.id").alias("component_id"),
        (F.col("uid") == F.col("best.uid")).alias("stays"),
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each group."""
    groups = near_groups(docs, id_col, text_col, size, percent)
    stay = F.sum(F.col("stays").cast("int"))
    # Of equal rows one stays, but all of those without words, which are linked with nothing.
    n = F.when(stay == F.count(F.lit(1)), 1).otherwise(F.count(F.lit(1)))
    winners = groups.groupBy("id", "text").agg(n.alias("n"), stay.alias("stay")).where("stay > 0")
    return keep_rows(docs, winners, id_col, text_col)
