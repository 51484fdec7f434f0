"""Collocations by top-order marginalisation: only the longest windows are counted, shorter phrases are sums of them.

Texts are lower-cased (A-Z) and split into pieces and words.  Each word begins one window of ``longest`` words, taken from
columns of following words (the words of the piece shifted by one, two, ...) and padded with empty words at the end of a piece.  So every
occurrence of a phrase of any length is the beginning of exactly one window, and Spark's ROLLUP over (language, first word, second word, ...) gives the
frequency of all phrases and the number of words from the counts of the longest windows; no second n-gram explosion.

Windows are numbered and counted in Arrow tasks over stretches of 28 MB, which end with a piece, and leave them sorted (so they compress);
each becomes one row with its count.  These rows are shuffled once, by the window without its last word.  Before the ROLLUP, what can no
longer matter is folded level by level, from the last word on: a window in fewer places than ``least`` gives its count to the
window with its last word padded.  A phrase that reaches ``least`` keeps its full sum, since it adds what was folded into it and what stayed
longer; so the ROLLUP meets frequent phrases and one rest per word instead of all windows.

*Hot beginnings.*  A first pass finds every beginning with one window in a hundred or more: each stretch names those above one in two hundred of its
own, so what it leaves out sums to less than that.  The at most 200 found are spread over salts by their last word.  They are frequent for sure, so their
sum needn't be known when others are folded.  All later shuffles come after partial sums.  Frequencies of the parts of candidates come
back by equi-joins, which Spark splits where a word is hot.  The ranking goes by slices of a language first, and each hands on at most ``most``
rows.  Products are decimals of 38 digits, exact for counts below 10^13.

Defined results: a null text is empty, an empty text has no words; a null language is ``und`` (and so is one of that name); repeated
rows count as often as they occur; an empty table gives an empty result.  A long text is worked on in stretches; only a single piece has to fit
in memory.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, ship_package
from .arrays import buffer_of, fold, give_back

#: What ends a piece.  Words are separated by blanks and tabs.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"

LONGEST = 3
LEAST = 10
MOST = 2000
HIDING_PERCENT = 50
MILLION = 1_000_000
HOT_SHARE = 200
_SALTS = 64
_SLICES = 64
_STRETCH = 28 << 20
_STEP = 2 << 20
_ROWS = 100_000

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in PIECE_ENDS]] = True
_KIND = np.where(_ENDS, np.uint8(2), np.uint8(0))  # 0 in a word, 1 between words, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_FOLDED = fold(np.arange(256, dtype=np.uint8))


def _words(longest: int) -> list[str]:
    return [f"w{i + 1}" for i in range(longest)]


def _stretches(data: np.ndarray, starts: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``step`` bytes that end with a row or behind the end of a piece."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + step, n)
        if end < n:
            ends = np.flatnonzero(_ENDS[data[at:end]])
            best = max(int(starts[np.searchsorted(starts, end, "right") - 1]), at + int(ends[-1]) + 1 if len(ends) else 0)
            if best <= at:  # one piece is longer than a step
                row_end = int(starts[np.searchsorted(starts, end)])
                ends = np.flatnonzero(_ENDS[data[end:row_end]])
                best = end + int(ends[0]) + 1 if len(ends) else row_end
            end = best
        yield at, end
        at = end


def _keys(columns: list[np.ndarray]) -> np.ndarray:
    """One number for each row of the columns (none negative), in the order of the rows' values."""
    key, most = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        base = int(column.max(initial=0)) + 1
        if most * base >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            most = int(key.max(initial=0)) + 1
        key *= base
        key += column
        most *= base
    return key


def _spans(data: np.ndarray, row_starts: np.ndarray, a: int, b: int) -> tuple[np.ndarray, ...]:
    """Of the words in ``data[a:b]``: their starts and lengths, whether a piece ends behind each, and all their letters."""
    kind = _KIND[data[a:b]]
    solid = kind == 0
    flips = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    heads = row_starts[np.searchsorted(row_starts, a, "right") : np.searchsorted(row_starts, b)] - a
    between = np.unique(heads[solid[heads] & solid[heads - 1]])  # rows that meet inside letters
    bounds = np.concatenate([[0] if solid[0] else [], flips, between, between, [b - a] if solid[-1] else []]).astype(np.int32)
    bounds.sort()
    first, last = bounds[0::2], bounds[1::2]
    ended = np.zeros(0, bool)
    if len(first):
        ended = np.add.reduceat((kind == 2).view(np.int8), np.minimum(last, b - a - 1)) > 0
    return first + np.int32(a), last - first, ended, _FOLDED[data[a:b][solid]]


class _Numbered:
    """The windows of a stretch of text: numbers of their words (0 for padding) and of their languages.

    With ``in_order`` the numbers of words are in alphabetical order.
    """

    def __init__(self, data: np.ndarray, row_starts: np.ndarray, langs: np.ndarray, longest: int, in_order: bool):
        parts = [_spans(data, row_starts, a, b) for a, b in _stretches(data, row_starts, _STEP)]
        first, lengths, ended, letters = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, t) for t in (np.int32, np.int32, bool, np.uint8))
        del parts
        offsets = np.zeros(len(first) + 1, np.int32)
        np.cumsum(lengths, out=offsets[1:])
        words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        del lengths, letters, offsets
        number, names = words.indices.to_numpy() + np.int32(1), words.dictionary
        del words
        if in_order:
            order = pc.sort_indices(names).to_numpy().astype(np.int64)
            rank = np.zeros(len(order) + 1, np.int32)
            rank[order + 1] = np.arange(1, len(order) + 1)
            number, names = rank[number], names.take(pa.array(order))
        self.names = pa.concat_arrays([pa.array([""], names.type), names])
        row_words = np.searchsorted(first, row_starts)
        self.lang = np.repeat(langs, np.diff(row_words))
        self.columns = [number]
        if len(first):
            starts_piece = np.concatenate([[False], ended])
            starts_piece[row_words[1:-1]] = True
            piece = np.cumsum(starts_piece[:-1], dtype=np.int32)
        for k in range(1, longest):
            column = np.zeros(len(number), np.int32)
            if len(number) > k:
                here = piece[k:] == piece[:-k]
                column[:-k][here] = number[k:][here]
            self.columns.append(column)

    def frequent(self, n_columns: int, share: int) -> tuple[np.ndarray, np.ndarray]:
        """A place of each beginning of ``n_columns`` words with one in ``share`` windows or more, and their counts."""
        total = len(self.lang)
        some = np.arange(total)
        for column in self.columns[:n_columns]:  # all its words are as frequent, or more
            some = some[(np.bincount(column)[column[some]] * share) >= total]
        _, place, count = np.unique(_keys([c[some] for c in (self.lang, *self.columns[:n_columns])]), return_index=True, return_counts=True)
        enough = count * share >= total
        return some[place[enough]], count[enough]

    def counted(self, n_columns: int) -> tuple[np.ndarray, np.ndarray]:
        """A place of each different beginning of ``n_columns`` words, in order of language and words, and their counts."""
        key = _keys([self.lang, *self.columns[:n_columns]])
        place = np.argsort(key, kind="stable")
        key = key[place]
        place = place.astype(np.int32)
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return place[heads], np.diff(np.append(heads, len(key)))

    def begins_with(self, place: np.ndarray, langs: pa.Array, hot: list[tuple[str, ...]]) -> np.ndarray:
        """Which of the windows at ``place`` have one of the beginnings ``(lang, first words)``."""
        own = [c[place] for c in (self.lang, *self.columns[: len(hot[0]) - 1])]
        looked_up = [pc.index_in(pa.array(x, names.type), value_set=names).fill_null(-1) for x, names in zip(zip(*hot), [langs] + [self.names] * len(hot[0]))]
        sought = np.stack([x.to_numpy().astype(np.int64) for x in looked_up])
        sought = sought[:, (sought >= 0).all(axis=0)]
        key = _keys([np.concatenate(pair) for pair in zip(own, sought)])
        return np.isin(key[: len(place)], key[len(place) :])


def _numbered(batch: pa.RecordBatch, longest: int, in_order: bool = True) -> Iterator[tuple[_Numbered, pa.Array]]:
    """The windows of a batch of (lang, text), stretch by stretch, and the names of the languages."""
    langs = batch.column(0).fill_null("und").dictionary_encode()
    data, starts = buffer_of(batch.column(1))
    number = langs.indices.to_numpy()
    for a, b in _stretches(data, starts, _STRETCH):
        first, last = np.searchsorted(starts, a, "right") - 1, np.searchsorted(starts, b)
        inside = np.concatenate([[0], starts[first + 1 : last] - a, [b - a]])
        yield _Numbered(data[a:b], inside, number[first:last], longest, in_order), langs.dictionary


def _slim(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))


def hot_beginnings(slim: DataFrame, longest: int, least: int) -> list[tuple[str, ...]]:
    """``(lang, first words)`` of the windows' beginnings without the last word that have one in ``HOT_SHARE`` windows or more, in ``least`` places at least.

    Every beginning with twice that share is among them; there are ``HOT_SHARE`` at most.
    """
    words = _words(longest)[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, langs in _numbered(batch, longest, in_order=False):
                place, count = part.frequent(longest - 1, HOT_SHARE)
                total = len(part.lang)
                found = [langs.take(pa.array(part.lang[place])), *(part.names.take(pa.array(c[place])).cast(pa.string()) for c in part.columns[:-1])]
                yield pa.RecordBatch.from_arrays([*found, pa.array(count)], ["lang", *words, "f"])
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.string())] * (1 + len(words)) + [pa.array([total])], ["lang", *words, "f"])

    schema = ", ".join(f"{c} string" for c in ("lang", *words)) + ", f long"
    sums = cut(slim.mapInArrow(run, schema).groupBy("lang", *words).agg(F.sum("f").alias("f")))
    total = sums.where("lang IS NULL").agg(F.sum("f")).first()[0] or 0
    rows = sums.where(F.col("lang").isNotNull() & (F.col("f") * HOT_SHARE >= total) & (F.col("f") >= least)).collect()
    return [tuple(r[c] for c in ("lang", *words)) for r in rows]


def windows(slim: DataFrame, longest: int, hot: list[tuple[str, ...]]) -> DataFrame:
    """``beginning, last, f``: windows with their counts in a stretch of text; empty words beyond the end of a piece.

    The beginning is one string, which makes slim rows: all words but the last, with blanks between, a tab and the language.  Those in ``hot``
    have one more word, a salt that hangs on the last word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, langs in _numbered(batch, longest):
                place, count = part.counted(longest)
                salted = part.begins_with(place, langs, hot) if hot else np.zeros(len(place), bool)
                salts = {0: " 0"}
                for n in np.unique(part.columns[-1][place[salted]]).tolist():
                    salts[n] = f" {zlib.crc32(part.names[n].as_buffer()) % _SALTS}"
                for a in range(0, len(place), _ROWS):
                    some, extra = place[a : a + _ROWS], salted[a : a + _ROWS]
                    words = [part.names.take(pa.array(c[some])).cast(pa.string()) for c in part.columns]
                    tail = pa.array(np.full(len(some), "\t", object), pa.string())
                    if extra.any():
                        own = [salts[n] + "\t" if hit else "\t" for n, hit in zip(part.columns[-1][some].tolist(), extra.tolist())]
                        tail = pa.array(own, pa.string())
                    lang = langs.take(pa.array(part.lang[some])).cast(pa.string())
                    beginning = pc.binary_join_element_wise(*words[:-1], " ") if longest > 2 else words[0]
                    beginning = pc.binary_join_element_wise(beginning, tail, lang, "")
                    yield pa.RecordBatch.from_arrays([beginning, words[-1], pa.array(count[a : a + _ROWS])], ["beginning", "last", "f"])
                del part, place, count, salted
                give_back()

    return slim.mapInArrow(run, "beginning string, last string, f long")


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, w1 .. wL, f, level`` for the phrases (empty words at the end) in at least ``least`` places, and the number of words (level 0) of each language."""
    words = _words(longest)
    slim = _slim(docs, text_col, lang_col)
    placed = windows(slim, longest, hot_beginnings(slim, longest, least)).repartition("beginning")
    # From here to the end of the first fold all sums stay in their partition.
    counts = placed.groupBy("beginning", "last").agg(F.sum("f").alias("f")).withColumn("stays", F.lit(False))
    counts = _fold(counts, ["beginning", "last"], 2, least, [])
    tab = F.instr("beginning", "\t")
    parts = F.split(F.substring(F.col("beginning"), F.lit(1), tab - 1), " ")
    counts = counts.select(
        F.substring(F.col("beginning"), tab + 1, F.length("beginning")).alias("lang"),
        *[F.get(parts, F.lit(i)).alias(w) for i, w in enumerate(words[:-1])], F.col("last").alias(words[-1]), "f",
        (F.col("stays") | (F.size(parts) == longest)).alias("stays"),  # hot beginnings are frequent
    )
    for k in range(longest - 1, 1, -1):
        counts = _fold(counts, words, k, least, ["lang"])
    levels = counts.select("lang", *words, "f").rollup("lang", *words).agg(F.sum("f").alias("f"), F.grouping_id().alias("gid"))
    # A grouping id has a bit for each column that was summed over; the language itself is the highest bit.
    level = F.lit(longest) - F.round(F.log2(F.col("gid") + 1)).cast("int")
    out = levels.where(F.col("gid") < (1 << longest)).withColumn("level", level)
    out = out.select("lang", *[F.coalesce(w, F.lit("")).alias(w) for w in words], "f", "level")
    padded = F.lit(False)
    for k, w in enumerate(words, 1):
        padded = padded | ((F.col("level") == k) & (F.col(w) == ""))  # sums of windows that end before this level
    return out.where(~padded & ((F.col("level") == 0) | (F.col("f") >= least)))


def _fold(counts: DataFrame, words: list[str], k: int, least: int, beside: list[str]) -> DataFrame:
    """Windows of ``k`` words in fewer than ``least`` places become windows of ``k - 1`` words; those of ``k`` that stay keep their beginning.

    ``stays``: a longer window of this beginning has stayed, so this one must stay, too, for the sum of the beginning to be whole.
    """
    here = F.col(words[k - 1]) != ""
    longer = F.lit(False) if k == len(words) else F.col(words[k]) != ""
    stays = longer | F.col("stays") | (F.col("f") >= least)
    kept, tail = words[: k - 1], words[k - 1 :]
    cut_off = F.struct(*[F.lit("").alias(w) for w in tail], F.when(stays, F.lit(0)).otherwise(F.col("f")).cast("long").alias("f"), stays.alias("stays"))
    whole_row = F.struct(*[F.col(w) for w in tail], F.col("f"), F.col("stays"))
    rows = F.when(~here, F.array(whole_row)).when(stays, F.array(whole_row, cut_off)).otherwise(F.array(cut_off))
    folded = counts.select(*beside, *kept, F.inline(rows))
    return folded.groupBy(*beside, *words).agg(F.sum("f").alias("f"), F.max("stays").alias("stays"))


def _exact_ratio(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))`` with 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (F.lit(MILLION).cast("decimal(7,0)") * wide(a)).cast("decimal(19,0)") * wide(a)
    return F.call_function("div", top, wide(left) * wide(right))


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    most: int = MOST,
    hiding_percent: int = HIDING_PERCENT,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``most`` phrases of 2 to ``longest`` words of each language."""
    words = _words(longest)
    known = cut(phrase_counts(docs, longest, least, text_col, lang_col))
    name = lambda part: F.concat_ws(" ", *[F.nullif(F.col(w), F.lit("")) for w in part])
    named = known.select("lang", name(words).alias("phrase"), "f", "level", *words)
    totals = named.where("level = 0").select("lang", F.col("f").alias("n"))
    parts = named.where("level > 0").select("lang", "phrase", "f")
    phrases = named.where("level > 1")
    scored = None
    for size in range(2, longest + 1):
        own = phrases.where(F.col("level") == size).select("lang", "phrase", F.col("f").alias("a"), F.lit(size).alias("size"), *words)
        for k in range(1, size):
            one = own.select("lang", "phrase", "a", "size", F.lit(k).alias("k"), name(words[:k]).alias("left"), name(words[k:size]).alias("right"))
            scored = one if scored is None else scored.unionByName(one)
    scored = scored.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    scored = scored.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    scored = scored.withColumn("score", _exact_ratio(F.col("a"), F.col("l"), F.col("r")))
    lowest = F.min_by(F.struct("score", "l", "r"), F.struct("score", "k")).alias("s")
    scored = scored.groupBy("lang", "phrase", "size").agg(F.first("a").alias("a"), lowest)
    # The longest frequency of a candidate around each shorter phrase
    around = None
    for size in range(3, longest + 1):
        own = phrases.where(F.col("level") == size)
        for inner in range(2, size):
            for at in range(size - inner + 1):
                one = own.select("lang", name(words[at : at + inner]).alias("phrase"), F.col("f").alias("longer"))
                around = one if around is None else around.unionByName(one)
    if around is not None:
        around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        hidden = F.coalesce(100 * F.col("longer") >= hiding_percent * F.col("a"), F.lit(False))
        scored = scored.join(around, ["lang", "phrase"], "left").where(~hidden)
    order = [F.desc("s.score"), F.desc("a"), F.asc("phrase")]
    slice_no = F.pmod(F.xxhash64("phrase"), F.lit(_SLICES))
    first = scored.withColumn("slice", slice_no).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
    last = first.where(F.col("rank") <= most).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return last.where(F.col("rank") <= most).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "n", F.col("s.score").alias("score")
    )
