"""Packing token streams into windows by sum of squares.

A document is cut into full windows and a rest.  The rest goes to the fill level that minimises the sum of squared counts of
partially filled windows: an array counts the windows at each level, and a rest of ``s`` tokens moves one window from level ``h`` to
``h + s``, or opens one.  Each task packs the documents it reads, as they come; nothing is shuffled, and a lost task is
packed anew as a whole.

At the end of a task, or beyond ``MOST_OPEN`` open windows, the open windows are poured into each other, cutting a piece where a
window is full.  What then remains of the last one is cut into windows with powers of two, which need no padding.  So a task
pads nothing, and a document is cut only if it is longer than a window or was poured.

Words are tokenized once and remembered (about twice ``MOST_WORDS`` at most): the vocabulary drops white space, so that the
tokens of a text are those of its words.

Defined results: a null or empty text has the end token only; repeated rows and ids are packed one by one; an empty table gives an empty
result.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .arrays import give_back

WINDOW = 2048
END_ID = 1
MOST_OPEN = 4096
MOST_WORDS = 600_000
LONG_WORD = 64
TOGETHER = 500
PLAIN = "\u0250"  # letters below are single code points with simple lower case
ROWS_OUT = 2000


class WordTokenizer:
    """Token ids of a text as little-endian 32-bit bytes, from remembered words.

    A word of letters is remembered in lower case, and one mark behind it apart from it: the vocabulary lower-cases, and
    never joins letters and marks.  Words of the letters below ``PLAIN`` need no further normalising and are one unit each, so they
    are tokenized many at a time, split at the space; each ends with a token of a word end.  Should the number of ends not
    agree, and for all other words, the whole tokenizer is asked.  Two generations of remembered words are kept, so that
    frequent ones survive.
    """

    def __init__(self, definition: str, most_words: int = MOST_WORDS):
        self.most_words = most_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._tokenizer = Tokenizer.from_str(definition)
        self._ascii, self._latin = Tokenizer.from_str(definition), Tokenizer.from_str(definition)
        at_space = pre_tokenizers.Split(" ", "removed")
        self._ascii.normalizer = self._latin.normalizer = normalizers.Sequence([])
        self._ascii.pre_tokenizer = at_space
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._latin.pre_tokenizer = pre_tokenizers.Sequence([at_space, byte_level])
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._marks = {mark: self._one(mark) for mark in ",."}

    def _one(self, word: str) -> bytes:
        return np.array(self._tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, tokenizer, words: list[str]) -> Iterator[bytes]:
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        encoded = tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, encoded, strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) == len(group):
                data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                yield from [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            else:
                yield from map(self._one, group)

    def _learn(self, words: set[str]) -> None:
        known, older, marks = self._known, self._older, self._marks
        ascii_words, latin_words, made = set(), set(), []
        for word in words:
            if word in older:
                known[word] = older[word]
                continue
            mark = word[-1:]
            base = word[:-1] if mark in marks else word
            if not base.isalpha():
                known[word] = self._one(word)
                continue
            lower = base.lower()
            if lower in older:
                known[lower] = older[lower]
            elif lower not in known:
                if lower.isascii():
                    ascii_words.add(lower)
                elif max(base) < PLAIN and lower.isalpha():
                    latin_words.add(lower)
                else:
                    known[word] = self._one(word)
                    continue
            if lower != word:
                made.append((word, lower, mark if base is not word else ""))
        for tokenizer, some in ((self._ascii, list(ascii_words)), (self._latin, list(latin_words))):
            known.update(zip(some, self._together(tokenizer, some), strict=True))
        for word, lower, mark in made:
            known[word] = known[lower] + marks[mark] if mark else known[lower]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self._known) > self.most_words:
            self._known, self._older = {}, {w: i for w, i in self._known.items() if len(w) <= LONG_WORD}
        self._learn(set().union(*split).difference(self._known))
        return [b"".join(map(self._known.__getitem__, words)) for words in split]


_TOKENIZERS: dict[tuple[int, int], WordTokenizer] = {}


def _tokenizer(definition: str, most_words: int) -> WordTokenizer:
    """One tokenizer per worker process, which serves many tasks."""
    key = hash(definition), most_words
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = WordTokenizer(definition, most_words)
    return _TOKENIZERS[key]


class SquaresPacker:
    """Windows by sum of squares.  A piece is ``(document, first token, bytes)``; ``full`` gets finished windows."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.window, self.most_open = window, most_open
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[tuple]]] = defaultdict(list)
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level to put ``size`` tokens on; 0 is a new window.  Of equal levels the fullest."""
        levels = np.flatnonzero(self.counts[1 : self.window - size + 1]) + 1
        if not len(levels):
            return 0
        after = self.counts[levels + size]
        after[levels + size == self.window] = 0
        change = 2 * after + 1 - 2 * self.counts[levels] + 1
        change[levels + size == self.window] -= 1  # a finished window counts no more
        best = len(levels) - 1 - int(np.argmin(change[::-1]))
        return int(levels[best]) if change[best] <= 2 * self.counts[size] + 1 else 0

    def add(self, doc: int, ids: bytes) -> Iterator[list[tuple]]:
        width = 4 * self.window
        whole = len(ids) // width * width
        for at in range(0, whole, width):
            yield [(doc, at // 4, ids[at : at + width])]
        size = (len(ids) - whole) // 4
        if not size:
            return
        level = self.level_for(size)
        window = self.open[level].pop() if level else []
        window.append((doc, whole // 4, ids[whole:]))
        if level:
            self.counts[level] -= 1
            self.n_open -= 1
        if level + size == self.window:
            yield window
            return
        self.open[level + size].append(window)
        self.counts[level + size] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            yield from self.pour()

    def pour(self) -> Iterator[list[tuple]]:
        """Full windows from all open ones, and the remainder in windows of powers of two."""
        pieces = [p for level in sorted(self.open, reverse=True) for window in self.open[level] for p in window]
        self.open.clear()
        self.counts[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) for p in pieces) // 4
        room, window = self._room(left), []
        for doc, start, ids in pieces:
            while ids:
                part = ids[: 4 * room]
                window.append((doc, start, part))
                ids, start = ids[len(part) :], start + len(part) // 4
                room -= len(part) // 4
                left -= len(part) // 4
                if not room:
                    yield window
                    room, window = self._room(left), []

    def _room(self, left: int) -> int:
        return self.window if left >= self.window else 1 << max(0, left.bit_length() - 1)


def _packed(definition, id_col: str, text_col: str, window: int, end_id: int, id_type, most_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(definition.value, most_words)
        packer = SquaresPacker(window)
        end = np.array([end_id], "<u4").tobytes()
        base, n_windows = TaskContext.get().partitionId() << 40, 0
        rows: list[tuple] = []

        def number(windows: Iterator[list[tuple]]) -> None:
            nonlocal n_windows
            for pieces in windows:
                offset = 0
                for (name, tokens), start, ids in pieces:
                    rows.append((name, start, len(ids) // 4, ids, tokens, base + n_windows, offset))
                    offset += len(ids) // 4
                n_windows += 1

        def batch_out() -> pa.RecordBatch:
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                texts = [t or "" for t in some.column(text_col).to_pylist()]
                for name, ids in zip(some.column(id_col).to_pylist(), tokenizer.encode(texts), strict=True):
                    ids += end
                    number(packer.add((name, len(ids) // 4), ids))
                    if len(rows) >= ROWS_OUT:
                        yield batch_out()
            give_back()
        number(packer.pour())
        if rows:
            yield batch_out()

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit token ids; ``start`` counts the document's tokens before the piece, ``offset`` the
    window's.  A worker remembers up to twice ``most_words`` words, about 200 bytes each.  The tokenizer file, a few MB, is read by the driver and broadcast.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType
    run = _packed(definition, id_col, text_col, window, end_id, to_arrow_type(kind), most_words)
    schema = f"`{id_col}` {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.select(id_col, F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, schema)
