"""Toxicity by two class-conditional Kneser-Ney models.

A model gives the likelihood of a document's words, letter by letter, each letter from up to five before it.  On top are
counts of documents for each class; they back off to counts of both classes together, and these to shared continuation
counts of lower orders.  So an expression that one class has rarely or never seen has the same probability in both and speaks for
neither.  What is left of chance, and of the languages' and topics' unequal parts in the classes, is small for each word:
differences of up to ``tau`` count as none.  A document is judged by the sum of its words' differences, normalised by its length;
a logistic curve, fitted on differences from models that haven't seen the document, turns it into a score, and the best
``tau`` is chosen in the same way.

Fitting takes all labelled documents that aren't held out for the classes' counts, and all documents for the continuation counts.
Spark counts the letter n-grams and works out their probabilities, order by order; the driver gets the n-grams that count for a
class, with their differences.  Only the curve and the choice of ``tau`` rest on a sample, of at most ``TRAIN_PER_CLASS`` documents of
each class (those with the smallest hash of the id).  Scoring covers every whole text of any number of documents in one pass without
a shuffle; the model, 12 bytes for an n-gram that counts for a class, is broadcast.

Defined results: empty and null texts have no words and score what the curve gives at 0, at most 0.49; documents without an id are not held out; repeated
rows are scored one by one; without labels of both classes every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship_package
from .arrays import give_back, mix
from .common import whole

ORDER = 6
FOLDS = 3
TRAIN_PER_CLASS = 1000  # documents that the curve is fitted on; the models count all
TAUS = (2.0, 3.0, 4.0)
CLASS_DISCOUNT = 2.0  # an n-gram must be in more documents of a class to count for it
LONGEST = 24  # letters handled together; longer words are cut into such parts
MOST_WORDS = 100_000  # gathered before they are counted
MOST_SEEN = 300_000  # remembered while scoring
ALPHABET = 1000.0
LETTERS = re.compile(r"[^\W\d_]+")
_EDGES = string.punctuation + string.digits
WORDS_AT_ONCE = 50_000
BROADCAST_ROWS = 500_000
_START, _END = 1, 2
_BITS = 21  # of a letter; an n-gram is two numbers of three letters each, the predicted letter last
_LETTER = (1 << _BITS) - 1
_BASE = np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the id's checksum puts a row among those that no label may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in rows, behind ``ORDER - 1`` start marks and before an end mark, and which places are to be predicted."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max(initial=0)) + ORDER
    grid = np.zeros((len(words), width), np.uint32)
    grid[:, : ORDER - 1] = _START
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + ORDER - 1
    grid[row, column] = flat + np.uint32(3)
    grid[np.arange(len(words)), lengths + ORDER - 1] = _END
    places = np.arange(ORDER - 1, width)[None, :] <= (lengths + ORDER - 1)[:, None]
    return grid, places


def _gram(grid: np.ndarray, places: np.ndarray, first: int, last: int) -> np.ndarray:
    """Hash of the letters from ``first`` to ``last`` places before each predicted place."""
    return _hash(lambda back: _letter(grid, places, back), int(places.sum()), first, last)


def _letter(grid: np.ndarray, places: np.ndarray, back: int) -> np.ndarray:
    return grid[:, ORDER - 1 - back : grid.shape[1] - back][places].astype(np.uint64)


def _hash(letter: Callable[[int], np.ndarray], n: int, first: int, last: int) -> np.ndarray:
    out = np.full(n, np.uint64(first * 16 + last), np.uint64)
    for back in range(first, last - 1, -1):
        out = mix(out * _BASE + letter(back))
    return out


def _unpacked(older: np.ndarray, newer: np.ndarray, last: int) -> np.ndarray:
    """The hash that ``_gram`` gives to packed letters, from the oldest to ``last`` places before the predicted one."""
    halves = newer.astype(np.uint64), older.astype(np.uint64)
    return _hash(lambda back: halves[back // 3] >> np.uint64(back % 3 * _BITS) & np.uint64(_LETTER), len(older), ORDER - 1, last)


@dataclass
class Table:
    """Values by hash; ``empty`` for hashes it doesn't have."""

    keys: np.ndarray
    values: np.ndarray
    empty: float

    def get(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), self.empty)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], self.empty)


def _tables(gram: np.ndarray, context: np.ndarray, counts: np.ndarray, discount: float = 0.0) -> tuple[Table, Table]:
    """Discounted probability of each n-gram, and what its context leaves to the lower order."""
    seen = counts > 0
    gram, context, counts = gram[seen], context[seen], counts[seen]
    if not discount:
        ones, twos = float((counts == 1).sum()), float((counts == 2).sum())
        discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
    kinds, at = np.unique(context, return_inverse=True)
    totals = np.bincount(at, weights=counts, minlength=len(kinds))
    left = np.bincount(at, weights=np.minimum(counts, discount), minlength=len(kinds)) / np.maximum(totals, 1e-300)
    order = np.argsort(gram)
    share = (np.maximum(counts - discount, 0) / np.maximum(totals[at], 1e-300))[order]
    some, told = share > 0, left < 1  # all others are as good as unseen
    return Table(gram[order][some], share[some].astype(np.float32), 0.0), Table(kinds[told], left[told].astype(np.float32), 1.0)


@dataclass
class KneserNey:
    """Both models: shared tables for the lower orders, one pair of tables for each class on top."""

    lower: list[tuple[Table, Table]] = field(default_factory=list)
    top: list[tuple[Table, Table]] = field(default_factory=list)

    @classmethod
    def fit(cls, words: list[str], counts: np.ndarray) -> KneserNey:
        """``counts`` has a row for each class (ordinary, toxic) and a column for each word."""
        model = cls()
        grid, places = _letters(words)
        gram = _gram(grid, places, 0, 0)
        for m in range(1, ORDER):  # two orders at a time, to keep the driver's memory low
            longer = _gram(grid, places, m, 0)
            one = np.unique(longer, return_index=True)[1]  # one place for each distinct n-gram of the next order
            kinds, first, n = np.unique(gram[one], return_index=True, return_counts=True)
            model.lower.append(_tables(kinds, _gram(grid, places, m - 1, 1)[one][first], n.astype(float)))
            gram = longer
        context = _gram(grid, places, ORDER - 1, 1)
        row = np.broadcast_to(np.arange(len(words), dtype=np.int32)[:, None], places.shape)[places]
        kinds, first, at = np.unique(gram, return_index=True, return_inverse=True)
        context = context[first]
        own = [np.bincount(at, weights=counts[c][row], minlength=len(kinds)) for c in range(2)]
        # Together each class counts for half, whatever the numbers of its documents.
        both = sum(n * (counts.sum() / 2 / max(1.0, counts[c].sum())) for c, n in enumerate(own))
        model.lower.append(_tables(kinds, context, both))
        model.top.extend(_tables(kinds, context, n, CLASS_DISCOUNT) for n in own)
        return model

    def probabilities(self, grid: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of the letter at each predicted place in an ordinary and in a toxic document."""
        p = np.full(int(places.sum()), 1 / ALPHABET)
        for m, (share, left) in enumerate(self.lower, 1):
            p = share.get(_gram(grid, places, m - 1, 0)) + left.get(_gram(grid, places, m - 1, 1)) * p
        gram, context = _gram(grid, places, ORDER - 1, 0), _gram(grid, places, ORDER - 1, 1)
        ordinary, toxic = (share.get(gram) + left.get(context) * p for share, left in self.top)
        return ordinary, toxic


@dataclass
class Differences:
    """What scoring needs of both models: the difference of the logarithms of a letter's two probabilities.

    An n-gram that counts for neither class has the same shared probability in both, times what its context leaves in each;
    so only n-grams that count for a class, and the contexts they have, need an entry.
    """

    grams: Table
    contexts: Table

    @classmethod
    def fit(cls, words: list[str], counts: np.ndarray) -> Differences:
        model = KneserNey.fit(words, counts)
        grid, places = _letters(words)
        gram = _gram(grid, places, ORDER - 1, 0)
        known = np.union1d(model.top[0][0].keys, model.top[1][0].keys)
        keys, one = np.unique(gram, return_index=True)
        at = one[np.isin(keys, known)]
        some = np.zeros_like(places)
        some.reshape(-1)[np.flatnonzero(places)[at]] = True  # one place for each n-gram
        ordinary, toxic = model.probabilities(grid, some)
        gram = _gram(grid, some, ORDER - 1, 0)
        order = np.argsort(gram)
        value = (np.log(toxic) - np.log(ordinary)).astype(np.float32)
        contexts = np.union1d(model.top[0][1].keys, model.top[1][1].keys)
        left = [np.log(t[1].get(contexts)) for t in model.top]
        return cls(Table(gram[order], value[order], np.nan), Table(contexts, (left[1] - left[0]).astype(np.float32), 0.0))

    def of(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word as toxic minus that as ordinary."""
        if not words:
            return np.zeros(0)
        grid, places = _letters(words)
        value = self.grams.get(_gram(grid, places, ORDER - 1, 0))
        value = np.where(np.isnan(value), self.contexts.get(_gram(grid, places, ORDER - 1, 1)), value)
        out = np.zeros(places.shape)
        out[places] = value
        return out.sum(axis=1)


def _parts(token: str) -> list[str]:
    """The runs of letters of a token, in parts of at most ``LONGEST``."""
    return [w[i : i + LONGEST] for w in LETTERS.findall(token) for i in range(0, len(w), LONGEST)]


def _words(token: str) -> list[str]:
    bare = token.strip(_EDGES)  # mostly a word with punctuation
    return [bare] if len(bare) <= LONGEST and bare.isalpha() else _parts(token)


class Scorer:
    """Sums of word differences in documents, for each ``tau``; remembers which tokens say something, and which it has seen."""

    def __init__(self, differences, taus: Sequence[float]):
        self.differences, self.taus = differences, taus
        self.tokens: dict[str, np.ndarray] = {}  # those with a difference beyond a tau
        self.seen: set[str] = set()

    def _learn(self, tokens: set[str]) -> None:
        if len(self.seen) > MOST_SEEN:
            self.seen.clear()
            self.tokens.clear()
        fresh = tokens.difference(self.seen)
        self.seen |= fresh
        split = {t: parts for t in fresh if (parts := _words(t)) != [t]}
        new = list(fresh.difference(split).union(*split.values()))
        loud: dict[str, np.ndarray] = {}
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            found = self.differences(part)
            beyond = np.stack([np.maximum(0.0, found - t) - np.maximum(0.0, -found - t) for t in self.taus], axis=1)
            for k in np.flatnonzero(beyond.any(axis=1)).tolist():
                loud[part[k]] = beyond[k]
        for token in loud.keys() & fresh - split.keys():
            self.tokens[token] = loud[token]
        for token, parts in split.items():
            values = [loud[p] for p in parts if p in loud]
            if values and (total := sum(values)).any():
                self.tokens[token] = total

    def features(self, texts: list[str]) -> np.ndarray:
        """Per tau and document the sum by the number of words, by its square root, and by its logarithm."""
        split = [t.lower().split() for t in texts]
        self._learn(set().union(*split))
        sums = np.zeros((len(self.taus), len(texts)))
        for i, words in enumerate(split):
            for values in [self.tokens[w] for w in words if w in self.tokens]:
                sums[:, i] += values
        n = np.maximum(1, np.array([len(words) for words in split], float))
        return np.stack([sums / n, sums / np.sqrt(n), sums / np.log1p(n)], axis=2)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and constant by Newton's method, and the loss; columns are scaled, each class has half of the weight."""
    scale = np.maximum(np.abs(x).mean(axis=0), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hessian, a.T @ (weight * (p - y)) + penalty * w)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
    loss = -float((weight * np.log(np.where(y == 1, p, 1 - p) + 1e-12)).sum())
    return np.append(w[:-1] / scale, w[-1]), loss


@dataclass
class Toxicity:
    """A fitted model; ``model`` is None if only one class was seen."""

    model: Differences | None
    tau: float
    curve: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve[:-1] + self.curve[-1], -30, 30)))


_GROUPS = [f"n{fold}{c}" for fold in range(FOLDS) for c in range(2)]


def _packed_grams(words: list[str], counts: np.ndarray) -> list[np.ndarray]:
    """Distinct n-grams of the words as ``older, newer`` letters, and their counts by group."""
    grid, places = _letters(words)
    newer, older = (
        sum(_letter(grid, places, at + i) << np.uint64(i * _BITS) for i in range(3)).astype(np.int64) for at in (0, 3)
    )
    row = np.broadcast_to(np.arange(len(words), dtype=np.int32)[:, None], places.shape)[places]
    order = np.lexsort((newer, older))
    newer, older = newer[order], older[order]
    first = np.flatnonzero(np.append(True, (newer[1:] != newer[:-1]) | (older[1:] != older[:-1])))
    return [older[first], newer[first], *(np.add.reduceat(n[row][order], first) for n in counts)]


def _gram_counts(rows: DataFrame) -> DataFrame:
    """``older, newer`` and the number of documents and words with that n-gram for each fold and class, of ``fold, toxic, body``.

    Rows without a class add their n-grams with counts of 0.
    """

    def flushed(found: list[dict[str, int]], others: set[str]) -> Iterator[pa.RecordBatch]:
        words = list({p for t in others for p in _words(t)}.union(*found))
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at : at + WORDS_AT_ONCE]
            counts = np.array([[f.get(w, 0) for w in part] for f in found], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _packed_grams(part, counts)], names=["older", "newer", *_GROUPS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict[str, int]] = [Counter() for _ in _GROUPS]
        others: set[str] = set()  # tokens that only tell of continuations
        parts: dict[str, list[str]] = {}
        for batch in batches:
            for fold, toxic, text in zip(*(batch.column(c) for c in ("fold", "toxic", "body")), strict=True):
                tokens = set(text.as_py().lower().split())
                if toxic.is_valid:
                    parts.update((t, _words(t)) for t in tokens.difference(parts))
                    found[fold.as_py() * 2 + toxic.as_py()].update(set(chain.from_iterable(map(parts.__getitem__, tokens))))
                else:
                    others |= tokens
                if len(parts) + len(others) > MOST_WORDS:
                    yield from flushed(found, others)
                    for kept in (*found, others, parts):
                        kept.clear()
        yield from flushed(found, others)
        for kept in (*found, others, parts):
            kept.clear()
        give_back()

    kinds = ", ".join(f"{c} long" for c in ("older", "newer", *_GROUPS))
    return rows.mapInArrow(run, kinds).groupBy("older", "newer").agg(*[F.sum(c).alias(c) for c in _GROUPS])


def _without_oldest(m: int) -> list[Column]:
    """Packed letters of an n-gram without all but its ``m`` newest letters."""
    older, newer = (1 << _BITS * max(0, m - 3)) - 1, (1 << _BITS * min(3, m)) - 1
    return [F.col("older").bitwiseAND(older).alias("older"), F.col("newer").bitwiseAND(newer).alias("newer")]


def _looked_up(grams: DataFrame, table: DataFrame, rows: int) -> DataFrame:
    """``grams`` with the columns of ``table``, which has a row for each ``older`` and ``newer`` of theirs."""
    return grams.join(F.broadcast(table) if rows <= BROADCAST_ROWS else table, ["older", "newer"])


def _with_contexts(grams: DataFrame, sums: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``grams`` with ``context`` and sums over all n-grams of that context, and the contexts alone."""
    grams = grams.withColumn("context", F.col("newer").bitwiseAND(~_LETTER))
    contexts = grams.groupBy("older", "context").agg(*[F.sum(c).cast("double").alias(name) for name, c in sums.items()])
    return grams.join(contexts, ["older", "context"]), contexts


def _discount(ones: float, twos: float) -> float:
    return min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5


def _lower_orders(grams: DataFrame) -> tuple[DataFrame, int]:
    """``older, newer, p``: probabilities by continuation counts of all n-grams a letter shorter, and their number."""
    kinds = []
    for m in range(ORDER - 1, 0, -1):
        grams = cut(grams.select(*_without_oldest(m)).groupBy("older", "newer").agg(F.count(F.lit(1)).alias("n")))
        kinds.append(grams)
    known, rows = None, 0
    for m, grams in enumerate(reversed(kinds), 1):
        size, ones, twos = grams.agg(F.count(F.lit(1)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
        d = _discount(float(ones), float(twos))
        grams, _ = _with_contexts(grams, {"total": F.col("n"), "left": F.least(F.col("n"), F.lit(d))})
        if known is None:
            grams = grams.withColumn("p", F.lit(1 / ALPHABET))
        else:
            grams = grams.withColumns({"full_older": F.col("older"), "full_newer": F.col("newer")})
            grams = _looked_up(grams.withColumns(dict(zip(("older", "newer"), _without_oldest(m - 1), strict=True))), known, rows)
            grams = grams.withColumns({"older": F.col("full_older"), "newer": F.col("full_newer")})
        p = (F.greatest(F.col("n") - d, F.lit(0.0)) + F.col("left") * F.col("p")) / F.col("total")
        known, rows = cut(grams.select("older", "newer", p.alias("p"))), size
    return known, rows


def _gathered(rows: DataFrame) -> tuple[list[Differences], list[float]]:
    """Differences of the models of all folds, and of those without each fold; and the number of words in each class.

    ``rows`` has ``fold, toxic, body``, without a class those that only tell of continuations.
    """
    grams = cut(_gram_counts(rows))
    first = sum(_START << i * _BITS for i in range(3))  # each word has one n-gram of its first letter alone
    of_word = (F.col("older") == first) & (F.col("newer").bitwiseAND(~_LETTER) == first & ~_LETTER)
    sums = grams.where(of_word).agg(*[F.sum(c).alias(c) for c in _GROUPS]).first()
    by_group = np.array([sums[c] or 0 for c in _GROUPS], float).reshape(FOLDS, 2)
    totals = by_group.sum(axis=0)
    if not totals.all():
        return [], totals.tolist()
    left_out = [None, *range(FOLDS)]
    counts, sizes = {}, []
    for v, fold in enumerate(left_out):
        folds = [f for f in range(FOLDS) if f != fold]
        words = [by_group[folds, c].sum() for c in range(2)]
        own = [sum((F.col(f"n{f}{c}") for f in folds), F.lit(0)).cast("double") for c in range(2)]
        both = own[0] * F.lit(sum(words) / 2 / max(1.0, words[0])) + own[1] * F.lit(sum(words) / 2 / max(1.0, words[1]))
        counts |= {f"o{v}": own[0], f"t{v}": own[1], f"b{v}": both}
        sizes.append(v)
    top = grams.where(sum((F.col(c) for c in _GROUPS), F.lit(0)) > 0).select("older", "newer", *[c.alias(k) for k, c in counts.items()])
    told = top.agg(*[F.count_if(F.col(f"b{v}") == n).alias(f"x{v}{n}") for v in sizes for n in (1, 2)]).first()
    discounts = {f"b{v}": _discount(float(told[f"x{v}1"]), float(told[f"x{v}2"])) for v in sizes}
    discounts |= {f"{k}{v}": CLASS_DISCOUNT for v in sizes for k in "ot"}
    sums = {f"total_{k}": F.col(k) for k in discounts} | {f"left_{k}": F.least(F.col(k), F.lit(d)) for k, d in discounts.items()}
    top, contexts = _with_contexts(top, sums)

    def left(k: str) -> Column:
        return F.when(F.col(f"total_{k}") > 0, F.col(f"left_{k}") / F.col(f"total_{k}")).otherwise(1.0)

    def after(k: str, p: Column) -> Column:
        share = F.when(F.col(f"total_{k}") > 0, F.greatest(F.col(k) - discounts[k], F.lit(0.0)) / F.col(f"total_{k}")).otherwise(0.0)
        return share + left(k) * p

    def counting(v: int) -> Column:
        return (F.col(f"o{v}") > CLASS_DISCOUNT) | (F.col(f"t{v}") > CLASS_DISCOUNT)

    lower, size = _lower_orders(grams)
    top = top.where(counting(0)).withColumns({"full_older": F.col("older"), "full_newer": F.col("newer")})
    top = _looked_up(top.withColumns(dict(zip(("older", "newer"), _without_oldest(ORDER - 1), strict=True))), lower, size)
    values = []
    for v in sizes:
        p = after(f"b{v}", F.col("p"))
        values.append(F.when(counting(v), F.log(after(f"t{v}", p)) - F.log(after(f"o{v}", p))).cast("float").alias(f"d{v}"))
    found = top.select(F.col("full_older").alias("older"), F.col("full_newer").alias("newer"), *values).toArrow()
    some = (left("o0") < 1) | (left("t0") < 1)
    lefts = [(F.log(left(f"t{v}")) - F.log(left(f"o{v}"))).cast("float").alias(f"d{v}") for v in sizes]
    ends = contexts.where(some).select("older", F.col("context").alias("newer"), *lefts).toArrow()

    def table(of: pa.Table, last: int, v: int, empty: float) -> Table:
        keys = _unpacked(of.column("older").to_numpy(), of.column("newer").to_numpy(), last)
        value = of.column(f"d{v}").to_numpy().astype(np.float32)
        have = np.flatnonzero(~np.isnan(value))
        order = have[np.argsort(keys[have])]
        return Table(keys[order], value[order], empty)

    return [Differences(table(found, 0, v, np.nan), table(ends, 1, v, 0.0)) for v in sizes], totals.tolist()


def _usable(labels: DataFrame, id_col: str) -> DataFrame:
    """``id, toxic`` of labels that may be learnt from.  A repeated label counts once, contradicting ones not at all."""
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("hi"))
    return rows.where("toxic = hi").drop("hi")


def _distinct_texts(rows: DataFrame) -> DataFrame:
    return rows.select(F.pmod(F.xxhash64("body"), F.lit(FOLDS)).cast("int").alias("fold"), "toxic", "body").distinct()


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = TRAIN_PER_CLASS
) -> Toxicity:
    """Fit on labelled rows that aren't held out; ``labels`` has ``id_col`` and ``toxic`` (0 or 1)."""
    spark = docs.sparkSession
    ship_package(spark)
    known = _usable(labels, id_col)
    named = docs.select(F.col(id_col).alias("id"), whole(F.col(text_col)).alias("body"))
    if known.count() <= BROADCAST_ROWS:
        labelled, others = named.join(F.broadcast(known), "id"), named.join(F.broadcast(known), "id", "left_anti")
    else:  # texts are shuffled once; that the others' n-grams come twice adds counts of 0
        labelled, others = named.join(known, "id"), named
    none = F.lit(None).cast("int")
    models, totals = _gathered(_distinct_texts(labelled).unionByName(others.select(none.alias("fold"), none.alias("toxic"), "body")))
    if not models:
        return Toxicity(None, 0.0, np.array([0.0, 0.0, 0.0, 30.0 if totals[1] else -30.0]))
    chosen = [known.where(F.col("toxic") == c).withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(per_class) for c in (0, 1)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * per_class rows
    rows = _distinct_texts(named.join(sample, "id"))
    full, *unseen = models
    shipped = spark.sparkContext.broadcast(unseen)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(d.of, TAUS) for d in shipped.value]
        for batch in batches:
            for f, y, t in zip(*(batch.column(c).to_pylist() for c in ("fold", "toxic", "body")), strict=True):
                x = scorers[f].features([t]).reshape(1, -1)
                yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x[0]), x.shape[1]).cast(pa.list_(pa.float64())), pa.array([y], pa.int32())], names=["x", "y"])

    seen = rows.mapInArrow(features, "x array<double>, y int").toPandas()
    y = seen["y"].to_numpy(float)
    x = np.stack([np.asarray(v) for v in seen["x"]]).reshape(len(y), len(TAUS), -1)
    order = np.lexsort([y, *x.reshape(len(y), -1).T])
    fits = [(*_logistic(x[order, k], y[order]), tau) for k, tau in enumerate(TAUS)]
    curve, _, tau = min(fits, key=lambda f: f[1])
    curve[-1] = min(curve[-1], -0.04)  # a text without words is no evidence
    return Toxicity(full, tau, curve)


def score_documents(docs: DataFrame, model: Toxicity, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` in place of one of that name."""
    spark = docs.sparkSession
    ship_package(spark)
    shipped = spark.sparkContext.broadcast(model)
    docs = docs.select(*[c for c in docs.columns if c != score_col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped.value
        scorer = Scorer(fitted.model.of, [fitted.tau]) if fitted.model else None
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            scores = np.zeros(len(texts))
            for at in range(0, len(texts), 1000):
                part = texts[at : at + 1000]
                scores[at : at + 1000] = fitted.scores(scorer.features(part)[0] if scorer else np.zeros((len(part), 3)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, score_col])
        del scorer
        give_back()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, `{score_col}` double")
