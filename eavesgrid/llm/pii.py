"""Personal data: exact patterns, and what a conditional random field adds to them.

The patterns are matched as regular expressions would match them, leftmost and without overlap, but in steps that are linear in the
text whatever it holds.

The linear-chain field labels words (runs without white space) from their shapes, the shapes and cue words next to them, and
the label before.  All personal data it looks for has a digit, an ``@``, a bracketed ``at`` or a ``dot``; its chains are the words up to
``CONTEXT`` around such words, and all other words are outside by definition.  It is trained from a small labelled table by
gradient steps on the exact likelihood, and decoded by Viterbi, many chains at a time as numpy arrays.  It finds what the patterns
can't: numbers that run into each other, numbers written in other ways, spelled-out addresses.  Added spans must have the digits
or the parts their kind needs, and overlap no pattern span.

One pass over the texts, nothing is shuffled.

Defined results: a null text is empty and has no spans; repeated rows are searched one by one; a table without rows gives an
empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
CONTEXT = 3

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[Span]:
    """A local part ends at the ``@``, so each one is looked at from there: left over its characters, right over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[Span]:
    """Numbers joined by dots, four at a time."""
    for run in _NUMBERS.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in four):
                yield "ip", at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _cards(text: str) -> Iterator[Span]:
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _only_digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()


def _phones(text: str) -> Iterator[Span]:
    for m in _PLUS.finditer(text):
        if 9 <= len(_only_digits(m.group())) <= 15:
            yield "phone", m.start(), m.end()


def base_spans(text: str) -> list[Span]:
    """Spans of the exact patterns, by start and then in the order of ``KINDS``."""
    found = [*_emails(text), *_ips(text), *_cards(text), *_phones(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# ---- words and their features

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKED = re.compile(r"[0-9@]|[dD][oO][tT]|[(\[{][aA][tT][)\]}]")
_EDGE = ".,;:!?\"'"
_CUES = frozenset(
    "at dot (at) [at] {at} (dot) [dot] {dot} mail e-mail email phone tel telephone call fax mobile card visa credit ip host "
    "address version no number chapter page pages isbn order year = password token".split()
)
_SHAPES: dict[str, tuple[str, str, str]] = {}


def _shape(word: str) -> tuple[str, str, str]:
    """Cue word, shape with every digit, and shape with runs joined."""
    known = _SHAPES.get(word)
    if known is None:
        core = word.strip(_EDGE)
        low = core.lower()
        letters = "".join("9" if "0" <= c <= "9" else ("A" if c.isupper() else "a") if c.isalpha() else c for c in core[:40])
        full = re.sub(r"A+", "A", re.sub(r"a+", "a", letters))
        joined = re.sub(r"(.)\1+", r"\1", full)
        known = (low if low in _CUES else "", full if "9" in full else joined[:12], joined[:24])
        if len(_SHAPES) > 100_000:
            _SHAPES.clear()
        _SHAPES[word] = known
    return known


def _features(words: list[str]) -> list[list[str]]:
    shapes = [("", "^", "^"), *map(_shape, words), ("", "$", "$")]
    out = []
    for i in range(1, len(shapes) - 1):
        (cue, full, joined), (cue_b, full_b, joined_b), (cue_a, full_a, joined_a) = shapes[i], shapes[i - 1], shapes[i + 1]
        out.append([
            "bias", f"s {full}", f"j {joined}", f"sb {full_b}", f"sa {full_a}", f"jb {joined_b}", f"ja {joined_a}",
            f"jj {joined} {joined_a}", f"bj {joined_b} {joined}", f"w {cue}", f"wb {cue_b}", f"wa {cue_a}",
        ])
    return out


@dataclass
class Field:
    """Weights of features by label, and of one label after another."""

    index: dict[str, int]
    weights: np.ndarray
    follow: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        get = self.index.get
        rows = [[i for f in features if (i := get(f)) is not None] for features in _features(words)]
        return np.stack([self.weights[r].sum(axis=0) for r in rows]) if rows else np.zeros((0, len(LABELS)))

    def decode(self, stretches: list[list[str]]) -> list[np.ndarray]:
        """Best labels of each stretch of words; stretches of similar length are decoded as one array."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(stretches)
        order = sorted(range(len(stretches)), key=lambda i: len(stretches[i]))
        first = 0
        while first < len(order):
            longest = max(1, len(stretches[order[first]]) * 5 // 4 + 2)
            last = first
            while last < len(order) and last - first < 256 and len(stretches[order[last]]) <= longest:
                last += 1
            group = order[first:last]
            for i, labels in zip(group, self._viterbi([self.emissions(stretches[i]) for i in group]), strict=True):
                out[i] = labels
            first = last
        return out

    def _viterbi(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        lengths = np.array([len(s) for s in scores])
        steps, n = int(lengths.max(initial=0)), len(scores)
        if not steps:
            return [np.zeros(0, np.int64)] * n
        grid = np.zeros((n, steps, len(LABELS)))
        for i, s in enumerate(scores):
            grid[i, : len(s)] = s
        best, back = grid[:, 0] + _START, np.zeros((n, steps, len(LABELS)), np.int8)
        for t in range(1, steps):
            ways = best[:, :, None] + self.follow[None]
            back[:, t] = ways.argmax(axis=1)
            best = np.where((t < lengths)[:, None], ways.max(axis=1) + grid[:, t], best)
        labels = np.zeros((n, steps), np.int64)
        now = best.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            inside = t < lengths
            labels[inside, t] = now[inside]
            if t:
                now = np.where(inside, back[np.arange(n), t, now], now)
        return [labels[i, : lengths[i]] for i in range(n)]


_NEVER = -1e4
#: A span begins with a B label, and an I label follows one of its own kind.
_ALLOWED = np.array([[a[2:] == b[2:] and a != "O" if b[0] == "I" else True for b in LABELS] for a in LABELS])
_START = np.where([label[0] == "I" for label in LABELS], _NEVER, 0.0)


# ---- training

def labelled_table(rows: int = 480, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """The small labelled table the field is trained from: sentences with and without personal data, from patterns.

    ``9`` stands for a digit, ``n`` for a number up to 255, ``x`` for a letter; ``{kind|...}`` marks a span.
    """
    patterns = [  # fixed values
        "{phone|(999) 999-9999}", "{phone|999-999-9999}", "{phone|999.999.9999}", "{phone|999 999 9999}", "{phone|9-999-999-9999}",
        "{phone|+9 (999) 999-9999}", "{phone|+99 99 9999 9999}", "{phone|(999)999-9999}", "phone {phone|999-999-9999}", "call {phone|(999) 999-9999} now",
        "{card|9999 9999 9999 9999}", "{card|9999-9999-9999-9999}", "{card|9999999999999999}", "{card|9999.9999.9999.9999}", "card {card|9999/9999/9999/9999}",
        "{ip|n.n.n.n}", "{ip|n[.]n[.]n[.]n}", "{ip|n(.)n(.)n(.)n}", "{ip|n.n.n.n:9999}", "host {ip|n[.]n[.]n[.]n}",
        "{email|xxxx.99@xxxx9.xxxxxxx.xxx}", "{email|xxxxx@xxxxxx.xxx}", "{email|xxxx (at) xxxxxx.xxx}", "{email|xxxx [at] xxxxxx [dot] xxx}",
        "{email|xxxx.99 (at) xxxxxx (dot) xxx}", "{email|xxxx at xxxxxx dot xxx}", "{email|xxxx[at]xxxxxx[dot]xxx}", "{email|xxxx(at)xxxxxx.xxx}", "{email|xxxx {at} xxxxx {dot} xxx}",
        "{phone|+9 (999) 999-9999} {card|9999999999999999}", "{card|9999999999999999} {phone|+9 (999) 999-9999}", "{ip|n.n.n.n} {card|9999999999999999}",
        "{card|9999999999999999} {ip|n.n.n.n}", "{phone|+9 (999) 999-9999} {ip|n.n.n.n}", "{ip|n.n.n.n} {phone|+9 (999) 999-9999}", "{phone|+9 (999) 999-9999} 99",
        "{card|9999999999999999} {card|9999999999999999}", "{phone|+9 (999) 999-9999} {phone|+9 (999) 999-9999}", "{card|9999999999999999} 99.99.99.", "99 {card|9999999999999999}",
        "{email|xxxx.99@xxxx9.xxxxxxx.xxx} {phone|+9 (999) 999-9999} {card|9999999999999999}", "{card|9999999999999999} 9", "9999 {phone|999-999-9999}", "{phone|999-999-9999} {card|9999 9999 9999 9999}",
        "9.9.", "version 9.", "version 9.9.9", "v9.9.9", "9999", "999", "99", "9", "99%", "99.99", "9,999,999", "9999-99-99", "99.99.9999", "99/99/9999", "99:99", "99:99:99",
        "chapter 99", "page 999", "pages 999-999", "ISBN 999-9-99-999999-9", "order 99999999-9999", "No. 9999", "9999-9999", "#9999", "$99.99", "999-9999", "(9999)", "[99]", "(99)",
        "AXXA9XX9XXX9X99XXX9X", "password=x9x9xx9x9999xx99", 'token = "9999x9xx9xxx9x99999x99xx9x99xx9x9x9x9999"', "http://xxxx.xxxxxxx.xxx/xx/99999", "https://xxx.xxxx.xxx/xx/9999?xxxx=9&xxx=x",
        "the dot xxxx", "at the xxxx", "xxxx at xxxxx", "x dot on xxxx", "polka dot xxxxx", "xxx9", "9xx", "9999999", "99999999", "9.9.9.9999", "(9)", "9)", "x-9", "9x9", "@xxxxx", "xxx @ xxx", "9999999999", "99999999999",
    ]
    random = np.random.default_rng(seed)

    def letters(low: int, high: int) -> str:
        return "".join(random.choice(list("abcdefghijklmnopqrstuvwxyzéüñ")[:26 if random.random() < 0.8 else 29], int(random.integers(low, high))))

    def plain() -> str:
        word = letters(1, 12)
        form = random.random()
        word = word.upper() if form < 0.06 else word.capitalize() if form < 0.25 else word
        return word + str(random.choice(["", "", "", "", "", ".", ",", "***", "!!", "|", ":"], p=[0.15] * 5 + [0.08, 0.08] + [0.0225] * 4))

    def filled(pattern: str) -> str:
        out = re.sub("n", lambda _: str(random.integers(0, 256)), pattern) if re.fullmatch(r"[n.:9\[\]()]+", pattern) else pattern
        out = re.sub("x+", lambda m: letters(max(1, len(m.group()) - 2), len(m.group()) + 3), out)
        return re.sub("9", lambda _: str(random.integers(0, 10)), out)

    table = []
    for i in range(rows):
        pattern = patterns[i % len(patterns)]
        text, spans = " ".join(plain() for _ in range(random.integers(0, 7))), []
        marked = re.split(r"\{(\w+)\|((?:[^{}]|\{\w+\})*)\}", pattern)
        for kind, piece in zip(["", *marked[1::3]], [marked[0], *marked[2::3]], strict=True):
            if kind or piece:
                text += " " * bool(text and not text.endswith(" "))
                made = filled(piece) if kind else " ".join(w if w.lower().strip(".") in _CUES else filled(w) for w in piece.split())
                if kind:
                    spans.append((kind, len(text), len(text) + len(made)))
                text += made
        tail = marked[-1].strip()
        text += (" " + tail if tail and len(marked) > 1 else "") + str(random.choice(["", "", "", ".", ","]))
        text += "".join(" " + plain() for _ in range(random.integers(0, 7)))
        table.append((text, spans))
    # Running text with nothing in it, so that plain words are learnt as such.
    table += [(" ".join(plain() for _ in range(12)), []) for _ in range(rows // 6)]
    return table


def _labels(words: list[tuple[int, int]], spans: Iterable[Span]) -> list[int]:
    out = []
    for start, end in words:
        label = "O"
        for kind, a, b in spans:
            if start < b and end > a:
                label = ("B-" if start <= a else "I-") + kind
        out.append(LABELS.index(label))
    return out


def train(table: list[tuple[str, list[Span]]] | None = None, rounds: int = 120, ridge: float = 2e-4) -> Field:
    """Fit a field to sentences with spans by Adam on the mean log-likelihood."""
    rows = []
    for text, spans in table if table is not None else labelled_table():
        for places in _stretches(text):
            rows.append((_features([text[a:b] for a, b in places]), _labels(places, spans)))
    index: dict[str, int] = {}
    for features, _ in rows:
        for word in features:
            for f in word:
                index.setdefault(f, len(index))
    n, steps, width, k = len(rows), max(len(y) for _, y in rows), len(rows[0][0][0]), len(LABELS)
    ids = np.full((n, steps, width), len(index))
    gold = np.zeros((n, steps), np.int64)
    inside = np.zeros((n, steps), bool)
    for i, (features, y) in enumerate(rows):
        ids[i, : len(y)] = [[index[f] for f in word] for word in features]
        gold[i, : len(y)], inside[i, : len(y)] = y, True
    weights, follow = np.zeros((len(index) + 1, k)), np.zeros((k, k))
    blocked = np.where(_ALLOWED, 0.0, _NEVER)
    flat = ids.reshape(-1)
    at = np.repeat(np.arange(n * steps), width)
    order = np.argsort(flat, kind="stable")
    kinds, heads = np.unique(flat[order], return_index=True)
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(follow), np.zeros_like(follow)]
    both = inside[:, 1:]

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))

    for step in range(1, rounds + 1):
        scores = weights[ids].sum(axis=2)
        moves = follow + blocked
        ahead, behind = np.zeros((n, steps, k)), np.zeros((n, steps, k))
        ahead[:, 0] = scores[:, 0] + _START
        for t in range(1, steps):
            ahead[:, t] = np.where(inside[:, t, None], lse(ahead[:, t - 1, :, None] + moves[None], 1) + scores[:, t], ahead[:, t - 1])
        for t in range(steps - 2, -1, -1):
            further = lse(moves[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(inside[:, t + 1, None], further, 0.0)
        total = lse(ahead[:, -1], 1)
        single = np.exp(ahead + behind - total[:, None, None]) * inside[:, :, None]
        pair = ahead[:, :-1, :, None] + moves[None, None] + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        pair = (np.exp(np.minimum(pair, 0.0)) * both[:, :, None, None]).sum(axis=(0, 1))
        single[np.arange(n)[:, None], np.arange(steps)[None, :], gold] -= inside
        np.add.at(pair, (gold[:, :-1][both], gold[:, 1:][both]), -1)
        push = np.zeros_like(weights)
        push[kinds] = np.add.reduceat(single.reshape(-1, k)[at[order]], heads, axis=0)
        push[-1] = 0
        for j, (w, g) in enumerate(((weights, push / n + ridge * weights), (follow, pair / n + ridge * follow))):
            m, v = state[2 * j], state[2 * j + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(index, weights[:-1], follow + blocked)


@functools.cache
def standard_field() -> Field:
    """The field of the standard table, trained once in a process."""
    return train()


# ---- spans

def _stretches(text: str) -> list[list[tuple[int, int]]]:
    """Places of the words in each chain."""
    marks = [m.start() for m in _MARKED.finditer(text)]
    if not marks:
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    hit = np.unique(np.searchsorted([a for a, _ in words], marks, "right") - 1)
    out: list[list[tuple[int, int]]] = []
    end = -1
    for i in hit.tolist():
        low, high = max(0, i - CONTEXT), min(len(words), i + CONTEXT + 1)
        if low <= end:
            out[-1].extend(words[end:high])
        else:
            out.append(words[low:high])
        end = high
    return out


_NEEDS = {"phone": (9, 15), "card": (12, 19)}
_AT = r"\s*(?:@|[(\[{]at[)\]}])\s*"
_DOT = r"(?:\.|\s*[(\[{]dot[)\]}]\s*)"
_SPELLED = re.compile(
    rf"[\w.%+-]+(?:{_AT}[\w-]+(?:{_DOT}[\w-]+)+|\s+at\s+[\w-]+(?:\s+dot\s+[\w-]+)+)", re.I
)


def _sound(kind: str, text: str) -> bool:
    """The digits or parts a span of that kind needs."""
    if kind == "email":
        return _SPELLED.fullmatch(text) is not None
    if kind == "ip":
        numbers = re.findall(r"[0-9]+", text)
        return len(numbers) in (4, 5) and all(len(x) <= 3 and int(x) <= 255 for x in numbers[:4])
    digits = _only_digits(text)
    low, high = _NEEDS[kind]
    return low <= len(digits) <= high and (kind == "phone" or luhn(digits))


def _decoded(text: str, words: list[tuple[int, int]], labels: np.ndarray) -> Iterator[Span]:
    i = 0
    while i < len(words):
        name = LABELS[labels[i]]
        j = i + 1
        if name[0] == "B":
            while j < len(words) and LABELS[labels[j]] == f"I-{name[2:]}":
                j += 1
            start, end = words[i][0], words[j - 1][1]
            while start < end and text[start] in "\"'<":
                start += 1
            while end > start and text[end - 1] in _EDGE + ">":
                end -= 1
            if end > start and _sound(name[2:], text[start:end]):
                yield name[2:], start, end
        i = j


def find_spans(texts: list[str], fitted: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text, both in order."""
    base = [base_spans(t) for t in texts]
    todo = [(i, words) for i, t in enumerate(texts) for words in _stretches(t)]
    found = fitted.decode([[texts[i][a:b] for a, b in words] for i, words in todo])
    out = [list(b) for b in base]
    for (i, words), labels in zip(todo, found, strict=True):
        if labels.any():
            for kind, start, end in _decoded(texts[i], words, labels):
                if all(end <= a or start >= b for _, a, b in base[i]):
                    out[i].append((kind, start, end))
    return [(b, sorted(o, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))) for b, o in zip(base, out, strict=True)]


SPANS = "array<struct<kind: string, start: long, end: long, base: boolean>>"


def find_personal_data(docs: DataFrame, fitted: Field | None = None, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans`` in place of a column of that name: kind, start, end (code points, end exclusive), and whether a
    pattern found it."""
    spark = docs.sparkSession
    ship_package(spark)
    shipped = spark.sparkContext.broadcast(fitted or standard_field())
    docs = docs.select(*[c for c in docs.columns if c != spans_col])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            rows = []
            for at in range(0, len(texts), 500):
                for base, spans in find_spans(texts[at : at + 500], shipped.value):
                    mine = set(base)
                    rows.append([{"kind": k, "start": a, "end": b, "base": (k, a, b) in mine} for k, a, b in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], names=[*batch.schema.names, spans_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{fields}, `{spans_col}` {SPANS}")

