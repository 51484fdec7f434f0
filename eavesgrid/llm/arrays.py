"""Texts of an Arrow batch as one byte array, and hashes of words and byte windows, without a Python loop over characters.

The hash of a run of bytes is a polynomial of random 64-bit values of its bytes modulo 2^64, taken from running sums,
and then mixed.  The base is odd, so that a power can be divided out again.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_BYTES, _OTHER = np.random.default_rng(20240229).integers(1, 1 << 63, (2, 256), dtype=np.int64).astype(np.uint64)
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_MAX_BYTES = 1 << 20
_POWERS: dict[str, np.ndarray] = {}


def give_back() -> None:
    """Return freed memory to the machine: a worker process serves one operator after another, beside a heap of fixed size."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", BASE), ("down", _INVERSE)):
            out = np.empty(size, np.uint64)
            out[0], done = 1, 1
            while done < size:  # doubling: the next stretch is the last one times a power
                out[done : 2 * done] = out[:done] * np.uint64(pow(int(base), done, 1 << 64))
                done *= 2
            _POWERS[name] = out
    return _POWERS["up"], _POWERS["down"]


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts (one more entry than rows); nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(column: pa.Array, most_bytes: int = _MAX_BYTES):
    """``(first, last)`` ranges of rows with about ``most_bytes`` bytes, at least one row each."""
    _, starts = buffer_of(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + most_bytes, "right")) - 1)
        yield first, min(last, len(column))
        first = min(last, len(column))


def _running(data: np.ndarray, values: np.ndarray = _BYTES) -> np.ndarray:
    """Running sums of byte value times power, one more entry than bytes."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=out[1:])
    return out


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (run of bytes other than ASCII white space), and the number of words in each row."""
    n = len(data)
    if not n:
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(starts) - 1, np.int64)
    solid = ~_WHITE[data]
    head = np.zeros(n + 1, bool)  # a row begins here
    head[starts] = True
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    first = np.flatnonzero(solid & (~before | head[:n]))
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    last = np.flatnonzero(solid & (~after | head[1:])) + 1
    counts = np.diff(np.searchsorted(first, starts))
    return first, last, counts


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray, other: bool = False) -> np.ndarray:
    """Hash of the bytes from ``first`` (ascending) to ``last``; ``other`` gives a second one, from other values of the bytes.

    The running sums are taken over stretches of ``_MAX_BYTES``, so that memory doesn't follow the length of a text.
    """
    out = np.empty(len(first), np.uint64)
    i = 0
    while i < len(first):
        base = first[i]
        j = max(i + 1, int(np.searchsorted(first, base + _MAX_BYTES)))
        a, b = first[i:j] - base, last[i:j] - base
        sums = _running(data[base : base + int(b.max())], _OTHER if other else _BYTES)
        _, down = _powers(len(sums))
        out[i:j] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def fold(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return _FOLD[data]


def line_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each line without the white space around it, and the number of lines in each row (one at least)."""
    rows = len(starts) - 1
    feeds = np.flatnonzero(data == 10)
    row = np.searchsorted(starts, feeds, "right") - 1
    before = np.searchsorted(feeds, starts)  # line feeds before each row
    begin, end = np.empty(rows + len(feeds), np.int64), np.empty(rows + len(feeds), np.int64)
    begin[np.arange(rows) + before[:-1]] = starts[:-1]
    begin[np.arange(len(feeds)) + row + 1] = feeds + 1
    end[np.arange(len(feeds)) + row] = feeds
    end[np.arange(rows) + before[1:]] = starts[1:]
    solid = np.flatnonzero(~_WHITE[data])
    first, last = np.searchsorted(solid, begin), np.searchsorted(solid, end)
    some = first < last
    out = np.stack([end, end])
    out[0][some], out[1][some] = solid[first[some]], solid[last[some] - 1] + 1
    return out[0], out[1], np.diff(before) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased, and the number of words in each row."""
    first, last, counts = word_spans(data, starts)
    return span_hashes(_FOLD[data], first, last), counts


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each position on, as far as they fit; rows are not told apart."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = _running(data)
    _, down = _powers(len(data) + 1)
    return mix((sums[length:] - sums[:-length]) * down[:n])


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words of a row, the whole row if it has fewer (none for no words); runs per row."""
    n_runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    at = np.repeat(first - np.concatenate([[0], np.cumsum(n_runs)[:-1]]) if len(counts) else first, n_runs) + np.arange(n_runs.sum())
    length = np.repeat(np.minimum(counts, size), n_runs)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        take = k < length
        here = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else out
        out = np.where(take, mix(out * BASE + here + np.uint64(k + 1)), out)
    return out, n_runs
