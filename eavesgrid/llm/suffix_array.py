"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard's text.

Suffixes are classed as smaller or larger than their right neighbour.  The leftmost smaller ones of each run split the text into
substrings; these are sorted by inducing from their first letters, named, and, if names repeat, the sequence of names is sorted
recursively.  From their order all other suffixes are induced in two linear scans.

At the top level, with its few letters, the scans go bucket by bucket with numpy: what a bucket's suffixes induce is appended
to the buckets of larger (then smaller) letters in order.  Deeper levels have as many letters as names and are scanned
one by one.
"""

from __future__ import annotations

import numpy as np

FEW_LETTERS = 512


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last, a sentinel, is."""
    n = len(s)
    out = np.ones(n, bool)
    if n > 1:
        differs = np.flatnonzero(s[:-1] != s[1:])  # the sentinel differs from all others, so there is one behind every place
        out[:-1] = (s[:-1] < s[1:])[differs[np.searchsorted(differs, np.arange(n - 1))]]
    return out


def _append(buckets: list[list[np.ndarray]], letters: np.ndarray, places: np.ndarray) -> None:
    """Append places to their letters' buckets, in order."""
    if not len(places):
        return
    order = np.argsort(letters, kind="stable")
    letters, places = letters[order], places[order]
    cuts = np.flatnonzero(letters[1:] != letters[:-1]) + 1
    for part, letter in zip(np.split(places, cuts), letters[np.concatenate([[0], cuts])], strict=True):
        buckets[letter].append(part)


def _scan(s: np.ndarray, wanted: np.ndarray, letter: int, buckets: list[list[np.ndarray]], behind: np.ndarray) -> np.ndarray:
    """A bucket's suffixes of one class in scanning order; what they and then ``behind`` induce goes to the buckets."""
    waves, wave = [], np.concatenate(buckets[letter]) if buckets[letter] else np.zeros(0, np.int64)
    while len(wave):
        waves.append(wave)
        left = wave[wave > 0] - 1
        left = left[wanted[left]]
        here = s[left] == letter
        _append(buckets, s[left[~here]], left[~here])
        wave = left[here]
    left = behind[behind > 0] - 1
    left = left[wanted[left]]
    _append(buckets, s[left], left)
    return np.concatenate(waves) if waves else np.zeros(0, np.int64)


def _induce_buckets(s: np.ndarray, smaller: np.ndarray, starts: np.ndarray, letters: int) -> np.ndarray:
    """All suffixes in order, from the leftmost smaller ones in order (by first letter only, for the first pass)."""
    order = np.argsort(s[starts], kind="stable")
    firsts = starts[order]
    bounds = np.searchsorted(s[firsts], np.arange(letters + 1))
    larger = ~smaller
    up: list[list[np.ndarray]] = [[] for _ in range(letters)]
    down: list[list[np.ndarray]] = [[] for _ in range(letters)]
    large = [_scan(s, larger, c, up, firsts[bounds[c] : bounds[c + 1]]) for c in range(letters)]
    down[s[-1]].append(np.array([len(s) - 1]))
    small = [_scan(s, smaller, c, down, large[c][::-1])[::-1] for c in range(letters - 1, -1, -1)][::-1]
    return np.concatenate([x for pair in zip(large, small, strict=True) for x in pair])


def _induce_list(s: np.ndarray, smaller: np.ndarray, starts: np.ndarray, letters: int) -> np.ndarray:
    """The same for many letters, one suffix after the other."""
    counts = np.bincount(s, minlength=letters)
    ends = np.cumsum(counts)
    heads, tails = (ends - counts).tolist(), ends.tolist()
    out = [-1] * len(s)
    # Letter before each suffix if what it starts belongs to the scan, else -1; the last entry serves places still empty.
    before = np.append(np.append(-1, np.where(smaller[:-1], -1, s[:-1])), -1).tolist()
    for i, letter in zip(starts[::-1].tolist(), s[starts[::-1]].tolist(), strict=True):
        tails[letter] -= 1
        out[tails[letter]] = i
    for i in out:  # grows as it is read: every larger suffix lies behind the one that induces it
        letter = before[i]
        if letter >= 0:
            head = heads[letter]
            out[head] = i - 1
            heads[letter] = head + 1
    before = np.append(np.append(-1, np.where(smaller[:-1], s[:-1], -1)), -1).tolist()
    tails = ends.tolist()
    for i in reversed(out):  # likewise, towards the front
        letter = before[i]
        if letter >= 0:
            tail = tails[letter] - 1
            out[tail] = i - 1
            tails[letter] = tail
    out[0] = len(s) - 1
    return np.array(out, np.int64)


def _names(s: np.ndarray, starts: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for each substring between leftmost smaller places, equal for equal ones and in their order."""
    place = np.zeros(len(s), np.int64)
    place[starts] = np.arange(len(starts))
    rank = place[ordered]  # number in the text of each substring, in sorted order
    length = np.append(np.diff(starts), 0) + 1  # both ends included
    length[-1] = 1
    same = np.zeros(len(ordered), bool)
    same[1:] = length[rank[1:]] == length[rank[:-1]]
    open_, offset = np.flatnonzero(same), 0
    while len(open_):
        a, b = ordered[open_], ordered[open_ - 1]
        equal = s[a + offset] == s[b + offset]
        same[open_[~equal]] = False
        offset += 1
        open_ = open_[equal]
        open_ = open_[length[rank[open_]] > offset]
    names = np.cumsum(~same) - 1
    out = np.empty(len(starts), np.int64)
    out[rank] = names
    return out, int(names[-1]) + 1


def suffix_array(s: np.ndarray, letters: int) -> np.ndarray:
    """Order of the suffixes of ``s``: whole numbers below ``letters``, the last one 0 and nowhere else."""
    n = len(s)
    if n <= 1:
        return np.arange(n)
    smaller = _smaller(s)
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    induce = _induce_buckets if letters <= FEW_LETTERS else _induce_list
    leftmost = np.zeros(n, bool)
    leftmost[starts] = True
    # The list scan places what it is given from the buckets' ends, in the order of the first letters or of the whole suffixes.
    first = induce(s, smaller, starts[np.argsort(s[starts], kind="stable")], letters)
    ordered = first[leftmost[first]]
    names, n_names = _names(s, starts, ordered)
    if n_names < len(starts):
        ordered = starts[suffix_array(names, n_names)]
    return induce(s, smaller, ordered, letters)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place of the text the bytes it shares with the suffix before it in the order, counted up to ``most``.

    The lengths stand in the order of the text (permuted), so that all places are compared word by word at once.
    """
    n = len(data)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(most + 8, np.uint8)])
    word = np.ndarray((n + most,), "<u8", padded.tobytes(), strides=(1,))
    out = np.zeros(n, np.int64)
    open_ = np.flatnonzero(before >= 0)
    while len(open_):
        equal = word[open_ + out[open_]] == word[before[open_] + out[open_]]
        rest = open_[~equal]
        difference = word[rest + out[rest]] ^ word[before[rest] + out[rest]]
        lowest = difference & (~difference + np.uint64(1))
        out[rest] += (np.log2(lowest.astype(np.float64)) // 8).astype(np.int64)
        open_ = open_[equal]
        out[open_] += 8
        open_ = open_[out[open_] < most]
    end = n - np.maximum(np.arange(n), before)
    return np.minimum(np.minimum(out, most), end)
