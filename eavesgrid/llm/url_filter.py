"""URL rules and listed keys by Bloom filter cascades.

A key is a host and the beginning of a path (``example.net/en/``).  The first filter of a cascade encodes the listed keys, the
second the keys of the corpus that pass the first by mistake, the third the listed keys that pass the second by mistake, and so
on until there are no mistakes.  Over the key universe it was built for, that is every key any page of the corpus can ask for, the
answer is exact.  Looking up needs no join: the filters are constants of the plan.

The first filter is sized by the list and by the corpus: for ``n`` listed keys and ``u`` keys asked for (counted before) it is large enough
that about ``n`` keys, or 64, pass it by mistake.  That is ``1.5 log2(u / n)`` bits a listed key and more for short lists, up to some ten bits a key for every factor
of ten in ``u / n``.  It is made larger until ``MISTAKES`` times that number is kept, so no later filter encodes more than ``MISTAKES * max(n, 64)``
keys, at ``BITS_PER_KEY`` bits each.  Up to ``MOST_KEYS`` listed keys a cascade travels with the plan; a longer list is divided by the hash
of the key into parts of that size, and each part has its own cascade.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no rule; repeated pages are judged one by
one; an empty rule list lets everything pass; null rules are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import ascii_lower

BITS_PER_KEY = 10
HASHES = 5
MISTAKES = 4
LEAST_KEYS = 64
MOST_KEYS = 1_000_000
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its number of bits, and the bits in words of 64."""

    salt: int
    bits: int
    words: np.ndarray

    def passes(self, key: Column) -> Column:
        array = F.lit(self.words)
        out = F.lit(True)
        for position in _positions(key, self.salt, self.bits):
            word = F.element_at(array, (F.shiftright(position, 6) + 1).cast("int"))
            out = out & (F.getbit(word, F.pmod(position, F.lit(64)).cast("int")) == 1)
        return out


def _positions(key: Column, salt: int, bits: int) -> list[Column]:
    first, step = (F.shiftrightunsigned(h, 32) for h in (F.xxhash64(F.lit(salt), key), F.xxhash64(key, F.lit(salt))))
    return [F.pmod(first + F.lit(i) * step, F.lit(bits)) for i in range(HASHES)]


def first_bits(n: int, universe: int) -> int:
    """Bits of the first filter: about ``n`` keys of the universe, or ``LEAST_KEYS``, pass it by mistake."""
    wanted = max(n, LEAST_KEYS)
    share = min(0.01, wanted / max(universe, 1))
    filled = -HASHES * n / math.log(1 - share ** (1 / HASHES))
    # All places of a key hang on two numbers below the size: so many keys look alike whatever is set.
    alike = math.sqrt(universe * n / wanted)
    return math.ceil(max(filled, alike))


def _encoded(keys: DataFrame, bits: int, salt: int) -> Level:
    """The filter of the keys, its words put together by Spark."""
    bits = -(-max(64, bits) // 64) * 64
    spots = keys.select(F.explode(F.array(*_positions(F.col("key"), salt, bits))).alias("p"))
    word = F.bit_or(F.expr("shiftleft(1L, cast(pmod(p, 64) as int))")).alias("word")
    rows = spots.groupBy(F.shiftright("p", 6).alias("at")).agg(word).collect()  # bits / 64 numbers at most
    words = np.zeros(bits // 64, dtype=np.int64)
    for at, value in rows:
        words[at] = value
    return Level(salt, bits, words)


@dataclass(frozen=True)
class Cascade:
    """Exact membership for the keys of one universe."""

    levels: tuple[Level, ...]

    def has(self, key: Column) -> Column:
        out = F.lit(False)
        for level in reversed(self.levels):
            out = level.passes(key) & ~out
        return out if self.levels else F.lit(False)


def build_cascade(listed: DataFrame, universe: DataFrame, salt: int = 0) -> Cascade:
    """``listed`` and ``universe`` have a column ``key``; keys of the list that the universe lacks do no harm."""
    mine = cut(listed.select("key").where("key is not null").distinct())
    n = mine.count()
    if not n:
        return Cascade(())
    bits, most = first_bits(n, universe.count()), MISTAKES * max(n, LEAST_KEYS)
    while True:
        level = _encoded(mine, bits, salt)
        passing = universe.select("key").where(level.passes(F.col("key"))).distinct()
        wrong = cut(passing.join(mine, "key", "left_anti"))  # keys of the corpus that aren't listed
        n_wrong = wrong.count()
        if n_wrong <= most:
            break
        bits *= 2
    levels, others = [level], mine
    while n_wrong:
        level = _encoded(wrong, n_wrong * BITS_PER_KEY, salt + len(levels))
        levels.append(level)
        wrong, others = cut(others.where(level.passes(F.col("key")))), wrong
        n_wrong = wrong.count()
    return Cascade(tuple(levels))


@dataclass(frozen=True)
class KeySet:
    """Cascades for the parts of a list, ``key`` in part ``xxhash64(key) mod parts``."""

    parts: tuple[Cascade, ...]

    def has(self, key: Column) -> Column:
        if len(self.parts) == 1:
            return self.parts[0].has(key)
        part = F.pmod(F.xxhash64(key), F.lit(len(self.parts)))
        out = F.lit(False)
        for i, cascade in enumerate(self.parts):
            out = out | ((part == i) & cascade.has(key))
        return out


def build_key_set(listed: DataFrame, universe: DataFrame, salt: int = 0, most_keys: int = MOST_KEYS) -> KeySet:
    n = -(-listed.count() // most_keys) or 1
    part = F.pmod(F.xxhash64("key"), F.lit(n))
    return KeySet(tuple(build_cascade(listed.where(part == i), universe.where(part == i), salt) for i in range(n)))


def candidate_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Every key a rule can have that fits, longest first, then longest host: the host and its parent domains with the
    beginnings of the path of the given lengths."""
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]), lambda p: p.isNotNull()
    )
    both = F.flatten(
        F.transform(hosts, lambda h: F.transform(starts, lambda p: F.struct(
            F.length(F.concat(h, p)).alias("n"), F.length(h).alias("h"), F.concat(h, p).alias("key"))))
    )
    ranked = F.sort_array(both, asc=False)
    return F.when(host != "", F.transform(ranked, lambda x: x["key"])).otherwise(F.array().cast("array<string>"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has ``host, path, verdict`` (block or allow).  A rule fits its host and all subdomains if the path starts with the
    rule's; the longest rule wins, with equal lengths the one with the longer host, and of two rules with one key the blocking
    one.  A URL that no listed key fits gets ``default``.
    """
    rules = rules.where("host is not null and path is not null and verdict is not null").select(
        F.concat(ascii_lower(F.col("host")), "path").alias("key"), F.length("path").alias("n"), "verdict"
    )
    # Distinct lengths of rule paths, not rules: bounded by the longest path of a rule.
    lengths = sorted(r[0] for r in rules.select("n").distinct().collect()) or [0]
    parted = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keyed = parted.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), lengths))
    universe = keyed.select(F.explode("keys").alias("key"))
    block = build_key_set(rules.where("verdict = 'block'"), universe, salt=1)
    allow = build_key_set(rules.where("verdict = 'allow'"), universe, salt=1001)
    hit = F.filter("keys", lambda k: block.has(k) | allow.has(k))
    out = keyed.withColumn("rule", F.get(hit, F.lit(0)))
    verdict = F.when(F.col("rule").isNull(), default).when(block.has(F.col("rule")), "block").otherwise("allow")
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"))
