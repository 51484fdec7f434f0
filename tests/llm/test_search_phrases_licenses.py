"""Ranked search, collocations and license notices against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eavesgrid.llm import collocations, lexical_search, license_scan
from eavesgrid.llm import queries as Q

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_search(docs, items, k):
    """docs: (id, text) rows, items: (id, text) rows; (item, rank, id, score)."""
    own = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, words in wanted.items():
        scored = []
        for i, c in own:
            m = 50 + (50 * sum(c.values()) * n_docs) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in words if c[t])
            if s > 0:
                scored.append((s, i))
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r, i, s) for r, (s, i) in enumerate(scored[:k], 1)]
    return Counter(out)


ITEMS = [(1, "Line of the text, WORDS and é"), (1, "some more words"), (2, None), (3, "twin row x w1x1 w2x2"), (None, "shared line"), (4, "nowhere-found")]


@pytest.mark.parametrize("frame", ["odd", "clashing", "empty"])
@pytest.mark.parametrize("k", [2, 50])
def test_search_on_odd_rows(spark, frame, k, request):
    docs = request.getfixturevalue(frame)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("term", F.lit("own")).withColumn("item", F.lit(7))
    got = Counter(tuple(r) for r in lexical_search.search(docs, items, k).select("item_id", "rank", "doc_id", "score").collect())
    assert got == plain_search([(r.doc_id, r.text) for r in docs.collect()], ITEMS, k)


def test_search_without_items(spark, odd):
    assert lexical_search.search(odd, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_search_in_parts_and_small_steps(spark, corpus, monkeypatch):
    docs = corpus.select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = Counter(map(tuple, lexical_search.search(docs, items, 7).collect()))
    monkeypatch.setattr(lexical_search, "MOST_PAIRS", 300)
    monkeypatch.setattr(lexical_search, "_CELLS", 500)
    assert Counter(map(tuple, lexical_search.search(docs.repartition(7), items, 7).collect())) == whole
    assert whole == plain_search([tuple(r) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 7)


def test_large_scores_add_exactly(spark):
    docs = spark.createDataFrame([(i, f"rare{i} " * 90_000 + "all") for i in range(3)] + [(9 + i, "all") for i in range(400)], "doc_id long, text string")
    items = [(5, " ".join(f"rare{i}" for i in range(3)) + " all")]
    got = Counter(map(tuple, lexical_search.search(docs, spark.createDataFrame(items, "item_id long, text string"), 4).collect()))
    assert got == plain_search([tuple(r) for r in docs.collect()], items, 4)


# ---------------------------------------------------------------- collocations


def plain_counts(rows, longest):
    out = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    out[("und" if lang is None else lang, *w[i : i + k])] += 1
    return out


def plain_collocations(rows, longest, least, most):
    f = plain_counts(rows, longest)
    n = Counter()
    for p, c in f.items():
        n[p[0]] += c * (len(p) == 2)
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    around = Counter()
    for p, a in found.items():
        for size in range(2, len(p) - 1):
            for i in range(1, len(p) - size + 1):
                around[(p[0], *p[i : i + size])] = max(around[(p[0], *p[i : i + size])], a)
    out = defaultdict(list)
    for p, a in found.items():
        if 100 * around[p] >= 50 * a and around[p]:
            continue
        cuts = [(10**6 * a * a // (f[p[:k]] * f[(p[0], *p[k:])]), k, f[p[:k]], f[(p[0], *p[k:])]) for k in range(2, len(p))]
        score, _, left, right = min(cuts)
        out[p[0]].append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return {(lang, r, ph.decode(), -a, left, right, n[lang], -s) for lang, rows_ in out.items() for r, (s, a, ph, left, right) in enumerate(sorted(rows_)[:most], 1)}


def random_rows(seed, n=60):
    rng = random.Random(seed)
    words = [f"V{i}" for i in range(25)] + ["é", "ß1"]
    bits = lambda: rng.choice([rng.choice(words), "hot pair " + rng.choice(words), ". ", "\t x", "one two three four"])
    return [(" ".join(bits() for _ in range(rng.randrange(200))), rng.choice(["en", None, "a b\tc\nd", "und"])) for _ in range(n)]


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_against_plain_counts(spark, longest, monkeypatch):
    monkeypatch.setattr(collocations, "_STRETCH", 700)
    monkeypatch.setattr(collocations, "_ROWS", 50)
    rows = random_rows(longest) + [(None, "en"), ("", "en"), ("a.b;c", "zz")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)
    words = [f"w{i + 1}" for i in range(longest)]
    slim = collocations._slim(docs, "text", "lang")
    assert collocations.hot_beginnings(slim, longest, 5)  # so that salts are tried, too
    got = {(r.lang, *[r[w] for w in words if r[w]]): r.f for r in collocations.phrase_counts(docs, longest, 5).where("level > 0").collect()}
    assert got == {p: c for p, c in plain_counts(rows, longest).items() if c >= 5}
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    for most in (11, 10**6):
        found = collocations.collocations(docs, longest, 5, most).select(columns).collect()
        assert {tuple(r) for r in found} == plain_collocations(rows, longest, 5, most) and found


@pytest.mark.parametrize("frame", ["odd", "clashing", "empty"])
def test_phrases_on_odd_rows(spark, frame, request):
    docs = request.getfixturevalue(frame)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = {tuple(r) for r in collocations.collocations(docs, least=2).select(columns).collect()}
    assert got == plain_collocations([(r.text, r.lang) for r in docs.collect()], 3, 2, 2000)


def test_products_beyond_64_bits(spark):
    numbers = spark.createDataFrame([(4_000_000_000_000, 9_999_999_999_999, 4_000_000_000_001), (10, 10, 10)], "a long, l long, r long")
    got = [r[0] for r in numbers.select(collocations._exact_ratio(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * a * a // (x * y) for a, x, y in [tuple(r) for r in numbers.collect()]]


def test_one_piece_longer_than_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_STRETCH", 64)
    rows = [("a b " * 400 + ". c d", "en"), ("x" * 500, "en"), ("c d! c d", "en")]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string").coalesce(1)
    got = {(r.lang, *[x for x in (r.w1, r.w2, r.w3) if x]): r.f for r in collocations.phrase_counts(docs, 3, 1).where("level > 0").collect()}
    assert got == dict(plain_counts(rows, 3))


# ---------------------------------------------------------------- license notices


def plain_licenses(text, templates=tuple(license_scan.TEMPLATES), percent=license_scan.PERCENT):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) if w]
    text = (text or "").translate(UPPER)
    w = split(text)
    places = [(i, label) for phrase, label in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    base, more, best = sorted({x for _, x in places}), set(), 0.0
    for block in re.split(r"\n|[.!?][\x20\x09-\x0D]", text):
        own = set(split(block))
        for label, words in templates:
            t = set(words.split())
            if 100 * len(t & own) >= percent * len(t):
                more.add(label)
                best = max(best, len(t & own) / len(t))
    at = [i for i, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(base), ",".join(sorted({*base, *more})), 1.0 if at else best)


NOTICES = [
    "Licensed under CC BY-NC 4.0.", "CC-BY cc   by\tCC\nby", "occ by", "All rights reserved.All rights reserved", "released under the MIT License",
    "License MIT the under released", "Released under the. MIT License", "general public. license", None, "",
    "This program is free software: you can redistribute it and/or modify it under terms of the GNU General Public License.",
    "Permission is hereby granted, free of charge, to any person obtaining copy of this software and documentation files!\nx",
    "redistribution and use in source and binary forms are met", "É licensed under the Apache License Version 2 0 É " * 30,
    " ".join(t for _, t in license_scan.TEMPLATES),
]


def test_notices_against_plain_python(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(NOTICES * 2)], "doc_id long, text string").repartition(4)
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = {r.doc_id: tuple(r[c] for c in columns) for r in license_scan.scan_licenses(docs).collect()}
    assert got == {i: plain_licenses(t) for i, t in enumerate(NOTICES * 2)}


@pytest.mark.parametrize("percent", [34, 60, 100])
def test_join_finds_every_pair(spark, percent):
    """Random small sets, where the filters have most to lose."""
    rng = random.Random(percent)
    words = [f"w{i}" for i in range(12)]
    templates = [(f"t{i}", " ".join(rng.sample(words, rng.randrange(1, 9)))) for i in range(12)] + [("empty", "")]
    texts = ["\n".join(" ".join(rng.choices(words, k=rng.randrange(9))) for _ in range(4)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = license_scan.scan_licenses(docs, templates=templates, percent=percent).collect()
    plain = [plain_licenses(t, [x for x in templates if x[1]], percent) for t in texts]
    assert {r.doc_id: (r.labels, r.score) for r in found} == {i: (p[5], p[6]) for i, p in enumerate(plain)}


@pytest.mark.parametrize("frame", ["odd", "clashing", "empty"])
def test_notices_on_odd_rows(spark, frame, request):
    docs = request.getfixturevalue(frame)
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = Counter(tuple(r[c] for c in columns) for r in license_scan.scan_licenses(docs).collect())
    assert got == Counter((r.doc_id, *plain_licenses(r.text)) for r in docs.collect())


def test_no_templates_or_phrases(spark, odd):
    assert license_scan.scan_licenses(odd, phrases=(), templates=()).where("labels <> '' OR score > 0").count() == 0
    with pytest.raises(ValueError):
        license_scan.scan_licenses(odd, templates=[("x", " ".join(f"w{i}" for i in range(license_scan.MOST_TEMPLATE_WORDS + 1)))])


def test_license_scan_is_native(spark):
    plan = license_scan.scan_licenses(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert set(Q.QUERIES) >= {"op11_aho_corasick", "op12_rollup_phrases", "op13_license_join"}
