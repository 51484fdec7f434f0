"""The n-gram join, repeated passages, packing and URL rules against brute force and round trips."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavesgrid.llm import arrays, ngram_join, packing, repeats, suffix_array, url_filter
from eavesgrid.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(UPPER))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_groups(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    common = Counter((i, j) for ids in holders.values() for k, i in enumerate(ids) for j in ids[k + 1 :])
    for (i, j), n in common.items():
        if 100 * n >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        key = (doc is not None, doc or 0)
        low[find(i)] = min(low.get(find(i), key), key)
    return Counter((d, len(sets[i]), low[find(i)][1] if low[find(i)][0] else None) for i, (d, _) in enumerate(rows))


def near(docs, size, percent):
    return Counter((r.id, r.n_shingles, r.component_id) for r in ngram_join.near_groups(docs, size=size, percent=percent).collect())


@pytest.fixture(scope="module")
def piles(spark):
    """Chains and piles of near copies, and a passage that unlike documents share."""
    random = np.random.default_rng(11)
    word = lambda n: [f"w{x}" for x in random.integers(0, 5000, n)]
    passage, rows = word(60), []
    base = word(120)
    for i in range(60):  # a pile around one text
        copy = list(base)
        for _ in range(random.integers(0, 6)):
            copy[int(random.integers(0, 120))] = f"e{random.integers(0, 999)}"
        rows.append(" ".join(copy))
    chain = word(100)
    for i in range(25):  # each like the next only
        chain = chain[4:] + word(4)
        rows.append(" ".join(chain))
    rows += [" ".join(passage + word(int(n))) for n in random.integers(5, 60, 40)]
    rows += [" ".join(word(int(n))) for n in random.integers(1, 9, 30)] + ["A b c d", "a B c d", "a b c", "a b c", "", " \n"]
    order = random.permutation(len(rows))
    return spark.createDataFrame([(int(k), rows[i]) for k, i in enumerate(order)], "doc_id long, text string").repartition(5).cache()


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_near_groups(piles, corpus, size, percent):
    for docs in (piles, corpus)[: 1 + (size == 5)]:
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert near(docs, size, percent) == plain_groups(rows, size, percent)


def test_near_groups_whatever_the_order(piles, monkeypatch):
    rows = [(r.doc_id, r.text) for r in piles.collect()]
    want = plain_groups(rows, 4, 85)
    monkeypatch.setattr(ngram_join, "SAMPLE", 1)
    monkeypatch.setattr(ngram_join, "HOT_IN_SAMPLE", 2)
    assert near(piles, 4, 85) == want
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", 0)
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    assert near(piles, 4, 85) == want


def test_near_groups_of_odd_rows(odd, clashing, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert near(odd, 5, 80) == plain_groups(rows, 5, 80)
    assert ngram_join.near_groups(empty).count() == 0
    kept = ngram_join.drop_near_copies(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == ngram_join.near_groups(clashing).where("stays").count()


def test_sketch_never_underrates():
    random = np.random.default_rng(2)
    for _ in range(200):
        pool = random.integers(0, 1 << 62, 400, dtype=np.int64).astype(np.uint64)
        a, b = (np.unique(random.choice(pool, int(random.integers(1, 300)))) for _ in range(2))
        assert len(np.intersect1d(a, b)) <= ngram_join.sketch_overlap(ngram_join.sketch(a), ngram_join.sketch(b), len(a), len(b))


def test_words_and_lines_on_arrays():
    import pyarrow as pa

    texts = ["A b\tc\n", "", None, "  x  ", "é　ü a", "\n\n", "b\n a \x0b"]
    data, starts = arrays.buffer_of(pa.array(texts).slice(0))
    words, counts = arrays.word_hashes(data, starts)
    plain = [WORD.findall((t or "").translate(UPPER)) for t in texts]
    assert counts.tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert len({(w, int(h)) for w, h in zip(flat, words, strict=True)}) == len(set(flat)) == len(set(words.tolist()))
    begin, end, n = arrays.line_spans(data, starts)
    lines = [x.strip(" \t\n\x0b\x0c\r").encode() for t in texts for x in (t or "").split("\n")]
    assert [data[a:b].tobytes() for a, b in zip(begin, end, strict=True)] == lines
    assert n.tolist() == [(t or "").count("\n") + 1 for t in texts]


def plain_repeats(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        body = text.encode()
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            window = body[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out[doc] = (len(body), [(int(a), int(b)) for a, b in edges.reshape(-1, 2)], bytes(np.frombuffer(body, np.uint8)[~gone]))
    return out


def found_repeats(docs, length):
    return {r.doc_id: (r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in repeats.remove_repeats(docs, length=length).collect()}


@pytest.fixture(scope="module")
def passages(spark):
    random = np.random.default_rng(4)
    letters = list("abcdé \n")
    make = lambda n: "".join(random.choice(letters, n))
    shared = [make(90) for _ in range(3)]
    rows = [make(int(random.integers(0, 150))) + shared[i % 3] * (i % 4) + make(int(random.integers(0, 80))) for i in range(50)]
    rows += ["ab" * 200, "a" * 333, "", shared[0], shared[0]]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4).cache()


@pytest.mark.parametrize("length", [20, 100])
def test_repeats(passages, length):
    assert found_repeats(passages, length) == plain_repeats([(r.doc_id, r.text) for r in passages.collect()], length)


def test_repeats_by_single_windows_and_parts(passages, monkeypatch):
    monkeypatch.setattr(repeats, "MOST_KINDS", 1)
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    assert found_repeats(passages, 30) == plain_repeats([(r.doc_id, r.text) for r in passages.collect()], 30)


def test_parts_of_long_texts_hold_every_window_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(repeats, "PART_BYTES", 64)
    column = pa.array([b"x" * 500, b"", b"abc" * 30])
    windows = Counter()
    for first, left_out, data, starts in repeats._parts(column, 20):
        row, at, _, _ = repeats.segments(data, starts, 20)
        for r, a in zip(row, at, strict=True):
            windows.update((first + int(r), left_out + (int(a) >> 9) + i) for i in range(int(a) & 255))
    assert windows == Counter((r, i) for r, v in enumerate(column.to_pylist()) for i in range(len(v) - 19))


def test_repeats_of_odd_rows(odd, empty):
    out = repeats.remove_repeats(odd).collect()
    assert len(out) == odd.count()
    assert next(r for r in out if r.doc_id == 7).n_bytes > 10 * len(next(r for r in out if r.doc_id == 7).kept)
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("few", [512, 0])
def test_suffix_arrays(few, monkeypatch):
    monkeypatch.setattr(suffix_array, "FEW_LETTERS", few)
    random = np.random.default_rng(1)
    for _ in range(300):
        s = np.append(random.integers(1, int(random.integers(2, 6)), int(random.integers(0, 70))), 0)
        text = s.tolist()
        order = suffix_array.suffix_array(s, int(s.max()) + 1)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        shared = suffix_array.common_prefixes(s.astype(np.uint8), order, 20)
        for a, b in zip(order[1:].tolist(), order[:-1].tolist(), strict=True):
            n = 0
            while n < 20 and max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            assert shared[a] == n


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def check_pieces(pieces, texts, tokenizer):
    """Every id of every document is in one piece, pieces fill their windows without gaps."""
    want = Counter()
    for doc, text in texts:
        want[doc, np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    windows, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length * 4 == len(p.ids) > 0
        windows[p.sequence_id].append((p.offset, p.length))
        docs[p.doc_id].append((p.start, bytes(p.ids), p.doc_tokens))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for doc, ids in want:
        if sum(d == doc for d, _ in want) == 1 and want[doc, ids] == 1:
            assert b"".join(x for _, x, _ in sorted(docs[doc])) == ids and {n for _, _, n in docs[doc]} == {len(ids) // 4}
    assert sum(p.length for p in pieces) == sum(len(ids) // 4 * n for (_, ids), n in want.items())
    return [sum(n for _, n in parts) for parts in windows.values()]


def test_packing_round_trip(corpus, odd, empty, tokenizer):
    for docs in (corpus, odd):
        pieces = packing.pack_documents(docs, tokenizer_path()).collect()
        fills = check_pieces(pieces, [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
        assert sum(2048 - f for f in fills if f & (f - 1)) == 0
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_checksum_is_of_the_ids(corpus):
    piece = packing.pack_documents(corpus, tokenizer_path()).withColumn("c", F.crc32("ids")).first()
    assert piece.c == zlib.crc32(bytes(piece.ids))


def test_words_tokenize_like_texts(tokenizer):
    mine = packing.WordTokenizer(tokenizer.to_str())
    random = np.random.default_rng(6)
    letters = [chr(c) for c in (*range(32, 600), 9, 10, 0x300, 0x301, 0x3A3, 0x130, 0xAC00, 0x1100, 0x1161, 0x200B, 0x3000)]
    texts = ["".join(random.choice(letters, 60)) for _ in range(400)] + ["", " ", "<|endoftext|> a", "I'm don't 's", "x" * 300, "Å, K. Σ, ΑΣ.", "a., b,. c.."]
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_sum_of_squares_levels():
    packer = packing.SquaresPacker(window=10)
    piece = lambda n: b"\0\0\0\0" * n
    assert list(packer.add(1, piece(6))) == [] and packer.counts[6] == 1
    done = list(packer.add(2, piece(4)))  # finishing a window lowers the sum, opening one raises it
    assert [[p[0] for p in w] for w in done] == [[1, 2]] and packer.counts.sum() == 0
    random = np.random.default_rng(0)
    for i in range(300):  # always the level with the least sum of squares
        size = int(random.integers(1, 10))
        counts = packer.counts.copy()
        sums = {}
        for h in [0, *np.flatnonzero(counts)]:
            if h + size <= 10:
                after = counts.copy()
                after[h] -= h > 0
                after[h + size] += h + size < 10
                sums[int(h)] = int((after**2).sum())
        assert sums[packer.level_for(size)] == min(sums.values())
        list(packer.add(i, piece(size)))
    left = list(packer.pour())
    assert all(sum(len(p[2]) for p in w) // 4 in (1, 2, 4, 8, 10) for w in left)


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def plain_verdict(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m.group(1).translate(UPPER), m.group(2)) if m else ("", "")
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.net/en/", "http://example.net/en", "http://example.net", "http://x.net/?q=/en/", "ftp://b.example.com/de/x#y",
    "http://example.com/fr/", "http://w.org/fr/://x.net/", "http://notexample.com/de/", "no scheme", "", None, "://net/", "http://net/a", "http://NET", "http://a.b.c.org/fr/\nx",
    "http://org/fr", "http://.net/", "http://example.com./de/", "http:///de/", "http://é.net/ü/en/",
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], "page_id long, url string").withColumn("rule", F.lit("own"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {i: plain_verdict(u, RULES) for i, u in enumerate(URLS * 2)}
    assert url_filter.judge_urls(pages.where("false"), rules).count() == 0
    none = url_filter.judge_urls(pages, rules.where("false"))
    assert none.select("rule", "verdict").distinct().collect() == [(None, "allow")]


@pytest.mark.parametrize("most_keys", [1_000_000, 300])
def test_cascade_is_exact(spark, most_keys):
    universe = spark.range(20_000).select(F.concat(F.lit("host"), "id").alias("key"))
    listed = universe.where("key like '%7'").unionByName(spark.createDataFrame([("elsewhere",), (None,)], "key string"))
    keys = url_filter.build_key_set(listed, universe, most_keys=most_keys)
    assert any(len(c.levels) > 2 for c in keys.parts) or most_keys == 300
    assert universe.where(keys.has(F.col("key")) != F.col("key").like("%7")).count() == 0


def test_filters_of_a_short_list_stay_small(spark):
    """Two listed keys in a corpus of two million: no level grows with the corpus."""
    universe = spark.range(2_000_000).select(F.concat(F.lit("host"), "id").alias("key"))
    listed = spark.createDataFrame([("host77",), ("host1999999",)], "key string")
    cascade = url_filter.build_cascade(listed, universe)
    most = -(-url_filter.MISTAKES * url_filter.LEAST_KEYS * url_filter.BITS_PER_KEY // 64) * 64
    assert cascade.levels[0].bits <= 512 and all(level.bits <= most for level in cascade.levels[1:])
    assert {r.key for r in universe.where(cascade.has(F.col("key"))).collect()} == {"host77", "host1999999"}
    assert url_filter.first_bits(10**6, 10**12) < 100 * 10**6 and url_filter.first_bits(2, 10**10) < 10**5


def test_hosts_of_many_labels_and_long_paths(spark):
    pages = [(1, "http://" + "a." * 300 + "example.com/de/" + "x" * 5000), (2, "http://" + "y" * 100_000), (3, "://example.com/de/")]
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), rules).collect()}
    assert got == {1: ("example.com/de/", "block"), 2: (None, "allow"), 3: ("example.com/de/", "block")}


def test_filter_queries_run_without_python(spark):
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    plan = url_filter.judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Join" not in plan and "Arrow" not in plan


