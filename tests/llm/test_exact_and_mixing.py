"""Exact copies, mixing, quality rules and line deduplication against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eavesgrid.llm import exact_dedup, line_dedup, mixing, quality

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_exact_groups(odd):
    got = rows_of(exact_dedup.exact_groups(odd, support=0.2))
    rows = odd.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(UPPER)].append(r.doc_id)
    assert len(got) == len(rows)
    for text, ids in groups.items():
        mine = [g for g in got if g["text_sha256"] == sha(text)]
        best = max((i for i in ids if i is not None), default=None)
        assert Counter(g["doc_id"] for g in mine) == Counter(ids)
        assert {g["keep_id"] for g in mine} == {best} and {g["group_size"] for g in mine} == {len(ids)}
        assert [g["doc_id"] for g in mine if g["kept"]] == [best]


@pytest.mark.parametrize("support", [0.3, 0.01])
def test_hot_and_cold_digests_agree(spark, support):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("t"), F.col("id") % 90)).alias("text"))
    got = exact_dedup.exact_groups(docs, support=support)
    assert got.where("kept").count() == got.select("text_sha256").distinct().count()
    assert got.where("text_sha256 = sha2('hot', 256)").select("keep_id", "group_size").distinct().collect() == [(399, 134)]


def test_drop_exact_copies_keeps_columns(clashing, empty):
    kept = exact_dedup.drop_exact_copies(clashing)
    assert kept.columns == clashing.columns
    assert kept.count() == exact_dedup.exact_groups(clashing).where("kept").count()
    assert exact_dedup.drop_exact_copies(empty).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0


def plain_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not full:
            target.update({s: weight[s] * level for s in open_})
            break
        target.update({s: 2.0 * sizes[s] for s in full})
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def check_mixture(docs):
    got = rows_of(mixing.mixture(docs))
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    target = plain_targets(sizes)
    taken, largest = Counter(), Counter()
    for g in got:
        assert g["target"] == pytest.approx(target[g["source"]]) and g["source_size"] == sizes[g["source"]]
        assert g["taken"] <= 2 * g["size"]
        taken[g["source"]] += g["taken"]
        largest[g["source"]] = max(largest[g["source"]], g["size"])
    assert len(got) == docs.count()
    assert sum(taken.values()) <= sum(target.values()) + 1e-6
    return taken, target, largest


def test_mixture(corpus, odd, empty):
    taken, target, largest = check_mixture(corpus)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] + 1
    check_mixture(odd)
    assert mixing.mixture(empty).count() == 0
    assert mixing.mixture(odd.where("text is null")).select("taken", "target").collect() == [(0, 0.0)]


def test_mixture_is_repeatable_and_takes_documents(corpus, clashing):
    first = sorted(map(tuple, mixing.mixture(corpus).collect()))
    assert first == sorted(map(tuple, mixing.mixture(corpus.repartition(5)).collect()))
    times = Counter(r.doc_id for r in mixing.mixed_documents(corpus).select("doc_id").collect())
    assert times == Counter({r.doc_id: r.taken // r.size for r in mixing.mixture(corpus).where("taken > 0").collect()})
    assert mixing.mixed_documents(clashing).columns == clashing.columns


def plain_quality(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


@pytest.mark.parametrize("name", ["odd", "corpus", "clashing"])
def test_quality_metrics(name, request):
    docs = request.getfixturevalue(name)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = Counter((r.doc_id, *[r[c] for c in columns]) for r in quality.judge_quality(docs).collect())
    assert got == Counter((r.doc_id, *plain_quality(r.text or "")) for r in docs.collect())


def test_quality_repeats_ties_and_overlaps(spark):
    texts = ["a b c d e a b c d e", "a a a a a a a a", "x " * 300, "p q r s t u\nz p q r s t", "1 2 3 4"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    got = {r.doc_id: r.n_repeat_words for r in quality.judge_quality(docs).collect()}
    assert got == {i: plain_quality(t)[4] for i, t in enumerate(texts)}


def test_depleted_documents_go(spark, empty):
    own = "these are ten words that only this document number {} has"
    common = "this same line stands on every page of the host and says nothing new at all, nothing\n" * 3
    rows = [(i, (common if i < 60 else "") + own.format(i), "h1") for i in range(80)] + [(100 + i, common + own.format(0), "h2") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.kept, r.lost_chars > 0) for r in quality.judge_quality(docs, limit=50).collect()}
    assert all(lost == (i < 60) for i, (_, lost) in got.items())  # copies of one text count once in h2
    assert quality.judge_quality(empty).count() == 0
    menu = " ".join(f"item{k}" for k in range(60)) + "\n"
    rows = [(i, (menu if i < 11 else "") + own.format(i), host) for host, n in (("many", 30), ("few", 10)) for i in range(n)]
    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, source string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge_quality(docs, limit=10).collect()}
    assert got == {i: (False, not (i < 11)) for i in range(40)}  # depleted documents are rejected, whatever the size of their host


def test_a_line_in_more_than_ten_texts_of_its_host_goes(spark, tmp_path):
    """By default and in SQL alike, for small and large hosts."""
    import duckdb

    from eavesgrid.llm.queries import ORACLES, op5_line_frequency

    menu = " ".join(f"item{k}" for k in range(60)) + "\n"
    own = "these are ten words that only this document number {} has"
    hosts = [("small", 12, 11), ("large", 400, 11), ("rare", 12, 10)]
    rows = [((menu if i < with_menu else "") + own.format(f"{host}{i}"), host) for host, n, with_menu in hosts for i in range(n)]
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    result = op5_line_frequency(spark, str(tmp_path))
    got = {tuple(r) for r in result.collect()}
    assert {r[0] for r in got if not r[-1]} == {i for i, (text, host) in enumerate(rows) if text.startswith("item") and host != "rare"}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert {tuple(r) for r in con.execute(f"SELECT {', '.join(result.columns)} FROM ({ORACLES['op5_line_frequency']})").fetchall()} == got


def plain_lines(rows, limit):
    found = defaultdict(set)
    strip = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    for i, r in enumerate(rows):
        for line in (r.text or "").split("\n"):
            found[strip(line)].add((r.doc_id, r.text or ""))
    gone = {k for k, docs in found.items() if k and len(docs) >= limit}
    out = []
    for r in rows:
        lines = (r.text or "").split("\n")
        left = [x for x in lines if strip(x) not in gone]
        out.append((r.doc_id, len(lines), len(lines) - len(left), sha("\n".join(left))))
    return Counter(out)


@pytest.mark.parametrize(("name", "limit"), [("odd", 2), ("odd", 10), ("corpus", 3), ("corpus", 10)])
def test_line_bitmaps(name, limit, request):
    docs = request.getfixturevalue(name).select("doc_id", "text")
    got = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, limit=limit), with_text=False)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got.collect()) == plain_lines(docs.collect(), limit)


def test_line_bitmaps_across_partitions(spark):
    """A line that all documents have runs through several range partitions."""
    rows = [(i, f"Hot\nown {i}\nhot " + "\nrare" * (i % 50 == 0)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs, limit=61))
    got = {r.doc_id: (r.text, r.n_dropped) for r in kept.collect()}
    assert got == {i: (f"own {i}" + "\nrare" * (i % 50 == 0), 2) for i in range(3000)}


def test_lines_of_empty_and_clashing(empty, clashing):
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0
    out = line_dedup.apply_bitmaps(clashing, line_dedup.keep_bitmaps(clashing, limit=2))
    assert out.count() == clashing.count() and "a" in out.columns
    assert out.where("doc_id = 1").first().n_dropped == 2
