"""The registered corpus queries against their SQL twins, and the pipeline stage by stage."""

from __future__ import annotations

import os
import subprocess
import sys

from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from eavesgrid.llm import line_dedup
from eavesgrid.llm.queries import ORACLES, QUERIES
from oracle_check import check, duck
from test_joins_and_packing import UPPER, check_pieces, plain_groups, tokenizer  # noqa: F401

SMALL = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, name):
    assert check(spark, duck(SMALL), name, QUERIES[name], ORACLES.get(name), SMALL) is None


def test_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and len(QUERIES) == 13
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_stages(spark, odd):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL).cache()
        assert out.columns == docs.columns, name
        if name != "mixing":
            assert out.exceptAll(docs).count() == 0
        else:
            assert out.distinct().exceptAll(docs.distinct()).count() == 0
        seen.append(out.count())
        docs = out
    assert seen[0] >= seen[1] >= seen[2] >= seen[3] > 0.6 * seen[0]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).agg({"doc_tokens": "sum"}).first()[0] > 0


def test_run_against_plain_stages(spark, tokenizer, monkeypatch):  # noqa: F811
    paths, scratch = [], corpus_pipeline.scratch_path
    monkeypatch.setattr(corpus_pipeline, "scratch_path", lambda *args: paths.append(scratch(*args)) or paths[-1])
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    rows = {r.doc_id: tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    stages = [Counter(map(tuple, spark.read.parquet(p).collect())) for p in paths]

    ids = {r.doc_id for r in QUERIES["op2_kneser_ney"](spark, SMALL).where("predicted = 0").collect()}  # scores as given
    assert stages[0] == Counter(rows[i] for i in ids) and len(ids) < len(rows)
    copies = defaultdict(list)
    for i in ids:
        copies[(text[i] or "").translate(UPPER)].append(i)
    ids = {max(group) for group in copies.values()}
    assert stages[1] == Counter(rows[i] for i in ids)
    ids = {i for i, _, component in plain_groups([(i, text[i]) for i in sorted(ids)], 5, 80) if i == component}
    assert stages[2] == Counter(rows[i] for i in ids)
    tables = duck(SMALL)
    tables.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{paths[2]}/*.parquet')")
    taken = tables.sql(ORACLES["op6_fair_queueing"]).select("doc_id, size, taken").fetchall()
    assert stages[3] == Counter({rows[i]: n // size for i, size, n in taken if n})
    check_pieces(pieces, [(i, text[i]) for i, size, n in taken if n for _ in range(n // size)], tokenizer)


@pytest.mark.parametrize("frame", ["odd", "clashing", "empty"])
def test_stages_take_odd_documents(spark, frame, request):
    docs = request.getfixturevalue(frame)
    own = [c for c in docs.columns if docs.count() and docs.first()[c] == f"own {c}"]
    assert len(own) > 10 or frame != "clashing"
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SMALL)
        if name != "packing":
            assert docs.columns == before.columns
            rows = docs.collect()
            assert {r[c] for r in rows for c in own} <= {f"own {c}" for c in own} and all(r[c] == f"own {c}" for r in rows for c in own)
    assert docs.count() >= 0


def test_bitmaps_leave_other_columns_alone(clashing):
    out = line_dedup.apply_bitmaps(clashing, line_dedup.keep_bitmaps(clashing, limit=2)).collect()
    own = [c for c in clashing.columns if clashing.first()[c] == f"own {c}" and c != "n_lines"]
    assert len(out) == clashing.count() and all(r[c] == f"own {c}" for r in out for c in own)


def test_entry_without_the_corpus_package(tmp_path):
    """The other queries stand without this package and the pipeline."""
    for name in os.listdir(ROOT):
        if name not in ("corpus_pipeline.py", "eavesgrid", ".git"):
            os.symlink(os.path.join(ROOT, name), tmp_path / name)
    os.mkdir(tmp_path / "eavesgrid")
    for name in os.listdir(os.path.join(ROOT, "eavesgrid")):
        if name != "llm":
            os.symlink(os.path.join(ROOT, "eavesgrid", name), tmp_path / "eavesgrid" / name)
    os.remove(tmp_path / "__spark_entry__.py")
    with open(os.path.join(ROOT, "__spark_entry__.py")) as f:
        (tmp_path / "__spark_entry__.py").write_text(f.read())
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    n, any_left = out.stdout.split()
    assert int(n) > 50 and any_left == "False"
