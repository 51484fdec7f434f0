"""Every query against its SQL twin.  Small tables everywhere; the middle size where the small one has no overlaps."""

import pytest

import __spark_entry__ as entry
from eavesgrid.plans.oracles import ORACLES
from eavesgrid.plans.queries import QUERIES
from oracle_check import check, duck

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SQL = ORACLES


@pytest.fixture(scope="module")
def small():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_small(spark, small, name):
    if name in ("self_overlap_pairs", "pair_dedup", "connected_components", "merge_overlaps"):
        pytest.skip("no overlaps at this size")
    assert check(spark, small, name, QUERIES[name], SQL.get(name), SMALL) is None


@pytest.mark.parametrize("name", ["self_overlap_pairs", "pair_dedup", "connected_components", "merge_overlaps", "merge_overlapped"])
def test_overlaps(spark, name):
    assert check(spark, duck(MIDDLE), name, QUERIES[name], SQL[name], MIDDLE) is None


def test_all_have_twins():
    assert set(QUERIES) == set(SQL)


def test_entry_has_all_of_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
