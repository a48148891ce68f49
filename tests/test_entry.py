"""Driver contract: entry smoke test and every registered query against its SQL."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_compare import compare, duck

from streamlens.plans.jobs import JOBS

NAMES = sorted(JOBS)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["item_id", "window_end", "count", "rank"]


def test_oracle_keys_subset():
    q, o = set(E.queries()), set(E.oracle_sql())
    assert o <= q
    assert set(NAMES) <= o


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(spark, name, SF001, con)
    assert ok, msg
