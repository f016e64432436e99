"""Every catalogue query equals its SQL twin on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from tests.compare import difference

TWINS = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    if name not in TWINS:
        assert df.count() > 0
        return
    assert difference(duck, df, TWINS[name]) is None


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
