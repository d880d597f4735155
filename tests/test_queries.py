"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tablepipe import plans
from tablepipe.plans.oracle import compare, duckdb_views

from .conftest import SF_SMALL

NAMES = sorted(plans.queries())  # the optional subpackage has its own tests


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(plans.oracle_sql()) == set(plans.queries())
    assert set(plans.queries()) <= set(E.queries())


def test_queries_without_the_optional_subpackage(monkeypatch):
    import importlib.util

    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name == "tablepipe.llm" else find(name, *a))
    assert set(E.queries()) == set(E.oracle_sql()) == set(plans.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, con, E.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["p_partkey", "p_name", "p_brand", "size", "retail_price"]
    assert df.count() > 0
