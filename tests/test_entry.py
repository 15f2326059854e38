"""Driver contract and every registered query against its DuckDB oracle
(sf0.001, the same comparison the driver makes at sf0.01)."""

import importlib

import pytest

import oracle_check
from loomlog.plans import catalog

SF = "/root/testdata/sf0.001"


def test_contract_shapes(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.columns == ["ev_type", "cnt"] and df.count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    return oracle_check.duck(SF)


@pytest.mark.parametrize("name", list(catalog.REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    fn, sql = catalog.REGISTRY[name]
    r = oracle_check.compare(spark, duck, name, fn, sql, SF)
    assert r["ok"] is True, r                     # every query has an oracle
    assert r["rows"] > 0
