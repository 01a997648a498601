"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001)."""

import pytest

import __spark_entry__ as entry_mod
from candela.plans.oracle import ORACLE
from candela.plans.queries import QUERIES
from candela.plans.verify import compare, duckdb_con
from tests.conftest import SF001


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF001)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["Ticker", "avg_close"]
    assert df.count() == 5


def test_every_query_is_registered_and_has_an_oracle_or_is_a_model():
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())
    assert set(QUERIES) - set(ORACLE) <= {"forecast_gbt", "gbt_early_stop_rmse"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF001), ORACLE[name], con)
    assert res["ok"], res


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF001).count() > 0
