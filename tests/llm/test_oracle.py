"""The training-data queries that SQL can express, against DuckDB."""

import pytest

import __spark_entry__ as entry_mod
from candela.llm.oracle import ORACLE
from candela.llm.queries import QUERIES
from candela.plans.verify import compare, duckdb_con
from tests.conftest import SF001


def test_all_are_registered_and_oracles_have_queries():
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(QUERIES)
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    res = compare(QUERIES[name](spark, SF001), ORACLE[name], duckdb_con(SF001))
    assert res["ok"] and res["types_match"], res
