"""Registered queries against their DuckDB SQL."""

import pytest

import __spark_entry__ as E
from riskweave.llm import queries
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck


def test_one_query_an_operator():
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("key", list(queries.ORACLE))
def test_query_equals_sql(spark, key):
    r = compare(spark, duck(SF_SMALL), key, SF_SMALL)
    assert r["same_cols"], (r["cols"], r["ocols"])
    assert r["same_values"], (r.get("only_spark"), r.get("only_oracle"))
