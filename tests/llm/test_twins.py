"""The queries with a DuckDB twin, side by side on whole tables."""

import pytest

import compare
from topicloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, sf, name):
    con = compare.duck(sf)
    assert compare.spark_rows(queries.QUERIES[name](spark, sf)) == compare.duck_rows(con, queries.ORACLES[name])
