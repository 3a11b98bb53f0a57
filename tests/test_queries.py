"""Every query against its SQL twin on the smallest tables; the rest must return rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import duck, duck_rows, spark_rows

SLOW = {"daily_job", "community_job"}  # covered by test_jobs


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, sf, con, name):
    assert spark_rows(queries()[name](spark, sf)) == duck_rows(con, oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_runs(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["url", "cluster", "first_layer"] and df.count() == 200
