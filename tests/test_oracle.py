"""Every query with an oracle: Spark result == DuckDB result on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from cohortlens.plans.registry import QUERIES as REGISTERED  # noqa: E402

from conftest import SF001  # noqa: E402

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF001).toPandas()
    dk = con.execute(ORACLE[name]).fetchdf()
    assert compare(sp, dk) is None


@pytest.mark.parametrize("name", sorted(set(REGISTERED) - set(ORACLE)))
def test_query_without_sql_runs(spark, name):
    df = REGISTERED[name](spark, SF001)
    assert df.toPandas().dropna(how="all").shape[0] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 9 and "median" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())
