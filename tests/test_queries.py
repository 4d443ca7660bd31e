"""Every registered query gives the rows its SQL gives in DuckDB."""

from __future__ import annotations

import os

import pytest

from tests.compare import difference, duck
from workload.catalog import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    problem, _ = difference(spark, con, FOLDER, QUERIES[name], SQL[name])
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
