"""Every registered query against its SQL on the smallest tables."""

import os
import re

import pytest

import __spark_entry__ as entry_points
import compare

SF = "/root/testdata/sf0.001"
# The queries of the optional corpus operators have tests of their own.
QUERIES = {n: q for n, q in entry_points.queries().items() if not re.match(r"op\d+_|pipeline$", n)}
ORACLES = {n: q for n, q in entry_points.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    same, message = compare.check(QUERIES[name](spark, SF), con, ORACLES[name])
    assert same, message
