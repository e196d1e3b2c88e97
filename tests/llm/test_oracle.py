"""Queries of the subpackage against their SQL on the smallest tables; the others must run."""

import os

import pytest

from cohortqc.llm import queries
from tests.util import DATA, same

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not there")


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.SQL])
def test_equal(spark, name):
    same(spark, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
