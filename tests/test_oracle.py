"""Every query of the library proper against its SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest

from cohortqc.plans import cohort_queries, domain_queries, general, io_queries, kernel_queries
from tests.util import DATA, same

MODULES = (cohort_queries, domain_queries, general, kernel_queries, io_queries)
CASES = [(m, n) for m in MODULES for n in m.QUERIES if n in m.SQL]
PLAIN = [(m, n) for m in MODULES for n in m.QUERIES if n not in m.SQL]
data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not there")


@data
@pytest.mark.parametrize("module,name", CASES, ids=[n for _, n in CASES])
def test_equal(spark, module, name):
    same(spark, module.QUERIES[name], module.SQL[name])


@data
@pytest.mark.parametrize("module,name", PLAIN, ids=[n for _, n in PLAIN])
def test_runs(spark, module, name):
    assert module.QUERIES[name](spark, DATA).count() > 0


def test_entry_needs_no_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and 'p1_found' in q"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
