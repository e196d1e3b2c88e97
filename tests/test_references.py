import datetime as dt

import pytest

from cohortqc.operators import references as R
from tests.util import rows

D = lambda y, m=1, d=1, h=0: dt.datetime(y, m, d, h)
REF = "record_id long, pat_id string, recorded_at timestamp_ntz, loaded_at timestamp_ntz, extra string, target string, t string"
TGT = "s string, arrived_at timestamp_ntz, removed_at timestamp_ntz, ref_key int"


def find(spark, refs, targets, **kw):
    r = spark.createDataFrame([(*x, "x", "y", "z") for x in refs], REF)
    t = spark.createDataFrame([(*x, 1) for x in targets], TGT)
    return R.orphan_references(R.references(r, "pat_id", "samples"), R.target_rows(t, "s", "samples"), **kw)


REFS = [
    (1, "A", D(2024, 2), D(2024, 2)), (2, " a ", None, D(2024, 3)), (3, "B", D(2024, 1, 1), D(2024, 2)), (4, "C", D(2024, 5), D(2024, 5)), (5, "D", D(2023, 6), D(2023, 6)),
    (6, None, D(2024), D(2024)), (7, "", D(2024), D(2024)), (8, "0", D(2024), D(2024)), (9, " na", D(2024), D(2024)), (10, "C", D(2024, 3), D(2024, 3)), (11, "E", D(2024), D(2024)),
    (12, "X", None, None), (13, "A", None, None), (4, "C", D(2024, 5), D(2024, 5)),
]
TARGETS = [
    ("a", D(2024), None), ("A", D(2024), None), ("C", D(2024, 1), D(2024, 2)), ("c ", D(2024, 2), D(2024, 4)), ("C", D(2024, 6), None), ("D", D(2023, 6, 2), None), ("D", D(2023, 7), None),
    ("E", D(2024, 2), D(2024, 1)), ("E", D(2023), D(2024)), ("B", D(2024, 1, 1), D(2024, 1, 1)), (None, D(2024), None),
]
WANT = [
    ("pat_id", 12, "missing", None), ("pat_id", 13, "deleted", None), ("pat_id", 3, "deleted", "2024-01"), ("pat_id", 4, "deleted", "2024-05"), ("pat_id", 4, "deleted", "2024-05"),
    ("pat_id", 5, "late", "2023-06"), ("pat_id", 11, "deleted", "2024-01"),
]


@pytest.mark.parametrize("kw", [{}, {"heavy_min": 0, "heavy_keys": 1024}, {"heavy_min": 0, "heavy_keys": 1024, "broadcast_spans": 0}])
def test_cases(spark, kw):
    assert rows(find(spark, REFS, TARGETS, **kw)) == sorted(WANT, key=repr)


def test_mixed_group(spark):
    # one key and month with records before, inside and after the only span
    refs = [(k, "A", D(2024, 1, d), D(2024)) for k, d in enumerate((1, 10, 20, 30))]
    got = find(spark, refs, [("A", D(2024, 1, 5), D(2024, 1, 20))])
    assert rows(got, "record_id", "reason") == [(0, "late"), (2, "deleted"), (3, "deleted")]


def test_empty(spark):
    assert find(spark, [], TARGETS).count() == 0
    assert rows(find(spark, [(1, "A", D(2024), D(2024))], []), "record_id", "reason") == [(1, "missing")]


def test_undated_target(spark):
    got = find(spark, [(1, "A", D(2024), D(2024))], [("A", None, None), ("A", D(2025), None)])
    assert rows(got, "reason") == [("deleted",)]


def test_report(spark):
    got = R.orphan_report(find(spark, REFS, TARGETS))
    assert ("pat_id", "2024-05", "deleted", 2) in rows(got)
