import datetime as dt
import math
import random

import pytest

from cohortqc.llm import cutoffs as C
from tests.util import rows

SCHEMA = "row_id long, vid long, rank_id string, is_snv boolean, score double, bin int, loaded_at timestamp_ntz, source string, cutoff int, n int, kept int"
nan = float("nan")


def run(spark, data, targets):
    rf = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in data], SCHEMA)
    tg = spark.createDataFrame([(*t, "y") for t in targets], "rank_id string, var_class string, keep_percent int, score string")
    report, kept = C.keep_share(rf, tg)
    return {(r["rank_id"], r["var_class"]): r for r in report.collect()}, rows(kept, "rank_id", "vid")


def plain(data, targets):
    last = {}
    for row_id, vid, rank, snv, score, _, at in sorted(data, key=lambda d: (d[6] or dt.datetime.min, d[0])):
        last[rank, vid] = (snv, score)
    cut, kept = {}, []
    for rank, kind, keep in targets:
        s = sorted(sc for (r, _), (snv, sc) in last.items() if r == rank and snv is (kind == "snv") and sc is not None and 0 <= sc <= 1)
        cut[rank, kind] = next((c for c in s if 100 * sum(x <= c for x in s) >= keep * len(s)), None)
        kept += [(r, v) for (r, v), (snv, sc) in last.items() if r == rank and snv is (kind == "snv") and sc is not None and cut[rank, kind] is not None and 0 <= sc <= cut[rank, kind]]
    return cut, sorted(kept, key=repr)


@pytest.mark.parametrize("size", [250_000, 50])
def test_against_plain(spark, monkeypatch, size):
    monkeypatch.setattr(C, "ARRAY_SCORES", size)
    rnd = random.Random(4)
    t = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 10**6))
    data = [(k, rnd.randint(0, 900), rnd.choice(["a", "b", "b", "b", "c", None]), rnd.choice([True, True, False, None]), rnd.choice([None, nan, -0.1, 1.1, 0.5, 0.5, round(rnd.random(), 3), rnd.random()]), rnd.randint(1, 100), rnd.choice([None, t(), t()])) for k in range(3000)]
    targets = [("a", "snv", 50), ("a", "indel", 1), ("b", "snv", 100), ("b", "indel", 33), ("c", "snv", 0), ("c", "indel", 99), ("none", "snv", 50)]
    report, kept = run(spark, data, targets)
    cut, want = plain(data, targets)
    assert {k: r["cutoff"] for k, r in report.items()} == cut and kept == want
    assert sum(r["kept"] for r in report.values()) == len(kept)


def test_ties_and_small_sources(spark):
    at = dt.datetime(2024, 1, 1)
    one = [(k, k, "a", True, 0.5, 7, at) for k in range(10)] + [(99, 99, "b", False, 0.0, None, at)]
    report, kept = run(spark, one, [("a", "snv", 10), ("b", "indel", 50), ("b", "snv", 50)])
    assert (report["a", "snv"]["cutoff"], report["a", "snv"]["kept"], report["a", "snv"]["max_bin"]) == (0.5, 10, 7)
    assert (report["b", "indel"]["cutoff"], report["b", "indel"]["kept"]) == (0.0, 1)
    assert (report["b", "snv"]["cutoff"], report["b", "snv"]["n"], report["b", "snv"]["kept"]) == (None, 0, 0) and len(kept) == 11


def test_above_all_and_null_targets_and_empty(spark):
    at = dt.datetime(2024, 1, 1)
    report, kept = run(spark, [(1, 1, "a", True, 0.5, 7, at)], [("a", "snv", 101), ("a", None, 5), (None, "snv", 5)])
    assert report["a", "snv"]["cutoff"] is None and kept == []
    report, kept = run(spark, [], [("a", "snv", 50)])
    assert report["a", "snv"]["cutoff"] is None and kept == []
    assert run(spark, [(1, 1, "a", True, 0.5, 7, at)], []) == ({}, [])


def test_share_is_exact():
    # 29 percent of 100 as a float product is above 29
    assert math.ceil(C.Fraction(29) * 100 / 100) == 29
