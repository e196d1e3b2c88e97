import datetime as dt
import math
import os
import random

import pytest

from cohortqc.llm import percentiles as P
from cohortqc.llm import queries
from tests.util import DATA, rows

SCHEMA = "s string, load_day date, dp int, gq int, hetab double, grp int, day string, n int, code int"
nan = float("nan")


def frame(spark, data):
    return spark.createDataFrame([(*d, 1, "x", 2, 3) for d in data], SCHEMA)


def plain(data, days=None):
    got = {}
    for s, day, dp, gq, ab in data:
        if s is None or (days and (day is None or not days[0] <= day <= days[1])):
            continue
        for m, v in (("dp", dp), ("gq", gq), ("hetab", ab)):
            if v is not None and not (isinstance(v, float) and (math.isnan(v) or math.isinf(v))):
                got.setdefault((s.strip().upper(), m), []).append(v)
    out = {}
    for (s, m), v in got.items():
        v.sort()
        for p in P.PERCENTILES:
            out[s, m, float(p)] = (round(v[max(1, math.ceil(p * len(v) / 100)) - 1], 6), len(v))
    return out


def table(df):
    return {(r["s"], r["measure"], r["percentile"]): (round(r["value"], 6), r["n"]) for r in df.collect()}


def sample(seed=1, n=3000):
    rnd = random.Random(seed)
    day = lambda: rnd.choice([None, *[dt.date(2024, 1, d) for d in range(1, 11)]])
    who = lambda: rnd.choice(["hot", " Hot", "HOT ", "hot", f"s{rnd.randint(0, 30)}", None])
    return [(who(), day(), rnd.choice([None, 0, rnd.randint(0, 60), 2**31 - 1, -(2**31), 7]), rnd.choice([None, rnd.randint(0, 99)]), rnd.choice([None, nan, float("inf"), round(rnd.random(), 6), 0.5, -0.25])) for _ in range(n)]


@pytest.mark.parametrize("hot", [(1_000_000, 1_000_000), (50, 1_000_000), (50, 60)])
def test_against_sorting(spark, monkeypatch, hot):
    monkeypatch.setattr(P, "HOT_ROWS", hot[0])
    monkeypatch.setattr(P, "HOT_CODES", hot[1])
    data = sample()
    assert table(P.entry_percentiles(frame(spark, data))) == plain(data)


@pytest.mark.parametrize("hot", [(1_000_000, 1_000_000), (50, 1_000_000), (50, 60)])
def test_days_can_be_joined(spark, monkeypatch, hot):
    monkeypatch.setattr(P, "HOT_ROWS", hot[0])
    monkeypatch.setattr(P, "HOT_CODES", hot[1])
    data = sample(2)
    span = (dt.date(2024, 1, 3), dt.date(2024, 1, 6))
    want = plain(data, span)
    assert table(P.entry_percentiles(frame(spark, data), *span)) == want
    days = P.day_counts(frame(spark, data))
    single = [days.where(f"day = date'2024-01-0{d}'") for d in range(3, 7)]
    merged = single[0]
    for d in single[1:]:
        merged = merged.unionByName(d)
    assert table(P.percentiles_of(merged).withColumnRenamed("grp", "s")) == want


def test_error_bound(spark):
    data = [("a", None, 1, 1, x) for x in (0.12345678, 0.12345612, 0.9)]
    r = [r for r in P.entry_percentiles(frame(spark, data)).collect() if r["measure"] == "hetab"]
    exact = {1.0: 0.12345612, 99.0: 0.9}
    assert all(abs(x["value"] - exact[x["percentile"]]) <= x["error_bound"] + 1e-12 for x in r if x["percentile"] in exact)
    assert {x["error_bound"] for x in P.entry_percentiles(frame(spark, data)).collect()} == {0.0, 5e-7}


def test_empty_and_all_missing(spark):
    assert P.entry_percentiles(frame(spark, [])).count() == 0
    got = P.entry_percentiles(frame(spark, [("a", None, None, None, nan), ("b", None, 5, None, None)]))
    assert rows(got, "s", "measure", "percentile", "value")[0][:2] == ("B", "dp") and got.count() == 7


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not there")
def test_summaries_of_all_days_give_the_whole_percentiles(spark):
    cols = ("s", "measure", "percentile", "value", "n")
    assert rows(queries.QUERIES["p3_merged_all_days"](spark, DATA), *cols) == rows(queries.p3_percentiles(spark, DATA), *cols)
