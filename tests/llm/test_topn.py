import random

import numpy as np
import pytest

from cohortqc.llm import topn as T
from tests.util import rows

SCHEMA = "line_no long, data_sample string, microarray_sample string, score double, grp string, item int, ident string, place int"


def run(spark, data, n=3):
    return rows(T.best_arrays(spark.createDataFrame([(*d, "x", 1, "y", 2) for d in data], SCHEMA), n), "data_sample", "microarray_sample", "place")


def plain(data, n=3):
    first = {}
    for line, d, m, score in data:
        if d is not None and m is not None and line is not None:
            key = (d.strip().upper(), m.strip().upper())
            if key not in first or line < first[key][0]:
                first[key] = (line, score)
    groups = {}
    for (d, m), (line, score) in first.items():
        if score is not None and np.isfinite(score):
            groups.setdefault(d, []).append((score, line, m))
    return sorted(((d, m, k) for d, g in groups.items() for k, (_, _, m) in enumerate(sorted(g)[:n], 1)), key=repr)


@pytest.mark.parametrize("cut", [2_000_000, 100])
@pytest.mark.parametrize("n", [1, 3, 10])
def test_against_sorting(spark, monkeypatch, cut, n):
    monkeypatch.setattr(T, "CUT_ROWS", cut)
    rnd = random.Random(5)
    scores = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 1.0, -1.5, 1e300, -1e-300, 0.25]
    data = [(k, rnd.choice(["hot", "Hot ", f"g{rnd.randint(0, 50)}", None, ""]), rnd.choice([f"a{rnd.randint(0, 400)}", f" A{rnd.randint(0, 400)}", None]), rnd.choice([*scores, rnd.random(), rnd.gauss(0, 1)])) for k in range(4000)]
    assert run(spark, data, n) == plain(data, n)


def test_all_equal_scores(spark):
    data = [(1000 - k, "a", f"m{k}", 0.5) for k in range(500)]
    assert run(spark, data) == [("A", "M497", 3), ("A", "M498", 2), ("A", "M499", 1)]


def test_small_and_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "a", "x", 1.0), (1, "a", "x", 1.0), (None, "a", "y", 0.0)]) == [("A", "X", 1)]
    with pytest.raises(ValueError):
        T.top_n(spark.createDataFrame([], "grp string, item string, score double, ident long"), 0)


def test_codes_keep_order():
    x = np.array([-np.inf, -1e300, -1.0, -1e-320, -0.0, 0.0, 5e-324, 1.0, 1e300, np.inf])
    code = T.ordered_bits(x)
    assert (np.diff(code) >= 0).all() and code[4] == code[5] and len(np.unique(code)) == 9


def test_bisection_kernel():
    rng = np.random.default_rng(1)
    group = rng.integers(0, 40, 5000)
    score, ident = rng.choice([0.0, 0.1, 0.2, 5.0], 5000), rng.permutation(5000) - 2500
    for n in (1, 2, 7, 1000):
        keep = T.bisect_top(group, score, ident, n)
        for g in range(40):
            at = np.flatnonzero(group == g)
            want = at[np.lexsort((ident[at], score[at]))][:n]
            assert set(np.flatnonzero(keep & (group == g))) == set(want)
