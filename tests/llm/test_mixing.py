import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortqc.llm import mixing as M
from tests.util import rows

SCHEMA = "doc_id long, source string, tokens long, docs int, extra string, luck int"
TARGETS = "source string, target_share double, max_repeats int, tokens int"


def run(spark, data, targets, **kw):
    sizes = spark.createDataFrame([(*d, 1, "x", 2) for d in data], SCHEMA)
    used, report = M.mix_sources(sizes, spark.createDataFrame([(*t, 5) for t in targets], TARGETS), **kw)
    return {r["doc_id"]: (r["source"], r["tokens"], r["copies"]) for r in used.collect()}, {r["source"]: r for r in report.collect()}


def test_knapsack_against_all_choices():
    rnd = random.Random(8)
    for _ in range(200):
        lengths = np.array(sorted(rnd.sample(range(1, 30), rnd.randint(1, 4))))
        counts = np.array([rnd.randint(0, 4) for _ in lengths])
        budget = rnd.randint(0, 80)
        best = max(s for c in itertools.product(*[range(k + 1) for k in counts]) if (s := int((np.array(c) * lengths).sum())) <= budget)
        got = M.knapsack(lengths, counts, budget)
        assert (got >= 0).all() and (got <= counts).all() and int((got * lengths).sum()) == best


def test_choose_is_exact_and_proportional():
    rng = np.random.default_rng(9)
    lengths, counts = np.arange(20, 1500, 7), rng.integers(1, 400, len(range(20, 1500, 7)))
    total = int((lengths * counts).sum())
    for budget in (total // 3, total // 7 + 1, total - 13, total, total + 5, 0):
        take = M.choose(lengths, counts, budget)
        assert (take <= counts).all() and abs(int((lengths * take).sum()) - min(budget, total)) <= 13
        if budget == total // 3:
            assert int((lengths * take).sum()) == budget and np.abs(take / counts - 1 / 3)[counts > 100].max() < 0.2


def test_budgets():
    got = M.budgets({"a": 100, "b": 1000, "c": 0}, {"a": (Fraction(1, 2), 2), "b": (Fraction(1, 4), 1), "c": (Fraction(1, 4), 3)})
    assert got == {"a": 200, "b": 100}
    assert M.budgets({"a": 100}, {"a": (Fraction(1), 3)}, 50) == {"a": 50} and M.budgets({}, {"a": (Fraction(1), 3)}) == {}


@pytest.mark.parametrize("bucket", [20_000, 10])
def test_shares_are_reached(spark, monkeypatch, bucket):
    monkeypatch.setattr(M, "BUCKET_DOCS", bucket)
    rnd = random.Random(10)
    data = [(k, rnd.choice(["a", "a", "b", "c", "d", None]), rnd.choice([None, 0, 50, 50, 50, rnd.randint(1, 400)])) for k in range(3000)]
    targets = [("a", 0.2, 1), (" B ", 0.3, 2), ("c", 0.5, 3), ("absent", 0.0, 2)]
    used, report = run(spark, data, targets)
    total = sum(t * c for _, t, c in used.values())
    size = {d[0]: d for d in data}
    for s, share, most in (("a", 0.2, 1), ("b", 0.3, 2), ("c", 0.5, 3)):
        own = [(k, t, c) for k, (src, t, c) in used.items() if src == s]
        assert all(1 <= c <= most and size[k][1] == s and size[k][2] == t for k, t, c in own)
        assert abs(sum(t * c for _, t, c in own) / total - share) < 1e-4
        assert report[s]["tokens"] == report[s]["budget"] == sum(t * c for _, t, c in own) and abs(report[s]["actual_share"] - share) < 1e-4
    assert report["absent"]["tokens"] == 0 and not any(src in ("d", None) for src, _, _ in used.values())
    limit = min(most * sum(t for _, x, t in data if x == s and t) / share for s, share, most in (("a", 0.2, 1), ("b", 0.3, 2), ("c", 0.5, 3)))
    assert total > 0.999 * limit


def test_seed_and_total(spark):
    data = [(k, "a", 10) for k in range(100)]
    one, _ = run(spark, data, [("a", 1.0, 1)], total=300, seed=1)
    again, _ = run(spark, data[::-1], [("a", 1.0, 1)], total=300, seed=1)
    other, _ = run(spark, data, [("a", 1.0, 1)], total=300, seed=2)
    assert len(one) == 30 and one == again and one != other


def test_empty(spark):
    used, report = run(spark, [], [("a", 1.0, 1)])
    assert used == {} and report["a"]["tokens"] == 0 and report["a"]["actual_share"] is None
    used, report = run(spark, [(1, "a", 5)], [])
    assert used == {} and report == {}
    used, report = run(spark, [(1, "a", 5)], [("a", None, None)])
    assert used == {} and report["a"]["budget"] == 0


def test_repeated_rows(spark):
    sizes = spark.createDataFrame([(1, "a", 5)] * 4, "doc_id long, source string, tokens long")
    used, report = M.mix_sources(sizes, spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int"))
    assert rows(used, "copies") == [(2,)] * 4


def test_audit_finds_faults(spark):
    data = [(k, "ab"[k % 2], 10 + k % 5) for k in range(200)]
    sizes = spark.createDataFrame(data, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.7, 1), ("b", 0.3, 2), ("c", 0.0, 1)], "source string, target_share double, max_repeats int")
    used, report = M.mix_sources(sizes, targets)
    marks = ("docs_unique", "repeats_kept", "budget_kept", "share_kept")
    assert rows(M.audit(used, report, sizes), *marks) == [(True,) * 4] * 3
    less = used.where("doc_id <> 0")
    found = {r["source"]: tuple(r[m] for m in marks) for r in M.audit(less, report, sizes).collect()}
    assert found["a"] == (True, True, False, True) and found["b"] == (True,) * 4
    twice = used.unionByName(used.where("source = 'b'").limit(1)).withColumn("copies", F.col("copies") + (F.col("source") == "b").cast("int") * 2)
    found = {r["source"]: tuple(r[m] for m in marks) for r in M.audit(twice, report, sizes).collect()}
    assert found["b"][:2] == (False, False)
