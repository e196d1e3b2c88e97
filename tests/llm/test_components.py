import random

import numpy as np
import pyarrow as pa
import pytest

from cohortqc.llm import components as C
from tests.util import rows


def plain(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {v: find(v) for v in parent}


def run(spark, pairs, **kw):
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in pairs], "a string, b string, v int, root string")
    return dict(rows(C.connected_groups(df, **kw)))


def shapes():
    rnd = random.Random(1)
    n = [f"n{k:03d}" for k in range(400)]
    path = list(zip(n, n[1:], strict=False))
    rnd.shuffle(path)
    yield "path", path
    yield "star", [("hub", x) for x in n]
    yield "random", [(rnd.choice(n), rnd.choice(n)) for _ in range(300)]
    yield "clique and copies", [(a, b) for a in n[:25] for b in n[:25]] * 2
    yield "dirt", [(None, "a"), ("a", None), (None, None), ("b", "b"), ("", "é"), ("é", "🧬"), ("z", "Z")]
    yield "self only", [("b", "b")]
    yield "empty", []


@pytest.mark.parametrize("name", [n for n, _ in shapes()])
def test_against_plain(spark, name):
    pairs = dict(shapes())[name]
    assert run(spark, pairs) == plain(pairs)


def test_fine_grids(spark):
    named = dict(shapes())
    for name in ("path", "star"):
        assert run(spark, named[name], cell_edges=60) == plain(named[name]), name


def test_hot_parents_and_cut_cells(spark, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_PARENTS", 5)
    monkeypatch.setattr(C, "HOT_CHILDREN", 50)
    named = dict(shapes())
    for name in ("path", "star"):
        assert run(spark, named[name], cell_edges=120, min_blocks=2) == plain(named[name]), name


def test_parts_of_a_cell_stay_apart():
    cols = {"cell": [1, 1, 1, 2], "part": pa.array([0, 0, 1, 0], pa.int32()), "a": ["a", "b", "a", "a"], "b": ["b", "c", "z", "q"]}
    table = pa.table(cols)
    for size in (1, 2, 4):
        got = [tuple(r.values()) for b in C._cells(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert got == [("a", "a"), ("b", "a"), ("c", "a"), ("a", "a"), ("z", "a"), ("a", "a"), ("q", "a")]


def test_local_union_find():
    rng = np.random.default_rng(2)
    for n in (1, 2, 50, 400):
        u, v = rng.integers(0, n, n), rng.integers(0, n, n)
        want = plain([(int(a), int(b)) for a, b in zip(u, v, strict=True)])
        got = C.local_roots(u, v, n)
        assert all(got[k] == want.get(k, k) for k in range(n))
    chain = np.arange(5000)
    assert (C.local_roots(chain[:-1], chain[1:], 5000) == 0).all()


def test_links(spark):
    data = [("a ", "B", 0.2), ("B", "c", 0.125), ("b", "A", None), ("c", "C ", 0.9), ("d", "e", float("nan")), ("e", "f", 0.3), ("E", "F", 0.0), (None, "x", 1.0)]
    df = spark.createDataFrame(data, "i string, j string, kin double")
    assert rows(C.related_samples(df)) == [("A", "A"), ("B", "A"), ("E", "E"), ("F", "E")]
