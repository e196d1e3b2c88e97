import random

import pytest

from cohortqc.llm import packing as K
from tests.util import rows

SCHEMA = "doc_id long, source string, tokens long, shard int, part string, place int"


def frame(spark, data):
    return spark.createDataFrame([(*d, 1, "x", 2) for d in data], SCHEMA)


def check(data, placed, capacity):
    per, docs = {}, {}
    for r in placed:
        per.setdefault(r["container_id"], []).append(r)
        docs.setdefault(r["doc_id"], []).append(r)
    for items in per.values():
        assert sum(r["tokens"] for r in items) <= capacity
        assert sorted(r["place"] for r in items) == list(range(len(items)))
    for doc, source, tokens in data:
        if not tokens or tokens < 1:
            assert doc not in docs
            continue
        parts = sorted(docs[doc], key=lambda r: r["first_token"])
        assert len(parts) == (1 if tokens <= capacity else -(-tokens // capacity)) and all(r["source"] == source for r in parts)
        end = 0
        for r in parts:
            assert r["first_token"] == end
            end += r["tokens"]
        assert end == tokens
    return len(per), sum(t for _, _, t in data if t and t > 0)


@pytest.mark.parametrize("shard", [10**9, 20_000])
def test_packs_all_and_fills(spark, shard):
    rnd = random.Random(6)
    data = [(k, rnd.choice(["a", "a", "a", "b", "c", None]), rnd.choice([None, 0, -3, rnd.randint(1, 60), rnd.randint(1, 400), rnd.randint(1, 400), rnd.randint(600, 3000)])) for k in range(2000)]
    n, total = check(data, K.fill_containers(frame(spark, data), 500, shard_tokens=shard).collect(), 500)
    assert total / (n * 500) > (0.99 if shard > 10**6 else 0.97)


def test_every_container_has_the_mixture(spark):
    data = [(k, "a" if k % 4 else "b", 10) for k in range(4000)]
    placed = K.fill_containers(frame(spark, data), 400, shard_tokens=10_000)
    share = placed.groupBy("container_id").agg({"tokens": "sum", "*": "count"}).count()
    per = rows(placed.where("source = 'b'").groupBy("container_id").count(), "count")
    assert share >= 100 and sum(9 <= n <= 11 for (n,) in per) > 0.9 * len(per)


def test_given_shares_and_deficits_across_shards(spark):
    data = [(k, "a" if k % 2 else "b", 10) for k in range(2000)]
    placed = K.fill_containers(frame(spark, data), 200, {"a": 0.25, "b": 0.75}, shard_tokens=4000).collect()
    check(data, placed, 200)


def test_cases(spark):
    assert K.fill_containers(frame(spark, []), 100).count() == 0
    one = K.fill_containers(frame(spark, [(1, "a", 100), (2, "a", 101), (3, None, 1_000_000)]), 100).collect()
    check([(1, "a", 100), (2, "a", 101), (3, None, 1_000_000)], one, 100)
    same = [(7, "a", 30), (7, "a", 30)]
    assert sum(r["tokens"] for r in K.fill_containers(frame(spark, same), 100).collect()) == 60
    assert rows(K.fill_report(K.fill_containers(frame(spark, same), 100), 100)) == [(60, 1, 2, 60)]


def test_same_rows_whatever_the_partitions(spark):
    data = [(k, "ab"[k % 2], k % 97 + 1) for k in range(500)]
    cols = ("container_id", "place", "doc_id", "tokens")
    assert rows(K.fill_containers(frame(spark, data), 200, shard_tokens=5000), *cols) == rows(K.fill_containers(frame(spark, data[::-1]).repartition(7), 200, shard_tokens=5000), *cols)


def test_round_trip(spark):
    import os

    from cohortqc.llm import tokens

    if not os.path.exists(tokens.VOCABULARY):
        pytest.skip("no public vocabulary here")
    rnd = random.Random(7)
    texts = {k: "".join(rnd.choice(["word ", "Straße ", "🧬", "12 ", "\n"]) for _ in range(rnd.choice([0, 3, 40, 900]))) for k in range(60)}
    docs = spark.createDataFrame([(k, t, "a") for k, t in texts.items()] + [(99, None, "a")], "doc_id long, text string, source string")
    placed = K.pack_documents(docs, 128)
    per = {}
    for r in K.container_tokens(placed, docs).collect():
        per.setdefault(r["doc_id"], []).append((r["part"], r["ids"]))
    assert set(per) == {k for k, t in texts.items() if t}
    want = tokens.encoder()(list(texts.values()))
    assert all([i for _, ids in sorted(per[k]) for i in ids] == w for k, w in zip(texts, want, strict=True) if w)


def test_many_sources_need_no_column_each(spark, monkeypatch):
    data = [(k, f"s{k % 1500}", k % 40 + 1) for k in range(3000)]
    for limit in (500_000, 10):
        monkeypatch.setattr(K, "BROADCAST_STARTS", limit)
        n, total = check(data, K.fill_containers(frame(spark, data), 100, shard_tokens=20_000).collect(), 100)
        assert total / (n * 100) > 0.95


def test_audit_finds_each_kind_of_fault(spark):
    sizes = spark.createDataFrame([(1, "a", 30), (2, "a", 150), (3, "b", 20), (4, "b", 10)], "doc_id long, source string, tokens long")
    good = K.fill_containers(sizes, 100)
    assert rows(K.audit(good, sizes, 100), "violations") == [(0,)] * 4
    bad = spark.createDataFrame(
        [(0, 0, 1, 0, 0, 20, "a"), (0, 2, 1, 1, 20, 10, "a"), (1, 0, 2, 0, 0, 150, "a"), (2, 0, 3, 0, 0, 20, "b"), (2, 1, 3, 1, 0, 20, "b")], good.schema
    )
    assert dict(rows(K.audit(bad, sizes, 100))) == {"over_capacity": 1, "gaps_in_places": 1, "short_split": 2, "incomplete": 2}
