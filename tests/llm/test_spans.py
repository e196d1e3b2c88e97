import random

import pytest

from cohortqc.llm import spans as S
from tests.util import rows

SPAN = 20


def plain(docs, span=SPAN):
    by, pairs, chars = {}, set(), {}
    for k, text in docs:
        for i in range(len(text or "") - span + 1):
            by.setdefault(text[i : i + span], set()).add(k)
    for s in by.values():
        pairs.update((a, b) for a in s for b in s if a < b)
    for k, text in docs:
        mark = [False] * len(text or "")
        for i in range(len(mark) - span + 1):
            if len(by[text[i : i + span]]) > 1:
                mark[i : i + span] = [True] * span
        chars[k] = sum(mark)
    return sorted(pairs, key=repr), chars


def run(spark, docs, span=SPAN):
    df = spark.createDataFrame([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, anchor int, pos string, start int")
    found = S.SharedSpans(df, span)
    return rows(found.pairs()), {r["doc_id"]: r["shared_chars"] for r in found.shared_chars().collect()}


def check(spark, docs, span=SPAN):
    pairs, chars = run(spark, docs, span)
    want_pairs, want_chars = plain(docs, span)
    assert pairs == want_pairs
    assert chars == want_chars


def text(rnd, n, letters="abcdefghijklmnopqrstuvwxyz ñ🧬"):
    return "".join(rnd.choice(letters) for _ in range(n))


@pytest.mark.parametrize("hot", [48, 1])
def test_random_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "SHARD_WINDOWS", hot)
    rnd = random.Random(11)
    passages = [text(rnd, n) for n in (18, 19, 20, 21, 25, 40, 90)]
    docs = []
    for k in range(60):
        parts = [text(rnd, rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(passages), text(rnd, rnd.randint(0, 30))]
        docs.append((k, "".join(parts)))
    check(spark, docs)


@pytest.mark.parametrize("hot", [48, 1])
def test_exact_limits_copies_and_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "SHARD_WINDOWS", hot)
    rnd = random.Random(12)
    p, q = text(rnd, 20), text(rnd, 19)
    whole = text(rnd, 70)
    docs = [(1, "x" + p + "y"), (2, "z" + p), (3, "A" + q + "B"), (4, "C" + q + "D"), (5, whole), (6, whole), (7, whole), (8, "pre" + whole[5:40]), (9, p * 3), (10, "k" * 50), (11, "m" + "k" * 30), (12, None), (13, ""), (14, "short"), (15, "short")]
    check(spark, docs)


def test_standing_text_in_many_documents(spark):
    rnd = random.Random(13)
    standing = text(rnd, 19)
    long_ = text(rnd, 45)
    docs = [(k, text(rnd, 12) + (standing if k % 2 else long_) + text(rnd, 12)) for k in range(150)]
    check(spark, docs)


def test_periodic_texts(spark):
    docs = [(1, "ab" * 40), (2, "ba" * 30), (3, "aab" * 30), (4, "a" * 19), (5, "a" * 20), (6, "a" * 21)]
    check(spark, docs)


def test_long_text_in_blocks(spark, monkeypatch):
    rnd = random.Random(14)
    p = text(rnd, 60)
    docs = [(1, text(rnd, 995) + p + text(rnd, 4000)), (2, text(rnd, 30) + p), (3, text(rnd, 2000))]
    monkeypatch.setattr(S.Winnower.__init__, "__defaults__", (SPAN, 500))
    check(spark, docs)


def test_same_id_twice_and_empty(spark):
    a = "q" * 10 + "The same long passage of text"
    pairs, chars = run(spark, [(1, a), (1, a), (2, "zz" + a)])
    assert pairs == [(1, 2)]
    assert run(spark, []) == ([], {})


def test_winnowing_never_misses():
    rnd = random.Random(15)
    w = S.Winnower(SPAN)
    for _ in range(200):
        p = text(rnd, rnd.randint(20, 40), "ab")
        one, two = text(rnd, rnd.randint(0, 50), "ab") + p, p + text(rnd, rnd.randint(0, 50), "ab")
        hashes = [set(), set()]
        for number, _, h in w.texts([one, two]):
            for k, x in zip(number, h, strict=True):
                hashes[k].add(int(x))
        assert hashes[0] & hashes[1]


def test_automaton():
    a = S.Automaton()
    for t in ("abcabxabcd", "xabcy", "zzz"):
        a.add(t)
    subs = {t[i:j] for t in ("abcabxabcd", "xabcy", "zzz") for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    for s in subs:
        state = 0
        for c in s:
            state = a.next[state][c]
    states = {}
    for t in ("qqabcabq", "xabcd", "cabx"):
        for end, s in enumerate(a.stream(t, 3), 1):
            assert (s >= 0) == (t[max(0, end - 3) : end] in subs and end >= 3)
            if s >= 0:
                assert states.setdefault(s, t[end - 3 : end]) == t[end - 3 : end]


def test_groups_classes_and_removal(spark):
    rnd = random.Random(16)
    p, q = text(rnd, 45), text(rnd, 33)
    docs = [(-5, "one " + p), (2, p + " two " + q), (3, "three " + q), (4, "alone " * 9), (9, "copy" * 9), (7, "copy" * 9), (8, None), (10, "")]
    found = S.SharedSpans(spark.createDataFrame(docs, "doc_id long, text string"), SPAN)
    assert rows(found.pairs()) == [(-5, 2), (2, 3), (7, 9)]
    assert {frozenset(r["doc_id"] for r in found.groups().collect() if r["grp"] == g) for (g,) in rows(found.groups(), "grp")} == {frozenset((-5, 2)), frozenset((2, 3))}
    assert rows(found.classes()) == sorted([(-5, -5, 3), (2, -5, 3), (3, -5, 3), (7, 7, 2), (9, 7, 2)], key=repr)
    left = {r["doc_id"]: r["text"] for r in found.without_spans().collect()}
    assert left == {-5: "one ", 2: " two", 3: "three", 4: "alone " * 9, 9: "", 7: "", 8: None, 10: ""}


def test_a_passage_in_many_different_surroundings(spark, monkeypatch):
    monkeypatch.setattr(S, "PAIR_BLOCK", 7)
    monkeypatch.setattr(S, "SHARD_WINDOWS", 4)
    rnd = random.Random(17)
    p = text(rnd, 26)
    check(spark, [(k, text(rnd, 25) + p[k % 5 :] + text(rnd, 25)) for k in range(60)])
