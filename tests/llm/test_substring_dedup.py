"""Removal against every window of every document."""

import random

import hashlib

from harborline.llm import substring_dedup as S
from harborline.llm.common import documents

from conftest import SF


def brute(rows, length=13):
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (doc_id, _), w in zip(rows, words):
        for i in range(len(w) - length + 1):
            if doc_id is not None:
                g = tuple(w[i:i + length])
                first[g] = min(doc_id, first.get(g, doc_id))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - length + 1):
            if doc_id is not None and first[tuple(w[i:i + length])] < doc_id:
                gone.update(range(i, i + length))
        out.append((doc_id, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def run(frame, **how):
    return sorted((tuple(r) for r in S.drop_repeats(frame, **how).collect()), key=str)


def test_table(spark):
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    expected = brute(rows)
    assert run(documents(spark, SF)) == expected
    got = sorted((tuple(r) for r in S.op8_substring_dedup(spark, SF).collect()), key=str)
    assert got == sorted(((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in expected), key=str)


def test_shared_passages(docs):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(words) for _ in range(n)] for n in (12, 13, 14, 30, 60)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += rng.choice([p, p[a:], p[:a]]) + [rng.choice(words) for _ in range(rng.randrange(20))]
        rows.append((rng.randrange(10**6), "\t".join(text)))
    assert run(docs(rows)) == brute(rows)
    assert run(docs(rows), length=4) == brute(rows, 4)


def test_odd_rows(docs):
    long = " ".join(f"w{i}" for i in range(50000))
    p = " ".join(f"p{i}" for i in range(13))
    rows = [(1, None), (2, ""), (3, " \n "), (None, p), (9, p), (9, p), (8, p + " x"), (4, long), (5, long), (6, long + " " + p), (9, "other " + p), (7, "same same"), (10, "same same"),
            (11, " ".join(["a"] * 40)), (12, " ".join(["a"] * 13))]
    assert run(docs(rows)) == brute(rows)
    assert run(docs(rows).where("false")) == []


def test_longest_repeats(docs):
    p = [f"p{i}" for i in range(60)]
    rows = [(1, " ".join(p)), (2, "x " + " ".join(p[:30])), (3, " ".join(p[30:43]) + " y"), (4, "q " * 30 + "z"), (5, " ".join(p))]
    assert {tuple(r) for r in S.longest_repeats(docs(rows)).collect()} == {(1, 52), (5, 52), (2, 26), (3, 13)}
    assert S.longest_repeats(docs(rows[3:4])).collect() == []


def test_longest_repeats_of_copies_in_a_task(docs):
    p = [f"p{i}" for i in range(60)]
    rows = [(1, " ".join(p)), (2, "x " + " ".join(p[:30])), (5, " ".join(p)), (5, " ".join(p)), (None, " ".join(p))]
    for n in (1, 4):
        assert {tuple(r) for r in S.longest_repeats(docs(rows).coalesce(1).repartition(n)).collect()} == {(1, 52), (5, 52), (2, 26)}
    alone = [(7, " ".join(p)), (8, " ".join(p))]
    assert {tuple(r) for r in S.longest_repeats(docs(alone).coalesce(1)).collect()} == {(7, 52), (8, 52)}
