"""Containment against every shingle of every document."""

import random

from harborline.llm import decontamination as D
from harborline.llm.common import documents, table

from conftest import SF


def shingles(text):
    w = [x for x in (text or "").lower().translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, items):
    best = {}
    for doc_id, text in rows:
        own = shingles(text)
        for item_id, item in items:
            s = shingles(item)
            if s and (k := len(s & own)) >= 0.75 * len(s):
                best[doc_id, item_id] = max(best.get((doc_id, item_id), (0, 0, 0)), (k / len(s), len(s), k))
    return sorted(((*i, n, k, share) for i, (share, n, k) in best.items()), key=str)


def run(frame, items):
    return sorted((tuple(r) for r in D.contained_items(frame, items).collect()), key=str)


def test_table(spark):
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    items = table(spark, SF, "benchmark")
    assert run(documents(spark, SF), items) == brute(rows, [tuple(r) for r in items.select("item_id", "text").collect()])


def test_containment_at_the_threshold(spark, docs):
    rng = random.Random(9)
    items = [(k, " ".join(f"i{k}_{j}" for j in range(rng.choice([1, 3, 4, 5, 6, 8, 12, 40, 100])))) for k in range(40)]
    rows = []
    for i in range(150):
        text = [f"f{rng.randrange(99)}" for _ in range(rng.choice([0, 3, 30, 300]))]
        for k in rng.sample(range(40), rng.randrange(3)):
            w = items[k][1].split()
            cut = rng.randrange(max(1, len(w) // 3))
            at = rng.randrange(len(text) + 1)
            text[at:at] = w[cut:] if rng.random() < 0.5 else w[:len(w) - cut]
        rows.append((i, " ".join(text)))
    frame = spark.createDataFrame(items + [(40, None), (41, ""), (None, items[3][1]), (3, items[3][1])], "item_id long, text string")
    assert run(docs(rows), frame) == brute(rows, [tuple(r) for r in frame.collect()])


def test_odd_rows(spark, docs):
    p = " ".join(f"p{i}" for i in range(20))
    rows = [(1, None), (2, ""), (None, p), (3, p), (3, p), (3, "else"), (4, "x " * 40000 + p), (5, "one two"), (6, "one two three")]
    items = spark.createDataFrame([(7, p, 1), (7, p, 2), (8, "One  two", 1)], "item_id long, text string, doc_id int")
    assert run(docs(rows), items) == brute(rows, [(r["item_id"], r["text"]) for r in items.collect()])
    assert run(docs(rows).where("false"), items) == [] and run(docs(rows), items.where("false")) == []
