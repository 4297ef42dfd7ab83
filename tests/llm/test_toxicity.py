"""Ordinal regression: held-out accuracy, order of thresholds, odd rows."""

import random

import numpy as np

from harborline.llm import toxicity as T
from harborline.llm.common import documents, table

from conftest import SF


def corpus(n, rng):
    mild, harsh = ["silly", "dull"], ["vile", "foul"]
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 300))]
        g = rng.choices([0, 1, 2], [8, 1, 1])[0]
        for _ in range(3 * (g > 0)):
            words.insert(rng.randrange(len(words)), rng.choice(mild if g == 1 else harsh))
        rows.append((i, " ".join(words), g))
    return rows


def test_held_out_grades():
    rows = corpus(3000, random.Random(2))
    x, y = [T.features(t) for _, t, _ in rows], np.array([g for *_, g in rows])
    model = T.fit(x[:2000], y[:2000])
    assert (np.diff(model.thresholds) > 0).all()
    score = np.array([model.score(f) for f in x[2000:]])
    severity, got = model.severity(score), model.chances(score).argmax(axis=1)
    assert (got == y[2000:]).mean() > 0.97
    assert ((severity >= T.REJECT) == (y[2000:] > 0)).mean() > 0.99
    means = [severity[y[2000:] == g].mean() for g in range(3)]
    assert means[0] < 0.1 < 0.8 < means[1] < means[2]


def test_chances_sum_to_one():
    model = T.Ordinal(np.empty(0, np.uint64), np.empty(0), np.array([-1.0, 2.0, 2.5]))
    p = model.chances(np.linspace(-50, 50, 21))
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    assert (np.diff(model.severity(np.linspace(-50, 50, 21))) >= -1e-12).all()


def test_train_and_grade(spark, docs):
    rows = corpus(600, random.Random(3))
    labels = spark.createDataFrame([(i, 0 if g == 2 else 1, int(g > 0)) for i, _, g in rows] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    frame = docs([(i, t) for i, t, _ in rows])
    model = T.train(frame, labels)
    odd = [(None, rows[0][1]), (1, None), (2, ""), (2, ""), (3, "vile foul vile " + "w1 " * 50000), (4, "foul vile")]
    got = {(r["doc_id"], r["node"], round(r["severity"], 6), r["grade"]) for r in T.grade(docs(odd), model).collect()}
    assert len(got) == 5 and {r[0] for r in got if r[2] >= T.REJECT} == {3, 4}
    assert T.grade(docs(odd).where("false"), model).count() == 0
    small = T.train(frame, labels, sample=200)
    assert len(small.features) <= len(model.features) + 5


def test_no_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = T.train(docs([(1, "a b")]), none)
    assert [r["severity"] < 1e-6 for r in T.grade(docs([(1, "a b")]), model).collect()] == [True]
    clean = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert T.grade(docs([(1, "a b")]), T.train(docs([(1, "a b")]), clean)).first()["severity"] < T.REJECT


def test_query(spark):
    got = T.op3_toxicity(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in documents(spark, SF).collect())
    label = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    wrong = [r for r in got if r["toxic"] and label.get(r["doc_id"]) == 0]
    assert not wrong
