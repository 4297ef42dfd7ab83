"""Toxicity grades by cumulative-link ordinal regression.

Severity grades are ordered: 0 clean, 1 toxic, 2 toxic and of low quality. One
weight vector serves all grades; with the score ``s`` of a text's features,
``P(grade <= k) = sigmoid(threshold_k - s)`` with ascending thresholds. The
output is the expected severity, ``sum of k * P(grade = k)``.

Features are sparse: which terms a text has, by 64-bit hash. Those that a test
finds unrelated to toxicity are left out, so that long texts don't gather
noise and the model stays small.

The model is fitted on the driver from at most ``SAMPLE`` labelled documents,
drawn by the hash of their ids. All documents are scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.common import documents, table, text_of
from harborline.llm.imatch import terms

#: Labelled documents to fit on, at most; so the sample can be broadcast.
SAMPLE = 10_000
GRADES = 3
#: Expected severity from which a document is rejected.
REJECT = 0.5

#: Steps of the descent, their rate, and the L2 penalty.
STEPS, RATE, PENALTY = 500, 0.3, 1e-4
#: Chance that any feature without a bearing on toxicity is kept.
LEVEL = 0.05


def features(text: str) -> np.ndarray:
    """Sorted hashes of the terms of a text, each once."""
    return terms(text.lower().encode())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    """Features in order with their weights, and ascending thresholds between
    the grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, own: np.ndarray) -> float:
        if not len(self.features):
            return 0.0
        at = np.minimum(np.searchsorted(self.features, own), len(self.features) - 1)
        return float(self.weights[at[self.features[at] == own]].sum())

    def chances(self, score: np.ndarray) -> np.ndarray:
        """A row for each score, a column for each grade."""
        upto = _sigmoid(self.thresholds[None, :] - np.asarray(score, float)[:, None])
        return np.diff(np.concatenate([np.zeros((len(upto), 1)), upto, np.ones((len(upto), 1))], axis=1), axis=1)

    def severity(self, score: np.ndarray) -> np.ndarray:
        return self.chances(score) @ np.arange(len(self.thresholds) + 1)


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES) -> Ordinal:
    """Maximum likelihood with an L2 penalty on the weights of the telling
    features, by AdaGrad over all rows. Thresholds start at the grades' shares; their
    differences are exponentials, so they stay in order. Without rows every
    text is grade 0."""
    n = len(rows)
    if not n:
        return Ordinal(np.empty(0, np.uint64), np.empty(0), np.linspace(20, 40, n_grades - 1))
    grades = np.asarray(grades, np.int64)
    share = (np.bincount(grades, minlength=n_grades)[:n_grades] + 0.5) / (n + 0.5 * n_grades)
    upto = np.cumsum(share)[:-1]
    start = np.log(upto / (1 - upto))
    first, gaps = start[0], np.log(np.maximum(np.diff(start), 1e-2))
    # only what is in several rows can tell
    known, often = np.unique(np.concatenate(rows), return_counts=True)
    known = known[often >= 3]
    found = [_places(known, r) for r in rows]
    place = np.concatenate(found).astype(np.int64)
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in found])
    telling = _telling(place, owner, grades > 0, len(known))
    known, kept = known[telling], telling[place]
    place, owner = (np.cumsum(telling) - 1)[place[kept]], owner[kept]
    # rare grades weigh more than their number, so that few rows are learnt from
    weight = 1 / np.sqrt(share[grades])
    w, heads = _descend(np.zeros(len(known)), np.concatenate([[first], gaps]), place, owner, grades, weight / weight.mean())
    return Ordinal(known, w, _ascending(heads))


def _places(known: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Where ``own`` stand in ``known``, both sorted, without those that don't."""
    if not len(known):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return at[known[at] == own]


def _telling(place: np.ndarray, owner: np.ndarray, toxic: np.ndarray, width: int) -> np.ndarray:
    """Features whose rows are toxic more or less often than others, by a
    chi-squared test at ``LEVEL`` over all features together."""
    n, k = len(toxic), toxic.sum()
    n_of = np.bincount(place, minlength=width).astype(float)
    k_of = np.bincount(place[toxic[owner]], minlength=width).astype(float)
    spread = n_of * (n - n_of) * k * (n - k)
    chi = n * (n * k_of - n_of * k) ** 2 / np.maximum(spread, 1)
    # the tail of one degree of freedom is below exp(-x / 2)
    return (spread > 0) & (n_of >= 3) & (chi > 2 * np.log(max((n_of >= 3).sum(), 1) / LEVEL))


def _ascending(heads: np.ndarray) -> np.ndarray:
    return heads[0] + np.concatenate([[0.0], np.cumsum(np.exp(heads[1:]))])


def _descend(w, heads, place, owner, grades, weight):
    n, n_grades = len(grades), len(heads) + 1
    at = np.arange(n)
    seen, head_seen = np.full(len(w), 1e-6), np.full(len(heads), 1e-6)
    for _ in range(STEPS):
        thresholds = _ascending(heads)
        s = np.bincount(owner, w[place], n)
        upto = np.concatenate([np.zeros((n, 1)), _sigmoid(thresholds[None] - s[:, None]), np.ones((n, 1))], axis=1)
        slope = upto * (1 - upto)
        p = np.maximum(upto[at, grades + 1] - upto[at, grades], 1e-12)
        # of the negative log-likelihood, by each threshold and by the score
        by_threshold = np.zeros((n, n_grades + 1))
        by_threshold[at, grades + 1] -= weight * slope[at, grades + 1] / p
        by_threshold[at, grades] += weight * slope[at, grades] / p
        by_score = -by_threshold.sum(axis=1)
        g = np.bincount(place, by_score[owner], len(w)) / n + PENALTY * w
        inner = by_threshold[:, 1:-1].sum(axis=0) / n
        tail = np.cumsum(inner[::-1])[::-1]
        head_g = np.concatenate([tail[:1], tail[1:] * np.exp(heads[1:])])
        seen += g * g
        w = w - RATE / np.sqrt(seen) * g
        head_seen += head_g * head_g
        heads = heads - RATE / 3 / np.sqrt(head_seen) * head_g
    return w, heads


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    """Fit on ``sample`` of the documents (``doc_id``, ``text``) that
    ``labels`` (``doc_id``, ``quality``, ``toxic``) covers. Labels without an
    id or a ``toxic`` value are left out; a missing ``quality`` counts as
    good. A null or empty text has no features."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.coalesce(F.col("quality"), F.lit(1)) == 0, 2).otherwise(1)
    known = labels.where("doc_id is not null and toxic is not null").select("doc_id", grade.alias("grade"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)

    def extract(batches):
        for batch in batches:
            rows = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary()), batch.column(1)], names=["terms", "grade"])

    texts = docs.select("doc_id", text_of(docs["text"]).alias("text")).join(F.broadcast(drawn), "doc_id")
    # bounded by the sample; the terms of a text come as the bytes of their hashes
    got = texts.select("text", "grade").mapInArrow(extract, "terms binary, grade int").toArrow()
    return fit([np.frombuffer(t, np.uint64) for t in got["terms"].to_pylist()], got["grade"].to_numpy())


def judged(spark: SparkSession, model: Ordinal, text: Column) -> Column:
    """``struct<severity, grade>`` of a text; null is scored as empty, which
    has no features."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, grade int")
    def judge(text: pd.Series) -> pd.DataFrame:
        model = shared.value
        score = np.array([model.score(features(t)) for t in text], float)
        return pd.DataFrame({"severity": model.severity(score), "grade": model.chances(score).argmax(axis=1).astype(np.int32)})

    return judge(text_of(text))


def grade(docs: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected, double) and ``grade`` (int, the
    likeliest). Every row stays, repeated rows too; columns of these names are
    replaced."""
    found = docs.withColumn("_judged", judged(docs.sparkSession, model, F.col(text)))
    return found.withColumns({"severity": F.col("_judged.severity"), "grade": F.col("_judged.grade")}).drop("_judged")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = grade(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "severity", "grade", (F.col("severity") >= REJECT).alias("toxic"))
