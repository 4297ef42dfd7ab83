"""The network against finite differences and step-by-step reading; scores
against a plain count of the words; held-out likelihood."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from harborline.llm import gru, gru_lm as L
from harborline.llm.common import documents

from conftest import SF


def words_of(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split() + [b"\x00end"]


def check(frame, rows):
    """Base scores and counts by the contract; returns rows by id."""
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    count = Counter(w for i, t in rows if not held(i) for w in words_of(t))
    n, v = sum(count.values()), len(count)
    got = L.score(frame).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), held(i), len(words_of(t)), sum(count[w] > 0 for w in words_of(t)), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words_of(t)), 3)) for i, t in rows)
    for a, b in zip(sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), want):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=2e-3)
    return got


@pytest.mark.parametrize("share", [L.SHARE, 500])
def test_table(spark, monkeypatch, share):
    monkeypatch.setattr(L, "SHARE", share)  # the smaller, the more words are joined
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    got = check(documents(spark, SF), rows)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert all(r["score"] < 0 for r in got)


def test_learns_what_follows(docs):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        n = rng.randrange(5, 80)
        w = [rng.choice("abcdef")]
        for _ in range(n):
            w.append(rng.choice({"a": "b", "b": "c", "c": "ad", "d": "e", "e": "f", "f": "a"}[w[-1]]))
        rows.append((i, " ".join(w)))
    out = [r for r in check(docs(rows), rows) if r["held_out"]]
    assert sum(r["score"] for r in out) > 0.75 * sum(r["base_score"] for r in out)


def test_odd_rows(docs):
    rows = [(i, f"the word w{i} and the end") for i in range(30)] + [(None, "no id here"), (31, None), (32, ""), (32, ""), (33, "Ab ab aB " + "rare%d " * 3), (34, " ".join(f"u{i % 3000}" for i in range(40000)))]
    check(docs(rows), rows)
    assert L.score(docs(rows).where("false")).count() == 0
    unseen = [r for r in rows if L.fold(r[0]) == 1]
    got = check(docs(unseen), unseen)
    assert all(r["score"] == pytest.approx(r["base_score"], abs=1e-3 * r["n_tokens"]) for r in got)


def test_known_words_follow_the_tokens():
    """However large the vocabulary, the network knows the words that make up
    ``COVER`` of the tokens."""
    for n in (300, 3000, 30000):
        counts = np.append(10**6 // np.arange(1, n + 1), 500)
        words = np.append(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64), L.END)
        v = L.Vocabulary(words, counts, int(counts.sum()), len(words))
        known = v.known[:-1] >= 0
        assert v.n_known == known.sum() and known[v.words == L.END].all()
        assert v.counts[known].sum() >= 0.69 * counts.sum() and v.n_known >= min(512, n + 1)
        assert v.counts[known & (v.words != L.END)].min() >= v.counts[~known].max(initial=0)
        layout = v.layout()
        assert layout.n_classes >= 16 and layout.hidden >= 24


def small(seed=0, dtype=np.float64):
    rng = np.random.default_rng(seed)
    shares = 1 / np.arange(1, 21.0)
    shares /= shares.sum() * 1.3
    layout = gru.Layout(shares, 5, 24, 6)
    weights = {k: v.astype(dtype) for k, v in layout.start(np.append(shares, 1 - shares.sum())).items()}
    texts = [(rng.integers(0, 24, n).astype(np.int32), rng.integers(0, 21, n)) for n in (9, 4, 1, 17, 6, 30)]
    return gru.Network(layout, weights), texts, rng


def test_gradients():
    net, texts, rng = small()
    x, first, there, _, y = list(net.windows(texts, 3, 6))[1]
    h = rng.standard_normal((x.shape[1], 6)).astype(np.float32)
    grads = net.gradients(x, first, there, y, h)[0]
    for k in gru.SHAPES:
        for _ in range(6):
            i = tuple(rng.integers(0, s) for s in net.w[k].shape)
            old, values = net.w[k][i], []
            for e in (1e-3, -1e-3):
                net.w[k][i] = old + e
                values.append(-net._outputs(net._steps(x, first, h)[there].astype(float), y)[0].sum() / len(y))
            net.w[k][i] = old
            assert (values[0] - values[1]) / 2e-3 == pytest.approx(grads[k][i], abs=2e-5)


def test_windows_carry_the_state():
    net, texts, _ = small(1, np.float32)
    whole = net.score(texts, n_lanes=1, steps=1000)
    for n_lanes, steps in ((2, 5), (6, 64), (3, 1)):
        assert np.allclose(net.score(texts, n_lanes, steps), whole, atol=1e-4)


def test_chances_sum_to_one():
    net, _, rng = small(2)
    state = rng.standard_normal((1, 6))
    p = sum(math.exp(net._outputs(state.copy(), np.array([k]))[0][0]) for k in range(21))
    assert p == pytest.approx(1)


def test_sums_of_rows():
    """Ids met once, some times and often, and none at all."""
    rng = np.random.default_rng(3)
    blocks, ids = rng.standard_normal((3, 900, 4)), np.minimum(rng.zipf(1.3, 900), 200)
    got, rows = gru._sums(blocks, ids)
    assert sorted(got) == sorted(set(ids.tolist())) and np.bincount(ids).max() > gru.FEW
    for i, row in zip(got, rows):
        assert np.allclose(row, blocks[:, ids == i].sum(axis=1).reshape(-1))
    assert [len(x) for x in gru._sums(blocks[:, :0], ids[:0])] == [0, 0]


def test_large_logits():
    """Where sums of powers are not finite, the largest logit is taken off."""
    net, _, rng = small(5)
    state, y = rng.standard_normal((40, 6)), rng.integers(0, 21, 40)
    for add in (2000, -2000):
        learn, learn_far = {}, {}
        want, back = net._outputs(state, y, learn)
        net.w["class_bias"] += add
        net.w["word_bias"] += add
        found, back_far = net._outputs(state, y, learn_far)
        net.w["class_bias"] -= add
        net.w["word_bias"] -= add
        assert np.allclose(found, want) and np.allclose(back_far, back) and np.allclose(learn_far["classes"], learn["classes"])
        assert all(np.allclose(learn_far["words"][c][0], g) for c, (g, _) in learn["words"].items())


def test_windows_scored_together(monkeypatch):
    """Short windows don't each go through all classes on their own."""
    net, _, rng = small(4, np.float32)
    texts = [(rng.integers(0, 24, 3000).astype(np.int32), rng.integers(0, 21, 3000)) for _ in range(20)]
    apart, calls, whole = net.score(texts[:1]), [], net._outputs
    monkeypatch.setattr(net, "_outputs", lambda state, y, learn=None: calls.append(len(y)) or whole(state, y, learn))
    got = net.score(texts)
    assert sum(calls) == 60000 and len(calls) == 1
    assert np.allclose(got[:3000], apart, atol=1e-4)
