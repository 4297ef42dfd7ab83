"""The join against all pairs."""

import random

import numpy as np
import pytest

from harborline.llm import jaccard_join as J
from harborline.llm.common import documents

from conftest import SF


def brute(rows):
    """Of (id, text): {row number: (n_shingles, component_id)}."""
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    shared = {}
    for own in holders.values():
        for x in range(len(own)):
            for y in range(x + 1, len(own)):
                shared[own[x], own[y]] = shared.get((own[x], own[y]), 0) + 1
    for (i, j), k in shared.items():
        if rows[i][0] is not None and rows[j][0] is not None and 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
            up[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(((doc_id, len(sets[i]), least.get(root(i)) if doc_id is not None else None) for i, (doc_id, _) in enumerate(rows)), key=str)


def run(frame):
    return sorted((tuple(r) for r in J.similar_groups(frame).collect()), key=str)


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_table(spark):
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    assert run(documents(spark, SF)) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_of_near_copies(docs, monkeypatch, seed):
    """Chains and clusters at the threshold, with the frequent tokens indexed
    in pairs, and passages that many texts share."""
    monkeypatch.setattr(J, "COMBINED", 12)
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for g in range(6):
        base = [f"w{g}_{i}" for i in range(rng.choice([6, 20, 60, 200]))]
        for _ in range(25):
            rows.append((len(rows) * 7 + seed, " ".join(edited(base, rng.choice([0, 1, 1, 2, 3]), rng))))
        chain = base
        for _ in range(8):
            chain = edited(chain, max(1, len(base) // 40), rng)
            rows.append((len(rows) * 7 + seed, " ".join(chain)))
    for i in range(60):
        own = [f"o{i}_{k}" for k in range(rng.choice([0, 1, 3, 8, 40]))]
        rows.append((len(rows) * 7 + seed, " ".join(own + passage)))
    rng.shuffle(rows)
    assert run(docs(rows)) == sorted(brute(rows), key=str)


def test_odd_rows(docs):
    long = " ".join(f"w{i}" for i in range(40000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (None, "a b c d e f"), (8, "a b c d e f"), (9, "A B c d E f"), (9, "A B c d E f"),
            (10, "one"), (11, "ONE"), (12, "one two"), (3, long), (4, long + " x"), (9, "other text of the same id here"), (13, "one")]
    assert run(docs(rows)) == sorted(brute(rows), key=str)


def test_no_rows(docs, spark):
    assert run(docs([(1, "x")]).where("false")) == []


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(2, 60))
        base = rng.choice(10**6, 200, replace=False).astype(np.uint64) * np.uint64(2**40 + 7)
        listed = np.sort(rng.choice(base, 60, replace=False))
        tier = rng.integers(1, 9, 60)
        tier[rng.random(60) < 0.5] = 255
        x = np.sort(base[:n])
        y = np.sort(np.concatenate([rng.choice(x, int(rng.integers(1, n + 1)), replace=False), base[100:100 + int(rng.integers(0, n // 4 + 1))]]))
        shared = len(np.intersect1d(x, y))
        if 100 * shared >= 75 * (len(x) + len(y) - shared) and not np.array_equal(x, y):
            assert len(np.intersect1d(J.prefix(x, listed, tier)[0], J.prefix(y, listed, tier)[0]))
