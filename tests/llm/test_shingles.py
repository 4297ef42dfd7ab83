"""Shingle sets of many texts at once, against a plain reading."""

import random

import pyarrow as pa
import pytest

from harborline.llm import shingles

PIECES = ["a", "B", "cé", " ", "\t", "\x0b", "x" * 8, "x" * 9, "y" * 16, "z" * 63, "q" * 64, "r" * 65, "r" * 66, "\n", "  "]


def plain(text, k=5):
    words = (text or "").encode().lower().split()
    k = min(k, max(1, len(words)))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


@pytest.mark.parametrize("together", [1, 300, 8 << 20])
def test_sets_of_many_texts(monkeypatch, together):
    monkeypatch.setattr(shingles, "TOGETHER", together)
    rng = random.Random(together)
    texts = ["".join(rng.choice(PIECES) + rng.choice([" ", ""]) for _ in range(rng.randrange(25))) for _ in range(400)] + [None, "", " ", "one", "one"]
    found = []
    for kind in (pa.string(), pa.large_string()):
        own = []
        for tokens, sizes in shingles.shingle_sets(pa.array(texts, kind).slice(3)):
            assert sizes.sum() == len(tokens)
            for n in sizes.tolist():
                own.append(tokens[:n].tolist())
                tokens = tokens[n:]
        found.append(own)
    assert found[0] == found[1]
    sets, expected = [set(x) for x in found[0]], [plain(t) for t in texts[3:]]
    assert all(x == sorted(set(x)) for x in found[0])
    assert [len(x) for x in sets] == [len(x) for x in expected]
    assert len(set().union(*sets)) == len(set().union(*expected))
    for i in range(0, len(sets), 7):
        assert [len(sets[i] & x) for x in sets] == [len(expected[i] & x) for x in expected]


def test_a_text_without_blanks():
    [(tokens, sizes)] = shingles.shingle_sets(pa.array([None, "ab" * 50_000], pa.string()))
    assert sizes.tolist() == [0, 1] and len(tokens) == 1
