"""Base forms and entropy spans against Python's own reading."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from harborline.llm import entropy_secrets as E
from harborline.llm.common import documents

from conftest import SF

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def brute(text):
    text = text or ""
    base = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    key = lambda s: (s[1], E.KINDS.index(s[0]), s[2])
    added = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
        s = m[0]
        if len(s) < 20 or not re.search("[0-9]", s) or any(re.fullmatch(p, s) for p in E.ALLOWED):
            continue
        bits = next(b for p, b in E.CLASSES if re.fullmatch(p, s))
        hot = [i for i in range(len(s) - 19) if entropy(s[i:i + 20]) >= bits]
        if hot:
            span = ("entropy", m.start() + hot[0], m.start() + hot[-1] + 20)
            if not any(a <= span[1] and span[2] <= z for _, a, z in base):
                added.append(span)
    return sorted(base, key=key), sorted(base + added, key=key)


def check(got, rows):
    def text(spans):
        return ",".join(":".join(map(str, s)) for s in spans)

    want = []
    for i, t in rows:
        base, spans = brute(t)
        n = Counter(s[0] for s in base)
        want.append((i, n["assign"], n["access"], n["hex"], hashlib.sha256(text(base).encode()).hexdigest(), text(spans)))
    assert sorted(map(str, got)) == sorted(map(str, want))


def query(frame, monkeypatch, spark):
    monkeypatch.setattr(E, "documents", lambda *_: frame)
    return [tuple(r) for r in E.op5_entropy_secrets(spark, SF).collect()]


def test_table(spark, monkeypatch):
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    check(query(documents(spark, SF), monkeypatch, spark), rows)


def test_made_up_texts(spark, docs, monkeypatch):
    rng = random.Random(1)
    parts = ["password", "token", "API_KEY", "apikey", "Secret", " ", "  ", ":", "=", "'", '"', "AKIA", "ABC123", "é", "😀", ".", "_", "-", "x" * 21, "\n", "ſecret", "toKen", "example",
             "123e4567-e89b-12d3-a456-426614174000", "2024-01-02", "0123456789abcdef0123456789"]
    rows = []
    for i in range(250):
        own = []
        for _ in range(rng.randrange(30)):
            n = rng.choice([5, 18, 19, 20, 24, 40, 80])
            own.append(rng.choice([rng.choice(parts), "".join(rng.choices("0123456789abcdef", k=n)), "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n)), "".join(rng.choices("ab1", k=n))]))
        rows.append((i, "".join(own)))
    check(query(docs(rows), monkeypatch, spark), rows)


def test_odd_rows(spark, docs, monkeypatch):
    rows = [(1, None), (2, ""), (None, "token=abcdef1"), (3, "token=abcdef1"), (3, "token=abcdef1"), (4, "ab1 " * 30000 + "f" * 100000 + " Zx9" * 9), (5, "AKIA" * 9)]
    check(query(docs(rows), monkeypatch, spark), rows)
    assert query(docs(rows).where("false"), monkeypatch, spark) == []


def test_redact(docs):
    rows = [(1, None), (2, "no secret"), (3, "a token=abcdef1 b é password: 12345678, z")]
    assert {r["doc_id"]: r["text"] for r in E.redact(docs(rows)).collect()} == {1: None, 2: "no secret", 3: "a [SECRET] b é [SECRET], z"}
    assert E.redact(docs(rows)).columns == docs(rows).columns


@pytest.mark.parametrize("bits", [b for _, b in E.CLASSES])
def test_no_window_is_at_a_threshold(bits):
    """So rounding can't decide."""
    def parts(n, most):
        if n == 0:
            yield ()
        for k in range(min(n, most), 0, -1):
            for rest in parts(n - k, k):
                yield (k, *rest)

    assert min(abs(sum(-c / 20 * math.log2(c / 20) for c in p) - bits) for p in parts(20, 20)) > 1e-6
