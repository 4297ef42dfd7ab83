"""Fingerprints against a plain reading of the definition."""

import hashlib
import math

from harborline.llm import imatch as M
from harborline.llm.common import documents

from conftest import SF


def next_of(rows):
    """Rows in order, each with the text that follows it."""
    rows = sorted(rows, key=lambda r: (-math.inf if r[0] is None else r[0],), reverse=True)
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    return [(i, t or "", rows[(k + 1) % len(rows)][1] or "") for k, (i, t) in enumerate(rows)]


def check(frame, rows):
    got = sorted((tuple(r) for r in M.edited_likeness(frame).collect()), key=str)
    want, prints = [], {r[0]: r[1] for r in M.fingerprints(frame).collect()}
    for doc_id, text, after in next_of(rows):
        n = len(text)
        edit = text[: n - n // 3] + after[: n // 3]
        want.append((doc_id, n, hashlib.sha256(edit.encode()).hexdigest()))
    assert [r[:3] for r in got] == sorted(want, key=lambda w: str(w)[:-1]) or sorted(r[:3] for r in got) == sorted(want)
    return got, prints


def test_table(spark):
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    got, prints = check(documents(spark, SF), rows)
    texts = dict(rows)
    by_text = {}
    for r in got:
        assert prints[r[0]] == r[3]
        assert by_text.setdefault(texts[r[0]], r[3]) == r[3]
        assert 0 <= r[5] <= 1 and 0 <= r[6] <= 1
    after = {i: t for i, _, t in next_of(rows)}
    told = [r for r in got if r[1] >= 200 and texts[r[0]] != after[r[0]]]
    assert sum(r[5] > r[6] for r in told) >= 0.97 * len(told)


def test_lexicon_band(docs):
    rows = [(i, f"the t{i % 10} u{i} pair{i // 2}") for i in range(40)]
    lexicon = set(M.lexicon(docs(rows).select("doc_id", "text"), 0, 0.2).tolist())
    assert lexicon == set(M.terms(" ".join([f"t{i}" for i in range(10)] + [f"pair{i}" for i in range(20)]).encode()).tolist())


def test_likeness():
    empty = M.lexicon.__globals__["np"].empty(0, "uint64")
    text = " ".join(f"w{i}" for i in range(300)).encode()
    near = " ".join(f"w{i}" for i in range(290)).encode()
    far = " ".join(f"v{i}" for i in range(300)).encode()
    a, b, c = (M.fingerprint(t, empty) for t in (text, near, far))
    assert M.likeness(a, a) == 1 and M.likeness(a, b) > 0.8 and M.likeness(a, c) == 0
    assert M.fingerprint(b"", empty) == "" and M.likeness("", "") == 1 and M.likeness(a, "") == 0


def test_odd_rows(docs):
    long = " ".join(f"w{i}" for i in range(40000))
    rows = [(5, None), (6, ""), (7, "é" * 10), (-3, "a b c d"), (8, "x y"), (8, "x y"), (9, long), (2**53 + 1, "big id"), (None, "no id"), (10, "😀😀😀 z")]
    check(docs(rows), rows)
    check(docs(rows[2:3]), rows[2:3])
    assert M.edited_likeness(docs(rows).where("false")).collect() == []


def test_against_a_plain_reading(spark):
    """Fingerprints and likeness of every text, term by term."""
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    lexicon = set(M.lexicon(documents(spark, SF)).tolist())
    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    seeds = [int.from_bytes(hashlib.sha256(b"subset %d" % k).digest()[:8], "little") for k in range(M.SUBSETS)]

    def plain(text):
        """{level: hashes of the subsets}"""
        own = M.terms(text.encode()).tolist()
        kept = [t for t in own if t in lexicon] or own
        if not kept:
            return {}
        low, found = int(math.log2(len(kept))), {}
        for level in range(low, low + M.LEVELS):
            found[level] = []
            for seed in seeds:
                inside = [t for t in kept if mix(t ^ seed) >> (64 - level) == 0]
                total = sum(mix(t) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, t in enumerate(inside)) & mask
                found[level].append(1 + mix(total) % 0xFFFF if inside else 0)
        return found

    def told(a, b):
        if a == b:
            return 1.0
        both = [(x, y) for k in a.keys() & b.keys() for x, y in zip(a[k], b[k])]
        some = sum(x > 0 or y > 0 for x, y in both)
        return sum(x == y > 0 for x, y in both) / some if some else 0.0

    got = {r["doc_id"]: r for r in M.edited_likeness(documents(spark, SF)).collect()}
    for doc_id, text, after in next_of(rows):
        edit = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        a, b, c = plain(text), plain(edit), plain(after)
        for field, want in (("fingerprint", a), ("edited_fingerprint", b)):
            assert got[doc_id][field] == ";".join(f"{k}:" + "".join(f"{h:04x}" for h in v) for k, v in want.items())
        assert got[doc_id]["near_edited"] == told(a, b) and got[doc_id]["near_next"] == told(a, c)
