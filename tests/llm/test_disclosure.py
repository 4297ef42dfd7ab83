"""Base spans against Python's own patterns, disclosure against plain counts."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from harborline.llm import disclosure as D
from harborline.llm.common import documents

from conftest import SF

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0,
                  "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def brute(rows):
    """Spans of each row of (id, text)."""
    texts = [(i, t or "") for i, t in rows]
    words = lambda t: re.finditer(r"[^\W_]+", t)
    has, near, beside, places, n_term = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(list), Counter()
    for k, (i, t) in enumerate(texts):
        key = (i, t)
        spans = base(t)
        rest = "".join(" " if any(a <= p < z for _, a, z in spans) else c for p, c in enumerate(t)) if spans else t
        n_term.update({w for w in re.split(r"[\W_]+", t.lower())})
        for kind, a, z in spans:
            value = t[a:z].lower() if kind == "email" else t[a:z] if kind == "ip" else re.sub("[^0-9]", "", t[a:z])
            e = f"{kind}:{value}"
            has[e].add(key)
            lo, hi = max(0, a - D.WINDOW), min(len(t), z + D.WINDOW)
            for part, at, cut in ((rest[lo:a], lo, lambda s, n: s[0] == 0 and lo > 0), (rest[z:hi], z, lambda s, n: s[1] == n and z + D.WINDOW < len(t))):
                for m in words(part):
                    s = (m.start() + at, m.end() + at)
                    if not cut(m.span(), len(part)):
                        near[e, m[0].lower()].add(key)
                        beside[m[0].lower()].add(key)
                        places[key].append((e, m[0].lower(), *s))
    n, out = len(texts), []
    for i, t in texts:
        best = {}
        for e, w, a, z in places[i, t]:
            both, of_e = len(near[e, w]), len(has[e])
            if both >= D.SUPPORT and of_e < n:
                share = math.log2(n * both / ((n_term[w] or len(beside[w])) * of_e)) / math.log2(n / of_e)
                best[a, z] = max(share, best.get((a, z), -9))
        added = [("removed" if s >= D.REMOVE else "generalised", a, z) for (a, z), s in best.items() if s >= D.GENERALISE]
        order = lambda s: (D.KINDS.index(s[0]), s[1])
        out.append((i, sorted(base(t), key=order), sorted(base(t) + added, key=order)))
    return out


def check(got, rows):
    text = lambda spans: ",".join(":".join(map(str, s)) for s in spans)
    want = []
    for i, own, spans in brute(rows):
        n = Counter(s[0] for s in own)
        want.append((i, *(n[k] for k in D.BASE), hashlib.sha256(text(own).encode()).hexdigest(), text(spans)))
    assert sorted(map(str, got)) == sorted(map(str, want))
    return [w[-1] for w in want]


def query(frame, monkeypatch, spark):
    monkeypatch.setattr(D, "documents", lambda *_: frame)
    return [tuple(r) for r in D.op4_disclosure(spark, SF).collect()]


def test_table(spark, monkeypatch):
    check(query(documents(spark, SF), monkeypatch, spark), [tuple(r) for r in documents(spark, SF).collect()])


def test_forms(spark, docs, monkeypatch):
    rng = random.Random(2)
    parts = ["a.b@c-d.ee", "@", ".", "..", "x@y", "1.2.3.4", "256.1.1.1", "00255.0.0.1", "1.2.3.4.5.6.7.8", "4952935900253052", "4952 9359-0025 3052", "4952  935900253052", "+1 (017) 555-7713", "+12345678", "+1", "(", ")", "-", " ", "é", "😀", "co.uk_z@q.r", "%", "1" * 20, "0" * 18, "\n", "12"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for i in range(300)]
    check(query(docs(rows), monkeypatch, spark), rows)


def test_terms_that_give_entities_away(spark, docs, monkeypatch):
    rng = random.Random(4)
    rows = []
    for i in range(200):
        who = rng.randrange(12)
        filler = lambda: " ".join(f"f{rng.randrange(60)}" for _ in range(rng.randrange(12)))
        rows.append((i, f"{filler()} nick{who} works in club{who}, mail Person{who}@mail.example {filler()}" if rng.random() < 0.4 else f"{filler()} club{rng.randrange(40)} {filler()}"))
    rows += [(900, rows[0][1]), (0, rows[0][1])]
    spans = check(query(docs(rows), monkeypatch, spark), rows)
    assert any("removed" in s for s in spans) and any("generalised" in s for s in spans)


def test_odd_rows(spark, docs, monkeypatch):
    rows = [(1, None), (2, ""), (None, "see a@b.cc now"), (3, "see a@b.cc now"), (3, "see a@b.cc now"), (4, "9 " * 20000 + "a" * 50000 + "@ " + "1." * 20000), (5, "x.y " * 3000 + "q@r.s")]
    check(query(docs(rows), monkeypatch, spark), rows)
    assert query(docs(rows).where("false"), monkeypatch, spark) == []


def test_sanitise(docs):
    rows = [(1, "é nick1 a@b.cc works"), (2, "plain")]
    spans = F.from_json(F.lit('[{"kind": "email", "start": 8, "end": 14}, {"kind": "generalised", "start": 2, "end": 7}]'), f"array<{D.S.SPAN}>")
    got = docs(rows[:1]).select(D.sanitise(F.col("text"), spans).alias("t")).first()["t"]
    assert got == "é [TERM] [EMAIL] works"
