"""Disclosure over whole documents, against counts of all pairs."""

import math
import random
import re
from collections import Counter, defaultdict

from harborline.llm import disclosure as D

from test_disclosure import base

PARTS = ["a.b@c-d.ee", "@", "..", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4952935900253052", "4952 9359-0025 3052", "+1 (017) 555-7713", "+12345678", " ", "é", "😀", "co.uk_z@q.r", "\n", "12", " word ", "Nick"]


def brute(rows):
    rows = [(i, t or "") for i, t in rows]
    n, n_term, has, near, found = len(rows), Counter(), defaultdict(set), defaultdict(set), {}
    for i, t in rows:
        n_term.update(set(re.split(r"[\W_]+", t.lower())))
        rest = list(t)
        for _, a, z in base(t):
            rest[a:z] = " " * (z - a)
        terms = [(m[0].lower(), *m.span()) for m in re.finditer(r"[^\W_]+", "".join(rest))]
        own = {(kind, t[a:z].lower() if kind == "email" else t[a:z] if kind == "ip" else re.sub("[^0-9]", "", t[a:z])) for kind, a, z in base(t)}
        found[i, t] = own, terms
        for e in own:
            has[e].add((i, t))
        for w in {w for w, *_ in terms} if own else ():
            near[w].add((i, t))
    both = Counter((e, w) for own, terms in found.values() for w in {w for w, *_ in terms} for e in own)
    out = []
    for i, t in rows:
        own, terms = found[i, t]
        spans = set(base(t))
        best = {w: max((math.log2(n * both[e, w] / ((n_term[w] or len(near[w])) * len(has[e]))) / math.log2(n / len(has[e])) for e in own if len(has[e]) < n), default=-1) for w in {w for w, *_ in terms}}
        spans |= {("removed" if best[w] >= D.REMOVE else "generalised", a, z) for w, a, z in terms if best[w] >= D.GENERALISE}
        out.append((i, sorted(spans)))
    return out


def spans_of(docs, rows):
    return [(r["doc_id"], sorted({(s["kind"], s["start"], s["end"]) for s in r["pii_spans"]})) for r in D.scan(docs(rows)).collect()]


def test_terms_far_from_the_entity(docs):
    """Wherever the term stands in a document that has the entity, and only there."""
    fill = "some words " * 30
    rows = [(i, fill) for i in range(60)] + [(i, f"Nick {fill}a@b.cc {fill}nick") for i in (70, 71)]
    got = dict(spans_of(docs, rows))
    assert got[70] == got[71] == [("email", 335, 341), ("removed", 0, 4), ("removed", 672, 676)]
    got = dict(spans_of(docs, rows + [(80, "nick")]))  # in another document as well
    assert got[70] == [("email", 335, 341), ("generalised", 0, 4), ("generalised", 672, 676)] and got[80] == []


def test_entities_of_one_document(docs):
    """A term that no other document has gives such an entity away, too."""
    rows = [(i, f"common words of text{i % 4}") for i in range(40)] + [(50, "common zanzibar a@b.cc words"), (51, "+1 (017) 555-7713 common text1 yonder")]
    got = dict(spans_of(docs, rows))
    assert got[50] == [("email", 16, 22), ("removed", 7, 15)]
    assert got[51] == [("phone", 0, 17), ("removed", 31, 37)]
    assert not any(got[i] for i in range(40))


def test_all_pairs(docs):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(25)))) for i in range(200)]
    rows += [(200 + i, " ".join(rng.choice([f"t{rng.randrange(90)}", f"p{rng.randrange(30)}@m.ee", "the"]) for _ in range(rng.randrange(30)))) for i in range(150)]
    rows += [(1, None), (2, ""), (None, "see a@b.cc now"), (600, "see a@b.cc now"), (600, "see a@b.cc now"), (601, "9 " * 20000 + "1." * 400 + "q@r.s")]
    got = sorted(spans_of(docs, rows), key=str)
    assert got == sorted(brute(rows), key=str)
    assert {s[0] for _, spans in got for s in spans} >= {"removed", "generalised"}
