"""Shards against a build of the same tree in plain Python, and their laws."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from harborline.llm import kd_shards as K
from harborline.llm.common import Stages

from conftest import SF


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, 6, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, size int, shard int, at_0 string").repartition(4)


def lawful(rows, got, shards=K.SHARDS):
    """Every row once, sizes and checksums right, slots gapless."""
    want = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter(tuple(r)[:3] for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(0 <= s < shards and sorted(v) == list(range(len(v))) for s, v in slots.items())
    total = Counter()
    for r in got:
        total[r["shard"]] += r["size"]
    return [total[s] for s in range(shards)]


def plain(rows, dims, shards, first=0, out=None, whole=None, fine=None):
    """The tree by sorting: split at the median nearest to the share, then
    the best single exchange."""
    out = {} if out is None else out
    at = lambda r, d: r[f"at_{d}"]
    span = lambda d: (max(at(r, d) for r in rows) >> K.MIX) - (min(at(r, d) for r in rows) >> K.MIX)
    if shards == 1 or not rows:
        out.update({r["row"]: first for r in rows})
        return out
    whole = whole or [max(1, span(d)) for d in range(dims)]
    d = max(range(dims), key=lambda i: (span(i) / whole[i], -i))
    goal = sum(r["size"] for r in rows) * (shards // 2) / shards
    order, left, sofar = sorted(rows, key=lambda r: at(r, d)), set(), 0
    for r in order:
        if sofar + r["size"] >= goal:
            if abs(sofar + r["size"] - goal) <= abs(sofar - goal):
                left.add(r["row"])
                sofar += r["size"]
            break
        left.add(r["row"])
        sofar += r["size"]
    lack = round(goal - sofar)
    gap, row = min((abs(lack + (r["size"] if r["row"] in left else -r["size"])), r["row"]) for r in rows)
    if gap < abs(lack):
        left ^= {row}
    plain([r for r in rows if r["row"] in left], dims, shards // 2, first, out, whole)
    return plain([r for r in rows if r["row"] not in left], dims, shards - shards // 2, first + shards // 2, out, whole)


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_tree(spark, shards, monkeypatch):
    monkeypatch.setattr(K, "FINE", 0.0)
    rng = random.Random(shards)
    rows = [(i, "x" * int(rng.expovariate(0.01)), rng.choice(["de", "en", None]), f"s{min(rng.randrange(30), rng.randrange(30))}", rng.choice([None, rng.randrange(9999)])) for i in range(900)]
    measured = Stages(spark, "test").write(K.measured(frame(spark, rows), ["n_chars", "source", "lang"]), "measured")
    root = K.tree(measured, 3, shards)
    got = {r["row"]: r["s"] for r in measured.select("row", K.routed(root, lambda n: K.F.lit(n.first)).alias("s")).collect()}
    assert got == plain([r.asDict() for r in measured.collect()], 3, shards)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    got = K.op12_kd_shards(spark, SF).collect()
    lawful([tuple(r) for r in docs.collect()], got)
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_bytes_are_near_equal(spark):
    """A third of the rows of one source and length, copies, long texts."""
    rng = random.Random(1)
    rows = [(i, "copy" * 100, "en", "hot", 400) for i in range(4000)]
    rows += [(i, "y" * int(rng.paretovariate(1.2) * 200 % 40000), rng.choice("abcd"), f"s{rng.randrange(20)}", rng.randrange(40000)) for i in range(4000, 12000)]
    sizes = lawful(rows, K.kd_shards(frame(spark, rows), ["n_chars", "source", "lang"]).collect())
    assert max(sizes) - min(sizes) < 0.01 * sum(sizes) / len(sizes)


def test_slots_of_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(K, "ROWS", 5)
    rows = [(i, "z" * (i % 50), "en", "s", i) for i in range(2000)]
    lawful(rows, K.kd_shards(frame(spark, rows), ["n_chars"]).collect())


def test_odd_rows(spark):
    rows = [(None, None, None, None, None)] * 50 + [(1, "", "", "", 0)] * 50 + [(2, "é😀" * 200000, "en", "s", -5), (3, "a", None, "s", 1 << 62)]
    got = K.kd_shards(frame(spark, rows), ["n_chars", "source", "lang"]).collect()
    lawful(rows, got)
    assert len({r["shard"] for r in got if r["doc_id"] is None}) > 5  # equal rows are dealt out
    assert K.kd_shards(frame(spark, rows[:0]), ["n_chars"]).collect() == []
    assert len(K.kd_shards(frame(spark, rows[-1:]), ["n_chars"]).collect()) == 1
