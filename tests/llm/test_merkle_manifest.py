"""Trees, proofs and tampering against a plain build of the whole tree."""

import hashlib
import random
import zlib

import duckdb
import pytest

from harborline.llm import merkle_manifest as M
from harborline.llm.common import Stages

from conftest import SF

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, slots int, n int, path string"


def H(data):
    return hashlib.sha256(data).hexdigest().encode()


def leaf(values):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values).encode())


def tree_of(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [H(b"".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
        levels.append(nodes)
    return levels


def way(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = at - at % 3
        out.append((b"".join(nodes[run:at]), b"".join(nodes[at + 1:run + 3])))
        at //= 3
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r, leaf(r)))
    keys = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    for k in keys:
        by[k].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {k: tree_of([own for _, own in by[k]]) for k in keys}
    top = tree_of([trees[k][-1][0] for k in keys])
    root, out = top[-1][0], []
    for j, k in enumerate(keys):
        for i, (r, own) in enumerate(by[k]):
            path, fold = way(trees[k], i) + way(top, j), own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4]:
                fold = leaf((*r[:4], r[4].replace("\n", "")))
            for a, b in path:
                fold = H(a + fold + b)
            out.append((r[0], own.decode(), trees[k][-1][0].decode(), root.decode(), H(b"".join(a + b for a, b in path)).decode(), fold.decode(), fold == root))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in M.manifest(frame).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2, "x") for r in rows], SCHEMA).repartition(4)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*M.FIELDS).collect()]
    found = sorted((tuple(r) for r in M.op11_merkle_manifest(spark, SF).collect()), key=str)
    assert found == brute(rows)
    altered = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (r[4] or "")}
    assert altered and {r[0] for r in found if not r[6]} == altered
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(con.sql(M.oracle_sql()).fetchall(), key=str) == found


@pytest.mark.parametrize("sources", [1, 2, 40])
def test_several_rounds(spark, sources):
    """More leaves in a source than a block holds, ids far apart and below 0."""
    rng = random.Random(sources)
    ids = [rng.getrandbits(64) - (1 << 63) for _ in range(400)] + rng.sample(range(-3000, 9000), 6500)
    rows = [(i, f"s{min(rng.randrange(sources), rng.randrange(sources))}", "é", rng.randrange(9), f"t{rng.randrange(50)}\nx") for i in ids]
    assert got(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    """Nulls everywhere, repeated ids (and more of one than a word has bits),
    equal rows, empty and very long texts, one row, none."""
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, "", "", 0, ""), (3, "b", None, 1, "\n"), (3, "b", None, 1, "\n"),
            (3, "b", "x", -1, "é\n😀"), (4, "é", "x", 2, "a\n" * 200000), (0, "a", None, None, ""), (-1, None, "l", 3, None), (64, "b", "l", 3, "\n\n")]
    rows += [(7, "b", "l", i % 30, "same") for i in range(300)] + [(None, "b", "l", i, "null id") for i in range(100)]
    rows += [(i, f"one{i}", "l", 1, "lone leaf") for i in range(100, 110)]
    assert got(frame(spark, rows)) == brute(rows)
    assert got(frame(spark, rows[6:7])) == brute(rows[6:7])
    assert got(frame(spark, rows[:0])) == []


def test_ranks_need_no_order(spark):
    rng = random.Random(3)
    ids = rng.sample(range(10 ** 12), 3000)
    rows = [(i, "s", None, None, None) for i in ids]
    placed = M.placed(Stages(spark, "test"), M.leaves(frame(spark, rows)))
    assert {r["doc_id"]: r["at"] for r in placed.collect()} == {d: i for i, d in enumerate(sorted(ids))}
