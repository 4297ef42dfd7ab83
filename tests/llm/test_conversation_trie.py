"""The trie against one built from tuples of turns."""

import hashlib
import random
import zlib

import duckdb
from pyspark.sql import functions as F

from harborline.llm import conversation_trie as T
from harborline.llm.common import Stages

from conftest import SF


def rebuilt(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, v in own.items():
        h, donor = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(donor, [])[:h] + v[h:]
    return out


def brute(built):
    """Nodes of {conversation: turns}."""
    ids, at, members = {(None, None): 0}, {}, {0: []}  # (parent, turn) -> node
    info, ends = {0: (0, None, 0)}, {}
    for c in sorted(built):
        node = 0
        members[0].append(c)
        for d, turn in enumerate(built[c], 1):
            if (node, turn) not in ids:
                new = len(ids)
                ids[node, turn] = new
                info[new] = (d, node, len(turn[1].encode()))
                members[new] = []
            node = ids[node, turn]
            members[node].append(c)
        ends.setdefault(node, []).append(c)
    kids, saved, leaves = {}, {}, {}
    for n in sorted(info, key=lambda n: -info[n][0]):
        d, parent, size = info[n]
        saved[n] = (len(members[n]) - 1) * size + sum(saved[k] for k in kids.get(n, []))
        leaves[n] = sum(leaves[k] for k in kids.get(n, [])) or 1
        if parent is not None:
            kids.setdefault(parent, []).append(n)
    text = lambda n: ",".join(map(str, ends.get(n, [])))
    return sorted(str((members[n][0], info[n][0], members[info[n][1]][0] if n else None, len(members[n]), len(kids.get(n, [])), leaves[n], saved[n],
                       hashlib.sha256(text(n).encode()).hexdigest())) for n in info) if built else []


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, b"x", 2) for r in rows], "conv_id long, turn long, role string, text string, node string, n int, key binary, block int").repartition(4)


def got(spark, rows):
    stages = Stages(spark, "test")
    found = T.trie(stages, *T.shared_starts(stages, frame(spark, rows)))
    assert found.columns == T.NODE
    return sorted(str(tuple(r)) for r in found.collect())


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = sorted(str(tuple(r)) for r in T.op13_conversation_trie(spark, SF).collect())
    assert found == brute(rebuilt(rows))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert sorted(str(r) for r in con.sql(T.oracle_sql()).fetchall()) == found


def test_many_shared_starts(spark):
    """Few different turns, so that conversations part at every depth."""
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice(["", "é", "yes"])) for c in range(-60, 400) for t in range(rng.randrange(1, 14))]
    rows += [(c, t, "user", f"hi {t}") for c in range(1000, 1200) for t in range(6)]  # a hot conversation
    assert got(spark, rows) == brute(rebuilt(rows))


def test_long_conversations(spark):
    """Several pieces, equal and parting in the second and at its end."""
    one = [("user", f"t{i % 7}") for i in range(2 * T.PIECE + 30)]
    convs = {0: one, 10: list(one), 15: one[:T.PIECE + 9] + [("bot", "other")] * 8, 20: one[:T.PIECE], 25: one[:2 * T.PIECE], 30: one[:T.PIECE - 1] + [("user", "x")] * 3}
    rows = [(c, i, r, x) for c, v in convs.items() for i, (r, x) in enumerate(v)]
    assert got(spark, rows) == brute(rebuilt(rows))


def test_odd_rows(spark):
    """Null turns, roles, texts and ids, tied and repeated rows, a donor that
    is absent, conversations without turns, one very long text, no rows."""
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", ""), (2, 5, None, "é😀" * 100000), (2, 5, "a", "b"), (2, 5, "a", "b"), (None, 1, "user", "lost"),
            (0, -3, "user", "first"), (0, 9, "", "last"), (-7, 1, "x", "y"), (-9, 0, "user", "z"), (7, 1, "u", "own")]
    rows += [(c, 0, "user", "only") for c in range(100, 130)]
    built = rebuilt(rows)
    assert any(not v for v in built.values())
    assert got(spark, rows) == brute(built)
    assert got(spark, rows[6:7]) == [] and got(spark, rows[:0]) == []
    bare = [(c, 0, "user", "z") for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    assert got(spark, bare) == brute(rebuilt(bare)) and len(brute(rebuilt(bare))) == 1  # a childless root


def test_chunked_ends(spark):
    ids = [5, -3, 1 << 40, 7, (1 << T.CHUNK) + 1, 1 << T.CHUNK, -(1 << 50)]
    ends = spark.createDataFrame([(b"k", i) for i in ids] + [(b"l", 3)], "key binary, conv_id long").repartition(3)
    found = {bytes(r[0]): r[1] for r in T.end_hashes(ends).collect()}
    assert found == {b"k": hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), b"l": hashlib.sha256(b"3").hexdigest()}


def test_one_row_a_distinct_block(spark):
    """Siblings are grouped by block first: copies do not reach the turns."""
    stages = Stages(spark, "test")
    rows = [(c, t, "user", f"{t}") for c in range(0, 500, 5) for t in range(10)]
    turns, _ = T.shared_starts(stages, frame(spark, rows))
    once = T.distinct_blocks(stages, T.blocks(stages, turns))
    assert once.count() == 3 and once.where("split").count() == 0
    assert once.agg(F.max("n")).first()[0] == 100
