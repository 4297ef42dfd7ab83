"""Prefix trie of conversations by fixed-length block hashing.

A turn becomes a digest of role and text; only digests and byte counts go on.
A conversation is cut into blocks of ``TURNS`` turns. The digest of a block's
last turn covers all turns up to it, so conversations are grouped by successive
block digests, and each distinct block is kept once, with the smallest
conversation in it and their number. Where a block has no sibling (no other
block follows the one before it) its turns are nodes as they stand; only where
siblings diverge are the turns within the blocks grouped again, one row for
each distinct block and not for each conversation.

Figures over subtrees come without walking the tree. A node is owned by its
smallest conversation, and the nodes that a conversation owns are the last ones
of its path. What a subtree saves is then the bytes of all turns in it that
their conversation does not own, and its leaves are the conversations that own
a childless node: sums over conversations, from counts within a block and
running counts over a conversation's later blocks.

A conversation of any length is cut into pieces of ``PIECE`` turns that differ-
ent tasks hash; the last digest of a piece is chained over the pieces alone.
Turns are numbered by range partitions, ids at an end are hashed as a stream of
sorted chunks. Hot keys (a first turn, a whole conversation) are counted
map-side, and their joins can be split by AQE, as the other side has one row a
key. Written tables cut the lineage after each step.

Turns are ordered by ``turn`` (null first), then by digest; equal rows are
turns of their own. Null or empty roles and texts are empty. Rows without a
conversation id belong to none and are left out. Negative ids: the donor is
c - c % 5 with the sign of c. An empty table has no nodes. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm.common import Stages, table, text_of
from harborline.operators.paging import number_rows

TURNS = 4
#: Turns of a conversation that one task hashes; a multiple of TURNS.
PIECE = 1024
#: Ids at an end are put in order in ranges of 2^CHUNK ids.
CHUNK = 14
WIDTH = 16  # bytes of a digest


def turn_digest(role: Column, text: Column) -> Column:
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.left(whole, F.lit(2 * WIDTH)))


def numbered(stages: Stages, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, at, digest, bytes`` of each turn, ``at`` from 0 in its
    conversation, and ``conv_id, n`` of each conversation."""
    c = conversations
    role, text = text_of(c["role"]), text_of(c["text"])
    turns = c.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", turn_digest(role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    turns = stages.write(turns, "turns")
    turns = number_rows(turns, [F.col(k) for k in ("conv_id", "turn", "digest", "row")])
    turns = stages.write(turns.select("conv_id", "row_no", "digest", "bytes"), "numbered")
    convs = stages.write(turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("row_no").alias("first")), "conversations")
    at = turns.join(convs, "conv_id").select("conv_id", (F.col("row_no") - F.col("first")).alias("at"), "digest", "bytes")
    return at, convs.select("conv_id", "n")


def shared_starts(stages: Stages, conversations: DataFrame, groups: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that start as the first of their ``groups`` does, for
    unsigned crc32(id) % ``most`` turns: ``conv_id, at, digest, bytes,
    length`` of each turn, and ``conv_id, length`` of each conversation."""
    turns, convs = numbered(stages, conversations)
    turns = stages.write(turns, "own-turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % groups).alias("donor"))
    donors = convs.select(F.col("conv_id").alias("donor"), F.col("n").alias("n_donor"))
    taken = F.least("h", F.coalesce("n_donor", F.lit(0)))
    convs = convs.join(donors, "donor", "left").select("conv_id", "donor", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    convs = stages.write(convs, "rebuilt")
    out = ["conv_id", "at", "digest", "bytes", "length"]
    own = turns.join(convs, "conv_id").where("at >= h").withColumn("at", F.expr("at - h + taken")).select(*out)
    heads = turns.where(F.col("at") < most).select(F.col("conv_id").alias("donor"), "at", "digest", "bytes")
    taken = convs.where("taken > 0").join(heads, "donor").where("at < taken").select(*out)
    return own.unionByName(taken), convs.select("conv_id", "length")


# ------------------------------------------------------------------- digests
def sha(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:WIDTH]


def piece_end(before: bytes, digests: list[bytes]) -> bytes:
    """The node at the end of a full piece, from the one before the piece."""
    return sha(b"piece", before, sha(*digests))


def piece_blocks(before: bytes, digests: list[bytes]) -> Iterator[tuple[bytes, list[bytes]]]:
    """Each block's parent node and nodes; a node's digest covers all turns
    from the first of the conversation on."""
    parent = before
    for i in range(0, len(digests), TURNS):
        own = digests[i:i + TURNS]
        nodes = [sha(parent, *own[:j + 1]) for j in range(len(own))]
        if i + len(own) == PIECE:
            nodes[-1] = piece_end(before, digests)
        yield parent, nodes
        parent = nodes[-1]


def _lists(column: pa.ListArray, field: str) -> Iterator[list]:
    ends, values = column.offsets.to_pylist(), column.values.field(field).to_pylist()
    for a, z in zip(ends, ends[1:]):
        yield values[a:z]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sums = [sha(*d) for d in _lists(b.column("turns"), "digest")]
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("piece"), pa.array(sums, pa.binary())], ["conv_id", "piece", "sum"])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for conv, sums in zip(b.column("conv_id").to_pylist(), _lists(b.column("sums"), "sum")):
            before = [b""]
            for s in sums[:-1]:
                before.append(sha(b"piece", before[-1], s))
            yield pa.RecordBatch.from_arrays([pa.array([conv] * len(before), pa.int64()), pa.array(range(len(before)), pa.int64()), pa.array(before, pa.binary())], ["conv_id", "piece", "before"])


BLOCK = "conv_id long, block long, last boolean, parent binary, key binary, nodes array<binary>, bytes array<long>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    for b in batches:
        out, plain = [], (b.column(c).to_pylist() for c in ("conv_id", "piece", "length", "before"))
        for conv, piece, length, before, digests, sizes in zip(*plain, _lists(b.column("turns"), "digest"), _lists(b.column("turns"), "bytes")):
            at = piece * PIECE
            for i, (parent, nodes) in enumerate(piece_blocks(before, digests)):
                done = at + i * TURNS + len(nodes)
                out.append((conv, at // TURNS + i, done == length, parent, nodes[-1], nodes, sizes[i * TURNS:i * TURNS + len(nodes)]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names=[f.split()[0] for f in BLOCK.split(", ")])


def blocks(stages: Stages, turns: DataFrame) -> DataFrame:
    """The blocks (BLOCK) of each conversation."""
    turn = F.struct("at", "digest", "bytes")
    pieces = turns.groupBy("conv_id", F.expr(f"at div {PIECE}").alias("piece")).agg(F.first("length").alias("length"), F.array_sort(F.collect_list(turn)).alias("turns"))
    pieces = stages.write(pieces, "pieces")
    longer = pieces.where("piece > 0").select("conv_id").distinct()
    sums = pieces.join(longer, "conv_id", "left_semi").mapInArrow(_sums, "conv_id long, piece long, sum binary")
    chains = sums.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "sum"))).alias("sums"))
    before = chains.mapInArrow(_chained, "conv_id long, piece long, before binary")
    begun = pieces.join(before, ["conv_id", "piece"], "left").withColumn("before", F.coalesce("before", F.lit(b"")))
    return stages.write(begun.mapInArrow(_blocks, BLOCK), "blocks")


# --------------------------------------------------------------------- nodes
def _bytes(condition: str) -> Column:
    """Bytes of the block's turns ``i`` for which ``condition`` holds."""
    return F.expr(f"aggregate(filter(bytes, (b, i) -> {condition}), 0L, (a, b) -> a + b)")


def _turns_of(distinct: DataFrame) -> DataFrame:
    """A row for each turn ``i`` of the distinct blocks, with its node, the
    node before it and its depth."""
    rows = distinct.select("*", F.posexplode("nodes").alias("i", "node"))
    before = F.when(F.col("i") == 0, F.col("parent")).otherwise(F.get("nodes", F.col("i") - 1))
    return rows.withColumn("before", before).withColumn("depth", F.col("block") * TURNS + F.col("i") + 1)


def distinct_blocks(stages: Stages, rows: DataFrame) -> DataFrame:
    """Each distinct block once: ``key, conv_id`` (the smallest), ``n``,
    ``parent, block, nodes, bytes``, whether it has siblings (``split``), and
    ``owned``, the first of its turns that ``conv_id`` owns (their number if
    it owns none)."""
    once = rows.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("parent", "block", "nodes", "bytes")))
    once = stages.write(once, "distinct-blocks")
    # joined by the block, not by the parent, which may have any number of them
    alone = once.groupBy("parent").agg(F.count("*").alias("n"), F.min("key").alias("key")).where("n = 1").select("key", F.lit(False).alias("split"))
    once = stages.write(once.join(alone, "key", "left").withColumn("split", F.coalesce("split", F.lit(True))), "siblings")
    turns = _turns_of(once.where("split")).select("key", "conv_id", "i", "node")
    owners = turns.groupBy("node").agg(F.min("conv_id").alias("owner"))
    first = turns.join(owners, "node").where("conv_id = owner").groupBy("key").agg(F.min("i").alias("first"))
    owned = F.when(~F.col("split"), 0).otherwise(F.coalesce("first", F.size("nodes")))
    return stages.write(once.join(first, "key", "left").withColumn("owned", owned).drop("first"), "owned")


def _grouped(turns: DataFrame, *sums: str) -> DataFrame:
    """Nodes from the turns of distinct blocks: those of blocks without
    siblings as they are, the others together."""
    alone = turns.where("NOT split").select("node", "conv_id", "n", "before", "depth", *sums)
    split = turns.where("split").groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.first("before").alias("before"), F.first("depth").alias("depth"), *(F.sum(s).alias(s) for s in sums))
    return alone.unionByName(split)


def later_copies(rows: DataFrame, distinct: DataFrame) -> DataFrame:
    """``key, conv_id, later``: of each conversation's block, the bytes in its
    later blocks that it does not own. Counted by piece, then within."""
    facts = distinct.select("key", F.col("conv_id").alias("owner"), _bytes("true").alias("all"), _bytes("i < owned").alias("part"))
    rows = rows.select("conv_id", "block", "key", F.expr(f"block div {PIECE // TURNS}").alias("piece")).join(facts, "key")
    rows = rows.withColumn("copied", F.when(F.col("conv_id") == F.col("owner"), F.col("part")).otherwise(F.col("all")))
    after = lambda keys, by: F.coalesce(F.sum("copied").over(Window.partitionBy(*keys).orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = rows.groupBy("conv_id", "piece").agg(F.sum("copied").alias("copied")).select("conv_id", "piece", after(["conv_id"], "piece").alias("beyond"))
    own = rows.withColumn("within", after(["conv_id", "piece"], "block"))
    return own.join(pieces, ["conv_id", "piece"]).select("key", "conv_id", (F.col("within") + F.col("beyond")).alias("later"))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each key's chunks, which come one after the other."""
    def row(key: bytes, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    key, state = None, None
    for b in batches:
        keys, shas = [], []
        for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
            if k != key:
                if key is not None:
                    keys.append(key)
                    shas.append(state.hexdigest())
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas)], ["key", "ends_sha256"])
    if key is not None:
        yield row(key, state)


def end_hashes(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of ``key, conv_id``: ids in order, comma-joined."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = ends.groupBy("key", F.shiftright("conv_id", CHUNK).alias("chunk")).agg(ids.alias("ids"))
    ordered = chunks.repartition("key").sortWithinPartitions("key", "chunk")
    return ordered.select("key", "ids").mapInArrow(_streamed, "key binary, ends_sha256 string")


NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(stages: Stages, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes (NODE) over ``conv_id, at, digest, bytes, length`` of turns
    and ``conv_id, length`` of conversations, written tables."""
    spark = turns.sparkSession
    rows = blocks(stages, turns)
    once = distinct_blocks(stages, rows)
    ends = stages.write(rows.where("last").select("key", "conv_id").unionByName(convs.where("length = 0").select(F.lit(b"").alias("key"), "conv_id")), "ends")
    n_ends = ends.groupBy(F.col("key").alias("node")).agg(F.count("*").alias("n_ends"))
    # a node is childless if all its conversations end there
    leaves = _grouped(_turns_of(once)).join(n_ends, "node").where("n = n_ends").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    leaves = stages.write(leaves, "leaves")
    members = later_copies(rows, once).join(leaves, "conv_id", "left").groupBy("key").agg(F.sum("later").alias("later"), F.count("leaf").alias("n_leaves"))
    of_turn = _turns_of(once.join(members, "key"))
    saved = F.col("later") + (F.col("n") - 1) * _bytes("i >= turn") + _bytes("i >= turn AND i < owned")
    nodes = _grouped(of_turn.withColumnRenamed("i", "turn").withColumn("saved", saved), "saved", "n_leaves")
    nodes = stages.write(nodes, "nodes")

    total = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).first()
    if not total["n"]:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    top = nodes.where("depth = 1").agg(F.sum("saved").alias("saved"), F.sum("n_leaves").alias("leaves")).first()
    root = spark.createDataFrame([(b"", total["conv_id"], total["n"], None, 0, top["saved"] or 0, top["leaves"] or 1)], "node binary, conv_id long, n long, before binary, depth long, saved long, n_leaves long")
    # the root's children need no join: its conversation is known
    below = nodes.where("depth > 1").join(nodes.select(F.col("node").alias("before"), F.col("conv_id").alias("parent_conv_id")), "before")
    known = root.withColumn("parent_conv_id", F.lit(None).cast("long")).unionByName(nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(total["conv_id"])))
    children = nodes.groupBy(F.col("before").alias("node")).agg(F.count("*").alias("n_children"))
    out = below.unionByName(known).join(children, "node", "left").join(end_hashes(ends).withColumnRenamed("key", "node"), "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "trie")
    return trie(stages, *shared_starts(stages, table(spark, sf_dir, "conversations")))


def oracle_sql() -> str:
    """DuckDB text: every conversation at every depth, and every pair of a
    node and one in its subtree."""
    crc = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)), lambda c, b: "
           "list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))")
    return f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    d AS (SELECT conv_id, {{'role': role, 'text': text}} AS said, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        sha256(octet_length(encode(role))::VARCHAR || ':' || role || text)) AS pos FROM t),
    o AS (SELECT conv_id, list(said ORDER BY pos) AS own FROM d GROUP BY conv_id),
    h AS (SELECT conv_id, own, xor({crc}, 4294967295) % 9 AS h FROM (SELECT *, conv_id::VARCHAR AS s FROM o)),
    r AS (SELECT h.conv_id, list_concat(coalesce(list_slice(p.own, 1, h.h), []), coalesce(list_slice(h.own, h.h + 1, len(h.own)), [])) AS said
        FROM h LEFT JOIN o p ON p.conv_id = h.conv_id - h.conv_id % 5),
    m AS MATERIALIZED (SELECT conv_id, len(said) AS n, unnest(range(0, len(said) + 1)) AS depth, said FROM r),
    k AS MATERIALIZED (SELECT conv_id, depth, n = depth AS ends, CASE WHEN depth = 0 THEN '' ELSE md5(to_json(said[1:depth])::VARCHAR) END AS node,
        CASE WHEN depth = 0 THEN NULL WHEN depth = 1 THEN '' ELSE md5(to_json(said[1:depth - 1])::VARCHAR) END AS parent,
        CASE WHEN depth = 0 THEN 0 ELSE octet_length(encode(said[depth].text)) END AS size FROM m),
    nodes AS MATERIALIZED (SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM k GROUP BY node, depth),
    c AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
    facts AS MATERIALIZED (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN c USING (node)),
    above AS (SELECT DISTINCT a.node AS top, b.node FROM k a JOIN k b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
    sums AS (SELECT top AS node, sum(saved) AS saved_tokens, count_if(n_children = 0) AS n_leaves FROM above JOIN facts USING (node) GROUP BY top)
    SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
    FROM facts f JOIN sums USING (node) LEFT JOIN facts p ON p.node = f.parent"""
