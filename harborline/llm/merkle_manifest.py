"""Merkle manifest of a dataset: a tree for each source, and one over those.

**Places without a sort.** A leaf's place is the number of ids before its own
in its source. Each source's ids are a bitmap kept as 64-bit words, of which
only those with an id exist; the words of all tasks are merged by ``bit_or``.
Counts of the words and of three directories over them (2^14 words, 2^14 of
those, and so on) give the rank at which a word starts, each by a running count
over at most 2^16 entries; the bits below an id's own give the rest. A word
whose rows outnumber its bits holds repeated ids: the rows of those words alone
are numbered by range partitions (by id, then leaf, then row), so that one id
may have any number of rows.

**Levels by slots.** ``LEVELS`` levels are reduced at a time: nodes go by their
place into slots of blocks of 3^LEVELS, a block's levels are hashed in one task,
and its digest is a node of the next round, until each source is one block.
Subroots are placed by source and reduced in the same way. Coming down again,
each block gets the siblings above it from its parent block, and the leaves'
blocks yield the proofs. A task holds one block; no shuffle carries more than
a digest a node and a path a block.

Written tables cut the lineage: the leaves, the words, and each round's blocks.

Null ids come first in their source and are never tampered with; equal ids are
ordered by their leaves, and equal rows each have a place of their own. A null
source is a source, and every null or empty field enters the leaf as stated. An
empty table has no root and returns no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm.common import Stages, table
from harborline.operators.paging import number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
#: Levels that one task reduces: a block has FAN ** LEVELS nodes at most.
LEVELS = 7
BLOCK = FAN ** LEVELS
WORD = 6        # a word of the bitmap has 2^6 ids
DIRECTORY = 14  # and an entry of a directory 2^14 of the level below
#: The word of null ids, before all others.
NO_ID = -(1 << 60)


def leaf_text(values: list[Column]) -> Column:
    def one(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.concat(*(one(v) for v in values))


def leaves(docs: DataFrame) -> DataFrame:
    """``key, word, bit, doc_id, leaf, altered`` of each row: its source as a
    key that sorts as asked (null first), its bit in the source's bitmap, its
    digest, and the digest after tampering (null where it is the same)."""
    def digest(text: Column) -> Column:
        return F.unhex(F.sha2(leaf_text([text if f == "text" else F.col(f) for f in FIELDS]), 256))

    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    doc_id = F.col("doc_id").cast("long")
    touched = (F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    return docs.select(*FIELDS).select(
        key.alias("key"), F.coalesce(F.shiftright(doc_id, WORD), F.lit(NO_ID)).alias("word"), F.coalesce(doc_id.bitwiseAND(63), F.lit(0)).cast("int").alias("bit"),
        doc_id.alias("doc_id"), digest(F.col("text")).alias("leaf"), F.when(touched, digest(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("altered"))


def bitmaps(rows: DataFrame) -> DataFrame:
    """``key, word, bits, n``: the words of each source's bitmap, and rows."""
    return rows.groupBy("key", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count("*").alias("n"))


def directory(words: DataFrame) -> DataFrame:
    """``words`` with ``start``, the number of the source's rows before each."""
    up = lambda c: F.shiftright(c, DIRECTORY)
    counts = [words]
    for level in range(3):
        below = "word" if level == 0 else f"d{level}"
        counts.append(counts[-1].groupBy("key", up(below).alias(f"d{level + 1}")).agg(F.sum("n").alias("n")))
    starts = None
    for level in (3, 2, 1, 0):
        at, over = ("word" if level == 0 else f"d{level}"), f"d{level + 1}"
        parents = ["key"] if level == 3 else ["key", over]
        frame = counts[level] if level == 3 else counts[level].withColumn(over, up(at))
        before = F.sum("n").over(Window.partitionBy(*parents).orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
        frame = frame.withColumn("start", F.coalesce(before, F.lit(0)))
        if starts is not None:
            frame = frame.join(starts.withColumnRenamed("start", "above"), parents).withColumn("start", F.col("start") + F.col("above")).drop("above", over)
        starts = frame if level == 0 else frame.drop("n")
    return starts


def placed(stages: Stages, rows: DataFrame) -> DataFrame:
    """``key, at, doc_id, leaf, altered``: ``rows`` with their places."""
    words = stages.write(bitmaps(rows), "words")
    ranks = stages.write(directory(words), "ranks").withColumn("repeated", F.col("n") > F.bit_count("bits"))
    below = F.when(F.col("bit") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftrightunsigned(-1L, 64 - bit)"))
    found = rows.join(ranks.where("NOT repeated").select("key", "word", "bits", "start"), ["key", "word"])
    out = ["key", "at", "doc_id", "leaf", "altered"]
    once = found.withColumn("at", F.col("start") + F.bit_count(F.col("bits").bitwiseAND(below))).select(*out)
    repeated = ranks.where("repeated").select("key", "word", "start")
    if repeated.isEmpty():
        return once
    tied = stages.write(rows.join(repeated, ["key", "word"]).withColumn("row", F.monotonically_increasing_id()), "tied")
    numbered = stages.write(number_rows(tied, [F.col("key"), F.col("word"), F.col("bit"), F.col("leaf"), F.col("row")]), "numbered")
    first = numbered.groupBy("key", "word").agg(F.min("row_no").alias("first"))
    many = numbered.join(first, ["key", "word"]).withColumn("at", F.col("start") + F.col("row_no") - F.col("first"))
    return once.unionByName(many.select(*out))


# ------------------------------------------------------------------ levels
def sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def height(n: int) -> int:
    """Levels over ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def reduced(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes of a block and of the levels above them, as hex text."""
    out = [nodes]
    for _ in range(levels):
        last = out[-1]
        out.append([sha(b"".join(last[i:i + FAN])) for i in range(0, len(last), FAN)])
    return out


def siblings(tree: list[list[bytes]], at: int) -> list[tuple[bytes, bytes]]:
    """What stands left and right of the node at ``at`` in its run, and of
    those above it."""
    out = []
    for level in tree[:-1]:
        run = at - at % FAN
        out.append((b"".join(level[run:at]), b"".join(level[at + 1:run + FAN])))
        at //= FAN
    return out


def _blocks_of(batch: pa.RecordBatch) -> Iterator[tuple[dict, dict]]:
    """Each block's plain columns and the columns of its slots."""
    names = [n for n in batch.schema.names if n != "slots"]
    rows = batch.select(names).to_pylist()
    slots = batch.column("slots")
    ends, fields = slots.offsets.to_pylist(), slots.values
    for i, row in enumerate(rows):
        own = fields.slice(ends[i], ends[i + 1] - ends[i])
        yield row, {own.type.field(j).name: own.field(j).to_pylist() for j in range(own.type.num_fields)}


def _tree(row: dict, slots: dict) -> list[list[bytes]]:
    return reduced([d.hex().encode() for d in slots["leaf"]], min(LEVELS, height(row["n"])))


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [(row["key"], row["block"], row["n"], bytes.fromhex(_tree(row, slots)[-1][0].decode())) for row, slots in _blocks_of(batch)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["key", "at", "n", "leaf"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, slots in _blocks_of(batch):
            tree = _tree(row, slots)
            path = ["".join(f"{a.decode()},{b.decode()};" for a, b in siblings(tree, i)) + row["above"] for i in range(len(tree[0]))]
            at = [row["block"] * BLOCK + i for i in range(len(path))]
            yield pa.RecordBatch.from_arrays([pa.array([row["key"]] * len(path), pa.string()), pa.array(at, pa.int64()), pa.array(path, pa.string())], ["key", "at", "path"])


def blocks(nodes: DataFrame, sizes: DataFrame, payload: list[str]) -> DataFrame:
    """``key, block, n, slots`` from ``key, at`` and ``payload``, and ``key,
    n``. The sizes meet blocks, not nodes, so a large source is not dealt by
    its key alone."""
    slot = F.struct(F.expr(f"CAST(at % {BLOCK} AS INT)").alias("slot"), *payload)
    grouped = nodes.groupBy("key", F.expr(f"at div {BLOCK}").alias("block"))
    return grouped.agg(F.array_sort(F.collect_list(slot)).alias("slots")).join(sizes, "key").select("key", "block", "n", "slots")


def climb(stages: Stages, nodes: DataFrame, sizes: DataFrame, payload: list[str], label: str) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks over nodes (``key, at, leaf`` and ``payload``) and the
    number of each key's (``key, n``), and ``key, leaf`` of the one digest
    left of each key."""
    rounds, roots = [], None
    while True:
        rounds.append(stages.write(blocks(nodes, sizes, payload), f"{label}-{len(rounds)}"))
        tops = stages.write(rounds[-1].mapInArrow(_tops, "key string, at long, n long, leaf binary"), f"{label}-tops-{len(rounds)}")
        done = tops.where(f"n <= {BLOCK}").select("key", "leaf")
        roots = done if roots is None else roots.unionByName(done)
        nodes, payload = tops.where(f"n > {BLOCK}").select("key", "at", "leaf"), ["leaf"]
        if nodes.isEmpty():
            return rounds, roots
        sizes = sizes.where(f"n > {BLOCK}").select("key", F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"))


def descend(stages: Stages, rounds: list[DataFrame], above: DataFrame, label: str) -> DataFrame:
    """The first round's blocks with ``above``, the siblings over each block;
    given ``key, above`` over the keys."""
    paths = None
    for i in range(len(rounds) - 1, -1, -1):
        # a key that this round finished has one block, right under its root
        ends = rounds[i].where(f"n <= {BLOCK}").join(above, "key")
        if paths is None:
            found = ends
        else:
            over = paths.select("key", F.col("at").alias("block"), F.col("path").alias("above"))
            found = ends.unionByName(rounds[i].where(f"n > {BLOCK}").join(over, ["key", "block"]))
        if i:
            paths = stages.write(found.mapInArrow(_paths, "key string, at long, path string"), f"{label}-paths-{i}")
    return found


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    for batch in batches:
        for row, slots in _blocks_of(batch):
            tree, out = _tree(row, slots), []
            above = [tuple(p.encode() for p in level.split(",")) for level in row["above"].split(";")[:-1]]
            for i, leaf in enumerate(tree[0]):
                path = siblings(tree, i) + above
                fold = leaf if slots["altered"][i] is None else slots["altered"][i].hex().encode()
                for left, right in path:
                    fold = sha(left + fold + right)
                proof = sha(b"".join(left + right for left, right in path))
                out.append((slots["doc_id"][i], leaf.decode(), row["subroot"], row["root"], proof.decode(), fold.decode(), fold.decode() == row["root"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names=[f.split()[0] for f in PROOF.split(", ")])


def manifest(docs: DataFrame) -> DataFrame:
    """A row with its proof for each row of ``docs`` (the columns FIELDS)."""
    spark = docs.sparkSession
    stages = Stages(spark, "merkle")
    rows = stages.write(leaves(docs), "leaves")
    nodes = stages.write(placed(stages, rows), "placed")
    sizes = stages.write(nodes.groupBy("key").agg(F.count("*").alias("n")), "sizes")
    rounds, subroots = climb(stages, nodes, sizes, ["doc_id", "leaf", "altered"], "blocks")
    subroots = stages.write(subroots, "subroots")
    sources = stages.write(number_rows(subroots, [F.col("key")]).withColumnRenamed("row_no", "at").withColumnRenamed("key", "source").withColumn("key", F.lit("")), "sources")
    n_sources = spark.createDataFrame([("", sources.count())], "key string, n long")
    over, root = climb(stages, sources, n_sources, ["leaf"], "sources-blocks")
    root = root.first()
    if root is None:
        return spark.createDataFrame([], PROOF)
    top = descend(stages, over, spark.createDataFrame([("", "")], "key string, above string"), "sources")
    paths = top.mapInArrow(_paths, "key string, at long, path string").select("at", F.col("path").alias("above"))
    above = stages.write(sources.drop("key").join(paths, "at").select(F.col("source").alias("key"), "above"), "above")
    named = subroots.select("key", F.lower(F.hex("leaf")).alias("subroot"), F.lit(root["leaf"].hex()).alias("root"))
    found = descend(stages, rounds, above, "leaves").join(named, "key")
    return found.mapInArrow(_proofs, PROOF)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def oracle_sql(leaf_levels: int = 20, source_levels: int = 12) -> str:
    """DuckDB text: every level as a table of its own (a level over one node
    changes nothing), and a leaf's runs at all of them."""
    crc = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)), lambda c, b: "
           "list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))")
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR END"
    leaf = lambda text: f"sha256({' || '.join(part(f) for f in FIELDS[:-1])} || {part(text)})"

    def level(name: str, last: str, key: str) -> str:
        return f"""{name} AS MATERIALIZED (SELECT {key}, pos // {FAN} AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
            (any_value(n) + {FAN - 1}) // {FAN} AS n FROM {last} GROUP BY {key}, pos // {FAN})"""

    def step(name: str, last: str, nodes: str, key: str) -> str:
        """A leaf's way through one level: proof, folded digest, next place."""
        run = f"o.{key} IS NOT DISTINCT FROM f.{key} AND o.pos // {FAN} = f.pos // {FAN}"
        left = f"coalesce((SELECT string_agg(o.h, '' ORDER BY o.pos) FROM {nodes} o WHERE {run} AND o.pos < f.pos), '')"
        right = f"coalesce((SELECT string_agg(o.h, '' ORDER BY o.pos) FROM {nodes} o WHERE {run} AND o.pos > f.pos), '')"
        return f"""{name} AS MATERIALIZED (SELECT * EXCLUDE (lft, rgt, pos, n, fold, proof), pos // {FAN} AS pos, (n + {FAN - 1}) // {FAN} AS n,
            CASE WHEN n > 1 THEN sha256(lft || fold || rgt) ELSE fold END AS fold, CASE WHEN n > 1 THEN proof || lft || rgt ELSE proof END AS proof
            FROM (SELECT f.*, {left} AS lft, {right} AS rgt FROM {last} f))"""

    parts = [f"""d AS MATERIALIZED (SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM
        (SELECT *, xor({crc}, 4294967295) AS crc FROM (SELECT {', '.join(FIELDS)}, doc_id::VARCHAR AS s FROM documents)))""",
             f"e AS MATERIALIZED (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('other')} AS altered FROM d)",
             """l0 AS MATERIALIZED (SELECT doc_id, source, leaf AS h, altered, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                count(*) OVER (PARTITION BY source) AS n FROM e)"""]
    parts += [level(f"l{i + 1}", f"l{i}", "source") for i in range(leaf_levels)]
    parts.append(f"s0 AS MATERIALIZED (SELECT 0 AS one, source, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM l{leaf_levels})")
    parts += [level(f"s{i + 1}", f"s{i}", "one") for i in range(source_levels)]
    parts.append("f0 AS MATERIALIZED (SELECT doc_id, source, h AS leaf, altered AS fold, '' AS proof, pos, n FROM l0)")
    parts += [step(f"f{i + 1}", f"f{i}", f"l{i}", "source") for i in range(leaf_levels)]
    parts.append(f"g0 AS MATERIALIZED (SELECT f.* EXCLUDE (pos, n), s.h AS subroot, s.pos, s.n, 0 AS one FROM f{leaf_levels} f JOIN s0 s ON f.source IS NOT DISTINCT FROM s.source)")
    parts += [step(f"g{i + 1}", f"g{i}", f"s{i}", "one") for i in range(source_levels)]
    return f"""WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = r.h AS verified
        FROM g{source_levels} JOIN s{source_levels} r USING (one)"""
