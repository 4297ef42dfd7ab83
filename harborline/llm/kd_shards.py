"""Shards of near equal bytes by a k-d tree over the documents' metadata.

A node that is to become several shards is split along its widest metadata
dimension (the range of its rows over that of all rows) at a weighted median:
the place that leaves the left side its share of the node's bytes, so 40 shards
are 20 and 20, and 5 are 2 and 3. Nodes are split until each is one shard and
so holds the target bytes, the total over the number of shards.

The medians of all nodes of a level are found together: bytes are counted in
``BINS`` steps between each node's smallest and largest coordinate, the step in
which the share is reached is counted again, until a step is one document or
too light to matter. Then the one document whose size comes nearest to what
the left side still lacks, or has too much, changes sides. The driver sees
these histograms (at most ``BINS`` rows a node) and the splits, never documents.

A coordinate is one 63-bit number: 24 bits of place on the dimension (the
logarithm of a number, the hash of a text; null first), then 39 bits that mix
the rows of one place, so that a source, a length or a text that a third of
all rows have is split like any other range. Rows are read once, for their
size, checksum and coordinates; all passes are over that written table.

Null, empty and very long texts count their bytes and ``OVERHEAD``; ids and
metadata may be null and may repeat, equal rows are dealt out like others. With
fewer documents than shards some shards are empty; an empty table gives none.
Columns besides ``doc_id``, ``text`` and the dimensions are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm.common import Stages, table, text_of

SHARDS = 40
OVERHEAD = 16
BINS = 4096
MIX = 39  # bits of a coordinate that mix the rows of one place
#: A step is not counted again if it holds less than this share of a shard.
FINE = 0.0002
#: Rows that one task puts in order for the slots, about.
ROWS = 20_000


def place(value: Column, kind: str) -> Column:
    """Place on a dimension in 24 bits: null first, then the hash of a text or
    the logarithm of a number (below 0 as 0)."""
    if kind == "string":
        at = F.shiftrightunsigned(F.xxhash64(value), 41)
    else:
        at = F.floor(F.log2(F.greatest(value.cast("double"), F.lit(0.0)) + 1) * F.lit(float((1 << 23) - 1) / 1025)).cast("long")
    return F.when(value.isNull(), F.lit(0).cast("long")).otherwise(at + 1)


def measured(docs: DataFrame, dims: list[str]) -> DataFrame:
    """``doc_id, size, text_crc32, row, mix`` and a coordinate ``at_<i>`` for
    each dimension. ``row`` tells rows apart; write the frame before use."""
    kinds = {f.name: f.dataType.typeName() for f in docs.schema.fields}
    text = text_of(docs["text"])
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"),
                       *(place(F.col(f"`{d}`"), kinds[d]).alias(f"place_{i}") for i, d in enumerate(dims)))
    mix = F.shiftleft(F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 40), 15) + F.shiftrightunsigned(F.xxhash64("row"), 49)
    base = base.withColumn("mix", mix)
    return base.select("doc_id", "size", "text_crc32", "row", "mix", *((F.shiftleft(f"place_{i}", MIX) + F.col("mix")).alias(f"at_{i}") for i in range(len(dims))))


@dataclass
class Node:
    """``shards`` shards from ``first`` on; split at ``bound`` (the left side's
    largest coordinate on ``dim``) unless it is one shard. ``moved`` is the row
    that is on the other side."""

    number: int
    first: int
    shards: int
    dim: int | None = None
    bound: int | None = None
    moved: int | None = None
    left: Node | None = None
    right: Node | None = None
    # what the search for the bound knows: range left, bytes below it and all
    lo: int = 0
    hi: int = 0
    below: int = 0
    goal: float = 0.0


def routed(node: Node, of: Callable[[Node], Column]) -> Column:
    """``of(leaf)`` for the leaf that a row comes to."""
    if node.left is None:
        return of(node)
    goes_left = F.col(f"at_{node.dim}") <= F.lit(node.bound)
    if node.moved is not None:
        goes_left = F.when(F.col("row") == F.lit(node.moved), ~goes_left).otherwise(goes_left)
    return F.when(goes_left, routed(node.left, of)).otherwise(routed(node.right, of))


def _within(rows: DataFrame, root: Node, nodes: list[Node], of: Callable[[Node], Column]) -> DataFrame:
    """Rows of ``nodes`` as ``node``, ``size`` and the fields of ``of(node)``."""
    wanted = {n.number for n in nodes}
    value = routed(root, lambda n: F.struct(F.lit(n.number).alias("node"), of(n).alias("v")) if n.number in wanted else F.lit(None))
    return rows.select("size", "row", value.alias("r")).where("r is not null").select("size", "row", "r.node", "r.v")


def tree(rows: DataFrame, dims: int, shards: int) -> Node:
    """The k-d tree over ``measured`` rows, which are a written table."""
    root = Node(0, 0, shards)
    count, level, whole, fine = 1, [root] if shards > 1 else [], None, 0.0
    while level:
        everywhere = F.struct(*(F.col(f"at_{i}") for i in range(dims)))
        found = _within(rows, root, level, lambda n: everywhere).groupBy("node").agg(
            F.sum("size").alias("bytes"), *(f(f"v.at_{i}").alias(f"{name}_{i}") for i in range(dims) for name, f in (("lo", F.min), ("hi", F.max)))).collect()
        if whole is None:
            whole = [max(1, (r[f"hi_{i}"] >> MIX) - (r[f"lo_{i}"] >> MIX)) for r in found for i in range(dims)]
            fine = sum(r["bytes"] for r in found) * FINE / shards
        by = {n.number: n for n in level}
        search = []
        for r in found:
            n = by[r["node"]]
            n.dim = max(range(dims), key=lambda i: (((r[f"hi_{i}"] >> MIX) - (r[f"lo_{i}"] >> MIX)) / whole[i], -i))
            n.lo, n.hi, n.goal = r[f"lo_{n.dim}"], r[f"hi_{n.dim}"], r["bytes"] * (n.shards // 2) / n.shards
            search.append(n)
        if not search:
            break
        reached = _bounds(rows, root, list(search), fine)
        _even_out(rows, root, search, reached)
        level_next = []
        for n in search:
            n.left, n.right = Node(count, n.first, n.shards // 2), Node(count + 1, n.first + n.shards // 2, n.shards - n.shards // 2)
            count += 2
            level_next += [m for m in (n.left, n.right) if m.shards > 1]
        level = level_next  # a node without rows stays one leaf
    return root


def _bounds(rows: DataFrame, root: Node, search: list[Node], fine: float) -> dict:
    """Finds ``bound`` of each node; {node number: bytes of the left side}."""
    reached = {}
    while search:
        step = {n.number: -(-(n.hi - n.lo + 1) // BINS) for n in search}

        def binned(n: Node) -> Column:
            at = F.col(f"at_{n.dim}")
            return F.when(at.between(n.lo, n.hi), F.struct(F.expr(f"(at_{n.dim} - {n.lo}) div {step[n.number]}").alias("bin"), at.alias("at")))

        bins = _within(rows, root, search, binned).where("v is not null").groupBy("node", "v.bin").agg(
            F.sum("size").alias("bytes"), F.min("v.at").alias("lo"), F.max("v.at").alias("hi")).collect()
        of = {n.number: [] for n in search}
        for r in bins:
            of[r["node"]].append(r)
        again = []
        for n in search:
            own = sorted(of[n.number], key=lambda r: r["bin"])
            before, sofar = n.lo - 1, n.below
            for r in own:
                if sofar + r["bytes"] >= n.goal or r is own[-1]:
                    break
                before, sofar = r["hi"], sofar + r["bytes"]
            if r["lo"] < r["hi"] and r["bytes"] > fine:
                n.lo, n.hi, n.below = r["lo"], r["hi"], sofar
                again.append(n)
            elif abs(sofar + r["bytes"] - n.goal) <= abs(sofar - n.goal):
                n.bound, reached[n.number] = r["hi"], sofar + r["bytes"]
            else:
                n.bound, reached[n.number] = before, sofar
        search = again
    return reached


def _even_out(rows: DataFrame, root: Node, nodes: list[Node], reached: dict) -> None:
    """Sets ``moved`` where one document on the wrong side brings the left
    side's bytes nearer to the goal."""
    lack = {n.number: round(n.goal - reached[n.number]) for n in nodes}

    def gap(n: Node) -> Column:
        left = F.col(f"at_{n.dim}") <= F.lit(n.bound)
        # a document moved from the left takes its bytes away
        return F.abs(F.lit(lack[n.number]) - F.when(left, -F.col("size")).otherwise(F.col("size")))

    best = _within(rows, root, nodes, gap).groupBy("node").agg(F.min(F.struct("v", "row")).alias("best")).collect()
    for r in best:
        n = next(n for n in nodes if n.number == r["node"])
        if r["best"]["v"] < abs(lack[n.number]):
            n.moved = r["best"]["row"]


def slots(stages: Stages, placed: DataFrame) -> DataFrame:
    """``placed`` with ``slot``, gapless from 0 in each shard: rows are
    counted and numbered by ranges of ``mix``, several to a shard as they are
    many, and a range starts where the ones before it end."""
    n = placed.count()
    bits = max(0, (n // (SHARDS * ROWS)).bit_length())
    ranged = placed.withColumn("range", F.shiftright("mix", MIX - bits).cast("int") if bits else F.lit(0))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stages.write(ranged.groupBy("shard", "range").agg(F.count("*").alias("n")), "ranges")
    starts = starts.select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("shard", "range").orderBy("mix", "row")) - 1
    numbered = ranged.withColumn("own", own).join(starts, ["shard", "range"])
    return numbered.withColumn("slot", F.col("start") + F.col("own"))


def kd_shards(docs: DataFrame, dims: list[str], shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row of ``docs``
    (``doc_id``, ``text`` and the metadata columns ``dims``)."""
    stages = Stages(docs.sparkSession, "kd-shards")
    rows = stages.write(measured(docs, dims), "measured")
    root = tree(rows, len(dims), shards)
    placed = stages.write(rows.select("doc_id", "size", "text_crc32", "row", "mix", routed(root, lambda n: F.lit(n.first)).alias("shard")), "placed")
    return slots(stages, placed).select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(table(spark, sf_dir, "documents"), ["n_chars", "source", "lang"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
