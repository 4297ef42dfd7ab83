"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

A token file is a folder of Parquet files that carry blocks as binary columns
(so any store that Spark reaches can hold it). Blocks stand in ascending
``doc_id`` order: by ``part`` (a folder each), then by ``block``.

* ``vocabulary``: ``rank, id``; rank 0 is the most frequent id.
* ``parts``: ``part, first``, the ids of all earlier parts.
* ``blocks``: ``part``, ``block``, ``before`` (ids of the part's earlier
  blocks), ``n_docs``, ``n_ids``, and four buffers: ``doc_ids`` (int64),
  ``sizes`` (uint32 ids of each document), ``control`` and ``data``. The ranks
  of a block are written one after the other in ``data``, in as few
  little-endian bytes as each needs; ``control`` has two bits for each rank,
  four to a byte from the low end, that say how many bytes less one.

Reading takes the sizes of four ranks at once from a table of 256 rows and
finds all places in ``data`` by one running sum.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm import tokens
from harborline.llm.common import Stages, documents

#: A block ends with the document that brings it to so many ids.
BLOCK_IDS = 1 << 18

#: How many bytes each of the four ranks of a control byte takes.
SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1

_RAW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.binary()), ("missing", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])
_RAW_SQL = "part int, block int, before long, n_docs int, n_ids long, doc_ids binary, missing binary, sizes binary, ids binary"
_FILE = pa.schema([f for f in _RAW if f.name != "ids"] + [("control", pa.binary()), ("data", pa.binary())])
_FILE_SQL = _RAW_SQL.rsplit(", ", 1)[0] + ", control binary, data binary"


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of non-negative ranks below 2**32."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    extra = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = extra
    control = padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    kept = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks that ``encode_ranks`` has written."""
    sizes = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n].astype(np.int64)
    first = np.cumsum(sizes) - sizes
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = padded[first].astype(np.uint32)
    for more in (1, 2, 3):
        at = np.flatnonzero(sizes > more)
        ranks[at] |= padded[first[at] + more].astype(np.uint32) << np.uint32(8 * more)
    return ranks


def _rows(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)


def _raw_blocks(docs: DataFrame, tokenizer: str, end_id: int, together: int | None = None) -> DataFrame:
    """Uncoded blocks of the documents in order; ``part`` is the task's place
    in that order."""

    def blocks(batches):
        encoder, end = tokens.encoder(tokenizer), np.array([end_id], np.uint32)
        part, block, before, size = TaskContext.get().partitionId(), 0, 0, 0
        names, parts = [], []

        def full():
            ids = np.concatenate(parts)
            return _rows([{"part": part, "block": block, "before": before, "n_docs": len(names), "n_ids": len(ids), "doc_ids": np.array([x or 0 for x in names], "<i8").tobytes(), "missing": bytes(x is None for x in names), "sizes": np.array([len(x) for x in parts], "<u4").tobytes(), "ids": ids.astype("<u4" if encoder.vocabulary > 1 << 16 else "<u2").tobytes()}], _RAW)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1), together), strict=True):
                names.append(doc_id)
                parts.append(np.concatenate([ids, end]))
                size += len(parts[-1])
                if size >= BLOCK_IDS:
                    yield full()
                    block, before, size, names, parts = block + 1, before + size, 0, [], []
        if names:
            yield full()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(blocks, _RAW_SQL)


def _widths(row_ids: bytes, n_ids: int) -> str:
    return "<u2" if len(row_ids) == 2 * n_ids else "<u4"


def _counts(raw: DataFrame) -> DataFrame:
    def count(batches):
        n = np.zeros(0, np.int64)
        for batch in batches:
            for ids, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.bincount(np.frombuffer(ids, _widths(ids, size)))
                n = np.pad(n, (0, max(0, len(own) - len(n))))
                n[: len(own)] += own
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["id", "n"])

    return raw.select("ids", "n_ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(stages: Stages, docs: DataFrame, tokenizer: str, end_id: int = 1, together: int | None = None) -> str:
    """Write the ids of ``docs`` (``doc_id``, ``text``), each document's ended
    by ``end_id``; returns the folder. A null text is empty, a null id comes
    first and is kept, repeated ids stand next to each other, and an empty
    table gives files without blocks."""
    spark = docs.sparkSession
    raw = stages.write(_raw_blocks(docs, tokenizer, end_id, together), "raw-blocks")
    # one row for each id of the vocabulary that occurs
    ranked = sorted(_counts(raw).collect(), key=lambda r: (-r["n"], r["id"]))
    ids = np.array([r["id"] for r in ranked], np.int64)
    ranks = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    ranks[ids] = np.arange(len(ids))
    stages.write(spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "rank int, id int").coalesce(1), "vocabulary")
    table = spark.sparkContext.broadcast(ranks)

    def code(batches):
        for batch in batches:
            for row in batch.to_pylist():
                control, data = encode_ranks(table.value[np.frombuffer(row.pop("ids"), _widths_of(row))])
                yield _rows([row | {"control": control, "data": data}], _FILE)

    def _widths_of(row):
        return row.pop("width")

    width = F.when(F.length("ids") == 2 * F.col("n_ids"), "<u2").otherwise("<u4")
    coded = raw.withColumn("width", width).mapInArrow(code, _FILE_SQL).sortWithinPartitions("part", "block")
    stages.write(coded, "blocks", by=["part"])
    # a row for each part, that is for each task that has written
    sizes = raw.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    stages.write(sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")).coalesce(1), "parts")
    stages.drop("raw-blocks")
    return stages.root


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Each document of a token file: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, and ``ids`` (array)."""
    return _read(spark, folder, "ids array<int>", pa.list_(pa.int32()), lambda ids: ids.astype(np.int32))


def _read(spark: SparkSession, folder: str, column: str, kind: pa.DataType, of) -> DataFrame:
    blocks = spark.read.schema(_FILE_SQL).parquet(f"{folder}/blocks")
    vocabulary = spark.read.schema("rank int, id int").parquet(f"{folder}/vocabulary").collect()
    ids = np.zeros(len(vocabulary), np.uint32)
    for r in vocabulary:
        ids[r["rank"]] = r["id"]
    table = spark.sparkContext.broadcast(ids)
    firsts = spark.read.schema("part int, first long").parquet(f"{folder}/parts")
    placed = blocks.join(firsts, "part").select((F.col("first") + F.col("before")).alias("start"), "n_ids", "doc_ids", "missing", "sizes", "control", "data")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (column.split()[0], kind)])

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = table.value[decode_ranks(row["control"], row["data"], row["n_ids"])].astype("<u4")
                names, missing = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["missing"], bool)
                sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
                stops = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64(), mask=missing), pa.array(stops - sizes + row["start"], pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array([of(ids[b - n : b]) for b, n in zip(stops, sizes)], kind),
                ], schema=schema)

    return placed.mapInArrow(decode, f"doc_id long, start long, n_tokens long, {column}")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_token_files(Stages(spark, "token-files"), documents(spark, sf_dir), tokens.public_path("word_bpe_49k.json"), together=tokens.TOGETHER)
    return _read(spark, folder, "ids_crc32 long", pa.int64(), zlib.crc32)
