"""Best-two-fit packing of tokenised documents into fixed-size sequences.

A bin is filled greedily, always with the longest unpacked piece that fits.
Then its smallest piece is taken out again if two unpacked pieces fit the
larger gap more tightly. Only lengths matter for this, and no length exceeds
the capacity, so the driver works on the histogram of lengths (at most
``capacity`` numbers, whatever the corpus): it repeats a bin's pattern for as
long as the histogram can supply it, which is what filling the bins one after
the other would do. The pieces themselves never leave Spark: a piece's rank
among those of its length says which pattern, which repeat of it and which
place it has.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm import tokens
from harborline.llm.common import Stages, documents

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def two_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns ``(repeats, [(length, how many in a bin), ...])`` that use up
    the histogram, lengths in a pattern descending."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        left[length] = n
    places = np.arange(capacity + 1)
    patterns = []
    while left.any():
        used: dict[int, int] = {}
        gap = capacity

        def take(length: int, n: int = 1) -> None:
            nonlocal gap
            left[length] -= n
            gap -= n * length
            used[length] = used.get(length, 0) + n

        while gap and (fits := np.flatnonzero(left[: gap + 1])).size:
            length = int(fits[-1])
            take(length, min(int(left[length]), gap // length))
        smallest = min(used)
        room = gap + smallest
        if gap and room > 2:
            larger = np.flatnonzero(left[:room])
            if larger.size:
                # below[g]: the longest unpacked length up to g (0: none)
                below = np.maximum.accumulate(np.where(left[: room + 1] > 0, places[: room + 1], 0))
                mate = below[np.minimum(larger, room - larger)]
                alone = (mate == larger) & (left[larger] < 2)
                mate[alone] = below[larger[alone] - 1]
                sums = np.where(mate > 0, larger + mate, 0)
                best = len(sums) - 1 - int(sums[::-1].argmax())
                if sums[best] > smallest:
                    left[smallest] += 1
                    used[smallest] -= 1
                    gap = room
                    take(int(larger[best]))
                    take(int(mate[best]))
        used = {k: n for k, n in used.items() if n}
        again = min(int(left[k]) // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= again * n
        patterns.append((again + 1, sorted(used.items(), reverse=True)))
    return patterns


def pack(stages: Stages, items: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` (long): their places in
    sequences of ``capacity``.

    ``length``: an integer column from 1 to ``capacity`` (rows with a null or
    another length are an error). Repeated rows are items of their own; an
    empty table gives an empty one. The columns ``sequence_id``, ``offset``
    and those that start with ``_pack`` are replaced. The ranks of a length
    are dealt out over hash buckets of the rows, so that one very common
    length is not one task's work.
    """
    spark = items.sparkSession
    drop = [c for c in items.columns if c in ("sequence_id", "offset") or c.startswith("_pack")]
    items = stages.write(items.drop(*drop).withColumn("_pack_item", F.monotonically_increasing_id()), "pack-items")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    items = items.withColumns({"_pack_length": F.col(length).cast("long"), "_pack_bucket": F.pmod(F.xxhash64("_pack_item"), F.lit(buckets))})
    sizes = items.groupBy("_pack_length", "_pack_bucket").agg(F.count("*").alias("_pack_n"))
    # at most `capacity` rows
    histogram = sizes.groupBy("_pack_length").agg(F.sum("_pack_n").alias("n")).collect()
    if any(r[0] is None for r in histogram):
        raise ValueError("null length")

    slots, bins, given = [], 0, {}
    for repeats, pattern in two_fit({r[0]: r[1] for r in histogram}, capacity):
        at = 0
        for k, n in pattern:
            first = given.get(k, 0)
            given[k] = first + repeats * n
            slots.append((k, first, given[k], n, bins, at))
            at += k * n
        bins += repeats
    # its size follows from the capacity alone, not from the number of items
    slots = spark.createDataFrame(slots, "_pack_length long, _pack_from long, _pack_to long, _pack_each long, _pack_bin long, _pack_at long")

    earlier = Window.partitionBy("_pack_length").orderBy("_pack_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("_pack_length", "_pack_bucket", F.coalesce(F.sum("_pack_n").over(earlier), F.lit(0)).alias("_pack_first"))
    within = Window.partitionBy("_pack_length", "_pack_bucket").orderBy("_pack_item")
    ranked = items.withColumn("_pack_rank", F.row_number().over(within) - 1).join(firsts, ["_pack_length", "_pack_bucket"])
    rank = F.col("_pack_rank") + F.col("_pack_first")
    placed = ranked.withColumn("_pack_rank", rank).join(
        F.broadcast(slots.withColumnRenamed("_pack_length", "_pack_slot")),
        (F.col("_pack_length") == F.col("_pack_slot")) & (F.col("_pack_rank") >= F.col("_pack_from")) & (F.col("_pack_rank") < F.col("_pack_to")),
    )
    nth = F.col("_pack_rank") - F.col("_pack_from")
    placed = placed.withColumns({
        "sequence_id": F.col("_pack_bin") + F.floor(nth / F.col("_pack_each")),
        "offset": F.col("_pack_at") + (nth % F.col("_pack_each")) * F.col("_pack_length"),
    })
    return placed.drop(*[c for c in placed.columns if c.startswith("_pack")])


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, together: int | None = None) -> DataFrame:
    """Token pieces of every document (``doc_id``, ``text``): its ids, then
    ``end_id``; only documents longer than ``capacity`` are cut. A null text
    counts as empty, a null id stays null, repeated rows give repeated pieces."""

    def cut(batches):
        encoder, end = tokens.encoder(tokenizer), np.array([end_id], np.uint32)
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1), together), strict=True):
                ids = np.concatenate([ids, end]).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((doc_id, piece, start, len(part), zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = [x.split()[0] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, together: int | None = None) -> DataFrame:
    """Tokenise ``docs`` (``doc_id``, ``text``) and pack all of them; a row
    for each piece with its ``sequence_id`` and ``offset``."""
    return pack(Stages(spark, "packing"), pieces(docs, tokenizer, capacity, end_id, together), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, documents(spark, sf_dir), tokens.public_path("word_bpe_49k.json"), together=tokens.TOGETHER)
