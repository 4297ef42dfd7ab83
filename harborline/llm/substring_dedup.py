"""Substring deduplication by level-wise doubling.

A passage of ``L`` words can repeat only where its shorter windows repeat. So
windows are judged level by level, and only those that repeat in another
document at one length are extended to twice that length (less what the asked
length leaves over), until the asked length is reached or nothing survives.

The first level need not look at each window: any window of ``length`` words
holds ``length - seed + 1`` windows of ``seed`` words, and the one with the
smallest hash among them depends on its words alone. Equal windows have equal
smallest ones, so only these (a quarter of the positions for 13 and 7) are
counted, and a window whose smallest one does not repeat is dropped.

Windows are 64-bit hashes of their words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.common import Stages, documents, text_of
from harborline.llm.shingles import windows, word_hashes

LENGTH = 13


def seed_of(length: int) -> int:
    """Half a window's length, rounded up."""
    return -(-length // 2)


def least_seeds(hashed: np.ndarray, length: int) -> np.ndarray:
    """Of each window of ``length`` words the smallest hash of its seeds."""
    seed = seed_of(length)
    if len(hashed) < length:
        return np.empty(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(windows(hashed, seed), length - seed + 1).min(axis=1)


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    known = np.sort(known)
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _batch(keys: list[np.ndarray], ids: list[int], names: list[str]) -> pa.RecordBatch:
    sizes = [len(k) for k in keys]
    keys = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(np.array(ids, np.int64), sizes))], names=names)


def _seeds(docs: DataFrame, length: int, copies: bool = False) -> DataFrame:
    """``key, doc_id``: the seeds of each document; of equal texts in a task
    those of the smallest id, or with ``copies`` those of each."""

    def seeds(batches):
        posted: dict[bytes, int] = {}
        for batch in batches:
            least: dict[bytes, int] = {}
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            ids = batch.column(0).to_pylist()
            marks = [hashlib.blake2b(t or b"", digest_size=16).digest() for t in texts]
            for doc_id, mark in zip(ids, marks):
                if doc_id is not None and doc_id < least.get(mark, posted.get(mark, doc_id + 1)):
                    least[mark] = doc_id
            posted |= least
            keys, owners = [], []
            for doc_id, mark, text in zip(ids, marks, texts):
                if doc_id is not None and (copies or least.get(mark) == doc_id):
                    least.pop(mark, None)
                    keys.append(np.unique(least_seeds(word_hashes(text.split()), length)))
                    owners.append(doc_id)
            yield _batch(keys, owners, ["key", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(seeds, "key long, doc_id long")


def _survivors(stages: Stages, rows: DataFrame, label: str, later: bool) -> DataFrame:
    """``doc_id, keys``: of ``rows`` (``key, doc_id``) the keys that stand in
    more than one document; ``later``: only where a smaller id has them."""
    ends = rows.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    kept = rows.join(ends, "key")
    kept = kept.where("doc_id > lo") if later else kept
    return stages.write(kept.groupBy("doc_id").agg(F.collect_list("key").alias("keys")), label)


def _extended(docs: DataFrame, alive: DataFrame, length: int) -> DataFrame:
    """``key, doc_id``: the windows of ``length`` words whose seed survives."""

    def extend(batches):
        for batch in batches:
            keys = []
            for text, known in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)):
                hashed = word_hashes(text.split())
                seeds = least_seeds(hashed, length)
                keys.append(np.unique(windows(hashed, length)[_member(seeds, known.values.to_numpy().view(np.uint64))]))
            yield _batch(keys, batch.column(0).to_pylist(), ["key", "doc_id"])

    return docs.join(alive, "doc_id").select("doc_id", "text", "keys").mapInArrow(extend, "key long, doc_id long")


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of each row (``doc_id``, ``text``;
    other columns are ignored): ``kept`` is the text, words joined by a blank,
    without each word that a window of ``length`` words covers whose words
    also start in a document with a smaller id.

    Windows are judged on the input. A null or empty text has no words. A row
    with a null id is kept whole and removes nothing elsewhere. Rows of one id
    are not smaller than one another, so repeated rows stay. An empty table
    gives an empty one."""
    return _dropped(docs, length, "kept string", pa.string(), lambda words: b" ".join(words).decode())


def _dropped(docs: DataFrame, length: int, column: str, kind: pa.DataType, of) -> DataFrame:
    stages = Stages(docs.sparkSession, "substring-dedup")
    docs = docs.select("doc_id", text_of(docs["text"]).alias("text"))
    seeds = stages.write(_seeds(docs, length), "seeds")
    alive = _survivors(stages, seeds, "alive", later=False)
    stages.drop("seeds")
    grown = stages.write(_extended(docs, alive, length), "windows")
    repeated = _survivors(stages, grown, "repeated", later=True)
    stages.drop("windows", "alive")
    # a whole text that a smaller id has is removed without looking at windows
    copies = docs.where("doc_id is not null").select("doc_id", F.md5("text").alias("mark"))
    first = copies.groupBy("mark").agg(F.min("doc_id").alias("first"))
    copies = copies.join(first, "mark").where("doc_id > first").groupBy("doc_id").agg(F.array_distinct(F.collect_list("mark")).alias("marks"))
    name = column.split()[0]
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), (name, kind)])

    def remove(batches):
        for batch in batches:
            rows = []
            for doc_id, text, known, copy in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                words = text.split()
                n = len(words)
                if copy and n >= length:
                    words = []
                elif known.is_valid and n >= length:
                    hit = _member(windows(word_hashes(words), length), known.values.to_numpy().view(np.uint64))
                    edge = np.zeros(n + 1, np.int64)
                    edge[: len(hit)] += hit
                    edge[length : length + len(hit)] -= hit
                    covered = np.cumsum(edge[:n]) > 0
                    words = [w for w, gone in zip(words, covered.tolist()) if not gone]
                rows.append((doc_id, n, n - len(words), of(words)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    joined = docs.join(repeated, "doc_id", "left").join(copies, "doc_id", "left").select("doc_id", "text", "keys", F.array_contains("marks", F.md5("text")).alias("copy"))
    return joined.mapInArrow(remove, f"doc_id long, n_words long, n_removed long, {column}")


def longest_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, longest``: of each document that shares a window of
    ``length`` words with another one, the longest of the lengths ``length``,
    twice that, and so on, at which it still does. A level extends a window by
    the one that follows it, both of them repeated; it ends when none survive."""
    stages = Stages(docs.sparkSession, "longest-repeats")
    docs = docs.select("doc_id", text_of(docs["text"]).alias("text"))
    alive = _survivors(stages, stages.write(_seeds(docs, length, copies=True), "seeds"), "alive-0", later=False)
    rows = stages.write(_extended(docs, alive, length), "windows-0")
    found, size, n = None, length, 0
    while True:
        alive = _survivors(stages, rows, f"level-{n}", later=False)
        if alive.isEmpty():
            break
        level = alive.select("doc_id", F.lit(size).alias("longest"))
        found = level if found is None else found.union(level)

        def double(batches, size=size):
            for batch in batches:
                keys = []
                for text, known in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)):
                    hashed = word_hashes(text.split())
                    alive = _member(windows(hashed, size), known.values.to_numpy().view(np.uint64))
                    both = alive[:-size] & alive[size:] if len(alive) > size else np.empty(0, bool)
                    keys.append(np.unique(windows(hashed, 2 * size)[both]))
                yield _batch(keys, batch.column(0).to_pylist(), ["key", "doc_id"])

        size, n = 2 * size, n + 1
        rows = stages.write(docs.join(alive, "doc_id").select("doc_id", "text", "keys").mapInArrow(double, "key long, doc_id long"), f"windows-{n}")
    if found is None:
        return docs.select("doc_id", F.lit(0).alias("longest")).where("false")
    return found.groupBy("doc_id").agg(F.max("longest").alias("longest"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dropped(documents(spark, sf_dir), LENGTH, "kept_sha256 string", pa.string(), lambda words: hashlib.sha256(b" ".join(words)).hexdigest())


def oracle_sql() -> str:
    """DuckDB text: every window of every document, and where it first starts."""
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    g AS (SELECT r, doc_id, i, array_to_string(w[i:i + {LENGTH - 1}], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {LENGTH - 2})) AS i FROM d)),
    f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
    c AS (SELECT DISTINCT r, unnest(range(i, i + {LENGTH})) AS i FROM g JOIN f USING (g) WHERE doc_id > first),
    k AS (SELECT r, list(i) AS gone FROM c GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
      sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: NOT list_contains(gone, z[2])), lambda z: z[1]) END, ' ')) AS kept_sha256
    FROM d LEFT JOIN k USING (r)"""
