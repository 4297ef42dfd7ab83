"""Scores of whole texts by a gated recurrent language model.

*Counts.* All words of the training texts are counted. The base model gives a
word with count ``c`` the chance ``(c + 0.5) / (N + 0.5 (V + 1))``.

*Network.* The most frequent words that make up ``COVER`` of the training
tokens, ``KNOWN`` at least (and the end of a text), are predicted by a GRU with
a class-factored softmax (``gru``), whose classes number about the square root
of half the words. So the known words grow with the input's vocabulary. All other words
are one class; within it, the base model's chances hold. So each text has a
probability, whatever its words. Its inputs are the known words, and of other
words a number from their last two letters.

*Places.* Texts are split and their words numbered in Arrow, some MB at a time;
each token's place among the network's inputs is written once, and training and
scoring read that.

*Training.* Every training text is learnt from once, in ``ROUNDS`` rounds.
In a round each task trains a copy of the network on its own texts, of
``TASK`` tokens on average at least; the copies' weights are averaged by the
tokens they have seen, first within groups of copies, then over these. The
network starts from the base model's shares, so it is never far below it.

*Scoring.* Each task runs all its texts side by side, carrying the state from
window to window, so a score is that of the complete text. Words that are
frequent enough for a broadcast list (at least ``1 / SHARE`` of all tokens each,
so at most ``SHARE`` words) are looked up in the task. Only the other, rare
ones are joined with the table of counts; none of them can be a hot key.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import gru
from harborline.llm.common import Stages, documents, text_of
from harborline.llm.shingles import numbered, word_hashes

#: Share of the training tokens whose words the network knows; words and
#: classes at least; input places for other words.
COVER, KNOWN, CLASSES, OTHERS = 0.7, 512, 16, 64
#: Weights in a row, where copies are averaged.
CHUNK = 1 << 15
#: Groups in which copies are averaged first.
GROUPS = 256
ROUNDS, RATE = 2, 0.06
#: Tokens that a copy learns from in a round, on average, at least.
TASK = 1 << 20
SHARE = 2_000_000
FOLDS, HELD_OUT = 5, 1

#: The hash that stands for the end of a text.
END = np.uint64(0x9E6C63D0676A9A99)

def fold(doc_id) -> int:
    """Null counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def tokens(text: bytes) -> np.ndarray:
    """Hashes of the words, A-Z lower-cased, and one end."""
    return np.append(word_hashes(text.lower().split()), END)


class Vocabulary:
    """Words of the broadcast list with their counts, and the known ones."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n_tokens: int, n_words: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.n_tokens, self.n_words = n_tokens, n_words
        rank = np.lexsort((self.words, -self.counts))
        rank = np.concatenate([rank[self.words[rank] == END], rank[self.words[rank] != END]])
        rank = rank[: max(KNOWN, int(np.searchsorted(np.cumsum(self.counts[rank]), COVER * n_tokens)) + 1)]
        rank = rank[np.argsort(-self.counts[rank], kind="stable")]
        self.known = np.full(len(self.words) + 1, -1, np.int64)
        self.known[rank] = np.arange(len(rank))
        self.n_known = len(rank)
        self.shares = self.chance(self.counts[rank])
        self.rest = max(1 - self.shares.sum(), 1e-12)

    def chance(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.n_tokens + 0.5 * (self.n_words + 1))

    def layout(self) -> gru.Layout:
        return gru.Layout(self.shares, max(CLASSES, math.isqrt(self.n_known // 2)), self.n_known + OTHERS + 1)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the list of each word (-1: none)."""
        if not len(self.words):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def inputs(self, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Input of the network for words at these places in the list."""
        known = self.known[at]  # of place -1 the last, which is none
        return np.where(known >= 0, known, self.n_known + ends % OTHERS).astype(np.int32)

    def steps(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and words to predict of a text, whose tokens as inputs are
        ``codes``, the end included."""
        x = np.empty(len(codes), np.int32)
        x[0] = self.n_known + OTHERS
        x[1:] = codes[:-1]
        return x, np.minimum(codes, self.n_known)


def _counts(docs: DataFrame) -> DataFrame:
    """``word, n``: the words of all ``docs``."""

    def count(batches):
        for batch in batches:
            for hashes, _, at, per_text in numbered(batch.column(0)):
                n = np.bincount(at, minlength=len(hashes))
                word, n = np.append(hashes[n > 0], END), np.append(n[n > 0], len(per_text))
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _texts(codes: pa.Array, vocabulary: Vocabulary) -> list[tuple[np.ndarray, np.ndarray]]:
    return [vocabulary.steps(np.frombuffer(c, np.int32)) for c in codes.to_pylist()]


def _round(rows: DataFrame, vocabulary, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The mean of the weights that each task has after its texts
    (``codes``)."""
    start = rows.sparkSession.sparkContext.broadcast(weights)

    def train(batches):
        net = gru.Network(vocabulary.value.layout(), {k: w.copy() for k, w in start.value.items()})
        adam, n = {}, 0
        for batch in batches:
            n += net.train(_texts(batch.column(0), vocabulary.value), adam, RATE)
        if n:
            values, own = gru.flat(net.w), TaskContext.get().partitionId() % GROUPS
            for at in range(0, len(values), CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([at // CHUNK]), pa.array([own]), pa.array([float(n)]), pa.array([values[at : at + CHUNK].tobytes()], pa.binary())], names=["chunk", "own", "n", "w"])

    def mean(batches, dtype):
        """One mean of a group, whose rows come in batches."""
        first, n, total = None, 0.0, 0.0
        for batch in batches:
            for chunk, own, k, w in zip(*(batch.column(i).to_pylist() for i in range(4))):
                first, n, total = first or (chunk, own), n + k, total + k * np.frombuffer(w, dtype).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([first[0]]), pa.array([first[1]]), pa.array([n]), pa.array([(total / n).tobytes()], pa.binary())], names=["chunk", "own", "n", "w"])

    schema = "chunk long, own long, n double, w binary"
    of_groups = rows.select("codes").mapInArrow(train, schema).groupBy("chunk", "own").applyInArrow(_whole(mean, np.float32), schema)
    # as many numbers as the network has weights
    got = of_groups.groupBy("chunk").applyInArrow(_whole(mean, np.float64), schema).select("chunk", "w").toArrow().sort_by("chunk")
    values = np.frombuffer(b"".join(got["w"].to_pylist()), np.float64) if len(got) else gru.flat(weights)
    return gru.unflat(values, weights)


def _whole(of_batches, *args):
    def of_table(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(of_batches(group.to_batches(), *args))

    return of_table


def _coded(docs: DataFrame, vocabulary) -> DataFrame:
    """A row for each document, with the sum of the base scores of its listed
    words, and one for each of its distinct words not listed (``word, n``)."""
    schema = pa.schema([("key", pa.int64()), ("word", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_known", pa.int64()), ("base", pa.float64()), ("codes", pa.binary())])

    def code(batches):
        v, key = vocabulary.value, TaskContext.get().partitionId() << 40
        end = v.places(np.array([END]))
        end_code, end_listed = v.inputs(end, np.zeros(1, np.int64)), int(end[0] >= 0)
        base_of = np.append(np.log10(v.chance(v.counts)), 0.0)
        for batch in batches:
            row = 0
            for hashes, ends, at, per_text in numbered(batch.column(1)):
                place = v.places(hashes)
                codes, base, listed = v.inputs(place, ends)[at], base_of[place][at], (place >= 0)[at]
                stops = np.cumsum(per_text)
                n, keys = len(per_text), key + np.arange(len(per_text))
                upto = [np.concatenate([[0], np.cumsum(x)]) for x in (base, listed)]
                bases, known = (x[stops] - x[stops - per_text] for x in upto)
                codes = np.insert(codes, stops, end_code)
                edges = pa.array(np.append(0, stops + np.arange(1, n + 1)) * codes.itemsize, pa.int32())  # or fails
                texts = pa.Array.from_buffers(pa.binary(), n, [None, edges.buffers()[1], pa.py_buffer(codes)])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(n, pa.int64()), pa.array(per_text + 1), batch.column(0).slice(row, n), batch.column(2).slice(row, n),
                                                  pa.array(known + end_listed), pa.array(bases + base_of[end[0]]), texts], schema=schema)
                # of words not listed: how often each text has them
                of_text, word = np.repeat(np.arange(n), per_text)[~listed], at[~listed]
                pair, times = np.unique(of_text * max(len(hashes), 1) + word, return_counts=True)
                owner, word = keys[pair // max(len(hashes), 1)], hashes[pair % max(len(hashes), 1)] if len(hashes) else np.empty(0, np.uint64)
                if not end_listed:
                    owner, word, times = np.append(owner, keys), np.append(word, np.full(n, END)), np.append(times, np.ones(n, np.int64))
                if len(owner):
                    void = [pa.nulls(len(owner), f.type) for f in list(schema)[3:]]
                    yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(word.view(np.int64)), pa.array(times.astype(np.int64)), *void], schema=schema)
                key, row = key + n, row + n

    return docs.select("doc_id", "text", "held_out").mapInArrow(code, "key long, word long, n long, doc_id long, held_out boolean, n_known long, base double, codes binary")


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` of each row of ``docs`` (``doc_id``, ``text``; other columns are
    ignored). Scores are log10 probabilities. A null or empty text is its end
    alone. A null id is in the training part. Repeated rows are texts of their
    own. Without training texts all words are unknown, and the network gives
    the base model's score."""
    spark = docs.sparkSession
    stages = Stages(spark, "language-model")
    fold_of = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))
    docs = docs.select("doc_id", text_of(docs["text"]).alias("text"), (fold_of == HELD_OUT).alias("held_out"))
    train = docs.where("not held_out")
    counts = stages.write(_counts(train), "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_tokens, n_words = int(total["n"]), int(total["v"])
    # at most SHARE words, as each is that share of the tokens
    listed = counts.where(F.col("n") * SHARE >= n_tokens).toPandas()
    listed = Vocabulary(listed["word"].to_numpy(np.int64).view(np.uint64), listed["n"].to_numpy(np.int64), n_tokens, n_words)
    vocabulary = spark.sparkContext.broadcast(listed)
    layout = listed.layout()
    weights = layout.start(np.append(listed.shares, listed.rest))
    coded = stages.write(_coded(docs, vocabulary), "coded")
    learnt = coded.where("word is null and not held_out").select("key", "codes")
    tasks = max(1, n_tokens // (ROUNDS * TASK))
    for k in range(ROUNDS if n_tokens else 0):
        weights = _round(learnt.where(F.pmod(F.xxhash64("key"), F.lit(ROUNDS)) == k).coalesce(tasks), vocabulary, weights)
    network = spark.sparkContext.broadcast(weights)

    def judge(batches):
        v = vocabulary.value
        net = gru.Network(v.layout(), network.value)
        base_of = np.append(np.log10(v.shares), math.log10(v.rest))
        for batch in batches:
            texts = _texts(batch.column(6), v)
            # what the network adds to the base model, token by token
            gain = net.score(texts) / math.log(10) - base_of[np.concatenate([y for _, y in texts])] if texts else np.empty(0)
            sizes = np.array([len(x) for x, _ in texts], np.int64)
            gains = np.add.reduceat(gain, np.cumsum(sizes) - sizes) if texts else gain
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(6)), pa.array(gains, pa.float64())], names=["key", "n", "doc_id", "held_out", "n_known", "base", "gain"])

    rows = coded.where("word is null").select("key", "n", "doc_id", "held_out", "n_known", "base", "codes")
    rows = stages.write(rows.mapInArrow(judge, "key long, n long, doc_id long, held_out boolean, n_known long, base double, gain double"), "rows")
    rare = coded.where("word is not null").select("key", "word", "n").join(counts.withColumnRenamed("n", "c"), "word", "left")
    chance = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / (n_tokens + 0.5 * (n_words + 1)))
    rare = rare.groupBy("key").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"), F.sum(F.col("n") * chance).alias("rare_base"))
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0))
    return rows.join(rare, "key", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"),
    )


def op9_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
