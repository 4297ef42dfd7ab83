"""I-Match document fingerprints over randomised lexicons.

The lexicon is the terms whose inverse document frequency lies in a band: those
in at least ``RARE`` and at most ``COMMON`` of all documents (and in two at
least). A document keeps its terms in the lexicon, distinct and sorted. Random
subsets of the lexicon cut that list down, and each cut list is hashed. Two
documents agree on a subset if no term that only one of them has is in it.

How much of the lexicon a subset should hold depends on the document: with
``T`` terms kept, subsets of a share near 1/T hold about one of them, and the
share of subsets agreed on is then close to the Jaccard similarity of the
lists. So a fingerprint has ``SUBSETS`` hashes for each of ``LEVELS`` shares,
powers of two around 1/T, and fingerprints are compared on those that both
have. A subset's terms on one level include those on the next; for each term of
the lexicon and each subset, the highest level is looked up in a table.

Terms are the runs of other characters than white space and ASCII punctuation,
A-Z lower-cased, held as 64-bit hashes. A document none of whose terms are in
the lexicon keeps all its terms.

The lexicon is broadcast: documents have ``d`` distinct terms on average, and
each term of the lexicon is in a share ``RARE`` of them at least, so it has at
most ``d / RARE`` terms however many documents there are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.common import documents, text_of
from harborline.llm.shingles import numbered, word_hashes

RARE, COMMON = 1 / 2000, 1 / 5

#: Levels of a fingerprint, and hashes of a level.
LEVELS, SUBSETS = 4, 32

#: Documents whose fingerprints are made together.
TOGETHER = 512

_BLANK = bytes(c if c > 127 or chr(c).isalnum() or c < 9 or 13 < c < 32 else 32 for c in range(256)).translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
_SEEDS = np.array([int.from_bytes(hashlib.sha256(b"subset %d" % k).digest()[:8], "little") for k in range(SUBSETS)], np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def terms(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct terms."""
    return np.unique(word_hashes(text.translate(_BLANK).split()))


def _texts(texts: list[bytes]) -> list[pa.Array]:
    """As Arrow strings, whose words are the terms."""
    made = pa.array([t.translate(_BLANK) for t in texts], pa.string())
    return made.chunks if isinstance(made, pa.ChunkedArray) else [made]


def all_terms(texts: list[bytes]):
    """Some texts at a time: the sorted terms of all, and of each text the
    places of its distinct terms among them, ascending."""
    for own in _texts(texts):
        for hashes, _, at, per_text in numbered(own):
            known, place = np.unique(hashes, return_inverse=True)
            at, stops = place[at].astype(np.int32), np.cumsum(per_text)
            yield known, [np.unique(at[i:j]) for i, j in zip((stops - per_text).tolist(), stops.tolist())]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rarity(terms: np.ndarray) -> np.ndarray:
    """For each term and subset, the highest level on which the subset holds
    the term: the leading zeros of a hash of both, of 40 bits."""
    out = np.empty((len(terms), SUBSETS), np.uint8)
    for k, seed in enumerate(_SEEDS):
        out[:, k] = 40 - np.frexp((_mix(terms ^ seed) >> np.uint64(24)).astype(np.float64))[1]
    return out


class Lexicon:
    """Sorted terms, and of each the levels on which it is in the subsets."""

    def __init__(self, terms: np.ndarray):
        self.terms, self.rarity = terms, _rarity(terms)

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Of each term; -1: not in the lexicon."""
        if not len(self.terms):
            return np.full(len(terms), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def drawn(self, own: np.ndarray, places: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Of a document with these terms, at these places: its lowest level, and each term
        that a subset holds on it (the subset, the term, its highest level),
        terms ascending within a subset."""
        inside = places >= 0
        if inside.any():
            kept, rarity = own[inside], self.rarity[places[inside]]
        else:
            kept, rarity = own, _rarity(own)
        level = len(kept).bit_length() - 1
        found = np.flatnonzero((rarity >= level).reshape(-1))
        found = found[np.argsort(found % SUBSETS, kind="stable")]
        term, subset = found // SUBSETS, found % SUBSETS
        return level, subset, kept[term], rarity.reshape(-1)[found]


class Prints:
    """Fingerprints of some texts: of each the lowest level (-1: a text
    without terms), and the hashes of the sorted terms in each subset on each
    level; 0 for a subset without any."""

    def __init__(self, level: np.ndarray, digests: np.ndarray):
        self.level, self.digests = level, digests

    @classmethod
    def of(cls, texts: list[bytes], lexicon: Lexicon) -> Prints:
        level = np.full(len(texts), -1, np.int64)
        digests = np.zeros((len(texts) * LEVELS * SUBSETS), np.uint16)
        parts, i = [], 0
        for known, of_texts in all_terms(texts):
            places = lexicon.places(known)
            for own in of_texts:
                if len(own):
                    level[i], subset, term, highest = lexicon.drawn(known[own], places[own])
                    parts.append((i * SUBSETS + subset, term, highest - level[i]))
                i += 1
        if parts:
            slot, term, above = (np.concatenate([p[k] for p in parts]) for k in range(3))
            term = _mix(term)
            for k in range(LEVELS):
                there = above >= k
                slot, term, above = slot[there], term[there], above[there]
                if not len(slot):
                    break
                starts = np.flatnonzero(np.diff(slot, prepend=-1))
                place = np.arange(len(slot)) - np.repeat(starts, np.diff(starts, append=len(slot)))
                # a polynomial of the list, in its order
                powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(place.max()), _ODD)]))
                hashed = 1 + _mix(np.add.reduceat(term * powers[place], starts)) % np.uint64(0xFFFF)
                text, subset = slot[starts] // SUBSETS, slot[starts] % SUBSETS
                digests[(text * LEVELS + k) * SUBSETS + subset] = hashed
        return cls(level, digests.reshape(-1, LEVELS, SUBSETS))

    def take(self, at) -> Prints:
        return Prints(self.level[at], self.digests[at])

    def then(self, other: Prints) -> Prints:
        return Prints(np.concatenate([self.level, other.level]), np.concatenate([self.digests, other.digests]))

    def text(self) -> list[str]:
        """``level:hashes`` of each level, joined by semicolons; empty for a
        text without terms."""
        size, found = 4 * SUBSETS, []
        for level, own in zip(self.level.tolist(), self.digests.astype(">u2")):
            hashes = own.tobytes().hex()
            found.append(";".join(f"{level + k}:{hashes[k * size : (k + 1) * size]}" for k in range(LEVELS)) if level >= 0 else "")
        return found

    @classmethod
    def parse(cls, fingerprint: str) -> Prints:
        if not fingerprint:
            return cls(np.array([-1]), np.zeros((1, LEVELS, SUBSETS), np.uint16))
        levels = [x.split(":") for x in fingerprint.split(";")]
        return cls(np.array([int(levels[0][0])]), np.array([np.frombuffer(bytes.fromhex(h), ">u2") for _, h in levels], np.uint16)[None])

    def likeness(self, other: Prints) -> np.ndarray:
        """Row by row. Of the subsets that hold a term of either document, on
        the levels that both fingerprints have, the share agreed on. Equal
        fingerprints: 1; without a common level: 0."""
        same, some = (np.zeros(len(self.level), np.int64) for _ in range(2))
        ahead = other.level - self.level
        with_terms = (self.level >= 0) & (other.level >= 0)
        for shift in range(1 - LEVELS, LEVELS):
            rows = np.flatnonzero(with_terms & (ahead == shift))
            x = self.digests[rows, max(shift, 0) : LEVELS + min(shift, 0)]
            y = other.digests[rows, max(-shift, 0) : LEVELS - max(shift, 0)]
            some[rows] = ((x > 0) | (y > 0)).sum(axis=(1, 2))
            same[rows] = ((x == y) & (x > 0)).sum(axis=(1, 2))
        equal = (ahead == 0) & (self.digests == other.digests).all(axis=(1, 2))
        return np.where(equal, 1.0, same / np.maximum(some, 1))


def fingerprint(text: bytes, lexicon: np.ndarray) -> str:
    return Prints.of([text], Lexicon(lexicon)).text()[0]


def likeness(a: str, b: str) -> float:
    """Of two fingerprints as text."""
    return float(Prints.parse(a).likeness(Prints.parse(b))[0])


def lexicon(docs: DataFrame, rare: float = RARE, common: float = COMMON) -> np.ndarray:
    """Sorted hashes of the terms in the band, counted over all of ``docs``."""

    def count(batches):
        for batch in batches:
            for term, own in all_terms([t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]):
                n = np.bincount(np.concatenate(own), minlength=len(term))
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], names=["term", "n"])

    n = docs.count()
    counts = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    band = counts.where((F.col("n") >= max(2, rare * n)) & (F.col("n") <= max(2, common * n))).select("term")
    # bounded by the mean number of terms of a document over `rare`
    return np.sort(band.toPandas()["term"].to_numpy(np.int64).view(np.uint64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of each row (``doc_id``, ``text``; other
    columns are ignored). A null or empty text has an empty fingerprint."""
    docs = docs.select("doc_id", text_of(docs["text"]).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(lexicon(docs))

    def mark(batches):
        lexicon = Lexicon(known.value)
        for batch in batches:
            found = Prints.of(batch.column(1).cast(pa.binary()).to_pylist(), lexicon).text()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return docs.mapInArrow(mark, "doc_id long, fingerprint string")


_LAST = -(1 << 63)


def _in_order(docs: DataFrame) -> DataFrame:
    """``docs`` in partitions that each hold runs of descending ``doc_id``,
    by ``bucket``; each run ends with the row that follows it (``after``), and
    the last with the first row of all. Null ids come last.

    Texts are shuffled once. What the driver gets is a bound and an id for
    each bucket, of which there are a few for each shuffle partition."""
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("id"))
    bounds = np.unique(np.array(ids.where(F.col("id") > _LAST).approxQuantile("id", [i / n for i in range(1, n)], 1 / (4 * n)), np.float64))

    def bucket_of(own: np.ndarray) -> np.ndarray:
        return len(bounds) - np.searchsorted(bounds, own.astype(np.float64), side="right")

    @F.pandas_udf("int")
    def bucket(own: pd.Series) -> pd.Series:
        return pd.Series(bucket_of(own.to_numpy()).astype(np.int32))

    firsts = ids.groupBy(bucket("id").alias("bucket")).agg(F.max("id").alias("id")).orderBy("bucket").collect()
    before = {firsts[i]["id"]: firsts[i - 1]["bucket"] for i in range(len(firsts))}  # the first of all follows the last

    @F.pandas_udf("array<int>")
    def places(own: pd.Series) -> pd.Series:
        at = bucket_of(own.to_numpy())
        return pd.Series([[b] if i not in before else [b, ~before[i]] for i, b in zip(own.to_numpy().tolist(), at.tolist())])

    dealt = docs.withColumn("id", F.coalesce("doc_id", F.lit(_LAST))).withColumn("place", F.explode(places("id")))
    dealt = dealt.select("doc_id", "text", "id", (F.col("place") < 0).alias("after"), F.when(F.col("place") < 0, F.bitwise_not("place")).otherwise(F.col("place")).alias("bucket"))
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "after", F.desc("id"), "text")
    return dealt.select("doc_id", "text", "bucket", "after")


def edited_likeness(docs: DataFrame, share: int = 3) -> DataFrame:
    """Fingerprints of ``docs`` (``doc_id``, ``text``) and of their edited
    texts, whose last ``floor(n_chars / share)`` code points are replaced by
    the first as many of the next document, in descending ``doc_id``.

    Of rows with one id, texts in ascending order follow each other; null ids
    come last. A null or empty text is edited into itself. A single row is
    its own next."""
    docs = docs.select("doc_id", text_of(docs["text"]).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(lexicon(docs))
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compare(batches):
        lexicon = Lexicon(known.value)
        last, ended = None, None  # the row that waits for its next; the bucket whose end has come
        for batch in (b.slice(i, TOGETHER) for b in batches for i in range(0, b.num_rows, TOGETHER)):
            rows = [] if last is None else [last[0]]
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if row[2] == ended:
                    continue  # further rows of the id that comes after
                rows.append(row)
                ended = row[2] if row[3] else None
            own = Prints.of([r[1].encode() for r in rows[last is not None :]], lexicon)
            if last is not None:
                own = last[1].then(own)
            at = np.array([i for i in range(len(rows) - 1) if not rows[i][3]], np.int64)
            edits = []
            for i in at.tolist():
                text, n = rows[i][1], len(rows[i][1]) // share
                edits.append((text[: len(text) - n] + rows[i + 1][1][:n]).encode())
            last = (rows[-1], own.take([-1])) if rows and not rows[-1][3] else None
            of_edits, before = Prints.of(edits, lexicon), own.take(at)
            columns = [[rows[i][0] for i in at.tolist()], [len(rows[i][1]) for i in at.tolist()], [hashlib.sha256(e).hexdigest() for e in edits],
                       before.text(), of_edits.text(), before.likeness(of_edits), before.likeness(own.take(at + 1))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return _in_order(docs).mapInArrow(compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(documents(spark, sf_dir))
