"""N-gram Jaccard join with token-combination prefixes.

A document is its set of distinct five-word shingles ("tokens" here), and two
link if the Jaccard similarity of their sets is ``THRESHOLD`` percent or more.

*Prefixes.* All tokens have one order: those on a list of tokens met often
come last, by how often, the others first, by hash. A set of ``n`` tokens may
miss at most ``n - ceil(0.75 n)`` of them in a partner, so it indexes one token
more from the start of its order. The ``COMBINED`` tokens met most often are
not indexed alone but as pairs, which takes one more of them in the prefix:
partners share a rare token, or else two of the frequent ones. Which tokens
are on the list changes the work and never the result.

*Candidates.* A signature that occurs in one set only is dropped. In each
other one, the sets are compared with one of them (the smallest, then one drawn
by hash), links make components, and only sets of a signature that are still
in different components are compared with each other in the end. So a group of
thousands of near copies costs some comparisons for each copy, and no link
that joins two components is missed.

*Verification.* Pairs are cut by size, then by the Hamming distance of parity
bitmaps (a lower bound of the symmetric difference), and what is left is
verified on the exact sets. Equal sets are one node from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.common import Stages, documents, text_of
from harborline.llm.components import components
from harborline.llm.shingles import shingle_sets

THRESHOLD = 75

#: Tokens on the list of those met often; of them, those indexed in pairs.
LISTED, COMBINED = 100_000, 64
#: A token counts as met often where so many of them (``COUNTED`` at least, if
#: a task has them) have it so often.
OFTEN, COUNTED = 3, 1 << 22

#: Bits of the parity bitmap of a set; sets whose bitmaps are made together.
BITS, TOGETHER = 1024, 256

_SETS = "doc_id long, n int, node long, bitmap array<long>, token long, often int"


def _set_id(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def _bitmaps(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of ``BITS`` bits for each set; the sets stand one after the other."""
    bit, stops, out = (tokens >> np.uint64(40)).astype(np.int64) % BITS, np.cumsum(sizes), []
    for i in range(0, len(sizes), TOGETHER):
        n = sizes[i : i + TOGETHER]
        own = bit[stops[i] - sizes[i] : stops[i + len(n) - 1]] + np.repeat(np.arange(len(n)) * BITS, n)
        odd = np.bincount(own, minlength=len(n) * BITS) & 1
        out.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _sets(batches):
    """Ids and sets of some documents at a time: the tokens, how many each
    document has, where they begin, and what names the set (0: it has none)."""
    for batch in batches:
        row = 0
        for tokens, sizes in shingle_sets(batch.column(1)):
            ids, starts = batch.column(0).slice(row, len(sizes)).cast(pa.int64()), np.cumsum(sizes) - sizes
            there = ids.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
            names = [_set_id(tokens[i : i + n]) if t else 0 for i, n, t in zip(starts.tolist(), sizes.tolist(), there.tolist())]
            yield ids, tokens, sizes, starts, there, np.array(names, np.int64)
            row += len(sizes)


def _often(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Those that are there ``OFTEN`` times, and how often."""
    every = np.concatenate(tokens)
    tokens.clear()
    every.sort()
    found = np.unique(every[OFTEN - 1 :][every[OFTEN - 1 :] == every[: len(every) - OFTEN + 1]])
    return found, np.searchsorted(every, found, "right") - np.searchsorted(every, found)


def _profiles(docs: DataFrame) -> DataFrame:
    """A row for each document, and rows of tokens met often in a task."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("node", pa.int64()), ("bitmap", pa.list_(pa.int64())), ("token", pa.int64()), ("often", pa.int32())])

    def met(tokens):
        token, n = _often(tokens)
        void = [pa.nulls(len(token), f.type) for f in list(schema)[:4]]
        return pa.RecordBatch.from_arrays([*void, pa.array(token.view(np.int64)), pa.array(n.astype(np.int32))], schema=schema)

    def profile(batches):
        seen, kept, n_kept = set(), [], 0
        for ids, tokens, sizes, starts, there, names in _sets(batches):
            offsets = pa.array(np.append(np.arange(len(ids)), len(ids)).astype(np.int32) * (BITS // 64))
            bitmaps = pa.ListArray.from_arrays(offsets, pa.array(_bitmaps(tokens, sizes)), mask=pa.array(~there))
            void = [pa.nulls(len(ids), f.type) for f in list(schema)[4:]]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes.astype(np.int32)), pa.array(names, mask=~there), bitmaps, *void], schema=schema)
            # equal sets count once
            fresh = [i for i, name in enumerate(names.tolist()) if there[i] and not (name in seen or seen.add(name))]
            if len(fresh) == len(sizes):
                kept.append(tokens)
            else:
                kept += [tokens[starts[i] : starts[i] + sizes[i]].copy() for i in fresh]
            n_kept += int(sizes[fresh].sum())
            if n_kept >= COUNTED:
                yield met(kept)
                seen, kept, n_kept = set(), [], 0
        if n_kept:
            yield met(kept)

    return docs.select("doc_id", "text").mapInArrow(profile, _SETS)


def prefix(tokens: np.ndarray, listed: np.ndarray, tier: np.ndarray, percent: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a sorted token set and their places in its order.

    ``listed``: sorted tokens met often; ``tier``: how often in powers of two,
    255 for those that are indexed in pairs."""
    n = len(tokens)
    budget = n - -(-percent * n // 100) + 1
    if n < 2:  # its partners are equal sets, which are one node
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(listed):
        at = np.minimum(np.searchsorted(listed, tokens), len(listed) - 1)
        own = np.where(listed[at] == tokens, tier[at], 0)
        ranked = np.argsort(own, kind="stable")
        tokens, n_rare = tokens[ranked], int((own < 255).sum())
    else:
        n_rare = n
    if n_rare >= budget:
        return tokens[:budget], np.arange(budget)
    paired = tokens[n_rare : budget + 1]  # so many that breaking all their pairs takes the rest of the budget
    i, j = np.triu_indices(len(paired), 1)
    pairs = (paired[i] * np.uint64(0x9E3779B97F4A7C15)) ^ (paired[j] + (paired[i] >> np.uint64(7)))
    return np.concatenate([tokens[:n_rare], pairs]), np.concatenate([np.arange(n_rare), n_rare + i])


def _maybe(tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which sets may have a token of ``listed``, by their highest bits."""
    table = np.zeros(1 << 22, bool)
    table[(listed >> np.uint64(42)).astype(np.int64)] = True
    hits = np.concatenate([[0], np.cumsum(table[(tokens >> np.uint64(42)).astype(np.int64)])])
    return hits[starts + sizes] > hits[starts]


def _postings(docs: DataFrame, listed: np.ndarray, tier: np.ndarray, percent: int) -> DataFrame:
    """``sig, node, place``: the signatures of each set; ``place``: its size
    in the upper 32 bits, the signature's place in its order in the lower."""
    shared = docs.sparkSession.sparkContext.broadcast((listed, tier))

    def sign(batches):
        listed, tier = shared.value
        seen = set()
        for _, tokens, sizes, starts, there, names in _sets(batches):
            maybe = _maybe(tokens, starts, sizes, listed)
            sigs, nodes, places = [], [], []
            for i, name in enumerate(names.tolist()):
                if not there[i] or name in seen:
                    continue
                seen.add(name)
                own = tokens[starts[i] : starts[i] + sizes[i]]
                sig, place = prefix(own, listed if maybe[i] else listed[:0], tier, percent)
                sigs.append(sig)
                nodes.append(np.full(len(sig), name, np.int64))
                places.append((len(own) << 32) + place)
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in ([s.view(np.int64) for s in sigs], nodes, places)], names=["sig", "node", "place"])

    return docs.select("doc_id", "text").mapInArrow(sign, "sig long, node long, place long")


def _hamming(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


class _Join:
    def __init__(self, docs: DataFrame, percent: int):
        self.spark, self.percent = docs.sparkSession, percent
        self.stages = Stages(self.spark, "jaccard-join")
        self.docs = docs
        self.round = 0

    def overlap(self, n_a: Column, n_b: Column) -> Column:
        """Tokens that linked sets of these sizes share at least."""
        return F.ceil(self.percent * (n_a + n_b) / (100 + self.percent))

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (``a``, ``b``) that link, verified on the sets."""
        k, nodes, stages = self.round, self.nodes, self.stages
        a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bitmap").alias("bits_a"))
        b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bitmap").alias("bits_b"))
        near = pairs.join(a, "a").join(b, "b")
        near = near.where(self.percent * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b"))
        near = near.where(_hamming(F.col("bits_a"), F.col("bits_b")) <= F.col("n_a") + F.col("n_b") - 2 * self.overlap(F.col("n_a"), F.col("n_b")))
        near = stages.write(near.select("a", "b"), f"near-{k}")
        wanted = near.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node").select("node", F.col("rep").alias("doc_id"))
        texts = self.docs.join(wanted, "doc_id").select("node", "text")

        def sets(batches):
            for wanted, tokens, sizes, starts, _, names in _sets(batches):
                own = np.flatnonzero(names == wanted.to_numpy(zero_copy_only=False))
                bytes_of = [tokens[i : i + n].tobytes() for i, n in zip(starts[own].tolist(), sizes[own].tolist())]
                yield pa.RecordBatch.from_arrays([wanted.take(pa.array(own, pa.int64())), pa.array(bytes_of, pa.binary())], names=["node", "tokens"])

        tokens = stages.write(texts.mapInArrow(sets, "node long, tokens binary").dropDuplicates(["node"]), f"sets-{k}")
        percent = self.percent

        def verify(batches):
            for batch in batches:
                kept = []
                for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * shared >= percent * (len(x) + len(y) - shared):
                        kept.append(i)
                yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

        both = near.join(tokens.select(F.col("node").alias("a"), F.col("tokens").alias("of_a")), "a").join(tokens.select(F.col("node").alias("b"), F.col("tokens").alias("of_b")), "b")
        found = stages.write(both.select("a", "b", "of_a", "of_b").mapInArrow(verify, "a long, b long"), f"found-{k}")
        stages.drop(f"sets-{k}", f"near-{k}")
        self.round += 1
        return found

    def run(self) -> DataFrame:
        stages, docs = self.stages, self.docs
        profiles = stages.write(_profiles(docs), "profiles")
        # a list of bounded length, as large as its parameter says
        often = profiles.where("token is not null").groupBy("token").agg(F.sum("often").alias("n")).orderBy(F.desc("n"), "token").limit(LISTED).collect()
        listed = np.array([r["token"] for r in often], np.int64).view(np.uint64)
        tier = np.minimum(np.log2(np.array([r["n"] for r in often], np.float64)).astype(np.int64), 254) if often else np.empty(0, np.int64)
        tier[:COMBINED] = 255
        ranked = np.argsort(listed)
        listed, tier = listed[ranked], tier[ranked]

        self.nodes = stages.write(profiles.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap")), "nodes")
        postings = stages.write(_postings(docs, listed, tier, self.percent), "postings")
        ends = postings.groupBy("sig").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
        live = stages.write(postings.join(ends, "sig"), "live")
        stages.drop("postings")

        # each set of a signature against the smallest one
        hub = live.where("node = lo").select("sig", F.col("place").alias("hub_place")).distinct()
        near = live.where("node <> lo").join(hub, "sig").where(self.can_link(F.col("place"), F.col("hub_place")))
        tested = stages.write(near.select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct(), "tested-0")
        found = self.links(tested)
        # where there are more than two sets: against one drawn by hash, for each signature another
        third = live.where("node <> lo and node <> hi").select("sig").distinct()
        many = stages.write(live.join(third, "sig").select("sig", "node", "place").distinct(), "many")
        for draw in range(2):
            if many.isEmpty():
                break
            member = components(stages, found, f"components-{draw}")
            many = self.split(many, member, f"split-{draw}")
            hub = many.groupBy("sig").agg(F.min(F.struct(F.xxhash64("node", "sig", F.lit(draw)).alias("h"), F.col("node").alias("hub"), F.col("component").alias("hub_component"), F.col("place").alias("hub_place"))).alias("m")).select("sig", "m.hub", "m.hub_component", "m.hub_place")
            drawn = many.join(hub, "sig").where("component <> hub_component").where(self.can_link(F.col("place"), F.col("hub_place"))).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
            fresh = stages.write(drawn.join(tested, ["a", "b"], "left_anti"), f"tested-{draw + 1}")
            tested = tested.union(fresh)
            found = found.union(self.links(fresh))
        if not many.isEmpty():
            member = components(stages, found, "components-2")
            many = self.split(many, member, "split-2")
            found = found.union(self.links(self.rest(many).join(tested, ["a", "b"], "left_anti")))

        member = components(stages, found, "components")
        joined = self.nodes.select("node", "rep").join(member, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
        least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
        classes = joined.join(least, "component").select("node", "component_id")
        rows = profiles.where("token is null").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "node")
        return rows.join(classes, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))

    def split(self, many: DataFrame, member: DataFrame, label: str) -> DataFrame:
        """The signatures whose sets are in more than one component."""
        own = many.select("sig", "node", "place").join(member, "node", "left").select("sig", "node", "place", F.coalesce("component", "node").alias("component"))
        several = own.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("sig")
        return self.stages.write(own.join(several, "sig"), label)

    def can_link(self, x: Column, y: Column) -> Column:
        """Whether two sets with the places ``x`` and ``y`` of a signature can
        link, by their sizes and what is left after those places. The first
        token that two linked sets share passes this."""
        n_x, n_y = F.shiftright(x, 32), F.shiftright(y, 32)
        left = F.least(n_x - x.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), n_y - y.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
        return (self.percent * F.greatest(n_x, n_y) <= 100 * F.least(n_x, n_y)) & (left >= self.overlap(n_x, n_y))

    def rest(self, many: DataFrame) -> DataFrame:
        """Pairs of sets of a signature in different components that can
        still link, by their places and bitmaps."""
        bits = many.join(self.nodes.select("node", "bitmap"), "node")
        x, y = bits.alias("x"), bits.alias("y")
        n_x, n_y = F.shiftright("x.place", 32), F.shiftright("y.place", 32)
        both = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
                      & self.can_link(F.col("x.place"), F.col("y.place"))
                      & (_hamming(F.col("x.bitmap"), F.col("y.bitmap")) <= n_x + n_y - 2 * self.overlap(n_x, n_y)))
        return both.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def similar_groups(docs: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``docs``
    (``doc_id``, ``text``; other columns are ignored).

    ``component_id`` is the smallest id reachable by links. A null or empty
    text has no shingles and is linked with nothing; a row with a null id is
    kept, linked with nothing, with a null component. Repeated rows are equal
    sets; rows of one id with different texts are judged each by its own text.
    An empty table gives an empty one."""
    return _Join(docs.select("doc_id", text_of(docs["text"]).alias("text")), percent).run()


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir))
