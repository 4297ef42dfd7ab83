"""Benchmark decontamination: test items that stand in long documents.

An item is contained in a document if at least ``THRESHOLD`` of its distinct
five-word shingles are among the document's. MinHash finds the candidates: the
items are partitioned by size (powers of two), and of each item the shingles
with the smallest hash values are kept as its sketch, as many as the largest
item of the partition may miss, and one. A document that contains the item
thus holds a shingle of its sketch, however long the document is; none is
missed. Documents with too few shingles for a partition are no candidates.
Each candidate is then verified by exact shingle containment. Only DataFrame
and SQL functions are used.

Words are lower-cased and split at white space; a text of fewer words than
five is one shingle, and an empty one has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm.common import SPACES, Stages, documents, table, text_of

WORDS = 5
THRESHOLD = 0.75


def shingles(text: Column, k: int = WORDS) -> Column:
    """64-bit hashes of the distinct ``k``-word shingles of a text."""
    words = F.split(F.btrim(F.lower(text), F.lit(" \t\n\x0b\x0c\r")), SPACES)
    # the words are hashed once, not each k times
    hashed = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))
    return F.array_distinct(_runs(hashed, k))


def _runs(hashed: Column, k: int) -> Column:
    """``aggregate`` hands the hashed words on as a value, so that they are
    not made anew for each shingle."""
    def of(h: Column) -> Column:
        return F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(k))))).when(
            F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(hashed), of), F.lit(0))


def item_sketches(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``item_id, item_text_hash, shingle, least``: the sketch of each item,
    and how many shingles a document needs for the item's size partition."""
    size = F.size("shingles")
    partition = F.ceil(F.log2(size.cast("double"))).cast("int")
    largest, least = F.pow(F.lit(2.0), partition), F.pow(F.lit(2.0), partition - 1)
    keep = (F.floor(largest * (1 - threshold)) + 1).cast("int")
    ranked = F.array_sort(F.transform("shingles", lambda s: F.struct(F.xxhash64(s, F.lit(1)).alias("rank"), s.alias("shingle"))))
    sketch = F.slice(ranked, F.lit(1), F.greatest(keep, F.lit(1)))
    return items.where(size > 0).select("item_key", F.ceil(least * threshold).alias("least"), F.explode(sketch).alias("s")).select("item_key", "least", F.col("s.shingle").alias("shingle"))


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` of each document
    (``doc_id``, ``text``) and item (``item_id``, ``text``) with containment of
    at least ``threshold``.

    Null and empty texts contain nothing and are contained nowhere; null ids
    stay null; of rows with the same ids the highest containment counts. Other
    columns are ignored. Spark broadcasts the items' side when it is small by
    its written size, and shuffles otherwise."""
    stages = Stages(docs.sparkSession, "decontamination")
    docs = docs.select(F.col("doc_id").alias("doc_id"), text_of(docs["text"]).alias("text"))
    docs = docs.withColumn("doc_key", F.xxhash64("doc_id", "text"))
    items = items.select("item_id", shingles(text_of(items["text"])).alias("shingles"))
    items = stages.write(items.withColumn("item_key", F.xxhash64("item_id", "shingles")).distinct(), "items")
    sketches = stages.write(item_sketches(items, threshold), "sketches")

    spread = docs.select("doc_key", shingles(F.col("text")).alias("shingles")).select("doc_key", F.size("shingles").alias("n_doc"), F.explode("shingles").alias("shingle"))
    found = spread.join(sketches, "shingle").where(F.col("n_doc") >= F.col("least"))
    # each document once, with the items to verify; they are few, as each shares a sketch with it
    candidates = stages.write(found.select("doc_key", "item_key").distinct().groupBy("doc_key").agg(F.collect_list("item_key").alias("item_keys")), "candidates")

    sized = docs.join(candidates, "doc_key").select("doc_id", "item_keys", shingles(F.col("text")).alias("doc_shingles"))
    pairs = sized.select("doc_id", "doc_shingles", F.explode("item_keys").alias("item_key")).join(items, "item_key")
    shared = pairs.select("doc_id", "item_id", F.size("shingles").cast("long").alias("n_item"), F.size(F.array_intersect("shingles", "doc_shingles")).cast("long").alias("n_shared"))
    share = (F.col("n_shared") / F.col("n_item")).alias("containment")
    verified = shared.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item")).select("*", share)
    return verified.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_item", "n_shared", "containment"), F.struct("containment", "n_item")).alias("m")).select("doc_id", "item_id", "m.*")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def oracle_sql() -> str:
    """DuckDB text: every shingle of every document against every item's."""
    words = lambda c: f"list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    grams = f"CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"
    return f"""
    WITH d AS (SELECT DISTINCT doc_id, unnest({grams}) AS g FROM (SELECT doc_id, {words('text')} AS w FROM documents)),
    i AS (SELECT DISTINCT item_id, unnest({grams}) AS g FROM (SELECT item_id, {words('text')} AS w FROM benchmark)),
    n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
    s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (g) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
    FROM s JOIN n USING (item_id) WHERE n_shared >= {THRESHOLD} * n_item"""
