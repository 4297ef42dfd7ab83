"""From raw documents to packed training sequences, one operator a stage.

Each stage takes what its predecessor has kept, as a written table, and all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm import tokens
from harborline.llm.best_fit_packing import pack_documents
from harborline.llm.common import Stages, table, text_of
from harborline.llm.decontamination import contained_items
from harborline.llm.entropy_secrets import redact
from harborline.llm.jaccard_join import similar_groups
from harborline.llm.toxicity import REJECT, judged, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an expected severity below ``REJECT``. A null or empty text
    has none of the features and stays."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(judged(spark, model, docs["text"])["severity"] < REJECT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near copies make: that with the
    smallest id. Texts without words, and rows without an id, are in no group
    and stay; of rows with one id that are not linked, each stays, and of those
    that are, one. Rows are told apart by a hash of id and text; of equal ones,
    that with the smallest other columns stays."""
    stages, key = Stages(spark, "near-copies"), "_row_key"
    keyed = docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", text_of(docs["text"]))))
    groups = stages.write(similar_groups(keyed.select(F.col(key).alias("doc_id"), "text")), "groups")
    members = groups.where("doc_id is not null and n_shingles > 0").groupBy(F.col("doc_id").alias(key), F.col("component_id").alias("group")).agg(F.count("*").alias("n"))
    members = stages.write(members.join(keyed.select(key, "doc_id").distinct(), key), "members")
    least = members.groupBy("group").agg(F.min(F.struct("doc_id", key)).alias("least")).select("group", F.col("least")[key].alias("kept_key"))
    dropped = members.join(least, "group").where(F.col(key) != F.col("kept_key")).select(key)
    repeated = members.where("n > 1").select(key)
    kept = keyed.join(dropped, key, "left_anti")
    order = Window.partitionBy(key).orderBy(*(c for c in docs.columns if c not in ("doc_id", "text")), F.lit(0))
    one = kept.join(repeated, key, "left_semi").withColumn("_row_number", F.row_number().over(order)).where("_row_number = 1")
    return kept.join(repeated, key, "left_anti").select(*docs.columns).union(one.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, each judged by its own text,
    whatever its id."""
    key = "_text_key"
    keyed = docs.withColumn(key, F.xxhash64(text_of(docs["text"])))
    found = contained_items(keyed.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(found, key, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; ``n_chars`` is that
    of the new text."""
    cleaned = redact(docs)
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return pack_documents(spark, texts, tokens.public_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: A tokenizer and a fitted model have no SQL; ``tests/llm`` holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages, docs = Stages(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stages.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
