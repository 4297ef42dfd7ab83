"""Information-theoretic sanitisation of personal data.

Protected entities are the e-mail addresses, IP addresses, card and phone
numbers that patterns find. Other terms of a document can give an entity away
even when the entity itself is masked: how strongly, corpus co-occurrence tells.
With ``N`` documents, of which ``n(e)`` have the entity, ``n(t)`` have the term
and ``n(t,e)`` have both,

    PMI(t;e) = log2(N * n(t,e) / (n(t) * n(e)))   and   IC(e) = log2(N / n(e)),

the share of the entity's information that the term gives is PMI / IC. In each
document that has the entity, a term is generalised wherever it stands from
``GENERALISE`` on and removed from ``REMOVE`` on. All entities are judged; for
one of a single document the share is ``1 - log2 n(t) / log2 N``. All counts
are over all documents. Only DataFrame and SQL functions are used.

Entities of the same documents have the same shares and are judged as one. As
``n(t,e) <= n(e)``, a term of more than ``N ** (1 - g) * n(e) ** g`` documents
has a share below ``g``, and is not paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.llm import spans as S
from harborline.llm.common import Stages, documents, text_of

KINDS = ["email", "ip", "card", "phone", "generalised", "removed"]
BASE = KINDS[:4]

# The base forms. Possessive quantifiers and the starts (after
# the last match, or where a run begins) find the same matches without
# trying each place of a long run again.
EMAIL = "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?:\\G|(?<![0-9]))[0-9]++(?:\\.[0-9]++){3}"
CARD = "[0-9](?:[\\x20-]?[0-9]){15,}+"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

TERM = "[\\p{L}\\p{N}]+"
NO_TERM = "[^\\p{L}\\p{N}]+"

#: Code points about an entity in which terms count: any text's length. And
#: documents that must have both: each pair is judged.
WINDOW = (1 << 31) - 1
SUPPORT = 1
GENERALISE, REMOVE = 0.75, 0.95


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """Base spans, by kind as listed, then start."""
    digit = lambda s: F.length(_digits(s["value"]))
    email = S.matches(text, "email", EMAIL, when=text.contains("@"))
    ip = F.filter(S.matches(text, "ip", IP, when=text.contains(".")), lambda s: s["value"].rlike(f"^{PART}(?:\\.{PART}){{3}}$"))
    card = F.filter(S.matches(text, "card", CARD), lambda s: (digit(s) <= 19) & _luhn(s["value"]))
    phone = F.filter(S.matches(text, "phone", PHONE, when=text.contains("+")), lambda s: digit(s).between(8, 15))
    return S.ordered(F.concat(email, ip, card, phone), KINDS, by_kind=True)


def _luhn(value: Column) -> Column:
    return F.call_function("luhn_check", _digits(value))


def mentions(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without texts: its other columns, ``pii_key`` (the same for
    equal rows), ``pii_base``, and of texts with entities ``pii_entities``,
    their forms, and ``pii_rest``, the text without them."""
    content = text_of(F.col(text))
    rest = [c for c in docs.columns if c != text and c not in ("pii_key", "pii_base", "pii_entities", "pii_rest")]
    docs = docs.select(*rest, text).withColumn("pii_key", F.xxhash64(*rest, text)).withColumn("pii_base", base_spans(content))
    entity = lambda s: F.concat_ws(":", s["kind"], F.when(s["kind"] == "email", F.lower(s["value"])).when(s["kind"] == "ip", s["value"]).otherwise(_digits(s["value"])))
    docs = docs.withColumn("pii_entities", F.array_distinct(F.transform("pii_base", entity)))
    return docs.withColumn("pii_rest", F.when(F.size("pii_base") > 0, _blanked(content, F.col("pii_base")))).drop(text)


def _blanked(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of the spans, so that no part of an
    entity counts as a term."""
    blank = lambda n: F.repeat(F.lit(" "), n.cast("int"))
    cut = lambda a, n: F.substring(text, (a + 1).cast("int"), n.cast("int"))
    return F.aggregate(
        S.ordered(spans, KINDS, by_kind=False), F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.struct(
            F.concat(acc["out"], F.when(s["start"] > acc["at"], cut(acc["at"], s["start"] - acc["at"])).otherwise(""), blank(F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)))).alias("out"),
            F.greatest(s["end"], acc["at"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], cut(acc["at"], F.length(text))),
    )


def _terms(named: DataFrame) -> DataFrame:
    """``pii_key, term, start, end`` of all terms of the texts with entities,
    equal rows once."""
    texts = named.where("pii_rest is not null").select("pii_key", "pii_rest").dropDuplicates(["pii_key"])
    parts = F.arrays_zip(F.regexp_extract_all("pii_rest", F.lit(TERM), F.lit(0)).alias("value"), F.split("pii_rest", TERM, -1).alias("gap"))
    rows = texts.select("pii_key", F.posexplode(parts).alias("i", "p")).where("p.value is not null")
    # the window needs no shuffle: equal rows were brought together by the key
    end = F.sum(F.length("p.gap") + F.length("p.value")).over(Window.partitionBy("pii_key").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    return rows.select("pii_key", "p.value", end.alias("end")).select("pii_key", F.lower("value").alias("term"), (F.col("end") - F.length("value")).alias("start"), "end")


def disclosing_terms(stages: Stages, docs: DataFrame, named: DataFrame, near: DataFrame, text: str = "text", generalise: float = GENERALISE, support: int = SUPPORT) -> DataFrame:
    """``pii_key, term, share``: of each text with entities the terms that give
    at least ``generalise`` of an entity's information, by the largest share.
    ``near``: the terms of those texts."""
    n = F.lit(float(docs.count()))
    owned = named.where("pii_rest is not null").dropDuplicates(["pii_key"]).select("pii_key", F.explode("pii_entities").alias("entity"))
    own = [F.bit_xor(F.xxhash64("pii_key", F.lit(k))) for k in (1, 2)]
    alike = owned.groupBy("entity").agg(F.count("*").alias("n_entity"), own[0].alias("a"), own[1].alias("b")).where((F.col("n_entity") >= support) & (F.col("n_entity") < n))
    alike = alike.select("entity", "n_entity", F.xxhash64("n_entity", "a", "b").alias("group"))
    owned = stages.write(owned.join(alike, "entity").select("pii_key", "group", "n_entity").distinct(), "pii-groups")
    # the most documents that a term of the text can be in; a little more, for the last digit
    most = (1 + 1e-9) * F.pow(n, F.lit(1 - generalise)) * F.pow("n_entity", F.lit(generalise))
    terms = docs.select(F.explode(F.array_distinct(F.split(F.lower(text_of(docs[text])), NO_TERM))).alias("term")).groupBy("term").agg(F.count("*").alias("n_all"))
    has = near.select("pii_key", "term").distinct()
    # what is left of a word beside an entity may be no term of any text
    counted = has.groupBy("term").agg(F.count("*").alias("n_near")).join(terms, "term", "left").select("term", F.coalesce("n_all", "n_near").alias("n_term"))
    largest = owned.agg(F.max(most)).first()[0] or 0.0
    pairs = has.join(counted.where(F.col("n_term") <= largest), "term").join(owned, "pii_key").where(F.col("n_term") <= most)
    pairs = stages.write(pairs.select("pii_key", "group", "n_entity", "term", "n_term"), "pii-pairs")
    both = pairs.groupBy("group", "term").agg(F.count("*").alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term")).where(F.col("n_both") >= support)
    pmi = F.log2(n * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    found = both.select("group", "term", (pmi / F.log2(n / F.col("n_entity"))).alias("share")).where(F.col("share") >= generalise)
    return pairs.select("pii_key", "group", "term").join(found, ["group", "term"]).groupBy("pii_key", "term").agg(F.max("share").alias("share"))


def scan(docs: DataFrame, text: str = "text", generalise: float = GENERALISE, remove: float = REMOVE, support: int = SUPPORT) -> DataFrame:
    """The columns of ``docs`` but for ``text``, with ``pii_base`` and
    ``pii_spans`` (arrays of kind, start, end, value, part; by kind, then
    start). A null or empty text has none. Every row stays; equal rows count
    as one document for co-occurrence and get the same spans. An entity in
    all documents has no information, so no term discloses it."""
    stages = Stages(docs.sparkSession, "disclosure")
    named = stages.write(mentions(docs, text), "pii-mentions")
    near = stages.write(_terms(named), "pii-terms")
    strong = near.join(disclosing_terms(stages, docs, named, near, text, generalise, support), ["pii_key", "term"])
    kind = F.when(F.col("share") >= remove, "removed").otherwise("generalised")
    span = F.struct(kind.alias("kind"), "start", "end", F.lit("").alias("value"), F.lit("").alias("part")).cast(S.SPAN)
    added = strong.select("pii_key", span.alias("span")).groupBy("pii_key").agg(F.collect_list("span").alias("pii_added"))
    found = named.join(added, "pii_key", "left")
    spans = S.ordered(F.concat("pii_base", F.coalesce("pii_added", S.no_spans())), KINDS, by_kind=True)
    return found.withColumn("pii_spans", spans).drop("pii_key", "pii_entities", "pii_rest", "pii_added")


def sanitise(text: Column, spans: Column) -> Column:
    """``text`` with each entity replaced by its kind in brackets, generalised
    terms by ``[TERM]``, and removed terms cut out."""
    placed = S.ordered(spans, KINDS, by_kind=False)
    mark = lambda s: F.when(s["kind"] == "removed", "").when(s["kind"] == "generalised", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    return F.aggregate(
        placed, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), mark(s)).alias("out"), s["end"].alias("at"),
        )).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )


def op4_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    return found.select(
        "doc_id", *(S.count_of(F.col("pii_base"), k).alias(f"n_{k}") for k in BASE),
        F.sha2(S.as_text(F.col("pii_base")), 256).alias("base_sha256"), S.as_text(F.col("pii_spans")).alias("spans"),
    )
