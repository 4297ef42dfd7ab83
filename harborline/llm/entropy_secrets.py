"""Secrets in texts: known forms, and strings of high entropy.

Known forms are found by patterns. Besides them, a candidate is a run of at
least ``WINDOW`` letters, digits and ``+/_=-`` with a digit in it. A window
slides over it; the counts of its characters change by one that enters and one
that leaves, and so does the sum of ``c * log2(c)``, from which the window's
Shannon entropy follows. The threshold depends on the candidate's character
class. From the first to the last window above it, the candidate is reported
as ``entropy``, unless an allowed form matches it or a known form covers it.
Only SQL functions are used; there is no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import spans as S
from harborline.llm.common import documents, text_of

KINDS = ["assign", "access", "hex", "entropy"]

# The base forms. The quantifiers say what the length limits ask
# for, so that shorter runs cost no match; a longer run is one match either way.
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*+[:=]\\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
ACCESS = "AKIA[A-Z0-9]{16,}+"
HEX = "[0-9a-f]{24,}+"

WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}+"

#: Bits a character; no window of 20 has just this entropy. Class: a pattern
#: for the whole candidate; the first that matches counts.
CLASSES = (("[0-9a-f]+|[0-9A-F]+", 3.01), ("[A-Za-z0-9]+", 3.66), ("[A-Za-z0-9+/_=-]+", 3.76))

#: Forms that are not secrets, each for a whole candidate.
ALLOWED = (
    "[0-9_=/+-]+",  # numbers and dates
    "(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",  # UUIDs
    "(?i).*(example|sample|placeholder|dummy|changeme|x{6}).*",
    "(?i).*(0123456789|abcdefghijkl).*",
    "[a-z]+([-_/=][a-z]+)*[-_/=]?[0-9]{1,4}",  # words with a number at the end
)


def _codes(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.ascii(c))


def _hot(value: Column, threshold: Column, window: int = WINDOW) -> Column:
    """``struct<first, last>``: from the first to the end of the last window
    of entropy ``threshold`` or more; both null if there is none."""
    codes = _codes(value)
    weight = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(0.0)
    state = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("total"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )

    def step(acc: Column, x: Column) -> Column:
        """x: place, the code that enters, the code that leaves (-1: none)."""
        kept = F.transform(acc["counts"], lambda n, k: n - F.when(k == x["old"], 1).otherwise(0))
        n, gone = F.get(kept, x["new"]), F.get(acc["counts"], F.greatest(x["old"], F.lit(0)))
        total = acc["total"] - F.when(x["old"] >= 0, weight(gone) - weight(gone - 1)).otherwise(0.0) + weight(n + 1) - weight(n)
        hot = (x["at"] >= window - 1) & (math.log2(window) - total / window >= threshold)
        return F.struct(
            F.transform(kept, lambda m, k: m + F.when(k == x["new"], 1).otherwise(0)).alias("counts"), total.alias("total"),
            F.when(hot, F.coalesce(acc["first"], (x["at"] - (window - 1)).cast("int"))).otherwise(acc["first"]).alias("first"),
            F.when(hot, (x["at"] + 1).cast("int")).otherwise(acc["last"]).alias("last"),
        )

    old = F.concat(F.array_repeat(F.lit(-1), window), codes)
    steps = F.transform(codes, lambda c, i: F.struct(i.alias("at"), c.alias("new"), F.get(old, i).alias("old")))
    return F.aggregate(steps, state, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def base_spans(text: Column) -> Column:
    assign = F.filter(S.matches(text, "assign", ASSIGN, 2, text.rlike("[:=]")), lambda s: F.length(s["part"]) >= 6)
    access = S.matches(text, "access", ACCESS, when=text.contains("AKIA"))
    return S.ordered(F.concat(assign, access, S.matches(text, "hex", HEX)), KINDS, by_kind=False)


def entropy_spans(text: Column, base: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """High-entropy spans outside ``base``."""
    found = F.filter(S.matches(text, "entropy", CANDIDATE, when=text.rlike("[0-9]")), lambda s: s["value"].rlike("[0-9]"))
    whole = lambda v, p: v.rlike(f"^(?:{p})$")

    def listed(v: Column) -> Column:
        test = F.lit(False)
        for p in allowed:
            test = test | whole(v, p)
        return test

    def threshold(v: Column) -> Column:
        pick = F.when(whole(v, CLASSES[0][0]), CLASSES[0][1])
        for p, bits in CLASSES[1:]:
            pick = pick.when(whole(v, p), bits)
        return pick

    kept = F.filter(found, lambda s: ~listed(s["value"]))
    judged = F.transform(kept, lambda s: F.struct(s.alias("span"), _hot(s["value"], threshold(s["value"])).alias("hot")))
    hot = F.filter(judged, lambda j: j["hot"]["first"].isNotNull())
    cut = F.transform(hot, lambda j: F.struct(
        F.lit("entropy").alias("kind"), (j["span"]["start"] + j["hot"]["first"]).cast("long").alias("start"),
        (j["span"]["start"] + j["hot"]["last"]).cast("long").alias("end"),
        j["span"]["value"].alias("value"), j["span"]["part"].alias("part"),
    )).cast(S.EMPTY)
    return F.filter(cut, lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))


def scan(docs: DataFrame, text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with ``secret_base`` and ``secret_spans`` (arrays of kind,
    start, end, value, part; all spans by start, then kind). A null or empty
    text has none; every row stays, repeated rows too; columns of these two
    names are replaced."""
    docs = docs.withColumn("secret_base", base_spans(text_of(docs[text])))
    found = S.ordered(F.concat("secret_base", entropy_spans(text_of(F.col(text)), F.col("secret_base"), allowed)), KINDS, by_kind=False)
    return docs.withColumn("secret_spans", found)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret of ``text`` replaced by ``mark``; overlapping
    secrets are replaced as one. Texts without secrets stay as they are (null
    too). The same columns come out."""
    plain = docs.columns
    found = scan(docs, text)
    content = text_of(F.col(text))
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    rest = lambda a: F.substring(content, (a + 1).cast("int"), F.length(content))
    cut = F.aggregate(
        "secret_spans", state,
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            F.concat(acc["out"], F.substring(content, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)).alias("out"), s["end"].alias("at"),
        )).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], rest(acc["at"])),
    )
    return found.withColumn(text, F.when(F.size("secret_spans") > 0, cut).otherwise(F.col(text))).select(*plain)


def op5_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    return found.select(
        "doc_id", *(S.count_of(F.col("secret_base"), k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(S.as_text(F.col("secret_base")), 256).alias("base_sha256"), S.as_text(F.col("secret_spans")).alias("spans"),
    )


def _sql_kind(kind: str) -> str:
    """Places of the matches ``m`` between the gaps ``g``; ``p``: the part."""
    return f"""list_transform(range(1, len({kind}_m) + 1), lambda i: struct_pack(kind := '{kind}',
      start := list_sum(list_transform({kind}_g[1:i], lambda x: len(x)))::BIGINT + coalesce(list_sum(list_transform({kind}_m[1:i-1], lambda x: len(x))), 0)::BIGINT,
      value := {kind}_m[i], part := {kind}_p[i]))"""


def oracle_sql() -> str:
    """DuckDB text of the query; each window's entropy is taken afresh."""
    patterns = {
        "assign": ("(?i)(password|passwd|secret|token|api_?key)[\"\']?\\x20*[:=]\\x20*[\"\']?([A-Za-z0-9+/_.=-]+)", 2),
        "access": ("AKIA[A-Z0-9]{16,}", 0), "hex": ("[0-9a-f]{24,}", 0), "entropy": (f"[A-Za-z0-9+/_=-]{{{WINDOW},}}", 0),
    }
    parts = []
    for kind, (p, group) in patterns.items():
        p = p.replace("'", "''")
        parts += [f"regexp_extract_all(t, '{p}') AS {kind}_m", f"regexp_split_to_array(t, '{p}') AS {kind}_g", f"regexp_extract_all(t, '{p}', {group}) AS {kind}_p"]
    classes = " ".join(f"WHEN regexp_full_match(value, '{p}') THEN {bits}" for p, bits in CLASSES)
    allowed = " OR ".join(f"regexp_full_match(value, '{p}')" for p in ALLOWED)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    m AS MATERIALIZED (SELECT r, {', '.join(parts)} FROM d),
    b AS (SELECT r, list_concat(list_filter({_sql_kind("assign")}, lambda s: len(s.part) >= 6), {_sql_kind("access")}, {_sql_kind("hex")}) AS base,
      list_filter({_sql_kind("entropy")}, lambda s: regexp_matches(s.value, '[0-9]')) AS runs FROM m),
    u AS (SELECT r, s.kind AS kind, s.start AS a, s.start + len(s.value) AS z FROM (SELECT r, unnest(base) AS s FROM b)),
    c AS (SELECT r, s.start AS start, s.value AS value FROM (SELECT r, unnest(runs) AS s FROM b)),
    k AS (SELECT *, CASE {classes} END AS bits FROM c WHERE NOT ({allowed})),
    w AS (SELECT r, start, bits, i, list_aggregate(string_split(value[i:i + {WINDOW - 1}], ''), 'entropy') AS h
          FROM (SELECT *, unnest(range(1, len(value) - {WINDOW - 2})) AS i FROM k)),
    e AS (SELECT r, 'entropy' AS kind, start + min(i) - 1 AS a, start + max(i) + {WINDOW - 1} AS z FROM w WHERE h >= bits GROUP BY r, start),
    f AS (SELECT e.* FROM e WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.r = e.r AND u.a <= e.a AND e.z <= u.z)),
    o AS (SELECT r, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, list_position({KINDS}, kind), z) AS spans FROM (SELECT * FROM u UNION ALL SELECT * FROM f) GROUP BY r),
    p AS (SELECT r, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, list_position({KINDS}, kind), z) AS spans,
          {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in KINDS[:3])} FROM u GROUP BY r)
    SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS[:3])},
      sha256(coalesce(p.spans, '')) AS base_sha256, coalesce(o.spans, '') AS spans
    FROM d LEFT JOIN p USING (r) LEFT JOIN o USING (r)"""
