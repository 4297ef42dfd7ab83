"""Keyed upsert (MERGE semantics) on plain DataFrames.

`upsert(target, source, spec, as_of)` returns the target as it must look after
the load, one row per output row, with an `action` column:

  keep    target row whose key is not in the source (no delete branch)
  noop    matched, but no trigger column differs (SQL `<>`: null never differs)
  update  matched and a trigger differs: update columns and `updated_at` change
  insert  source row without a matching target row (null keys never match)

Plan shape. Two joins on the key, neither a full outer one:
  * target LEFT JOIN source decides keep/noop/update. A source key occurs once
    here, so each target row comes out once, also where the target holds a key
    several times (an earlier load inserted duplicates). Spark broadcasts the
    source by its size, or AQE splits a target partition that is too large;
  * source LEFT ANTI JOIN target keys gives the inserts.
Rows with a null key component can never match (null = anything is not true):
they go straight to keep or insert and never reach a join.
Duplicated source keys are found by a grouped count (partial aggregation: a
key repeated in a third of all rows adds one row per map task to the shuffle)
and written first, small in practice, so the planner broadcasts them from
their real size. They take part in the first join as one probe row each: a
target row that matches it fails the job (MERGE cardinality rule: a target row
matched by two source rows). Unmatched, each of their rows is inserted.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.session import materialize

ACTIONS = ("keep", "noop", "update", "insert")


@dataclass(frozen=True)
class MergeSpec:
    """What a load compares and writes.

    keys:        join key columns
    columns:     all non-audit table columns, in table order
    trigger:     columns whose change makes a matched row an update;
                 None = every matched row is updated (master loads)
    update_cols: columns rewritten on update (others are set on insert only)
    """

    keys: tuple[str, ...]
    columns: tuple[str, ...]
    trigger: tuple[str, ...] | None
    update_cols: tuple[str, ...]
    audit: tuple[str, str] = field(default=("created_at", "updated_at"))


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def _q(name: str) -> str:
    return f"`{name}`"


def upsert(target: DataFrame, source: DataFrame, spec: MergeSpec,
           as_of: Column | None = None) -> DataFrame:
    """Merged table rows plus `action`; nothing is written to the target (the
    duplicate-key table is staged in the scratch folder).

    The wide projections are written as SQL expressions (one call each for
    all columns), the plan is the same as with Column objects."""
    as_of = F.current_timestamp() if as_of is None else as_of
    created, updated = spec.audit
    keys, cols = list(spec.keys), list(spec.columns)
    t_cols = cols + [created, updated]
    complete = " AND ".join(f"{_q(k)} IS NOT NULL" for k in keys)

    target = target.select(*t_cols)
    source = source.select(*cols)
    t_full, s_full = target.where(complete), source.where(complete)

    dup = materialize(s_full.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                      .where("_n > 1").select(*keys), "dup-keys")
    once = s_full.join(dup, keys, "left_anti").withColumn("_dup", F.lit(False))
    probes = once.unionByName(dup.withColumn("_dup", F.lit(True)), allowMissingColumns=True)
    sk = probes.selectExpr(*[f"{_q(c)} AS {_q('s_' + c)}" for c in cols], "true AS s_hit", "_dup")
    tk = t_full.selectExpr(*[f"{_q(c)} AS {_q('t_' + c)}" for c in t_cols])
    j = tk.join(sk, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys], "left")

    matched = "coalesce(s_hit, false)"
    if spec.trigger is None:
        changed = "true"
    else:
        # SQL: WHEN MATCHED AND (t.a != s.a OR ...) -- a null comparison is not true
        changed = "coalesce(" + " OR ".join(
            f"{_q('t_' + c)} <> {_q('s_' + c)}" for c in spec.trigger) + ", false)"
    action = f"""CASE
        WHEN {matched} AND _dup THEN raise_error('MERGE cardinality violation: a target row matches more than one source row')
        WHEN {matched} AND {changed} THEN 'update'
        WHEN {matched} THEN 'noop'
        ELSE 'keep' END"""
    out = []
    for c in cols:
        if c in spec.update_cols and c not in keys:
            out.append(f"CASE WHEN action = 'update' THEN {_q('s_' + c)} ELSE {_q('t_' + c)} END AS {_q(c)}")
        else:
            out.append(f"{_q('t_' + c)} AS {_q(c)}")
    out.append(f"{_q('t_' + created)} AS {_q(created)}")
    out.append(f"CASE WHEN action = 'update' THEN _as_of ELSE {_q('t_' + updated)} END AS {_q(updated)}")
    kept = j.select("*", F.expr(action).alias("action"), as_of.alias("_as_of")).selectExpr(*out, "action")

    fresh = s_full.join(t_full.select(*keys).distinct(), keys, "left_anti").select(*cols)
    inserts = fresh.unionByName(source.where(f"NOT ({complete})")).select(
        *cols, as_of.alias(created), as_of.alias(updated), F.lit("insert").alias("action"))
    unmatchable = target.where(f"NOT ({complete})").withColumn("action", F.lit("keep"))
    return kept.unionByName(unmatchable).unionByName(inserts)


#: Positions of the key filter: 2^24 bits, so at most 2^18 words of 16 bytes.
FILTER_BITS = 24


def key_filter(source: DataFrame, keys: tuple[str, ...], bits: int = FILTER_BITS) -> DataFrame:
    """`_word, _bits`: a Bloom filter (one hash) of the source's keys as 64-bit
    words, merged map-side; at most 2^(bits - 6) rows, whatever the source."""
    at = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    complete = " AND ".join(f"{_q(k)} IS NOT NULL" for k in keys)
    marks = source.where(complete).select(F.shiftright(at, 6).alias("_word"), at.bitwiseAND(63).cast("int").alias("_bit"))
    return marks.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))


def split_target(target: DataFrame, source: DataFrame, spec: MergeSpec, bits: int = FILTER_BITS) -> DataFrame:
    """`target` with `_may`: whether a row's key can be among the source's.

    The filter is broadcast (its size is bounded by `bits`, not by the data),
    so target rows are marked where they are read: no shuffle. A row that is
    not marked has no match; one that is marked without need takes part in the
    joins like any other. Write the result by `_may` and give the marked part
    to `upsert`: a target far larger than its source is read once, and only
    the rows that may change are shuffled."""
    at = F.pmod(F.xxhash64(*spec.keys), F.lit(1 << bits))
    complete = " AND ".join(f"{_q(k)} IS NOT NULL" for k in spec.keys)
    marked = target.withColumn("_at", F.when(F.expr(complete), at)).withColumn("_word", F.shiftright("_at", 6))
    hit = F.getbit("_bits", F.col("_at").bitwiseAND(63).cast("int")) == 1
    return marked.join(F.broadcast(key_filter(source, spec.keys, bits)), "_word", "left").withColumn(
        "_may", F.coalesce(hit, F.lit(False))).select(*target.columns, "_may")


def upsert_narrow(target: DataFrame, source: DataFrame, spec: MergeSpec, as_of: Column | None = None,
                  bits: int = FILTER_BITS) -> DataFrame:
    """`upsert`, for a target far larger than its source: same rows. Stages the
    target, split by the key filter."""
    split = materialize(split_target(target.select(*spec.columns, *spec.audit), source, spec, bits), "split-target", by=["_may"])
    changed = upsert(split.where("_may"), source, spec, as_of)
    return changed.unionByName(split.where("NOT _may").drop("_may").withColumn("action", F.lit("keep")))


def action_counts(merged: DataFrame) -> DataFrame:
    """Dry-run report: rows per action (the load itself is not performed)."""
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


def changed_rows(merged: DataFrame) -> DataFrame:
    return merged.where(F.col("action").isin("insert", "update"))


def difference(before: DataFrame, after: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """What makes `after` of `before`: each row that one has more often, with
    `n_rows` (how much more often) and `action`:

      insert  in `after`, and no row with its key has gone
      update  in `after`, and a row with its key has gone
      was     gone from `before`, and a row with its key has come
      delete  gone from `before`, and none has come

    Rows with a null key component are inserted or deleted. One grouping by
    whole rows, partly done map-side (equal rows of both sides cancel out
    there where they meet), then joins of what has changed by key."""
    cols = before.columns
    both = after.withColumn("_w", F.lit(1)).unionByName(before.withColumn("_w", F.lit(-1)))
    changed = materialize(both.groupBy(*cols).agg(F.sum("_w").alias("_w")).where("_w <> 0"), "difference")
    side = lambda sign, name: changed.where(f"_w {sign} 0").select(*keys).distinct().withColumn(name, F.lit(True))
    marked = changed.join(side("<", "_gone"), list(keys), "left").join(side(">", "_come"), list(keys), "left")
    new = F.col("_w") > 0
    action = (F.when(new & F.col("_gone").isNotNull(), "update").when(new, "insert")
              .when(F.col("_come").isNotNull(), "was").otherwise("delete"))
    return marked.select(*cols, action.alias("action"), F.abs("_w").alias("n_rows"))


def _names(schema) -> tuple[str, ...]:
    return tuple(f.name for f in schema.fields)


def _specs():
    from harborline.schemas import CHOKEPOINTS, MASTER, PORTS

    chk = _names(CHOKEPOINTS)
    prt = _names(PORTS)
    mst = _names(MASTER)
    return {
        # matched rows change only when n_total or capacity differ; name is kept
        "chokepoints": MergeSpec(
            keys=("portid", "event_date"), columns=chk, trigger=("n_total", "capacity"),
            update_cols=tuple(c for c in chk if c.startswith("n_") or c == "capacity")),
        # matched rows change only when portcalls, import or export differ;
        # portname, country and iso3 are set on insert only
        "ports": MergeSpec(
            keys=("portid", "event_date"), columns=prt, trigger=("portcalls", "import", "export"),
            update_cols=tuple(c for c in prt if c.startswith(("portcalls", "import", "export")))),
        # every matched master row is rewritten
        "master": MergeSpec(
            keys=("portid",), columns=mst, trigger=None,
            update_cols=tuple(c for c in mst if c != "portid")),
    }


SPECS = _specs()
