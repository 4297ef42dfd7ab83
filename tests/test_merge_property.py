"""Property test: upsert equals a brute-force row-by-row MERGE."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harborline.operators.merge import SPECS, upsert
from harborline.schemas import CHOKEPOINTS

T0 = dt.datetime(2024, 1, 1)
AS_OF = dt.datetime(2024, 2, 1)
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
COLS = [f.name for f in CHOKEPOINTS.fields]
SPEC = SPECS["chokepoints"]

row = st.fixed_dictionaries({
    "portid": st.sampled_from(["a", "b", "c", None]),
    "event_date": st.sampled_from(DAYS),
    "portname": st.sampled_from(["x", "y"]),
    "n_tanker": st.sampled_from([None, 1, 2]),
    "n_total": st.sampled_from([None, 0, 1]),
    "capacity": st.sampled_from([None, 5, 6]),
})


def _full(r):
    return {c: r.get(c) for c in COLS}


def brute(target, source):
    """Row-by-row MERGE: WHEN MATCHED AND (t.n_total != s.n_total OR
    t.capacity != s.capacity) UPDATE; WHEN NOT MATCHED INSERT."""
    def key(r):
        return None if any(r[k] is None for k in SPEC.keys) else tuple(r[k] for k in SPEC.keys)

    out, used = [], set()
    for t in target:
        hits = [i for i, s in enumerate(source) if key(t) is not None and key(s) == key(t)]
        if len(hits) > 1:
            raise ValueError("cardinality")
        if not hits:
            out.append(dict(t, action="keep"))
            continue
        used.add(hits[0])
        s = source[hits[0]]
        changed = any(t[c] is not None and s[c] is not None and t[c] != s[c] for c in SPEC.trigger)
        if changed:
            new = dict(t)
            for c in SPEC.update_cols:
                new[c] = s[c]
            new.update(updated_at=AS_OF, action="update")
            out.append(new)
        else:
            out.append(dict(t, action="noop"))
    for i, s in enumerate(source):
        if i not in used:
            out.append(dict(s, created_at=AS_OF, updated_at=AS_OF, action="insert"))
    return out


def _frame(spark, rows, audit):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CHOKEPOINTS.fields)
    if audit:
        schema += ", created_at timestamp, updated_at timestamp"
    data = [tuple(r[c] for c in COLS) + ((T0, T0) if audit else ()) for r in rows]
    return spark.createDataFrame(data, schema)


def _canon(rows):
    keys = COLS + ["created_at", "updated_at", "action"]
    return sorted((tuple(r[k] for k in keys) for r in rows), key=repr)


@settings(max_examples=30, deadline=None)
@given(st.lists(row, max_size=8), st.lists(row, max_size=8))
def test_upsert_matches_brute_force(spark, target, source):
    seen, tgt = set(), []
    for r in map(_full, target):  # a table has unique complete keys
        k = (r["portid"], r["event_date"])
        if None in k or k not in seen:
            seen.add(k)
            tgt.append(dict(r, created_at=T0, updated_at=T0))
    src = [_full(r) for r in source]
    try:
        expected = _canon(brute(tgt, src))
    except ValueError:
        with pytest.raises(Exception, match="cardinality"):
            upsert(_frame(spark, tgt, True), _frame(spark, src, False), SPEC, F.lit(AS_OF)).collect()
        return
    got = upsert(_frame(spark, tgt, True), _frame(spark, src, False), SPEC, F.lit(AS_OF)).collect()
    assert _canon([r.asDict() for r in got]) == expected
