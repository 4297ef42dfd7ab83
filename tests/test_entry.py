"""Driver contract: entry smoke, every query has an oracle, small-scale parity."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "action" in df.columns and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["upsert_ports", "upsert_master", "page_stop", "zone_filter",
                                  "ais_statics", "day_calendar"])
def test_parity_small(spark, name):
    con = duckdb.connect()
    for t in ["events", "supplier", "nation", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(str(r[c]) for c in cols) for r in df.collect()))
    rel = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    exp = sorted(tuple(str(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert got == exp
