"""Page-stop rule, error policy, file layout, global numbering."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from harborline.operators import paging
from harborline.sources import pages as pg


def _page(rows, more=True):
    return json.dumps({"features": [{"attributes": {"date": 1709251200000, "portid": str(r),
                                                    "portname": f"P{r}", "n_total": r}}
                                    for r in rows], "exceededTransferLimit": more})


ERR = json.dumps({"error": {"code": 400, "message": "bad"}})


def _text(spark, pages):
    return spark.createDataFrame(pages, "request string, offset bigint, body string")


def _ids(spark, pages, on_error="keep"):
    rows = pg.stat_rows(pg.parse_pages(_text(spark, pages), "daily_chokepoint"), on_error)
    return sorted(int(r["portid"]) for r in rows.collect())


def test_two_truncated_pages_then_last(spark):
    p = [("r", 0, _page([1, 2])), ("r", 2, _page([3, 4])), ("r", 4, _page([5], more=False))]
    assert _ids(spark, p) == [1, 2, 3, 4, 5]


def test_empty_last_page_and_page_after_stop(spark):
    p = [("r", 0, _page([1, 2])), ("r", 2, _page([], more=True)), ("r", 4, _page([9]))]
    assert _ids(spark, p) == [1, 2]
    p = [("r", 0, _page([1], more=False)), ("r", 1, _page([7], more=False))]
    assert _ids(spark, p) == [1]


def test_error_page_keeps_earlier_pages(spark):
    p = [("a", 0, _page([1])), ("a", 1, ERR), ("a", 2, _page([3], more=False)),
         ("b", 0, ERR), ("b", 1, _page([8], more=False))]
    assert _ids(spark, p, "keep") == [1]


def test_error_page_fails_when_asked(spark):
    p = [("a", 0, _page([1])), ("a", 1, ERR)]
    with pytest.raises(Exception, match="service error"):
        _ids(spark, p, "fail")


def test_requests_are_independent(spark):
    p = [("a", 0, _page([1], more=False)), ("b", 0, _page([2])), ("b", 1, _page([3], more=False))]
    assert _ids(spark, p) == [1, 2, 3]


def test_read_page_files(spark, workdir):
    for req, off, body in [("d1", 0, _page([1, 2])), ("d1", 2, _page([3], more=False)),
                           ("d2", 0, _page([4], more=False))]:
        d = os.path.join(workdir, f"request={req}", f"offset={off}")
        os.makedirs(d)
        with open(os.path.join(d, "page.json"), "w") as f:
            f.write(json.dumps(json.loads(body), indent=2))
    pages = pg.read_pages(spark, workdir, "daily_chokepoint")
    rows = pg.stat_scan(pages, "daily_chokepoint", start="2024-03-01", end="2024-03-01")
    assert sorted(int(r["portid"]) for r in rows.collect()) == [1, 2, 3, 4]
    assert pg.stat_scan(pages, "daily_chokepoint", ids=["P4"], start="2024-03-01").count() == 1  # by name


def test_number_rows_matches_row_number(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2000).alias("k"),
                                     (F.col("id") % 3).alias("g"))
    got = paging.number_rows(df, [F.asc("g"), F.desc("k")], size=100, num_partitions=5)
    w = Window.orderBy(F.asc("g"), F.desc("k"))
    exp = df.withColumn("row_no", F.row_number().over(w) - 1)
    a = sorted((r["g"], r["k"], r["row_no"], r["page_no"]) for r in got.collect())
    b = sorted((r["g"], r["k"], r["row_no"], r["row_no"] // 100) for r in exp.collect())
    assert a == b


def test_single_page_slice(spark):
    df = spark.range(0, 50)
    got = [r[0] for r in paging.page(df, [F.desc("id")], 10, 5).collect()]
    assert got == [39, 38, 37, 36, 35]


def test_page_log_envelope_equals_page_files(spark, workdir):
    pages = [("r1", 0, _page([1, 2])), ("r1", 2, _page([3], more=False)), ("r2", 0, ERR),
             ("r3", 0, _page([], more=True))]
    text = _text(spark, pages)
    pg.page_log_lines(text).write.text(os.path.join(workdir, "log"))
    log = pg.read_page_log(spark, os.path.join(workdir, "log"), "daily_chokepoint")
    a = sorted(int(r["portid"]) for r in pg.stat_rows(log, "keep").collect())
    b = _ids(spark, pages, "keep")
    meta = pg.read_page_log_meta(spark, os.path.join(workdir, "log"))
    c = sorted(int(r["portid"]) for r in pg.stat_rows(log, "keep", meta=meta).collect())
    assert a == b == c == [1, 2, 3]


def test_master_pages_drop_nameless_and_sort(spark):
    from harborline.functions.casts import lenient
    from harborline.schemas import MASTER

    recs = [{"portid": 3, "portname": "B"}, {"portid": 1, "portname": "B"}, {"portid": 2, "portname": ""},
            {"portid": 4, "portname": None}, {"portid": 5}, {"portid": "0", "portname": "A"}]
    body = json.dumps({"features": [{"attributes": r} for r in recs], "exceededTransferLimit": False})
    pages = pg.parse_pages(_text(spark, [("m", 0, body)]), "ports_db")
    rows = lenient(pg.master_rows(pages), MASTER).orderBy("portname", "portid").collect()
    assert [(r["portname"], r["portid"]) for r in rows] == [("A", "0"), ("B", "1"), ("B", "3")]


def test_master_page_files_keep_number_vs_text(spark, workdir):
    from harborline.functions.casts import lenient
    from harborline.schemas import MASTER

    d = os.path.join(workdir, "request=m1", "offset=0")
    os.makedirs(d)
    recs = [{"portid": 1, "portname": "A", "vessel_count_total": "7", "lat": 12.5},
            {"portid": "2", "portname": "B", "vessel_count_total": 12.7},
            {"portid": 3, "portname": "C", "vessel_count_total": "12.5"}]
    with open(os.path.join(d, "p.json"), "w") as f:
        json.dump({"features": [{"attributes": r} for r in recs], "exceededTransferLimit": False}, f)
    rows = lenient(pg.master_rows(pg.read_pages(spark, workdir, "ports_db")), MASTER).collect()
    got = {r["portid"]: r["vessel_count_total"] for r in rows}
    assert got == {"1": 7, "2": 12, "3": None}


def _cut(body):
    return body[: len(body) * 2 // 3]


def test_unreadable_page_is_an_error(spark, workdir):
    pages = [("r", 0, _page([1, 2])), ("r", 2, _cut(_page([3, 4]))), ("r", 4, _page([5], more=False)), ("s", 0, _page([6], more=False))]
    assert _ids(spark, pages) == [1, 2, 6]
    with pytest.raises(Exception, match="unreadable page r@2"):
        _ids(spark, pages, "fail")
    for req, off, body in pages:
        d = os.path.join(workdir, f"request={req}", f"offset={off}")
        os.makedirs(d)
        with open(os.path.join(d, "page.json"), "w") as f:
            f.write(body)
    files = pg.read_pages(spark, workdir, "daily_chokepoint")
    assert sorted(int(r["portid"]) for r in pg.stat_rows(files, "keep").collect()) == [1, 2, 6]
    with pytest.raises(Exception, match="unreadable page r@2"):
        pg.stat_rows(files).collect()


def test_cut_line_of_a_page_log(spark, workdir):
    log = os.path.join(workdir, "log")
    os.makedirs(log)
    with open(os.path.join(log, "a.json"), "w") as f:
        for off, body in [(0, _page([1, 2])), (2, _page([3, 4])), (4, _page([5], more=False))]:
            line = json.dumps({"request": "r", "offset": off, "response": json.loads(body)})
            f.write((_cut(line) if off == 2 else line) + "\n")
    pages, meta = pg.read_page_log(spark, log, "daily_chokepoint"), pg.read_page_log_meta(spark, log)
    for m in (None, meta):
        assert sorted(int(r["portid"]) for r in pg.stat_rows(pages, "keep", meta=m).collect()) == [1, 2]
        with pytest.raises(Exception, match="unreadable page|missing page"):
            pg.stat_rows(pages, "fail", meta=m).collect()


@pytest.mark.parametrize("pages,what", [
    ([("r", 0, _page([1, 2])), ("r", 4, _page([5], more=False))], "missing page before r@4"),
    ([("r", 2, _page([1], more=False))], "missing page before r@0"),
    ([("r", 0, _page([1, 2])), ("r", 2, _page([3]))], "no last page of r"),
])
def test_incomplete_request_fails(spark, pages, what):
    with pytest.raises(Exception, match=what):
        _ids(spark, pages, "fail")


def test_incomplete_request_keeps_what_came_before(spark):
    assert _ids(spark, [("r", 0, _page([1, 2])), ("r", 4, _page([5], more=False))]) == [1, 2]
    assert _ids(spark, [("r", 2, _page([1], more=False))]) == []
    assert _ids(spark, [("r", 0, _page([1, 2])), ("r", 2, _page([3]))]) == [1, 2, 3]


def _strict_total(spark, value):
    from harborline.functions.casts import strict
    from harborline.schemas import CHOKEPOINTS

    rec = dict.fromkeys([f.name for f in CHOKEPOINTS.fields if f.name != "event_date"], 0)
    rec |= {"date": 1709251200000, "portid": "1", "portname": "P", "n_total": value}
    body = json.dumps({"features": [{"attributes": rec}], "exceededTransferLimit": False})
    rows = pg.stat_rows(pg.parse_pages(_text(spark, [("r", 0, body)]), "daily_chokepoint"))
    return strict(rows, CHOKEPOINTS).first()["n_total"]


@pytest.mark.parametrize("value,expected", [(12, 12), (12.0, 12), ("7", 7), (12.7, 12), (None, None)])
def test_numbers_in_any_form(spark, value, expected):
    assert _strict_total(spark, value) == expected


def test_no_number_fails(spark):
    with pytest.raises(Exception, match="(?i)cast"):
        _strict_total(spark, "abc")


def test_absent_column_fails_unless_optional(spark):
    from harborline.functions.casts import strict
    from harborline.schemas import CHOKEPOINTS

    with pytest.raises(ValueError, match="n_tanker"):
        strict(spark.range(1), CHOKEPOINTS, optional=("portid", "portname"))
    assert strict(spark.range(1), CHOKEPOINTS, optional=tuple(CHOKEPOINTS.names)).first()["capacity"] is None


def test_empty_collections_of_ids_are_no_filter():
    from harborline.operators.predicates import ids

    assert all(ids("portid", v) is None for v in (None, "", [], (), set(), iter(())))
