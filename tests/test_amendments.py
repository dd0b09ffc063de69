from pathlib import Path

import pytest

from statuta.operators import amendments as a
from statuta.plans import legislative

SF = "/root/testdata/sf0.001"


def cells(spark, *rows):
    return spark.createDataFrame([("A", i, list(r)) for i, r in enumerate(rows)], "act_id STRING, row_ord BIGINT, cells ARRAY<STRING>")


def events(spark, *rows):
    f = a.provisions_filled(cells(spark, *rows))
    return [(r.provision, r.effect, r.act_number, r.act_year, r.applied) for r in a.events(f).orderBy("row_ord", "seg_no", "num_no").collect()]


def test_cells(spark):
    assert events(spark, ("s 6", "am. Nos. 83 and 172, 1999")) == [("s 6", "am", 83, 1999, True), ("s 6", "am", 172, 1999, True)]
    assert events(spark, ("s 6", "am No 74, 1991; No 116, 1991")) == [("s 6", "am", 74, 1991, True), ("s 6", "am", 116, 1991, True)]
    assert events(spark, ("s 6", "am No 70, 2000"), ("", "am No 116, 2001")) == [("s 6", "am", 70, 2000, True), ("s 6", "am", 116, 2001, True)]
    assert events(spark, ("Part I", ""), ("Provision affected", "How affected"), (None, None), ("s 1",)) == []
    assert events(spark, ("s 7", "am No 7, 2009 (amdt never applied (Sch 1))")) == [("s 7", "am", 7, 2009, False)]
    f = a.provisions_filled(cells(spark, ("s 1", "see notes; No 5, 1990")))
    assert [r.error for r in a.parse_errors(f).orderBy("segment").collect()] == ["no effect", "unmatched"]


def test_history(spark):
    got = a.legislation_history(cells(spark, ("Act", "Number and year"), ("X Act", "119, 1988", "14 Dec 1988"), ("Y", "none"), ("", "1, 1999"), ("Z",)))
    assert [tuple(r)[2:] for r in got.orderBy("row_ord").collect()] == [("X Act", 119, 1988, "14 Dec 1988", ""), ("Y", None, None, "", "")]


def test_lifecycle_and_mods(spark):
    ev = a.events(a.provisions_filled(cells(spark, ("s 6", "am No 70, 2000"), ("s 7a", "rep No 3, 1990; No 70, 2000"), ("s 99", "ad No 1, 2001"))))
    assert [(r.event_eid, r.act_number) for r in a.lifecycle(ev).orderBy("event_eid").collect()] == [("evt-amd-1", 3), ("evt-amd-2", 70), ("evt-amd-3", 1)]
    known = spark.createDataFrame([("A", "sec-6"), ("A", "sec-7A")], "act_id STRING, eid STRING")
    ev = ev.selectExpr("*", "row_ord * 10 + seg_no AS o")
    got = [(r.mod_no, r.mod_type, r.dest_eid) for r in a.passive_mods(ev, known, ["o"]).orderBy("o").collect()]
    assert got == [(1, "substitution", "sec-6"), (2, "repeal", "sec-7A"), (3, "repeal", "sec-7A"), (None, "insertion", None)]


def test_unresolved_mods(spark):
    ev = a.events(a.provisions_filled(cells(spark, ("s 6", "am No 70, 2000"), ("s 8", "rep No 70, 2000"), ("Part IX", "ad No 3, 1990"), ("s 7", "am No 3, 1990"))))
    known = spark.createDataFrame([("A", "sec-6"), ("A", "SEC-7"), ("B", "sec-8")], "act_id STRING, eid STRING")
    got = [(r.mod_no, r.dest_eid, r.provision) for r in a.passive_mods(ev, known, ["row_ord"]).orderBy("row_ord").collect()]
    assert got == [(1, "sec-6", "s 6"), (None, None, "s 8"), (None, None, "Part IX"), (2, "SEC-7", "s 7")]


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data here")
def test_every_event_gives_a_known_identifier(spark):
    mods = legislative.passive_mods(spark, SF)
    assert mods.where("dest_eid IS NULL AND provision RLIKE '^s \\\\d+[A-Z]*$'").count() == 0
    assert mods.where("dest_eid IS NOT NULL").count() > 0
