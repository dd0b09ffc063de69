from datetime import date
from pathlib import Path

import pytest

from statuta.operators import quality as q
from statuta.plans import reporting

SF = "/root/testdata/sf0.01"

ACTS = "act_id STRING, effective_date DATE, number INT, doc_type STRING"
REPORTS = "act_id STRING, volumes_fetched INT, subsections_parsed INT, dates_found INT, amendment_events_parsed INT"


def checks(spark, acts, nodes, reports, baseline=(), dates=(), life=(), notes=(), countries=None):
    ids = lambda x: spark.createDataFrame([(v,) for v in x], "act_id STRING")
    xml = [(a, f'<FRBRcountry value="{(countries or {}).get(a, "au")}"/>') for a in acts]
    got = q.node_checks(
        spark.createDataFrame(nodes, "act_id STRING, element_type STRING, eid STRING"), spark.createDataFrame([(a, date(2020, 1, 1), 10, "act") for a in acts], ACTS), spark.createDataFrame(reports, REPORTS), ids(baseline),
        {"dates present": ids(dates), "lifecycle present": ids(life), "temporalData present": ids(life)}, spark.createDataFrame(notes, "act_id STRING, eid STRING"), spark.createDataFrame(xml, "act_id STRING, xml STRING"),
    )
    return {tuple(r) for r in got.collect()}


def test_what_the_report_counts_is_there(spark):
    nodes = [(a, "section", "sec-1") for a in "ABCD"]
    reports = [("A", 1, 0, 3, 2), ("B", 1, 0, 3, 2), ("C", 1, 0, 0, None), ("D", 1, 0, 1, 0)]
    want = {("A", "dates present"), ("A", "lifecycle present"), ("A", "temporalData present"), ("D", "dates present")}
    assert checks(spark, "ABCD", nodes, reports, dates=["B", "B"], life=["B", "D"]) == want


def test_country_and_note_ids(spark):
    nodes, reports = [(a, "section", "sec-1") for a in "AB"], [(a, 1, 0, 0, 0) for a in "AB"]
    assert checks(spark, "AB", nodes, reports, notes=[("A", "note-1"), ("A", "fn-2"), ("B", "note-1")], countries={"B": "nz"}) == {("A", "note ids"), ("B", "country")}


def test_baseline_excuses_its_acts_only(spark):
    reports = [(a, 1, 0, 0, 0) for a in "ABC"]
    assert checks(spark, "ABC", [("C", "section", "sec-1")], reports, baseline=["A", "A", "C", "X"]) == {("B", "sections")}
    assert checks(spark, "ABC", [("C", "section", "sec-1")], reports) == {("A", "sections"), ("B", "sections")}


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data here")
def test_no_act_is_excused_by_its_number(spark):
    acts = spark.read.parquet(f"{SF}/acts.parquet")
    bare = {r.act_id for r in reporting.quality_checks(spark, SF).where("check = 'sections'").collect()}
    have = {r.act_id for r in spark.read.parquet(f"{SF}/paragraphs.parquet").where("element_type = 'section'").select("act_id").distinct().collect()}
    assert bare == {r.title_id for r in acts.select("title_id").distinct().collect()} - have
    assert acts.where("number % 10 = 0").where(acts.title_id.isin(list(bare))).count() > 0
