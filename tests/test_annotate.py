from pyspark.sql import functions as F

from statuta.operators import annotate as a

SCHEMA = "para_id BIGINT, act_id STRING, text STRING, kind STRING, spans ARRAY<STRUCT<text: STRING, bold: BOOLEAN, italic: BOOLEAN, superscript: BOOLEAN, subscript: BOOLEAN>>"


def frame(spark, *texts):
    return spark.createDataFrame([(i, "A", t, "clash", None) for i, t in enumerate(texts)], SCHEMA)


def refs(spark, text):
    return [(r.kind, r.href or r.target_name) for r in a.references(frame(spark, text)).orderBy("starts_at").collect()]


def test_references(spark):
    assert refs(spark, "as provided in s 6(1)(a) of this Act") == [("sec_subsec_para", "#sec-6__subsec-1__para-a")]
    assert refs(spark, "as defined in section 6 of this Act") == [("def_ref", "#sec-6")]
    assert refs(spark, "within the meaning of the Privacy Act 1988") == [("act", "Privacy Act 1988")]
    assert refs(spark, "under the Privacy Regulation 2013") == [("subsidiary", "Privacy Regulation 2013")]
    assert refs(spark, "Part III of the Code and Part IV") == [("part_div", "#part-IV")]
    assert refs(spark, 'he said "see section 5" and section 7') == [("sec", "#sec-7")]
    assert refs(spark, "s 16(2)") == [("sec_subsec", "#sec-16__subsec-2")]
    assert refs(spark, "") == [] and refs(spark, None) == []


def test_resolution(spark):
    idx = spark.createDataFrame([("Privacy Act 1988", "/akn/au/act/1988/119", "T")], "name STRING, frbr_uri STRING, title_id STRING")
    got = a.resolve_names(a.references(frame(spark, "the Privacy Act 1988, the Other Act 1990, section 5")), idx).orderBy("starts_at").collect()
    assert [(r.href, r.status) for r in got] == [("/akn/au/act/1988/119", "resolved"), (None, "unresolved"), ("#sec-5", "resolved")]


def test_ranges(spark):
    e = spark.createDataFrame([("A", "sec-7"), ("A", "part-1__sec-12"), ("A", "sec-12"), ("A", "sec-99")], "act_id STRING, eid STRING")
    got = [(r.href_from, r.href_up_to, r.resolved) for r in a.ranges(frame(spark, "see sections 7 to 12 for details", "see sections 99 to 999", "from 1 July to 30 June"), e).orderBy("para_id").collect()]
    assert got == [("#sec-7", "#sec-12", True), ("#sec-99", "#sec-999", False)]


def test_dates_quantities_roles_notes(spark):
    d = a.dates(frame(spark, "on 1 July 1995 and 01/07/1995, 45/13/2020; on the commencement day")).orderBy("starts_at").collect()
    assert [(r.iso, r.is_valid) for r in d] == [("1995-07-01", True), ("1995-07-01", True), ("2020-13-45", False), (None, None)]
    q = a.quantities(frame(spark, "Penalty: 2,500 penalty units or imprisonment for 5 years, within 30 days")).orderBy("starts_at").collect()
    assert [r.kind for r in q] == ["penaltyUnit", "custodialSentence", "deadline"]
    r = a.roles(frame(spark, "The Commissioner of Taxation and the privacy commissioner or the Commissioner")).orderBy("starts_at").collect()
    assert [x.kind for x in r] == ["commissioner-of-taxation", "privacy-commissioner", "commissioner"]
    assert [x.href for x in a.note_refs(frame(spark, "see [Note 3]")).collect()] == ["#note-3"]


def test_places_are_code_points(spark):
    r = a.dates(frame(spark, "🌾 é 1 July 1995")).first()
    assert "🌾 é 1 July 1995"[r.starts_at : r.ends_at] == "1 July 1995" == r.matched
