from pyspark.sql import functions as F

from statuta.operators import terms as t

SPAN = "ARRAY<STRUCT<text: STRING, bold: BOOLEAN, italic: BOOLEAN, superscript: BOOLEAN, subscript: BOOLEAN>>"
SCHEMA = f"para_id BIGINT, act_id STRING, pos BIGINT, element_type STRING, number STRING, heading STRING, text STRING, spans {SPAN}"


def term(spark, text, spans=None):
    df = spark.createDataFrame([(text, spans)], f"text STRING, spans {SPAN}")
    d = df.select(t.definition(F.col("text"), F.col("spans")).alias("d")).first().d
    return d and d.show_as


def test_wordings(spark):
    assert term(spark, '"personal information" means information about a person') == "personal information"
    assert term(spark, "Court, in relation to a matter, means any court having jurisdiction") == "Court"
    assert term(spark, "X, in relation to Y with a comma, and more, means Z.") is None
    assert term(spark, "Act does not include regulations, etc.") is None
    assert term(spark, "lease includes a sublease and, in relation to goods, includes hire") == "lease"
    assert term(spark, "a person (who may include the trustee) is liable") is None
    assert term(spark, "will includes a codicil") == "will"
    assert term(spark, "A reference in subsection (5) to a thing includes a reference to:") is None
    assert term(spark, "this Act means nothing") is None
    assert term(spark, "officer has the same meaning as in the Code") == "officer"
    assert term(spark, None) is None and term(spark, "") is None


def test_leading_italic_run(spark):
    text = "lawyer means a practitioner and, in relation to a person, means one acting for the person"
    assert term(spark, text, [("lawyer", True, True, False, False), (text[6:], False, False, False, False)]) == "lawyer"


def stream(spark, *rows):
    return spark.createDataFrame([(i, "A", i, r[0], "", r[1] if r[0] == "section" else "", r[1], None) for i, r in enumerate(rows)], SCHEMA)


def test_registry_and_uses(spark):
    s = stream(spark, ("section", "Definitions"), ("body", '"Tax Officer" means one.'), ("body", '"tax officer" means two.'), ("body", '"tax" means three.'), ("section", "Other"), ("body", '"no" means none.'), ("body", "a *tax officer or *tax and *taxes"))
    d = t.definitions(s)
    assert {r.term_eid for r in d.collect()} == {"term-tax-officer", "term-tax"}
    assert [tuple(r) for r in t.duplicate_terms(d).collect()] == [("A", 3, 1)]
    reg = t.term_registry(d)
    assert {r.show_as for r in reg.collect()} == {"tax officer", "tax"}
    uses = t.asterisk_refs(s, reg)
    assert [(r.starts_at, r.show_as) for r in uses.orderBy("starts_at").collect()] == [(2, "tax officer"), (18, "tax")]
    assert [tuple(r) for r in t.unresolved_asterisks(s, uses).collect()] == [("A", 1)]


def test_list_and_completed(spark):
    s = stream(spark, ("section", "Interpretation"), ("subsec", "lawyer means:"), ("para", "one;"), ("subsec", "agency means any of:"), ("para", "first;"), ("para", "second."), ("para", '"x" means y'), ("para", "third"))
    assert [r.show_as for r in t.list_definitions(s).collect()] == ["lawyer"]
    assert [r.definiens for r in t.completed_definitions(s).collect()] == ["any of: first; second."]
