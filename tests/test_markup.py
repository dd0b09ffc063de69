"""Acts as annotated XML: well-formed, and as the rules say."""

from datetime import date
from xml.etree import ElementTree as ET

import pytest

from statuta.operators import markup as m
from statuta.operators import structure as st

SCHEMA = (
    "para_id BIGINT, act_id STRING, volume_index INT, pos BIGINT, element_type STRING, number STRING, heading STRING, text STRING, raw_style STRING, table_rows ARRAY<ARRAY<STRING>>, "
    "spans ARRAY<STRUCT<text: STRING, bold: BOOLEAN, italic: BOOLEAN, superscript: BOOLEAN, subscript: BOOLEAN>>, doc_type STRING"
)
ACTS = "title_id STRING, name STRING, year INT, number INT, effective_date DATE, doc_type STRING, subject_keywords ARRAY<STRING>"
EVENTS = "act_id STRING, row_ord BIGINT, seg_no INT, num_no INT, provision STRING, effect STRING, act_number INT, act_year INT, applied BOOLEAN, raw_text STRING"
N = "{" + m.AKN_NS + "}"


def run(text, bold=False, italic=False):
    return (text, bold, italic, False, False)


def build(spark, acts, meta=(), events=()):
    """(root element, report) of each Act, all built at once."""
    made = []
    for act, rows in acts.items():
        at = len(made)
        made += [(at + i, act, 0, i, r[0], r[1] if len(r) > 1 else "", r[2] if len(r) > 2 else "", r[3] if len(r) > 3 else "", r[4] if len(r) > 4 else "Body Text", r[6] if len(r) > 6 else None, r[5] if len(r) > 5 else None, "clash") for i, r in enumerate(rows, 1)]
    s = spark.createDataFrame(made, SCHEMA)
    idx = spark.createDataFrame([("Privacy Act 1988", "/akn/au/act/1988/119", "C1")], "name STRING, frbr_uri STRING, title_id STRING")
    d = m.documents(st.regions(st.resolve_ambiguous(s)), spark.createDataFrame(list(meta), ACTS), idx, spark.createDataFrame(list(events), EVENTS), "2024-01-01")
    xml = {}
    for r in d["fragments"].orderBy("act_id", "part", "ord").collect():
        xml[r.act_id] = xml.get(r.act_id, "") + r.xml
    reports = {r.act_id: r for r in d["report"].collect()}
    return {a: (ET.fromstring(xml[a]), reports[a]) for a in acts}


def inner(el):
    return (el.text or "") + "".join(ET.tostring(x, encoding="unicode").replace(f' xmlns:ns0="{m.AKN_NS}"', "").replace("ns0:", "") for x in el)


ROWS = [
    ("body", "", "", "Contents", "TOC Heading"), ("body", "", "", "1 Short title", "TOC 1"), ("body", "", "", "WHEREAS it is so", "Normal"), ("body", "", "", "The Parliament enacts:", "Normal"),
    ("part", "1", "Preliminary"), ("section", "5", "Definitions"), ("subsec", "1", "", '"tax & levy" means a charge under section 7.'), ("subsec", "2", "", "lawyer means:"), ("para", "a", "", "a *lawyer within s 6(2) of the Privacy Act 1988; and"), ("para", "b", "", "x < y"),
    ("section", "6", "Duties"), ("subsec", "1", "", "Penalty of 5 penalty units under section 9."), ("subsec", "2", "", "See section 5 and the Unknown Act 1900, sections 5 to 6 [note 1]."), ("para", "i", "", ""), ("para", "ii", "", "[note 2] only"), ("note", "", "", "Note: on 3 May 2001."),
    ("body", "", "", "The Minister may.", "Normal", [run("The Minister ", True), run("may.")]), ("body", "", "", "plain tail"), ("list-item", "0", "", "(a) one"), ("list-item", "0", "", "two"), ("list-item", "1", "", "deep"), ("table", "", "", "", "", None, [["h", "k"], ["1", "<"]]), ("figure",),
    ("section", "7", "Amended"), ("body", "", "", "“"), ("section", "8", "New"), ("subsec", "1", "", "inside"), ("body", "", "", "”"), ("subsec", "3", "", "after"), ("penalty", "", "", "Penalty: x"), ("level4", "Q", "", "deep"),
    ("body", "", "", "Schedule 1—The forms", "ActHead 1"), ("body", "", "", "APP 1 — Open management"), ("para", "a", "", "in para"), ("body", "", "", "1.2 Further matters"), ("body", "", "", "plain in schedule"), ("body", "", "", "Schedule 2", "ActHead 1"), ("section", "3", "Clause three"), ("subsec", "1", "", "one"),
]


RANGES = [("section", "1", "Interpretation"), ("subsec", "1", "", "levy means any of the following:"), ("para", "a", "", "a tax;"), ("para", "b", "", "a duty."), ("section", "2", "Other"), ("subsec", "1", "", "see sections 1 to 2 and section 2 [note 4]"), ("subsec", "2", "", "*levy and *nothing")]
STAR = [("section", "1", "X"), ("subsec", "1", "", "a *nothing costs 5 penalty units")]
ODD = [("section", None, None, None), ("body", "", "", "“"), ("section", "2", "a"), ("section", "3", "b"), ("body", "", "", "”"), ("body", "", "", None), ("subsec", "1", "", ""), ("body", "", "", "“")]


@pytest.fixture(scope="module")
def built(spark):
    meta = [("A", "Some Act 1999", 1999, 3, None, "act", ["tax law"]), ("B", "Some Act 1999", 1999, 3, date(2020, 1, 1), "act", None)]
    events = [("A", 1, 0, 0, "s 6", "am", 5, 2001, True, ""), ("A", 2, 0, 0, "s 99", "ad", 5, 2001, True, ""), ("A", 3, 0, 0, "s 7", "rep", 2, 2000, False, "")]
    events += [("B", 1, 0, 0, "s 2", "am", 5, 2001, True, ""), ("B", 2, 0, 0, "s 99", "ad", 5, 2001, True, ""), ("B", 3, 0, 0, "s 1", "rep", 2, 2000, False, "")]
    return build(spark, {"A": ROWS, "B": RANGES, "C": STAR, "D": ODD}, meta, events)


def test_one_act(built):
    root, report = built["A"]
    act = root.find(f"{N}act")
    assert [x.tag.replace(N, "") for x in act] == ["meta", "preface", "preamble", "body", "attachments"]
    assert [x.tag.replace(N, "") for x in act.find(f"{N}meta")] == ["lifecycle", "temporalData", "classification", "references"]  # no identification without a day; 's 6' isn't 'part-1__sec-6'
    assert [(e.get("eId"), e.get("source")) for e in act.iter(f"{N}eventRef")] == [("evt-creation", "#some-act-1999"), ("evt-amd-1", "/akn/au/act/2000/2"), ("evt-amd-2", "/akn/au/act/2001/5")]
    preface = act.find(f"{N}preface")
    assert [x.tag.replace(N, "") for x in preface] == ["toc", "formula"] and preface[0][0].text == "1 Short title" and preface[1][0].text == "The Parliament enacts:"
    assert act.find(f"{N}preamble/{N}recitals/{N}recital/{N}p").text == "WHEREAS it is so"
    at = {e.get("eId"): e for e in act.iter() if e.get("eId")}
    p = lambda eid, tag="content": inner(at[eid].find(f"{N}{tag}/{N}p"))
    five, six, seven = "part-1__sec-5", "part-1__sec-6", "part-1__sec-7"
    assert p(f"{five}__subsec-1") == '<term refersTo="#term-tax-levy">"tax &amp; levy"</term> means <def>a charge under <ref href="#sec-7">section 7</ref>.</def>'
    assert p(f"{five}__subsec-2", "intro") == '<term refersTo="#term-lawyer">lawyer</term> means:'
    assert p(f"{five}__subsec-2__para-a") == 'a <ref href="#term-lawyer">lawyer</ref> within s 6(2) of the Privacy Act 1988; and'  # nothing after the first mark
    assert p(f"{six}__subsec-1") == 'Penalty of <quantity refersTo="#penaltyUnit">5 penalty units</quantity> under section 9.'
    assert p(f"{six}__subsec-2") == 'See <ref href="#sec-5">section 5</ref> and <ref href="#unresolved">the Unknown Act 1900</ref>, <ref href="#sec-5">sections 5</ref> to 6 [note 1].'.replace('<ref href="#sec-5">sections 5</ref>', "sections 5")
    assert p(f"{six}__subsec-2__para-i__subpara-ii") == '<noteRef href="#note-2" marker="2" /> only'
    note = at["note-1"]
    assert note.get("marker") == "1" and inner(note[0][0]) == 'Note: on <date date="2001-05-03">3 May 2001</date>.'
    deep = at[f"{six}__subsec-2__para-i__subpara-ii"]
    assert [x.tag.replace(N, "") for x in deep] == ["num", "content", "authorialNote", "content", "blockList", "blockList", "table", "figure"]
    assert [inner(x) for x in deep[3]] == ["<b>The Minister </b>may.", "plain tail"]
    assert [(i.get("eId").split("__")[-2:], [x.text for x in i]) for i in deep[4]] == [(["list-1", "item-1"], ["(a)", "one"]), (["list-1", "item-2"], ["two"])] and deep[5][0].get("eId").endswith("list-2__item-1")
    assert [[c.tag.replace(N, "") + c.text for c in r] for r in deep[6]] == [["thh", "thk"], ["td1", "td<"]]
    quote = at[seven].find(f"{N}quotedStructure")
    assert quote[0].get("eId") == "sec-8" and quote[0].find(f"{N}subsection").get("eId") == "sec-8__subsec-1"
    assert [x.tag.replace(N, "") for x in at[seven]] == ["num", "heading", "quotedStructure", "subsection"] and at[f"{seven}__subsec-3"].find(f"{N}hcontainer").get("name") == "penalty"
    one, two = act.findall(f"{N}attachments/{N}attachment/{N}hcontainer")
    assert one.find(f"{N}heading").text == "The forms" and two.find(f"{N}heading").text == "Schedule 2"
    assert {e for e in at if e.startswith("schedule-")} == {"schedule-1", "schedule-1__clause-1", "schedule-1__clause-1__para-a", "schedule-1__clause-1__subclause-1-2", "schedule-2", "schedule-2__clause-3", "schedule-2__clause-3__subclause-1"}
    assert [x.text for x in at["schedule-1__clause-1__subclause-1-2"].iter(f"{N}p")] == ["Further matters", "plain in schedule"]
    assert {(e.tag.replace(N, ""), e.get("eId")) for e in act.find(f"{N}meta/{N}references")} == {("TLCOrganization", "parliament"), ("TLCTerm", "term-tax-levy"), ("TLCTerm", "term-lawyer"), ("TLCConcept", "penaltyUnit")}
    want = {
        "preface_paras": 4, "schedules_found": 2, "schedule_names": ["Schedule 1—The forms", "Schedule 2"], "schedule_clauses_found": 2, "terms_found": 1, "duplicate_terms": 0, "list_defs_found": 1, "asterisk_resolved": 1, "asterisk_unresolved": 0,
        "quantities_found": 1, "dates_found": 1, "roles_found": 0, "note_refs_injected": 1, "inline_formatted": 1, "figures_found": 1, "tables_found": 1, "subparagraphs_parsed": 1, "quoted_structures_found": 1, "quoted_structures_unhandled": 0,
        "amendment_events_parsed": 3, "refs_unresolved": 1, "range_refs_resolved": 0, "range_refs_unresolved": 1, "list_defs_completed": 0, "level4_found": 1, "penalties_found": 1,
    }
    assert {k: report[k] for k in want} == want


def test_ranges_and_completed_definitions(built):
    root, report = built["B"]
    assert [(e.get("type"), e.get("eId"), e[0].get("href"), e[1].get("href")) for e in root.iter(f"{N}textualMod")] == [("substitution", "mod-1", "#evt-amd-2", "#sec-2")]
    assert root.find(f".//{N}FRBRExpression/{N}FRBRuri").get("value") == "/akn/au/act/1999/3/eng@2020-01-01" and (report.mods_resolved, report.mods_unresolved) == (1, 1)
    ps = [inner(x) for x in root.iter(f"{N}p")]
    assert ps[0] == '<term refersTo="#term-levy">levy</term> means <def>any of the following: a tax; a duty.</def>'
    assert ps[3] == 'see <rref from="#sec-1" upTo="#sec-2">sections 1 to 2</rref> and section 2 [note 4]'
    assert ps[4] == '<ref href="#term-levy">levy</ref> and *nothing'
    assert (report.range_refs_resolved, report.refs_resolved, report.asterisk_resolved, report.asterisk_unresolved, report.list_defs_completed, report.note_refs_injected) == (1, 0, 1, 1, 1, 0)


def test_a_star_before_no_term_claims_nothing(built):
    root, report = built["C"]
    assert next(root.iter(f"{N}quantity")).text == "5 penalty units" and report.quantities_found == 1 and report.asterisk_unresolved == 0


def test_unhandled_quotes_and_nulls(built):
    root, report = built["D"]
    assert root.find(f".//{N}quotedStructure") is None and [e.get("eId") for e in root.iter(f"{N}section")] == ["sec-", "sec-2", "sec-3"] and report.quoted_structures_unhandled == 1


def test_empty(spark):
    assert build(spark, {}) == {}
