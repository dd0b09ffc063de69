import json
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from statuta import api
from statuta.operators.history import ChainStore
from statuta.sources import docx, readers, sinks
from statuta.streaming.incremental import keep_history

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'


def make(path, *body):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{''.join(body)}</w:body></w:document>")
        z.writestr("word/styles.xml", f'<w:styles {W}><w:style w:styleId="A5"><w:name w:val="ActHead 5"/></w:style><w:style w:styleId="BT"><w:name w:val="Body Text"/></w:style></w:styles>')


def p(text, style="", extra="", run=""):
    s = f'<w:pStyle w:val="{style}"/>' if style else ""
    return f'<w:p><w:pPr>{s}{extra}</w:pPr><w:r><w:rPr>{run}</w:rPr><w:t xml:space="preserve">{text}</w:t></w:r></w:p>'


@pytest.fixture
def folder(tmp_path):
    item = '<w:numPr><w:ilvl w:val="1"/></w:numPr>'
    table = f"<w:tbl><w:tr><w:tc>{p(' h ')}</w:tc><w:tc>{p('k')}</w:tc></w:tr></w:tbl>"
    make(tmp_path / "some-act-c3-vol0.docx", p("6  Short title", "A5"), p("(1) Text here", "BT"), p("listed", "", item), table, "<w:p><w:r><a:blip/></w:r></w:p>", p("bold ", "", "", "<w:b/>"))
    make(tmp_path / "old-act-vol0.docx", p("Short title.", "", "", "<w:b/>"), p("1. This Act may be cited.", ""))
    (tmp_path / "mixed-act-vol0.docx").write_bytes(bytes.fromhex("D0CF11E0") + b"x")
    make(tmp_path / "mixed-act-vol1.docx", p("x"))
    (tmp_path / "broken-act-vol0.docx").write_bytes(b"PK but no archive")
    return str(tmp_path)


def test_docx(spark, folder):
    files = docx.load(spark, folder)
    assert {(r.act_id, r.kind) for r in files.collect()} == {("some-act", "docx"), ("old-act", "docx"), ("mixed-act", "convert"), ("mixed-act", "docx"), ("broken-act", "docx")}
    whole = docx.whole_acts(files)
    assert {r.act_id for r in whole.collect()} == {"some-act", "old-act", "broken-act"}
    assert [r.error for r in docx.raw_paragraphs(whole).where("error IS NOT NULL").collect()] == ["BadZipFile"]
    got = [(r.element_type, r.number, r.heading, r.text) for r in docx.paragraphs(whole).where("act_id = 'some-act'").orderBy("ord").collect()]
    assert got == [("section", "6", "Short title", ""), ("subsec", "1", "", "Text here"), ("list-item", "1", "", "listed"), ("table", "", "", ""), ("figure", "", "", ""), ("body", "", "", "bold")]
    old = docx.paragraphs(whole).where("act_id = 'old-act'").orderBy("ord", "part_no").collect()
    assert [(r.element_type, r.heading, r.text) for r in old] == [("section", "Short title.", ""), ("body", "", "This Act may be cited.")]


def test_build(spark, folder):
    empty = spark.createDataFrame([], "name STRING, frbr_uri STRING, title_id STRING")
    acts = spark.createDataFrame([("some-act", "Some Act 1999", 1999, 3, date(2020, 1, 1), "act", ["tax law"])], "title_id STRING, name STRING, year INT, number INT, effective_date DATE, doc_type STRING, subject_keywords ARRAY<STRING>")
    events = spark.createDataFrame([("some-act", 1, 0, 0, "s 6", "am", 5, 2001, True, "am. No. 5, 2001")], "act_id STRING, row_ord BIGINT, seg_no INT, num_no INT, provision STRING, effect STRING, act_number INT, act_year INT, applied BOOLEAN, raw_text STRING")
    made = api.build(api.paragraph_stream(spark, folder), empty, acts, events, "2024-01-01")
    assert {r.eid for r in made["nodes"].collect()} == {"sec-6", "sec-6__subsec-1", "sec-1"}
    assert {r.region for r in made["regions"].collect()} == {"body"}
    assert made["references"].count() == 0
    sinks.akn(made["xml"], folder + "/xml")
    got = {r.path.split("act_id=")[1].split("/")[0]: r for r in readers.stored_xml(spark, folder + "/xml").collect()}
    assert got["some-act"].section_eids == ["sec-6"] and got["some-act"].dates == ["1999-01-01"] and got["old-act"].section_eids == ["sec-1"]
    report = {r.act_id: r for r in made["report"].collect()}["some-act"]
    assert (report.subsections_parsed, report.tables_found, report.figures_found, report.amendment_events_parsed, report.mods_resolved, report.inline_formatted) == (1, 1, 1, 1, 1, 1)


def test_files(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p/1.json").write_text(json.dumps({"value": [{"id": "C1988A119", "name": "B Act", "collection": "Act", "isInForce": True}, {"id": "F2011L1", "name": "R", "isInForce": True}]}))
    (tmp_path / "p/2.json").write_text(json.dumps({"value": [{"id": "C1990A2", "name": "A Act", "collection": "Act", "isInForce": True}]}))
    assert [r.name for r in api.list_acts(spark, str(tmp_path / "p")).collect()] == ["A Act", "B Act"]
    assert [r.name for r in api.list_instruments(spark, str(tmp_path / "p")).collect()] == ["R"]
    (tmp_path / "index.json").write_text(json.dumps({"acts": {"b": {"name": "B", "title_id": "T", "year": 1990}, "a": {"name": "A", "aliases": ["x"]}}, "updated_at": None}))
    api.export_jsonl(spark, str(tmp_path / "index.json"), str(tmp_path / "out"))
    got = [json.loads(x) for f in sorted((tmp_path / "out").glob("part-*")) for x in f.read_text().splitlines()]
    assert [(x["slug"], x["aliases"], x["title_id"]) for x in got] == [("a", ["x"], None), ("b", [], "T")]
    (tmp_path / "names.txt").write_text(" One \n\n \nTwo\n")
    assert [r.value for r in readers.lines(spark, str(tmp_path / "names.txt")).collect()] == ["One", "Two"]
    (tmp_path / "x.xml").write_text('<akomaNtoso xmlns="urn:x"><act><section eId="sec-1"><subsection eId="sec-1__subsec-1"/></section></act></akomaNtoso>')
    (tmp_path / "y.xml").write_text("nothing")
    got = readers.stored_xml(spark, str(tmp_path / "*.xml")).orderBy("path").collect()
    assert got[0].section_eids == ["sec-1"] and got[1].section_eids is None
    sinks.names(spark.createDataFrame([("b",), ("a",)], "name STRING"), str(tmp_path / "n"))
    assert "".join(f.read_text() for f in sorted((tmp_path / "n").glob("part-*"))) == "a\nb\n"


def test_stream_equals_batch(spark, tmp_path):
    schema = "snapshot_id BIGINT, title_id STRING, snapshot_date DATE, loaded_at TIMESTAMP_NTZ, name STRING, aliases ARRAY<STRING>, comp_num STRING, effective_date DATE"
    rows = [(i, "AB"[i % 2], date(2020, 1 + i, 1), datetime(2020, 1 + i, 2), f"n{i // 3}", None, "1", date(2000, 1, 1)) for i in range(8)]
    land = str(tmp_path / "land")
    for part in (rows[:5], rows[5:], rows[2:4]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(land)
    keep_history(spark, land, str(tmp_path / "store"), str(tmp_path / "ck"), 1).awaitTermination()
    whole = ChainStore(spark, str(tmp_path / "whole"))
    whole.apply(spark.createDataFrame(rows, schema))
    key = ["title_id", "name", "valid_from", "valid_to"]
    assert sorted(ChainStore(spark, str(tmp_path / "store")).history().select(*key).collect()) == sorted(whole.history().select(*key).collect())
    assert whole.history().where(F.col("valid_to") == "9999-12-31").count() == 2


def test_corpus_folder(spark, tmp_path):
    root = str(tmp_path / "corpus")
    entry = "slug STRING, title_id STRING, name STRING, aliases ARRAY<STRING>, n BIGINT"
    xml = lambda *slugs: spark.createDataFrame([(s, 0, i, f"<a>{s}{i}</a>") for s in slugs for i in range(2)], "act_id STRING, part INT, ord BIGINT, xml STRING")
    assert sinks.corpus_index(spark, root).count() == 0
    sinks.write_corpus(spark, root, spark.createDataFrame([("a-(x)", "T1", "A", ["z"], 1), ("b", "T2", "B", None, 2)], entry), xml("a-(x)", "b"), "n")
    sinks.write_corpus(spark, root, spark.createDataFrame([("a2", "T1", "A2", [], 1)], entry), xml("a2"), "n")
    got = {r.slug: (r.name, r.aliases, r.xml_version) for r in sinks.corpus_index(spark, root).collect()}
    assert got == {"b": ("B", [], 1), "a2": ("A2", ["A", "z"], 2)}
    assert ["a-(x)" in r.path or "a-%28x%29" in r.path for r in sinks.given_up(spark, root).collect()] == [True]
    assert sinks.delete_given_up(spark, root) == 1 and sinks.given_up(spark, root).count() == 0
    left = sorted((tmp_path / "corpus/xml").glob("version=*/act_id=*/part-*"))
    assert [f.read_text() for f in left] == ["<a>b0</a>\n<a>b1</a>\n", "<a>a20</a>\n<a>a21</a>\n"]


def test_site(spark, tmp_path):
    acts = spark.createDataFrame([("T1", "Tax & Levy Act 1999", 1999, 3), ("T2", "Empty Act 2000", 2000, 4)], "title_id STRING, name STRING, year INT, number INT")
    rows = [(1, "T1", 1, "section", "6", "Title", "", None), (2, "T1", 2, "subsec", "1", "", "a < b", None), (3, "T9", 1, "section", "1", "Other", "", None)]
    s = spark.createDataFrame(rows, "para_id BIGINT, act_id STRING, pos BIGINT, element_type STRING, number STRING, heading STRING, text STRING, spans ARRAY<STRUCT<text: STRING, bold: BOOLEAN, italic: BOOLEAN, superscript: BOOLEAN, subscript: BOOLEAN>>")
    sinks.site(acts, s, str(tmp_path / "site"))
    page = {f.parent.name: f.read_text() for f in (tmp_path / "site/acts").glob("act_id=*/part-*")}
    assert set(page) == {"act_id=T1", "act_id=T2"} and page["act_id=T2"].count("\n") == 2
    assert page["act_id=T1"].splitlines()[1:] == ['<h6 id="sec-6">6 Title</h6>', "<p>a &lt; b</p>", "</body></html>"] and "<h1>Tax &amp; Levy Act 1999</h1>" in page["act_id=T1"]
