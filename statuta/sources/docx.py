"""Word documents as paragraph rows, read in parallel with the standard library alone."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.operators import classify as cl
from statuta.session import scratch

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
# First bytes of files.
ZIP, OLE2, RTF = "504B", "D0CF11E0", "7B5C7274"
RAW = (
    "path STRING, ord BIGINT, raw_style STRING, text STRING, all_bold BOOLEAN, list_level INT, has_image BOOLEAN, is_table BOOLEAN, table_rows ARRAY<ARRAY<STRING>>, "
    "spans ARRAY<STRUCT<text: STRING, bold: BOOLEAN, italic: BOOLEAN, superscript: BOOLEAN, subscript: BOOLEAN>>, error STRING"
)
_SPAN = pa.struct([("text", pa.string()), ("bold", pa.bool_()), ("italic", pa.bool_()), ("superscript", pa.bool_()), ("subscript", pa.bool_())])


def file_kind(content: Column) -> Column:
    """docx by its first bytes, convert for older formats, else reject."""
    head = F.hex(F.substring(content, 1, 4))
    return F.when(head.startswith(ZIP), "docx").when((head == OLE2) | (head == RTF), "convert").otherwise("reject")


def _on(props: ET.Element | None, tag: str) -> bool:
    el = props.find(_W + tag) if props is not None else None
    return el is not None and el.get(_W + "val", "1").lower() not in ("0", "false", "off", "none")


def _run_text(run: ET.Element) -> str:
    signs = {_W + "tab": "\t", _W + "br": "\n", _W + "cr": "\n", _W + "noBreakHyphen": "-"}
    return "".join((c.text or "") if c.tag == _W + "t" else signs.get(c.tag, "") for c in run)


def _spans(p: ET.Element) -> list[dict]:
    out = []
    for run in p.findall(_W + "r"):
        text, props = _run_text(run), run.find(_W + "rPr")
        if text:
            place = props.find(_W + "vertAlign") if props is not None else None
            at = place.get(_W + "val") if place is not None else None
            out.append({"text": text, "bold": _on(props, "b"), "italic": _on(props, "i"), "superscript": at == "superscript", "subscript": at == "subscript"})
    return out


def read_paragraphs(content: bytes) -> Iterator[tuple]:
    """(style, text, all_bold, list_level, has_image, is_table, table_rows, spans) of each paragraph and table, in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(_W + "body")
        names: dict[str, str] = {}
        if "word/styles.xml" in z.namelist():
            for s in ET.fromstring(z.read("word/styles.xml")).iter(_W + "style"):
                name = s.find(_W + "name")
                if name is not None:
                    v = name.get(_W + "val", "")
                    names[s.get(_W + "styleId", "")] = re.sub(r"^heading (\d)", r"Heading \1", v)
    for el in body if body is not None else ():
        if el.tag == _W + "tbl":
            rows = [[" ".join("".join(s["text"] for s in _spans(p)) for p in c.iter(_W + "p")).strip() for c in r.findall(_W + "tc")] for r in el.findall(_W + "tr")]
            yield "", "", False, None, False, True, rows, []
        elif el.tag == _W + "p":
            props = el.find(_W + "pPr")
            style = props.find(_W + "pStyle") if props is not None else None
            level = props.find(f"{_W}numPr/{_W}ilvl") if props is not None else None
            image = next(el.iter(_A + "blip"), None) is not None
            spans = [] if image else _spans(el)
            seen = [s for s in spans if s["text"].strip()]
            name = names.get(style.get(_W + "val", ""), style.get(_W + "val", "")) if style is not None else "Normal"
            yield name, "".join(s["text"] for s in spans), bool(seen) and all(s["bold"] for s in seen), int(level.get(_W + "val", "0")) if level is not None else None, image, False, [], spans


def raw_paragraphs(files: DataFrame) -> DataFrame:
    """Rows of all paragraphs and tables of docx files (path, content). A file that can't be read gives one row with error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows: list[tuple]
                try:
                    rows = [(path, i, *r, None) for i, r in enumerate(read_paragraphs(content.as_py()))]
                except Exception as e:  # noqa: BLE001 - any broken file is told, not raised
                    rows = [(path, 0, None, None, None, None, None, None, None, None, type(e).__name__)]
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.bool_(), pa.bool_(), pa.list_(pa.list_(pa.string())), pa.list_(_SPAN), pa.string()]
                cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], [f.strip().split()[0] for f in re.split(r", (?=[a-z_]+ [A-Z])", RAW)])

    return files.select("path", "content").mapInArrow(run, RAW)


def load(spark: SparkSession, folder: str) -> DataFrame:
    """binaryFile rows of a folder with kind, slug, comp_num and volume_index told by the file name."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    p = r"^(.*?)(?:-c(\d+))?-vol(\d+)\.docx?$"
    return spark.read.format("binaryFile").load(folder).select(
        "path", "content", file_kind(F.col("content")).alias("kind"), F.regexp_extract(name, p, 1).alias("act_id"), F.nullif(F.regexp_extract(name, p, 2), F.lit("")).alias("comp_num"), F.regexp_extract(name, p, 3).try_cast("int").alias("volume_index")
    )


def whole_acts(files: DataFrame) -> DataFrame:
    """Only files of Acts of which every volume is a docx: an Act is taken whole or not at all."""
    ok = files.groupBy("act_id").agg(F.every(F.col("kind") == "docx").alias("ok")).where("ok").select("act_id")
    return files.join(ok, "act_id", "left_semi")


def paragraphs(files: DataFrame) -> DataFrame:
    """Classified paragraphs (as the paragraphs table) of docx files with act_id and volume_index.

    A volume without any ActHead style is read by wording. Images become
    figures, tables tables; a body row with a list level becomes a list item
    numbered by its level.
    """
    # Written once: what follows reads the rows several times, and a document should be unpacked only once.
    at = scratch(files.sparkSession, "raw")
    raw_paragraphs(files).join(files.select("path", "act_id", "volume_index"), "path").where("error IS NULL").withColumn("para_id", F.xxhash64("path", "ord")).write.parquet(at)
    raw = files.sparkSession.read.parquet(at)
    legacy = cl.legacy_documents(raw.where("NOT is_table"))
    flow = raw.join(legacy, ["act_id", "volume_index"], "left")
    special = flow.where("is_table OR has_image").select("para_id", "act_id", "volume_index", "ord", F.lit(0).alias("part_no"), F.when(F.col("is_table"), "table").otherwise("figure").alias("element_type"), F.lit("").alias("number"), F.lit("").alias("heading"), F.col("text"))
    plain = flow.where("NOT is_table AND NOT has_image")
    styled = cl.classify(plain.where("NOT is_legacy")).drop("raw_style").withColumn("part_no", F.lit(0))
    old = cl.classify_legacy(plain.where("is_legacy"))
    cols = ["para_id", "act_id", "volume_index", "ord", "part_no", "element_type", "number", "heading", "text"]
    rows = special.select(*cols).unionByName(styled.select(*cols)).unionByName(old.select(*cols))
    out = rows.join(raw.select("para_id", "raw_style", "list_level", "table_rows", "spans"), "para_id")
    is_item = (F.col("element_type") == "body") & F.col("list_level").isNotNull()
    return out.withColumns({"number": F.when(is_item, F.col("list_level").cast("string")).otherwise(F.col("number")), "element_type": cl.list_level(F.col("element_type"), F.col("list_level"))}).drop("list_level")
