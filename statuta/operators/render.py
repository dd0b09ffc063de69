"""Text for the sinks: HTML and XML, as fragments in order, so that no Act is ever gathered in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.carry import carry_last
from statuta.operators.corpus import expression_uri, keyword_slug, safe_name, work_uri
from statuta.operators.structure import DEPTH, _map

# Element names of the hierarchy.
TAGS = {"chapter": "chapter", "part": "part", "dvs": "division", "subdvs": "subDivision", "section": "section", "subsec": "subsection", "para": "paragraph", "subpara": "subparagraph", "level4": "hcontainer"}


def escape(c: Column, quotes: bool = True) -> Column:
    """Markup signs as entities; null as ''."""
    out = F.coalesce(c, F.lit(""))
    for a, b in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *([('"', "&#34;"), ("'", "&#39;")] if quotes else [])]:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def inline(text: Column, spans: Column, quotes: bool = True) -> Column:
    """Runs with b, i, sup or sub; bold and italic nest; a bold raised run is only bold. Text without formatted runs is only escaped."""
    def one(s: Column) -> Column:
        t = escape(s["text"], quotes)
        wrap = lambda tag, x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))
        return (
            F.when(s["bold"] & s["italic"], wrap("b", wrap("i", t))).when(s["bold"], wrap("b", t)).when(s["italic"], wrap("i", t))
            .when(s["superscript"], wrap("sup", t)).when(s["subscript"], wrap("sub", t)).otherwise(t)
        )

    marked = F.exists(spans, lambda s: s["bold"] | s["italic"] | s["superscript"] | s["subscript"])
    return F.when(F.coalesce(marked, F.lit(False)), F.array_join(F.transform(F.filter(spans, lambda s: F.coalesce(s["text"], F.lit("")) != ""), one), "")).otherwise(escape(text, quotes))


def html_paragraphs(rows: DataFrame) -> DataFrame:
    """act_id, section_pos, pos, html: every paragraph of a section, however deep, by its section; blank ones are left out.

    The section is the last row of a level down to sections before a paragraph, if that is one.
    """
    level = F.when(F.col("element_type").isin([t for t, d in DEPTH.items() if d <= 4]), F.struct("pos", "element_type"))
    got = carry_last(rows.select("act_id", "pos", "element_type", "text", "spans"), ["act_id"], "pos", {"owner": level})
    inner = got.where(level.isNull() & (F.col("owner.element_type") == "section"))
    html = inline(F.col("text"), F.col("spans"))
    return inner.select("act_id", F.col("owner.pos").alias("section_pos"), "pos", html.alias("html")).where(F.col("html").rlike(r"(?U)\S"))


def browse_nodes(hierarchy: DataFrame, rows: DataFrame) -> DataFrame:
    """act_id, pos, tag, eid, parent_eid, num, heading of the containers and sections that a reader browses."""
    keep = hierarchy.where("depth <= 4")
    return keep.join(rows.select("para_id", "number", "heading"), "para_id").select("act_id", "pos", _map(TAGS, F.col("element_type")).alias("tag"), "eid", F.coalesce("parent_eid", F.lit("")).alias("parent_eid"), F.coalesce("number", F.lit("")).alias("num"), F.coalesce("heading", F.lit("")).alias("heading"))


#: Headings of a page by the element that they belong to.
LEVELS = {"chapter": "h2", "part": "h3", "division": "h4", "subDivision": "h5", "section": "h6"}


def act_pages(acts: DataFrame, nodes: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """act_id, ord, html: the page of each Act in ordered fragments: its name, the containers and sections, and the paragraphs of sections.

    acts: act_id, name; nodes: the result of browse_nodes; paragraphs: of
    html_paragraphs. An Act without nodes has a page with its name alone.
    """
    name = escape(F.col("name"))
    head = acts.select("act_id", F.lit(-1).cast("bigint").alias("ord"), F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), name, F.lit("</title></head><body><h1>"), name, F.lit("</h1>")).alias("html"))
    tail = acts.select("act_id", F.lit(2**62).alias("ord"), F.lit("</body></html>").alias("html"))
    level = _map(LEVELS, F.col("tag"))
    titled = F.concat(F.lit("<"), level, F.lit(' id="'), escape(F.col("eid")), F.lit('">'), escape(F.concat_ws(" ", F.nullif("num", F.lit("")), F.nullif("heading", F.lit("")))), F.lit("</"), level, F.lit(">"))
    of = acts.select("act_id")
    rows = nodes.select("act_id", F.col("pos").alias("ord"), titled.alias("html")).unionByName(paragraphs.select("act_id", F.col("pos").alias("ord"), F.concat(F.lit("<p>"), "html", F.lit("</p>")).alias("html")))
    return head.unionByName(tail).unionByName(rows.join(of, "act_id", "left_semi"))


def act_links(acts: DataFrame, paths: DataFrame) -> DataFrame:
    """title_id, name, html: one line of the index page per Act, sorted by name."""
    html = F.concat(F.lit('<li><a href="'), escape(F.col("site_path")), F.lit('">'), escape(F.col("name")), F.lit("</a></li>"))
    return acts.join(paths, "title_id").select("title_id", "name", html.alias("html")).orderBy("name")


def metadata_xml(acts: DataFrame, made_on: str) -> DataFrame:
    """title_id, xml: the identification block of each Act and its classification. The day of making is a parameter, so that output can be made again."""
    return metadata_parts(acts, made_on).select("title_id", F.concat("identification", "classification").alias("xml"))


def metadata_parts(acts: DataFrame, made_on: str) -> DataFrame:
    """acts with identification (null where a part of it is missing) and classification ('' without keywords)."""
    c = F.col
    work, expr = work_uri(c("doc_type"), c("year"), c("number")), expression_uri(c("doc_type"), c("year"), c("number"), c("effective_date"))
    day = F.date_format("effective_date", "yyyy-MM-dd")
    v = lambda tag, value: F.concat(F.lit(f'<{tag} value="'), escape(value), F.lit('"/>'))
    date = lambda value: F.concat(F.lit('<FRBRdate date="'), value, F.lit('" name="Generation"/>'))
    author = F.lit('<FRBRauthor href="#parliament"/>')
    block = F.concat(
        F.lit('<identification source="#source"><FRBRWork>'), v("FRBRthis", F.concat(work, F.lit("/!main"))), v("FRBRuri", work), date(F.concat(c("year").cast("string"), F.lit("-01-01"))), author, v("FRBRcountry", F.lit("au")),
        v("FRBRsubtype", F.coalesce(c("doc_type"), F.lit("act"))), v("FRBRnumber", c("number").cast("string")), v("FRBRname", safe_name(c("name"))), F.lit('<FRBRprescriptive value="true"/><FRBRauthoritative value="true"/></FRBRWork><FRBRExpression>'),
        v("FRBRthis", F.concat(expr, F.lit("/!main"))), v("FRBRuri", expr), date(day), author, F.lit('<FRBRlanguage language="eng"/></FRBRExpression><FRBRManifestation>'),
        v("FRBRthis", F.concat(expr, F.lit("/!main.akn"))), v("FRBRuri", F.concat(expr, F.lit("/!main.akn"))), date(F.lit(made_on)), F.lit('<FRBRauthor href="#source"/></FRBRManifestation></identification>'),
    )
    word = lambda k: F.concat(F.lit('<keyword value="'), escape(keyword_slug(k)), F.lit('" showAs="'), escape(k), F.lit('" dictionary="#register"/>'))
    words = F.when(F.size("subject_keywords") > 0, F.concat(F.lit('<classification source="#register">'), F.array_join(F.transform("subject_keywords", word), ""), F.lit("</classification>"))).otherwise("")
    return acts.withColumns({"identification": block, "classification": words})
