"""Structure of an Act from its ordered paragraph stream.

A stream has act_id, volume_index, ord (the order within the Act), pos (one
order over all volumes), element_type, number, heading, text, raw_style and so
on. A row without act_id belongs to no Act and is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.carry import BLOCK, B, carry, carry_last, carry_sum, with_block
from statuta.functions.patterns import java
from statuta.functions.text import strip
from statuta.session import settled
from statuta.operators.classify import ELEMENT_TYPES, SCHEDULE_HEADING, STRUCTURAL, is_schedule_heading

DEPTH = {t: d for t, _, d in ELEMENT_TYPES if d is not None}
PREFIX = {t: p for t, p, _ in ELEMENT_TYPES}
QUOTE_MARKS = ['"', "'", "“", "”", "‘", "’"]
QUOTED_STRUCTURAL = ["chapter", "part", "dvs", "subdvs", "section", "subsec"]
# Wordings of schedule clauses and of prefaces.
APP_CLAUSE = r"^APP\s+(\d+(?:\.\d+)*)\s*(?:[—–\-]\s*)?([A-Z].*)"
SUBCLAUSE = r"^(\d+(?:\.\d+){1,})\s+([A-Z].*)"
CLAUSE = r"^(\d+[A-Z]?(?:\.\d+[A-Z]?)*)\s+([A-Z].*)"
ENACTING, WHEREAS = r"\benacts?\s*:", r"^WHEREAS\b"
LIST_NUMBER = r"^(\([^)]+\))\s+(.*)"


def _map(of: dict[str, object], c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in of.items() for x in kv]), c)


def stream(paragraphs: DataFrame) -> DataFrame:
    """The paragraph stream: each row once (by para_id), with pos; skip rows and rows without act_id are left out."""
    once = paragraphs.where("act_id IS NOT NULL AND coalesce(element_type, 'skip') <> 'skip'").dropDuplicates(["para_id"])
    return once.withColumn("pos", F.col("ord"))


def eid_part(element_type: Column, number: Column) -> Column:
    """The step of an identifier: prefix-number; only level4 numbers become lower case."""
    return F.concat(F.coalesce(_map(PREFIX, element_type), element_type), F.lit("-"), F.when(element_type == "level4", F.lower(number)).otherwise(number))


def hierarchy(rows: DataFrame, keys: list[str] | None = None, block: int = BLOCK) -> DataFrame:
    """keys, para_id, pos, element_type, depth, eid, parent_eid of every row with a level (null parent_eid at the top).

    A row's ancestors are, of each higher level, the last row before it that no
    row of a yet higher level came after. A null number gives a step without one.
    """
    keys = keys or ["act_id"]
    levels = rows.select(*keys, "para_id", "pos", "element_type", F.coalesce("number", F.lit("")).alias("number")).withColumn("depth", _map(DEPTH, F.col("element_type"))).where("depth IS NOT NULL")
    levels = levels.withColumn("step", eid_part(F.col("element_type"), F.col("number")))
    seen = {f"l{d}": F.when(F.col("depth") == d, F.struct("pos", "step")) for d in range(8)}
    got = carry_last(levels, keys, "pos", seen, block)
    steps: list[Column] = []
    above = F.lit(-1).cast("bigint")
    for d in range(8):
        here = F.col(f"l{d}")
        steps.append(F.when((F.col("depth") > d) & (here["pos"] > above), here["step"]))
        above = F.greatest(above, F.coalesce(here["pos"], F.lit(-1)))
    parent = F.nullif(F.concat_ws("__", *steps), F.lit(""))
    return got.select(*keys, "para_id", "pos", "element_type", "depth", F.concat_ws("__", parent, F.col("step")).alias("eid"), parent.alias("parent_eid"))


def regions(rows: DataFrame) -> DataFrame:
    """All columns, with region (preface, body, schedule) and schedule_no (within the Act, null outside).

    The preface ends in the first volume at the first structural row or
    schedule heading. In each volume the body runs up to its first schedule
    heading; once there was body and a volume ended within a schedule, all that
    follows stays schedule. A region of schedules so begins at the latest with
    its volume's first heading, and their number is the number of headings so
    far. The state that passes between volumes is folded over one row per volume
    and given to the rows by block, so a very long Act is shared by many tasks.
    """
    marked = rows.withColumn("is_heading", is_schedule_heading())
    cuts = with_block(marked, "pos").groupBy("act_id", B, "volume_index").agg(
        F.min("pos").alias("first"),
        F.min(F.when(F.col("element_type").isin(STRUCTURAL), F.col("pos"))).alias("structural"),
        F.min(F.when(F.col("is_heading"), F.col("pos"))).alias("schedule"),
    )
    never = F.lit(2**62)
    per = cuts.groupBy("act_id", "volume_index").agg(F.min("first").alias("first"), F.min("structural").alias("structural"), F.min("schedule").alias("schedule"), F.collect_set(B).alias("blocks"))
    vols = per.groupBy("act_id").agg(F.array_sort(F.collect_list(F.struct("volume_index", "first", F.coalesce("structural", never).alias("structural"), F.coalesce("schedule", never).alias("schedule"), "blocks"))).alias("vols"))
    kind = "array<struct<volume_index: int, body_from: bigint, schedule_from: bigint, blocks: array<bigint>>>"
    start = F.struct(F.lit(False).alias("seen"), F.lit(False).alias("inside"), F.array().cast(kind).alias("out"))

    def step(acc: Column, v: Column) -> Column:
        leading = F.size(acc["out"]) == 0
        body_from = F.when(leading, F.least(v["structural"], v["schedule"])).otherwise(v["first"])
        carried = acc["inside"] & acc["seen"]
        schedule_from = F.when(carried, body_from).otherwise(v["schedule"])
        has_body = ~carried & (body_from < schedule_from)
        return F.struct(
            (acc["seen"] | has_body).alias("seen"),
            F.when(carried, True).otherwise(v["schedule"] < never).alias("inside"),
            F.concat(acc["out"], F.array(F.struct(v["volume_index"].alias("volume_index"), body_from.alias("body_from"), schedule_from.alias("schedule_from"), v["blocks"].alias("blocks")))).alias("out"),
        )

    bounds = vols.select("act_id", F.explode(F.aggregate("vols", start, step)["out"]).alias("b")).select("act_id", "b.volume_index", "b.body_from", "b.schedule_from", F.explode("b.blocks").alias(B))
    by_block = bounds.groupBy("act_id", B).agg(F.map_from_entries(F.collect_list(F.struct("volume_index", F.struct("body_from", "schedule_from")))).alias("bounds"))
    told = carry(marked, ["act_id"], "pos", sums={"schedule_no": F.col("is_heading").cast("int")}, keep_block=True).join(by_block, ["act_id", B])
    at = F.element_at("bounds", F.col("volume_index"))
    region = F.when(F.col("pos") < at["body_from"], "preface").when(F.col("pos") < at["schedule_from"], "body").otherwise("schedule")
    told = told.withColumn("region", region).drop("bounds", B, "is_heading")
    return told.withColumn("schedule_no", F.when(F.col("region") == "schedule", F.greatest("schedule_no", F.lit(1))))


def quotes(rows: DataFrame) -> DataFrame:
    """act_id, quote_no, n_rows, n_top, handled: spans between two rows that are only a quotation mark.

    handled if just one row is at the highest level of structure inside. A last
    mark without a partner stays body text and opens nothing.
    """
    mark = F.coalesce((F.col("element_type") == "body") & strip(F.col("text")).isin(QUOTE_MARKS), F.lit(False))
    marked = rows.select("act_id", "pos", "element_type", mark.alias("mark"))
    inside = carry(marked, ["act_id"], "pos", sums={"c": F.col("mark").cast("int")}, totals=True).where("c % 2 = 1 AND c < c_total")
    depth = F.when(F.col("element_type").isin(QUOTED_STRUCTURAL), _map(DEPTH, F.col("element_type")))
    by_depth = inside.groupBy("act_id", ((F.col("c") + 1) / 2).cast("bigint").alias("quote_no"), depth.alias("d")).agg(F.count_if(~F.col("mark")).alias("n"))
    out = by_depth.groupBy("act_id", "quote_no").agg(F.sum("n").alias("n_rows"), F.coalesce(F.min_by(F.when(F.col("d").isNotNull(), F.col("n")), "d"), F.lit(0)).alias("n_top"))
    return out.withColumn("handled", F.col("n_top") == 1)


def block_lists(rows: DataFrame) -> DataFrame:
    """act_id, para_id, pos, list_no (within its provision), item_no, num, text of list items.

    A list ends where its level changes or a row that isn't an item comes
    between; numbering begins anew with every row of the hierarchy. '(a) text'
    is split into number and text.
    """
    item, level = F.col("element_type") == "list-item", F.coalesce("number", F.lit(""))
    owner = F.col("element_type").isin(list(DEPTH))
    w = carry_last(rows.select("act_id", "para_id", "pos", "element_type", "number", "text"), ["act_id"], "pos", {"prev": F.struct(item.alias("item"), level.alias("level"))})
    starts = item & ~F.coalesce(F.col("prev.item") & (F.col("prev.level") == level), F.lit(False))
    base = carry(
        settled(w.withColumn("starts", starts).drop("prev"), "lists"), ["act_id"], "pos", sums={"n_lists": F.col("starts").cast("int"), "n_items": item.cast("int")},
        marks={"lists_before": (owner, "n_lists"), "items_at_start": (F.col("starts"), "n_items")},
    ).withColumn("items_before", F.col("items_at_start") - 1)
    text = F.coalesce("text", F.lit(""))
    split = java(LIST_NUMBER, dot_all=True)
    return base.where(item).select(
        "act_id", "para_id", "pos", (F.col("n_lists") - F.coalesce("lists_before", F.lit(0))).alias("list_no"),
        (F.col("n_items") - F.when(F.col("starts"), F.col("n_items") - 1).otherwise(F.coalesce("items_before", F.lit(0)))).alias("item_no"),
        F.when(text.rlike(split), F.regexp_extract(text, split, 1)).alias("num"), F.when(text.rlike(split), F.regexp_extract(text, split, 2)).otherwise(text).alias("text"),
    )


def content_groups(rows: DataFrame) -> DataFrame:
    """act_id, para_id, pos, content_no: body rows that share one content element; any row but notes, examples and penalties ends it."""
    resets = ~F.col("element_type").isin("body", "note", "example", "penalty")
    got = carry_sum(rows.select("act_id", "para_id", "pos", "element_type"), ["act_id"], "pos", {"content_no": resets.cast("int")})
    return got.where("element_type = 'body'").select("act_id", "para_id", "pos", "content_no")


def numbered(rows: DataFrame, element_type: str, label: str) -> DataFrame:
    """act_id, para_id, pos, eid: rows of one type numbered through the Act, such as note-1."""
    got = carry_sum(rows.select("act_id", "para_id", "pos", "element_type"), ["act_id"], "pos", {"n": (F.col("element_type") == element_type).cast("int")})
    return got.where(F.col("element_type") == element_type).select("act_id", "para_id", "pos", F.concat(F.lit(f"{label}-"), F.col("n").cast("string")).alias("eid"))


def resolve_ambiguous(rows: DataFrame) -> DataFrame:
    """All columns with element_type settled: a para numbered in Roman figures right under a para without text is a subpara.

    The open para is the last row of the hierarchy before, if it is a para;
    one with text is a leaf, and the row its sibling.
    """
    roman = F.lower(F.coalesce("number", F.lit(""))).rlike("^[ivxlcdm]*$")
    got = carry_last(rows, ["act_id"], "pos", {"open": F.when(F.col("element_type").isin(list(DEPTH)), F.struct("element_type", F.coalesce("text", F.lit("")).alias("t")))})
    sub = (F.col("element_type") == "para") & roman & F.coalesce((F.col("open.element_type") == "para") & (F.col("open.t") == ""), F.lit(False))
    return got.withColumn("element_type", F.when(sub, "subpara").otherwise(F.col("element_type"))).drop("open")


def schedule_item() -> Column:
    """What a row of a schedule is, null for plain text and headings: kind, num, heading, text, opens, cut (whether text is a part of the row's text)."""
    s = strip(F.coalesce("text", F.lit("")))
    body, numbered_ = (F.col("element_type") == "body") & (s != ""), F.coalesce(F.col("number"), F.lit("")) != ""
    m = lambda p: s.rlike(java(p, dot_all=True))
    g = lambda p, n: strip(F.regexp_extract(s, java(p, dot_all=True), n))
    section = (F.col("element_type") == "section") & numbered_
    none, num = F.lit(None).cast("string"), F.col("number")
    made = lambda kind, n, h, t, opens, cut=False: F.struct(F.lit(kind).alias("kind"), n.alias("num"), h.alias("heading"), t.alias("text"), F.lit(opens).alias("opens"), F.lit(cut).alias("cut"))
    text, heading = F.nullif(F.col("text"), F.lit("")), F.nullif(F.col("heading"), F.lit(""))
    return F.when(
        ~is_schedule_heading(),
        F.when(body & m(APP_CLAUSE), made("clause", g(APP_CLAUSE, 1), g(APP_CLAUSE, 2), none, "app"))
        .when(body & m(SUBCLAUSE), made("subclause", g(SUBCLAUSE, 1), none, g(SUBCLAUSE, 2), "subclause", True))
        .when(body & m(CLAUSE), made("clause", g(CLAUSE, 1), g(CLAUSE, 2), none, "clause"))
        .when(section & F.contains(num, F.lit(".")), made("subclause", num, heading, none, "subclause"))
        .when(section, made("clause", num, heading, none, "clause"))
        .when((F.col("element_type") == "subsec") & numbered_, made("subclause", num, none, text, "closes"))
        .when(F.col("element_type") == "para", made("para", num, none, text, "para"))
        .when(F.col("element_type") == "subpara", made("subpara", num, none, text, "")),
    )


def schedule_state(position: str = "seq") -> tuple[dict[str, Column], dict[str, Column]]:
    """(last values, sums) that the place of a schedule's rows needs, for carry; rows have i, the result of schedule_item."""
    opens, clause = F.col("i.opens"), F.col("i.opens").isin("app", "clause")
    at = F.struct(F.col(position).alias("seq"), "i.kind", "i.num", "i.opens")
    last = {"c": F.when(clause, at), "s": F.when(opens == "subclause", at), "p": F.when(opens == "para", at), "x": F.when(clause | opens.isin("subclause", "closes"), F.col(position))}
    return last, {"n_clause": clause.cast("int")}


def schedule_place() -> tuple[Column, Column, Column]:
    """(what a row hangs below, as seq, kind and step from the outermost; its own eid; its kind, both null for plain text) after the carry.

    Clauses 'APP 1' are numbered by their place, others by their number; dotted
    numbers are subclauses that later rows may hang below, numbered subsections
    are subclauses that they may not.
    """

    def step(f, n: Column) -> Column:
        plain = F.concat(f("kind"), F.lit("-"), F.when(f("kind") == "subclause", F.replace(f("num"), F.lit("."), F.lit("-"))).otherwise(f("num")))
        return F.when(f("opens") == "app", F.concat(F.lit("clause-"), n.cast("string"))).otherwise(plain)

    of = lambda name: (lambda x: F.col(f"{name}.{x}"))
    opens, kind = F.coalesce("i.opens", F.lit("text")), F.col("i.kind")
    c_ok = F.col("c").isNotNull()
    s_ok = F.col("s").isNotNull() & (~c_ok | (F.col("s.seq") > F.col("c.seq")))
    p_ok = F.col("p").isNotNull() & (F.col("x").isNull() | (F.col("p.seq") > F.col("x")))
    plain = kind.isNull()
    # What a para hangs below was told when it came, and nothing that closes it has come since, so its own way up is the same.
    ups = [
        F.when(~opens.isin("app", "clause") & c_ok, F.struct("c.seq", "c.kind", step(of("c"), F.col("c_no")).alias("step"))),
        F.when(~opens.isin("app", "clause", "subclause") & s_ok & (~plain | (F.col("element_type") == "body")), F.struct("s.seq", "s.kind", step(of("s"), F.lit(0)).alias("step"))),
        F.when((kind == "subpara") & p_ok, F.struct("p.seq", "p.kind", step(of("p"), F.lit(0)).alias("step"))),
    ]
    up = F.filter(F.array(*ups), lambda u: u.isNotNull())
    top = F.concat(F.lit("schedule-"), F.col("schedule_no").cast("string"))
    parent = F.concat_ws("__", top, F.transform(up, lambda u: u["step"]))
    return up, F.when(~plain, F.concat_ws("__", parent, step(of("i"), F.col("n_clause")))), kind


def schedule_items(rows: DataFrame) -> DataFrame:
    """act_id, schedule_no, para_id, pos, kind (clause, subclause, para, subpara), num, heading, text, eid, parent_eid of schedule content. rows is the result of regions."""
    items = rows.where("region = 'schedule'").withColumn("i", schedule_item()).where("i IS NOT NULL").select("act_id", "schedule_no", "para_id", "pos", "element_type", "i")
    last, sums = schedule_state("pos")
    got = carry(items, ["act_id", "schedule_no"], "pos", last=last, sums=sums, marks={"c_no": (last["c"].isNotNull(), "n_clause")})
    _, eid, _ = schedule_place()
    out = got.select("act_id", "schedule_no", "para_id", "pos", "i.kind", "i.num", "i.heading", "i.text", eid.alias("eid"))
    return out.withColumn("parent_eid", F.regexp_replace("eid", "__(?:(?!__).)*$", ""))


def schedule_title() -> Column:
    """What stands after 'Schedule N' and its dashes; the whole text if nothing does."""
    rest = F.regexp_replace(F.regexp_replace("text", java(SCHEDULE_HEADING, True), ""), "^[—–\\- ]+", "")
    return F.coalesce(F.nullif(rest, F.lit("")), F.col("text"))


def schedule_headings(rows: DataFrame) -> DataFrame:
    """act_id, schedule_no, heading: what stands after 'Schedule N' and its dashes; the whole text if nothing does."""
    return rows.where(is_schedule_heading() & (F.col("region") == "schedule")).select("act_id", "schedule_no", schedule_title().alias("heading"))


def preface_routes(rows: DataFrame) -> DataFrame:
    """act_id, para_id, pos, route: where each row of a preface goes (toc, tocItem, formula, recital, p)."""
    text, style = F.coalesce("text", F.lit("")), F.coalesce("raw_style", F.lit(""))
    route = (
        F.when(style == "TOC Heading", "toc").when(style.isin("TOC 1", "TOC 2", "TOC 3"), "tocItem").when(text.rlike(java(ENACTING, True)), "formula")
        .when(text.rlike(java(WHEREAS, True)), "recital").otherwise("p")
    )
    return rows.where("region = 'preface'").select("act_id", "para_id", "pos", route.alias("route"))


def table_cells(rows: DataFrame) -> DataFrame:
    """act_id, para_id, row_no, col_no, tag, cell: cells of tables, the first row as headings."""
    r = rows.where("element_type = 'table'").select("act_id", "para_id", F.posexplode("table_rows").alias("row_no", "cells"))
    return r.select("act_id", "para_id", "row_no", F.posexplode("cells").alias("col_no", "cell")).withColumn("tag", F.when(F.col("row_no") == 0, "th").otherwise("td"))


