"""Acts as annotated XML: what may mark up each paragraph, the marked-up text, and the fragments of each Act in order.

Nothing here gathers an Act: annotations are found row by row or by joins on
paragraphs, and a document is the order of its fragments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.carry import carry
from statuta.functions.patterns import all_matches, java, leftmost
from statuta.functions.text import extract
from statuta.operators import annotate as an
from statuta.operators import structure as st
from statuta.operators import terms as te
from statuta.operators.classify import is_schedule_heading
from statuta.operators.corpus import safe_name
from statuta.operators.render import TAGS, escape, inline
from statuta.session import settled

AKN_NS = "http://docs.oasis-open.org/legaldocml/ns/akn/3.0"
#: Parts of a document, in order: the opening with its identification, lifecycle, modifications, references, then the rows, then the end.
OPENING, LIFECYCLE, MODS, REFERENCES, ROWS, CLOSING = 0, 1, 2, 3, 4, 9
MARKS = "array<struct<starts_at: int, ends_at: int, kind: string, xml: string>>"
_REGION = {"preface": 0, "preamble": 1, "body": 2, "schedule": 3}


# --- annotations --------------------------------------------------------------------------------------------------------
def told(rows: DataFrame) -> DataFrame:
    """rows (the result of regions, or a stream without regions, all of it body) with what terms they define: defines, d (a
    definition) and l (the term of a list definition), written once."""
    body = F.lit(True) if "region" not in rows.columns else F.col("region") == "body"
    level = ~F.col("element_type").isin("note", "example", "penalty")
    both = te.with_section(rows, {"last": F.when(level, F.col("element_type"))})
    here = F.col("defines") & body & ~F.col("element_type").isin(te._BLOCKS)
    alone = (F.col("element_type") != "body") | (F.coalesce("last", F.lit("")) != "body")
    s = settled(both.withColumns({"d": F.when(here, te.definition(F.col("text"), F.col("spans"))), "l": F.when(here & alone, te.list_definition(F.col("text")))}).drop("last", "section_heading"), "told")
    ahead = carry(s.withColumn("back", -F.col("pos")), ["act_id"], "back", last={"next": F.when(level, F.col("element_type"))}).drop("back")
    return settled(ahead.withColumn("d_eid", te.term_eid(F.col("d.show_as"))).withColumn("l", F.when(F.col("next").isin("para", "list-item"), F.col("l"))).drop("next"), "told")


def registry(t: DataFrame) -> DataFrame:
    """act_id, term_eid, show_as, href of all terms that told rows define; the last definition of an identifier wins."""
    name = F.coalesce("d.show_as", "l")
    return te.term_registry(t.where(name.isNotNull()).select("act_id", "pos", te.term_eid(name).alias("term_eid"), name.alias("show_as")))


def claimed(t: DataFrame, terms: DataFrame) -> DataFrame:
    """told rows with stars (the asterisked terms in them) and claim: the one pass that may mark a paragraph up.

    The first that applies of term, listdef, fmt (formatted runs), ast (an
    asterisk before a registered term), qty, date, role; null if none does.
    """
    used = te.asterisk_refs(t.where("d IS NULL AND l IS NULL"), terms)
    stars = used.groupBy("para_id").agg(F.array_sort(F.collect_list(F.struct("starts_at", "term_eid", "show_as"))).alias("stars"))
    text = F.col("text")
    has = lambda ps: F.coalesce(F.greatest(*[text.rlike(p.java).cast("int") for p in ps], F.lit(0)) == 1, F.lit(False))
    claim = (
        F.when(F.col("d").isNotNull(), "term").when(F.col("l").isNotNull(), "listdef").when(an.formatted(), "fmt").when(F.col("stars").isNotNull(), "ast")
        .when(has(an.QUANTITIES), "qty").when(has(an.DATES), "date").when(has(an.ROLES), "role")
    )
    return t.join(stars, "para_id", "left").withColumn("claim", claim)


def _tag(name: str, attributes: dict[str, Column], inner: Column | None) -> Column:
    parts: list[Column] = [F.lit(f"<{name}")]
    for k, v in attributes.items():
        parts += [F.when(v.isNotNull(), F.concat(F.lit(f' {k}="'), escape(v), F.lit('"'))).otherwise("")]
    return F.concat(*parts, *([F.lit("/>")] if inner is None else [F.lit(">"), inner, F.lit(f"</{name}>")]))


def splice(text: Column, marks: Column) -> Column:
    """Escaped text with marks (sorted, not overlapping) in their places."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    step = lambda acc, m: F.struct(F.concat(acc["done"], escape(F.substring(text, acc["at"] + 1, m["starts_at"] - acc["at"]), False), m["xml"]).alias("done"), m["ends_at"].alias("at"))
    folded = F.aggregate(marks, start, step)
    return F.concat(folded["done"], escape(F.substring(text, folded["at"] + 1, F.char_length(text)), False))


def _marks(found: Column, xml) -> Column:
    return F.transform(found, lambda m: F.struct(m["starts_at"].cast("int").alias("starts_at"), m["ends_at"].cast("int").alias("ends_at"), m["kind"].alias("kind"), xml(m).alias("xml")))


def annotated(c: DataFrame, eids: DataFrame, citation_index: DataFrame) -> DataFrame:
    """claimed rows with marks (of the claiming pass, else references, ranges, note references), in_def (those within a
    definition) and the counts refs_resolved, refs_unresolved, range_resolved, range_unresolved, n_notes; written once.

    Ranges are looked for in paragraphs that nothing claims and in definitions,
    and count as marks where both ends are identifiers of the Act. Other
    references are looked for in what stands before the first mark, and note
    references where there is no mark at all. eids: act_id, eid.
    """
    none = F.array().cast(MARKS)
    text = F.coalesce("text", F.lit(""))
    pick = lambda ps: leftmost(all_matches(F.col("text"), ps))
    own = (
        F.when(F.col("claim") == "ast", F.transform("stars", lambda x: F.struct(x["starts_at"].alias("starts_at"), (x["starts_at"] + 1 + F.char_length(x["show_as"])).cast("int").alias("ends_at"), F.lit("term").alias("kind"), _tag("ref", {"href": F.concat(F.lit("#"), x["term_eid"])}, escape(x["show_as"], False)).alias("xml"))))
        .when(F.col("claim") == "qty", _marks(pick(an.QUANTITIES), lambda m: _tag("quantity", {"refersTo": F.concat(F.lit("#"), m["kind"])}, escape(m["matched"], False))))
        .when(F.col("claim") == "date", _marks(pick(an.DATES), lambda m: _tag("date", {"date": an.iso_date(m["kind"], m["matched"])}, escape(m["matched"], False))))
        .when(F.col("claim") == "role", _marks(pick(an.ROLES), lambda m: _tag("role", {"refersTo": F.concat(F.lit("#"), m["kind"])}, escape(m["matched"], False))))
        .otherwise(none)
    )
    plain = lambda s: ~F.coalesce(s["bold"] | s["italic"] | s["superscript"] | s["subscript"], F.lit(False))
    flags = F.transform("spans", lambda s: plain(s))
    n_lead = F.when(F.array_position(flags, F.lit(False)) > 0, F.array_position(flags, F.lit(False)) - 1).otherwise(F.size("spans"))
    lead = F.array_join(F.transform(F.slice("spans", F.lit(1), n_lead.cast("int")), lambda s: F.coalesce(s["text"], F.lit(""))), "")
    # Where references are looked for: the definition, or what stands before the first mark.
    place = (
        F.when(F.col("claim") == "term", F.col("d.definiens")).when(F.col("claim") == "listdef", "").when(F.col("claim") == "fmt", lead)
        .when(F.size("own") > 0, F.substring(text, F.lit(1), F.get("own", F.lit(0))["starts_at"])).otherwise(text)
    )
    open_ = F.coalesce(F.col("claim") == "term", F.col("claim").isNull())
    s = settled(c.withColumn("own", own).withColumn("place", place).withColumn("whole", open_), "marked")
    found = an.ranges(s.where("whole").select("para_id", "act_id", F.col("place").alias("text")), eids)
    rref = _tag("rref", {"from": F.col("href_from"), "upTo": F.col("href_up_to")}, escape(F.col("matched"), False))
    one = F.when(F.col("resolved"), F.struct(F.col("starts_at").cast("int").alias("starts_at"), (F.col("starts_at") + F.char_length("matched")).cast("int").alias("ends_at"), F.lit("range").alias("kind"), rref.alias("xml")))
    per = found.groupBy("para_id").agg(F.array_sort(F.collect_list(one)).alias("rrefs"), F.count_if("resolved").cast("int").alias("range_resolved"), F.count_if(~F.col("resolved")).cast("int").alias("range_unresolved"))
    r = s.join(per, "para_id", "left").withColumn("rrefs", F.coalesce("rrefs", none))
    r = r.withColumn("place", F.when(F.size("rrefs") > 0, F.substring("place", F.lit(1), F.get("rrefs", F.lit(0))["starts_at"])).otherwise(F.col("place")))
    r = settled(r, "ranged")
    refs = an.resolve_names(an.references(r.select("para_id", F.col("place").alias("text"))), citation_index)
    # A name that no Act bears is still an element, without a target.
    ref = F.struct(F.col("starts_at").cast("int").alias("starts_at"), F.col("ends_at").cast("int").alias("ends_at"), F.lit("ref").alias("kind"), _tag("ref", {"href": F.coalesce("href", F.lit("#unresolved"))}, escape(F.col("matched"), False)).alias("xml"))
    per = refs.groupBy("para_id").agg(F.array_sort(F.collect_list(ref)).alias("refs"), F.count_if(F.col("status") == "resolved").cast("int").alias("refs_resolved"), F.count_if(F.col("status") != "resolved").cast("int").alias("refs_unresolved"))
    r = r.join(per, "para_id", "left").withColumn("refs", F.coalesce("refs", none))
    bare = F.col("claim").isNull() & (F.size("rrefs") == 0) & (F.size("refs") == 0)
    marker = lambda m: F.regexp_extract(m["matched"], an.NOTE_REF.java, 1)
    notes = F.when(bare & text.rlike(an.NOTE_REF.java), _marks(pick([an.NOTE_REF]), lambda m: _tag("noteRef", {"href": F.concat(F.lit("#note-"), marker(m)), "marker": marker(m)}, None))).otherwise(none)
    r = r.withColumn("notes", notes)
    both = F.array_sort(F.concat("refs", "rrefs"))
    in_def = F.col("claim") == "term"
    zero = lambda k: F.coalesce(k, F.lit(0)).alias(k)
    kept = [x for x in r.columns if x not in ("stars", "own", "place", "whole", "rrefs", "refs", "notes", "refs_resolved", "refs_unresolved", "range_resolved", "range_unresolved")]
    return settled(r.select(
        *kept, F.when(in_def, none).otherwise(F.array_sort(F.concat("own", both, "notes"))).alias("marks"), F.when(in_def, both).otherwise(none).alias("in_def"),
        F.when(F.col("claim") == "fmt", n_lead).otherwise(0).cast("int").alias("n_lead"), F.size("own").alias("n_own"), F.size("notes").alias("n_notes"),
        *[zero(k) for k in ("refs_resolved", "refs_unresolved", "range_resolved", "range_unresolved")],
    ), "annotated")


def paragraph_xml(more: Column | None = None) -> Column:
    """What stands in the p element of an annotated row. more: what goes on a definition that ends in a colon."""
    text = F.coalesce("text", F.lit(""))
    term = lambda shown, name: _tag("term", {"refersTo": F.concat(F.lit("#"), te.term_eid(name))}, escape(shown, False))
    shown = F.when(F.col("d.quoted"), F.concat(F.lit('"'), F.col("d.show_as"), F.lit('"'))).otherwise(F.col("d.show_as"))
    tail = F.lit("") if more is None else F.when(more.isNotNull(), F.concat(F.lit(" "), escape(more, False))).otherwise("")
    defined = F.concat(term(shown, F.col("d.show_as")), F.lit(" "), escape(F.col("d.connector"), False), F.lit(" <def>"), splice(F.col("d.definiens"), F.col("in_def")), tail, F.lit("</def>"))
    led = F.array_join(F.transform(F.slice("spans", F.lit(1), F.col("n_lead")), lambda s: F.coalesce(s["text"], F.lit(""))), "")
    rest = F.slice("spans", F.col("n_lead") + 1, F.greatest(F.size("spans") - F.col("n_lead"), F.lit(0)))
    return (
        F.when(F.col("claim") == "term", defined).when(F.col("claim") == "listdef", F.concat(term(F.col("l"), F.col("l")), F.lit(" means:")))
        .when(F.col("claim") == "fmt", F.concat(splice(led, F.col("marks")), inline(F.lit(""), rest, False))).otherwise(splice(text, F.col("marks")))
    )


# --- documents ----------------------------------------------------------------------------------------------------------
def _entry(id_: Column, opening: Column, closing: str | Column) -> Column:
    return F.struct(id_.alias("id"), opening.alias("open"), (closing if isinstance(closing, Column) else F.lit(closing)).alias("close"))


def _simple(name: str, attributes: str = "") -> Column:
    return _entry(F.lit(name), F.lit(f"<{name}{attributes}>"), f"</{name}>")


def placed(rows: DataFrame) -> DataFrame:
    """Annotated rows with seq (one order over all regions), eid, path (the elements that enclose a row, from the outermost) and leaf
    (its own markup); rows has region, schedule_no and what annotated gives, and more (null or what goes on a definition).

    Quoted structures that hold one provision enclose their rows, whose
    identifiers begin anew within them; other quotation marks stay text. What
    follows a note within one provision opens its content anew.
    """
    route = F.when(F.col("region") == "preface", F.when(F.coalesce("text", F.lit("")).rlike(java(st.WHEREAS, True)), "preamble").otherwise("preface")).otherwise(F.col("region"))
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in _REGION.items() for x in kv]), F.col("route")).cast("bigint")
    r = rows.withColumn("route", route).withColumn("seq", rank * F.lit(2**50) + F.col("pos"))
    body = F.col("route") == "body"
    mark = F.coalesce(body & (F.col("element_type") == "body") & st.strip(F.col("text")).isin(st.QUOTE_MARKS), F.lit(False))
    r = r.withColumn("i", F.when(F.col("route") == "schedule", st.schedule_item()))
    q = settled(carry(r.withColumn("mark", mark), ["act_id"], "seq", sums={"c": F.col("mark").cast("int")}, totals=True), "quoted")
    within = (F.col("c") % 2 == 1) & (F.col("c") < F.col("c_total"))
    quote_no = F.when(within | (F.col("mark") & (F.col("c") % 2 == 0)), F.ceil(F.col("c") / 2).cast("bigint"))
    handled = st.quotes(q.where(body).select("act_id", F.col("seq").alias("pos"), "element_type", "text")).where("handled").select("act_id", F.col("quote_no").alias("no"), F.lit(True).alias("handled"))
    q = q.withColumn("no", quote_no)
    asked = q.where("no IS NOT NULL").select("act_id", "para_id", "no").join(handled, ["act_id", "no"]).select("para_id", F.col("no").alias("quote"))
    q = q.drop("no").join(asked, "para_id", "left")
    inner = F.col("quote").isNotNull() & ~F.col("mark")
    border = F.col("quote").isNotNull() & F.col("mark")
    depth = F.when(body, st._map(st.DEPTH, F.col("element_type")))
    number = F.coalesce("number", F.lit(""))
    item = body & (F.col("element_type") == "list-item")
    level = F.when(number.rlike("^[0-9]+$"), number).otherwise("0")
    q = settled(q.withColumns({"depth": depth, "inner": inner, "border": border, "step": F.when(depth.isNotNull(), st.eid_part(F.col("element_type"), number)), "item": item, "level": level}).drop("c", "c_total"), "quoted")
    at = F.struct("seq", "step")
    # The levels that are open before a row, of the Act and of the quotation it stands in, and the row before it.
    seen = {f"o{d}": F.when((F.col("depth") == d) & ~F.col("inner"), at) for d in range(9)} | {f"q{d}": F.when((F.col("depth") == d) & F.col("inner"), F.struct("seq", "step", "quote")) for d in range(9)}
    seen["prev"] = F.struct("item", "level", "quote")
    clauses, clause_sum = st.schedule_state()
    notes = body & (F.col("element_type") == "note")
    figures = body & (F.col("element_type") == "figure")
    got = carry(q, ["act_id"], "seq", last=seen, sums={"note_no": notes.cast("int"), "figure_no": figures.cast("int")})
    starts = F.col("item") & ~F.coalesce(F.col("prev.item") & (F.col("prev.level") == F.col("level")) & F.col("prev.quote").eqNullSafe(F.col("quote")), F.lit(False))

    def chain(p: str, mine: Column) -> Column:
        """The open levels above a row, from the outermost: each after all that are above it."""
        above, out = F.lit(-1).cast("bigint"), []
        for d in range(9):
            here = F.col(f"{p}{d}")
            ok = mine & here.isNotNull() & (here["seq"] > above) & (F.coalesce(F.col("depth"), F.lit(99)) > d)
            out.append(F.when(ok, F.struct(here["seq"].alias("seq"), here["step"].alias("step"), F.lit(f"</{[t for t, n in st.DEPTH.items() if n == d][0]}>").alias("close"))))
            above = F.when(mine, F.greatest(above, F.coalesce(here["seq"], F.lit(-1)))).otherwise(above)
        return F.filter(F.array(*out), lambda x: x.isNotNull())

    outer_depth = F.col("depth")
    got = got.withColumns({"starts": starts, "depth_": outer_depth})
    got = got.withColumn("depth", F.when(F.col("inner"), None).otherwise(F.col("depth"))).withColumn("up", chain("o", F.lit(True)))
    got = got.withColumn("depth", F.col("depth_"))
    for d in range(9):
        got = got.withColumn(f"q{d}", F.when(F.col(f"q{d}.quote") == F.col("quote"), F.col(f"q{d}")))
    got = got.withColumn("inner_up", F.when(F.col("inner"), chain("q", F.lit(True))).otherwise(F.array().cast("array<struct<seq: bigint, step: string, close: string>>")))
    got = got.drop(*[f"{p}{d}" for p in "oq" for d in range(9)], "prev", "depth_")
    # Lists are numbered anew by every level row, items by every list.
    own_level = F.col("depth").isNotNull()
    listed = carry(settled(got, "levels"), ["act_id"], "seq", sums={"n_lists": F.col("starts").cast("int"), "n_items": F.col("item").cast("int")}, marks={"l0": (own_level, "n_lists"), "i0": (F.col("starts"), "n_items")})
    listed = listed.withColumns({"list_no": F.col("n_lists") - F.coalesce("l0", F.lit(0)), "item_no": F.when(F.col("starts"), 1).otherwise(F.col("n_items") - F.col("i0") + 1)}).drop("n_lists", "n_items", "l0", "i0")
    sched = carry(settled(listed, "lists"), ["act_id", "schedule_no"], "seq", last=clauses, sums=clause_sum, marks={"c_no": (clauses["c"].isNotNull(), "n_clause")})
    return settled(_shown(sched), "placed")


def _shown(r: DataFrame) -> DataFrame:
    p = F.concat(F.lit("<p>"), paragraph_xml(F.col("more")), F.lit("</p>"))
    content = lambda x: F.concat(F.lit("<content>"), x, F.lit("</content>"))
    part = lambda tag, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"<{tag}>"), escape(c, False), F.lit(f"</{tag}>"))).otherwise("")
    has_text = F.coalesce("text", F.lit("")) != ""
    kind = F.col("element_type")
    up_ids = lambda up: F.transform(up, lambda x: F.struct(F.concat(F.lit("at-"), x["seq"].cast("string")).alias("id"), F.lit("").alias("open"), F.regexp_replace(x["close"], "</(.*)>", "$1").alias("close")))
    tags = F.create_map(*[F.lit(x) for kv in TAGS.items() for x in kv])
    # The close of a level is told by its type until here, now by its tag.
    closed = lambda up: F.transform(up_ids(up), lambda x: F.struct(x["id"].alias("id"), x["open"].alias("open"), F.concat(F.lit("</"), F.element_at(tags, x["close"]), F.lit(">")).alias("close")))
    prefix = lambda up: F.array_join(F.transform(up, lambda x: x["step"]), "__")
    level_up = F.when(F.col("inner"), F.col("inner_up")).otherwise(F.col("up"))
    eid = F.when(F.col("depth").isNotNull(), F.concat_ws("__", F.nullif(prefix(level_up), F.lit("")), F.col("step")))
    tag = F.element_at(tags, kind)
    opening = F.concat(F.lit("<"), tag, F.when(kind == "level4", ' name="level4"').otherwise(""), F.lit(' eId="'), escape(eid), F.lit('">'), F.lit("<num>"), escape(F.col("number"), False), F.lit("</num>"), part("heading", F.col("heading")))
    own = F.when(F.col("depth").isNotNull(), F.array(_entry(F.concat(F.lit("at-"), F.col("seq").cast("string")), opening, F.concat(F.lit("</"), tag, F.lit(">")))))
    empty = F.array().cast("array<struct<id: string, open: string, close: string>>")
    list_eid = F.concat_ws("__", F.nullif(prefix(level_up), F.lit("")), F.concat(F.lit("list-"), F.col("list_no").cast("string")))
    lists = F.when(F.col("item"), F.array(_entry(F.concat(F.lit("list-"), (F.col("seq") - F.col("item_no")).cast("string")), F.concat(F.lit('<blockList eId="'), escape(list_eid), F.lit('">')), "</blockList>")))
    group = F.when((kind == "body") & has_text & ~F.col("border"), F.array(_simple("content")))
    quote = F.when(F.col("quote").isNotNull(), F.array(_entry(F.concat(F.lit("quote-"), F.col("quote").cast("string")), F.lit('<quotedStructure startQuote="“" endQuote="”" from="#" to="#">'), "</quotedStructure>")))
    in_body = F.concat(F.array(_simple("body")), closed(F.col("up")), F.coalesce(quote, empty), F.when(F.col("inner"), closed(F.col("inner_up"))).otherwise(empty), F.coalesce(own, lists, group, empty))
    # Items: '(a) text' is split into number and text.
    split = java(st.LIST_NUMBER, dot_all=True)
    text = F.coalesce("text", F.lit(""))
    item_eid = F.concat(list_eid, F.lit("__item-"), F.col("item_no").cast("string"))
    item = F.concat(F.lit('<item eId="'), escape(item_eid), F.lit('">'), F.when(text.rlike(split) & F.col("claim").isNull() & (F.size("marks") == 0), F.concat(F.lit("<num>"), escape(F.regexp_extract(text, split, 1), False), F.lit("</num><p>"), escape(F.regexp_extract(text, split, 2), False), F.lit("</p>"))).otherwise(p), F.lit("</item>"))
    cell = lambda i: (lambda c: F.concat(F.when(i == 0, "<th>").otherwise("<td>"), escape(c, False), F.when(i == 0, "</th>").otherwise("</td>")))
    grid = F.array_join(F.transform(F.coalesce("table_rows", F.array().cast("array<array<string>>")), lambda x, i: F.concat(F.lit("<tr>"), F.array_join(F.transform(x, cell(i)), ""), F.lit("</tr>"))), "")
    named = lambda n: F.concat(F.lit(f'<hcontainer name="{n}">'), content(p), F.lit("</hcontainer>"))
    note = F.concat(F.lit('<authorialNote placement="end" eId="note-'), F.col("note_no").cast("string"), F.lit('" marker="'), F.col("note_no").cast("string"), F.lit('">'), content(p), F.lit("</authorialNote>"))
    image = F.concat(F.lit('<figure><img src="'), escape(F.concat(F.lit("corpus/images/"), F.col("act_id"), F.lit("-fig-"), F.col("figure_no").cast("string"), F.lit(".png"))), F.lit('" alt=""/></figure>'))
    leveled = F.when(kind.isin("subsec", "para", "subpara", "level4") & has_text, F.when(F.col("claim") == "listdef", F.concat(F.lit("<intro>"), p, F.lit("</intro>"))).otherwise(content(p))).otherwise("")
    body_leaf = (
        F.when(F.col("border"), "").when(F.col("depth").isNotNull(), leveled).when(F.col("item"), item).when(kind == "note", note).when(kind == "example", named("example")).when(kind == "penalty", named("penalty"))
        .when(kind == "table", F.concat(F.lit("<table>"), grid, F.lit("</table>"))).when(kind == "figure", image).when((kind == "body") & has_text, p).otherwise("")
    )
    # Schedules: an attachment each, its clauses and what hangs below them.
    sched = F.concat(F.lit("schedule-"), F.col("schedule_no").cast("string"))
    head = is_schedule_heading()
    headed = F.when(head, part("heading", st.schedule_title())).otherwise("")
    attachment = _entry(sched, F.concat(F.lit('<attachment><hcontainer name="schedule" eId="'), sched, F.lit('">'), headed), "</hcontainer></attachment>")
    ups, own_eid, own_kind = st.schedule_place()
    up_entries = F.transform(ups, lambda x: F.struct(F.concat(F.lit("at-"), x["seq"].cast("string")).alias("id"), F.lit("").alias("open"), F.when(x["kind"] == "para", "</paragraph>").otherwise("</hcontainer>").alias("close")))
    box = F.when(own_kind.isin("clause", "subclause"), F.concat(F.lit('hcontainer name="'), own_kind, F.lit('"'))).when(own_kind == "para", "paragraph").when(own_kind == "subpara", "subparagraph")
    s_open = F.concat(F.lit("<"), box, F.lit(' eId="'), escape(own_eid), F.lit('"><num>'), escape(F.col("i.num"), False), F.lit("</num>"), part("heading", F.col("i.heading")))
    s_own = F.when(own_kind.isNotNull(), F.array(_entry(F.concat(F.lit("at-"), F.col("seq").cast("string")), s_open, F.concat(F.lit("</"), F.element_at(F.split(box, " "), 1), F.lit(">")))))
    s_text = F.when(own_kind.isNull() & ~head & has_text, F.array(_simple("content")))
    in_schedule = F.concat(F.array(_simple("attachments"), attachment), up_entries, F.coalesce(s_own, s_text, empty))
    cut = F.when(F.col("i.cut"), F.concat(F.lit("<p>"), escape(F.col("i.text"), False), F.lit("</p>"))).otherwise(p)
    schedule_leaf = F.when(head, "").when(own_kind.isNotNull(), F.when(F.col("i.text").isNotNull(), content(cut)).otherwise("")).when(has_text, p).otherwise("")
    # Prefaces.
    style = F.coalesce("raw_style", F.lit(""))
    toc, toc_item = style == "TOC Heading", style.isin("TOC 1", "TOC 2", "TOC 3")
    in_preface = F.concat(F.array(_simple("preface")), F.when(toc | toc_item, F.array(_simple("toc"))).otherwise(empty))
    preface_leaf = F.when(toc, "").when(toc_item, F.concat(F.lit("<tocItem>"), escape(F.col("text"), False), F.lit("</tocItem>"))).when(text.rlike(java(st.ENACTING, True)), F.concat(F.lit('<formula name="enacting">'), p, F.lit("</formula>"))).otherwise(p)
    in_preamble = F.array(_simple("preamble"), _simple("recitals"))
    where = F.col("route")
    path = F.when(where == "body", in_body).when(where == "schedule", in_schedule).when(where == "preamble", in_preamble).otherwise(in_preface)
    leaf = F.when(where == "body", body_leaf).when(where == "schedule", schedule_leaf).when(where == "preamble", F.concat(F.lit("<recital>"), p, F.lit("</recital>"))).otherwise(preface_leaf)
    return r.select("act_id", "para_id", "seq", "route", F.coalesce(eid, own_eid).alias("eid"), path.alias("path"), leaf.alias("leaf"))


def row_fragments(rows: DataFrame) -> DataFrame:
    """act_id, part, ord, xml of placed rows: each closes what ends before it and opens what it stands in. The last one of an Act
    closes all. Only the path of the row before is needed, so an Act's size doesn't matter."""
    ids = F.transform("path", lambda x: F.struct(x["id"].alias("id"), x["close"].alias("close")))
    got = carry(rows.withColumn("ids", ids), ["act_id"], "seq", last={"before": F.col("ids")})
    shared = F.aggregate(
        F.sequence(F.lit(1), F.least(F.size("path"), F.size("before"))), F.lit(0), lambda n, i: F.when((n == i - 1) & (F.get("path", i - 1)["id"] == F.get("before", i - 1)["id"]), i).otherwise(n)
    )
    n = F.when(F.col("before").isNull(), 0).otherwise(shared)
    got = got.withColumn("n", n)
    before = F.coalesce("before", F.array().cast("array<struct<id: string, close: string>>"))
    closing = F.array_join(F.reverse(F.transform(F.slice(before, F.col("n") + 1, F.greatest(F.size(before) - F.col("n"), F.lit(0))), lambda x: x["close"])), "")
    opening = F.array_join(F.transform(F.slice("path", F.col("n") + 1, F.greatest(F.size("path") - F.col("n"), F.lit(0))), lambda x: x["open"]), "")
    made = got.select("act_id", F.lit(ROWS).alias("part"), F.col("seq").alias("ord"), F.concat(closing, opening, "leaf").alias("xml"))
    last = rows.groupBy("act_id").agg(F.max_by(ids, "seq").alias("ids"), F.count_if(F.col("route") == "body").alias("n"))
    end = F.concat(F.array_join(F.reverse(F.transform("ids", lambda x: x["close"])), ""), F.lit("</act></akomaNtoso>"))
    return made.unionByName(last.select("act_id", F.lit(CLOSING).alias("part"), F.lit(0).cast("bigint").alias("ord"), end.alias("xml")))


def head_fragments(metadata: DataFrame, acts: DataFrame, events: DataFrame, mods: DataFrame, references: DataFrame) -> DataFrame:
    """act_id, part, ord, xml of the meta element of each Act, piece by piece.

    metadata: act_id, identification, classification; acts: act_id, year, name,
    number of what a document is made for; events: the result of lifecycle;
    mods: of passive_mods; references: act_id, element (TLCTerm and so on), eid,
    href, show_as.
    """
    frame = lambda d, part, ord_, xml: d.select("act_id", F.lit(part).alias("part"), ord_.cast("bigint").alias("ord"), xml.alias("xml"))
    low, high = F.lit(-1), F.lit(2**62)
    opened = frame(metadata, OPENING, low, F.concat(F.lit(f'<akomaNtoso xmlns="{AKN_NS}"><act name="act"><meta>'), F.coalesce("identification", F.lit(""))))
    dated = acts.join(events.select("act_id").distinct(), "act_id", "left_semi")
    creation = F.concat(F.lit('<lifecycle source="#parliament"><eventRef date="'), F.coalesce(F.col("year").cast("string"), F.lit("0000")), F.lit('-01-01" type="generation" eId="evt-creation" source="#'), escape(safe_name(F.col("name"))), F.lit('"/>'))
    life = frame(dated, LIFECYCLE, low, creation)
    event = F.concat(F.lit('<eventRef type="amendment" eId="'), F.col("event_eid"), F.lit('" source="'), F.col("source"), F.lit('"/>'))
    each = frame(events, LIFECYCLE, F.regexp_extract("event_eid", r"(\d+)$", 1).cast("bigint"), event)
    lived = frame(dated, LIFECYCLE, high, F.lit('</lifecycle><temporalData source="#parliament"><temporalGroup eId="tg-1"><timeInterval start="#evt-creation"/></temporalGroup></temporalData>'))
    resolved = mods.where("mod_no IS NOT NULL")
    with_mods = resolved.select("act_id").distinct()
    mod = F.concat(F.lit('<textualMod type="'), F.col("mod_type"), F.lit('" eId="mod-'), F.col("mod_no").cast("string"), F.lit('"><source href="#'), escape(F.col("event_eid")), F.lit('"/><destination href="#'), escape(F.col("dest_eid")), F.lit('"/></textualMod>'))
    parts = [
        opened, life, each, lived, frame(with_mods, MODS, low, F.lit('<analysis source="#source"><passiveModifications>')), frame(resolved, MODS, F.col("mod_no"), mod), frame(with_mods, MODS, high, F.lit("</passiveModifications></analysis>")),
        frame(metadata, REFERENCES, low, F.concat(F.coalesce("classification", F.lit("")), F.lit('<references source="#source"><TLCOrganization eId="parliament" href="/ontology/organization/au/parliament" showAs="Parliament of Australia"/>'))),
    ]
    tlc = F.concat(F.lit("<"), F.col("element"), F.lit(' eId="'), escape(F.col("eid")), F.lit('" href="'), escape(F.col("href")), F.lit('" showAs="'), escape(F.col("show_as")), F.lit('"/>'))
    # Their order among each other follows from a hash, so that no Act's terms are numbered in one task; identifiers tell them apart.
    parts += [frame(references, REFERENCES, F.abs(F.xxhash64("eid") % F.lit(2**61)), tlc), frame(metadata, REFERENCES, high, F.lit("</references></meta>"))]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def used_references(a: DataFrame, terms: DataFrame) -> DataFrame:
    """act_id, element, eid, href, show_as: terms, and the concepts and roles that annotated rows mark, each once in an Act."""
    marks = a.where(F.col("claim").isin("qty", "role")).select("act_id", "claim", F.explode("marks").alias("m")).where("m.kind NOT IN ('ref', 'range')").select("act_id", "claim", F.col("m.kind").alias("eid")).distinct()
    shown = F.create_map(*[F.lit(x) for p in [*an.QUANTITIES, *an.ROLES] for x in (p.kind, p.note)])
    seen = marks.select("act_id", F.when(F.col("claim") == "qty", "TLCConcept").otherwise("TLCRole").alias("element"), "eid", F.concat(F.when(F.col("claim") == "qty", "/ontology/concept/au/").otherwise("/ontology/roles/au/"), "eid").alias("href"), F.element_at(shown, F.col("eid")).alias("show_as"))
    return seen.unionByName(terms.select("act_id", F.lit("TLCTerm").alias("element"), F.col("term_eid").alias("eid"), "href", "show_as"))


def documents(rows: DataFrame, acts: DataFrame, entries: DataFrame, events: DataFrame, made_on: str) -> dict[str, DataFrame]:
    """Of Acts all that a build makes: fragments (act_id, part, ord, xml), report (one row per Act), annotated, placed, terms.

    rows is the result of regions; acts have title_id and the columns of
    metadata; entries is the citation index; events the result of
    amendments.events, with act_id. An Act without rows gives no fragment but a
    meta element and no report. made_on is the day of making, yyyy-mm-dd.
    """
    from statuta.operators import amendments as am
    from statuta.operators import quality as qu
    from statuta.operators.render import metadata_parts

    t = told(rows)
    terms = settled(registry(t), "terms")
    hier = settled(st.hierarchy(t.where("region = 'body'")), "levels")
    eids = hier.select("act_id", "eid").unionByName(st.schedule_items(t).select("act_id", "eid")).distinct()
    a = annotated(claimed(t, terms), eids, entries)
    whole = te.completed_definitions(t.where("region = 'body'")).select("para_id", F.col("definiens").alias("more"))
    a = settled(a.join(whole, "para_id", "left").withColumn("more", F.substring("more", F.char_length("d.definiens") + 2, F.char_length("more"))), "completed")
    p = placed(a)
    known = p.where("eid IS NOT NULL").select("act_id", "eid")
    ordered = events.withColumn("ord", F.col("row_ord") * 10_000 + F.col("seg_no") * 100 + F.col("num_no"))
    mods = settled(am.passive_mods(ordered, known, ["ord"]), "mods")
    of = rows.select("act_id").distinct()
    meta = of.join(acts.withColumnRenamed("title_id", "act_id"), "act_id", "left")
    head = head_fragments(metadata_parts(meta, made_on), meta, am.lifecycle(events).join(of, "act_id", "left_semi"), mods.join(of, "act_id", "left_semi"), used_references(a, terms))
    return {"fragments": head.unionByName(row_fragments(p)), "report": qu.full_report(a, terms, events, mods), "annotated": a, "placed": p, "terms": terms}
