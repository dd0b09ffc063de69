"""Defined terms: extraction, registry, uses marked by an asterisk, and definitions that go on in list items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.carry import carry_last
from statuta.functions.patterns import java
from statuta.functions.skew import SALT, hot_keys, salt_few, salt_many
from statuta.functions.text import strip
from statuta.session import settled
from statuta.operators.annotate import formatted

ROWS_PER_TASK = 200_000
# Wordings of definition sections, of definitions, and of prose that only looks like one.
DEF_HEADING = r"\b(definitions?|interpretations?|meaning\s+of|dictionary|defined\s+terms)\b"
STOP = r"^(this\s+act|this\s+part|this\s+division|these\s+regulations?|this\s+schedule)\s+(means|includes?)"
DOES_NOT = r"does\s+not\s*$"
EMBEDDED_CONNECTOR = r"\b(means|includes?)\b"
EMBEDDED_RELATIVE = r"\((who|which|that)\b"
STOP_OPENER = r"^(a\s+reference|some\s+provisions|in\s+this\s+(division|chapter|part)|before\s+the|there\s+is|for\s+the\s+purposes\s+of)\b"
FUNCTION_WORDS = [
    "and", "or", "but", "by", "to", "of", "in", "on", "at", "for", "with", "from", "as", "that", "which", "who", "whom", "whose", "can", "may", "must", "shall", "will", "through", "the", "a", "an", "is", "are",
    "be", "been", "not", "than", "so",
]
_TERM = r"[A-Za-z][A-Za-z0-9\s\-\(\)\*]{1,60}?"
#: Group 1: all before the connector; 2: the term; 3: the connector; 4: the definition. The first that is accepted wins.
DEFINITIONS = [
    r'^("([^"]+)"\s+)(means|includes?)\s+(.*)',
    r'^("([^"]+)"\s+)(has the (?:same )?meaning (?:given by|as))\s+(.*)',
    rf"^(({_TERM}),\s+in relation to\s+[^,]{{1,60}},\s+)(means|includes?)\s+(.*)",
    rf"^(({_TERM})\s+)(means|includes?)\s+(.*)",
    rf"^(({_TERM})\s+)(has the (?:same )?meaning (?:given by|as))\s+(.*)",
]
TAIL = r"^\s+(means|includes?)\s+(.*)"
LIST_DEFINITION = rf"^({_TERM})(?:,.*?)?\s+means\s*:$"


def term_eid(show_as: Column) -> Column:
    """term-slug: lower case, anything but a-z and 0-9 as one hyphen, none at the ends. Different terms can share one."""
    return F.concat(F.lit("term-"), F.trim(F.regexp_replace(F.lower(show_as), "[^a-z0-9]+", "-"), F.lit("-")))


def narrative(show_as: Column) -> Column:
    """Why a supposed term is prose: embedded-connector, embedded-relative, stop-opener, dangling:word; null if it isn't."""
    tokens = F.filter(F.split(show_as, r"(?U)\s+"), lambda t: t != "")
    last = F.lower(F.trim(F.element_at(tokens, -1), F.lit("()[]{}.,;:")))
    return (
        F.when(show_as.rlike(java(EMBEDDED_CONNECTOR, True)), "embedded-connector").when(show_as.rlike(java(EMBEDDED_RELATIVE, True)), "embedded-relative")
        .when(show_as.rlike(java(STOP_OPENER, True)), "stop-opener").when((F.size(tokens) >= 2) & last.isin(FUNCTION_WORDS), F.concat(F.lit("dangling:"), last))
    )


def _made(show_as: Column, connector: Column, definiens: Column, quoted: Column) -> Column:
    return F.struct(show_as.alias("show_as"), connector.alias("connector"), definiens.alias("definiens"), quoted.alias("quoted"))


def definition(text: Column, spans: Column | None = None) -> Column:
    """(show_as, connector, definiens, quoted) of a definition, or null.

    A leading italic run directly before the connector is the term; else the
    wordings are tried in order. 'does not include', prose and 'this Act means'
    are no definitions.
    """
    s = strip(F.coalesce(text, F.lit("")))
    found = F.lit(None)
    g = lambda p, n: strip(F.regexp_extract(s, java(p, True, True), n))
    for p in reversed(DEFINITIONS):
        ok = s.rlike(java(p, True, True)) & ~F.regexp_extract(s, java(p, True, True), 1).rlike(java(DOES_NOT, True)) & narrative(g(p, 2)).isNull()
        found = F.when(ok, _made(g(p, 2), g(p, 3), g(p, 4), s.startswith('"'))).otherwise(found)
    if spans is not None:
        first = F.get(F.filter(spans, lambda x: x["bold"] | x["italic"] | x["superscript"] | x["subscript"]), F.lit(0))
        run = F.when(first["italic"], F.nullif(strip(first["text"]), F.lit("")))
        rest = F.substring(s, F.char_length(run) + 1, F.char_length(s))
        ok = F.coalesce(s.startswith(run) & rest.rlike(java(TAIL, True, True)) & narrative(run).isNull(), F.lit(False))
        t = java(TAIL, True, True)
        found = F.when(ok, _made(run, F.regexp_extract(rest, t, 1), strip(F.regexp_extract(rest, t, 2)), F.lit(False))).otherwise(found)
    return F.when((s != "") & ~s.rlike(java(STOP, True)), found)


def list_definition(text: Column) -> Column:
    """The term of 'X means:', or null."""
    s = strip(F.coalesce(text, F.lit("")))
    term = strip(F.regexp_extract(s, java(LIST_DEFINITION, True, True), 1))
    return F.when(s.rlike(java(LIST_DEFINITION, True, True)) & ~s.rlike(java(STOP, True)) & narrative(term).isNull(), term)


def with_section(rows: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """All columns with the section a row stands in (section_pos, section_heading; null above the first) and whether that defines
    terms. more: other values to carry along."""
    got = carry_last(rows, ["act_id"], "pos", {"sec": F.when(F.col("element_type") == "section", F.struct("pos", "heading")), **(more or {})})
    defines = F.coalesce(F.col("sec.heading").rlike(java(DEF_HEADING, True)), F.lit(False))
    return got.withColumns({"section_pos": F.col("sec.pos"), "section_heading": F.col("sec.heading"), "defines": defines}).drop("sec")


_BLOCKS = ["section", "part", "chapter", "dvs", "subdvs", "table", "figure"]


def definitions(rows: DataFrame) -> DataFrame:
    """act_id, para_id, pos, term_eid, show_as, connector, definiens, quoted: definitions in sections that define terms."""
    blocks = with_section(rows).where(F.col("defines") & ~F.col("element_type").isin(_BLOCKS))
    d = blocks.withColumn("d", definition(F.col("text"), F.col("spans"))).where("d IS NOT NULL")
    return d.select("act_id", "para_id", "pos", term_eid(F.col("d.show_as")).alias("term_eid"), "d.*")


def list_definitions(rows: DataFrame) -> DataFrame:
    """act_id, para_id, pos, term_eid, show_as of 'X means:' alone in its content and followed by paras or list items."""
    level = ~F.col("element_type").isin("note", "example", "penalty")
    both = with_section(rows, {"last": F.when(level, F.col("element_type"))})
    # Only such rows are asked what follows them, but all rows tell it.
    asked = settled(both.select("act_id", "para_id", "pos", "element_type", "last", "defines", F.when(F.col("defines"), list_definition(F.col("text"))).alias("show_as")), "lists")
    both = carry_last(asked.withColumn("back", -F.col("pos")), ["act_id"], "back", {"next": F.when(level, F.col("element_type"))}).drop("back")
    alone = (F.col("element_type") != "body") | (F.coalesce("last", F.lit("")) != "body")
    hit = both.where(F.col("defines") & ~F.col("element_type").isin(_BLOCKS) & F.col("next").isin("para", "list-item") & alone)
    return hit.where("show_as IS NOT NULL").select("act_id", "para_id", "pos", term_eid(F.col("show_as")).alias("term_eid"), "show_as")


def term_registry(defined: DataFrame) -> DataFrame:
    """act_id, term_eid, show_as, href: one row per identifier in an Act; the last definition wins."""
    last = defined.groupBy("act_id", "term_eid").agg(F.max_by("show_as", "pos").alias("show_as"))
    return last.withColumn("href", F.concat(F.lit("/ontology/term/au/"), "term_eid"))


def duplicate_terms(defined: DataFrame) -> DataFrame:
    """act_id, terms_found, duplicate_terms: definitions, and how many of them share an identifier with another."""
    return defined.groupBy("act_id").agg(F.count(F.lit(1)).alias("terms_found"), (F.count(F.lit(1)) - F.countDistinct("term_eid")).alias("duplicate_terms"))


def asterisk_refs(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """act_id, para_id, starts_at, term_eid, show_as: uses '*term' of a registered term, the longest that fits.

    No pairs of uses and terms are made: each asterisk offers the beginnings of
    what follows that end at a word's end, no longer than the Act's longest
    term, and these meet the terms in an equi-join. Paragraphs with formatted
    runs are passed over.
    """
    longest = registry.groupBy("act_id").agg(F.max(F.char_length("show_as")).alias("most"))
    starred = rows.where(F.contains(F.col("text"), F.lit("*")) & ~formatted()).select("act_id", "para_id", "text")
    hot = hot_keys(starred, ["act_id"], ROWS_PER_TASK)
    marked = salt_many(starred, hot, ["act_id"], ["para_id"]).join(salt_few(longest, hot, ["act_id"]), ["act_id", SALT]).drop(SALT)
    at = F.filter(F.sequence(F.lit(1), F.char_length("text")), lambda i: F.substring("text", i, F.lit(1)) == "*")
    stars = marked.select("act_id", "para_id", "text", "most", F.explode(at).alias("star"))
    tail = F.substring("text", F.col("star") + 1, F.col("most") + 1)
    ends = F.filter(F.sequence(F.lit(1), F.least("most", F.char_length(tail))), lambda i: F.substring(tail, i, F.lit(2)).rlike(r"(?U)^(\w(\W|$)|\W\w)"))
    tries = stars.where(F.char_length(tail) > 0).select("act_id", "para_id", (F.col("star") - 1).alias("starts_at"), F.explode(F.transform(ends, lambda i: F.substring(tail, F.lit(1), i))).alias("show_as"))
    hits = tries.join(registry.select("act_id", "term_eid", "show_as"), ["act_id", "show_as"])
    best = hits.groupBy("act_id", "para_id", "starts_at").agg(F.max_by(F.struct("term_eid", "show_as"), F.struct(F.char_length("show_as"), "term_eid")).alias("b"))
    return best.select("act_id", "para_id", "starts_at", "b.*")


def unresolved_asterisks(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """act_id, n: asterisks before a letter that no registered term explains. Paragraphs with formatted runs are passed over, as in asterisk_refs."""
    all_ = rows.where(F.contains(F.col("text"), F.lit("*")) & ~formatted()).groupBy("act_id").agg(F.sum(F.regexp_count("text", F.lit(r"\*[A-Za-z]"))).alias("n"))
    ok = resolved.where(F.col("show_as").rlike("^[A-Za-z]")).groupBy("act_id").agg(F.count(F.lit(1)).alias("r"))
    return all_.join(ok, "act_id", "left").select("act_id", (F.col("n") - F.coalesce("r", F.lit(0))).alias("n"))


def completed_definitions(rows: DataFrame) -> DataFrame:
    """act_id, para_id, term_eid, definiens: definitions that end in a colon, with the paras and list items that follow.

    They take in what follows up to the first row that is neither, or that
    itself begins a definition. Subparagraphs are passed over. The items of one
    definition meet in one row, as they are one text.
    """
    d = definition(F.col("text"), F.col("spans"))
    listed = F.col("element_type").isin("para", "list-item")
    r = rows.where("element_type NOT IN ('note', 'example', 'penalty', 'subpara')").withColumns({"d": d, "l": list_definition(F.col("text"))})
    stops = ~listed | F.col("d").isNotNull() | F.col("l").isNotNull()
    colon = F.coalesce(F.col("d").isNotNull() & F.endswith(strip(F.col("d.definiens")), F.lit(":")), F.lit(False))
    # A section ends what came before it, so a row stands in the section of the definition it goes on from.
    got = with_section(r.withColumns({"colon": colon, "stops": stops}), {"stop": F.when(stops, F.struct("pos", colon.alias("colon")))})
    head, item = F.col("defines") & F.col("colon"), ~F.col("stops") & F.col("stop.colon") & F.col("defines")
    ones = F.when(item, F.struct("pos", F.coalesce("text", F.lit("")).alias("text")))
    named = F.when(head, F.struct("para_id", "d.show_as", "d.definiens"))
    # A definition may itself go on from none: its own row and the rows that go on from it meet by its place.
    per = got.where(head | item).select("act_id", F.when(head, F.col("pos")).otherwise(F.col("stop.pos")).alias("at"), named.alias("head"), ones.alias("item")).groupBy("act_id", "at").agg(F.max("head").alias("h"), F.array_sort(F.collect_list("item")).alias("items"))
    return per.where("h IS NOT NULL AND size(items) > 0").select("act_id", "h.para_id", term_eid(F.col("h.show_as")).alias("term_eid"), F.concat_ws(" ", "h.definiens", F.array_join(F.transform("items", lambda x: x["text"]), " ")).alias("definiens"))
