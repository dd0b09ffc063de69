"""Annotations of paragraph text: references, quantities, officeholders, dates, note references, and who may claim a paragraph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.patterns import Pattern, all_matches, java, leftmost
from statuta.functions.text import extract

# The patterns of references, the most specific first.
REFS = [
    Pattern("sec_subsec_para", r"\bs\s*(\d+[A-Z]?)\((\d+[A-Z]?)\)\(([a-z]+)\)"),
    Pattern("sec_subsec", r"\bs\s*(\d+[A-Z]?)\((\d+[A-Z]?)\)"),
    Pattern("sec", r"\b(?:section|s)\s+(\d+[A-Z]?)"),
    Pattern("part_div", r"\b(Part|Division)\s+([\dIVXA-Z]++)(?!\s+of\s+the)"),
    Pattern("def_ref", r"\b(?:within the meaning of|as defined in)\s+(?:section|subsection|s)\s+(\d+[A-Z]?)(?:\((\d+[A-Z]?)\))?"),
    Pattern("subsidiary", r"\bthe\s+([A-Z][A-Za-z ]+?(?:Regulation|Instrument|Order|Rules?)\s+\d{4})"),
    Pattern("act", r"\bthe\s+([A-Z][A-Za-z ]+?Act\s+\d{4})"),
]
RANGE = Pattern("range", r"\b(sections?|ss\.?|parts?|divisions?)\s+(\w+)\s+to\s+(\w+)", True)
# How identifiers of a range begin, by its keyword.
RANGE_PREFIX = {"section": "sec", "sections": "sec", "ss": "sec", "ss.": "sec", "part": "part", "parts": "part", "division": "dvs", "divisions": "dvs"}
# The patterns of quantities.
QUANTITIES = [
    Pattern("penaltyUnit", r"\b(\d[\d,]*)\s+penalty units?\b", True, "penalty unit"),
    Pattern("custodialSentence", r"\b(?:(\d+)\s+(?:months?|years?)\s+imprisonment|imprisonment\s+for\s+(\d+)\s+(?:months?|years?))\b", True, "term of imprisonment"),
    Pattern("deadline", r"\bwithin\s+(\d+)\s+(days?|weeks?|months?)\b", True, "deadline"),
]
# Officeholders, the more specific first: identifier, phrase, and how it is shown.
ROLES = [
    Pattern(eid, rf"\b{phrase}\b", True, shown)
    for eid, phrase, shown in [
        ("privacy-commissioner", "the Privacy Commissioner", "Privacy Commissioner"),
        ("information-commissioner", "the Information Commissioner", "Information Commissioner"),
        ("commissioner-of-taxation", "the Commissioner of Taxation", "the Commissioner of Taxation"),
        ("trustee", "the trustee", "the trustee"),
        ("commissioner", "the Commissioner", "the Commissioner"),
        ("secretary", "the Secretary", "the Secretary"),
        ("minister", "the Minister", "the Minister"),
        ("registrar", "the Registrar", "the Registrar"),
        ("ceo", "the CEO", "the CEO"),
        ("authority", "the Authority", "the Authority"),
    ]
]
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
# The patterns of dates.
DATES = [
    Pattern("dmy", rf"\b(\d{{1,2}})\s+({'|'.join(MONTHS)})\s+(\d{{4}})\b", True),
    Pattern("slash", r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b"),
    Pattern("commencement", r"\b(the day this Act commences|the commencement day|the day of commencement)\b", True),
]
NOTE_REF = Pattern("noteRef", r"\[note\s+(\d+)\]", True)


def spans(df: DataFrame, patterns: list[Pattern], id_col: str = "para_id", text_col: str = "text", drop_quoted: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """id_col, keep, starts_at, ends_at, kind, matched, note: the leftmost matches that don't overlap, in place order.

    drop_quoted leaves out matches wholly inside straight double quotes. Null,
    empty and unmatched texts give no rows; a row delivered twice gives its
    matches twice. Everything runs in the JVM without a shuffle.
    """
    text = F.col(text_col)
    found = all_matches(text, patterns)
    if drop_quoted:
        found = F.filter(found, lambda m: ~in_quotes(text, m["starts_at"], m["ends_at"]))
    return (
        df.where(text.isNotNull()).select(id_col, *keep, F.explode(leftmost(found)).alias("m"))
        .select(id_col, *keep, "m.starts_at", "m.ends_at", "m.kind", "m.matched", "m.note")
    )


def in_quotes(text: Column, starts_at: Column, ends_at: Column) -> Column:
    """Whether a match lies wholly between a straight double quote and the next one."""
    before = F.substring(text, F.lit(1), starts_at)
    n_before = F.char_length(before) - F.char_length(F.replace(before, F.lit('"'), F.lit("")))
    after = F.substring(text, ends_at + 1, F.char_length(text))
    inside = F.substring(text, starts_at + 1, ends_at - starts_at)
    return (n_before % 2 == 1) & F.contains(after, F.lit('"')) & ~F.contains(inside, F.lit('"'))


def references(df: DataFrame, id_col: str = "para_id", text_col: str = "text") -> DataFrame:
    """The reference spans with href: the target inside the same Act, or null for a name that the citation index must resolve (target_name).

    'Part III of the X' refers to another Act and isn't matched at all: the
    number is taken whole or not, so no shortened number is found instead.
    """
    s = spans(df, REFS, id_col, text_col, drop_quoted=True)
    m, by = F.col("matched"), {p.kind: p for p in REFS}

    def g(kind: str, n: int) -> Column:
        return extract(m, by[kind].java.replace("(?!\\s+of\\s+the)", ""), n)

    sec = F.concat(F.lit("#sec-"), g("sec", 1))
    href = (
        F.when(F.col("kind") == "sec_subsec_para", F.concat(F.lit("#sec-"), g("sec_subsec_para", 1), F.lit("__subsec-"), g("sec_subsec_para", 2), F.lit("__para-"), g("sec_subsec_para", 3)))
        .when(F.col("kind") == "sec_subsec", F.concat(F.lit("#sec-"), g("sec_subsec", 1), F.lit("__subsec-"), g("sec_subsec", 2)))
        .when(F.col("kind") == "sec", sec)
        .when(F.col("kind") == "part_div", F.concat(F.when(g("part_div", 1) == "Part", "#part-").otherwise("#dvs-"), g("part_div", 2)))
        .when(F.col("kind") == "def_ref", F.concat(F.lit("#sec-"), g("def_ref", 1), F.coalesce(F.concat(F.lit("__subsec-"), g("def_ref", 2)), F.lit(""))))
    )
    name = F.when(F.col("kind") == "subsidiary", g("subsidiary", 1)).when(F.col("kind") == "act", g("act", 1))
    return s.select(id_col, "starts_at", "ends_at", "kind", "matched", href.alias("href"), name.alias("target_name"))


def resolve_names(refs: DataFrame, citation_index: DataFrame) -> DataFrame:
    """References with the URI of the named Act; status 'resolved' or 'unresolved' (those inside an Act always count as resolved).

    A left join on the name; Spark broadcasts the index only if it measures it as small.
    """
    idx = citation_index.select(F.col("name").alias("target_name"), "frbr_uri")
    uri = F.coalesce("href", "frbr_uri")
    return refs.join(idx, "target_name", "left").withColumns({"href": uri, "status": F.when(uri.isNull(), "unresolved").otherwise("resolved")}).drop("frbr_uri")


def ranges(df: DataFrame, eids: DataFrame) -> DataFrame:
    """para_id, act_id, starts_at, matched, href_from, href_up_to, resolved, resolved_nested: 'sections 7 to 12' and the like.

    resolved: both ends are identifiers of the Act; resolved_nested: both are
    the last step of one, as identifiers of Acts with Parts are longer. eids
    has act_id and eid.
    """
    p = RANGE
    s = spans(df, [p], keep=("act_id",))
    word = F.lower(extract(F.col("matched"), p.java, 1))
    prefix = F.element_at(F.create_map(*[F.lit(x) for kv in RANGE_PREFIX.items() for x in kv]), word)
    ends = s.select(
        "para_id", "act_id", "starts_at", "matched",
        F.concat(prefix, F.lit("-"), extract(F.col("matched"), p.java, 2)).alias("a"),
        F.concat(prefix, F.lit("-"), extract(F.col("matched"), p.java, 3)).alias("z"),
    )
    # Of each last step of an identifier, whether it's an identifier itself: one row per Act and step.
    known = eids.where("eid IS NOT NULL").select("act_id", F.element_at(F.split("eid", "__"), -1).alias("end"), (~F.contains("eid", F.lit("__"))).alias("whole")).groupBy("act_id", "end").agg(F.bool_or("whole").alias("whole"))
    each = ends.select("*", F.explode(F.array_distinct(F.array("a", "z"))).alias("end"), F.size(F.array_distinct(F.array("a", "z"))).alias("n"))
    met = each.join(known, ["act_id", "end"], "left").groupBy("para_id", "act_id", "starts_at", "matched", "a", "z", "n").agg(F.count_if("whole").alias("n_whole"), F.count("whole").alias("n_in"))
    return met.select("para_id", "act_id", "starts_at", "matched", F.concat(F.lit("#"), "a").alias("href_from"), F.concat(F.lit("#"), "z").alias("href_up_to"), (F.col("n_whole") == F.col("n")).alias("resolved"), (F.col("n_in") == F.col("n")).alias("resolved_nested"))


def quantities(df: DataFrame) -> DataFrame:
    """Penalty units, terms of imprisonment and deadlines: the spans with concept."""
    return spans(df, QUANTITIES).withColumn("concept", F.concat(F.lit("/ontology/concept/au/"), "kind"))


def roles(df: DataFrame) -> DataFrame:
    """Officeholders: the spans, kind being the identifier."""
    return spans(df, ROLES)


def registry(found: DataFrame, prefix: str) -> DataFrame:
    """eid, href, show_as: each concept or role that occurs, once."""
    return found.select(F.col("kind").alias("eid"), F.concat(F.lit(prefix), "kind").alias("href"), F.col("note").alias("show_as")).distinct()


def iso_date(kind: Column, matched: Column) -> Column:
    """yyyy-mm-dd as written, without a look at the calendar; null for a commencement phrase."""
    dmy, slash = DATES[0].java, DATES[1].java
    month = F.lpad(F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]), F.lower(F.regexp_extract(matched, dmy, 2))).cast("string"), 2, "0")
    day = lambda p: F.lpad(F.regexp_extract(matched, p, 1), 2, "0")
    return F.when(kind == "dmy", F.concat_ws("-", F.regexp_extract(matched, dmy, 3), month, day(dmy))).when(
        kind == "slash", F.concat_ws("-", F.regexp_extract(matched, slash, 3), F.lpad(F.regexp_extract(matched, slash, 2), 2, "0"), day(slash))
    )


def dates(df: DataFrame) -> DataFrame:
    """Dates: the spans with iso and whether the calendar has such a day (null without iso)."""
    iso = iso_date(F.col("kind"), F.col("matched"))
    return spans(df, DATES).withColumns({"iso": iso, "is_valid": F.when(iso.isNotNull(), F.try_to_date(iso, "yyyy-MM-dd").isNotNull())})


def note_refs(df: DataFrame) -> DataFrame:
    """'[note 3]': the spans with href and marker."""
    n = F.regexp_extract("matched", NOTE_REF.java, 1)
    return spans(df, [NOTE_REF]).select("para_id", "starts_at", "ends_at", "matched", F.concat(F.lit("#note-"), n).alias("href"), n.alias("marker"))


def formatted(spans_col: str = "spans") -> Column:
    """Whether any run of the paragraph is bold, italic, raised or lowered."""
    return F.coalesce(F.exists(spans_col, lambda s: s["bold"] | s["italic"] | s["superscript"] | s["subscript"]), F.lit(False))
