"""Classification of paragraphs into provisions, by style and wording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions.carry import carry, carry_last
from statuta.functions.patterns import java
from statuta.functions.text import strip
from statuta.session import settled

# The wordings that make a paragraph a heading, a provision or an annotation.
HEADING = "^(Chapter|Part|Division|Subdivision)\xa0([^—]+?)(?:—(.*))?$"
LEGACY_HEADING = "^(Chapter|Part|Division|Subdivision)[\xa0 ]([^—]+?)(?:—(.*))?$"
SECTION = r"^(\w[\w.\-]*)[ \t]{2,}(.+)$"
SUBSECTION = r"^\((\d+[A-Z]?)\)\s+(.*)"
PARAGRAPH = r"^\(([a-z]+)\)\s+(.*)"
SUBPARAGRAPH = r"^\(([ivxlcdm]+)\)\s+(.*)"
LEVEL4 = r"^\(([A-Z]+)\)\s+(.*)"
LEGACY_FUSED = r"^(\w[\w.\-]*)\.\s+\((\d+[A-Z]?)\)\s+(.+)$"
LEGACY_NUMBERED = r"^(\d+[A-Z]*)\.[ \t]+(.+)$"
NOTE, EXAMPLE, PENALTY = "^Notes?[\xa0: ]", "^Examples?[\xa0: ]", "^Penalty[\xa0: ]"
SCHEDULE_HEADING = "^Schedule[\xa0 ](\\d+|[IVX]+)"
LEGACY_SECTION_STYLE = "heading 5"
# Element types with the value in identifiers, the start of identifiers and the depth (null: no level of the hierarchy).
ELEMENT_TYPES = [
    ("chapter", "chapter", 0), ("part", "part", 1), ("dvs", "dvs", 2), ("subdvs", "subdvs", 3), ("section", "sec", 4), ("subsec", "subsec", 5),
    ("para", "para", 6), ("subpara", "subpara", 7), ("level4", "level4", 8), ("note", "note", None), ("example", "example", None),
    ("penalty", "penalty", None), ("list-item", "list-item", None), ("table", "table", None), ("figure", "figure", None), ("body", "body", None), ("skip", "skip", None),
]
PREFIX_TYPES = {"Chapter": "chapter", "Part": "part", "Division": "dvs", "Subdivision": "subdvs"}
STRUCTURAL = ["chapter", "part", "dvs", "subdvs", "section"]


def element_types(spark) -> DataFrame:
    """The lookup table type, eid_prefix, depth."""
    return spark.createDataFrame(ELEMENT_TYPES, "type STRING, eid_prefix STRING, depth INT")


def _made(kind: str | Column, number: Column | str = "", heading: Column | str = "", text: Column | str = "") -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(kind).alias("element_type"), lit(number).alias("number"), lit(heading).alias("heading"), lit(text).alias("text"))


def _g(c: Column, pattern: str, n: int, i: bool = False) -> Column:
    return strip(F.regexp_extract(c, java(pattern, i, True), n))


def _is(c: Column, pattern: str, i: bool = False, dot_all: bool = True) -> Column:
    return c.rlike(java(pattern, i, dot_all))


def _typed(prefix: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in PREFIX_TYPES.items() for x in kv]), prefix)


def annotation(style: Column, stripped: Column) -> Column:
    """note, example or penalty by style or wording, in this order; else null."""
    return (
        F.when((style == "Note") | _is(stripped, NOTE, True), "note").when((style == "Example") | _is(stripped, EXAMPLE, True), "example")
        .when((style == "Penalty") | _is(stripped, PENALTY, True), "penalty")
    )


def classified(style: Column, text: Column) -> Column:
    """(element_type, number, heading, text) of a paragraph with a style. A null style counts as none, a null or blank text as skip."""
    style, s = F.coalesce(style, F.lit("")), strip(F.coalesce(text, F.lit("")))
    act_head = style.startswith("ActHead")
    found = lambda kind, p: _made(kind, F.regexp_extract(s, java(p, dot_all=True), 1), "", _g(s, p, 2))
    note = annotation(style, s)
    listed = style == "List Paragraph"
    other = ~style.isin("Body Text", "List Paragraph")
    return (
        F.when(s == "", _made("skip"))
        .when(act_head & _is(s, HEADING, dot_all=False), _made(_typed(F.regexp_extract(s, java(HEADING), 1)), _g(s, HEADING, 2), _g(s, HEADING, 3)))
        .when(act_head & _is(s, SECTION, dot_all=False), _made("section", F.regexp_extract(s, java(SECTION), 1), _g(s, SECTION, 2)))
        .when(~act_head & note.isNotNull(), _made(note, "", "", s))
        .when((style == "Body Text") & _is(s, SUBSECTION), found("subsec", SUBSECTION))
        .when(listed & _is(s, SUBPARAGRAPH), found("subpara", SUBPARAGRAPH))
        .when(listed & _is(s, PARAGRAPH), found("para", PARAGRAPH))
        .when(listed & _is(s, LEVEL4), found("level4", LEVEL4))
        .when(other & _is(s, SUBSECTION), found("subsec", SUBSECTION))
        .when(other & _is(s, PARAGRAPH), found("para", PARAGRAPH))
        .otherwise(_made("body", "", "", s))
    )


def style_name(style: Column) -> Column:
    """The part of a style's name before the first comma, stripped, in lower case."""
    return F.lower(strip(F.element_at(F.split(F.coalesce(style, F.lit("")), ","), 1)))


def legacy_parts(style: Column, text: Column) -> Column:
    """One or two (element_type, number, heading, text) of a paragraph without usable styles: '1. (1) text' is a section and a subsection."""
    s = strip(F.coalesce(text, F.lit("")))
    note = annotation(F.lit(""), s)
    return (
        F.when(s == "", F.array(_made("skip")))
        .when(_is(s, LEGACY_HEADING, True, False), F.array(_made(_typed(F.initcap(F.regexp_extract(s, java(LEGACY_HEADING, True), 1))), _g(s, LEGACY_HEADING, 2, True), _g(s, LEGACY_HEADING, 3, True))))
        .when((style_name(style) == LEGACY_SECTION_STYLE) & _is(s, SECTION, dot_all=False), F.array(_made("section", F.regexp_extract(s, java(SECTION), 1), _g(s, SECTION, 2))))
        .when(_is(s, LEGACY_FUSED), F.array(_made("section", F.regexp_extract(s, java(LEGACY_FUSED, dot_all=True), 1)), _made("subsec", F.regexp_extract(s, java(LEGACY_FUSED, dot_all=True), 2), "", _g(s, LEGACY_FUSED, 3))))
        .when(_is(s, SUBSECTION), F.array(_made("subsec", F.regexp_extract(s, java(SUBSECTION, dot_all=True), 1), "", _g(s, SUBSECTION, 2))))
        .when(note.isNotNull(), F.array(_made(note, "", "", s)))
        .otherwise(F.array(_made("body", "", "", s)))
    )


def all_bold(spans: Column) -> Column:
    """At least one run that isn't blank, and all such bold."""
    seen = F.filter(spans, lambda s: F.coalesce(s["text"].rlike(r"(?U)\S"), F.lit(False)))
    return F.coalesce((F.size(seen) > 0) & F.forall(seen, lambda s: F.coalesce(s["bold"], F.lit(False))), F.lit(False))


def classify(raw: DataFrame) -> DataFrame:
    """para_id, act_id, volume_index, ord, raw_style and the classification of styled paragraphs. No shuffle."""
    return raw.select("para_id", "act_id", "volume_index", "ord", "raw_style", classified(F.col("raw_style"), F.col("text")).alias("c")).select("para_id", "act_id", "volume_index", "ord", "raw_style", "c.*")


def legacy_documents(raw: DataFrame) -> DataFrame:
    """act_id, volume_index, is_legacy: volumes none of whose styles begins with ActHead. Images don't count (has_image, if there is such a column)."""
    rows = raw.where(~F.coalesce("has_image", F.lit(False))) if "has_image" in raw.columns else raw
    return rows.groupBy("act_id", "volume_index").agg((~F.coalesce(F.bool_or(F.col("raw_style").startswith("ActHead")), F.lit(False))).alias("is_legacy"))


def classify_legacy(raw: DataFrame) -> DataFrame:
    """act_id, volume_index, ord, part_no, element_type, number, heading, text of paragraphs without usable styles; raw has all_bold.

    A bold paragraph before '1. text' is that section's heading (a donor) and
    gives no row; the next one then is the section with this heading, and its
    body. A paragraph so used can't be a donor itself: within a run of possible
    donors every second one is. Runs are short in practice but may be any
    length; they are told by position, not collected.
    """
    rows = raw.select("para_id", "act_id", "volume_index", "ord", "raw_style", "text", "all_bold").withColumn("s", strip(F.coalesce("text", F.lit(""))))
    keys = ["act_id", "volume_index"]
    # What comes after a row is what came before it the other way round.
    ahead = carry_last(rows.withColumn("back", -F.col("ord")), keys, "back", {"next": F.col("s")}).drop("back")
    could = (
        F.col("all_bold") & (F.col("s") != "") & F.coalesce(_is(F.col("next"), LEGACY_NUMBERED), F.lit(False)) & ~_is(F.col("s"), LEGACY_HEADING, True, False)
        & ~_is(F.col("s"), LEGACY_FUSED) & ~F.coalesce(_is(F.col("next"), LEGACY_FUSED), F.lit(False))
    )
    marked = settled(ahead.withColumn("could", F.coalesce(could, F.lit(False))).drop("next"), "candidates")
    # In a run of candidates the first, third, ... are donors: count candidates since the last row that isn't one.
    based = carry(marked, keys, "ord", sums={"n_could": F.col("could").cast("int")}, marks={"base": (~F.col("could"), "n_could")})
    donors = settled(based.withColumn("donor", F.col("could") & ((F.col("n_could") - F.coalesce("base", F.lit(0))) % 2 == 1)).drop("n_could", "base", "could"), "donors")
    before = carry_last(donors, keys, "ord", {"prev": F.struct(F.col("donor").alias("d"), F.col("s").alias("s"))})
    used = F.coalesce(F.col("prev.d"), F.lit(False))
    s = F.col("s")
    merged = F.array(_made("section", F.regexp_extract(s, java(LEGACY_NUMBERED, dot_all=True), 1), F.col("prev.s")), _made("body", "", "", _g(s, LEGACY_NUMBERED, 2)))
    parts = F.when(F.col("donor"), F.slice(F.array(_made("skip")), 1, 0)).when(used, merged).otherwise(legacy_parts(F.col("raw_style"), F.col("text")))
    return before.select("para_id", *keys, "ord", F.posexplode(parts).alias("part_no", "c")).select("para_id", *keys, "ord", "part_no", "c.*")


def is_schedule_heading() -> Column:
    """A body row with an ActHead style that begins 'Schedule N'."""
    return F.coalesce((F.col("element_type") == "body") & F.col("raw_style").startswith("ActHead") & _is(F.col("text"), SCHEDULE_HEADING, True), F.lit(False))


def list_level(element_type: Column, level: Column) -> Column:
    """Body rows with a list level are list items."""
    return F.when((element_type == "body") & level.isNotNull(), "list-item").otherwise(element_type)
