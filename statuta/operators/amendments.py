"""Endnotes: legislation history, amendment events, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.functions.carry import carry_last, carry_sum
from statuta.functions.patterns import java
from statuta.functions.text import strip
from statuta.session import settled

# Wordings of endnote tables. A single-digit Act number counts too.
SEGMENT = r"^([a-z]+)?\.?\s*Nos?\.?\s*(\d(?:[\d\s,]|and)*?),\s*(\d{4})"
NOT_APPLIED = r"\(amdt\s+never\s+applied"
EDITORIAL = r"\(amdt.*"
STRUCTURAL_PROVISION = r"^(Part|Division|Chapter|Subdivision)\s+"
NUM_YEAR = r"(\d+),\s*(\d{4})"
PROVISION = r"^s\.?\s*(\w[\w.]*)"
MOD_TYPES = {"am": "substitution", "ad": "insertion", "rep": "repeal", "rs": "substitution"}
HEADERS = ["provision affected", "provision\naffected"]


def endnote_section(rows: DataFrame) -> DataFrame:
    """Rows of a volume with the endnote heading they stand under (section), from the style of headings; null outside the endnotes."""
    style, text = F.col("raw_style"), strip(F.col("text"))
    got = carry_last(
        rows, ["act_id", "volume_index"], "pos",
        {"inside": F.when((style == "ENotesHeading 1") & (text == "Endnotes"), F.lit(True)), "section": F.when(style == "ENotesHeading 2", text)},
    )
    return got.withColumn("section", F.when(F.col("inside"), F.col("section"))).drop("inside")


def endnote_volume(rows: DataFrame) -> DataFrame:
    """act_id, volume_index of the last volume that has the endnotes heading."""
    hit = (F.col("raw_style") == "ENotesHeading 1") & (strip(F.col("text")) == "Endnotes")
    return rows.where(hit).groupBy("act_id").agg(F.max("volume_index").alias("volume_index"))


def num_year(raw: Column) -> tuple[Column, Column]:
    n, y = (F.regexp_extract(raw, java(NUM_YEAR), i).try_cast("int") for i in (1, 2))
    return n, y


def legislation_history(rows: DataFrame) -> DataFrame:
    """act_id, row_ord, act_name, act_number, act_year, assent_raw, commencement_raw from the cells of each row.

    Rows with fewer than two cells, blank names and header rows are left out;
    missing cells are ''; an unreadable number and year are null.
    """
    cell = lambda i: strip(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))
    n, y = num_year(cell(1))
    keep = (F.size("cells") >= 2) & (cell(0) != "") & ~F.lower(cell(0)).isin("act", "number and year")
    return rows.where(keep).select("act_id", "row_ord", cell(0).alias("act_name"), n.alias("act_number"), y.alias("act_year"), cell(2).alias("assent_raw"), cell(3).alias("commencement_raw"))


def provisions_filled(rows: DataFrame) -> DataFrame:
    """act_id, row_ord, provision, affected: an empty first cell takes the provision above; headers, structural markers and empty rows go."""
    c1, c2 = (strip(F.coalesce(F.get("cells", F.lit(i)), F.lit(""))) for i in (0, 1))
    r = rows.where(F.size("cells") >= 2).select("act_id", "row_ord", c1.alias("c1"), c2.alias("c2")).where(~F.lower("c1").isin(HEADERS))
    got = carry_last(r, ["act_id"], "row_ord", {"above": F.nullif("c1", F.lit(""))})
    return got.select("act_id", "row_ord", F.coalesce(F.nullif("c1", F.lit("")), "above").alias("provision"), F.col("c2").alias("affected")).where("provision IS NOT NULL AND affected <> ''")


def _segments(affected: Column) -> Column:
    """Of each part between semicolons: text, effect (carried from the part before, within the cell), numbers, year."""
    parts = F.filter(F.transform(F.split(affected, r"(?U);\s*"), lambda s: strip(s)), lambda s: s != "")
    p = java(SEGMENT, True)

    def one(s: Column) -> Column:
        clean = strip(F.regexp_replace(s, java(EDITORIAL, True), ""))
        ok = clean.rlike(p)
        return F.struct(
            s.alias("segment"), F.when(ok, F.nullif(F.lower(F.regexp_extract(clean, p, 1)), F.lit(""))).alias("effect"),
            F.when(ok, F.regexp_extract_all(F.regexp_extract(clean, p, 2), F.lit(r"(\d+)"), 1)).alias("nums"), F.when(ok, F.regexp_extract(clean, p, 3).cast("int")).alias("year"),
        )

    read = F.transform(parts, one)
    return F.transform(
        read,
        lambda x, i: F.struct(
            x["segment"].alias("segment"), x["nums"].alias("nums"), x["year"].alias("year"),
            F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.transform(F.filter(F.slice(read, F.lit(1), i + 1), lambda y: y["effect"].isNotNull()), lambda y: y["effect"])), -1).alias("effect"),
        ),
    )


def events(filled: DataFrame) -> DataFrame:
    """act_id, row_ord, seg_no, num_no, provision, effect, act_number, act_year, applied, raw_text: one row per amending Act."""
    seg = filled.select("act_id", "row_ord", "provision", "affected", F.posexplode(_segments(F.col("affected"))).alias("seg_no", "s")).where("s.nums IS NOT NULL AND s.effect IS NOT NULL")
    applied = ~F.col("affected").rlike(java(NOT_APPLIED, True))
    return seg.select("act_id", "row_ord", "seg_no", F.posexplode("s.nums").alias("num_no", "n"), "provision", F.col("s.effect").alias("effect"), "s.year", applied.alias("applied"), F.col("affected").alias("raw_text")).select(
        "act_id", "row_ord", "seg_no", "num_no", "provision", "effect", F.col("n").try_cast("int").alias("act_number"), F.col("year").alias("act_year"), "applied", "raw_text"
    )


def parse_errors(filled: DataFrame) -> DataFrame:
    """act_id, row_ord, provision, segment, error: parts that no event comes from."""
    seg = filled.select("act_id", "row_ord", "provision", F.explode(_segments(F.col("affected"))).alias("s"))
    error = F.when(F.col("s.nums").isNull(), "unmatched").when(F.col("s.effect").isNull(), "no effect")
    return seg.select("act_id", "row_ord", "provision", "s.segment", error.alias("error")).where("error IS NOT NULL")


def lifecycle(evs: DataFrame) -> DataFrame:
    """act_id, event_eid, source, act_number, act_year: one event per amending Act, numbered by year and number. Null numbers and years don't count.

    The numbering runs over distinct amending Acts only, so an Act with very many events still has a short window.
    """
    d = evs.select("act_id", "act_number", "act_year").dropna().distinct()
    n = F.row_number().over(W.partitionBy("act_id").orderBy("act_year", "act_number"))
    return d.select("act_id", F.concat(F.lit("evt-amd-"), n.cast("string")).alias("event_eid"), F.concat_ws("/", F.lit("/akn/au/act"), F.col("act_year").cast("string"), F.col("act_number").cast("string")).alias("source"), "act_number", "act_year")


def passive_mods(evs: DataFrame, known: DataFrame, order: list[str]) -> DataFrame:
    """act_id, mod_no, mod_type, event_eid, dest_eid, provision of applied events, in the order of the given columns.

    mod_no counts resolved ones and is null for others. A provision 's 6' goes
    to sec-6, else to the least identifier that differs by case only. known has
    act_id and eid.
    """
    cand = F.concat(F.lit("sec-"), F.nullif(F.regexp_extract("provision", java(PROVISION, True), 1), F.lit("")))
    k = known.select("act_id", "eid").dropna().distinct()
    low = k.groupBy("act_id", F.lower("eid").alias("low")).agg(F.min("eid").alias("low_eid"))
    evs = settled(evs, "events")  # read by the events and by the lifecycle
    e = evs.where("applied").withColumn("cand", cand)
    e = e.join(k.select("act_id", F.col("eid").alias("cand"), F.col("eid").alias("exact")), ["act_id", "cand"], "left")
    e = e.withColumn("low", F.lower("cand")).join(low, ["act_id", "low"], "left")
    e = e.join(lifecycle(evs).select("act_id", "act_number", "act_year", "event_eid"), ["act_id", "act_number", "act_year"], "left").withColumn("dest_eid", F.coalesce("exact", "low_eid"))
    ok = F.col("dest_eid").isNotNull() & F.col("event_eid").isNotNull()
    # Rows of one Act are numbered by an order column of their own first; hot Acts are then counted in blocks.
    assert len(order) == 1, "one column gives the order"
    n = carry_sum(settled(e, "mods"), ["act_id"], order[0], {"n": ok.cast("int")})
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in MOD_TYPES.items() for x in kv]), F.col("effect")), F.lit("amendment"))
    return n.select("act_id", *order, F.when(ok, F.col("n")).alias("mod_no"), kind.alias("mod_type"), "event_eid", "dest_eid", "provision")
