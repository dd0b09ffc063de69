"""Reports and checks over Acts, and samples for review."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.functions.text import is_blank, strip
from statuta.operators.annotate import formatted
from statuta.operators.corpus import expression_uri, year_from_name

# Styles that tell nothing about a document.
COMMON_STYLES = ["Normal", "Body Text", "Default"]
COUNTED = {"subsec": "subsections_parsed", "para": "paragraphs_parsed", "subpara": "subparagraphs_parsed", "note": "notes_found", "example": "examples_found", "penalty": "penalties_found", "level4": "level4_found", "table": "tables_found", "figure": "figures_found"}
SKIP_LINE = "  SKIP -- DOCX download failed"
FETCH_LINE = r"^\[fetch \] (.+)$"


def structural_counts(rows: DataFrame) -> DataFrame:
    """act_id and the structural counters of its parse report, in one pass. rows is the result of regions."""
    body = F.col("region") == "body"
    fallback = F.col("element_type").isin("subsec", "para", "subpara") & ~F.coalesce("raw_style", F.lit("")).isin("Body Text", "List Paragraph")
    return rows.groupBy("act_id").agg(
        F.countDistinct("volume_index").alias("volumes_fetched"),
        F.count_if(F.col("region") == "preface").alias("preface_paras"),
        F.coalesce(F.max("schedule_no"), F.lit(0)).alias("schedules_found"),
        *[F.count_if(body & (F.col("element_type") == t)).alias(n) for t, n in COUNTED.items()],
        F.count_if(body & fallback).alias("style_fallbacks"),
        F.count_if(formatted()).alias("inline_formatted"),
    )


def schedule_names(rows: DataFrame) -> DataFrame:
    """act_id, schedule_names: the texts of schedule headings in order; one short text per schedule."""
    from statuta.operators.classify import is_schedule_heading

    h = rows.where((F.col("region") == "schedule") & is_schedule_heading())
    got = h.groupBy("act_id").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("h"))
    return got.select("act_id", F.transform("h", lambda x: x["text"]).alias("schedule_names"))


def full_report(a: DataFrame, terms: DataFrame, events: DataFrame, mods: DataFrame) -> DataFrame:
    """One parse report per Act: act_id and every counter, by one aggregation over its annotated rows.

    a: the result of markup.annotated, with more (what completes a definition);
    terms: act_id, term_eid; events: act_id of amendment events; mods: the
    result of passive_mods. What other relations count comes in by a union, so
    there is no chain of joins. Acts without rows give none.
    """
    from statuta.operators.classify import is_schedule_heading
    from statuta.operators.structure import quotes, schedule_item

    body = F.col("region") == "body"
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    claim = F.col("claim")
    fallback = F.col("element_type").isin("subsec", "para", "subpara") & ~F.coalesce("raw_style", F.lit("")).isin("Body Text", "List Paragraph")
    # A * before a letter that no term explains counts where an asterisk may be marked up and the Act has terms at all.
    stars = F.when(claim.isNull() | claim.isin("ast", "qty", "date", "role"), F.regexp_count("text", F.lit(r"\*[A-Za-z]")) - F.when(claim == "ast", F.size(F.filter("marks", lambda m: (m["kind"] == "term") & F.substring(F.col("text"), m["starts_at"] + 2, F.lit(1)).rlike("[A-Za-z]")))).otherwise(0)).otherwise(0)
    counted = {
        "volumes_fetched": F.countDistinct("volume_index"), "preface_paras": n(F.col("region") == "preface"), "schedules_found": F.coalesce(F.max("schedule_no"), F.lit(0)).cast("bigint"), **{k: n(body & (F.col("element_type") == t)) for t, k in COUNTED.items()},
        "style_fallbacks": n(body & fallback), "schedule_clauses_found": n((F.col("region") == "schedule") & (schedule_item()["kind"] == "clause")), "terms_found": n(F.col("d").isNotNull()), "list_defs_found": n(F.col("l").isNotNull()),
        "refs_resolved": F.sum("refs_resolved"), "refs_unresolved": F.sum("refs_unresolved"), "range_refs_resolved": F.sum("range_resolved"), "range_refs_unresolved": F.sum("range_unresolved"), "note_refs_injected": F.sum("n_notes"),
        **{k: F.sum(F.when(claim == c, F.col("n_own")).otherwise(0)) for k, c in (("quantities_found", "qty"), ("roles_found", "role"), ("dates_found", "date"), ("asterisk_resolved", "ast"))}, "asterisk_unresolved": F.sum(stars),
        "inline_formatted": n(formatted()), "list_defs_completed": n(F.col("more").isNotNull()),
        "schedule_names": F.transform(F.array_sort(F.collect_list(F.when((F.col("region") == "schedule") & is_schedule_heading(), F.struct("pos", "text")))), lambda x: x["text"]),
    }
    base = a.groupBy("act_id").agg(*[(c if k == "schedule_names" else F.coalesce(c, F.lit(0)).cast("bigint")).alias(k) for k, c in counted.items()], F.countDistinct(F.when(F.col("d").isNotNull(), F.col("d_eid"))).alias("n_eids"))
    q = quotes(a.where(body))
    more = (
        terms.groupBy("act_id").agg(F.count(F.lit(1)).alias("v")).select("act_id", F.lit("has_terms").alias("k"), "v")
        .unionByName(events.groupBy("act_id").agg(F.count(F.lit(1)).alias("v")).select("act_id", F.lit("amendment_events_parsed").alias("k"), "v"))
        .unionByName(mods.groupBy("act_id", F.when(F.col("mod_no").isNotNull(), "mods_resolved").otherwise("mods_unresolved").alias("k")).agg(F.count(F.lit(1)).alias("v")))
        .unionByName(q.groupBy("act_id", F.when(F.col("handled"), "quoted_structures_found").otherwise("quoted_structures_unhandled").alias("k")).agg(F.count(F.lit(1)).alias("v")))
    )
    kinds = ["amendment_events_parsed", "mods_resolved", "mods_unresolved", "quoted_structures_found", "quoted_structures_unhandled", "has_terms"]
    wide = more.groupBy("act_id").agg(*[F.sum(F.when(F.col("k") == k, F.col("v"))).alias(k) for k in kinds])
    out = base.join(wide, "act_id", "left").withColumns({k: F.coalesce(k, F.lit(0)) for k in kinds})
    return out.withColumns({"duplicate_terms": F.col("terms_found") - F.col("n_eids"), "asterisk_unresolved": F.when(F.col("has_terms") > 0, F.col("asterisk_unresolved")).otherwise(0)}).drop("n_eids", "has_terms")


def style_signature(rows: DataFrame) -> DataFrame:
    """act_id, signature: the set of telling styles of each Act, sorted and joined by '|'. Styles are few per Act, so the set stays small."""
    s = rows.where(F.col("raw_style").isNotNull() & ~F.col("raw_style").isin(COMMON_STYLES)).select("act_id", "raw_style").distinct()
    sig = s.groupBy("act_id").agg(F.array_join(F.array_sort(F.collect_list("raw_style")), "|").alias("signature"))
    return rows.select("act_id").distinct().join(sig, "act_id", "left").select("act_id", F.coalesce("signature", F.lit("")).alias("signature"))


def style_clusters(rows: DataFrame) -> DataFrame:
    """signature, n_acts, first_act: groups of Acts of one signature, largest first."""
    g = style_signature(rows).groupBy("signature").agg(F.count(F.lit(1)).alias("n_acts"), F.min("act_id").alias("first_act"))
    return g.orderBy(F.desc("n_acts"), "first_act")


def cluster_samples(rows: DataFrame, acts: int = 5, paragraphs: int = 30) -> DataFrame:
    """signature, act_id, para_no, style, text: the first paragraphs that aren't blank of the first Acts of each cluster."""
    sig = style_signature(rows)
    first = sig.withColumn("n", F.row_number().over(W.partitionBy("signature").orderBy("act_id"))).where(F.col("n") <= acts).drop("n")
    live = rows.where(~is_blank(F.col("text"))).join(first, "act_id")
    n = live.withColumn("para_no", F.row_number().over(W.partitionBy("act_id").orderBy("pos"))).where(F.col("para_no") <= paragraphs)
    return n.select("signature", "act_id", "para_no", F.coalesce("raw_style", F.lit("Default")).alias("style"), strip(F.col("text")).alias("text"))


def era(name: Column) -> Column:
    """The period of a title by the year its name ends in."""
    y = year_from_name(name)
    return F.when(y.isNull(), "unknown").when(y < 1970, "pre-1970").when(y < 2000, "1970s-90s").otherwise("2000s+")


def stride_sample(df: DataFrame, stratum: str, order: str, n: int) -> DataFrame:
    """At even strides n rows of each stratum in the given order (all if there are no more): a sampling operator, the same on every run.

    Ranks are counted within beginnings of the order column and offset by
    the beginnings before, so one large stratum isn't sorted by one task.
    Rows with a null order come first.
    """
    b = df.withColumn("__b", F.substring(F.coalesce(order, F.lit("")), 1, 4))
    per = b.groupBy(stratum, "__b").agg(F.count(F.lit(1)).alias("c"))
    offsets = per.select(stratum, "__b", (F.sum("c").over(W.partitionBy(stratum).orderBy("__b").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("c")).alias("off"), F.sum("c").over(W.partitionBy(stratum)).alias("total"))
    ranked = b.withColumn("__r", F.row_number().over(W.partitionBy(stratum, "__b").orderBy(order)) - 1).join(offsets.withColumnRenamed(stratum, "__s"), F.col(stratum).eqNullSafe(F.col("__s")) & (b["__b"] == offsets["__b"])).drop(offsets["__b"])
    rank, stride = F.col("__r") + F.col("off"), F.col("total") / F.lit(n)
    i = F.ceil(rank / stride)
    hit = (F.floor(i * stride) == rank) & (i < n) | (F.floor((i - 1) * stride) == rank) & (i >= 1)
    return ranked.where((F.col("total") <= n) | hit).drop("__b", "__r", "__s", "off", "total")


def log_failures(lines: DataFrame) -> DataFrame:
    """log_id, line_no, name: fetches whose next line says that the download failed. lines: log_id, line_no, line."""
    w = W.partitionBy("log_id").orderBy("line_no")
    p = lines.withColumn("before", F.lag("line").over(w)).where(F.col("line") == SKIP_LINE)
    return p.select("log_id", "line_no", F.nullif(F.regexp_extract("before", FETCH_LINE, 1), F.lit("")).alias("name")).where("name IS NOT NULL")


def trial_summary(results: DataFrame) -> DataFrame:
    """One row: n, n_non_empty, rate, top_error, max_error_share of a conversion trial (error, non_empty_body)."""
    each = results.groupBy("error").agg(F.count(F.lit(1)).alias("k"), F.count_if("non_empty_body").alias("filled"))
    is_error = F.col("error").isNotNull()
    both = each.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), F.coalesce(F.sum("filled"), F.lit(0)).alias("n_non_empty"), F.max_by("error", F.when(is_error, F.struct("k", "error"))).alias("top_error"), F.max(F.when(is_error, F.col("k"))).alias("c"))
    return both.select("n", "n_non_empty", F.round(F.col("n_non_empty") / F.col("n"), 6).alias("rate"), "top_error", F.round(F.coalesce("c", F.lit(0)) / F.col("n"), 6).alias("max_error_share"))


def error_breakdown(results: DataFrame) -> DataFrame:
    return results.where("error IS NOT NULL").groupBy("error").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "error")


def latest_reports(reports: DataFrame) -> DataFrame:
    """title_id, report_id of the report built last (of a tie the greatest id)."""
    return reports.groupBy("title_id").agg(F.max_by("report_id", F.struct("built_at", "report_id")).alias("report_id"))


#: Counters of a parse report, and the checks that what they count is there.
CONDITIONAL = {"dates_found": ["dates present"], "amendment_events_parsed": ["lifecycle present", "temporalData present"]}


def node_checks(nodes: DataFrame, acts: DataFrame, reports: DataFrame, baseline: DataFrame, made: dict[str, DataFrame], notes: DataFrame, metadata: DataFrame) -> DataFrame:
    """act_id, check: the failed checks of each Act.

    nodes: act_id, element_type, eid; acts: act_id, effective_date, number,
    doc_type; reports: act_id, volumes_fetched, subsections_parsed and the
    counters of CONDITIONAL; baseline: act_id of Acts known to have no sections;
    made: of each check of CONDITIONAL the act_id of every element; notes:
    act_id, eid; metadata: act_id, xml.
    """
    per = nodes.groupBy("act_id").agg(
        F.count_if((F.col("element_type") == "subsec") & ~F.contains("eid", F.lit("__subsec-"))).alias("flat"),
        F.count_if((F.col("element_type") == "section") & (F.coalesce("eid", F.lit("")) != "")).alias("n_sections"),
        F.count_if(F.col("element_type") == "subsec").alias("n_subsecs"),
    )
    a = acts.select("act_id", "effective_date", "number", "doc_type").dropDuplicates(["act_id"]).join(per, "act_id", "left").join(reports.select("act_id", "volumes_fetched", "subsections_parsed", *CONDITIONAL).dropDuplicates(["act_id"]), "act_id", "left")
    marks = [d.select("act_id", F.lit(k).alias("mark")) for k, d in made.items()] + [notes.where(~F.startswith("eid", F.lit("note-"))).select("act_id", F.lit("note").alias("mark"))]
    a = a.join(reduce(DataFrame.unionByName, marks).groupBy("act_id").agg(F.collect_set("mark").alias("marks")), "act_id", "left")
    countries = F.regexp_extract_all("xml", F.lit('<FRBRcountry value="([^"]*)"'), 1)
    a = a.join(metadata.select("act_id", countries.alias("countries")).dropDuplicates(["act_id"]), "act_id", "left")
    a = a.join(baseline.select("act_id", F.lit(True).alias("known")).distinct(), "act_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    marked = lambda k: F.coalesce(F.array_contains("marks", k), F.lit(False))
    checks = {
        "date": F.col("effective_date").isNull(), "number": F.col("number").isNull(), "subtype": F.coalesce("doc_type", F.lit("")) != "act", "subsections nested": zero("flat") > 0,
        "volumes": F.coalesce("volumes_fetched", F.lit(0)) < 1, "subsections present": (zero("subsections_parsed") > 0) & (zero("n_subsecs") == 0), "sections": (zero("n_sections") == 0) & F.col("known").isNull(),
        **{k: (zero(n) > 0) & ~marked(k) for n, ks in CONDITIONAL.items() for k in ks}, "country": ~F.col("countries").eqNullSafe(F.array(F.lit("au"))), "note ids": marked("note"),
    }
    failed = F.filter(F.array(*[F.when(c, k) for k, c in checks.items()]), lambda x: x.isNotNull())
    return a.select("act_id", F.explode(failed).alias("check"))


def check_summary(failures: DataFrame) -> DataFrame:
    return failures.groupBy("check").agg(F.count(F.lit(1)).alias("n_acts"))


def empty_bodies(acts: DataFrame, nodes: DataFrame) -> DataFrame:
    """act_id of Acts without any section."""
    return acts.select("act_id").distinct().join(nodes.where("element_type = 'section'").select("act_id").distinct(), "act_id", "left_anti")


def validation(acts: DataFrame, stated: str) -> DataFrame:
    """title_id, passed, errors: whether the stated expression URI is the one the metadata gives, and both dates are there."""
    c = F.col
    uri = expression_uri(c("doc_type"), c("year"), c("number"), c("effective_date"))
    errors = F.filter(
        F.array(F.when(~uri.eqNullSafe(c(stated)), "uri mismatch"), F.when(c("year").isNull(), "no work date"), F.when(c("effective_date").isNull(), "no expression date")), lambda x: x.isNotNull()
    )
    return acts.select("title_id", (F.size(errors) == 0).alias("passed"), errors.alias("errors"))
