"""Queries of reports, checks, samples and rendering, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from statuta.functions.patterns import all_matches, leftmost, re2, sql_leftmost, sql_matches
from statuta.operators import amendments as am
from statuta.operators import annotate as an
from statuta.operators import corpus as co
from statuta.operators import markup as mu
from statuta.operators import quality as qu
from statuta.operators import render as re_
from statuta.operators import structure as st
from statuta.operators.corpus import YEAR_AT_END
from statuta.plans import legislative as lg
from statuta.plans import structural as sn
from statuta.plans.derived import DEFINING, STREAM, derive, duck, endnotes, full
from statuta.session import settled
from statuta.sources.tables import table

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


_ST, _FMT = sn._ST, "coalesce(len(list_filter(spans, lambda x: x.bold OR x.italic OR x.superscript OR x.subscript)) > 0, false)"


def _stream(spark, d):
    return derive(spark, d, STREAM)


_N = ", ".join(f"count(*) FILTER (region = 'body' AND element_type = '{t}') AS {n}" for t, n in qu.COUNTED.items())


@query(sn._REGIONS + f"""SELECT act_id, count(DISTINCT volume_index) AS volumes_fetched, count(*) FILTER (region = 'preface') AS preface_paras, coalesce(max(schedule_no), 0)::BIGINT AS schedules_found, {_N},
 count(*) FILTER (region = 'body' AND element_type IN ('subsec', 'para', 'subpara') AND coalesce(raw_style, '') NOT IN ('Body Text', 'List Paragraph')) AS style_fallbacks, count(*) FILTER ({_FMT}) AS inline_formatted FROM g GROUP BY act_id""")
def structural_counts(spark, d):
    """Structural counters of each Act."""
    return qu.structural_counts(st.regions(_stream(spark, d)))


def _documents(spark, d):
    """The build of all Acts, from one stream with everything in it."""
    rows = settled(st.regions(settled(st.resolve_ambiguous(full(spark, d)))))
    acts = table(spark, d, "acts").dropDuplicates(["title_id"])
    # Endnotes stand under reports; here they belong to the Act of their report.
    of = table(spark, d, "parse_reports").select("report_id", F.upper(F.trim("title_id")).alias("title")).where("title <> ''").dropDuplicates(["report_id"])
    ev = am.events(am.provisions_filled(endnotes(spark, d))).withColumnRenamed("act_id", "report_id").join(of, "report_id").withColumnRenamed("title", "act_id").drop("report_id")
    return mu.documents(rows, acts, co.citation_index(table(spark, d, "corpus_index").dropDuplicates(["entry_id"])), settled(ev, "events"), "2000-01-01")


@query()
def parse_report(spark, d):
    """One report with every counter per Act; no SQL, its parts are compared in structural_counts, annotation_report and others, the whole in the tests."""
    return _documents(spark, d)["report"]


@query(sn._REGIONS + "SELECT act_id, list(text ORDER BY pos) AS schedule_names FROM g WHERE region = 'schedule' AND head GROUP BY act_id")
def schedule_names(spark, d):
    """A1: schedule_names."""
    return qu.schedule_names(st.regions(_stream(spark, d)))


_KINDS = {"quantities_found": ("qty", an.QUANTITIES), "dates_found": ("date", an.DATES), "roles_found": ("role", an.ROLES)}
_COUNTS = ", ".join(f"coalesce(sum(CASE WHEN claim = '{c}' THEN len({sql_leftmost(sql_matches('text', ps))}) END), 0)::BIGINT AS {k}" for k, (c, ps) in _KINDS.items())


@query(f"SELECT act_id, {_COUNTS} FROM ({lg._CLAIMS}) GROUP BY act_id")
def annotation_report(spark, d):
    """A1: counters of annotations, each in the paragraphs that it may mark up."""
    n = lambda ps: F.size(leftmost(all_matches(F.col("text"), ps)))
    c = lg.claims(lg._defining(spark, d))
    return c.groupBy("act_id").agg(*[F.coalesce(F.sum(F.when(F.col("claim") == k, n(ps))), F.lit(0)).cast("bigint").alias(name) for name, (k, ps) in _KINDS.items()])


_SIG = f"(SELECT a.act_id, coalesce(s.signature, '') AS signature FROM (SELECT DISTINCT act_id FROM {_ST}) a LEFT JOIN (SELECT act_id, string_agg(raw_style, '|' ORDER BY raw_style) AS signature FROM (SELECT DISTINCT act_id, raw_style FROM {_ST} WHERE raw_style IS NOT NULL AND raw_style NOT IN ('Normal', 'Body Text', 'Default')) GROUP BY act_id) s USING (act_id))"


@query(f"SELECT signature, count(*) AS n_acts, min(act_id) AS first_act FROM {_SIG} GROUP BY signature")
def style_clusters(spark, d):
    """A9, O5."""
    return qu.style_clusters(_stream(spark, d))


@query(f"""SELECT signature, act_id, para_no, style, text FROM (SELECT f.signature, r.act_id, row_number() OVER (PARTITION BY r.act_id ORDER BY r.pos) AS para_no, coalesce(raw_style, 'Default') AS style, {sn._strip('text')} AS text
 FROM {_ST} r JOIN (SELECT *, row_number() OVER (PARTITION BY signature ORDER BY act_id) AS k FROM {_SIG}) f ON f.act_id = r.act_id AND f.k <= 5 WHERE {sn._strip("coalesce(text, '')")} <> '') WHERE para_no <= 30""")
def cluster_samples(spark, d):
    """W18."""
    return qu.cluster_samples(_stream(spark, d))


_ERA = f"CASE WHEN y IS NULL THEN 'unknown' WHEN y < 1970 THEN 'pre-1970' WHEN y < 2000 THEN '1970s-90s' ELSE '2000s+' END"
_NAMED = f"(SELECT DISTINCT name, TRY_CAST(nullif(regexp_extract(name, {re2(YEAR_AT_END)}, 1), '') AS INT) AS y FROM acts)"


@query(f"""WITH s AS (SELECT name, {_ERA} AS era FROM {_NAMED}), r AS (SELECT *, row_number() OVER (PARTITION BY era ORDER BY name) - 1 AS rank, count(*) OVER (PARTITION BY era) AS total FROM s)
SELECT name, era FROM r WHERE total <= 5 OR rank IN (SELECT floor(i * (total / 5.0::DOUBLE))::BIGINT FROM range(5) t(i))""")
def stratified_sample(spark, d):
    """Five titles of each period at even strides."""
    return qu.stride_sample(table(spark, d, "acts").select("name").distinct().withColumn("era", qu.era(F.col("name"))), "era", "name", 5)


_LOG = "(SELECT report_id // 50 AS log_id, report_id * 2 + k AS line_no, CASE WHEN k = 0 THEN CASE WHEN report_id % 4 = 0 THEN 'warning' ELSE '[fetch ] ' || act_name END ELSE CASE WHEN report_id % 3 = 0 THEN '  SKIP -- DOCX download failed' ELSE '  ok' END END AS line FROM (SELECT DISTINCT report_id, act_name FROM parse_reports), range(2) t(k))"


@query(f"SELECT log_id, line_no, nullif(regexp_extract(prev, '^\\[fetch \\] (.+)$', 1), '') AS name FROM (SELECT *, lag(line) OVER (PARTITION BY log_id ORDER BY line_no) AS prev FROM {_LOG}) WHERE line = '{qu.SKIP_LINE}' AND nullif(regexp_extract(prev, '^\\[fetch \\] (.+)$', 1), '') IS NOT NULL")
def log_failures(spark, d):
    """S18."""
    r = table(spark, d, "parse_reports").select("report_id", "act_name").distinct()
    k = r.select("report_id", "act_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    line = F.when(F.col("k") == 0, F.when(F.col("report_id") % 4 == 0, "warning").otherwise(F.concat(F.lit("[fetch ] "), "act_name"))).otherwise(F.when(F.col("report_id") % 3 == 0, qu.SKIP_LINE).otherwise("  ok"))
    return qu.log_failures(k.select(F.floor(F.col("report_id") / 50).alias("log_id"), (F.col("report_id") * 2 + F.col("k")).alias("line_no"), line.alias("line")))


_TRIAL = "(SELECT DISTINCT report_id, CASE WHEN report_id % 7 = 0 THEN 'download' WHEN report_id % 11 = 0 THEN 'convert' END AS error, subsections_parsed > 0 AND report_id % 7 > 0 AS non_empty_body FROM parse_reports)"


def _trial(spark, d):
    r = table(spark, d, "parse_reports").select("report_id", "subsections_parsed").distinct()
    return r.select("report_id", F.when(F.col("report_id") % 7 == 0, "download").when(F.col("report_id") % 11 == 0, "convert").alias("error"), ((F.col("subsections_parsed") > 0) & (F.col("report_id") % 7 > 0)).alias("non_empty_body"))


@query(f"SELECT count(*) AS n, count(*) FILTER (non_empty_body) AS n_non_empty, round(count(*) FILTER (non_empty_body) / count(*), 6) AS rate, (SELECT error FROM {_TRIAL} WHERE error IS NOT NULL GROUP BY error ORDER BY count(*) DESC, error DESC LIMIT 1) AS top_error, round((SELECT max(c) FROM (SELECT count(*) AS c FROM {_TRIAL} WHERE error IS NOT NULL GROUP BY error)) / count(*), 6) AS max_error_share FROM {_TRIAL}")
def trial_summary(spark, d):
    """A10, Q6."""
    return qu.trial_summary(_trial(spark, d))


@query(f"SELECT error, count(*) AS n FROM {_TRIAL} WHERE error IS NOT NULL GROUP BY error")
def error_breakdown(spark, d):
    """O7."""
    return qu.error_breakdown(_trial(spark, d))


@query("SELECT title_id, arg_max(report_id, {'b': built_at, 'r': report_id}) AS report_id FROM parse_reports GROUP BY title_id")
def latest_reports(spark, d):
    """W20."""
    return qu.latest_reports(table(spark, d, "parse_reports"))


_ACT = "(SELECT DISTINCT ON (title_id) title_id AS act_id, * EXCLUDE (title_id) FROM acts)"
_LATEST = "(SELECT p.title_id AS act_id, any_value(volumes_fetched) AS volumes_fetched, any_value(subsections_parsed) AS subsections_parsed, any_value(dates_found) AS dates_found, any_value(amendment_events_parsed) AS amendment_events_parsed, any_value(report_id) AS report_id FROM parse_reports p JOIN (SELECT title_id, arg_max(report_id, {'b': built_at, 'r': report_id}) AS report_id FROM parse_reports GROUP BY title_id) l USING (report_id, title_id) GROUP BY p.title_id)"
_NODES = f"(SELECT act_id, element_type, eid FROM ({sn._hier(sn._ST)}))"


def _failures(spark, d):
    acts = table(spark, d, "acts").dropDuplicates(["title_id"]).withColumnRenamed("title_id", "act_id")
    p = table(spark, d, "parse_reports")
    reports = settled(p.join(qu.latest_reports(p), ["title_id", "report_id"]).withColumnRenamed("title_id", "act_id"), "reports")
    s = _stream(spark, d)
    # Dates and events are looked for in the given paragraphs and events: the derived ones leave some out.
    given = table(spark, d, "paragraphs").where("act_id IS NOT NULL").dropDuplicates(["para_id"]).withColumnRenamed("ord", "pos").select("para_id", "act_id", "pos", "element_type", "number", "heading", "text", "spans")
    dates = lg.claims(given).where("claim = 'date'").select("act_id")
    events = table(spark, d, "amendment_events").withColumnRenamed("report_id", "act_id")
    life = am.lifecycle(events).select(F.col("act_id").alias("report_id")).distinct().join(reports.select("report_id", "act_id").distinct(), "report_id")
    made = {"dates present": dates, "lifecycle present": life, "temporalData present": life}
    # The tables hold no list of Acts known to have no sections, so none is excused.
    xml = re_.metadata_xml(acts.withColumnRenamed("act_id", "title_id"), "2000-01-01").withColumnRenamed("title_id", "act_id")
    return qu.node_checks(st.hierarchy(s), acts, reports, acts.limit(0), made, st.numbered(s, "note", "note"), xml)


_GIVEN = "SELECT para_id, act_id, ord AS pos, element_type, number, heading, text, spans, raw_style FROM " + sn.ONCE_SQL + " WHERE act_id IS NOT NULL"
_DATED = f"(SELECT act_id FROM ({lg._CLAIMS.replace(duck(DEFINING), _GIVEN)}) WHERE claim = 'date')"
_LIVED = "(SELECT report_id FROM amendment_events WHERE act_number IS NOT NULL AND act_year IS NOT NULL AND report_id IS NOT NULL)"
_CHECKS = f"""(SELECT act_id, unnest(list_filter([CASE WHEN effective_date IS NULL THEN 'date' END, CASE WHEN number IS NULL THEN 'number' END, CASE WHEN coalesce(doc_type, '') <> 'act' THEN 'subtype' END, CASE WHEN coalesce(flat, 0) > 0 THEN 'subsections nested' END,
 CASE WHEN coalesce(volumes_fetched, 0) < 1 THEN 'volumes' END, CASE WHEN coalesce(subsections_parsed, 0) > 0 AND coalesce(n_subsecs, 0) = 0 THEN 'subsections present' END, CASE WHEN coalesce(n_sections, 0) = 0 THEN 'sections' END,
 CASE WHEN coalesce(dates_found, 0) > 0 AND act_id NOT IN {_DATED} THEN 'dates present' END, CASE WHEN coalesce(amendment_events_parsed, 0) > 0 AND r.report_id NOT IN {_LIVED} THEN 'lifecycle present' END,
 CASE WHEN coalesce(amendment_events_parsed, 0) > 0 AND r.report_id NOT IN {_LIVED} THEN 'temporalData present' END], lambda x: x IS NOT NULL)) AS check
FROM {_ACT} a LEFT JOIN (SELECT act_id, count(*) FILTER (element_type = 'subsec' AND NOT contains(eid, '__subsec-')) AS flat, count(*) FILTER (element_type = 'section' AND eid <> '') AS n_sections, count(*) FILTER (element_type = 'subsec') AS n_subsecs FROM {_NODES} GROUP BY act_id) n USING (act_id) LEFT JOIN {_LATEST} r USING (act_id))"""


@query(f"SELECT act_id, \"check\" FROM {_CHECKS.replace(' AS check', ' AS \"check\"')}")
def quality_checks(spark, d):
    """Failed checks of each Act. Q1's check of terms is always true in the reference and gives no row."""
    return _failures(spark, d)


@query(f"SELECT \"check\", count(*) AS n_acts FROM {_CHECKS.replace(' AS check', ' AS \"check\"')} GROUP BY \"check\"")
def quality_summary(spark, d):
    """A11, Q5."""
    return qu.check_summary(_failures(spark, d))


@query(f"SELECT DISTINCT title_id AS act_id FROM acts WHERE title_id NOT IN (SELECT act_id FROM {_ST} WHERE element_type = 'section')")
def empty_bodies(spark, d):
    """P19."""
    return qu.empty_bodies(table(spark, d, "acts").withColumnRenamed("title_id", "act_id"), _stream(spark, d))


@query(f"""SELECT title_id, len(e) = 0 AS passed, e AS errors FROM (SELECT title_id, list_filter([CASE WHEN {lg._URI} || '/eng@' || strftime(effective_date, '%Y-%m-%d') IS DISTINCT FROM '/akn/au/act/' || year || '/' || number || '/eng@' || strftime(effective_date, '%Y-%m-%d') THEN 'uri mismatch' END,
 CASE WHEN year IS NULL THEN 'no work date' END, CASE WHEN effective_date IS NULL THEN 'no expression date' END], lambda x: x IS NOT NULL) AS e FROM {lg._ACTS})""")
def validation(spark, d):
    """The URI of an Act against the one its subtype would give."""
    a = table(spark, d, "acts").dropDuplicates(["title_id"])
    stated = F.concat(F.lit("/akn/au/act/"), F.col("year").cast("string"), F.lit("/"), F.col("number").cast("string"), F.lit("/eng@"), F.date_format("effective_date", "yyyy-MM-dd"))
    return qu.validation(a.withColumn("stated", stated), "stated")


@query("SELECT count(*) AS n_rows, count(DISTINCT slug) AS n_slugs FROM (SELECT DISTINCT ON (entry_id) * FROM corpus_index)")
def export_counts(spark, d):
    """A14."""
    return table(spark, d, "corpus_index").dropDuplicates(["entry_id"]).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("slug").alias("n_slugs"))


# --- rendering --------------------------------------------------------------------------------------------------------
def _esc(x: str, quotes: bool = True) -> str:
    out = f"replace(replace(replace(coalesce({x}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"replace(replace({out}, '\"', '&#34;'), '''', '&#39;')" if quotes else out


_INLINE = f"""CASE WHEN {_FMT} THEN array_to_string(list_transform(list_filter(spans, lambda s: coalesce(s.text, '') <> ''), lambda s: CASE WHEN s.bold AND s.italic THEN '<b><i>' || {_esc('s.text')} || '</i></b>' WHEN s.bold THEN '<b>' || {_esc('s.text')} || '</b>'
 WHEN s.italic THEN '<i>' || {_esc('s.text')} || '</i>' WHEN s.superscript THEN '<sup>' || {_esc('s.text')} || '</sup>' WHEN s.subscript THEN '<sub>' || {_esc('s.text')} || '</sub>' ELSE {_esc('s.text')} END), '') ELSE {_esc('text')} END"""


@query(f"""SELECT act_id, section_pos, pos, html FROM (SELECT act_id, pos, o.pos AS section_pos, {_INLINE} AS html, up, o FROM (SELECT *, element_type IN ('chapter', 'part', 'dvs', 'subdvs', 'section') AS up,
 last_value(CASE WHEN element_type IN ('chapter', 'part', 'dvs', 'subdvs', 'section') THEN {{'pos': pos, 't': element_type}} END IGNORE NULLS) OVER (PARTITION BY act_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS o FROM {_ST}))
WHERE NOT up AND o.t = 'section' AND regexp_matches(html, {sn._WS1})""")
def html_paragraphs(spark, d):
    """Paragraphs of sections as HTML."""
    return re_.html_paragraphs(_stream(spark, d))


_TAG = "CASE element_type " + " ".join(f"WHEN '{t}' THEN '{g}'" for t, g in re_.TAGS.items()) + " END"


@query(f"SELECT h.act_id, h.pos, {_TAG.replace('element_type', 'h.element_type')} AS tag, h.eid, coalesce(parent_eid, '') AS parent_eid, coalesce(r.number, '') AS num, coalesce(r.heading, '') AS heading FROM ({sn._hier(sn._ST)}) h JOIN {_ST} r USING (para_id) WHERE depth <= 4")
def browse_nodes(spark, d):
    """T10."""
    s = _stream(spark, d)
    return re_.browse_nodes(st.hierarchy(s), s)


_LEVEL = "CASE tag " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in re_.LEVELS.items()) + " END"
_TITLED = f"(SELECT title_id AS act_id, any_value(name) AS name FROM acts GROUP BY title_id)"


@query(f"""SELECT act_id, -1::BIGINT AS ord, '<!DOCTYPE html><html><head><meta charset="utf-8"><title>' || {_esc('name')} || '</title></head><body><h1>' || {_esc('name')} || '</h1>' AS html FROM {_TITLED}
UNION ALL SELECT act_id, 4611686018427387904, '</body></html>' FROM {_TITLED}
UNION ALL SELECT act_id, pos, '<' || {_LEVEL} || ' id="' || {_esc('eid')} || '">' || {_esc("concat_ws(' ', nullif(num, ''), nullif(heading, ''))")} || '</' || {_LEVEL} || '>' FROM ({SQL['browse_nodes']}) WHERE act_id IN (SELECT act_id FROM {_TITLED})
UNION ALL SELECT act_id, pos, '<p>' || html || '</p>' FROM ({SQL['html_paragraphs']}) WHERE act_id IN (SELECT act_id FROM {_TITLED})""")
def act_pages(spark, d):
    """The page of each Act, in ordered fragments."""
    s = settled(_stream(spark, d), "stream")
    a = table(spark, d, "acts").groupBy(F.col("title_id").alias("act_id")).agg(F.any_value("name").alias("name"))
    return re_.act_pages(a, re_.browse_nodes(st.hierarchy(s), s), re_.html_paragraphs(s))


@query()
def akn_acts(spark, d):
    """Each Act as annotated XML, in ordered fragments; that they parse as one document and hold what the relations hold is tested."""
    return _documents(spark, d)["fragments"]


def _frbr(tag: str, value: str) -> str:
    return f"'<{tag} value=\"' || {_esc(value)} || '\"/>'"


_WORK, _EXPR = lg._URI, f"{lg._URI} || '/eng@' || strftime(effective_date, '%Y-%m-%d')"
_AUTHOR = "'<FRBRauthor href=\"#parliament\"/>'"


def _made(day: str) -> str:
    return f"'<FRBRdate date=\"' || {day} || '\" name=\"Generation\"/>'"


_META = " || ".join([
    "'<identification source=\"#source\"><FRBRWork>'", _frbr("FRBRthis", f"({_WORK} || '/!main')"), _frbr("FRBRuri", f"({_WORK})"), _made("year || '-01-01'"), _AUTHOR, "'<FRBRcountry value=\"au\"/>'", _frbr("FRBRsubtype", "coalesce(doc_type, 'act')"),
    _frbr("FRBRnumber", "number::VARCHAR"), _frbr("FRBRname", "translate(lower(name), ' /', '--')"), "'<FRBRprescriptive value=\"true\"/><FRBRauthoritative value=\"true\"/></FRBRWork><FRBRExpression>'", _frbr("FRBRthis", f"({_EXPR} || '/!main')"),
    _frbr("FRBRuri", f"({_EXPR})"), _made("strftime(effective_date, '%Y-%m-%d')"), _AUTHOR, "'<FRBRlanguage language=\"eng\"/></FRBRExpression><FRBRManifestation>'", _frbr("FRBRthis", f"({_EXPR} || '/!main.akn')"), _frbr("FRBRuri", f"({_EXPR} || '/!main.akn')"),
    _made("'2000-01-01'"), "'<FRBRauthor href=\"#source\"/></FRBRManifestation></identification>'",
])
_KEYWORD = f"'<keyword value=\"' || {_esc("replace(lower(k), ' ', '-')")} || '\" showAs=\"' || {_esc('k')} || '\" dictionary=\"#register\"/>'"


@query(f"SELECT title_id, {_META} || CASE WHEN len(subject_keywords) > 0 THEN '<classification source=\"#register\">' || array_to_string(list_transform(subject_keywords, lambda k: {_KEYWORD}), '') || '</classification>' ELSE '' END AS xml FROM {lg._ACTS}")
def akn_metadata(spark, d):
    """T1."""
    return re_.metadata_xml(table(spark, d, "acts").dropDuplicates(["title_id"]), "2000-01-01")


@query()
def index_page(spark, d):
    """Lines of the index page."""
    a = table(spark, d, "acts").dropDuplicates(["title_id"]).select("title_id", "name", "year", "number")
    from statuta.operators.corpus import site_paths

    return re_.act_links(a.select("title_id", "name"), site_paths(a))
