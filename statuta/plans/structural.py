"""Queries of classification, structure and annotation, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from statuta.functions.patterns import re2, sql_leftmost, sql_matches
from statuta.operators import annotate as an
from statuta.operators import classify as cl
from statuta.operators import structure as st
from statuta.session import settled
from statuta.plans.derived import ONCE_SQL, RAW, REFERRING_SQL, STREAM, derive, duck, once, referring

Q: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        Q[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


# --- classification -------------------------------------------------------------------------------------------------
_STRIP = re2(r"^\s+|\s+$")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_STRIP}, '', 'g')"


def _x(p: str, n: int, i: bool = False, s: bool = True, of: str = "s") -> str:
    return _strip(f"regexp_extract({of}, {re2(p, i, s)}, {n})")


def _m(p: str, i: bool = False, s: bool = True, of: str = "s") -> str:
    return f"regexp_matches({of}, {re2(p, i, s)})"


_PREFIX = "CASE lower({}) WHEN 'chapter' THEN 'chapter' WHEN 'part' THEN 'part' WHEN 'division' THEN 'dvs' ELSE 'subdvs' END"
_NOTE = f"CASE WHEN style = 'Note' OR {_m(cl.NOTE, True)} THEN 'note' WHEN style = 'Example' OR {_m(cl.EXAMPLE, True)} THEN 'example' WHEN style = 'Penalty' OR {_m(cl.PENALTY, True)} THEN 'penalty' END"


def _t(kind: str, n: str = "''", h: str = "''", t: str = "''") -> str:
    return f"{{'element_type': {kind}, 'number': {n}, 'heading': {h}, 'text': {t}}}"


_CLASSIFIED = f"""CASE WHEN s = '' THEN {_t("'skip'")}
 WHEN starts_with(style, 'ActHead') AND {_m(cl.HEADING, s=False)} THEN {_t(_PREFIX.format(_x(cl.HEADING, 1, s=False)), _x(cl.HEADING, 2, s=False), _x(cl.HEADING, 3, s=False))}
 WHEN starts_with(style, 'ActHead') AND {_m(cl.SECTION, s=False)} THEN {_t("'section'", _x(cl.SECTION, 1, s=False), _x(cl.SECTION, 2, s=False))}
 WHEN NOT starts_with(style, 'ActHead') AND ({_NOTE}) IS NOT NULL THEN {_t(_NOTE, t="s")}
 WHEN style = 'Body Text' AND {_m(cl.SUBSECTION)} THEN {_t("'subsec'", _x(cl.SUBSECTION, 1), t=_x(cl.SUBSECTION, 2))}
 WHEN style = 'List Paragraph' AND {_m(cl.SUBPARAGRAPH)} THEN {_t("'subpara'", _x(cl.SUBPARAGRAPH, 1), t=_x(cl.SUBPARAGRAPH, 2))}
 WHEN style = 'List Paragraph' AND {_m(cl.PARAGRAPH)} THEN {_t("'para'", _x(cl.PARAGRAPH, 1), t=_x(cl.PARAGRAPH, 2))}
 WHEN style = 'List Paragraph' AND {_m(cl.LEVEL4)} THEN {_t("'level4'", _x(cl.LEVEL4, 1), t=_x(cl.LEVEL4, 2))}
 WHEN style NOT IN ('Body Text', 'List Paragraph') AND {_m(cl.SUBSECTION)} THEN {_t("'subsec'", _x(cl.SUBSECTION, 1), t=_x(cl.SUBSECTION, 2))}
 WHEN style NOT IN ('Body Text', 'List Paragraph') AND {_m(cl.PARAGRAPH)} THEN {_t("'para'", _x(cl.PARAGRAPH, 1), t=_x(cl.PARAGRAPH, 2))}
 ELSE {_t("'body'", t="s")} END"""
_RAW_S = f"(SELECT *, coalesce(raw_style, '') AS style, {_strip('coalesce(text, chr(32))')} AS s FROM ({duck(RAW)}))"


@query(f"SELECT para_id, c.element_type AS element_type, c.number AS number, c.heading AS heading, c.text AS text FROM (SELECT para_id, {_CLASSIFIED} AS c FROM {_RAW_S})")
def classify_paragraphs(spark, d):
    """Styled paragraphs."""
    return cl.classify(derive(spark, d, RAW)).select("para_id", "element_type", "number", "heading", "text")


_PARTS = f"""CASE WHEN s = '' THEN [{_t("'skip'")}]
 WHEN {_m(cl.LEGACY_HEADING, True, False)} THEN [{_t(_PREFIX.format(_x(cl.LEGACY_HEADING, 1, True, False)), _x(cl.LEGACY_HEADING, 2, True, False), _x(cl.LEGACY_HEADING, 3, True, False))}]
 WHEN lower({_strip("string_split(style, ',')[1]")}) = 'heading 5' AND {_m(cl.SECTION, s=False)} THEN [{_t("'section'", _x(cl.SECTION, 1, s=False), _x(cl.SECTION, 2, s=False))}]
 WHEN {_m(cl.LEGACY_FUSED)} THEN [{_t("'section'", _x(cl.LEGACY_FUSED, 1))}, {_t("'subsec'", _x(cl.LEGACY_FUSED, 2), t=_x(cl.LEGACY_FUSED, 3))}]
 WHEN {_m(cl.SUBSECTION)} THEN [{_t("'subsec'", _x(cl.SUBSECTION, 1), t=_x(cl.SUBSECTION, 2))}]
 WHEN ({_NOTE.replace("style", "''")}) IS NOT NULL THEN [{_t(_NOTE.replace("style", "''"), t="s")}]
 ELSE [{_t("'body'", t="s")}] END"""
_LEGACY = f"""
WITH r AS (SELECT *, lead(s) OVER w AS nxt FROM {_RAW_S} WINDOW w AS (PARTITION BY act_id, volume_index ORDER BY ord)),
c AS (SELECT *, coalesce(all_bold, false) AND s <> '' AND coalesce({_m(cl.LEGACY_NUMBERED, of="nxt")}, false) AND NOT {_m(cl.LEGACY_HEADING, True, False)} AND NOT {_m(cl.LEGACY_FUSED)} AND NOT coalesce({_m(cl.LEGACY_FUSED, of="nxt")}, false) AS could FROM r),
n AS (SELECT *, sum(CASE WHEN could THEN 0 ELSE 1 END) OVER (PARTITION BY act_id, volume_index ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run FROM c),
k AS (SELECT *, could AND (count(*) FILTER (could) OVER (PARTITION BY act_id, volume_index, run ORDER BY ord ROWS UNBOUNDED PRECEDING)) % 2 = 1 AS donor FROM n),
u AS (SELECT *, coalesce(lag(donor) OVER w, false) AS used, lag(s) OVER w AS prev FROM k WINDOW w AS (PARTITION BY act_id, volume_index ORDER BY ord)),
p AS (SELECT para_id, CASE WHEN donor THEN [] WHEN used THEN [{_t("'section'", _x(cl.LEGACY_NUMBERED, 1), "prev")}, {_t("'body'", t=_x(cl.LEGACY_NUMBERED, 2))}] ELSE {_PARTS} END AS parts FROM u)
SELECT para_id, i - 1 AS part_no, parts[i].element_type AS element_type, parts[i].number AS number, parts[i].heading AS heading, parts[i].text AS text
FROM (SELECT para_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM p)"""


@query(_LEGACY)
def classify_legacy(spark, d):
    """Paragraphs without usable styles."""
    return cl.classify_legacy(derive(spark, d, RAW)).select("para_id", "part_no", "element_type", "number", "heading", "text")


@query(f"SELECT act_id, volume_index, NOT coalesce(bool_or(starts_with(raw_style, 'ActHead')), false) AS is_legacy FROM ({duck(RAW)}) GROUP BY ALL")
def legacy_documents(spark, d):
    """P3."""
    return cl.legacy_documents(derive(spark, d, RAW))


_WS1 = re2(r"\S").replace(r"\S", r"[^\s\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


@query(f"SELECT para_id, coalesce(len(v) > 0 AND len(list_filter(v, lambda x: NOT coalesce(x.bold, false))) = 0, false) AS all_bold FROM (SELECT para_id, list_filter(spans, lambda x: regexp_matches(x.text, {_WS1})) AS v FROM {ONCE_SQL})")
def all_bold(spark, d):
    """P7."""
    return once(spark, d).select("para_id", cl.all_bold(F.col("spans")).alias("all_bold"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{p}', {d if d is not None else 'NULL'})" for t, p, d in cl.ELEMENT_TYPES) + ") t(type, eid_prefix, depth)")
def element_types(spark, d):
    """The lookup table of element types."""
    return cl.element_types(spark)


# --- structure --------------------------------------------------------------------------------------------------------
_ST = f"({duck(STREAM)})"
_DEPTH = "CASE element_type " + " ".join(f"WHEN '{t}' THEN {n}" for t, n in st.DEPTH.items()) + " END"
_STEP = "CASE element_type " + " ".join(f"WHEN '{t}' THEN '{p}'" for t, p in st.PREFIX.items()) + " ELSE element_type END || '-' || CASE WHEN element_type = 'level4' THEN lower(number) ELSE number END"


def _hier(src: str, key: str = "act_id") -> str:
    """Ancestors level by level: the last row of the level before, unless a higher one came after it."""
    lasts = ", ".join(f"last_value(CASE WHEN depth = {k} THEN pos END IGNORE NULLS) OVER w AS p{k}, last_value(CASE WHEN depth = {k} THEN step END IGNORE NULLS) OVER w AS s{k}" for k in range(8))
    steps = ", ".join(f"CASE WHEN depth > {k} AND p{k} > greatest({', '.join(['-1', *[f'coalesce(p{j}, -1)' for j in range(k)]])}) THEN s{k} END" for k in range(8))
    return f"""SELECT {key}, para_id, pos, element_type, depth, concat_ws('__', parent_eid, step) AS eid, parent_eid FROM (
  SELECT *, nullif(concat_ws('__', {steps}), '') AS parent_eid FROM (
    SELECT *, {lasts} FROM (SELECT *, {_STEP} AS step, {_DEPTH} AS depth FROM (SELECT * REPLACE (coalesce(number, '') AS number) FROM {src})) WHERE depth IS NOT NULL
    WINDOW w AS (PARTITION BY {key} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"""


@query(_hier(_ST))
def hierarchy_eids(spark, d):
    """Identifiers from the hierarchy."""
    return st.hierarchy(derive(spark, d, STREAM))


_HEAD = f"coalesce(element_type = 'body' AND starts_with(raw_style, 'ActHead') AND {_m(cl.SCHEDULE_HEADING, True, of='text')}, false)"
_STRUCT = ", ".join(f"'{t}'" for t in cl.STRUCTURAL)
_REGIONS = f"""WITH RECURSIVE r AS (SELECT *, {_HEAD} AS head FROM {_ST}),
v AS (SELECT act_id, volume_index, row_number() OVER (PARTITION BY act_id ORDER BY volume_index) AS n, min(pos) AS first, coalesce(min(CASE WHEN element_type IN ({_STRUCT}) THEN pos END), 4611686018427387904) AS structural,
  coalesce(min(CASE WHEN head THEN pos END), 4611686018427387904) AS schedule FROM r GROUP BY act_id, volume_index),
f(act_id, n, volume_index, body_from, schedule_from, seen, inside) AS (
  SELECT act_id, n, volume_index, least(structural, schedule), schedule, least(structural, schedule) < schedule, schedule < 4611686018427387904 FROM v WHERE n = 1
  UNION ALL
  SELECT v.act_id, v.n, v.volume_index, v.first, CASE WHEN f.inside AND f.seen THEN v.first ELSE v.schedule END, f.seen OR (v.first < v.schedule AND NOT (f.inside AND f.seen)), (f.inside AND f.seen) OR v.schedule < 4611686018427387904
  FROM f JOIN v ON v.act_id = f.act_id AND v.n = f.n + 1),
t AS (SELECT r.*, CASE WHEN pos < body_from THEN 'preface' WHEN pos < schedule_from THEN 'body' ELSE 'schedule' END AS region FROM r JOIN f USING (act_id, volume_index)),
g AS (SELECT *, CASE WHEN region = 'schedule' THEN greatest(1, sum(CASE WHEN region = 'schedule' AND head THEN 1 ELSE 0 END) OVER (PARTITION BY act_id ORDER BY pos ROWS UNBOUNDED PRECEDING)) END AS schedule_no FROM t)
"""


def _regions(spark, d):
    return st.regions(derive(spark, d, STREAM))


@query(_REGIONS + "SELECT para_id, region, schedule_no FROM g")
def split_regions(spark, d):
    """Preface, body and schedules across volumes."""
    return _regions(spark, d).select("para_id", "region", "schedule_no")


_MARKS = ", ".join("'" + q.replace("'", "''") + "'" for q in st.QUOTE_MARKS)
_QS = ", ".join(f"'{t}'" for t in st.QUOTED_STRUCTURAL)


@query(f"""WITH m AS (SELECT act_id, pos, element_type, coalesce(element_type = 'body' AND {_strip('text')} IN ({_MARKS}), false) AS mark FROM {_ST}),
c AS (SELECT *, sum(mark::INT) OVER (PARTITION BY act_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS c, sum(mark::INT) OVER (PARTITION BY act_id) AS total FROM m),
i AS (SELECT act_id, ((c + 1) // 2)::BIGINT AS quote_no, mark, CASE WHEN element_type IN ({_QS}) THEN {_DEPTH} END AS depth FROM c WHERE c % 2 = 1 AND c < total),
x AS (SELECT *, min(depth) OVER (PARTITION BY act_id, quote_no) AS top FROM i)
SELECT act_id, quote_no, count(*) FILTER (NOT mark) AS n_rows, count(*) FILTER (depth = top) AS n_top, count(*) FILTER (depth = top) = 1 AS handled FROM x GROUP BY act_id, quote_no""")
def quoted_structures(spark, d):
    """Quoted spans and whether they hold one provision."""
    return st.quotes(derive(spark, d, STREAM))


_OWN = ", ".join(f"'{t}'" for t in st.DEPTH)


@query(f"""WITH a AS (SELECT *, element_type = 'list-item' AS item, lag(element_type) OVER w = 'list-item' AND lag(number) OVER w IS NOT DISTINCT FROM number AS same, sum(CASE WHEN element_type IN ({_OWN}) THEN 1 ELSE 0 END) OVER w AS owner
  FROM {_ST} WINDOW w AS (PARTITION BY act_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT *, sum(CASE WHEN item AND NOT coalesce(same, false) THEN 1 ELSE 0 END) OVER (PARTITION BY act_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS lists FROM a)
SELECT act_id, para_id, pos, dense_rank() OVER (PARTITION BY act_id, owner ORDER BY lists) AS list_no, row_number() OVER (PARTITION BY act_id, lists ORDER BY pos) AS item_no,
  CASE WHEN {_m(st.LIST_NUMBER, of="text")} THEN regexp_extract(text, {re2(st.LIST_NUMBER, dot_all=True)}, 1) END AS num,
  CASE WHEN {_m(st.LIST_NUMBER, of="text")} THEN regexp_extract(text, {re2(st.LIST_NUMBER, dot_all=True)}, 2) ELSE coalesce(text, '') END AS text FROM b WHERE item""")
def block_lists(spark, d):
    """W6, F31, P8."""
    return st.block_lists(derive(spark, d, STREAM))


@query(f"""SELECT act_id, para_id, pos, content_no FROM (SELECT *, sum(CASE WHEN element_type IN ('body', 'note', 'example', 'penalty') THEN 0 ELSE 1 END) OVER (PARTITION BY act_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS content_no FROM {_ST}) WHERE element_type = 'body'""")
def content_groups(spark, d):
    """W7."""
    return st.content_groups(derive(spark, d, STREAM))


def _numbered(t: str) -> str:
    return f"SELECT act_id, para_id, pos, '{t}-' || row_number() OVER (PARTITION BY act_id ORDER BY pos) AS eid FROM {_ST} WHERE element_type = '{t}'"


@query(_numbered("note"))
def note_numbers(spark, d):
    """W9."""
    return st.numbered(derive(spark, d, STREAM), "note", "note")


@query(_numbered("figure"))
def figure_numbers(spark, d):
    """W10."""
    return st.numbered(derive(spark, d, STREAM), "figure", "figure")


@query(f"""SELECT para_id, CASE WHEN element_type = 'para' AND regexp_matches(lower(coalesce(number, '')), '^[ivxlcdm]*$') AND open_type = 'para' AND open_text = '' THEN 'subpara' ELSE element_type END AS element_type
FROM (SELECT *, last_value(CASE WHEN element_type IN ({_OWN}) THEN element_type END IGNORE NULLS) OVER w AS open_type, last_value(CASE WHEN element_type IN ({_OWN}) THEN coalesce(text, '') END IGNORE NULLS) OVER w AS open_text
 FROM {_ST} WINDOW w AS (PARTITION BY act_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
def para_ambiguity(spark, d):
    """W5."""
    return st.resolve_ambiguous(derive(spark, d, STREAM)).select("para_id", "element_type")


@query(_REGIONS + f"""SELECT act_id, schedule_no, count(*) AS n_clauses FROM (SELECT *, {_strip("coalesce(text, '')")} AS s FROM g) WHERE region = 'schedule' AND NOT head
 AND ((element_type = 'body' AND ({_m(st.APP_CLAUSE)} OR (NOT {_m(st.SUBCLAUSE)} AND {_m(st.CLAUSE)}))) OR (element_type = 'section' AND number <> '' AND NOT contains(number, '.'))) GROUP BY act_id, schedule_no""")
def schedule_clause_counts(spark, d):
    """A3."""
    return st.schedule_items(settled(_regions(spark, d), "regions")).where("kind = 'clause'").groupBy("act_id", "schedule_no").agg(F.count(F.lit(1)).alias("n_clauses"))


_SI = f"""i0 AS (SELECT act_id, schedule_no, para_id, pos, number AS num0, nullif(heading, '') AS h0, nullif(text, '') AS t0, s, element_type AS et, CASE
   WHEN element_type = 'body' AND s <> '' AND {_m(st.APP_CLAUSE)} THEN 'app' WHEN element_type = 'body' AND s <> '' AND {_m(st.SUBCLAUSE)} THEN 'dotted' WHEN element_type = 'body' AND s <> '' AND {_m(st.CLAUSE)} THEN 'clause'
   WHEN element_type = 'section' AND number <> '' AND contains(number, '.') THEN 'sdotted' WHEN element_type = 'section' AND number <> '' THEN 'sclause' WHEN element_type = 'subsec' AND number <> '' THEN 'sub'
   WHEN element_type = 'para' THEN 'para' WHEN element_type = 'subpara' THEN 'subpara' END AS o FROM (SELECT *, {_strip("coalesce(text, '')")} AS s FROM g) WHERE region = 'schedule' AND NOT head),
i1 AS (SELECT *, CASE WHEN o IN ('app', 'clause', 'sclause') THEN 'clause' WHEN o IN ('dotted', 'sdotted', 'sub') THEN 'subclause' ELSE o END AS kind,
   CASE o WHEN 'app' THEN {_x(st.APP_CLAUSE, 1)} WHEN 'dotted' THEN {_x(st.SUBCLAUSE, 1)} WHEN 'clause' THEN {_x(st.CLAUSE, 1)} ELSE num0 END AS num,
   CASE o WHEN 'app' THEN {_x(st.APP_CLAUSE, 2)} WHEN 'clause' THEN {_x(st.CLAUSE, 2)} WHEN 'sclause' THEN h0 WHEN 'sdotted' THEN h0 END AS heading,
   CASE o WHEN 'dotted' THEN {_x(st.SUBCLAUSE, 2)} WHEN 'sub' THEN t0 WHEN 'para' THEN t0 WHEN 'subpara' THEN t0 END AS text,
   count(*) FILTER (o IN ('app', 'clause', 'sclause')) OVER (PARTITION BY act_id, schedule_no ORDER BY pos) AS nth FROM i0 WHERE o IS NOT NULL),
i2 AS (SELECT *, CASE WHEN o = 'app' THEN 'clause-' || nth WHEN kind = 'subclause' THEN 'subclause-' || replace(num, '.', '-') ELSE kind || '-' || num END AS step FROM i1),
i3 AS (SELECT *, last_value(CASE WHEN kind = 'clause' THEN {{'p': pos, 's': step}} END IGNORE NULLS) OVER w AS c, last_value(CASE WHEN o IN ('dotted', 'sdotted') THEN {{'p': pos, 's': step}} END IGNORE NULLS) OVER w AS sc,
   last_value(CASE WHEN o = 'para' THEN {{'p': pos, 's': step}} END IGNORE NULLS) OVER w AS pa, last_value(CASE WHEN kind IN ('clause', 'subclause') THEN pos END IGNORE NULLS) OVER w AS x
   FROM i2 WINDOW w AS (PARTITION BY act_id, schedule_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
i4 AS (SELECT *, concat_ws('__', 'schedule-' || schedule_no, CASE WHEN kind <> 'clause' THEN c.s END, CASE WHEN kind <> 'clause' AND o NOT IN ('dotted', 'sdotted') AND (c IS NULL OR sc.p > c.p) THEN sc.s END,
   CASE WHEN kind = 'subpara' AND (x IS NULL OR pa.p > x) THEN pa.s END) AS parent_eid FROM i3)"""


@query(_REGIONS + f", {_SI} SELECT act_id, schedule_no, para_id, pos, kind, num, heading, text, concat_ws('__', parent_eid, step) AS eid, parent_eid FROM i4")
def schedule_items(spark, d):
    """The items of schedules with identifiers; also checked against a direct walk in the tests."""
    return st.schedule_items(settled(_regions(spark, d), "regions"))


@query(_REGIONS + f"""SELECT act_id, schedule_no, coalesce(nullif(regexp_replace(regexp_replace(text, {re2(cl.SCHEDULE_HEADING, True)}, ''), '^[—– -]+', ''), ''), text) AS heading FROM g WHERE region = 'schedule' AND head""")
def schedule_headings(spark, d):
    """F33."""
    return st.schedule_headings(_regions(spark, d))


@query(_REGIONS + f"""SELECT act_id, para_id, pos, CASE WHEN raw_style = 'TOC Heading' THEN 'toc' WHEN raw_style IN ('TOC 1', 'TOC 2', 'TOC 3') THEN 'tocItem' WHEN {_m(st.ENACTING, True, of="coalesce(text, '')")} THEN 'formula'
 WHEN {_m(st.WHEREAS, True, of="coalesce(text, '')")} THEN 'recital' ELSE 'p' END AS route FROM g WHERE region = 'preface'""")
def preface_routes(spark, d):
    """F32."""
    return st.preface_routes(_regions(spark, d))


@query(f"""SELECT act_id, para_id, row_no, c - 1 AS col_no, cells[c] AS cell, CASE WHEN row_no = 0 THEN 'th' ELSE 'td' END AS tag FROM (
 SELECT act_id, para_id, r - 1 AS row_no, table_rows[r] AS cells, unnest(range(1, len(table_rows[r]) + 1)) AS c FROM (SELECT *, unnest(range(1, len(table_rows) + 1)) AS r FROM {_ST} WHERE element_type = 'table'))""")
def table_cells(spark, d):
    """T5."""
    return st.table_cells(derive(spark, d, STREAM)).select("act_id", "para_id", "row_no", "col_no", "cell", "tag")


# --- annotation -------------------------------------------------------------------------------------------------------
def _spans_sql(patterns, columns: str = "starts_at, starts_at + length(matched) AS ends_at, kind, matched, note", keep: str = "true", drop: str | None = None) -> str:
    c = sql_matches("text", patterns)
    if drop:
        c = f"list_filter({c}, lambda m: {drop})"
    return f"SELECT para_id, {columns} FROM (SELECT para_id, m.starts_at AS starts_at, m.kind AS kind, m.matched AS matched, m.note AS note FROM (SELECT para_id, unnest({sql_leftmost(c)}) AS m FROM {REFERRING_SQL} WHERE text IS NOT NULL)) WHERE {keep}"


@query(_spans_sql(an.QUANTITIES, "starts_at, starts_at + length(matched) AS ends_at, kind, matched, note, '/ontology/concept/au/' || kind AS concept"))
def quantities(spark, d):
    """F22, W16."""
    return an.quantities(referring(spark, d))


@query(_spans_sql(an.ROLES))
def roles(spark, d):
    """F23, W16."""
    return an.roles(referring(spark, d))


@query(f"SELECT DISTINCT kind AS eid, '/ontology/roles/au/' || kind AS href, note AS show_as FROM ({_spans_sql(an.ROLES)})")
def role_registry(spark, d):
    """A6, J11."""
    return an.registry(an.roles(referring(spark, d)), "/ontology/roles/au/")


@query(f"SELECT DISTINCT kind AS eid, '/ontology/concept/au/' || kind AS href, note AS show_as FROM ({_spans_sql(an.QUANTITIES)})")
def concept_registry(spark, d):
    """A6, J11."""
    return an.registry(an.quantities(referring(spark, d)), "/ontology/concept/au/")


_MONTH = "CASE lower(regexp_extract(matched, {p}, 2)) " + " ".join(f"WHEN '{m.lower()}' THEN '{i:02}'" for i, m in enumerate(an.MONTHS, 1)) + " END"
_DMY, _SLASH = an.DATES[0].re2, an.DATES[1].re2
_ISO = f"""CASE WHEN kind = 'dmy' THEN regexp_extract(matched, {_DMY}, 3) || '-' || {_MONTH.format(p=_DMY)} || '-' || lpad(regexp_extract(matched, {_DMY}, 1), 2, '0')
 WHEN kind = 'slash' THEN regexp_extract(matched, {_SLASH}, 3) || '-' || lpad(regexp_extract(matched, {_SLASH}, 2), 2, '0') || '-' || lpad(regexp_extract(matched, {_SLASH}, 1), 2, '0') END"""


@query(f"SELECT *, CASE WHEN iso IS NOT NULL THEN try_cast(iso AS DATE) IS NOT NULL END AS is_valid FROM ({_spans_sql(an.DATES, 'starts_at, starts_at + length(matched) AS ends_at, kind, matched, note, ' + _ISO + ' AS iso')})")
def dates(spark, d):
    """F24, W16."""
    return an.dates(referring(spark, d))


@query(f"SELECT para_id, starts_at, ends_at, matched, '#note-' || n AS href, n AS marker FROM ({_spans_sql([an.NOTE_REF], 'starts_at, starts_at + length(matched) AS ends_at, matched, regexp_extract(matched, ' + an.NOTE_REF.re2 + ', 1) AS n')})")
def note_refs(spark, d):
    """F25."""
    return an.note_refs(referring(spark, d))


_SQL_REFS = [p if p.kind != "part_div" else an.Pattern("part_div", r"\b(Part|Division)\s+[\dIVXA-Z]+(?:\s+of\s+the)?") for p in an.REFS]
_QUOTED = """length(text[1:m.starts_at]) - length(replace(text[1:m.starts_at], '"', '')) """
_DROP = f"""NOT (m.kind = 'part_div' AND m.matched LIKE '%of_the') AND NOT (({_QUOTED}) % 2 = 1 AND contains(text[m.starts_at + length(m.matched) + 1:], '"') AND NOT contains(m.matched, '"'))"""
_R = {p.kind: p.re2 for p in _SQL_REFS}
_PD = re2(r"\b(Part|Division)\s+([\dIVXA-Z]+)")
_HREF = f"""CASE kind WHEN 'sec_subsec_para' THEN '#sec-' || regexp_extract(matched, {_R['sec_subsec_para']}, 1) || '__subsec-' || regexp_extract(matched, {_R['sec_subsec_para']}, 2) || '__para-' || regexp_extract(matched, {_R['sec_subsec_para']}, 3)
 WHEN 'sec_subsec' THEN '#sec-' || regexp_extract(matched, {_R['sec_subsec']}, 1) || '__subsec-' || regexp_extract(matched, {_R['sec_subsec']}, 2) WHEN 'sec' THEN '#sec-' || regexp_extract(matched, {_R['sec']}, 1)
 WHEN 'part_div' THEN CASE WHEN regexp_extract(matched, {_PD}, 1) = 'Part' THEN '#part-' ELSE '#dvs-' END || regexp_extract(matched, {_PD}, 2)
 WHEN 'def_ref' THEN '#sec-' || regexp_extract(matched, {_R['def_ref']}, 1) || CASE WHEN regexp_extract(matched, {_R['def_ref']}, 2) <> '' THEN '__subsec-' || regexp_extract(matched, {_R['def_ref']}, 2) ELSE '' END END"""
_NAME = f"CASE kind WHEN 'subsidiary' THEN regexp_extract(matched, {_R['subsidiary']}, 1) WHEN 'act' THEN regexp_extract(matched, {_R['act']}, 1) END"
_REFS_SQL = _spans_sql(_SQL_REFS, f"starts_at, starts_at + length(matched) AS ends_at, kind, matched, {_HREF} AS href, {_NAME} AS target_name", drop=_DROP)


@query(_REFS_SQL)
def references(spark, d):
    """References inside an Act and by name."""
    return an.references(referring(spark, d))


@query(f"SELECT kind, count(*) AS n, count(DISTINCT para_id) AS n_paragraphs FROM ({_REFS_SQL}) GROUP BY kind")
def reference_counts(spark, d):
    """what the reference pass counts."""
    return an.references(referring(spark, d)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("para_id").alias("n_paragraphs"))
