"""Queries of named references, terms, amendments and the corpus index, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from statuta.functions.patterns import re2
from statuta.operators import amendments as am
from statuta.operators import annotate as an
from statuta.operators import corpus as co
from statuta.operators import markup as mu
from statuta.operators import terms as te
from statuta.plans import structural as sn
from statuta.plans.derived import DEFINING, ENDNOTES_SQL, NAMES_SQL, REFERRING_SQL, derive, duck, endnotes, names, referring
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


# --- names ------------------------------------------------------------------------------------------------------------
_ENTRIES = "(SELECT DISTINCT ON (entry_id) * FROM corpus_index)"
_CITATION = f"""SELECT name, frbr_uri, title_id FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY is_alias, entry_id) AS rn FROM (
  SELECT name, 0 AS is_alias, entry_id, frbr_uri, title_id FROM {_ENTRIES} UNION ALL SELECT unnest(aliases), 1, entry_id, frbr_uri, title_id FROM {_ENTRIES}) WHERE name IS NOT NULL) WHERE rn = 1"""


def _entries(spark, d):
    return table(spark, d, "corpus_index").dropDuplicates(["entry_id"])


@query(_CITATION)
def citation_index(spark, d):
    """Names and aliases, canonical before alias."""
    return co.citation_index(_entries(spark, d))


@query(f"""SELECT r.para_id, starts_at, ends_at, kind, matched, target_name, coalesce(href, c.frbr_uri) AS href, CASE WHEN coalesce(href, c.frbr_uri) IS NULL THEN 'unresolved' ELSE 'resolved' END AS status
FROM ({sn._REFS_SQL}) r LEFT JOIN ({_CITATION}) c ON c.name = r.target_name""")
def act_refs_resolved(spark, d):
    """References with the URI of the Act they name."""
    return an.resolve_names(an.references(referring(spark, d)), co.citation_index(_entries(spark, d))).select("para_id", "starts_at", "ends_at", "kind", "matched", "target_name", "href", "status")


_RP = "CASE lower(regexp_extract(matched, {p}, 1)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in an.RANGE_PREFIX.items()) + " END"
_RG = an.RANGE.re2


@query(f"""WITH s AS ({sn._spans_sql([an.RANGE], 'starts_at, matched')}),
e AS (SELECT s.*, t.act_id, {_RP.format(p=_RG)} || '-' || regexp_extract(matched, {_RG}, 2) AS a, {_RP.format(p=_RG)} || '-' || regexp_extract(matched, {_RG}, 3) AS z FROM s JOIN (SELECT DISTINCT para_id, act_id FROM {REFERRING_SQL}) t USING (para_id)),
k AS (SELECT DISTINCT act_id, eid, string_split(eid, '__')[-1] AS step FROM {REFERRING_SQL} WHERE eid IS NOT NULL)
SELECT para_id, act_id, starts_at, matched, '#' || a AS href_from, '#' || z AS href_up_to,
  EXISTS (SELECT 1 FROM k WHERE k.act_id = e.act_id AND k.eid = a) AND EXISTS (SELECT 1 FROM k WHERE k.act_id = e.act_id AND k.eid = z) AS resolved,
  EXISTS (SELECT 1 FROM k WHERE k.act_id = e.act_id AND k.step = a) AND EXISTS (SELECT 1 FROM k WHERE k.act_id = e.act_id AND k.step = z) AS resolved_nested FROM e""")
def range_refs(spark, d):
    """F16, J7."""
    r = referring(spark, d)
    return an.ranges(r, r.select("act_id", "eid"))


# --- terms ------------------------------------------------------------------------------------------------------------
_S = sn._strip("coalesce(text, '')")


def _rm(p: str, of: str, s: bool = True) -> str:
    return f"regexp_matches({of}, {re2(p, True, s)})"


def _rx(p: str, n: int, of: str = "s") -> str:
    return sn._strip(f"regexp_extract({of}, {re2(p, True, True)}, {n})")


_WORDS = ", ".join(f"'{w}'" for w in te.FUNCTION_WORDS)


def _narrative(x: str) -> str:
    toks = f"list_filter(regexp_split_to_array({x}, {re2(r'\s+')}), lambda t: t <> '')"
    return f"({_rm(te.EMBEDDED_CONNECTOR, x)} OR {_rm(te.EMBEDDED_RELATIVE, x)} OR {_rm(te.STOP_OPENER, x)} OR (len({toks}) >= 2 AND lower(trim(({toks})[-1], '()[]{{}}.,;:')) IN ({_WORDS})))"


_RUN = f"nullif({sn._strip('fr.text')}, '')"
_DEF = "CASE WHEN s = '' OR " + _rm(te.STOP, "s") + " THEN NULL " + f"WHEN run IS NOT NULL AND starts_with(s, run) AND {_rm(te.TAIL, 's[length(run)+1:]')} AND NOT {_narrative('run')} THEN {{'show_as': run, 'connector': {_rx(te.TAIL, 1, 's[length(run)+1:]')}, 'definiens': {_rx(te.TAIL, 2, 's[length(run)+1:]')}, 'quoted': false}} "
for _p in te.DEFINITIONS:
    _raw1 = f"regexp_extract(s, {re2(_p, True, True)}, 1)"
    _DEF += f"WHEN {_rm(_p, 's')} AND NOT {_rm(te.DOES_NOT, _raw1)} AND NOT {_narrative(_rx(_p, 2))} THEN {{'show_as': {_rx(_p, 2)}, 'connector': {_rx(_p, 3)}, 'definiens': {_rx(_p, 4)}, 'quoted': starts_with(s, '\"')}} "
_DEF += "END"
_SECTIONED = f"""(SELECT *, coalesce({_rm(te.DEF_HEADING, 'sh')}, false) AS defines FROM (SELECT *, last_value(CASE WHEN element_type = 'section' THEN coalesce(heading, '') END IGNORE NULLS) OVER (PARTITION BY act_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sh FROM ({duck(DEFINING)})))"""
_FMT = "list_filter(spans, lambda x: x.bold OR x.italic OR x.superscript OR x.subscript)"
_NOT_BLOCKS = "element_type NOT IN (" + ", ".join(f"'{b}'" for b in te._BLOCKS) + ")"
_SLUG = "'term-' || trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-')"
_WITH_DEF = f"(SELECT *, {_DEF} AS d FROM (SELECT *, CASE WHEN fr.italic THEN {_RUN} END AS run FROM (SELECT *, {_S} AS s, ({_FMT})[1] AS fr FROM {_SECTIONED})))"
_DEFS = f"SELECT act_id, para_id, pos, {_SLUG.format(x='d.show_as')} AS term_eid, d.show_as AS show_as, d.connector AS connector, d.definiens AS definiens, d.quoted AS quoted FROM {_WITH_DEF} WHERE defines AND {_NOT_BLOCKS} AND d IS NOT NULL"


def _defining(spark, d):
    return derive(spark, d, DEFINING)


@query(_DEFS)
def definitions(spark, d):
    """F10, F19, F20, P10, P11, J12."""
    return te.definitions(_defining(spark, d))


_LD = f"CASE WHEN {_rm(te.LIST_DEFINITION, 's')} AND NOT {_rm(te.STOP, 's')} AND NOT {_narrative(_rx(te.LIST_DEFINITION, 1))} THEN {_rx(te.LIST_DEFINITION, 1)} END"
_LEVELS = "element_type NOT IN ('note', 'example', 'penalty')"
_LISTS = f"""SELECT act_id, para_id, pos, {_SLUG.format(x='show_as')} AS term_eid, show_as FROM (SELECT *, {_LD} AS show_as,
  first_value(CASE WHEN {_LEVELS} THEN element_type END IGNORE NULLS) OVER (PARTITION BY act_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt,
  last_value(CASE WHEN {_LEVELS} THEN element_type END IGNORE NULLS) OVER (PARTITION BY act_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prv
 FROM (SELECT *, {_S} AS s FROM {_SECTIONED})) WHERE defines AND {_NOT_BLOCKS} AND nxt IN ('para', 'list-item') AND (element_type <> 'body' OR coalesce(prv, '') <> 'body') AND show_as IS NOT NULL"""


@query(_LISTS)
def list_definitions(spark, d):
    """F21."""
    return te.list_definitions(_defining(spark, d))


_REG = f"SELECT act_id, term_eid, arg_max(show_as, pos) AS show_as, '/ontology/term/au/' || term_eid AS href FROM (SELECT act_id, pos, term_eid, show_as FROM ({_DEFS}) UNION ALL SELECT act_id, pos, term_eid, show_as FROM ({_LISTS})) GROUP BY act_id, term_eid"


def _told(spark, d):
    return mu.told(_defining(spark, d))


@query(_REG)
def term_registry(spark, d):
    """A5, J4 of terms: the last definition of an identifier wins."""
    return mu.registry(_told(spark, d))


@query(f"SELECT act_id, count(*) AS terms_found, count(*) - count(DISTINCT term_eid) AS duplicate_terms FROM ({_DEFS}) GROUP BY act_id")
def duplicate_terms(spark, d):
    """A4."""
    return te.duplicate_terms(te.definitions(_defining(spark, d)))


_ESC = r"regexp_replace(show_as, '([^A-Za-z0-9 ])', '\\\1', 'g')"
_STARS = f"""SELECT act_id, para_id, starts_at, term_eid, show_as FROM (
 SELECT *, row_number() OVER (PARTITION BY act_id, para_id, starts_at ORDER BY length(show_as) DESC, term_eid DESC) AS rn FROM (
  SELECT u.act_id, u.para_id, u.star - 1 AS starts_at, r.term_eid, r.show_as FROM (
   SELECT act_id, para_id, text, unnest(list_filter(range(1, length(text) + 1), lambda i: text[i:i] = '*')) AS star FROM ({duck(DEFINING)}) WHERE contains(text, '*') AND len(coalesce({_FMT}, [])) = 0) u
  JOIN ({_REG}) r ON r.act_id = u.act_id AND starts_with(u.text[u.star+1:], r.show_as)
  WHERE regexp_matches(r.show_as[-1:], '[\\p{{L}}\\p{{M}}\\p{{N}}_]') <> regexp_matches(u.text[u.star+1+length(r.show_as):u.star+1+length(r.show_as)], '[\\p{{L}}\\p{{M}}\\p{{N}}_]'))) WHERE rn = 1"""


@query(_STARS)
def asterisk_refs(spark, d):
    """F26, J8, W16."""
    t = _told(spark, d)
    return te.asterisk_refs(t, settled(mu.registry(t), "terms"))


@query(f"""SELECT a.act_id, n - coalesce(r, 0) AS n FROM (SELECT act_id, sum(len(regexp_extract_all(text, '\\*[A-Za-z]'))) AS n FROM ({duck(DEFINING)}) WHERE contains(text, '*') AND len(coalesce({_FMT}, [])) = 0 GROUP BY act_id) a
LEFT JOIN (SELECT act_id, count(*) AS r FROM ({_STARS}) WHERE regexp_matches(show_as, '^[A-Za-z]') GROUP BY act_id) b USING (act_id)""")
def asterisk_unresolved(spark, d):
    """A12."""
    t = _told(spark, d)
    return te.unresolved_asterisks(t, te.asterisk_refs(t, settled(mu.registry(t), "terms")))


@query(f"""WITH r AS (SELECT *, {_LD} AS l, element_type IN ('para', 'list-item') AS listed FROM {_WITH_DEF} WHERE element_type NOT IN ('note', 'example', 'penalty', 'subpara')),
t AS (SELECT *, NOT listed OR d IS NOT NULL OR l IS NOT NULL AS stops, defines AND d IS NOT NULL AND ends_with({sn._strip('d.definiens')}, ':') AS opens FROM r),
g AS (SELECT *, last_value(CASE WHEN stops THEN {{'pos': pos, 'opens': opens}} END IGNORE NULLS) OVER (PARTITION BY act_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stop FROM t),
i AS (SELECT act_id, stop.pos AS pos, string_agg(coalesce(text, ''), ' ' ORDER BY pos) AS items FROM g WHERE NOT stops AND stop.opens GROUP BY ALL)
SELECT t.act_id, t.para_id, {_SLUG.format(x='t.d.show_as')} AS term_eid, t.d.definiens || ' ' || i.items AS definiens FROM t JOIN i ON i.act_id = t.act_id AND i.pos = t.pos WHERE t.opens""")
def completed_definitions(spark, d):
    """W19."""
    return te.completed_definitions(_defining(spark, d))


_HAS = {n: " OR ".join(f"regexp_matches(text, {p.re2})" for p in ps) for n, ps in (("qty", an.QUANTITIES), ("date", an.DATES), ("role", an.ROLES))}


_CLAIMS = f"""SELECT para_id, act_id, text, CASE WHEN defines AND {_NOT_BLOCKS} AND d IS NOT NULL THEN 'term' WHEN para_id IN (SELECT para_id FROM ({_LISTS})) THEN 'listdef' WHEN len(coalesce({_FMT}, [])) > 0 THEN 'fmt'
 WHEN para_id IN (SELECT para_id FROM ({_STARS})) THEN 'ast' WHEN {_HAS['qty']} THEN 'qty' WHEN {_HAS['date']} THEN 'date' WHEN {_HAS['role']} THEN 'role' END AS claim FROM {_WITH_DEF}"""


@query(f"SELECT para_id, claim FROM ({_CLAIMS})")
def annotation_claims(spark, d):
    """The order of the passes: which one may mark up a paragraph."""
    return claims(_defining(spark, d)).select("para_id", "claim")


def claims(rows):
    t = mu.told(rows)
    return mu.claimed(t, settled(mu.registry(t), "terms"))


# --- amendments -------------------------------------------------------------------------------------------------------
_CELLS = f"(SELECT act_id, row_ord, {sn._strip('coalesce(cells[1], chr(32))')} AS c1, {sn._strip('coalesce(cells[2], chr(32))')} AS c2 FROM {ENDNOTES_SQL} WHERE len(cells) >= 2)"
_FILLED = f"SELECT act_id, row_ord, provision, c2 AS affected FROM (SELECT *, last_value(nullif(c1, '') IGNORE NULLS) OVER (PARTITION BY act_id ORDER BY row_ord ROWS UNBOUNDED PRECEDING) AS provision FROM {_CELLS} WHERE lower(c1) NOT IN ('provision affected', 'provision\naffected')) WHERE provision IS NOT NULL AND c2 <> ''"
_SEG = re2(am.SEGMENT, True)
_SEGS = f"""(SELECT *, last_value(effect0 IGNORE NULLS) OVER (PARTITION BY act_id, row_ord ORDER BY seg_no ROWS UNBOUNDED PRECEDING) AS effect FROM (
 SELECT *, regexp_matches(clean, {_SEG}) AS ok, CASE WHEN regexp_matches(clean, {_SEG}) THEN nullif(lower(regexp_extract(clean, {_SEG}, 1)), '') END AS effect0 FROM (
  SELECT act_id, row_ord, provision, affected, i - 1 AS seg_no, parts[i] AS segment, {sn._strip("regexp_replace(parts[i], " + re2(am.EDITORIAL, True) + ", '', 'g')")} AS clean FROM (
   SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT *, list_filter(list_transform(regexp_split_to_array(affected, {re2(r';\s*')}), lambda x: {sn._strip('x')}), lambda x: x <> '') AS parts FROM ({_FILLED}))))))"""
_EVENTS = f"""SELECT act_id, row_ord, seg_no, k - 1 AS num_no, provision, effect, TRY_CAST(nums[k] AS INT) AS act_number, year::INT AS act_year, NOT regexp_matches(affected, {re2(am.NOT_APPLIED, True)}) AS applied, affected AS raw_text FROM (
 SELECT *, unnest(range(1, len(nums) + 1)) AS k FROM (SELECT *, regexp_extract_all(regexp_extract(clean, {_SEG}, 2), '[0-9]+') AS nums, regexp_extract(clean, {_SEG}, 3) AS year FROM {_SEGS} WHERE ok AND effect IS NOT NULL))"""


def _events(spark, d):
    return am.events(am.provisions_filled(endnotes(spark, d)))


@query(_EVENTS)
def amendment_cells(spark, d):
    """Endnote cells as events."""
    return _events(spark, d)


@query(f"SELECT act_id, row_ord, provision, segment, CASE WHEN NOT ok THEN 'unmatched' ELSE 'no effect' END AS error FROM {_SEGS} WHERE NOT ok OR effect IS NULL")
def amendment_errors(spark, d):
    """the parts that no event comes from."""
    return am.parse_errors(am.provisions_filled(endnotes(spark, d)))


_LIFE = f"SELECT act_id, 'evt-amd-' || row_number() OVER (PARTITION BY act_id ORDER BY act_year, act_number) AS event_eid, '/akn/au/act/' || act_year || '/' || act_number AS source, act_number, act_year FROM (SELECT DISTINCT act_id, act_number, act_year FROM ({_EVENTS}) WHERE act_number IS NOT NULL AND act_year IS NOT NULL)"


@query(_LIFE)
def lifecycle_events(spark, d):
    """W12, T7."""
    return am.lifecycle(_events(spark, d))


@query(f"""WITH e AS (SELECT *, 'sec-' || nullif(regexp_extract(provision, {re2(am.PROVISION, True)}, 1), '') AS cand FROM ({_EVENTS}) WHERE applied),
k AS (SELECT DISTINCT report_id AS act_id, CASE WHEN event_id % 2 = 0 THEN 'sec-' ELSE 'SEC-' END || nullif(regexp_extract(provision, {re2(am.PROVISION, True)}, 1), '') AS eid FROM amendment_events),
x AS (SELECT e.act_id, (row_ord * 10000 + seg_no * 100 + num_no)::BIGINT AS ord, effect, provision, coalesce((SELECT max(eid) FROM k WHERE k.act_id = e.act_id AND k.eid = cand), (SELECT min(eid) FROM k WHERE k.act_id = e.act_id AND lower(k.eid) = lower(cand))) AS dest_eid, l.event_eid
  FROM e LEFT JOIN ({_LIFE}) l ON l.act_id = e.act_id AND l.act_number = e.act_number AND l.act_year = e.act_year)
SELECT act_id, ord, CASE WHEN dest_eid IS NOT NULL AND event_eid IS NOT NULL THEN count(*) FILTER (dest_eid IS NOT NULL AND event_eid IS NOT NULL) OVER (PARTITION BY act_id ORDER BY ord) END AS mod_no,
  CASE effect WHEN 'am' THEN 'substitution' WHEN 'rs' THEN 'substitution' WHEN 'ad' THEN 'insertion' WHEN 'rep' THEN 'repeal' ELSE 'amendment' END AS mod_type, event_eid, dest_eid, provision FROM x""")
def passive_mods(spark, d):
    """F29, J5, J6, W13."""
    ev = _events(spark, d).withColumn("ord", F.col("row_ord") * 10000 + F.col("seg_no") * 100 + F.col("num_no"))
    step = F.nullif(F.regexp_extract("provision", am.java(am.PROVISION, True), 1), F.lit(""))
    raw = table(spark, d, "amendment_events")
    known = raw.select(F.col("report_id").alias("act_id"), F.concat(F.when(F.col("event_id") % 2 == 0, "sec-").otherwise("SEC-"), step).alias("eid")).distinct()
    return am.passive_mods(ev, known, ["ord"])


_HIST = "(SELECT report_id AS act_id, event_id AS row_ord, list_value(CASE WHEN event_id % 9 = 0 THEN 'Act' ELSE raw_text END, coalesce(act_number, 0) || ', ' || coalesce(act_year, 0), strftime(recorded_at, '%Y-%m-%d')) AS cells FROM (SELECT DISTINCT ON (event_id) * FROM amendment_events))"


@query(f"""SELECT act_id, row_ord, {sn._strip('cells[1]')} AS act_name, TRY_CAST(nullif(regexp_extract(cells[2], {re2(am.NUM_YEAR)}, 1), '') AS INT) AS act_number, TRY_CAST(nullif(regexp_extract(cells[2], {re2(am.NUM_YEAR)}, 2), '') AS INT) AS act_year, cells[3] AS assent_raw, '' AS commencement_raw
FROM {_HIST} WHERE {sn._strip('cells[1]')} <> '' AND lower({sn._strip('cells[1]')}) NOT IN ('act', 'number and year')""")
def legislation_history(spark, d):
    """F28, F38."""
    e = table(spark, d, "amendment_events").dropDuplicates(["event_id"])
    cells = F.array(
        F.when(F.col("event_id") % 9 == 0, "Act").otherwise(F.col("raw_text")), F.concat(F.coalesce("act_number", F.lit(0)).cast("string"), F.lit(", "), F.coalesce("act_year", F.lit(0)).cast("string")),
        F.date_format("recorded_at", "yyyy-MM-dd"),
    )
    return am.legislation_history(e.select(F.col("report_id").alias("act_id"), F.col("event_id").alias("row_ord"), cells.alias("cells")))


_NOTED = "(SELECT para_id, act_id, volume_index, ord AS pos, CASE WHEN element_type = 'part' AND para_id % 2 = 0 THEN 'ENotesHeading 1' WHEN element_type = 'section' THEN 'ENotesHeading 2' ELSE raw_style END AS raw_style, CASE WHEN element_type = 'part' THEN 'Endnotes' WHEN element_type = 'section' THEN 'Endnote ' || number ELSE text END AS text FROM {once} WHERE act_id IS NOT NULL)"


@query(f"""SELECT para_id, CASE WHEN inside THEN section END AS section FROM (SELECT para_id, last_value(CASE WHEN raw_style = 'ENotesHeading 1' AND {sn._strip('text')} = 'Endnotes' THEN true END IGNORE NULLS) OVER w AS inside,
 last_value(CASE WHEN raw_style = 'ENotesHeading 2' THEN {sn._strip('text')} END IGNORE NULLS) OVER w AS section FROM {duck(_NOTED)} WINDOW w AS (PARTITION BY act_id, volume_index ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""")
def endnote_sections(spark, d):
    """S13."""
    return am.endnote_section(derive(spark, d, "SELECT * FROM " + _NOTED)).select("para_id", "section")


@query(f"SELECT act_id, max(volume_index) AS volume_index FROM {duck(_NOTED)} WHERE raw_style = 'ENotesHeading 1' AND {sn._strip('text')} = 'Endnotes' GROUP BY act_id")
def endnote_volumes(spark, d):
    """S14."""
    return am.endnote_volume(derive(spark, d, "SELECT * FROM " + _NOTED))


# --- the corpus index -------------------------------------------------------------------------------------------------
_ACTS = "(SELECT DISTINCT ON (title_id) * FROM acts)"


def _acts(spark, d):
    return table(spark, d, "acts").dropDuplicates(["title_id"])


_URI = "'/akn/au/' || coalesce(doc_type, 'act') || '/' || year || '/' || number"


@query(f"""SELECT title_id, translate(lower(name), ' /', '--') AS slug, {_URI} AS work_uri, {_URI} || '/eng@' || strftime(effective_date, '%Y-%m-%d') AS expression_uri, TRY_CAST(nullif(regexp_extract(name, {re2(co.YEAR_AT_END)}, 1), '') AS INT) AS year_from_name,
 TRY_CAST(coalesce({', '.join(f"nullif(regexp_extract(title_id, '{p}', 1), '')" for p in co.NUMBER_IN_ID)}) AS INT) AS number_from_id FROM {_ACTS}""")
def identifiers(spark, d):
    """S7, S8, F8, F9."""
    a, c = _acts(spark, d), F.col
    return a.select(
        "title_id", co.safe_name(c("name")).alias("slug"), co.work_uri(c("doc_type"), c("year"), c("number")).alias("work_uri"), co.expression_uri(c("doc_type"), c("year"), c("number"), c("effective_date")).alias("expression_uri"),
        co.year_from_name(c("name")).alias("year_from_name"), co.number_from_title_id(c("title_id")).alias("number_from_id"),
    )


def _titles(spark, d):
    a, c = _acts(spark, d), F.col
    return a.select(
        "title_id", "name", F.lower("name").alias("query"), c("year").cast("string").alias("year"), F.when(c("number") % 3 > 0, c("number").cast("string")).alias("number"), "long_title",
        F.array_join("subject_keywords", " , ").alias("subjects"), "doc_type", F.isnull("removed_at").alias("is_in_force"), F.when(c("doc_type") == "act", "Act").otherwise("Other").alias("collection"),
    )


_TITLES = f"(SELECT title_id, name, lower(name) AS query, year, CASE WHEN number % 3 > 0 THEN number END AS number, long_title, array_to_string(subject_keywords, ' , ') AS subjects, doc_type, removed_at IS NULL AS is_in_force, CASE WHEN doc_type = 'act' THEN 'Act' ELSE 'Other' END AS collection FROM {_ACTS})"


@query(f"SELECT name FROM {_TITLES} WHERE is_in_force AND regexp_matches(title_id, '{co.ACT_ID}') AND collection = 'Act'")
def list_acts(spark, d):
    """S2, O1, O3."""
    return co.listed(_titles(spark, d), True)


@query(f"SELECT name FROM {_TITLES} WHERE is_in_force AND NOT regexp_matches(title_id, '{co.ACT_ID}')")
def list_instruments(spark, d):
    """S3, O1."""
    return co.listed(_titles(spark, d), False)


def _versions(spark, d):
    s = table(spark, d, "act_snapshots").dropDuplicates(["snapshot_id"]).where("title_id IS NOT NULL AND snapshot_date IS NOT NULL")
    last = s.groupBy("title_id").agg(F.max("snapshot_id").alias("last"))
    return s.join(last, "title_id").select("title_id", F.concat(F.lit("R"), F.col("snapshot_id").cast("string")).alias("register_id"), F.col("comp_num").alias("compilation_number"), F.col("snapshot_date").alias("start"), (F.col("snapshot_id") == F.col("last")).alias("is_latest"))


_VERSIONS = "(SELECT title_id, 'R' || snapshot_id AS register_id, comp_num AS compilation_number, snapshot_date AS start, snapshot_id = max(snapshot_id) OVER (PARTITION BY title_id) AS is_latest FROM (SELECT DISTINCT ON (snapshot_id) * FROM act_snapshots) WHERE title_id IS NOT NULL AND snapshot_date IS NOT NULL)"


@query(f"SELECT v.title_id, t.name FROM (SELECT DISTINCT title_id FROM {_VERSIONS} WHERE is_latest AND start > DATE '2020-01-01') v JOIN {_TITLES} t USING (title_id)")
def modified_since(spark, d):
    """S4."""
    return co.modified_since(_versions(spark, d), _titles(spark, d), "2020-01-01")


_ASKED = f"(SELECT CASE WHEN entry_id % 3 = 0 THEN lower(name) WHEN entry_id % 3 = 1 THEN name ELSE 'No ' || name END AS query FROM {_ENTRIES} WHERE name IS NOT NULL)"


@query(f"""WITH live AS (SELECT title_id, name FROM {_TITLES} WHERE is_in_force), x AS (SELECT name, min(title_id) AS t FROM live GROUP BY name), l AS (SELECT lower(name) AS low, min(title_id) AS t FROM live GROUP BY lower(name) HAVING count(*) = 1)
SELECT q.query, coalesce(x.t, l.t) AS title_id, CASE WHEN x.t IS NOT NULL THEN 'exact' WHEN l.t IS NOT NULL THEN 'case' END AS how FROM {_ASKED} q LEFT JOIN x ON x.name = q.query LEFT JOIN l ON l.low = lower(q.query)""")
def resolve_titles(spark, d):
    """S5, S21."""
    e = _entries(spark, d).where("name IS NOT NULL")
    q = F.when(F.col("entry_id") % 3 == 0, F.lower("name")).when(F.col("entry_id") % 3 == 1, F.col("name")).otherwise(F.concat(F.lit("No "), "name"))
    return co.resolve_titles(e.select(q.alias("query")), _titles(spark, d))


@query(f"""SELECT t.name, t.title_id, v.register_id AS comp_id, v.compilation_number AS comp_num, t.year::INT AS year, coalesce(t.number::INT, TRY_CAST(coalesce({', '.join(f"nullif(regexp_extract(t.title_id, '{p}', 1), '')" for p in co.NUMBER_IN_ID)}) AS INT)) AS number, v.start AS effective_date,
 coalesce(t.long_title, '') AS long_title, coalesce(list_filter(list_transform(string_split(t.subjects, ','), lambda x: {sn._strip('x')}), lambda x: x <> ''), []) AS subject_keywords, CASE WHEN lower(t.query) <> lower(t.name) THEN [t.query] ELSE []::VARCHAR[] END AS aliases, coalesce(t.doc_type, 'act') AS doc_type
FROM {_TITLES} t JOIN {_VERSIONS} v ON v.title_id = t.title_id AND v.is_latest""")
def act_metadata(spark, d):
    """S6."""
    return co.metadata(_titles(spark, d), _versions(spark, d))


_CANON = NAMES_SQL


def _merged(spark, d):
    return co.merge_titles(_entries(spark, d), names(spark, d))


_MERGE = f"""WITH e AS (SELECT e.*, c.name AS canonical FROM (SELECT * FROM {_ENTRIES} WHERE title_id IS NOT NULL) e LEFT JOIN {_CANON} c USING (title_id)),
p AS (SELECT title_id, count(*) AS n, coalesce(bool_or(name = canonical), false) AS found, arg_min(entry_id, {{'a': coalesce(name <> canonical, true), 'b': entry_id}}) AS keep FROM e GROUP BY title_id),
j AS (SELECT e.*, n, found, keep, n = 1 OR NOT found AS lone FROM e JOIN p USING (title_id)),
o AS (SELECT title_id, list_sort(list_distinct(list(x))) AS merged FROM (SELECT title_id, canonical, unnest(list_concat(CASE WHEN entry_id = keep THEN []::VARCHAR[] ELSE [name] END, coalesce(aliases, []))) AS x FROM j WHERE NOT lone) WHERE x IS NOT NULL AND x <> canonical GROUP BY title_id)
"""


@query(_MERGE + "SELECT entry_id, j.title_id, name, CASE WHEN lone THEN list_sort(coalesce(aliases, [])) ELSE coalesce(merged, []) END AS aliases, NOT found AND n > 1 AS conflict FROM j LEFT JOIN o ON o.title_id = j.title_id WHERE lone OR entry_id = keep")
def title_merge(spark, d):
    """J4, A8, U2, K1."""
    return _merged(spark, d)[0]


@query(_MERGE + "SELECT entry_id, slug, xml_path, 'reports/' || slug || '-v[0-9]*.json' AS report_glob, ['docx/' || slug || '-c[0-9]*-vol*.docx', 'docx/' || slug || '-vol[0-9]*.docx'] AS docx_globs FROM j WHERE NOT lone AND entry_id <> keep")
def merge_orphans(spark, d):
    """F35, K1."""
    return _merged(spark, d)[1]


# A fold over the entries in order: each takes the place of the entry of its slug and of those of its title, and keeps the names of the latter.
_INCOMING = f"(SELECT list({{'slug': slug, 'title_id': title_id, 'name': name, 'aliases': coalesce(aliases, [])}} ORDER BY entry_id) AS es FROM {_ENTRIES} WHERE title_id IS NOT NULL AND name IS NOT NULL)"


@query(f"""SELECT e.slug AS slug, e.title_id AS title_id, e.name AS name, e.aliases AS aliases FROM (SELECT unnest(list_reduce(list_concat([es[:0]], list_transform(es, lambda x: [x])), lambda kept, x:
  list_concat(list_filter(kept, lambda k: k.slug <> x[1].slug AND k.title_id <> x[1].title_id), [{{'slug': x[1].slug, 'title_id': x[1].title_id, 'name': x[1].name,
    'aliases': list_sort(list_distinct(list_filter(list_concat(x[1].aliases, flatten(list_transform(list_filter(kept, lambda k: k.title_id = x[1].title_id AND k.slug <> x[1].slug), lambda k: list_concat([k.name], k.aliases)))), lambda a: a <> x[1].name)))}}]))) AS e FROM {_INCOMING})""")
def index_upsert(spark, d):
    """All entries come in, in the order of their ids."""
    e = _entries(spark, d).where("title_id IS NOT NULL AND name IS NOT NULL")
    return co.upsert(e.limit(0), e, "entry_id")


@query(f"SELECT DISTINCT name FROM acts WHERE NOT regexp_matches(name, '(?i){co.LOW_VALUE}') AND name NOT IN (SELECT name FROM corpus_index WHERE name IS NOT NULL) AND name NOT IN (SELECT name FROM act_snapshots WHERE comp_num = '1' AND name IS NOT NULL)")
def new_titles(spark, d):
    """J3, P12, U1, S16."""
    return co.new_titles(table(spark, d, "acts"), table(spark, d, "corpus_index").dropna(subset=["name"]), table(spark, d, "act_snapshots").where("comp_num = '1'").dropna(subset=["name"]))


@query(f"SELECT DISTINCT name FROM acts WHERE NOT regexp_matches(name, '(?i){co.LOW_VALUE}') AND name NOT IN (SELECT name FROM corpus_index WHERE name IS NOT NULL) AND name NOT IN (SELECT name FROM act_snapshots WHERE comp_num = '1' AND name IS NOT NULL) ORDER BY name LIMIT 20")
def new_titles_top(spark, d):
    """O2: the first candidates."""
    return co.new_titles(table(spark, d, "acts"), table(spark, d, "corpus_index").dropna(subset=["name"]), table(spark, d, "act_snapshots").where("comp_num = '1'").dropna(subset=["name"]), 20)


@query(f"SELECT v.title_id, t.name FROM (SELECT DISTINCT title_id FROM {_VERSIONS} WHERE is_latest AND start > DATE '2020-01-01') v JOIN {_TITLES} t USING (title_id) WHERE t.name IN (SELECT name FROM corpus_index)")
def modified_in_corpus(spark, d):
    """J2, U3."""
    return co.modified_since(_versions(spark, d), _titles(spark, d), "2020-01-01").join(table(spark, d, "corpus_index").select("name").distinct(), "name", "left_semi").select("title_id", "name")


@query(f"""SELECT translate(lower(a.name), ' /', '--') AS slug, i.slug IS NOT NULL AND a.comp_num IS NOT DISTINCT FROM i.comp_num AS is_current FROM {_ACTS} a LEFT JOIN (SELECT slug, arg_min(coalesce(comp_num, '<null>'), entry_id) AS c, CASE WHEN c = '<null>' THEN NULL ELSE c END AS comp_num FROM {_ENTRIES} GROUP BY slug) i ON i.slug = translate(lower(a.name), ' /', '--')""")
def is_current(spark, d):
    """P14."""
    e = _entries(spark, d).groupBy("slug").agg(F.min_by("comp_num", "entry_id").alias("comp_num"))
    return co.currency(_acts(spark, d).select(co.safe_name(F.col("name")).alias("slug"), "comp_num"), e)


@query(_MERGE + f"""SELECT DISTINCT xml_path AS path FROM corpus_index WHERE xml_path NOT LIKE '%.json' AND xml_path NOT LIKE 'xml/a%'
 AND xml_path NOT IN (SELECT xml_path FROM {_ENTRIES} WHERE xml_path IS NOT NULL AND entry_id NOT IN (SELECT entry_id FROM j WHERE NOT lone AND entry_id <> keep))""")
def orphan_files(spark, d):
    """Of the files of all entries, those that no entry left after merging titles has."""
    e = _entries(spark, d).select(F.col("xml_path").alias("path"), "entry_id")
    local = e.join(_merged(spark, d)[1].select("entry_id"), "entry_id", "left_anti").dropna(subset=["path"])
    return co.orphan_files(e, local, ["*.json", "xml/a*"], ["README.md"])


@query()
def site_paths(spark, d):
    """No SQL, as no engine function gives the digest; golden values in the tests."""
    return co.site_paths(_acts(spark, d).select("title_id", "name", "year", "number"))


@query(f"SELECT title_id, '/akn/au/act/' || year || '/' || number AS base, count(*) OVER (PARTITION BY year, number) > 1 AS shared FROM {_ACTS}")
def path_collisions(spark, d):
    """A7."""
    a = _acts(spark, d)
    many = a.groupBy("year", "number").agg((F.count(F.lit(1)) > 1).alias("shared"))
    return a.join(many, ["year", "number"]).select("title_id", F.concat(F.lit("/akn/au/act/"), F.col("year").cast("string"), F.lit("/"), F.col("number").cast("string")).alias("base"), "shared")


@query(f"SELECT slug, name, title_id, comp_id, comp_num, year, number, effective_date, xml_path, coalesce(aliases, []) AS aliases FROM {_ENTRIES}")
def export_rows(spark, d):
    """P16, O4, K3."""
    return co.export_rows(_entries(spark, d))
