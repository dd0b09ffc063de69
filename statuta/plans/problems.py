"""Queries of the general data-pipeline problems, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statuta.operators import history, references, shred
from statuta.session import scratch
from statuta.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_history(spark: SparkSession, d: str) -> DataFrame:
    """Every version of every title with its attributes."""
    return history.load_in_batches(spark, table(spark, d, "act_snapshots"), scratch(spark, "chains")).history()


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every version's period: title_id, valid_from, valid_to."""
    return p1_history(spark, d).select("title_id", "valid_from", "valid_to")


def _dangling(spark: SparkSession, d: str) -> DataFrame:
    return references.dangling_report_rows(table(spark, d, "amendment_events"), table(spark, d, "parse_reports"), table(spark, d, "acts"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Dangling references and wrong counts: table_name, row_id, reason."""
    return _dangling(spark, d).select("table_name", "row_id", "reason")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Dangling references by table, month and reason."""
    return references.dangling_by_month(_dangling(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of section trees: tree_id, node_path, parent_path, eid, n_paragraphs."""
    streams = shred.striped(table(spark, d, "section_trees"), ["eid", "paragraphs"])
    return shred.assemble_nodes(streams).select("tree_id", "node_path", "parent_path", "eid", "n_paragraphs")


def p4_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of section trees with all scalar leaves."""
    return shred.assemble_nodes(shred.striped(table(spark, d, "section_trees")))


def p4_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs of section trees, linked to their node."""
    return shred.assemble_paragraphs(shred.striped(table(spark, d, "section_trees"), ["paragraphs"]))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_history, p3_found, p3_report, p4_found, p4_nodes, p4_paragraphs)}

_WS = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}\x{000B}]+"
_P1 = rf"""
WITH keyed AS (
  SELECT title_id, snapshot_date, loaded_at, snapshot_id,
         trim(regexp_replace(name, '{_WS}', ' ', 'g')) AS name,
         list_sort(list_distinct([trim(regexp_replace(a, '{_WS}', ' ', 'g')) FOR a IN aliases IF a IS NOT NULL AND trim(regexp_replace(a, '{_WS}', ' ', 'g')) <> ''])) AS aliases,
         regexp_replace(trim(regexp_replace(comp_num, '{_WS}', ' ', 'g')), '^0+(.)', '\1') AS comp_num, effective_date
  FROM act_snapshots WHERE title_id IS NOT NULL AND snapshot_date IS NOT NULL),
latest AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY title_id, snapshot_date ORDER BY loaded_at DESC NULLS LAST, snapshot_id DESC) AS rn FROM keyed) WHERE rn = 1),
held AS (
  SELECT title_id, snapshot_date,
         last_value(name IGNORE NULLS) OVER w AS name, last_value(aliases IGNORE NULLS) OVER w AS aliases,
         last_value(comp_num IGNORE NULLS) OVER w AS comp_num, last_value(effective_date IGNORE NULLS) OVER w AS effective_date
  FROM latest WINDOW w AS (PARTITION BY title_id ORDER BY snapshot_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
marked AS (
  SELECT *, lag(snapshot_date) OVER w AS before, lag(name) OVER w AS n0, lag(aliases) OVER w AS a0, lag(comp_num) OVER w AS c0, lag(effective_date) OVER w AS e0
  FROM held WINDOW w AS (PARTITION BY title_id ORDER BY snapshot_date)),
versions AS (
  SELECT title_id, name, aliases, comp_num, effective_date, strftime(snapshot_date, '%Y-%m-%d') AS valid_from,
         coalesce(strftime(lead(snapshot_date) OVER (PARTITION BY title_id ORDER BY snapshot_date), '%Y-%m-%d'), '9999-12-31') AS valid_to
  FROM marked WHERE before IS NULL OR n0 IS DISTINCT FROM name OR a0 IS DISTINCT FROM aliases OR c0 IS DISTINCT FROM comp_num OR e0 IS DISTINCT FROM effective_date)
"""
_P3 = """
WITH ev AS (SELECT DISTINCT event_id, report_id, act_number, act_year, recorded_at FROM amendment_events),
rp AS (SELECT DISTINCT report_id, upper(regexp_replace(title_id, '^\\s+|\\s+$', '', 'g')) AS k, built_at, refs_unresolved FROM parse_reports),
fe AS (
  SELECT e.event_id, any_value(e.report_id) AS report_id, any_value(e.recorded_at) AS noted,
         CASE WHEN count(a.title_id) = 0 THEN 'missing' WHEN coalesce(bool_or(coalesce(a.registered_at <= e.recorded_at, true)), false) THEN 'deleted' ELSE 'late' END AS reason
  FROM ev e LEFT JOIN acts a ON a.number = e.act_number AND a.year = e.act_year
  WHERE e.act_number IS NOT NULL AND e.act_year IS NOT NULL GROUP BY e.event_id
  HAVING count(CASE WHEN a.title_id IS NOT NULL AND coalesce(a.registered_at <= e.recorded_at, true) AND coalesce(a.removed_at > e.recorded_at, true) THEN 1 END) = 0),
fr AS (
  SELECT r.report_id, any_value(r.built_at) AS noted,
         CASE WHEN count(a.title_id) = 0 THEN 'missing' WHEN coalesce(bool_or(coalesce(a.registered_at <= r.built_at, true)), false) THEN 'deleted' ELSE 'late' END AS reason
  FROM rp r LEFT JOIN acts a ON upper(trim(a.title_id)) = r.k WHERE r.k <> '' GROUP BY r.report_id
  HAVING count(CASE WHEN a.title_id IS NOT NULL AND coalesce(a.registered_at <= r.built_at, true) AND coalesce(a.removed_at > r.built_at, true) THEN 1 END) = 0),
fc AS (
  SELECT r.report_id, r.built_at AS noted FROM rp r LEFT JOIN (SELECT report_id, count(*) AS n FROM fe GROUP BY report_id) c ON c.report_id = r.report_id
  WHERE r.refs_unresolved IS NOT NULL AND r.refs_unresolved <> coalesce(c.n, 0)),
found AS (
  SELECT 'amendment_events' AS table_name, event_id AS row_id, reason, noted FROM fe
  UNION ALL SELECT 'parse_reports', report_id, reason, noted FROM fr
  UNION ALL SELECT 'parse_reports', report_id, 'count', noted FROM fc)
"""
ORACLE: dict[str, str] = {
    "p1_found": _P1 + "SELECT title_id, valid_from, valid_to FROM versions",
    "p1_history": _P1 + "SELECT * FROM versions",
    "p3_found": _P3 + "SELECT table_name, row_id, reason FROM found",
    "p3_report": _P3 + "SELECT table_name, strftime(noted, '%Y-%m') AS month, reason, count(*) AS n FROM found GROUP BY ALL",
}
