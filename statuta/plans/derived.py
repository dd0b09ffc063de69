"""Inputs that the given tables don't hold, derived from them by expressions that both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statuta.sources.tables import table

#: Paragraphs as a document reader gives them: style and whole text, before classification.
RAW = """
SELECT para_id, act_id, volume_index, ord, spans,
  CASE WHEN para_id % 13 = 0 THEN 'heading 5,s' ELSE raw_style END AS raw_style,
  CASE WHEN element_type = 'part' THEN 'Part ' || number || coalesce('—' || heading, '')
       WHEN element_type = 'section' AND para_id % 5 = 0 THEN number || '. (1) ' || heading
       WHEN element_type = 'section' AND para_id % 5 = 1 THEN number || '. ' || heading
       WHEN element_type = 'section' THEN number || '  ' || heading
       WHEN element_type IN ('subsec', 'para', 'subpara') THEN '(' || number || ') ' || text
       ELSE text END AS text,
  (element_type = 'part' OR para_id % 6 IN (3, 4)) AS all_bold
FROM {once} WHERE act_id IS NOT NULL"""

#: A stream with prefaces, schedules, quoted structures, lists, clauses and figures, which the given paragraphs lack.
STREAM = """
SELECT para_id, act_id, volume_index, ord AS pos, spans, table_rows, eid AS given_eid,
  CASE WHEN ord = 1 AND element_type = 'part' THEN 'body' WHEN element_type = 'part' AND para_id % 4 = 1 THEN 'body' WHEN element_type = 'note' AND para_id % 3 = 0 THEN 'body'
       WHEN element_type = 'body' AND para_id % 3 = 0 THEN 'list-item' WHEN element_type = 'penalty' AND para_id % 2 = 0 THEN 'figure' ELSE element_type END AS element_type,
  CASE WHEN element_type = 'body' AND para_id % 3 = 0 THEN CAST(para_id % 2 AS STRING) WHEN element_type = 'section' AND para_id % 6 = 0 THEN number || '.1' ELSE number END AS number,
  heading,
  CASE WHEN ord = 1 AND element_type = 'part' THEN CASE para_id % 5 WHEN 0 THEN 'Contents' WHEN 1 THEN '1  Short title' WHEN 2 THEN 'WHEREAS the people agreed to unite' WHEN 3 THEN 'The Parliament of Australia enacts:' ELSE 'An Act to provide' END
       WHEN element_type = 'part' AND para_id % 4 = 1 THEN 'Schedule ' || CAST(para_id % 9 + 1 AS STRING) || '—' || coalesce(heading, '')
       WHEN element_type = 'note' AND para_id % 3 = 0 THEN '“'
       WHEN element_type = 'body' AND para_id % 3 = 0 THEN '(a) ' || text
       WHEN element_type = 'body' AND para_id % 9 = 1 THEN 'APP ' || CAST(para_id % 7 + 1 AS STRING) || ' — Open management'
       WHEN element_type = 'body' AND para_id % 9 = 4 THEN CAST(para_id % 7 + 1 AS STRING) || '.2 Further matters'
       WHEN element_type = 'body' AND para_id % 9 = 7 THEN CAST(para_id % 7 + 1 AS STRING) || 'A Application of rules'
       ELSE text END AS text,
  CASE WHEN ord = 1 AND element_type = 'part' THEN CASE para_id % 5 WHEN 0 THEN 'TOC Heading' WHEN 1 THEN 'TOC 1' ELSE 'Normal' END WHEN element_type = 'part' AND para_id % 4 = 1 THEN 'ActHead 1' WHEN para_id % 50 = 7 THEN 'TOC 2' ELSE raw_style END AS raw_style
FROM {once} WHERE act_id IS NOT NULL"""

#: The same stream with definition sections, definitions, asterisked uses and references of every kind.
FULL = """
SELECT para_id, act_id, volume_index, pos, spans, table_rows, raw_style, element_type, number,
  CASE WHEN element_type = 'section' AND para_id % 2 = 0 THEN 'Definitions' ELSE heading END AS heading,
  CASE WHEN element_type IN ('subsec', 'para') AND para_id % 9 = 0 THEN '"personal information ' || CAST(para_id % 5 AS STRING) || '" means ' || text
       WHEN element_type IN ('subsec', 'para') AND para_id % 9 = 1 THEN 'Court, in relation to a matter, means ' || text || ' (see section 5)'
       WHEN element_type = 'subsec' AND para_id % 9 = 2 THEN 'lawyer means:'
       WHEN element_type IN ('subsec', 'para') AND para_id % 9 = 3 THEN 'A *lawyer may hold *personal information 1 and *nothing else under section 8. ' || text
       WHEN element_type = 'subsec' AND para_id % 9 = 4 THEN 'agency means any of the following:'
       WHEN element_type IN ('subsec', 'para', 'note') THEN text || CASE para_id % 12
         WHEN 0 THEN ' See s 6(1)(a) and s 16(2) of this Act.' WHEN 1 THEN ' Compare [note 3].' WHEN 2 THEN ' as defined in section 6(2) of this Act' WHEN 3 THEN ' under the Privacy Act 1988 & the Code'
         WHEN 4 THEN ' sections 1A to 2A apply, but not Parts 1 to 99' WHEN 5 THEN ' "see section 5" is not meant' WHEN 6 THEN ' from 01/07/1995' WHEN 7 THEN ' within 28 days of 3 May 2001' ELSE '' END
       ELSE text END AS text
FROM ({stream})"""

ONCE_SQL = "(SELECT DISTINCT ON (para_id) * FROM paragraphs)"


def once(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "paragraphs").dropDuplicates(["para_id"])


def full(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(FULL.replace("{stream}", STREAM), once=once(spark, d))


def derive(spark: SparkSession, d: str, sql: str) -> DataFrame:
    return spark.sql(sql, once=once(spark, d))


def duck(sql: str) -> str:
    return sql.replace("{once}", ONCE_SQL)


#: A stream with definition sections, definitions of every wording, and asterisked uses.
DEFINING = """
SELECT para_id, act_id, volume_index, ord AS pos, spans, raw_style, number,
  CASE WHEN element_type = 'body' AND para_id % 4 = 0 THEN 'list-item' ELSE element_type END AS element_type,
  CASE WHEN element_type = 'section' AND para_id % 2 = 0 THEN 'Definitions' ELSE heading END AS heading,
  CASE WHEN element_type NOT IN ('body', 'subsec', 'para') THEN text
       WHEN para_id % 9 = 0 THEN '"personal information ' || CAST(para_id % 5 AS STRING) || '" means ' || text
       WHEN para_id % 9 = 1 THEN 'Court, in relation to a matter, means ' || text
       WHEN para_id % 9 = 2 AND element_type <> 'para' THEN 'lawyer means:'
       WHEN para_id % 9 = 3 THEN 'A *lawyer may hold *personal information 1 and *nothing else. ' || text
       WHEN para_id % 9 = 4 THEN 'Act does not include regulations, etc.'
       WHEN para_id % 9 = 6 AND element_type <> 'para' THEN 'agency means any of the following:'
       WHEN para_id % 9 = 5 THEN 'tax officer has the meaning given by section 5.'
       ELSE text END AS text
FROM {once} WHERE act_id IS NOT NULL"""

#: Paragraphs with every kind of reference, date and note mark, some naming real Acts.
REFERRING = """
SELECT p.para_id, p.act_id, p.eid, p.spans, p.text || CASE p.para_id % 12
   WHEN 0 THEN ' See s 6(1)(a) and s 16(2) of this Act.' WHEN 1 THEN ' Compare [note 3] and [Note 12].' WHEN 2 THEN ' as defined in section 6(2) of this Act' WHEN 3 THEN ' under the ' || coalesce(a.name, 'X Act 1900')
   WHEN 4 THEN ' sections 2 to 4 apply, but not Parts 1 to 99' WHEN 5 THEN ' "see section 5" is not meant' WHEN 6 THEN ' from 01/07/1995 or 45/13/2020' WHEN 7 THEN ' made under the Privacy Regulation 2013'
   WHEN 8 THEN ' Part III of the Code' WHEN 9 THEN ' the Commissioner of Taxation and the Privacy Commissioner' ELSE '' END AS text
FROM {once} p LEFT JOIN {names} a ON a.title_id = p.act_id WHERE p.act_id IS NOT NULL"""
NAMES_SQL = "(SELECT title_id, any_value(name) AS name FROM acts GROUP BY title_id)"


def names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "acts").groupBy("title_id").agg({"name": "any_value"}).withColumnRenamed("any_value(name)", "name")


def referring(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(REFERRING, once=once(spark, d), names=names(spark, d))


REFERRING_SQL = "(" + REFERRING.replace("{once}", ONCE_SQL).replace("{names}", NAMES_SQL) + ")"

#: Rows of an endnote table as a reader gives them: two cells, the first often empty, the second with several parts.
ENDNOTES = """
SELECT report_id AS act_id, event_id AS row_ord,
  array(CASE WHEN event_id % 5 IN (1, 2) THEN '' WHEN event_id % 11 = 0 THEN 'Part IX' ELSE provision END,
    CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 7 = 0 THEN raw_text || '; Nos 83 and 172, 1999' WHEN event_id % 7 = 1 THEN raw_text || ' (amdt never applied (Sch 1))'
         WHEN event_id % 7 = 2 THEN 'see the table of Acts; ' || raw_text WHEN event_id % 13 = 3 THEN 'No 4, 1999' ELSE raw_text END) AS cells
FROM {events} WHERE report_id IS NOT NULL"""
EVENTS_SQL = "(SELECT DISTINCT ON (event_id) * FROM amendment_events)"
ENDNOTES_SQL = "(" + ENDNOTES.replace("{events}", EVENTS_SQL).replace("array(", "list_value(") + ")"


def endnotes(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(ENDNOTES, events=table(spark, d, "amendment_events").dropDuplicates(["event_id"]))
