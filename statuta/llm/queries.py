"""Queries of the text-corpus problems, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statuta.llm import encode, lookalike, pack, split, survivor, truncated
from statuta.session import scratch
from statuta.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that read the same: field_name, para_id_a, para_id_b."""
    return lookalike.alike_pairs(table(spark, d, "paragraphs"))


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs whose value is spelt in more than one way, with their class."""
    return lookalike.alike_classes(table(spark, d, "paragraphs"))


def p2_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every text and joined span text in the one form."""
    return lookalike.normalised(table(spark, d, "paragraphs"))


def p2_repairs(spark: SparkSession, d: str) -> DataFrame:
    """How many tokens and values each rule of repair mends."""
    return lookalike.repairs_by_rule(table(spark, d, "paragraphs"))


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Numbered pieces of paragraphs beyond 1,200 characters."""
    return split.split_long(table(spark, d, "paragraphs"), "para_id", "text", ["eid"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs beyond 1,200 characters: para_id, hard."""
    return p5_pieces(spark, d).where("piece_no = 1").select("para_id", "hard")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The entry that supplies each surviving value: title_id, field_name, entry_id."""
    return survivor.surviving(table(spark, d, "corpus_index"), table(spark, d, "source_trust"))


def p6_consensus(spark: SparkSession, d: str) -> DataFrame:
    """The consensus of every field of every title, beside the required order."""
    return survivor.compared(table(spark, d, "corpus_index"), table(spark, d, "source_trust"))


def p6_survivors(spark: SparkSession, d: str) -> DataFrame:
    """One row per title with two or more entries."""
    return survivor.survivors(table(spark, d, "corpus_index"), table(spark, d, "source_trust"))


def _spread(docs: DataFrame) -> DataFrame:
    """Documents dealt over the tasks, where the files alone would give fewer tasks than cores."""
    spark = docs.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(2 * cores)


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document: doc_id, ids."""
    return encode.token_ids(_spread(table(spark, d, "documents").select("doc_id", "text")))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    at = scratch(spark, "sizes")
    encode.token_counts(_spread(table(spark, d, "documents").select("doc_id", "text"))).write.parquet(at)
    return spark.read.schema("doc_id BIGINT, n_tokens INT").parquet(at)


def p8_pack(spark: SparkSession, d: str) -> DataFrame:
    """Documents in containers of 2,048 tokens."""
    return pack.pack(_sizes(spark, d), "doc_id", "n_tokens")


def p8_filling(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are."""
    return pack.filling(p8_pack(spark, d))


#: The largest container costs a quarter more than its length, as attention in it grows with its square.
DEAR = {"attention": 0.25}


def p8_lengths(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers are, and what they cost, where long ones are dear."""
    return pack.filling(pack.pack(_sizes(spark, d), "doc_id", "n_tokens", **DEAR), **DEAR)


def _told(spark: SparkSession, d: str) -> DataFrame:
    return truncated.judged(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that were cut: doc_id."""
    return _told(spark, d).where("cut").select("doc_id")


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts: source, n_texts, n_cut, share_cut."""
    return truncated.cut_share(_told(spark, d))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p2_found, p2_classes, p2_forms, p2_repairs, p5_found, p5_pieces, p6_found, p6_consensus, p6_survivors, p7_ids, p8_pack, p8_filling, p8_lengths, p9_found, p9_report)}

_SPACE = r"[\s\x{000B}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Stand-ins for no value, written apart from those of the operator.
_NO_VALUE = "('', '-', '--', '?', 'n/a', 'na', 'tbc', 'tba', 'null', '(null)', 'none', '(none)', 'nil', 'unknown', 'untitled', 'missing', 'blank', 'not available', 'not known')"


def _given(x: str) -> str:
    return f"coalesce(lower(regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')) NOT IN {_NO_VALUE}, false)"


_FIELDS_SQL = ", ".join(f"CASE WHEN {_given(f)} THEN {f} END AS {f}" for f in ["title_id", "name", "comp_num", "frbr_uri"])
_FIELDS_SQL += f", CASE WHEN {_given('effective_date')} AND regexp_matches(effective_date, '[1-9A-Za-z]') THEN effective_date END AS effective_date"
ORACLE: dict[str, str] = {
    "p5_found": rf"""
SELECT para_id, CASE WHEN max(length(s)) > 1200 THEN 1 ELSE 0 END::INT AS hard
FROM (SELECT para_id, unnest(string_split(regexp_replace(replace(text, chr(1), ' '), '\n|([.;:?!]){_SPACE}+', '\1' || chr(1), 'g'), chr(1))) AS s
      FROM (SELECT DISTINCT para_id, text FROM paragraphs WHERE length(text) > 1200)) GROUP BY para_id""",
    "p6_found": f"""
WITH e0 AS (SELECT DISTINCT ON (entry_id) entry_id, source_format, fetched_at, {_FIELDS_SQL},
                   [a FOR a IN coalesce(aliases, []) IF {_given('a')}] AS aliases FROM corpus_index),
e AS (SELECT *, upper(regexp_replace(title_id, '{_SPACE}+', '', 'g')) AS own FROM e0),
borne AS (SELECT n, min(own) AS own FROM (SELECT own, name AS n FROM e WHERE own IS NOT NULL AND name IS NOT NULL UNION SELECT own, unnest(aliases) FROM e WHERE own IS NOT NULL) GROUP BY n HAVING min(own) = max(own)),
m AS (SELECT e.*, coalesce(e.own, b.own) AS title, coalesce(t.trust, 0) AS trust FROM e
      LEFT JOIN borne b ON e.own IS NULL AND b.n = e.name
      LEFT JOIN source_trust t ON lower(t.source_format) = lower(regexp_replace(e.source_format, '^{_SPACE}+|{_SPACE}+$', '', 'g'))),
multi AS (SELECT title FROM m WHERE title IS NOT NULL GROUP BY title HAVING count(*) > 1),
v AS (SELECT title, entry_id, trust, fetched_at, unnest(['name', 'comp_num', 'effective_date', 'frbr_uri']) AS field_name, unnest([name, comp_num, effective_date, frbr_uri]) AS value FROM m WHERE title IN (SELECT title FROM multi))
SELECT title AS title_id, field_name, entry_id FROM (
  SELECT *, row_number() OVER (PARTITION BY title, field_name ORDER BY trust DESC, fetched_at DESC NULLS LAST, entry_id) AS rn FROM v WHERE value IS NOT NULL) WHERE rn = 1""",
}
