"""The corpus index: names, identifiers, merging of renamed titles, what is new, changed or orphaned."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from statuta.functions.patterns import java
from statuta.functions.text import extract, strip
from statuta.session import settled

# Forms of title ids, and titles of little value to a reader.
NUMBER_IN_ID = [r"C\d{4}A(\d+)", r"C\d{4}R(\d+)", r"F\d{4}[A-Z](\d+)"]
ACT_ID = r"^C\d{4}A\d+"
YEAR_AT_END = r"(?:^|\s)(\d{4})\s*$"
LOW_VALUE = r"Amendment|Statute Law Revision|Repeal|Consequential|Transitional|Miscellaneous"


def safe_name(name: Column) -> Column:
    """The key of an entry: lower case, blanks and slashes as hyphens."""
    return F.translate(F.lower(name), " /", "--")


def keyword_slug(word: Column) -> Column:
    return F.replace(F.lower(word), F.lit(" "), F.lit("-"))


def work_uri(doc_type: Column, year: Column, number: Column) -> Column:
    return F.concat_ws("/", F.lit("/akn/au"), F.coalesce(doc_type, F.lit("act")), year.cast("string"), number.cast("string"))


def expression_uri(doc_type: Column, year: Column, number: Column, day: Column) -> Column:
    return F.concat(work_uri(doc_type, year, number), F.lit("/eng@"), F.date_format(day, "yyyy-MM-dd"))


def year_from_name(name: Column) -> Column:
    """The year a name ends in, or null."""
    return extract(name, java(YEAR_AT_END)).try_cast("int")


def number_from_title_id(title_id: Column) -> Column:
    """The number in a title id, by the first form that fits, or null."""
    return F.coalesce(*[extract(title_id, p) for p in NUMBER_IN_ID]).try_cast("int")


def keywords(value: Column, is_list: bool) -> Column:
    """Subject keywords given as a list or as comma-separated text, stripped, without blanks."""
    parts = value if is_list else F.split(value, ",")
    return F.filter(F.transform(parts, lambda x: strip(x)), lambda x: x != "")


def listed(titles: DataFrame, acts: bool, collection: str = "Act") -> DataFrame:
    """name of titles in force that are Acts by their id (and of the collection), or that aren't; each once, sorted."""
    is_act = F.col("title_id").rlike(ACT_ID)
    keep = (is_act & (F.col("collection") == collection)) if acts else ~is_act
    return titles.where(F.col("is_in_force") & keep).select("name").orderBy("name")


def modified_since(versions: DataFrame, titles: DataFrame, since: str) -> DataFrame:
    """title_id, name of titles whose latest version began after a day."""
    v = versions.where(F.col("is_latest") & (F.col("start") > F.lit(since).cast("date"))).select("title_id").distinct()
    return v.join(titles.select("title_id", "name"), "title_id")


def resolve_titles(queries: DataFrame, titles: DataFrame) -> DataFrame:
    """query, title_id, how: the title in force of exactly that name, else the only one of that name whatever its case.

    Null queries give a row without a title. Of several titles with one exact name the least id is taken.
    """
    live = titles.where("is_in_force").select("title_id", "name")
    exact = live.groupBy(F.col("name").alias("query")).agg(F.min("title_id").alias("exact"))
    loose = live.groupBy(F.lower("name").alias("low")).agg(F.min("title_id").alias("loose"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    q = queries.select("query").join(exact, "query", "left").withColumn("low", F.lower("query")).join(loose, "low", "left")
    how = F.when(F.col("exact").isNotNull(), "exact").when(F.col("loose").isNotNull(), "case")
    return q.select("query", F.coalesce("exact", "loose").alias("title_id"), how.alias("how"))


def metadata(titles: DataFrame, versions: DataFrame) -> DataFrame:
    """ActMetadata rows: titles joined with their latest version; year and number fall back to the name and the id.

    titles: title_id, query, name, year, number, long_title, subjects (text), doc_type; versions: title_id, register_id,
    compilation_number, start, is_latest. The query a title was found by becomes an alias where it isn't its name.
    """
    latest = versions.where("is_latest").groupBy("title_id").agg(F.max_by(F.struct("register_id", "compilation_number", "start"), "start").alias("v"))
    differs = F.col("query").isNotNull() & (F.lower("query") != F.lower("name"))
    return titles.join(latest, "title_id").select(
        "name", "title_id", F.col("v.register_id").alias("comp_id"), F.col("v.compilation_number").alias("comp_num"),
        F.coalesce(F.col("year").try_cast("int"), year_from_name(F.col("name"))).alias("year"), F.coalesce(F.col("number").try_cast("int"), number_from_title_id(F.col("title_id"))).alias("number"),
        F.col("v.start").alias("effective_date"), F.coalesce("long_title", F.lit("")).alias("long_title"), F.coalesce(keywords(F.col("subjects"), False), F.array().cast("array<string>")).alias("subject_keywords"),
        F.when(differs, F.array("query")).otherwise(F.array().cast("array<string>")).alias("aliases"), F.coalesce("doc_type", F.lit("act")).alias("doc_type"),
    )


def citation_index(entries: DataFrame) -> DataFrame:
    """name, frbr_uri, title_id: every name and alias once; a canonical name goes before an alias, among equals the first entry.

    entries: entry_id, title_id, name, aliases, frbr_uri. Hot names meet one row per name only, combined before the shuffle.
    """
    names = entries.select("name", F.lit(0).alias("is_alias"), "entry_id", "frbr_uri", "title_id")
    aliases = entries.select(F.explode("aliases").alias("name"), F.lit(1).alias("is_alias"), "entry_id", "frbr_uri", "title_id")
    both = names.unionByName(aliases).where("name IS NOT NULL")
    return both.groupBy("name").agg(F.min_by(F.struct("frbr_uri", "title_id"), F.struct("is_alias", "entry_id")).alias("b")).select("name", "b.*")


def merge_titles(entries: DataFrame, canonical: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, orphans): one entry per title_id, the canonically named one, with all other names and aliases; and the entries given up.

    canonical: title_id, name. Titles of which no entry bears the canonical
    name keep their entries apart, with conflict true. Entries without a
    title_id stay as they are.
    """
    c = canonical.select("title_id", F.col("name").alias("canonical")).dropDuplicates(["title_id"])
    e = entries.select("entry_id", "title_id", "name", "slug", "xml_path", "aliases").where("title_id IS NOT NULL").join(c, "title_id", "left")
    per = e.groupBy("title_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("entry_id", F.struct(F.coalesce(F.col("name") != F.col("canonical"), F.lit(True)), "entry_id")).alias("keep"), F.coalesce(F.bool_or(F.col("name") == F.col("canonical")), F.lit(False)).alias("found"))
    j = settled(e.join(per, "title_id"), "titles")
    lone = (F.col("n") == 1) | ~F.col("found")
    keeps = lone | (F.col("entry_id") == F.col("keep"))
    others = (
        j.where(~lone).select("title_id", F.explode(F.array_compact(F.concat(F.when(F.col("entry_id") == F.col("keep"), F.array().cast("array<string>")).otherwise(F.array("name")), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("x"), "canonical")
        .where("x <> canonical").select("title_id", "x").distinct().groupBy("title_id").agg(F.array_sort(F.collect_list("x")).alias("merged"))
    )
    merged = j.where(keeps).join(others, "title_id", "left").select(
        "entry_id", "title_id", "name", F.when(lone, F.array_sort(F.coalesce("aliases", F.array().cast("array<string>")))).otherwise(F.coalesce("merged", F.array().cast("array<string>"))).alias("aliases"), (~F.col("found") & (F.col("n") > 1)).alias("conflict")
    )
    orphans = j.where(~keeps).select("entry_id", "slug", "xml_path", F.concat(F.lit("reports/"), "slug", F.lit("-v[0-9]*.json")).alias("report_glob"), F.array(F.concat(F.lit("docx/"), "slug", F.lit("-c[0-9]*-vol*.docx")), F.concat(F.lit("docx/"), "slug", F.lit("-vol[0-9]*.docx"))).alias("docx_globs"))
    return merged, orphans


def upsert(existing: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """The index after incoming entries came in one by one, each in place of the entry of its slug and of those of its title under another slug.

    Both: slug, title_id, name, aliases; order is a whole number of incoming,
    needed where a slug or title comes in more than once. What gave way to its
    own title under another slug leaves its names as aliases, through any number
    of renamings. As in the reference, what is overwritten under its own slug
    leaves none.
    """
    cols = ["slug", "title_id", "name", "aliases"]
    e = existing.select(*cols, F.lit(-(2**62)).alias("o")).unionByName(incoming.select(*cols, (F.col(order) if order else F.lit(0)).cast("bigint").alias("o")))
    after = lambda key: W.partitionBy(key).orderBy(F.desc("o")).rangeBetween(W.unboundedPreceding, -1)
    e = e.withColumn("taken", F.min("o").over(after("slug"))).withColumn("next", F.min(F.struct("o", "slug")).over(after("title_id")))
    handed = F.col("next").isNull() | (F.coalesce(F.col("next.o") <= F.col("taken"), F.lit(True)) & (F.col("next.slug") != F.col("slug")))
    e = e.withColumn("handed", handed).withColumn("kept", F.col("handed") & F.coalesce(F.min("handed").over(after("title_id")), F.lit(True)))
    none = F.array().cast("array<string>")
    old = e.where("next IS NOT NULL AND kept").select("title_id", F.explode(F.array_union(F.array("name"), F.coalesce("aliases", none))).alias("x")).groupBy("title_id").agg(F.collect_set("x").alias("old"))
    live = e.where("next IS NULL AND taken IS NULL").join(old, "title_id", "left")
    both = F.array_union(F.coalesce("aliases", none), F.coalesce("old", none))
    return live.select("slug", "title_id", "name", F.array_sort(F.when(F.col("o") == -(2**62), F.coalesce("aliases", none)).otherwise(F.filter(both, lambda x: x != F.col("name")))).alias("aliases"))


def new_titles(live: DataFrame, corpus: DataFrame, excluded: DataFrame, limit: int | None = None) -> DataFrame:
    """name of live titles that the corpus lacks and no list or pattern excludes, each once, sorted; limit is the feature of a candidate list."""
    left = live.where(~F.col("name").rlike(java(LOW_VALUE, True))).select("name").distinct()
    out = left.join(corpus.select("name").distinct(), "name", "left_anti").join(excluded.select("name").distinct(), "name", "left_anti").orderBy("name")
    return out if limit is None else out.limit(limit)


def currency(incoming: DataFrame, index: DataFrame) -> DataFrame:
    """slug, is_current: whether the index has the slug with the same compilation number (two nulls are the same)."""
    i = index.select("slug", F.col("comp_num").alias("have"), F.lit(True).alias("there")).dropDuplicates(["slug"])
    return incoming.select("slug", "comp_num").join(i, "slug", "left").select("slug", (F.coalesce("there", F.lit(False)) & F.col("comp_num").eqNullSafe(F.col("have"))).alias("is_current"))


def glob_to_regex(glob: str) -> str:
    """A file pattern as a regular expression; * crosses folders, as in the upload rules."""
    out = ""
    i = 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and "]" in glob[i:]:
            j = glob.index("]", i)
            out, i = out + glob[i : j + 1].replace("[!", "[^"), j
        else:
            out += "\\" + c if c in r".^$+{}()|\[]" else c
        i += 1
    return f"^{out}$"


def orphan_files(remote: DataFrame, local: DataFrame, ignore: list[str], managed: list[str]) -> DataFrame:
    """path of remote files that are gone locally, without ignored and managed ones."""
    keep = lambda d: d.where(~F.greatest(*[F.col("path").rlike(glob_to_regex(g)).cast("int") for g in ignore], F.lit(0)).cast("boolean")) if ignore else d
    return keep(remote.select("path")).distinct().join(keep(local.select("path")).distinct(), "path", "left_anti").where(~F.col("path").isin(managed))


@F.pandas_udf(StringType())
def short_digest(key: pd.Series) -> pd.Series:
    """Four bytes of BLAKE2b in hex: no engine function has it, so whole batches go through Arrow."""
    return key.map(lambda k: None if k is None else hashlib.blake2b(k.encode(), digest_size=4).hexdigest())


def site_paths(acts: DataFrame) -> DataFrame:
    """title_id, site_path: /akn/au/act/year/number/, with the title id and a digest where several Acts share year and number."""
    many = acts.groupBy("year", "number").agg((F.count(F.lit(1)) > 1).alias("shared"))
    suffix = F.concat(F.lit("-"), F.lower("title_id"), F.lit("-"), short_digest(safe_name(F.col("name"))))
    base = F.concat(F.lit("/akn/au/act/"), F.col("year").cast("string"), F.lit("/"), F.col("number").cast("string"))
    return acts.join(many, ["year", "number"]).select("title_id", F.concat(base, F.when(F.col("shared"), suffix).otherwise(""), F.lit("/")).alias("site_path"))


def export_rows(entries: DataFrame) -> DataFrame:
    """The ten export columns, sorted by slug."""
    return entries.select("slug", "name", "title_id", "comp_id", "comp_num", "year", "number", "effective_date", "xml_path", F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases")).orderBy("slug")


def first_by(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group; Spark prunes each task's share before the shuffle."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


