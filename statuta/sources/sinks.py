"""Writers. Each overwrites its target whole, so a run can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.operators import corpus, quality, render, structure
from statuta.session import settled


def export_jsonl(entries: DataFrame, path: str) -> None:
    """One JSON object per entry, sorted by slug over all part files; nulls are written as null."""
    corpus.export_rows(entries).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def names(df: DataFrame, path: str) -> None:
    df.select("name").orderBy("name").write.mode("overwrite").text(path)


def reports(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def akn(fragments: DataFrame, path: str) -> None:
    """Each Act as one text file below act_id=…, its fragments one after another; they are streamed, never held together."""
    df = fragments.repartition("act_id").sortWithinPartitions("act_id", "part", "ord")
    df.select("act_id", "xml").write.mode("overwrite").option("lineSep", "\n").partitionBy("act_id").text(path)


def _versions(spark: SparkSession, root: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/index/version=*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


INDEX = "slug STRING, title_id STRING, name STRING, aliases ARRAY<STRING>, xml_version BIGINT"


def corpus_index(spark: SparkSession, root: str) -> DataFrame:
    """The index as the last whole write left it: slug, title_id, name, aliases and the version its XML lies under; empty before the first."""
    versions = _versions(spark, root)
    return spark.read.schema(INDEX).parquet(f"{root}/index/version={versions[-1]}") if versions else spark.createDataFrame([], INDEX)


def write_corpus(spark: SparkSession, root: str, incoming: DataFrame, fragments: DataFrame, order: str | None = None) -> None:
    """Takes built Acts into a corpus folder: their XML, then a new version of the index (see corpus.upsert), which makes both visible at once.

    incoming: slug, title_id, name, aliases and the order column; fragments have
    the slug as act_id. XML of entries that gave way stays until delete_given_up.
    A write that dies before its index is whole changes nothing for readers.
    """
    n = (_versions(spark, root) or [0])[-1] + 1
    have = corpus_index(spark, root)
    index = corpus.upsert(have, incoming, order)
    new = incoming.select("slug").distinct().withColumn("is_new", F.lit(True))
    index = index.join(have.select("slug", F.col("xml_version").alias("old")), "slug", "left").join(new, "slug", "left")
    akn(fragments, f"{root}/xml/version={n}")
    index.select("slug", "title_id", "name", "aliases", F.when(F.col("is_new"), F.lit(n)).otherwise(F.col("old")).cast("bigint").alias("xml_version")).write.mode("overwrite").parquet(f"{root}/index/version={n}")


def given_up(spark: SparkSession, root: str) -> DataFrame:
    """path of XML files that no entry of the index has any more."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{root}/xml").select("path")
    p = r"/version=(\d+)/act_id=([^/]+)/"
    told = files.select("path", F.regexp_extract("path", p, 1).cast("bigint").alias("xml_version"), F.url_decode(F.regexp_replace(F.regexp_extract("path", p, 2), r"\+", "%2B")).alias("slug"))
    return told.join(corpus_index(spark, root).select("slug", "xml_version"), ["slug", "xml_version"], "left_anti").select("path")


def delete_given_up(spark: SparkSession, root: str) -> int:
    """Deletes them, one after another as they come; returns how many. Not while someone reads an older version."""
    fs = spark._jvm.org.apache.hadoop.fs
    n = 0
    for row in given_up(spark, root).toLocalIterator():
        path = fs.Path(row.path)
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False))
    return n


def site(acts: DataFrame, paragraphs: DataFrame, path: str) -> None:
    """The index page's lines and one page per Act below act_id=…; paragraphs is the stream, its act_id the title_id of acts."""
    render.act_links(acts.select("title_id", "name"), corpus.site_paths(acts)).select("html").write.mode("overwrite").text(f"{path}/index")
    s = settled(paragraphs, "stream")
    pages = render.act_pages(acts.select(F.col("title_id").alias("act_id"), "name"), render.browse_nodes(structure.hierarchy(s), s), render.html_paragraphs(s))
    pages.repartition("act_id").sortWithinPartitions("act_id", "ord").select("act_id", F.col("html").alias("value")).write.mode("overwrite").partitionBy("act_id").text(f"{path}/acts")


def relevance_skim(df: DataFrame, path: str) -> None:
    """A check list in Markdown, one line per title of the sample."""
    mark = F.concat(F.lit("- [ ] "), F.col("name"), F.lit(" ("), quality.era(F.col("name")), F.lit(")"))
    df.orderBy("name").select(mark.alias("value")).write.mode("overwrite").text(path)
