"""Readers of landed files: register pages, the corpus index, line lists, logs and stored XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions.text import strip

ENTRY = "name STRING, title_id STRING, comp_id STRING, comp_num STRING, year INT, number INT, effective_date STRING, xml_path STRING, aliases ARRAY<STRING>, source_format STRING"
TITLES = "id STRING, name STRING, year STRING, number STRING, longTitle STRING, subjects STRING, collection STRING, isInForce BOOLEAN"
VERSIONS = "titleId STRING, registerId STRING, compilationNumber STRING, start STRING, isLatest BOOLEAN"


def register_pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of landed register pages, each file {"value": [...]}: one file per page and as many tasks as there are files. The schema is always given."""
    pages = spark.read.schema(f"value ARRAY<STRUCT<{', '.join(': '.join(f.strip().split(' ', 1)) for f in schema.split(','))}>>").json(path, multiLine=True)
    return pages.select(F.explode("value").alias("v")).select("v.*")


def titles(spark: SparkSession, path: str) -> DataFrame:
    t = register_pages(spark, path, TITLES)
    return t.select(F.col("id").alias("title_id"), "name", "year", "number", F.col("longTitle").alias("long_title"), "subjects", "collection", F.col("isInForce").alias("is_in_force"))


def versions(spark: SparkSession, path: str) -> DataFrame:
    v = register_pages(spark, path, VERSIONS)
    return v.select(F.col("titleId").alias("title_id"), F.col("registerId").alias("register_id"), F.col("compilationNumber").alias("compilation_number"), F.try_to_date(F.substring("start", 1, 10)).alias("start"), F.col("isLatest").alias("is_latest"))


def corpus_index(spark: SparkSession, path: str) -> DataFrame:
    """Entries of an index file {"acts": {slug: entry}}; missing aliases are an empty list."""
    struct = ", ".join(": ".join(f.strip().split(" ", 1)) for f in ENTRY.split(","))
    j = spark.read.schema(f"acts MAP<STRING, STRUCT<{struct}>>").json(path, multiLine=True)
    e = j.select(F.explode("acts").alias("slug", "e")).select("slug", "e.*")
    return e.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value: the lines of a list, stripped, blank ones dropped."""
    return spark.read.text(path).select(strip(F.col("value")).alias("value")).where("value <> ''")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """log_id (the file), line_no, line of log files; each file is read whole, so the lines keep their order."""
    t = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("log_id"), F.split("value", "\r?\n").alias("ls"))
    return t.select("log_id", F.posexplode("ls").alias("line_no", "line"))


def stored_xml(spark: SparkSession, path: str) -> DataFrame:
    """path, section_eids, dates, subsection_eids of stored documents, by XPath that is blind to namespaces; a broken file gives nulls."""
    t = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    ok = t.where(F.col("value").contains("</akomaNtoso>"))
    x = lambda p: F.xpath("value", F.lit(p))
    read = ok.select("path", x("//section/@eId").alias("section_eids"), x("//FRBRWork/FRBRdate/@date").alias("dates"), x("//subsection/@eId").alias("subsection_eids"))
    return t.select("path").join(read, "path", "left")
