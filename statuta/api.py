"""What a user runs, one function each: build, update, list, export, site."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.operators import annotate, corpus, markup, structure
from statuta.session import settled
from statuta.sources import docx, readers, sinks


def paragraph_stream(spark: SparkSession, docx_folder: str) -> DataFrame:
    """The classified stream of all whole Acts in a folder of documents, with pos over all volumes."""
    rows = docx.paragraphs(docx.whole_acts(docx.load(spark, docx_folder)))
    return settled(rows.where("element_type <> 'skip'").withColumn("pos", (F.col("volume_index").cast("bigint") * F.lit(1 << 40)) + F.col("ord") * 2 + F.col("part_no")))


def build(stream: DataFrame, citation_index: DataFrame, acts: DataFrame, events: DataFrame, made_on: str) -> dict[str, DataFrame]:
    """Every relation of a batch of Acts: nodes, regions, annotations, terms, the XML in fragments and the parse report. See markup.documents."""
    regions = settled(structure.regions(settled(structure.resolve_ambiguous(stream))))
    body = regions.where("region = 'body'")
    nodes = structure.hierarchy(body)
    made = markup.documents(regions, acts, citation_index, events, made_on)
    return {
        "regions": regions, "nodes": nodes, "quotes": structure.quotes(body), "lists": structure.block_lists(body), "schedules": structure.schedule_items(regions),
        "references": annotate.resolve_names(annotate.references(stream), citation_index), "quantities": annotate.quantities(stream), "dates": annotate.dates(stream),
        "roles": annotate.roles(stream), "note_refs": annotate.note_refs(stream), "terms": made["terms"], "xml": made["fragments"], "report": made["report"],
    }


def update(spark: SparkSession, titles: DataFrame, versions: DataFrame, index: DataFrame, since: str) -> DataFrame:
    """title_id, name of Acts of the corpus that changed since a day."""
    return corpus.modified_since(versions, titles, since).join(index.select("name").distinct(), "name", "left_semi")


def list_acts(spark: SparkSession, titles_path: str) -> DataFrame:
    return corpus.listed(readers.titles(spark, titles_path), True)


def list_instruments(spark: SparkSession, titles_path: str) -> DataFrame:
    return corpus.listed(readers.titles(spark, titles_path), False)


def export_jsonl(spark: SparkSession, index_path: str, out: str) -> None:
    sinks.export_jsonl(readers.corpus_index(spark, index_path), out)


def site(spark: SparkSession, acts: DataFrame, stream: DataFrame, out: str) -> None:
    sinks.site(acts, stream, out)
