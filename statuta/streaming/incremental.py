"""Incremental work on landed files, as streams. The rules are those of the batch operators; a stream only feeds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from statuta.operators.history import ChainStore

SNAPSHOTS = "snapshot_id BIGINT, title_id STRING, snapshot_date DATE, loaded_at TIMESTAMP_NTZ, name STRING, aliases ARRAY<STRING>, comp_num STRING, effective_date DATE"


def keep_history(spark: SparkSession, landing: str, store: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Applies snapshot files to a ChainStore as they land, until all that is there is done.

    A batch that is given again after a failure only repeats rows, and repeated
    rows count once, so the history is the same: exactly once in effect. Late
    rows need no watermark, since each batch rebuilds the chains it touches.
    """
    chains = ChainStore(spark, store)

    def step(batch: DataFrame, _: int) -> None:
        chains.apply(batch)

    source = spark.readStream.schema(SNAPSHOTS).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    return source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def build_changed(spark: SparkSession, landing: str, schema: str, build, checkpoint: str) -> StreamingQuery:
    """Calls build(batch) for rows of Acts as they land; build skips what is current (an anti-join on slug and compilation number)."""
    source = spark.readStream.schema(schema).parquet(landing)
    return source.writeStream.foreachBatch(lambda batch, _: build(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
