"""Session settings and the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SHARED: dict[str, str] = {}
_RELEASED_AT_EXIT: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    and the master is local (tests) is a temporary folder made and set; on a
    cluster without the setting an error is raised, since a machine-local
    folder would be lost with its machine.
    """
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        set_to = _LOCAL_SHARED.setdefault(app, tempfile.mkdtemp(prefix="statuta-"))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(set_to)
    return set_to.rstrip("/")


def settled(df: DataFrame, label: str = "settled") -> DataFrame:
    """df written below the shared folder and read again: what builds on it starts from a scan, not from all that led to it."""
    at = scratch(df.sparkSession, label)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def _own(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/statuta-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in a part of it that belongs to this application and is deleted when it ends."""
    at = _own(spark)
    if at not in _RELEASED_AT_EXIT:
        _RELEASED_AT_EXIT.add(at)
        atexit.register(_release, spark, at)
    return f"{at}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Deletes every table that scratch and settled wrote for this application. Relations built on them can't be read any more."""
    _release(spark, _own(spark))


def _release(spark: SparkSession, at: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the session may be gone before its last tables are; then only a local folder can still go
        shutil.rmtree(at.removeprefix("file:"), ignore_errors=True)
