"""History of changing entity attributes, kept up to date by rebuilding the chains that an update touches."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.functions.text import squeeze

#: The end of a version that still holds.
OPEN_END = "9999-12-31"
ATTRS = ["name", "aliases", "comp_num", "effective_date"]
RAW = ["snapshot_id", "title_id", "snapshot_date", "loaded_at", *ATTRS]


def canonical_attributes(df: DataFrame) -> DataFrame:
    """Attributes in the form in which they are compared.

    Runs of white space become one blank. Aliases become a sorted set without
    nulls and blanks (an empty list stays an empty list, which is a value).
    Leading zeros of comp_num go, but '000' stays '0'.
    """
    aliases = F.array_sort(F.array_distinct(F.filter(F.transform("aliases", lambda a: squeeze(a)), lambda a: F.coalesce(a != "", F.lit(False)))))
    return df.withColumns(
        {
            "name": squeeze(F.col("name")),
            "aliases": aliases,
            "comp_num": F.regexp_replace(squeeze(F.col("comp_num")), r"^0+(?=.)", ""),
        }
    )


def build_chains(rows: DataFrame) -> DataFrame:
    """All versions of each title: title_id, the four attributes, valid_from, valid_to (dates as text).

    Rows without title_id or snapshot_date don't count. Of several rows for one
    title and date the one loaded last counts (null loaded_at comes first; of a
    tie the greatest snapshot_id), so repeated rows count once. A null attribute
    keeps its last value; before its first value it is null, and its first
    value then begins a version. An empty table gives an empty history; columns
    besides RAW are ignored.

    Scale: rows shrink to one per (title, date) before they meet in a window,
    combined on the map side, so even a title with a third of all rows leaves
    no more rows for one task than there are distinct dates.
    """
    keyed = rows.select(*RAW).where("title_id IS NOT NULL AND snapshot_date IS NOT NULL")
    last = (
        canonical_attributes(keyed)
        .groupBy("title_id", "snapshot_date")
        .agg(F.max_by(F.struct(*ATTRS), F.struct("loaded_at", "snapshot_id")).alias("a"))
        .select("title_id", "snapshot_date", "a.*")
    )
    w = W.partitionBy("title_id").orderBy("snapshot_date")
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    held = last.select("title_id", "snapshot_date", *[F.last(a, ignorenulls=True).over(so_far).alias(a) for a in ATTRS])
    state: Column = F.struct(*ATTRS)
    starts = held.withColumn("before", F.lag(state).over(w)).where(F.col("before").isNull() | ~F.col("before").eqNullSafe(state))
    return starts.select(
        "title_id",
        *ATTRS,
        F.date_format("snapshot_date", "yyyy-MM-dd").alias("valid_from"),
        F.coalesce(F.date_format(F.lead("snapshot_date").over(w), "yyyy-MM-dd"), F.lit(OPEN_END)).alias("valid_to"),
    )


class Conflict(Exception):
    """Another writer committed first."""


class ChainStore:
    """Raw changes and the history built from them, below one folder.

    Both are kept by bucket of the key, sorted by key within. ``apply`` appends
    the changes, finds the titles they touch, reads only those titles' raw
    changes (the files of their buckets, and in them the row groups that can
    hold the titles), rebuilds their chains whole and writes just these; from
    then on they stand in place of the older chains of the same titles. A
    manifest, written under the next number only if no one else wrote that,
    makes all of it visible at once: a run that dies before leaves the old
    history in place, readers never see part of an update, and of two writers
    the second sees the first one's work and does its own again. So a late or
    corrected row costs the chains it touches, not the history.

    Buckets whose chains were replaced MOST_PARTS times are brought together
    again by ``compact``, which ``apply`` calls for them; ``vacuum`` deletes what
    no manifest needs. The number of buckets follows from the first load and
    ``rebucket`` changes it.
    """

    ROWS_PER_BUCKET = 1_000_000
    MOST_PARTS = 6
    #: So many touched titles are named in the filter of the scan; more are met by a join.
    NAMED = 1_000
    RETRIES = 5

    def __init__(self, spark: SparkSession, root: str, n_buckets: int | None = None):
        self.spark, self.root, self._wanted = spark, root.rstrip("/"), n_buckets
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        found = self._fs.globStatus(self._path(f"{self.root}/MANIFEST-*"))
        return sorted(int(f.getPath().getName().split("-")[1]) for f in found or [])

    def _manifest(self) -> dict:
        versions = self._versions()
        if not versions:
            return {"version": 0, "n_buckets": self._wanted, "raw": {}, "history": {}}
        stream = self._fs.open(self._path(f"{self.root}/MANIFEST-{versions[-1]}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        """Makes a manifest the current one; Conflict if its number is taken."""
        new, at = self._path(f"{self.root}/.new-{uuid.uuid4().hex}"), self._path(f"{self.root}/MANIFEST-{manifest['version']}")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        fs = self.spark._jvm.org.apache.hadoop.fs
        try:
            fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(new, at, self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0))
        except Exception as e:
            self._fs.delete(new, False)
            if self._fs.exists(at):
                raise Conflict(str(at)) from e
            raise

    @staticmethod
    def _next_part(m: dict) -> int:
        """A number beyond all committed ones, whatever the writer's clock says; the clock keeps it apart from those of failed writers."""
        return max([int(time.time() * 1_000_000), *[t + 1 for tags in m["raw"].values() for t in tags]])

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64("title_id"), F.lit(n)).cast("int")

    _ATTRS = "name STRING, aliases ARRAY<STRING>, comp_num STRING, effective_date DATE"
    _SCHEMAS = {
        "raw": f"snapshot_id BIGINT, title_id STRING, snapshot_date DATE, loaded_at TIMESTAMP_NTZ, {_ATTRS}, bucket INT",
        "history": f"title_id STRING, {_ATTRS}, valid_from STRING, valid_to STRING, bucket INT",
    }

    def _read(self, manifest: dict, kind: str, buckets: list[int] | None = None) -> DataFrame:
        """The parts of these buckets (null: all) with part, the number under which each was written."""
        parts: dict[int, list[int]] = {}
        for b, tags in manifest[kind].items():
            if buckets is None or int(b) in buckets:
                for t in tags:
                    parts.setdefault(t, []).append(int(b))
        out = None
        for t, bs in sorted(parts.items()):
            at = f"{self.root}/{kind}/part={t}"
            df = self.spark.read.schema(self._SCHEMAS[kind]).option("basePath", at).parquet(at)
            df = (df if len(bs) == manifest["n_buckets"] else df.where(F.col("bucket").isin(bs))).withColumn("part", F.lit(t).cast("bigint"))
            out = df if out is None else out.unionByName(df)
        return self.spark.createDataFrame([], self._SCHEMAS[kind] + ", part BIGINT") if out is None else out

    def _write(self, df: DataFrame, kind: str, part: int) -> None:
        """By bucket, sorted by title; a bucket with very many rows is shared by several tasks as its size asks."""
        df.hint("rebalance", "bucket").sortWithinPartitions("bucket", "title_id").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{kind}/part={part}")

    @staticmethod
    def _current(rows: DataFrame, manifest: dict) -> DataFrame:
        """Of each title only the chain written last. Later parts hold few titles, which Spark broadcasts if it measures them as small."""
        firsts = {tags[0] for tags in manifest["history"].values()}
        later = sorted({t for tags in manifest["history"].values() for t in tags[1:]} | {t for t in firsts if t != min(firsts, default=0)})
        if not later:
            return rows
        newest = rows.where(F.col("part").isin(later)).groupBy("title_id").agg(F.max("part").alias("newest"))
        return rows.join(newest, "title_id", "left").where(F.col("newest").isNull() | (F.col("newest") == F.col("part"))).drop("newest")

    def apply(self, changes: DataFrame) -> None:
        """Adds changes (late, corrected or new) and replaces the chains they touch. No rows: nothing changes."""
        for _ in range(self.RETRIES):
            try:
                return self._apply(changes)
            except Conflict as e:
                last = e
        raise last

    def _apply(self, changes: DataFrame) -> None:
        m = self._manifest()
        keyed = changes.select(*RAW).where("title_id IS NOT NULL AND snapshot_date IS NOT NULL")
        n = m["n_buckets"]
        if n is None:
            n = 1
            while n * self.ROWS_PER_BUCKET < keyed.count() and n < 1 << 20:
                n *= 2
        part = self._next_part(m)
        self._write(keyed.withColumn("bucket", self._bucket(n)), "raw", part)
        at = f"{self.root}/raw/part={part}"
        new = self.spark.read.schema(self._SCHEMAS["raw"]).option("basePath", at).parquet(at)
        touched = new.select("title_id", "bucket").distinct()
        named = touched.limit(self.NAMED + 1).collect()
        if not named:
            return
        few = len(named) <= self.NAMED
        buckets = sorted({r["bucket"] for r in named} if few else {r[0] for r in touched.select("bucket").distinct().collect()})  # at most n
        if any(str(b) in m["raw"] for b in buckets):
            old = self._read(m | {"n_buckets": n}, "raw", buckets).drop("part")
            old = old.where(F.col("title_id").isin([r["title_id"] for r in named])) if few else old.join(touched.select("title_id"), "title_id", "left_semi")
            new = new.unionByName(old)
        self._write(build_chains(new).withColumn("bucket", self._bucket(n)), "history", part)
        more = lambda kind: m[kind] | {str(b): [*m[kind].get(str(b), []), part] for b in buckets}
        made = {"version": m["version"] + 1, "n_buckets": n, "raw": more("raw"), "history": more("history")}
        self._commit(made)
        full = [b for b in buckets if len(made["history"][str(b)]) > self.MOST_PARTS]
        if full:
            self.compact(full)

    def compact(self, buckets: list[int] | None = None) -> None:
        """Brings the parts of each of these buckets (null: all) together in one; Conflict if another writer came first, which loses nothing."""
        m = self._manifest()
        self._rewrite(m, [int(b) for b in m["history"]] if buckets is None else buckets, m["n_buckets"])

    def rebucket(self, n_buckets: int) -> None:
        """Writes everything anew in another number of buckets."""
        m = self._manifest()
        self._rewrite(m, [int(b) for b in m["history"]], n_buckets)

    def _rewrite(self, m: dict, buckets: list[int], n: int) -> None:
        part = self._next_part(m)
        for kind in ("raw", "history"):
            rows = self._read(m, kind, buckets)
            rows = (self._current(rows, m) if kind == "history" else rows).drop("part").withColumn("bucket", self._bucket(n))
            self._write(rows, kind, part)
        if n == m["n_buckets"]:
            kept = {kind: {b: ([part] if int(b) in buckets else tags) for b, tags in m[kind].items()} for kind in ("raw", "history")}
        else:
            kept = {kind: {str(b): [part] for b in range(n)} for kind in ("raw", "history")}
        self._commit({"version": m["version"] + 1, "n_buckets": n, **kept})

    def vacuum(self) -> None:
        """Deletes parts and manifests that the current manifest doesn't need. Not while others write or read older states."""
        m = self._manifest()
        for kind in ("raw", "history"):
            needed = {t for tags in m[kind].values() for t in tags}
            for f in self._fs.globStatus(self._path(f"{self.root}/{kind}/part=*")) or []:
                if int(f.getPath().getName().split("=")[1]) not in needed:
                    self._fs.delete(f.getPath(), True)
        for v in self._versions():
            if v < m["version"]:
                self._fs.delete(self._path(f"{self.root}/MANIFEST-{v}"), False)

    def history(self) -> DataFrame:
        """The history as the last commit left it."""
        m = self._manifest()
        return self._current(self._read(m, "history"), m).drop("bucket", "part")


#: Years of arrival that are applied one by one as updates; what came before them is the first load.
UPDATES = 2


def load_in_batches(spark: SparkSession, snapshots: DataFrame, root: str, updates: int = UPDATES) -> ChainStore:
    """The history of a whole snapshot table, brought in as it arrived.

    The rows of each of the last years of arrival, with the late and corrected
    ones among them, are applied as an update of what came before. Rows without
    loaded_at belong to the first load.
    """
    last = snapshots.agg(F.year(F.max("loaded_at")).alias("y")).first()["y"]
    store = ChainStore(spark, root)
    if last is None:
        store.apply(snapshots)
        return store
    year = F.coalesce(F.year("loaded_at"), F.lit(0))
    store.apply(snapshots.where(year <= last - updates))
    for y in range(last - updates + 1, last + 1):
        store.apply(snapshots.where(year == y))
    return store
