"""References to records that do not exist: a sorted merge of references with the validity of their parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.session import settled
from statuta.functions.skew import SALT, hot_keys, salt_few, salt_many

#: Rows of one key that one task may take; a key with more is spread.
ROWS_PER_TASK = 200_000
#: Order of rows of one key at one instant: that the key is known at all, ends of validity, beginnings, references.
_KNOWN, _END, _BEGIN, _REF = 0, 1, 2, 3


def dangling(refs: DataFrame, parents: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """References that meet no parent in being at their time: row_id, at, reason.

    refs has the key columns, row_id (bigint) and at (timestamp_ntz); parents
    the key columns, since and until (null: always, for good). A parent is in
    being at t if since <= t < until. reason is 'missing' if no parent has the
    key, 'deleted' if one had begun by then, else 'late'. A reference with a
    null key refers to nothing and gives no row; one with a null time gives a
    row only if its key is missing. A parent whose until isn't after its since
    is never in being but counts as begun. Repeated parents change nothing.

    Both sides are co-partitioned by key and sorted by time into one stream, in
    which parents are marks (+1 at since, -1 at until); one running sum over it
    tells of each reference whether a parent is open. Hot keys are spread over
    several tasks, with their few parent marks repeated.
    """
    refs = refs.select(*keys, "row_id", F.col("at").cast("timestamp_ntz").alias("at")).dropna(subset=keys)
    parents = parents.select(*keys, F.col("since").cast("timestamp_ntz").alias("since"), F.col("until").cast("timestamp_ntz").alias("until")).dropna(subset=keys).distinct()
    hot = hot_keys(refs, keys, rows_per_task)
    refs, parents = salt_many(refs, hot, keys, ["row_id"]), salt_few(parents, hot, keys)
    lasts = F.col("since").isNull() | F.col("until").isNull() | (F.col("until") > F.col("since"))
    none = F.lit(None).cast("timestamp_ntz")

    def mark(kind: int, at, opened, begun):
        return F.struct(F.lit(kind).alias("kind"), at.alias("at"), F.lit(opened).alias("opened") if isinstance(opened, int) else opened.alias("opened"), F.lit(begun).alias("begun"))

    ends = F.when(lasts & F.col("until").isNotNull(), mark(_END, F.col("until"), -1, 0))
    begins = mark(_BEGIN, F.col("since"), F.when(lasts, 1).otherwise(0), 1)
    marks = parents.select(*keys, SALT, F.explode(F.filter(F.array(mark(_KNOWN, none, 0, 0), ends, begins), lambda m: m.isNotNull())).alias("m")).select(
        *keys, SALT, "m.*", F.lit(None).cast("bigint").alias("row_id")
    )
    stream = marks.unionByName(refs.select(*keys, SALT, F.lit(_REF).alias("kind"), "at", F.lit(0).alias("opened"), F.lit(0).alias("begun"), "row_id"))
    # Times are null for 'known' marks, for parents since ever and for references without a time: nulls sort first.
    running = W.partitionBy(*keys, SALT).orderBy(F.col("at").asc_nulls_first(), "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    told = stream.select(
        "row_id", "at", "kind",
        F.sum("opened").over(running).alias("n_open"),
        F.sum("begun").over(running).alias("n_begun"),
        F.sum((F.col("kind") == _KNOWN).cast("int")).over(running).alias("n_known"),
    )
    reason = F.when(F.col("n_known") == 0, "missing").when(F.col("at").isNull(), None).when(F.col("n_open") > 0, None).when(F.col("n_begun") > 0, "deleted").otherwise("late")
    return told.where(F.col("kind") == _REF).select("row_id", "at", reason.alias("reason")).where("reason IS NOT NULL")


def title_key(c):
    """Title ids compare without case and outer blanks; a blank one is none."""
    return F.nullif(F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), F.lit(""))


def dangling_report_rows(events: DataFrame, reports: DataFrame, acts: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """table_name, row_id, reason, at over both referring tables, with the reports whose stated count is wrong.

    A row delivered twice counts once, by its id. reason 'count' stands for a
    report whose refs_unresolved isn't null and differs from the number of its
    events found here (0 if none).
    """
    being = {"since": F.col("registered_at"), "until": F.col("removed_at")}
    events = events.select("event_id", "report_id", "act_number", "act_year", "recorded_at").dropDuplicates(["event_id"])
    reports = reports.select("report_id", "title_id", "built_at", "refs_unresolved").dropDuplicates(["report_id"])
    of_events = dangling(
        events.select(F.col("act_number").alias("k1"), F.col("act_year").alias("k2"), F.col("event_id").alias("row_id"), F.col("recorded_at").alias("at")),
        acts.select(F.col("number").alias("k1"), F.col("year").alias("k2"), *[c.alias(n) for n, c in being.items()]),
        ["k1", "k2"], rows_per_task,
    )
    of_events = settled(of_events, "dangling")  # few, and told and counted
    of_reports = dangling(
        reports.select(title_key(F.col("title_id")).alias("k1"), F.col("report_id").alias("row_id"), F.col("built_at").alias("at")),
        acts.select(title_key(F.col("title_id")).alias("k1"), *[c.alias(n) for n, c in being.items()]),
        ["k1"], rows_per_task,
    )
    counted = of_events.select(F.col("row_id").alias("event_id")).join(events.select("event_id", "report_id"), "event_id").groupBy("report_id").agg(F.count(F.lit(1)).alias("n"))
    wrong = (
        reports.where("refs_unresolved IS NOT NULL").join(counted, "report_id", "left")
        .where(F.col("refs_unresolved") != F.coalesce("n", F.lit(0)))
        .select(F.lit("parse_reports").alias("table_name"), F.col("report_id").alias("row_id"), F.lit("count").alias("reason"), F.col("built_at").cast("timestamp_ntz").alias("at"))
    )
    named = [d.select(F.lit(t).alias("table_name"), "row_id", "reason", "at") for t, d in (("amendment_events", of_events), ("parse_reports", of_reports))]
    return named[0].unionByName(named[1]).unionByName(wrong)


def dangling_by_month(rows: DataFrame) -> DataFrame:
    """table_name, month (yyyy-mm, null without a time), reason, n."""
    return rows.groupBy("table_name", F.date_format("at", "yyyy-MM").alias("month"), "reason").agg(F.count(F.lit(1)).alias("n"))
