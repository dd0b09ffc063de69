"""The best representative of each duplicate group, field by field: by the order the result asks for, or by weighted token consensus."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from statuta.functions.skew import SALT, hot_keys, salt_few, salt_many
from statuta.functions.text import strip

FIELDS = ["name", "comp_num", "effective_date", "frbr_uri"]
# What stands for "no value", compared without case and outer blanks.
STAND_INS = [
    "", "-", "--", "---", "–", "—", ".", "...", "?", "??", "???", "n/a", "n.a.", "n.a", "na", "nan", "nil", "none", "(none)", "null", "(null)",
    "<null>", "unknown", "(unknown)", "tbc", "tba", "tbd", "not available", "not known", "not stated", "not applicable", "not given", "not set",
    "unspecified", "undefined", "untitled", "(untitled)", "no title", "missing", "(blank)", "blank",
]
#: Fields of a survivor that the required order doesn't settle: the consensus chooses their value.
VOTED = ["slug", "comp_id", "year", "number", "xml_path"]
#: Distinct values of one field of one title that one task aligns; a title with more votes in two rounds.
VALUES_PER_TASK = 2_000
ROWS_PER_TASK = 200_000
STRINGS = "array<string>"


def absent(c: Column) -> Column:
    """Null, blank, or a stand-in for no value."""
    return F.coalesce(F.lower(strip(c)).isin(STAND_INS), F.lit(True))


def dateless(c: Column) -> Column:
    """Absent, or without a letter or a digit but 0, as in '0000-00-00': no date."""
    return absent(c) | ~c.rlike(r"(?U)[^\W_0]")


def title_of(c: Column) -> Column:
    """A title id in upper case without blanks; null where it is absent."""
    return F.when(~absent(c), F.upper(F.regexp_replace(c, r"(?U)\s+", "")))


def _rank(trust: Column) -> Column:
    """The order of entries: highest trust, then latest fetched_at (null last), then least entry_id."""
    return F.struct((-F.coalesce(trust, F.lit(0))).alias("t"), F.col("fetched_at").isNull().alias("n"), F.coalesce(-F.unix_micros(F.col("fetched_at").cast("timestamp")), F.lit(0)).alias("f"), F.col("entry_id").alias("e"))


def _read(entries: DataFrame, trust: DataFrame, fields: list[str]) -> DataFrame:
    """entry_id, own (the title id, null where absent), name, aliases, rank, weight and the fields, null where absent.

    Trust is joined as a table; Spark broadcasts it if it measures it as small.
    """
    t = trust.select(F.lower(strip(F.col("source_format"))).alias("fmt"), "trust").dropna().groupBy("fmt").agg(F.max("trust").alias("trust"))
    e = entries.select(*dict.fromkeys(["entry_id", "title_id", "name", "aliases", "source_format", "fetched_at", *fields])).withColumns({f: F.col(f).cast("string") for f in fields})
    e = e.withColumns({f: F.when(~(dateless if f == "effective_date" else absent)(F.col(f)), F.col(f)) for f in dict.fromkeys(["name", *fields])})
    e = e.withColumns({"own": title_of(F.col("title_id")), "fmt": F.lower(strip(F.col("source_format"))), "aliases": F.filter("aliases", lambda a: ~absent(a))})
    e = e.join(t, "fmt", "left")
    return e.select("entry_id", "own", "aliases", _rank(F.col("trust")).alias("rank"), (1 + F.greatest(F.coalesce("trust", F.lit(0)), F.lit(0))).alias("weight"), *dict.fromkeys(["name", *fields]))


def _names() -> Column:
    """The name and the aliases of an entry."""
    return F.array_compact(F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast(STRINGS))))


def _borne(e: DataFrame) -> DataFrame:
    """name, title: names and aliases that just one title bears, by its entries that have a title_id."""
    named = e.where("own IS NOT NULL").select("own", F.explode(_names()).alias("name"))
    return named.groupBy("name").agg(F.min("own").alias("title"), F.max("own").alias("other")).where("title = other").drop("other")


def surviving(entries: DataFrame, trust: DataFrame, values: bool = False) -> DataFrame:
    """title_id, field_name, entry_id (values: and value): the entry that supplies each of FIELDS, for titles with two or more entries.

    An entry delivered twice counts once, by its id. One without title_id
    belongs to the title whose entries with a title_id bear its name, exactly,
    as name or alias, if that is just one title; else it is left out. Of the
    entries that have the value the first in the order of _rank supplies it;
    fields absent in all entries give no row. Null, blank and stand-in values
    are absent; an empty table gives no row.

    The order is total, so no vote can have a say in it: this is a minimum per
    title, combined on the map side. Entries without a title_id are brought to
    one row per name before they meet the names, so neither a hot title nor a
    hot name gathers more than one row per input partition.
    """
    e = _read(entries, trust, FIELDS)
    best = {f: F.when(F.col(f).isNotNull(), F.struct("rank", F.col(f).alias("value")) if values else F.struct("rank")) for f in FIELDS}
    first, last = F.min("lo").alias("lo"), F.max("hi").alias("hi")
    picked = e.select("own", "name", F.col("entry_id").alias("lo"), F.col("entry_id").alias("hi"), *[c.alias(f"b_{f}") for f, c in best.items()])
    least = [F.min(f"b_{f}").alias(f"b_{f}") for f in FIELDS]
    lone = picked.where("own IS NULL AND name IS NOT NULL").groupBy("name").agg(first, last, *least).join(_borne(e), "name").drop("name")
    both = picked.where("own IS NOT NULL").withColumnRenamed("own", "title").drop("name").unionByName(lone)
    won = both.groupBy("title").agg(first, last, *least).where("lo <> hi")
    rows = won.select(F.col("title").alias("title_id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"b_{f}.rank.e").alias("entry_id"), *([F.col(f"b_{f}.value").alias("value")] if values else [])) for f in FIELDS])).alias("v"))
    return rows.select("title_id", "v.*").where("entry_id IS NOT NULL")


def grouped(entries: DataFrame, trust: DataFrame, fields: list[str]) -> DataFrame:
    """title, entry_id, rank, weight, name, aliases, fields: each entry once with the title it belongs to (as in surviving), the rest left out.

    Entries that share a hot name are spread over several tasks.
    """
    e = _read(entries.dropDuplicates(["entry_id"]), trust, fields)
    lone = e.where("own IS NULL AND name IS NOT NULL").drop("own")
    hot = hot_keys(lone, ["name"], ROWS_PER_TASK)
    placed = salt_many(lone, hot, ["name"], ["entry_id"]).join(salt_few(_borne(e), hot, ["name"]), ["name", SALT]).drop(SALT)
    return e.where("own IS NOT NULL").withColumnRenamed("own", "title").unionByName(placed)


_PART = re.compile(r"\w+|[^\w\s]")


def tokens_of(value: str) -> list[str]:
    return _PART.findall(value)


def decide(said: list[list[str]], weights: list[int]) -> list[str]:
    """The token consensus of sequences: they are aligned one after another, the heaviest first, into columns (token or gap,
    each with the weight of those who say so), and every column is decided by weight; of a tie a token goes before a gap,
    then the greater one."""
    order = sorted(range(len(said)), key=lambda i: (-weights[i], said[i]))
    first = order[0]
    columns: list[dict[str | None, int]] = [{t: weights[first]} for t in said[first]]
    total = weights[first]
    for i in order[1:]:
        columns = _align(columns, said[i], weights[i], total)
        total += weights[i]
    return [t for t in (max(c, key=lambda k: (c[k], k is not None, k or "")) for c in columns) if t is not None]


def _align(columns: list[dict[str | None, int]], tokens: list[str], weight: int, total: int) -> list[dict[str | None, int]]:
    """Columns with one more sequence aligned into them: least weight of disagreement, pairs before gaps."""
    begin = 0
    while begin < min(len(columns), len(tokens)) and columns[begin] == {tokens[begin]: total}:
        begin += 1
    if begin:  # what all agree on from the start needs no table
        return [{t: total + weight} for t in tokens[:begin]] + _align(columns[begin:], tokens[begin:], weight, total)
    n, m = len(columns), len(tokens)
    gap = [total - c.get(None, 0) for c in columns]
    cost = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(1, n + 1):
        cost[i][0] = cost[i - 1][0] + gap[i - 1]
    for j in range(1, m + 1):
        cost[0][j] = cost[0][j - 1] + total
        for i in range(1, n + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + total - columns[i - 1].get(tokens[j - 1], 0), cost[i - 1][j] + gap[i - 1], cost[i][j - 1] + total)
    out: list[dict[str | None, int]] = []
    i, j = n, m
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + total - columns[i - 1].get(tokens[j - 1], 0):
            i, j, said, column = i - 1, j - 1, tokens[j - 1], dict(columns[i - 1])
        elif i and cost[i][j] == cost[i - 1][j] + gap[i - 1]:
            i, said, column = i - 1, None, dict(columns[i - 1])
        else:
            j, said, column = j - 1, tokens[j - 1], {None: total}
        column[said] = column.get(said, 0) + weight
        out.append(column)
    return out[::-1]


def distance(a: list[str], b: list[str]) -> int:
    """Token edit distance."""
    begin = 0
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    a, b = a[begin:], b[begin:]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _decided(rows: DataFrame) -> DataFrame:
    """title, field_name, tokens, weight of title, field_name, said (array of tokens and weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = b.column(2).to_pylist()
            out = [decide([x["tokens"] for x in v], [x["weight"] for x in v]) for v in said]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.string())), pa.array([sum(x["weight"] for x in v) for v in said], pa.int64())], ["title", "field_name", "tokens", "weight"])

    return rows.select("title", "field_name", "said").mapInArrow(run, "title STRING, field_name STRING, tokens ARRAY<STRING>, weight BIGINT")


def consensus(members: DataFrame, fields: list[str], values_per_task: int = VALUES_PER_TASK) -> DataFrame:
    """title_id, field_name, entry_id, value, n_values: of each title with two or more entries and each field the existing value
    closest to the consensus of all its values, and the first entry (in the order of _rank) that has it.

    Every distinct value votes with the summed weight of its entries (1 + trust
    each), so several entries of little trust can outvote one of much. Values
    are aligned token by token (see decide); the value of least edit distance to
    the decided sequence wins, of a tie the one with the best-ranked entry. A
    field absent in all entries gives no row.

    members is the result of grouped. Values come together as one row per
    distinct value, combined on the map side, at most values_per_task of them
    in one task: beyond that the values of a title are dealt by hash, each part
    decides, and the decided sequences vote again with the weight of their
    part. Distances are taken where the values are. No value is left out.
    """
    keys = ["title", "field_name"]
    several = members.groupBy("title").agg(F.min("entry_id").alias("a"), F.max("entry_id").alias("b")).where("a <> b").select("title")
    said = (
        members.select("title", "rank", "weight", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields])).alias("v"))
        .select("title", "rank", "weight", "v.*").where("value IS NOT NULL").groupBy(*keys, "value").agg(F.min("rank").alias("rank"), F.sum("weight").cast("bigint").alias("weight")).join(several, "title", "left_semi")
    )
    hot = hot_keys(said, keys, values_per_task)
    tokens = F.regexp_extract_all("value", F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0))
    dealt = salt_many(said, hot, keys, ["value"]).withColumn("tokens", tokens)
    heard = lambda d: F.array_sort(F.collect_list(F.struct("tokens", F.col("weight").cast("bigint").alias("weight")))).alias("said")
    parts = _decided(dealt.groupBy(*keys, SALT).agg(heard(dealt)))
    told = _decided(parts.groupBy(*keys).agg(heard(parts))).select(*keys, F.col("tokens").alias("decided"))
    near = dealt.join(salt_few(told, hot, keys), [*keys, SALT]).select(*keys, "value", "rank", "tokens", "decided")

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = [distance(x, y) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(d, pa.int32())], ["title", "field_name", "value", "rank", "distance"])

    kinds = dict(near.dtypes)
    off = near.mapInArrow(far, f"title STRING, field_name STRING, value STRING, rank {kinds['rank']}, distance INT")
    won = off.groupBy(*keys).agg(F.min(F.struct("distance", "rank", "value")).alias("w"), F.count(F.lit(1)).alias("n_values"))
    return won.select(F.col("title").alias("title_id"), "field_name", F.col("w.rank.e").alias("entry_id"), F.col("w.value").alias("value"), "n_values")


def survivors(entries: DataFrame, trust: DataFrame) -> DataFrame:
    """title_id, n_entries, name, comp_num, effective_date, frbr_uri, slug, comp_id, year, number, xml_path, aliases: one row per title with two or more entries.

    The first four come from the entry that the required order puts first, the
    others by consensus. aliases are all other names and aliases of the title's
    entries, sorted.
    """
    wide = lambda d, fs: d.groupBy("title_id").agg(*[F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f) for f in fs])
    members = grouped(entries, trust, VOTED)
    fields = wide(surviving(entries, trust, True), FIELDS)
    voted = wide(consensus(members, VOTED), VOTED).withColumns({c: F.col(c).cast("int") for c in ("year", "number")})
    names = members.select("title", F.explode(_names()).alias("x")).distinct().groupBy(F.col("title").alias("title_id")).agg(F.array_sort(F.collect_list("x")).alias("borne"))
    counts = members.groupBy(F.col("title").alias("title_id")).agg(F.count(F.lit(1)).alias("n_entries")).where("n_entries > 1")
    joined = counts.join(fields, "title_id", "left").join(voted, "title_id", "left").join(names, "title_id", "left")
    return joined.select("title_id", "n_entries", *FIELDS, *VOTED, F.array_remove(F.coalesce("borne", F.array().cast(STRINGS)), F.coalesce("name", F.lit(""))).alias("aliases"))


def compared(entries: DataFrame, trust: DataFrame) -> DataFrame:
    """title_id, field_name, entry_id, value, n_values, same_as_order: the consensus of every field beside the required order.

    same_as_order is null for fields that the order doesn't settle, else
    whether the value that the order puts first is the consensus.
    """
    c = consensus(grouped(entries, trust, [*FIELDS, *VOTED]), [*FIELDS, *VOTED])
    o = surviving(entries, trust, True).select("title_id", "field_name", F.col("value").alias("first"))
    return c.join(o, ["title_id", "field_name"], "left").select("title_id", "field_name", "entry_id", "value", "n_values", (F.col("value") == F.col("first")).alias("same_as_order"))
