from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from statuta.operators.history import ChainStore, build_chains, load_in_batches
from statuta.session import scratch

SCHEMA = "snapshot_id BIGINT, title_id STRING, snapshot_date DATE, loaded_at TIMESTAMP_NTZ, name STRING, aliases ARRAY<STRING>, comp_num STRING, effective_date DATE, valid_from STRING, bucket INT"


def row(i, t, day, load, name="N", aliases=None, comp="1", eff=date(2000, 1, 1)):
    return (i, t, day, load, name, aliases, comp, eff, "clash", 99)


def brute(rows):
    last = {}
    for r in rows:
        if r[1] is None or r[2] is None:
            continue
        k = (r[1], r[2])
        if k not in last or ((r[3] or datetime.min), r[0]) > ((last[k][3] or datetime.min), last[k][0]):
            last[k] = r
    out, state = set(), {}
    starts = {}
    for (t, day), r in sorted(last.items()):
        norm = lambda s: None if s is None else " ".join(s.split())
        c = norm(r[6])
        now = [norm(r[4]), None if r[5] is None else tuple(sorted({norm(a) for a in r[5] if a and a.strip()})), None if c is None else (c.lstrip("0") or "0" if c else c), r[7]]
        before = state.get(t)
        held = [n if n is not None else (before[i] if before else None) for i, n in enumerate(now)]
        if before is None or held != before:
            starts.setdefault(t, []).append(str(day))
        state[t] = held
    for t, days in starts.items():
        for a, b in zip(days, [*days[1:], "9999-12-31"], strict=True):
            out.add((t, a, b))
    return out


def got(df):
    return {tuple(r) for r in df.select("title_id", "valid_from", "valid_to").collect()}


DAYS = [date(2020, q, 1) for q in (1, 4, 7, 10)]
ROWS = [
    row(1, "A", DAYS[0], datetime(2020, 1, 1), "Old  Act", ["x", "y"], "007"), row(2, "A", DAYS[1], datetime(2020, 4, 1), "Old Act ", ["y", "x", "x", None, " "], "7"),
    row(3, "A", DAYS[2], datetime(2020, 7, 1), "New Act", None, "7"), row(3, "A", DAYS[2], datetime(2020, 7, 1), "New Act", None, "7"),
    row(4, "A", DAYS[3], datetime(2020, 10, 1), "Old Act", [], "7"), row(5, "B", DAYS[0], None, None, None, None, None), row(6, "B", DAYS[1], datetime(2020, 4, 1), "B"),
    row(7, None, DAYS[0], datetime(2020, 1, 1)), row(8, "C", None, datetime(2020, 1, 1)), row(9, "A", DAYS[2], datetime(2020, 7, 2), "Old Act", None, "007"),
]


def test_versions(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert got(build_chains(df)) == brute(ROWS)
    # The correction loaded last undoes the renaming; the empty list of aliases is a change.
    assert {r for r in got(build_chains(df)) if r[0] == "A"} == {("A", "2020-01-01", "2020-10-01"), ("A", "2020-10-01", "9999-12-31")}


def test_empty(spark):
    assert build_chains(spark.createDataFrame([], SCHEMA)).count() == 0
    assert load_in_batches(spark, spark.createDataFrame([], SCHEMA), scratch(spark, "t")).history().count() == 0


def test_update_rebuilds_only_touched_chains(spark):
    store = ChainStore(spark, scratch(spark, "t"), n_buckets=3)
    base = [row(i, t, DAYS[i % 4], datetime(2020, 1 + i % 4, 2), f"{t}{i % 3}") for t in "ABCDE" for i in range(6)]
    late = [row(100, "C", DAYS[1], datetime(2021, 1, 1), "late"), row(101, "F", DAYS[0], datetime(2021, 1, 1), "new")]
    store.apply(spark.createDataFrame(base, SCHEMA))
    before = got(store.history())
    store.apply(spark.createDataFrame(late, SCHEMA))
    after = got(store.history())
    assert after == brute(base + late)
    assert {r for r in before if r[0] not in "CF"} == {r for r in after if r[0] not in "CF"}
    store.apply(spark.createDataFrame(late, SCHEMA))  # a batch given again changes nothing
    assert got(store.history()) == after
    store.apply(spark.createDataFrame([], SCHEMA))
    assert got(store.history()) == after


def test_failed_update_leaves_history(spark, monkeypatch):
    store = ChainStore(spark, scratch(spark, "t"), n_buckets=2)
    store.apply(spark.createDataFrame(ROWS, SCHEMA))
    before = got(store.history())
    monkeypatch.setattr(store, "_commit", lambda m: (_ for _ in ()).throw(RuntimeError))
    with pytest.raises(RuntimeError):
        store.apply(spark.createDataFrame([row(50, "A", DAYS[0], datetime(2022, 1, 1), "Z")], SCHEMA))
    assert got(store.history()) == before


def test_an_update_reads_and_writes_only_what_it_touches(spark):
    store = ChainStore(spark, scratch(spark, "t"), n_buckets=2)
    base = [row(1000 * t + i, f"T{t:03}", DAYS[i], datetime(2020, 1 + i, 2), f"{t} {i}") for t in range(100) for i in range(4)]
    store.apply(spark.createDataFrame(base, SCHEMA))
    late = [row(9_000_000, "T042", DAYS[1], datetime(2021, 1, 1), "late")]
    store.apply(spark.createDataFrame(late, SCHEMA))
    m = store._manifest()
    part = max(t for tags in m["history"].values() for t in tags)
    assert [tags for b, tags in m["history"].items() if part not in tags] and len({t for tags in m["history"].values() for t in tags}) == 2
    written = spark.read.parquet(f"{store.root}/history/part={part}")
    assert written.select("title_id").distinct().collect() == [("T042",)] and written.count() == 4
    assert got(store.history()) == brute(base + late)
    plan = store._read(m, "raw", [0]).where("title_id IN ('T042')")._jdf.queryExecution().toString()
    assert "PushedFilters: [In(title_id, [T042])" in plan or "EqualTo(title_id,T042)" in plan


def test_compaction_buckets_and_vacuum(spark):
    store = ChainStore(spark, scratch(spark, "t"), n_buckets=2)
    store.MOST_PARTS = 2
    rows = []
    for k in range(4):
        more = [row(10 * k + i, t, DAYS[k], datetime(2020, 1 + k, 2), f"{t}{k // 2}") for i, t in enumerate("ABCDE")]
        rows += more
        store.apply(spark.createDataFrame(more, SCHEMA))
        assert got(store.history()) == brute(rows)
    assert max(len(tags) for tags in store._manifest()["history"].values()) <= 2
    store.rebucket(5)
    store.vacuum()
    assert got(store.history()) == brute(rows) and store._versions() == [store._manifest()["version"]]
    store.NAMED = 1
    more = [row(900 + i, t, DAYS[0], datetime(2022, 1, 1), "corrected") for i, t in enumerate("ACX")]
    store.apply(spark.createDataFrame(more, SCHEMA))
    assert got(store.history()) == brute(rows + more)


def test_of_two_writers_none_is_lost(spark, monkeypatch):
    root = scratch(spark, "t")
    one, two = ChainStore(spark, root, n_buckets=1), ChainStore(spark, root, n_buckets=1)
    one.apply(spark.createDataFrame(ROWS, SCHEMA))
    a, b = [row(50, "A", DAYS[0], datetime(2022, 1, 1), "Z")], [row(51, "A", DAYS[1], datetime(2022, 1, 1), "Y")]
    commit, raced = two._commit, []

    def late(m):
        if not raced:
            raced.append(1)
            one.apply(spark.createDataFrame(a, SCHEMA))
        commit(m)

    monkeypatch.setattr(two, "_commit", late)
    two.apply(spark.createDataFrame(b, SCHEMA))
    assert got(two.history()) == brute(ROWS + a + b)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 3), st.integers(1, 20), st.sampled_from([None, "n", "m"]), st.sampled_from([None, "01", "1", "2"])), max_size=25))
def test_batches_equal_brute_force(spark, drawn):
    rows = [row(i, t, DAYS[q], datetime(2020, 1, load), n, None, c) for i, (t, q, load, n, c) in enumerate(drawn)]
    assert got(load_in_batches(spark, spark.createDataFrame(rows, SCHEMA), scratch(spark, "t")).history()) == brute(rows)
