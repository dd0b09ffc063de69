import random
from datetime import datetime, timedelta

from statuta.operators.references import dangling, dangling_report_rows

T0 = datetime(2020, 1, 1)
REFS = "k1 INT, row_id BIGINT, at TIMESTAMP_NTZ, since STRING"
PARENTS = "k1 INT, since TIMESTAMP_NTZ, until TIMESTAMP_NTZ, row_id STRING"


def brute(refs, parents):
    out = set()
    for k, i, at, *_ in refs:
        if k is None:
            continue
        mine = [p for p in parents if p[0] == k]
        if not mine:
            out.add((i, "missing"))
        elif at is not None and not any((p[1] is None or p[1] <= at) and (p[2] is None or p[2] > at) for p in mine):
            out.add((i, "deleted" if any(p[1] is None or p[1] <= at for p in mine) else "late"))
    return out


def test_against_brute_force_with_a_hot_key(spark):
    rnd = random.Random(1)
    day = lambda: T0 + timedelta(days=rnd.randrange(12))
    maybe = lambda: None if rnd.random() < 0.2 else day()
    parents = [(rnd.randrange(6), maybe(), maybe(), "clash") for _ in range(14)] + [(None, None, None, "x")]
    parents += parents[:3]
    refs = [(rnd.choice([1, 1, 1, 2, 3, 4, 5, 6, 7, None]), i, maybe(), "clash") for i in range(400)]
    for per_task in (1_000_000, 20):
        got = {(r.row_id, r.reason) for r in dangling(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), ["k1"], per_task).collect()}
        assert got == brute(refs, parents)


def test_empty_sides(spark):
    none, refs = spark.createDataFrame([], PARENTS), spark.createDataFrame([(1, 1, T0, "")], REFS)
    assert [r.reason for r in dangling(refs, none, ["k1"]).collect()] == ["missing"]
    assert dangling(spark.createDataFrame([], REFS), none, ["k1"]).count() == 0


def test_reports(spark):
    acts = spark.createDataFrame([("T1", 5, 1999, None, None), ("T2", 6, 1999, T0, T0 + timedelta(days=5)), ("T3", 7, 1999, T0 + timedelta(days=9), None)], "title_id STRING, number INT, year INT, registered_at TIMESTAMP_NTZ, removed_at TIMESTAMP_NTZ")
    at = T0 + timedelta(days=6)
    ev = [(1, 10, 5, 1999, at), (2, 10, 6, 1999, at), (3, 10, 7, 1999, at), (4, 10, 8, 1999, at), (4, 10, 8, 1999, at), (5, 11, None, 1999, at), (6, 11, 6, 1999, T0)]
    rp = [(10, " t1\n", at, 2), (11, "t2", at, 0), (12, "nix", at, None), (13, None, at, 0), (14, " ", at, 1)]
    got = {(r.table_name, r.row_id, r.reason) for r in dangling_report_rows(spark.createDataFrame(ev, "event_id BIGINT, report_id BIGINT, act_number INT, act_year INT, recorded_at TIMESTAMP_NTZ"), spark.createDataFrame(rp, "report_id BIGINT, title_id STRING, built_at TIMESTAMP_NTZ, refs_unresolved INT"), acts).collect()}
    e, p = "amendment_events", "parse_reports"
    assert got == {(e, 2, "deleted"), (e, 3, "late"), (e, 4, "missing"), (p, 10, "count"), (p, 11, "deleted"), (p, 12, "missing"), (p, 14, "count")}
