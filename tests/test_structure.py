import xml.etree.ElementTree as ET

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statuta.operators import render
from statuta.operators import structure as s

SCHEMA = (
    "para_id BIGINT, act_id STRING, volume_index INT, pos BIGINT, element_type STRING, number STRING, heading STRING, text STRING, raw_style STRING, table_rows ARRAY<ARRAY<STRING>>, "
    "spans ARRAY<STRUCT<text: STRING, bold: BOOLEAN, italic: BOOLEAN, superscript: BOOLEAN, subscript: BOOLEAN>>"
)


def stream(spark, rows, act="A"):
    """rows: (type, number, text, style, volume)"""
    full = [(*r, *("", "", "", 0)[len(r) - 1 :]) if len(r) < 5 else r for r in rows]
    return spark.createDataFrame([(i, act, r[4], i, r[0], r[1], "", r[2], r[3], None, None) for i, r in enumerate(full)], SCHEMA)


def eids(spark, rows, block=50_000):
    return [r.eid for r in s.hierarchy(stream(spark, rows), block=block).orderBy("pos").collect()]


def test_golden_hierarchy(spark):
    assert eids(spark, [("section", "6"), ("subsec", "1"), ("para", "a"), ("subpara", "i"), ("level4", "AA"), ("section", "7"), ("para", "b")]) == [
        "sec-6", "sec-6__subsec-1", "sec-6__subsec-1__para-a", "sec-6__subsec-1__para-a__subpara-i", "sec-6__subsec-1__para-a__subpara-i__level4-aa", "sec-7", "sec-7__para-b",
    ]


TYPES = list(s.DEPTH)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([*TYPES, "body"]), max_size=40), st.integers(1, 7))
def test_hierarchy_is_a_stack_in_any_blocks(spark, types, block):
    stack, want = [], []
    for i, t in enumerate(types):
        if t == "body":
            continue
        while stack and s.DEPTH[stack[-1][0]] >= s.DEPTH[t]:
            stack.pop()
        stack.append((t, f"{s.PREFIX[t]}-{i}"))
        want.append("__".join(x for _, x in stack))
    assert eids(spark, [(t, str(i)) for i, t in enumerate(types)] or [("body", "")], block) == want


def test_regions_across_volumes(spark):
    head = ("body", "", "Schedule 1—Rates", "ActHead 1")
    def run(rows):
        return [(r.region, r.schedule_no) for r in s.regions(stream(spark, rows)).orderBy("pos").collect()]

    assert run([("body", "", "WHEREAS"), ("section", "1"), (*head, 0), ("body", "", "x", "", 1), (*head, 1)]) == [("preface", None), ("body", None), ("schedule", 1), ("schedule", 1), ("schedule", 2)]
    # Schedules first: the body may still come in a later volume, and schedules after it.
    assert run([(*head, 0), ("body", "", "x", "", 0), ("section", "1", "", "", 1), (*head, 1), ("body", "", "y", "", 2)]) == [("schedule", 1), ("schedule", 1), ("body", None), ("schedule", 2), ("schedule", 2)]
    # Prose that only begins like a schedule heading is no heading.
    assert run([("section", "1"), ("body", "", "Schedule 1 to the Act applies", "subsection")]) == [("body", None)] * 2


def test_quotes(spark):
    rows = [("body", "", "“"), ("section", "1"), ("subsec", "1"), ("body", "", "”"), ("body", "", "'"), ("section", "2"), ("section", "3"), ("body", "", "'"), ("body", "", '"')]
    got = [(r.quote_no, r.n_rows, r.n_top, r.handled) for r in s.quotes(stream(spark, rows)).orderBy("quote_no").collect()]
    assert got == [(1, 2, 1, True), (2, 2, 2, False)]


def test_ambiguous_paras(spark):
    def run(rows):
        return [r.element_type for r in s.resolve_ambiguous(stream(spark, rows)).orderBy("pos").collect()]

    assert run([("section", "5"), ("para", "a", ""), ("para", "l", "x")]) == ["section", "para", "subpara"]
    assert run([("section", "5"), ("para", "a", "text"), ("para", "l", "x")]) == ["section", "para", "para"]


def test_lists(spark):
    rows = [("section", "5"), ("list-item", "0", "(a) one"), ("list-item", "0", "two"), ("list-item", "1", "(i) in"), ("body", "", "x"), ("list-item", "1", "y"), ("section", "6"), ("list-item", "0", "z")]
    got = [(r.list_no, r.item_no, r.num, r.text) for r in s.block_lists(stream(spark, rows)).orderBy("pos").collect()]
    assert got == [(1, 1, "(a)", "one"), (1, 2, None, "two"), (2, 1, "(i)", "in"), (3, 1, None, "y"), (1, 1, None, "z")]


def schedule_walk(items):
    """The state machine over a schedule, one row at a time."""
    clause = sub = para = None
    n, out = 0, []
    for kind, num in items:
        top = "schedule-1"
        if kind in ("app", "clause"):
            n += 1
            clause, sub, para = f"{top}__clause-{n if kind == 'app' else num}", None, None
            out.append(clause)
        elif kind == "dotted":
            sub, para = f"{clause or top}__subclause-{num.replace('.', '-')}", None
            out.append(sub)
        elif kind == "subsec":
            out.append(f"{sub or clause or top}__subclause-{num}")
            para = None
        elif kind == "para":
            para = f"{sub or clause or top}__para-{num}"
            out.append(para)
        elif kind == "subpara":
            out.append(f"{para or sub or clause or top}__subpara-{num}")
    return out


KIND = {"app": lambda n: ("body", "", f"APP {n} — Open management"), "clause": lambda n: ("section", n), "dotted": lambda n: ("section", n), "subsec": lambda n: ("subsec", n, "t"), "para": lambda n: ("para", n, "t"), "subpara": lambda n: ("subpara", n, "t")}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(list(KIND)), min_size=1, max_size=30))
def test_schedule_items(spark, kinds):
    items = [(k, f"{i}.1" if k == "dotted" else str(i)) for i, k in enumerate(kinds)]
    rows = [("section", "1"), ("body", "", "Schedule 1—X", "ActHead 1")] + [KIND[k](n) for k, n in items]
    got = [r.eid for r in s.schedule_items(s.regions(stream(spark, rows))).orderBy("pos").collect()]
    assert got == schedule_walk(items)


def test_empty_streams(spark):
    e = spark.createDataFrame([], SCHEMA)
    for f in (s.hierarchy, s.regions, s.quotes, s.block_lists, s.content_groups, s.resolve_ambiguous, s.table_cells):
        assert f(e).count() == 0
