import random
from datetime import datetime

import pytest

sv = pytest.importorskip("statuta.llm.survivor")
SCHEMA = "entry_id BIGINT, title_id STRING, name STRING, comp_num STRING, effective_date STRING, frbr_uri STRING, aliases ARRAY<STRING>, source_format STRING, fetched_at TIMESTAMP_NTZ, rank STRING, title STRING, trust STRING, slug STRING, comp_id STRING, year INT, number INT, xml_path STRING"
T = [datetime(2020, 1, d) for d in range(1, 9)]
TRUST = [("docx", 5), ("ocr", 1)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", f"s{r[0]}", None, 1999, r[0] % 3, "n/a") for r in rows], SCHEMA)


def trust(spark):
    return spark.createDataFrame(TRUST, "source_format STRING, trust INT")


NO_VALUE = {"", "-", "n/a", "tbc", "untitled", "?"}


def present(v):
    return v is not None and v.strip().lower() not in NO_VALUE


def found(spark, rows):
    return {tuple(r) for r in sv.surviving(frame(spark, rows), trust(spark)).collect()}


def brute(rows):
    rows = list({r[0]: r for r in rows}.values())
    titled = {r[0]: "".join(r[1].split()).upper() if present(r[1]) else None for r in rows}
    borne = {}
    for r in rows:
        if titled[r[0]]:
            for n in [r[2], *(r[6] or [])]:
                if present(n):
                    borne.setdefault(n, set()).add(titled[r[0]])
    groups = {}
    for r in rows:
        t = titled[r[0]] or (next(iter(borne[r[2]])) if present(r[2]) and len(borne.get(r[2], ())) == 1 else None)
        if t:
            groups.setdefault(t, []).append(r)
    out = set()
    rank = lambda r: (-dict(TRUST).get((r[7] or "").strip().lower(), 0), r[8] is None, -(r[8] or T[0]).timestamp(), r[0])
    for t, g in groups.items():
        for f, i in (("name", 2), ("comp_num", 3), ("effective_date", 4), ("frbr_uri", 5)):
            have = [r for r in g if present(r[i])]
            if len(g) > 1 and have:
                out.add((t, f, min(have, key=rank)[0]))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(4)
    pick = lambda *x: rnd.choice(x)
    rows = [
        (i, pick("t1", " T1", "T2", "T 3", None, "n/a", ""), pick("Act A", "Act B", "Act  C", None, "TBC", "Untitled"), pick("1", "2", None, "-"), pick("2020-01-01", "1 Jan 2020", " ", None), pick("/a", "/b", "?"),
         pick(None, [], ["Act A"], ["Old", None, "n/a"]), pick("DOCX", " docx", "ocr", "odd", None), pick(None, *T))
        for i in range(120)
    ]
    rows += rows[:5]
    assert found(spark, rows) == brute(rows)


def test_hot_title(spark):
    rows = [(i, "T", f"Act {i}", str(i), None, "-", None, "ocr", T[i % 8]) for i in range(500)] + [(1000, "T", "Best Act", None, None, None, [], "docx", None)]
    assert found(spark, rows) == {("T", "name", 1000), ("T", "comp_num", 7)}


def test_survivors_and_empty(spark):
    rows = [(1, "T", "New Act", None, "2020", None, ["x"], "docx", T[0]), (2, "t", "Old Act", "5", None, None, ["New Act"], "ocr", T[1]), (3, "U", "Lone", "1", None, None, None, None, None)]
    got = sv.survivors(frame(spark, rows), trust(spark)).collect()
    assert [(r.title_id, r.n_entries, r.name, r.comp_num, r.aliases) for r in got] == [("T", 2, "New Act", "5", ["Old Act", "x"])]
    assert (got[0].slug, got[0].comp_id, got[0].year, got[0].xml_path) == ("s1", None, 1999, None)
    assert found(spark, []) == set() and sv.survivors(frame(spark, []), trust(spark)).count() == 0 == sv.compared(frame(spark, []), trust(spark)).count()


def votes(spark, rows, field="name", **more):
    return {r.title_id: (r.entry_id, r.value) for r in sv.consensus(sv.grouped(frame(spark, rows), trust(spark), ["name"]), [field], **more).collect()}


def test_a_majority_outvotes_trust(spark):
    rows = [(1, "T", "The Best Act 1999", None, None, None, None, "docx", T[5])] + [(i, "T", "A Worse Act 1999", None, None, None, None, "ocr", T[0]) for i in range(2, 6)]
    assert ("T", "name", 1) in found(spark, rows)
    assert votes(spark, rows) == {"T": (2, "A Worse Act 1999")}
    assert votes(spark, rows[:2]) == {"T": (1, "The Best Act 1999")}


def test_the_vote_is_taken_token_by_token(spark):
    # No whole value has a majority, but each token of the third has.
    rows = [(1, "T", "Privacy Act 1989", None, None, None, None, "ocr", None), (2, "T", "Privacy Bill 1988", None, None, None, None, "ocr", None), (3, "T", "Privacy Act 1988", None, None, None, None, "odd", None)]
    assert votes(spark, rows) == {"T": (3, "Privacy Act 1988")}
    assert sv.decide([["a", "x", "c"], ["a", "c"], ["a", "y", "c"]], [2, 2, 1]) == ["a", "x", "c"]  # two of five have no token there, as many as x: a token goes first
    assert sv.decide([["a", "c"], ["a", "x", "c"], ["b"]], [3, 2, 1]) == ["a", "c"]


def test_a_hot_title_votes_in_parts(spark):
    rows = [(i, "T", f"Road Safety Act {1900 + i % 40} No {i}", None, None, None, [], "ocr", T[i % 8]) for i in range(300)] + [(i, "T", "Road Safety Act 1988", None, None, None, [], "ocr", T[0]) for i in range(1000, 1400)]
    assert votes(spark, rows, values_per_task=20) == {"T": (1000, "Road Safety Act 1988")}


def test_repeated_entries_vote_once_and_long_values_end(spark):
    rows = [(1, "T", "A B", None, None, None, None, "ocr", None), (2, "T", "A C", None, None, None, None, "docx", None)] + [(1, "T", "A B", None, None, None, None, "ocr", None)] * 9
    assert votes(spark, rows) == {"T": (2, "A C")}
    long = "word " * 20_000
    assert votes(spark, [(1, "T", long + "x", None, None, None, None, "ocr", None), (2, "T", long + "y", None, None, None, None, "docx", None)])["T"][0] == 2


def test_zero_dates_are_absent(spark):
    rows = [
        (1, "T", "A", None, "0000-00-00", None, None, "docx", T[1]), (2, "T", "A", None, "2020-01-01", None, None, "ocr", T[0]),
        (3, "U", "B", None, " 00/00/0000 ", None, None, "docx", T[0]), (4, "U", "B", "0", "0", None, None, "ocr", T[0]), (5, "V", "C", None, "0000-00-00", None, None, "docx", T[1]), (6, "V", "C", None, "2000-10-10", None, None, "ocr", T[0]),
    ]
    assert {r for r in found(spark, rows) if r[1] != "name"} == {("T", "effective_date", 2), ("U", "comp_num", 4), ("V", "effective_date", 6)}
    assert {r.title_id: r.effective_date for r in sv.survivors(frame(spark, rows), trust(spark)).collect()} == {"T": "2020-01-01", "U": None, "V": "2000-10-10"}
