import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

sp = pytest.importorskip("statuta.llm.split")
SCHEMA = "para_id BIGINT, text STRING, eid STRING, piece STRING, hard INT"


def pieces(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "e", "clash", 7) for i, t in enumerate(texts)], SCHEMA)
    out = {}
    for r in sp.split_long(df, "para_id", "text", ["eid"], **kw).orderBy("para_id", "piece_no").collect():
        out.setdefault(r.para_id, []).append(r)
    return out


def check(texts, got, limit, overlap):
    for i, t in enumerate(texts):
        if t is None or len(t) <= limit:
            assert i not in got
            continue
        rs = got[i]
        assert [r.piece_no for r in rs] == list(range(1, len(rs) + 1)) and {r.n_pieces for r in rs} == {len(rs)}
        assert all(len(r.piece) <= limit for r in rs)
        assert [r.n_overlap for r in rs] == [0] + [overlap] * (len(rs) - 1)
        assert "".join(r.piece[r.n_overlap :] for r in rs) == t
        for a, b in zip(rs, rs[1:]):
            assert a.piece.endswith(b.piece[:overlap])
        hard = max(map(len, re.split(r"\n|(?<=[.;:?!])\s+", t))) > limit
        assert {r.hard for r in rs} == {int(hard)}


def test_texts(spark):
    texts = [None, "", "short", "x" * 1200, "x" * 1201, "A sentence of words. " * 200, ("line " * 30 + "\n") * 30, "🌾" * 1500, "a b " * 900, "w" * 1100 + ". " + "v" * 1100, "no. " + "z" * 5000, "e　" * 700]
    check(texts, pieces(spark, texts), 1200, 150)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .;\n🌾", max_size=300), max_size=6))
def test_round_trip(spark, texts):
    check(texts, pieces(spark, texts, limit=40, overlap=8), 40, 8)


def test_cuts_at_sentences(spark):
    got = pieces(spark, ["A sentence of words. " * 200])[0]
    assert all(r.piece.endswith(". ") for r in got)


def test_empty_and_repeated(spark):
    assert pieces(spark, []) == {}
    df = spark.createDataFrame([(1, "x" * 1300, "e", "", 0)] * 2, SCHEMA)
    assert sp.split_long(df, "para_id", "text").count() == 2
