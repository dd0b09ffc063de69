import unicodedata

import pytest

la = pytest.importorskip("statuta.llm.lookalike")
SPANS = "ARRAY<STRUCT<text: STRING, bold: BOOLEAN, italic: BOOLEAN, superscript: BOOLEAN, subscript: BOOLEAN>>"
SCHEMA = f"para_id BIGINT, text STRING, spans {SPANS}, form STRING, key STRING"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None if s is None else [(x, False, False, False, False) for x in s], "clash", "clash") for i, t, s in rows], SCHEMA)


def skeleton(s):
    return unicodedata.normalize("NFC", "".join(la._TO_LATIN.get(c, c) for c in unicodedata.normalize("NFD", la.unify(s))))


ROWS = [
    (1, "The claim of Gufláec is 8 K", None), (2, "Ｔｈｅ claim of Gufláec is 8 K", None), (3, "Thе cl​aim of Gufláec is 8 K", None), (4, "the claim of Gufláec is 8 K", None),
    (5, "x²", None), (6, "x2", None), (7, "a-b", ["a-", "b"]), (8, "a‑b", ["a‑", "b"]), (9, "a–b", None), (10, None, []), (11, " ", [None]), (12, "", None), (13, "аѕѕеѕѕ it", None), (14, "aѕѕeѕs it", None),
    (15, "assess it", None), (16, "mе rеly", None), (17, "mе rely", None), (7, "a-b", ["a-", "b"]), (18, "Part Ⅵ", None), (19, "Part VI", None), (20, "Москва", None), (21, "ﬁle", None), (22, "file", None), (23, "The" * 30000, None), (24, "Ｔｈｅ" * 30000, None),
]


def test_pairs_against_brute_force(spark):
    want = set()
    for field, of in (("text", lambda r: r[1]), ("spans", lambda r: None if r[2] is None else "".join(x or "" for x in r[2]))):
        vals = {r[0]: of(r) for r in ROWS if of(r) and of(r).strip()}
        want |= {(field, a, b) for a in vals for b in vals if a < b and vals[a] != vals[b] and skeleton(vals[a]) == skeleton(vals[b])}
    got = {tuple(r) for r in la.alike_pairs(frame(spark, ROWS)).collect()}
    assert got == want
    assert ("text", 13, 15) in got and ("text", 5, 6) not in got and ("text", 7, 9) not in got and ("text", 1, 4) not in got and ("text", 23, 24) in got


def test_only_mixed_words_are_repaired(spark):
    rows = [(1, "Москва и Дума", None), (2, "хо", None), (3, "only one cаt", None)]
    got = {r.para_id: r.form for r in la.normalised(frame(spark, rows)).collect()}
    assert got == {1: "Москва и Дума", 2: "хо", 3: "only one cаt"}  # 'cat' stands nowhere
    got = {r.para_id: r.form for r in la.normalised(frame(spark, [*rows, (4, "a cat", None)])).collect()}
    assert got[3] == "only one cat"


def test_classes_and_empty(spark):
    got = {(r.field_name, r.para_id): (r.class_id, r.n_spellings) for r in la.alike_classes(frame(spark, ROWS)).collect()}
    assert got[("text", 2)] == (1, 3) and got[("spans", 8)] == (7, 2)
    assert la.alike_pairs(frame(spark, [])).count() == 0


def test_unify():
    assert la.unify("ａ­b　c‑d e\r\nf") == "ab c-d e\nf"
    assert la.unify("é") == "é" and la.unify("x²—é’") == "x²—é’"


def test_words_of_plain_span_texts_count(spark):
    rows = [(1, None, ["zorb", "lap act"]), (2, None, ["zоrb", "lap act"])]
    assert {(r.para_id_a, r.para_id_b) for r in la.alike_pairs(frame(spark, rows)).collect()} == {(1, 2)}
