import json
import random

from hypothesis import given
from hypothesis import strategies as st

from statuta.operators import shred

SCHEMA = "tree_id BIGINT, body_json STRING, eid STRING"


def walk(nodes, at=()):
    """The straight recursion that the level streams must agree with."""
    i = 0
    for n in nodes if isinstance(nodes, list) else [nodes] if isinstance(nodes, dict) else []:
        if isinstance(n, dict):
            i += 1
            path = (*at, i)
            ps = n.get("paragraphs") or []
            texts = [p.get("text") if isinstance(p, dict) else p for p in (ps if isinstance(ps, list) else [ps])]
            yield ".".join(map(str, path)), ".".join(map(str, at)), n.get("eid") or n.get("eId") or "", sum(bool(t and t.strip()) for t in texts)
            yield from walk(n.get("children") or [], path)


def made(rnd, depth):
    n = {"eid": rnd.choice(["a", None, "b-1", ""]), "paragraphs": rnd.choice([None, [], ["x", None, " "], [{"text": "y"}, {"text": None}], "one", ["p", "q"]])}
    if depth and rnd.random() < 0.8:
        kids = [made(rnd, depth - 1) if rnd.random() < 0.9 else None for _ in range(rnd.randrange(4))]
        n["children"] = rnd.choice([kids, kids, kids[0] if kids and kids[0] else None])
    if rnd.random() < 0.2:
        n["eId"] = n.pop("eid")
    return n


def assembled(spark, bodies):
    df = spark.createDataFrame([(i, b, "clash") for i, b in enumerate(bodies)], SCHEMA)
    return {tuple(r) for r in shred.assemble_nodes(shred.striped(df, ["eid", "paragraphs"])).select("tree_id", "node_path", "parent_path", "eid", "n_paragraphs").collect()}


def test_round_trip_against_recursion(spark):
    rnd = random.Random(3)
    trees = [[made(rnd, 5) for _ in range(rnd.randrange(4))] for _ in range(60)]
    want = {(i, *r) for i, t in enumerate(trees) for r in walk(t)}
    assert assembled(spark, [json.dumps(t) for t in trees]) == want
    assert assembled(spark, [json.dumps({"body": t, "meta": 1}) for t in trees]) == want


def test_irregular_bodies(spark):
    one = {"eid": "a", "children": json.dumps([{"eId": "b", "paragraphs": json.dumps(["x", ""])}, None, {"eid": "c"}])}
    deep = '{"children":' * 3000 + "{}" + "}" * 3000
    bodies = [None, "", "not available", '{"eid":"a"', "NaN", "3", "null", "[]", json.dumps(one), json.dumps({"body": one}), json.dumps({"body": None}), '[{"eid":"\\ud800"}]', deep, '{"eid":"a"} x']
    got = assembled(spark, bodies)
    three = {("1", "", "a", 0), ("1.1", "1", "b", 1), ("1.2", "1", "c", 0)}
    assert {r[1:] for r in got if r[0] == 8} == three == {r[1:] for r in got if r[0] == 9}
    assert {r[0] for r in got} == {8, 9, 11, 12}
    assert sum(r[0] == 12 for r in got) == 3001


def test_empty_and_repeated(spark):
    assert shred.assemble_nodes(shred.striped(spark.createDataFrame([], SCHEMA))).count() == 0
    df = spark.createDataFrame([(1, '[{"paragraphs":["a",null,"b"]}]', "")] * 2, SCHEMA)
    assert [tuple(r) for r in shred.assemble_paragraphs(shred.striped(df)).orderBy("ord").collect()] == [(1, "1", 1, "a"), (1, "1", 3, "b")]


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text() | st.floats(allow_nan=False, allow_infinity=False), lambda x: st.lists(x) | st.dictionaries(st.text(), x), max_leaves=20))
def test_parser_without_recursion(value):
    text = json.dumps(value, indent=1)
    assert shred._parse_deep(text) == json.loads(text)


@given(st.text(alphabet='[]{}",:0tn ', max_size=12))
def test_parser_refuses_what_the_library_refuses(text):
    def read(f):
        try:
            return f(text)
        except ValueError:
            return "refused"

    assert read(shred._parse_deep) == read(json.loads)
