"""Deeply nested records as flat tables, by columnar shredding into level streams.

A section tree is recursive, so each depth has its own leaf columns
(``nodes[].eid``, ``nodes[].nodes[].eid`` and so on). Every column is a stream
of (repetition level, definition level, value): the repetition level says at
which depth the entry repeats (0 opens a record), the definition level how many
of the levels above the leaf exist. The tables of nodes and of paragraphs are
put together again from these streams alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAVES = ["eid", "num", "heading", "tag", "paragraphs"]
STRIPED = "tree_id BIGINT, columns ARRAY<STRUCT<leaf: STRING, depth: INT, reps: ARRAY<INT>, defs: ARRAY<INT>, vals: ARRAY<STRING>>>"
NODES = "tree_id BIGINT, node_path STRING, parent_path STRING, eid STRING, num STRING, heading STRING, tag STRING, n_paragraphs INT"
PARAGRAPHS = "tree_id BIGINT, node_path STRING, ord INT, text STRING"

#: What a worker holds of bodies or of rows before it hands them on; bounds its memory, not the result.
HELD_LETTERS, HELD_ROWS = 1_000_000, 20_000

_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?", re.ASCII)
_SPACE = re.compile(r"[ \t\n\r]*")
_WORDS = {"true": True, "false": False, "null": None}


def _no_constant(word: str) -> None:
    raise ValueError(word)


def parse_json(text: str) -> Any:
    """Strict JSON of any depth; ValueError for anything else (NaN and the like too)."""
    try:
        return json.loads(text, parse_constant=_no_constant)
    except RecursionError:
        return _parse_deep(text)


def _parse_deep(s: str) -> Any:
    """The same without recursion, for nesting beyond the library's depth."""
    done: list[Any] = []
    stack: list[list[Any]] = []  # [container, pending key]
    i, state = _SPACE.match(s, 0).end(), "value"
    while True:
        i = _SPACE.match(s, i).end()
        c = s[i : i + 1]
        if state == "value":
            if c in ("{", "[") and c:
                stack.append([{} if c == "{" else [], None])
                i = _SPACE.match(s, i + 1).end()
                if s[i : i + 1] == ("}" if c == "{" else "]"):
                    value, i, state = stack.pop()[0], i + 1, "done"
                else:
                    state = "key" if c == "{" else "value"
                    continue
            elif c == '"':
                value, i = json.decoder.scanstring(s, i + 1, True)
            elif m := _NUMBER.match(s, i):
                value, i = (float(m[0]) if re.search("[.eE]", m[0]) else int(m[0])), m.end()
            else:
                word = next((w for w in _WORDS if s.startswith(w, i)), None)
                if word is None:
                    raise ValueError(f"no value at {i}")
                value, i = _WORDS[word], i + len(word)
            if not stack:
                done.append(value)
                if _SPACE.match(s, i).end() != len(s):
                    raise ValueError(f"extra data at {i}")
                return done[0]
            top = stack[-1]
            top[0].append(value) if isinstance(top[0], list) else top[0].__setitem__(top[1], value)
            state = "after"
        elif state == "key":
            if c != '"':
                raise ValueError(f"no name at {i}")
            stack[-1][1], i = json.decoder.scanstring(s, i + 1, True)
            i = _SPACE.match(s, i).end()
            if s[i : i + 1] != ":":
                raise ValueError(f"no colon at {i}")
            i, state = i + 1, "value"
        else:
            closing = "]" if isinstance(stack[-1][0], list) else "}"
            if c == ",":
                i, state = i + 1, "value" if closing == "]" else "key"
            elif c == closing:
                value, i = stack.pop()[0], i + 1
                if not stack:
                    if _SPACE.match(s, i).end() != len(s):
                        raise ValueError(f"extra data at {i}")
                    return value
                top = stack[-1]
                top[0].append(value) if isinstance(top[0], list) else top[0].__setitem__(top[1], value)
            else:
                raise ValueError(f"no comma at {i}")


def _as_list(x: Any, texts: bool) -> list[Any]:
    """A list however it was given: absent, a single item, or as JSON text. texts: a plain string is itself an item."""
    if isinstance(x, str):
        if x.lstrip()[:1] in ("[", "{") and x.strip():
            try:
                got = parse_json(x)
                if isinstance(got, (list, dict)):
                    return _as_list(got, texts)
            except ValueError:
                pass
        return [x] if texts else []
    if x is None:
        return []
    return x if isinstance(x, list) else [x]


def _nodes(x: Any) -> list[dict]:
    """Members that are nodes; null members and anything that isn't a record don't count."""
    out = []
    for m in _as_list(x, False):
        if isinstance(m, str):
            out += [n for n in _as_list(m, False) if isinstance(n, dict)]
        elif isinstance(m, dict):
            out.append(m)
    return out


def _roots(body: Any) -> list[dict]:
    if isinstance(body, str):
        body = next(iter(_as_list(body, False)), None) if body.lstrip()[:1] == "{" else _as_list(body, False)
    if isinstance(body, dict) and "body" in body:
        return _nodes(body["body"])
    return _nodes(body)


def _text(x: Any) -> str | None:
    if isinstance(x, dict):
        x = x.get("text")
    if x is None or isinstance(x, (list, dict)):
        return None
    return x if isinstance(x, str) else json.dumps(x)


def _leaf(node: dict, leaf: str) -> str | None:
    if leaf == "eid":
        return next((t for t in (_text(node.get("eid")), _text(node.get("eId"))) if t is not None and t.strip()), None)
    return _text(node.get(leaf))


def shred_tree(body: Any, leaves: list[str]) -> list[tuple[str, int, list[int], list[int], list[str | None]]]:
    """Level streams (leaf, depth, reps, defs, vals) of one parsed body, for every depth that has a node.

    At depth d a scalar leaf has definition level d if the node is there and
    d + 1 if it has a value too; 'paragraphs' repeats once more: d without any,
    d + 1 for a null one, d + 2 for a text. A node above d without further nodes
    gives one entry of its own depth to each deeper column.
    """
    columns: dict[tuple[str, int], tuple[list, list, list]] = {}
    ends: list[list[tuple[int, int, int]]] = []  # nodes without children: by depth, (visit number, rep, depth)
    seen: list[list[tuple[int, int, dict]]] = []  # nodes: by depth, (visit number, rep, node)
    stack: list[tuple[dict, int, int]] = [(n, 0 if i == 0 else 1, 1) for i, n in enumerate(_roots(body))][::-1]
    visit = 0
    while stack:
        node, rep, depth = stack.pop()
        while len(seen) < depth:
            seen.append([])
            ends.append([])
        seen[depth - 1].append((visit, rep, node))
        visit += 1
        kids = _nodes(node.get("children"))
        if kids:
            stack += [(k, rep if i == 0 else depth + 1, depth + 1) for i, k in enumerate(kids)][::-1]
        else:
            ends[depth - 1].append((visit, rep, depth))
    for depth in range(1, len(seen) + 1):
        shallow = [e for level in ends[: depth - 1] for e in level]
        entries: list[tuple[int, int, Any]] = sorted([(v, r, n) for v, r, n in seen[depth - 1]] + [(v - 1, r, d) for v, r, d in shallow], key=lambda e: e[0])
        for leaf in leaves:
            reps, defs, vals = columns.setdefault((leaf, depth), ([], [], []))
            for _, rep, what in entries:
                if isinstance(what, int):
                    reps.append(rep), defs.append(what), vals.append(None)
                elif leaf != "paragraphs":
                    value = _leaf(what, leaf)
                    reps.append(rep), defs.append(depth + (value is not None)), vals.append(value)
                else:
                    texts = [_text(p) for p in _as_list(what.get("paragraphs"), True)]
                    if not texts:
                        reps.append(rep), defs.append(depth), vals.append(None)
                    for i, t in enumerate(texts):
                        reps.append(rep if i == 0 else depth + 1), defs.append(depth + 1 + (t is not None)), vals.append(t)
    return [(leaf, depth, *c) for (leaf, depth), c in columns.items()]


def _walk(depth: int, reps: list[int], defs: list[int]) -> Iterator[tuple[int, list[int] | None, bool]]:
    """Of each entry of a column at this depth: its index, the node's path (None: no node there), whether the node is new."""
    at = [0] * depth
    for i, (rep, defined) in enumerate(zip(reps, defs, strict=True)):
        if rep > depth:
            yield i, at, False
            continue
        if rep == 0:
            at = [0] * depth
        first = max(rep, 1)
        at[first - 1] += 1
        for level in range(first, depth):
            at[level] = 1
        yield i, (at if defined >= depth else None), True


def _clean(s: str | None) -> str | None:
    """Lone surrogates, which JSON allows and UTF-8 doesn't, become replacement characters."""
    return s if s is None or s.isascii() else s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _dotted(path: list[int]) -> str:
    return ".".join(map(str, path))


def striped(trees: DataFrame, leaves: list[str] | None = None) -> DataFrame:
    """tree_id and the level streams of each body_json that is valid JSON.

    A tree delivered twice counts once, by its id. A null, empty or unreadable
    body gives no row; a valid one without nodes gives no columns. A row may be
    as large as one body, never larger than a document.
    """
    leaves = leaves or LEAVES

    kind = pa.list_(pa.struct([("leaf", pa.string()), ("depth", pa.int32()), ("reps", pa.list_(pa.int32())), ("defs", pa.list_(pa.int32())), ("vals", pa.list_(pa.string()))]))

    def run(batches):
        ids, out, held = [], [], 0
        for b in batches:
            for i, body in zip(b.column(0), b.column(1), strict=True):
                text = body.as_py()
                try:
                    tree = parse_json(text)
                except ValueError:
                    continue
                ids.append(i.as_py())
                out.append([{"leaf": a, "depth": d, "reps": r, "defs": f, "vals": [_clean(v) for v in vs]} for a, d, r, f, vs in shred_tree(tree, leaves)])
                held += len(text)
                if held > HELD_LETTERS:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, kind)], ["tree_id", "columns"])
                    ids, out, held = [], [], 0
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, kind)], ["tree_id", "columns"])

    once = trees.select("tree_id", "body_json").where("body_json IS NOT NULL").groupBy("tree_id").agg(F.min("body_json").alias("body_json"))
    return once.mapInArrow(run, STRIPED)


def _columns_of(row: list[dict]) -> dict[int, dict[str, dict]]:
    by_depth: dict[int, dict[str, dict]] = {}
    for c in row:
        by_depth.setdefault(c["depth"], {})[c["leaf"]] = c
    return by_depth


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    for b in batches:
        for tree, row in zip(b.column(0), b.column(1), strict=True):
            yield tree.as_py(), row.as_py() or []


def assemble_nodes(streams: DataFrame) -> DataFrame:
    """The table of nodes, one row per node at any depth, from the level streams.

    node_path counts positions from 1 at every level; parent_path is '' for a
    root; eid is '' where there is none; other leaves are null where absent or
    not shredded; n_paragraphs counts paragraphs that aren't null or blank.
    """

    def made_of(rows: list[list]) -> pa.RecordBatch:
        cols_ = list(zip(*rows, strict=True))
        kinds = [pa.int64(), *[pa.string()] * 6, pa.int32()]
        arrays = [pa.array([v or "" for v in c] if n == 3 else c, k) for n, (c, k) in enumerate(zip(cols_, kinds, strict=True))]
        return pa.RecordBatch.from_arrays(arrays, ["tree_id", "node_path", "parent_path", "eid", "num", "heading", "tag", "n_paragraphs"])

    def run(batches):
        rows: list[list] = []
        for tree, row in _one_by_one(batches):
            for depth, cols in sorted(_columns_of(row).items()):
                made: list[list] = []
                lead = next(n for n in ("eid", *LEAVES) if n in cols and n != "paragraphs")
                for i, path, _ in _walk(depth, cols[lead]["reps"], cols[lead]["defs"]):
                    if path is not None:
                        made.append([tree, _dotted(path), _dotted(path[:-1]), *[cols[n]["vals"][i] if n in cols else None for n in LEAVES[:-1]], 0])
                if "paragraphs" in cols:
                    p, k = cols["paragraphs"], -1
                    for i, path, new in _walk(depth, p["reps"], p["defs"]):
                        k += new and path is not None
                        if path is not None and (p["vals"][i] or "").strip():
                            made[k][-1] += 1
                rows += made
            if len(rows) > HELD_ROWS:
                yield made_of(rows)
                rows = []
        if rows:
            yield made_of(rows)

    return streams.mapInArrow(run, NODES)


def assemble_paragraphs(streams: DataFrame) -> DataFrame:
    """The table of paragraphs: tree_id, node_path, ord (1-based among all given, blank ones too), text; null ones are left out."""

    def made_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["tree_id", "node_path", "ord", "text"])

    def run(batches):
        rows: list[tuple] = []
        for tree, row in _one_by_one(batches):
            for depth, cols in sorted(_columns_of(row).items()):
                if "paragraphs" not in cols:
                    continue
                p, n = cols["paragraphs"], 0
                for i, path, new in _walk(depth, p["reps"], p["defs"]):
                    n = 1 if new else n + 1
                    if path is not None and p["vals"][i] is not None:
                        rows.append((tree, _dotted(path), n, p["vals"][i]))
            if len(rows) > HELD_ROWS:
                yield made_of(rows)
                rows = []
        if rows:
            yield made_of(rows)

    return streams.mapInArrow(run, PARAGRAPHS)
