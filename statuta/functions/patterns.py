"""Patterns in the dialects of both engines, and all matches of a pattern with their places."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The classes of RE2 know ASCII only; these are what the rules mean.
_RE2 = {r"\s": r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]", r"\d": r"\p{Nd}", r"\w": r"[\p{L}\p{M}\p{N}_]"}
_RE2_IN_CLASS = {k: v[1:-1] if v[0] == "[" else v for k, v in _RE2.items()}


def java(pattern: str, ignore_case: bool = False, dot_all: bool = False) -> str:
    """A pattern for Spark, with Unicode classes and word boundaries."""
    return f"(?{'i' * ignore_case}{'s' * dot_all}U)" + pattern


def re2(pattern: str, ignore_case: bool = False, dot_all: bool = False) -> str:
    """The same pattern for DuckDB, its classes spelt out, as a quoted SQL literal."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            two = pattern[i : i + 2]
            out.append((_RE2_IN_CLASS if inside else _RE2).get(two, two))
            i += 2
            continue
        inside = True if c == "[" else False if c == "]" else inside
        out.append(c)
        i += 1
    flags = "i" * ignore_case + "s" * dot_all
    return "'" + (f"(?{flags})" if flags else "") + "".join(out).replace("'", "''") + "'"


@dataclass(frozen=True)
class Pattern:
    """A pattern, what its matches are, and what else is known of them."""

    kind: str
    regex: str
    ignore_case: bool = False
    note: str = ""

    @property
    def java(self) -> str:
        return java(self.regex, self.ignore_case)

    @property
    def re2(self) -> str:
        return re2(self.regex, self.ignore_case)


def matches(text: Column, p: Pattern, order: int) -> Column:
    """All matches of one pattern: array of (starts_at, priority, ends_at, kind, matched, note), places from 0 in code points.

    The engine gives the matches and what lies between them; their lengths add
    up to the places, so no row leaves the JVM.
    """
    found = F.regexp_extract_all(text, F.lit(p.java), 0)
    gaps = F.split(text, p.java, -1)
    kind = "array<struct<starts_at: int, priority: int, ends_at: int, kind: string, matched: string, note: string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, gm: Column) -> Column:
        begin = acc["at"] + F.char_length(gm["gap"])
        end = begin + F.char_length(gm["matched"])
        one = F.struct(begin.alias("starts_at"), F.lit(order).alias("priority"), end.alias("ends_at"), F.lit(p.kind).alias("kind"), gm["matched"].alias("matched"), F.lit(p.note).alias("note"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    # The last gap has no match behind it: zipping stops at the matches.
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("matched")))
    return F.when(text.rlike(p.java), F.aggregate(pairs, start, step)["out"]).otherwise(F.array().cast(kind))


def leftmost(candidates: Column) -> Column:
    """Matches that don't overlap: in order of place, then of priority, each that begins at or after the end of the last one kept."""
    empty = F.slice(candidates, F.lit(1), F.lit(0))
    return F.aggregate(
        F.array_sort(candidates),
        empty,
        lambda kept, m: F.when((F.size(kept) == 0) | (m["starts_at"] >= F.element_at(kept, -1)["ends_at"]), F.concat(kept, F.array(m))).otherwise(kept),
    )


def all_matches(text: Column, patterns: list[Pattern]) -> Column:
    """Matches of several patterns, overlapping ones included."""
    return F.concat(*[matches(text, p, i) for i, p in enumerate(patterns)])


def sql_matches(text: str, patterns: list[Pattern]) -> str:
    """The same candidates as a DuckDB expression."""
    parts = [
        f"""list_transform(range(1, len(regexp_extract_all({text}, {p.re2})) + 1), lambda i: {{
  'starts_at': (list_sum(list_transform((string_split_regex({text}, {p.re2}))[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform((regexp_extract_all({text}, {p.re2}))[1:i-1], lambda g: length(g))), 0))::BIGINT,
  'priority': {n}, 'ends_at': 0::BIGINT, 'kind': '{p.kind}', 'matched': (regexp_extract_all({text}, {p.re2}))[i], 'note': '{p.note}'}})"""
        for n, p in enumerate(patterns)
    ]
    joined = parts[0]
    for p in parts[1:]:
        joined = f"list_concat({joined}, {p})"
    return joined


def sql_leftmost(candidates: str) -> str:
    """The same choice as a DuckDB expression: a list of one-element lists is folded."""
    return f"""list_reduce(list_concat([[]], list_transform(list_sort({candidates}), lambda m: [m])), lambda kept, x:
  CASE WHEN len(kept) = 0 OR x[1].starts_at >= kept[-1].starts_at + length(kept[-1].matched) THEN list_concat(kept, x) ELSE kept END)"""
