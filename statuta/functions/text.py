"""Column helpers for text that hold for any script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode defines it; Java's plain \s knows ASCII only.
WS = r"(?U)\s"


def squeeze(c: Column) -> Column:
    """Runs of Unicode white space become one blank, none stays at the ends."""
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def strip(c: Column) -> Column:
    """Unicode white space removed at both ends only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    """True for null, empty and white-space-only values."""
    return F.coalesce(~c.rlike(r"(?U)\S"), F.lit(True))


def extract(c: Column, pattern: str, group: int = 1) -> Column:
    """Captured group, or null where the pattern or the group doesn't match."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))
