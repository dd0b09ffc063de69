"""Splitting of oversized texts at natural boundaries, with overlap, by one bounded pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1200, 150
#: A line feed, or white space after one of . ; : ? !
BOUNDARY = r"\n|(?<=[.;:?!])\s+"


def _alternatives(n: int, least: int) -> str:
    """Up to n characters, ending at the strongest boundary there is: end of text, line feed, end of sentence or clause in
    the latter half; any of these; white space; else n characters. Every cut but the last leaves at least `least`."""
    half = max(least, n // 2)
    ends = [rf".{{1,{n}}}\z", rf".{{{half - 1},{n - 1}}}\n", rf".{{{half - 1},{n - 1}}}(?<=[.;:?!])\s", rf".{{{least - 1},{n - 1}}}(?:\n|(?<=[.;:?!])\s)", rf".{{{least - 1},{n - 1}}}\s"]
    return "|".join([*ends, rf".{{{n}}}"])


def core_pattern(limit: int, overlap: int) -> str:
    """The stretches that pieces add: the first may fill the limit, later ones leave room for the overlap."""
    if not 0 < overlap <= limit // 4:
        raise ValueError("overlap must be positive and at most a quarter of the limit")
    return rf"(?sU)\A(?:{_alternatives(limit, overlap)})|(?:{_alternatives(limit - overlap, overlap)})"


def longest_stretch(text: Column) -> Column:
    """Characters of the longest stretch without a boundary inside."""
    return F.array_max(F.transform(F.split(text, "(?U)" + BOUNDARY), lambda s: F.char_length(s)))


def split_long(df: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """id_col, keep..., piece_no (from 1), n_pieces, n_overlap, piece, hard: the pieces of each text longer than limit.

    Length is in code points. Without its first n_overlap characters each piece
    continues where the one before ended, so the text can be put together
    again; n_overlap is 0 for the first piece and `overlap` for all others. No
    piece is longer than limit. hard is 1 if the text has a stretch longer than
    limit without a boundary inside. Null and shorter texts give no row. A row
    delivered twice counts once, by its id. Texts are handled whole in one row;
    only long ones are shuffled.
    """
    long = df.select(id_col, *(keep or []), text_col).where(F.char_length(text_col) > limit).dropDuplicates([id_col])
    text = F.col(text_col)
    cores = long.withColumn("__hard", (longest_stretch(text) > limit).cast("int")).withColumn("__cores", F.regexp_extract_all(text, F.lit(core_pattern(limit, overlap)), 0)).drop(text_col)
    pieces = F.transform(
        F.col("__cores"),
        lambda c, i: F.struct(
            F.when(i == 0, 0).otherwise(overlap).alias("n_overlap"),
            F.concat(F.when(i == 0, "").otherwise(F.substring(F.get("__cores", i - 1), -overlap, overlap)), c).alias("piece"),
        ),
    )
    return cores.select(id_col, *(keep or []), F.size("__cores").alias("n_pieces"), "__hard", F.posexplode(pieces).alias("__i", "p")).select(
        id_col, *(keep or []), (F.col("__i") + 1).alias("piece_no"), "n_pieces", "p.n_overlap", "p.piece", F.col("__hard").alias("hard")
    )
