"""Running state over ordered streams, in blocks, so that one long stream isn't one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Positions of one stream that one task takes at a time.
BLOCK = 50_000
B = "__block"


def with_block(df: DataFrame, position: str, block: int = BLOCK) -> DataFrame:
    return df.withColumn(B, F.floor(F.col(position) / F.lit(block)))


def carry(
    df: DataFrame, keys: list[str], position: str, last: dict[str, Column] | None = None, sums: dict[str, Column] | None = None, marks: dict[str, tuple[Column, str]] | None = None,
    totals: bool = False, block: int = BLOCK, keep_block: bool = False,
) -> DataFrame:
    """df with running state, several values at once.

    last: the last value that isn't null before each row. sums: running sums,
    the row's own value included; nulls count as 0. marks: of each name (condition,
    sum): what the sum was at the last row before that meets the condition. totals:
    each sum over the whole stream too, as name_total.

    Rows are windowed within blocks of positions; the last row of each block
    tells the state that goes on from it, which is windowed per key and joined
    back. So a key with a third of all rows is shared by as many tasks as it has
    blocks, and what crosses between them is one row per block. The input is read
    twice, the second time only the columns that the state needs; so state that
    builds on other state is best asked for in one call, or from a written table.
    """
    last, sums, marks = last or {}, sums or {}, marks or {}
    df = with_block(df, position, block).withColumns({**{f"__v_{n}": c for n, c in last.items()}, **{f"__s_{n}": F.coalesce(c.cast("bigint"), F.lit(0)) for n, c in sums.items()}, **{f"__m_{n}": c for n, (c, _) in marks.items()}})
    within = W.partitionBy(*keys, B).orderBy(position)
    before, so_far = within.rowsBetween(W.unboundedPreceding, -1), within.rowsBetween(W.unboundedPreceding, W.currentRow)
    here = df.withColumns({**{f"__i_{n}": F.last(f"__v_{n}", ignorenulls=True).over(before) for n in last}, **{f"__t_{n}": F.sum(f"__s_{n}").over(so_far) for n in sums}})
    here = here.withColumns({f"__at_{n}": F.when(F.col(f"__m_{n}"), F.col(f"__t_{s}")) for n, (_, s) in marks.items()})
    here = here.withColumns({f"__i_{n}": F.last(f"__at_{n}", ignorenulls=True).over(before) for n in marks})
    ends = here.withColumn("__more", F.lead(F.lit(True)).over(within)).where("__more IS NULL").select(
        *keys, B, *[F.coalesce(f"__v_{n}", f"__i_{n}").alias(f"__e_{n}") for n in last], *[F.col(f"__t_{n}").alias(f"__e_{n}") for n in sums], *[F.coalesce(f"__at_{n}", f"__i_{n}").alias(f"__e_{n}") for n in marks]
    )
    blocks = W.partitionBy(*keys).orderBy(B)
    earlier = blocks.rowsBetween(W.unboundedPreceding, -1)
    offset = {n: F.coalesce(F.sum(f"__e_{n}").over(earlier), F.lit(0)) for n in sums}
    carried = ends.withColumns({**{f"__o_{n}": c for n, c in offset.items()}, **{f"__o_{n}": F.last(f"__e_{n}", ignorenulls=True).over(earlier) for n in last}})
    carried = carried.withColumns({f"__a_{n}": F.col(f"__e_{n}") + F.col(f"__o_{s}") for n, (_, s) in marks.items()})
    carried = carried.withColumns({f"__o_{n}": F.last(f"__a_{n}", ignorenulls=True).over(earlier) for n in marks})
    if totals:
        carried = carried.withColumns({f"{n}_total": F.sum(f"__e_{n}").over(W.partitionBy(*keys)) for n in sums})
    carried = carried.select(*keys, B, *[f"__o_{n}" for n in [*last, *sums, *marks]], *[f"{n}_total" for n in sums if totals])
    joined = here.join(carried, [*keys, B], "left")  # a null key keeps its rows, without what crosses blocks
    out = joined.withColumns({
        **{n: F.coalesce(f"__i_{n}", f"__o_{n}") for n in last}, **{n: F.col(f"__t_{n}") + F.coalesce(f"__o_{n}", F.lit(0)) for n in sums},
        **{n: F.coalesce(F.col(f"__i_{n}") + F.coalesce(f"__o_{s}", F.lit(0)), F.col(f"__o_{n}")) for n, (_, s) in marks.items()},
    })
    made = [c for c in out.columns if c.startswith(("__v_", "__s_", "__m_", "__i_", "__t_", "__at_", "__o_"))]
    return out.drop(*made, *([] if keep_block else [B]))


def carry_last(df: DataFrame, keys: list[str], position: str, values: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """The last value that isn't null before each row, for several values at once. See carry."""
    return carry(df, keys, position, last=values, block=block)


def carry_sum(df: DataFrame, keys: list[str], position: str, values: dict[str, Column], block: int = BLOCK) -> DataFrame:
    """Running sums, each row's own value included. See carry."""
    return carry(df, keys, position, sums=values, block=block)
