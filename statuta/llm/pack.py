"""Filling of fixed-capacity containers with items of varying size."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CAPACITY = 2048
#: Lengths a container may have; the largest is the capacity.
LENGTHS = (256, 512, 1024, 2048)
#: What a container costs beside its length (a fixed share of work), and how its length counts squared: the share by which the
#: largest permitted container is dearer than its length, as attention within it is. 0: only space counts.
OVERHEAD, ATTENTION = 32, 0.0
#: Items that one packing task takes: enough to fill all but its last containers, few enough for any executor.
ITEMS_PER_SHARD = 50_000

PACKED = "id BIGINT, piece_no INT, token_start BIGINT, n_tokens INT, container_id BIGINT, length INT, used INT"


def price(n: int, most: int, overhead: float = OVERHEAD, attention: float = ATTENTION) -> float:
    """What a container of length n costs, in tokens."""
    return n + overhead + attention * n * n / most


def least_price(n_tokens: int, lengths: tuple[int, ...] = LENGTHS, overhead: float = OVERHEAD, attention: float = ATTENTION) -> float:
    """A lower bound of what containers for that many tokens cost: all of the length that is cheapest per token, filled to the brim."""
    return n_tokens * min(price(n, max(lengths), overhead, attention) / n for n in lengths)


class _Unplaced:
    """The sizes that are still unplaced, and how far they could fill a room."""

    def __init__(self, sizes: list[int], most: int):
        self.count = [0] * (most + 1)
        self.some = 0  # bit z: an item of size z is unplaced
        for z in sizes:
            self.count[z] += 1
        for z in range(1, most + 1):
            if self.count[z]:
                self.some |= 1 << z

    def place(self, size: int) -> None:
        self.count[size] -= 1
        if size and not self.count[size]:
            self.some &= ~(1 << size)

    def fill(self, room: int) -> int:
        """Tokens that the unplaced items would bring into a room, largest first."""
        begin, below = room, room
        while room:
            fitting = self.some & ((1 << (min(room, below) + 1)) - 1)
            if not fitting:
                break
            z = fitting.bit_length() - 1
            room -= z * min(self.count[z], room // z)
            below = z - 1
        return begin - room


def best_fit(sizes: list[int], lengths: tuple[int, ...] = LENGTHS, overhead: float = OVERHEAD, attention: float = ATTENTION) -> tuple[list[int], list[int], list[int]]:
    """(container of each item, length of each container, contents of each container).

    Largest items first. Each goes into the open container that it leaves
    least room in. Where it fits none, all permitted lengths it fits compete:
    each is filled in thought with what is unplaced, and the one that costs
    least per token so placed is opened (of a tie the smaller). In the end each
    container shrinks to the least permitted length that holds its contents.
    Empty items go in last and take no room. No item may exceed the largest
    length.
    """
    lengths = tuple(sorted(lengths))
    most = lengths[-1]
    if sizes and max(sizes) > most:
        raise ValueError("an item is larger than the largest container")
    unplaced = _Unplaced(sizes, most)
    at = [-1] * len(sizes)
    used: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(most + 1)]
    rooms = 0  # bit r: some open container has room for exactly r
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        size = sizes[i]
        unplaced.place(size)
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            box = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room = min((n for n in lengths if n >= size), key=lambda n: (price(n, most, overhead, attention) / max(1, size + unplaced.fill(n - size)), n))
            box = len(used)
            used.append(0)
        at[i] = box
        used[box] += size
        room -= size
        by_room[room].append(box)
        rooms |= 1 << room
    return at, [next(n for n in lengths if n >= u) for u in used], used


def pack(items: DataFrame, id_col: str, size_col: str, lengths: tuple[int, ...] = LENGTHS, overhead: float = OVERHEAD, attention: float = ATTENTION, items_per_shard: int = ITEMS_PER_SHARD) -> DataFrame:
    """id_col, piece_no, token_start, n_tokens, container_id, length, used: where every item goes.

    An item larger than the largest length is cut into full containers and one
    rest; no other is divided. A null size counts as 0, and an item without
    tokens still gets its row. Repeated rows are packed as often as they come.
    An empty table gives no row.

    Items are dealt by a hash of their id to shards of about items_per_shard,
    each packed by one task in an order that depends on the items alone, so a
    task that runs again packs the same. What this loses against one packing
    of all is less than one container's room per shard.
    """
    shards = max(1, -(-items.count() // items_per_shard))
    most = max(lengths)

    def run(table: pa.Table) -> pa.Table:
        ids, sizes = table.column("id").to_pylist(), table.column("size").to_pylist()
        shard = table.column("shard")[0].as_py()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k], sizes[k]))
        rows: list[tuple[int, int, int, int]] = []
        for k in order:
            size, start, piece = sizes[k], 0, 1
            while size > most:
                rows.append((ids[k], piece, start, most))
                size, start, piece = size - most, start + most, piece + 1
            rows.append((ids[k], piece, start, size))
        at, length, used = best_fit([r[3] for r in rows], lengths, overhead, attention)
        cols = [list(c) for c in zip(*rows, strict=True)]
        cols += [[(shard << 32) + b for b in at], [length[b] for b in at], [used[b] for b in at]]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["id", "piece_no", "token_start", "n_tokens", "container_id", "length", "used"])

    dealt = items.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(size_col), F.lit(0)).cast("bigint").alias("size")).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, PACKED).withColumnRenamed("id", id_col)


def filling(packed: DataFrame, lengths: tuple[int, ...] = LENGTHS, overhead: float = OVERHEAD, attention: float = ATTENTION) -> DataFrame:
    """length, n_containers, n_tokens, share_used, cost, share_of_bound: how full the containers of each length are and what they
    cost, and in every row how much dearer all containers together are than least_price of all tokens (1: none dearer)."""
    boxes = packed.groupBy("container_id", "length").agg(F.max("used").alias("used"))
    most, n = max(lengths), F.col("length")
    each = boxes.groupBy("length").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("used").cast("bigint").alias("n_tokens"), F.round(F.sum("used") / F.sum("length"), 6).alias("share_used"))
    each = each.withColumn("cost", F.round(F.col("n_containers") * (n + overhead + attention * n * n / most), 3))
    all_ = W.partitionBy(F.lit(1))  # one row per permitted length
    bound = F.sum("n_tokens").over(all_) * least_price(1, lengths, overhead, attention)
    return each.select("*", F.round(F.sum("cost").over(all_) / bound, 6).alias("share_of_bound"))
