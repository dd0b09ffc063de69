import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

pk = pytest.importorskip("statuta.llm.pack")


@given(st.lists(st.integers(0, 100), max_size=60))
def test_best_fit_holds(sizes):
    at, length, used = pk.best_fit(sizes, (25, 50, 100), 5)
    fill = [0] * len(length)
    for s, b in zip(sizes, at, strict=True):
        fill[b] += s
    assert fill == used and all(u <= n for u, n in zip(used, length, strict=True))
    assert all(n == min(x for x in (25, 50, 100) if x >= u) for u, n in zip(used, length, strict=True))


def run(spark, sizes, **kw):
    df = spark.createDataFrame([(i, s, "clash", 1) for i, s in enumerate(sizes)], "doc_id BIGINT, n_tokens INT, length STRING, shard INT")
    return pk.pack(df, "doc_id", "n_tokens", **kw).collect()


def test_whole_and_divided(spark):
    rnd = random.Random(2)
    sizes = [None, 0, 2048, 2049, 10_000, *[int(rnd.expovariate(1 / 300)) for _ in range(3000)]]
    rows = run(spark, sizes, items_per_shard=1000)
    boxes, got = {}, {}
    for r in rows:
        boxes.setdefault(r.container_id, []).append(r.n_tokens)
        got.setdefault(r.doc_id, []).append((r.piece_no, r.token_start, r.n_tokens))
    assert all(sum(v) <= 2048 for v in boxes.values())
    for i, s in enumerate(sizes):
        ps = sorted(got[i])
        assert sum(p[2] for p in ps) == (s or 0) and [p[0] for p in ps] == list(range(1, len(ps) + 1))
        assert len(ps) == max(1, -(-(s or 0) // 2048))
    total = sum(s or 0 for s in sizes)
    assert total / (2048 * len(boxes)) > 0.98
    assert sorted(map(tuple, rows)) == sorted(map(tuple, run(spark, sizes, items_per_shard=1000)))


def test_empty(spark):
    assert run(spark, []) == []


def cost(length, **kw):
    return sum(pk.price(n, 100, **kw) for n in length)


@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.sampled_from([0.0, 0.5, 2.0]))
def test_cost_against_bounds(sizes, attention):
    lengths, kw = (25, 50, 100), {"overhead": 5, "attention": attention}
    _, length, _ = pk.best_fit(sizes, lengths, **kw)
    assert pk.least_price(sum(sizes), lengths, **kw) <= cost(length, **kw) + 1e-9
    # Never dearer than twice what each item alone in its own container costs at the least.
    assert cost(length, **kw) <= 2 * sum(min(pk.price(n, 100, **kw) for n in lengths if n >= s) for s in sizes)


def test_lengths_compete():
    sizes = [10, 12, 14] * 40
    assert set(pk.best_fit(sizes, (25, 50, 100), 5, 0.0)[1][:-3]) == {100}  # where only space counts the largest is the cheapest
    dear = pk.best_fit(sizes, (25, 50, 100), 5, 2.0)[1]
    assert set(dear) == {25} and cost(dear, overhead=5, attention=2.0) < cost(pk.best_fit(sizes, (100,), 5, 2.0)[1], overhead=5, attention=2.0)
    # A length that can be filled to the brim goes before a larger one that can't.
    assert sorted(pk.best_fit([50, 50, 50], (50, 100), 0, 0.0)[1]) == [50, 50, 50]
    assert sorted(pk.best_fit([40, 40, 40, 10, 10, 10], (50, 90), 0, 0.0)[1]) == [50, 50, 50]


def test_filling(spark):
    df = spark.createDataFrame([(i, 1000, "c", 1) for i in range(10)], "doc_id BIGINT, n_tokens INT, length STRING, shard INT")
    row = pk.filling(pk.pack(df, "doc_id", "n_tokens")).collect()[0]
    assert (row.length, row.n_containers, row.n_tokens, row.share_used, row.cost) == (2048, 5, 10_000, 0.976563, 10400.0) and row.share_of_bound == round(10400 / (10_000 * 2080 / 2048), 6)
