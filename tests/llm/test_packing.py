from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagelattice.llm import packing as P


def loads(plan, histogram):
    """The filling of each container, item by item."""
    by_size = defaultdict(list)
    for size, rank, first, each in plan.places:
        by_size[size].append((rank, first, each))
    out = Counter()
    for size, n in histogram.items():
        places = sorted(by_size[size])
        for r in range(n):
            rank, first, each = [p for p in places if p[0] <= r][-1]
            out[first + (r - rank) // each] += size
    return out


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(0, 30), max_size=12))))
def test_plan_holds_every_item(case):
    capacity, histogram = case
    plan = P.plan_containers(histogram, capacity)
    filled = loads(plan, histogram)
    assert all(v <= capacity for v in filled.values()) and set(filled) == set(range(plan.n_bins))
    total = sum(s * n for s, n in histogram.items())
    large = sum(n for s, n in histogram.items() if 2 * s > capacity)
    assert plan.n_bins >= max(large, -(-total // capacity))
    half_full = sum(1 for v in filled.values() if 2 * v <= capacity)
    assert half_full <= 1 + sum(1 for s, n in histogram.items() if capacity // 3 < s and 2 * s <= capacity and n)


def test_plan_goes_on_after_sizes_are_used_up():
    hot = Counter(60 if i % 3 == 0 else 10 + i * 7919 % 51 for i in range(3000))  # one size has over a third of the items
    for histogram in ({60: 3, 55: 2, 40: 1, 39: 1, 38: 1}, dict(hot)):
        plan = P.plan_containers(histogram, 100)
        filled = loads(plan, histogram)
        assert plan.used == histogram and max(filled.values()) <= 100
        assert sum(filled.values()) == sum(s * n for s, n in histogram.items())


def best_fit(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - s)
        else:
            gaps.append(capacity - s)
    return len(gaps)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=120))
def test_not_worse_than_best_fit_item_by_item(sizes):
    assert P.plan_containers(Counter(sizes), 100).n_bins <= best_fit(sizes, 100) * 1.05 + 1


def packed(spark, rows, capacities, **kw):
    df = spark.createDataFrame([(k, n, "x") for k, n in rows], "doc_id long, n_tokens int, container_id string")
    return P.pack(df, capacities, "doc_id", "n_tokens").collect()


def test_rows_parts_and_ties(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS_PER_BUCKET", 7)  # several buckets of ranks
    rows = [(i, 4) for i in range(90)] + [(200, 25), (201, None), (202, 0), (203, 10), (203, 10), (None, 3)]
    out = packed(spark, rows, [(1, 10), (2, 100), (3, 0)])
    for cap_id, cap in ((1, 10), (2, 100)):
        own = [r for r in out if r.capacity_id == cap_id]
        filled = Counter()
        for r in own:
            filled[r.container_id] += r.n_tokens
        assert all(v <= cap for v in filled.values()) and sum(filled.values()) == 90 * 4 + 25 + 20 + 3
        parts = sorted((r.part_no, r.token_from, r.n_tokens) for r in own if r.doc_id == 200)
        assert parts == ([(0, 0, 10), (1, 10, 10), (2, 20, 5)] if cap == 10 else [(0, 0, 25)])
        assert {r.doc_id for r in own if r.n_tokens == 0} == {201, 202}
        assert len(filled) <= -(-sum(filled.values()) // cap) * 1.3 + 1
    assert not [r for r in out if r.capacity_id == 3]


def test_empty(spark):
    assert packed(spark, [], [(1, 10)]) == [] and packed(spark, [(1, 5)], []) == []
    assert [r.container_id for r in packed(spark, [(1, 0), (2, None)], [(1, 10)])] == [0, 0]


def test_documents_fill_well(spark, small):
    from pagelattice.llm import queries

    for r in queries.p7_fill(spark, small).collect():
        assert r.fullest <= {1: 512, 2: 2048, 3: 8192}[r.capacity_id]
        assert r.fill > 0.95 or r.n_containers < 20


def test_large_capacities_and_many_sizes(spark, monkeypatch):
    """A capacity beyond any fixed bound is packed as any other; too many different sizes are refused, not cut."""
    df = spark.createDataFrame([(i, 10**6 * (i % 7 + 1)) for i in range(40)], "k long, n long")
    packed = P.pack(df, [(1, 10**7), (2, 2 * 10**9)], "k", "n").collect()
    for cap_id, cap in ((1, 10**7), (2, 2 * 10**9)):
        fill = {}
        for r in packed:
            if r.capacity_id == cap_id:
                fill[r.container_id] = fill.get(r.container_id, 0) + r.n_tokens
        assert sum(fill.values()) == sum(10**6 * (i % 7 + 1) for i in range(40)) and max(fill.values()) <= cap
    monkeypatch.setattr(P, "MOST_SIZES", 3)
    with pytest.raises(ValueError, match="different sizes"):
        P.pack(df, [(1, 10**7)], "k", "n")
