from datetime import datetime as T

import numpy as np
import pytest

from pagelattice.operators import orphans as O

REFS = "id long, m string, ref_key string, at timestamp_ntz, spans string, begins string, ends int, reason string, word long, h1 string"
PARENTS = "m string, ref_key string, begins timestamp_ntz, ends timestamp_ntz, id long"
D = lambda n: T(2024, 1, n)


def reasons(spark, refs, parents):
    r = spark.createDataFrame([(i, *x, "clash", "clash", 1, "old", 2, "clash") for i, x in enumerate(refs)], REFS)
    p = spark.createDataFrame([(*x, 9) for x in parents], PARENTS)
    return {x.id: x.reason for x in O.orphans(r, p, ["m"]).collect()}


def test_reasons(spark):
    parents = [("a", "k", D(5), D(9)), ("a", "k", D(12), None), ("a", "n", None, None), ("b", "k", D(1), None), ("a", "z", D(3), D(3)), (None, "k", D(1), None)]
    refs = [("a", "k", D(4)), ("a", "k", D(5)), ("a", "k", D(9)), ("a", "k", D(12)), ("a", "x", D(9)), ("a", "n", D(9)), ("a", "z", D(3)), ("a", "k", None), ("a", "x", None), (None, "k", D(9)), ("b", "k", D(1))]
    assert reasons(spark, refs, parents) == {0: "late", 2: "deleted", 4: "missing", 5: "missing", 6: "deleted", 8: "missing", 9: "missing"}


def test_empty_sides_and_repeats(spark):
    assert reasons(spark, [("a", "k", D(4))], []) == {0: "missing"}
    assert reasons(spark, [], [("a", "k", D(5), None)]) == {}
    r = spark.createDataFrame([(1, "a", "k", D(4))] * 3, "id long, m string, ref_key string, at timestamp_ntz")
    p = spark.createDataFrame([("a", "k", D(5), None)] * 4, "m string, ref_key string, begins timestamp_ntz, ends timestamp_ntz")
    assert [x.reason for x in O.orphans(r, p, ["m"]).collect()] == ["late"] * 3


@pytest.mark.parametrize("lifetimes", [2, 1000])  # 2: keys of more parents are laid out in ranges
def test_against_brute_force_with_a_hot_key(spark, monkeypatch, lifetimes):
    import random

    monkeypatch.setattr(O, "LIFETIMES", lifetimes)
    monkeypatch.setattr(O, "ROWS_PER_RANGE", 50)
    rng = random.Random(1)
    day = lambda: D(rng.randint(1, 28)) if rng.random() < 0.95 else None
    key = lambda: "hot" if rng.random() < 0.6 else rng.choice("abc")
    parents = [("m", key() if rng.random() < 0.97 else "late", D(rng.randint(3, 28)), day()) for _ in range(40)]
    parents = [(m, k, b, e if e is None or e >= b else b) for m, k, b, e in parents]
    refs = [("m", rng.choice(["hot", "hot", "a", "b", "c", "late", "no"]), day()) for _ in range(400)]
    want = {}
    for i, (_, k, at) in enumerate(refs):
        own = [(b, e) for _, k2, b, e in parents if k2 == k]
        if not own:
            want[i] = "missing"
        elif at is not None and not any(b <= at and (e is None or e > at) for b, e in own):
            want[i] = "deleted" if any(b <= at for b, _ in own) else "late"
    assert reasons(spark, refs, parents) == want


def test_filter_never_denies_a_parent(spark, monkeypatch):
    monkeypatch.setattr(O, "MAX_BITS", 1 << 10)  # far too small: all is verified by the join
    parents = spark.range(5000).selectExpr("cast(id as string) as k")
    bits = O.bloom_filter(parents, ["k"], 5000)
    assert len(bits) == 16
    assert parents.filter(~O.maybe_in(bits, parents, ["k"])).count() == 0
    monkeypatch.setattr(O, "MAX_BITS", 1 << 26)
    bits = O.bloom_filter(parents, ["k"], 5000)
    others = spark.range(5000, 25000).selectExpr("cast(id as string) as k")
    assert others.filter(O.maybe_in(bits, others, ["k"])).count() < 400
    assert parents.filter(~O.maybe_in(bits, parents, ["k"])).count() == 0
    assert not np.any(O.bloom_filter(parents.limit(0), ["k"], 0))


def test_keys(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(" ./a\\B.md \n",), ("img\\x\\y.png",), ("-",), ("  ",), (None,)], "r string")
    got = df.select(O.path_key(F.col("r")).alias("p"), O.path_key(F.col("r"), file=True).alias("f"), O.is_reference(F.col("r")).alias("is")).collect()
    assert (got[0].p, got[1].f) == ("a/B", "y.png")
    assert [bool(x["is"]) for x in got] == [True, True, False, False, False]
