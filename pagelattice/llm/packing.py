"""Filling containers of fixed capacity with items of varying length.

Items are integers of tokens, so the whole packing problem is its histogram: how many items there are of each size,
at most as many numbers as there are different sizes. The plan is made on the histogram, for runs of equal containers at a time,
and the items are then dealt into it by their rank within their size. The plan therefore sees every item of the
corpus at once, while nothing but counts leaves the cluster.

Large items (above a third of the capacity) are matched greedily, two to a container at most, each with the largest
one that still fits; the smaller ones then fill the smallest gap that takes them (best fit), largest items first, and
open containers of their own when no gap does.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of one size and bucket that are numbered in one sorted run; different sizes, over all capacities, that a driver plans.
ROWS_PER_BUCKET, MOST_SIZES = 250_000, 1 << 22


class _Plan:
    """Runs of equal containers, and which ranks of which size go into them."""

    def __init__(self, capacity: int):
        self.capacity, self.n_bins = capacity, 0
        self.places: list[tuple[int, int, int, int]] = []  # size, first rank, first container, items of this run in each container
        self.used: dict[int, int] = {}  # ranks dealt of each size
        self.runs: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first container, length)
        self.gaps: list[int] = []

    def open(self, n: int) -> int:
        first, self.n_bins = self.n_bins, self.n_bins + n
        return first

    def deal(self, size: int, first: int, n: int, each: int) -> None:
        rank = self.used.get(size, 0)
        self.places.append((size, rank, first, each))
        self.used[size] = rank + n * each

    def leave(self, gap: int, first: int, n: int) -> None:
        if gap <= 0 or n <= 0:
            return
        if gap not in self.runs:
            self.runs[gap] = []
            insort(self.gaps, gap)
        runs = self.runs[gap]
        if runs and sum(runs[-1]) == first:
            runs[-1] = (runs[-1][0], runs[-1][1] + n)
        else:
            runs.append((first, n))

    def tightest(self, size: int) -> int | None:
        at = bisect_left(self.gaps, size)
        return self.gaps[at] if at < len(self.gaps) else None

    def take(self, gap: int) -> tuple[int, int]:
        run = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap]
            del self.gaps[bisect_left(self.gaps, gap)]
        return run

    def fill(self, size: int, n: int, first: int, length: int, gap: int) -> int:
        """Up to n items of a size into a run of containers with a gap; how many are left."""
        each = gap // size
        whole = min(length, n // each)
        if whole:
            self.deal(size, first, whole, each)
            self.leave(gap - each * size, first, whole)
            n -= whole * each
        if whole < length and n:  # the rest fits into one container of the run
            self.deal(size, first + whole, 1, n)
            self.leave(gap - n * size, first + whole, 1)
            whole, n = whole + 1, 0
        self.leave(gap, first + whole, length - whole)
        return n


def plan_containers(histogram: dict[int, int], capacity: int) -> _Plan:
    """A packing of histogram[size] items of each size from 1 to capacity."""
    plan = _Plan(capacity)
    third = capacity // 3
    large = {s: n for s, n in histogram.items() if s > third and n}
    order = sorted(large)
    for size in order[::-1]:  # a copy: sizes used up leave order meanwhile
        while (n := large[size]) > 0:
            at = bisect_left(order, capacity - size + 1) - 1
            while at >= 0 and not large[order[at]]:
                del order[at]  # used up
                at -= 1
            other = order[at] if at >= 0 else None
            if other is None or (other == size and n == 1 and at == 0):
                first = plan.open(n)
                plan.deal(size, first, n, 1)
                plan.leave(capacity - size, first, n)
                large[size] = 0
            elif other == size:
                if n == 1:  # itself is the largest that fits: look for the next smaller one
                    order.pop(at)
                    continue
                first = plan.open(n // 2)
                plan.deal(size, first, n // 2, 2)
                plan.leave(capacity - 2 * size, first, n // 2)
                large[size] = n % 2
            else:
                k = min(n, large[other])
                first = plan.open(k)
                plan.deal(size, first, k, 1)
                plan.deal(other, first, k, 1)
                plan.leave(capacity - size - other, first, k)
                large[size] -= k
                large[other] -= k
    for size in sorted((s for s, n in histogram.items() if 0 < s <= third and n), reverse=True):
        n = histogram[size]
        while n:
            gap = plan.tightest(size)
            if gap is None:
                length = -(-n // (capacity // size))
                n = plan.fill(size, n, plan.open(length), length, capacity)
            else:
                first, length = plan.take(gap)
                n = plan.fill(size, n, first, length, gap)
    if plan.used != {s: n for s, n in histogram.items() if s > 0 and n}:
        raise AssertionError("the plan does not hold the items of the histogram")
    return plan


def split_items(sizes: DataFrame, capacities: list[tuple[int, int]], key: str, size: str) -> DataFrame:
    """The items of each capacity: an item above it is cut into parts of exactly the capacity and a remainder."""
    caps = F.array(*(F.struct(F.lit(i).cast("int").alias("capacity_id"), F.lit(c).cast("int").alias("cap")) for i, c in capacities))
    n = F.col(size)
    each = sizes.select(F.col(key), n, F.explode(caps).alias("c")).select(F.col(key), n, "c.capacity_id", "c.cap")
    parts = F.greatest(F.ceil(n / F.col("cap")), F.lit(1)).cast("int")
    out = each.select("capacity_id", "cap", F.col(key), n, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part_no"))
    from_ = F.col("part_no").cast("long") * F.col("cap")
    return out.select("capacity_id", F.col(key), "part_no", from_.alias("token_from"), F.least(n - from_, F.col("cap")).cast("int").alias("n_tokens"))


def pack(sizes: DataFrame, capacities: list[tuple[int, int]], key: str, size: str) -> DataFrame:
    """capacity_id, key, part_no, token_from, n_tokens, container_id of every item for each capacity.

    sizes is read more than once: give a stored table. Containers are numbered from 0 for each capacity. An
    item above the capacity is split, others never. Items of size 0 (null counts as 0) need no room and go to
    container 0. Ties go by key; of repeated keys each row is an item of its own. Capacities below 1 are left
    out; without capacities or rows the result is empty. Capacities may be of any size; ValueError if items have more than MOST_SIZES different sizes.
    """
    capacities = [(i, c) for i, c in capacities if c is not None and c > 0]
    sizes = sizes.select(F.col(key), F.coalesce(F.col(size), F.lit(0)).alias(size))
    if not capacities:
        return split_items(sizes, [(0, 1)], key, size).withColumn("container_id", F.lit(0).cast("long")).filter(F.lit(False))
    items = split_items(sizes, capacities, key, size)
    counts = items.groupBy("capacity_id", "n_tokens").agg(F.count("*").alias("n")).limit(MOST_SIZES + 1).toPandas()  # one row for each size that is met
    if len(counts) > MOST_SIZES:
        raise ValueError(f"items of more than {MOST_SIZES} different sizes need a coarser unit")
    n_buckets = int(max(1, -(-int(counts["n"].max() if len(counts) else 1) // ROWS_PER_BUCKET)))

    plans = {}
    for cap_id, cap in capacities:
        own = counts[(counts["capacity_id"] == cap_id) & (counts["n_tokens"] > 0)]
        plans[cap_id] = plan_containers(dict(zip(own["n_tokens"].tolist(), own["n"].tolist())), cap).places
    place_of = _dealer(items.sparkSession, plans)

    # rank within a size, dealt out over buckets of keys: counts of earlier buckets + place in the own one
    bucketed = items.withColumn("bucket", F.pmod(F.xxhash64(key, "part_no"), F.lit(n_buckets)).cast("int"))
    own = Window.partitionBy("capacity_id", "n_tokens", "bucket").orderBy(key, "part_no")
    numbered = bucketed.withColumn("nth", F.row_number().over(own) - 1)
    if n_buckets > 1:
        sums = bucketed.groupBy("capacity_id", "n_tokens", "bucket").agg(F.count("*").alias("n"))
        before = Window.partitionBy("capacity_id", "n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("capacity_id", "n_tokens", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
        numbered = numbered.join(sums, ["capacity_id", "n_tokens", "bucket"]).withColumn("nth", F.col("nth") + F.col("earlier"))
    return numbered.select("capacity_id", key, "part_no", "token_from", "n_tokens", place_of("capacity_id", "n_tokens", F.col("nth").cast("long")).alias("container_id"))


def _dealer(spark, plans: dict[int, list[tuple[int, int, int, int]]]):
    """A column function from capacity, size and rank to the container. The plan has a few rows for each size at most."""
    rows = sorted((cap, *p) for cap, places in plans.items() for p in places)
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("long")
    def container(cap: pd.Series, size: pd.Series, rank: pd.Series) -> pd.Series:
        t = shared.value
        caps = np.unique(t[:, 0])
        pair = lambda c, s: (c << 33) + s  # noqa: E731  a size is below 2^33
        names = np.unique(pair(np.searchsorted(caps, t[:, 0]), t[:, 1]))
        place = lambda c, s, r: (np.searchsorted(names, pair(np.searchsorted(caps, c), s)) << 40) + r
        size_, rank_ = size.to_numpy(np.int64), rank.to_numpy(np.int64)
        if not len(t):
            return pd.Series(np.zeros(len(size_), np.int64))
        at = np.searchsorted(place(t[:, 0], t[:, 1], t[:, 2]), place(cap.to_numpy(np.int64), size_, rank_), side="right") - 1
        found = t[np.maximum(at, 0)]
        return pd.Series(np.where(size_ == 0, 0, found[:, 3] + (rank_ - found[:, 2]) // np.maximum(found[:, 4], 1)))

    return container


def fill_report(packed: DataFrame, capacities: list[tuple[int, int]]) -> DataFrame:
    """For each capacity: containers, items, tokens and the share of the room that is used."""
    caps = F.create_map(*(F.lit(x) for pair in capacities for x in pair))
    bins = packed.groupBy("capacity_id", "container_id").agg(F.sum("n_tokens").alias("filled"), F.count("*").alias("items"))
    out = bins.groupBy("capacity_id").agg(F.count("*").alias("n_containers"), F.sum("items").alias("n_items"), F.sum("filled").alias("n_tokens"), F.max("filled").alias("fullest"))
    return out.withColumn("fill", F.round(F.col("n_tokens") / (F.col("n_containers") * caps[F.col("capacity_id")]), 6))
