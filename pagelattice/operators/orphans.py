"""References to records that do not exist (yet, or any more).

A Bloom filter of all parent keys is broadcast: a key outside it has certainly no parent, so those references
are orphans without a join. Only the references inside the filter are verified, by an exact join with the
lifetimes of the parents, of which a second filter, of the references, lets only those pass that some reference can mean.
The filters have a fixed largest size (MAX_BITS): with more keys they let more through to the exact join, and the
result stays the same.

A key has one row of lifetimes in that join, so a key with many references is split like any skewed side of a join.
A key with more than LIFETIMES parents is no row but a range layout: its parents and references are laid out
by time over as many tasks as they need, and the last end so far is carried on from range to range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelattice.sources.tables import kept

#: Largest filter in bits (16 MB), bits for each key, and probes.
MAX_BITS, BITS_PER_KEY, PROBES = 1 << 27, 12, 4
#: Lifetimes of a key that are one row of the join; rows of a range where keys have more.
LIFETIMES, ROWS_PER_RANGE = 1_000, 250_000


def _positions(h1: np.ndarray, h2: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The probed bits by double hashing; bits is a power of two."""
    a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    for i in range(PROBES):
        yield (a + np.uint64(i) * b) & np.uint64(bits - 1)


def _hashes(*cols: Column) -> list[Column]:
    return [F.xxhash64(*cols).alias("__h1"), F.xxhash64(F.lit("second"), *cols).alias("__h2")]


def bloom_filter(parents: DataFrame, cols: list[str], n: int) -> np.ndarray:
    """The filter of the rows of cols as an array of 64-bit words, sized for n keys up to MAX_BITS.

    Each task sets bits in its own array and sends the words that aren't zero; these are OR-ed per word
    in the cluster, so the driver gets MAX_BITS / 64 words at most.
    """
    bits = 1 << 10
    while bits < min(MAX_BITS, n * BITS_PER_KEY):
        bits *= 2

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 64, dtype=np.uint64)
        for b in batches:
            h1, h2 = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for at in _positions(h1, h2, bits):
                np.bitwise_or.at(own, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        words = own.view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(words[at])], names=["at", "word"])

    words = parents.select(*_hashes(*(F.col(c) for c in cols))).mapInArrow(fill, "at int, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words["at"].to_numpy()] = words["word"].to_numpy()
    return out


def maybe_in(filter_: np.ndarray, df: DataFrame, cols: list[str]) -> Column:
    """A boolean column of df: false only if the row's cols are certainly not in the filter."""
    shared = df.sparkSession.sparkContext.broadcast(filter_)

    @F.pandas_udf("boolean")
    def probe(h1: pd.Series, h2: pd.Series) -> pd.Series:
        words = shared.value.view(np.uint64)
        hit = np.ones(len(h1), dtype=bool)
        for at in _positions(h1.to_numpy(), h2.to_numpy(), len(words) * 64):
            hit &= (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return pd.Series(hit)

    return probe(*_hashes(*(F.col(c) for c in cols)))


_NEVER = "9999-12-31"


def _by_ranges(refs: DataFrame, parents: DataFrame, cols: list[str]) -> DataFrame:
    """refs with `reason` against the parents of the same cols: missing, late, deleted, or null.

    Parents and references are laid out together by key and time in ranges of about equal size, so the rows of
    one hot key are spread over as many ranges as they need. Within a range the last end so far is a running
    maximum; what earlier ranges of the same key hold comes from one row for each key and range.
    """
    others = [c for c in refs.columns if c not in (*cols, "reason")]
    end = F.coalesce("ends", F.lit(_NEVER).cast("timestamp_ntz"))
    once = parents.groupBy(*cols, "begins").agg(F.max(end).alias("ends"))  # those that began together are one
    row = F.struct(*others)
    born = once.select(*cols, F.col("begins").alias("__t"), F.lit(0).alias("__ref"), F.col("ends").alias("__end"), F.lit(None).cast(refs.select(row.alias("r")).schema["r"].dataType).alias("__row"))
    asked = refs.select(*cols, F.col("at").cast("timestamp_ntz").alias("__t"), F.lit(1).alias("__ref"), F.lit(None).cast("timestamp_ntz").alias("__end"), row.alias("__row"))
    n = max(int(refs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-refs.count() // ROWS_PER_RANGE))
    laid = kept(born.unionByName(asked).repartitionByRange(n, *cols, "__t", "__ref").withColumn("__range", F.spark_partition_id()))
    each = laid.groupBy(*cols, "__range").agg(F.max("__end").alias("__last"))
    by_key = Window.partitionBy(*cols)
    before = by_key.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carried = each.select(*cols, "__range", F.max("__last").over(before).alias("__carried"), F.max("__last").over(by_key).isNotNull().alias("__known"))
    so_far = F.max("__end").over(Window.partitionBy(*cols, "__range").orderBy("__t", "__ref").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = laid.withColumn("__so_far", so_far).filter("__ref = 1")
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*cols, "__range")]
    met = met.alias("m").join(carried.alias("c"), same).select(*(F.col(f"m.{c}").alias(c) for c in cols), "m.__row", F.greatest("m.__so_far", "c.__carried").alias("__end"), "c.__known")
    at = F.col("__row")["at"].cast("timestamp_ntz")
    reason = F.when(~F.col("__known"), "missing").when(at.isNull() | (F.col("__end") > at), None).when(F.col("__end").isNotNull(), "deleted").otherwise("late")
    return met.withColumn("reason", reason).select(*cols, *(F.col("__row")[c].alias(c) for c in others), "reason")


def _by_lifetimes(refs: DataFrame, parents: DataFrame, cols: list[str]) -> DataFrame:
    """As _by_ranges for keys of few parents: one row of lifetimes for each key is joined to the references."""
    end = F.coalesce("ends", F.lit(_NEVER).cast("timestamp_ntz"))
    lives = parents.groupBy(*cols).agg(F.collect_set(F.struct(F.col("begins").alias("b"), end.alias("e"))).alias("__lives"))
    at = F.col("at").cast("timestamp_ntz")
    begun = F.filter("__lives", lambda x: x["b"] <= at)
    reason = F.when(F.col("__lives").isNull(), "missing").when(at.isNull() | F.exists(begun, lambda x: x["e"] > at), None).when(F.size(begun) > 0, "deleted").otherwise("late")
    return refs.drop("reason").join(lives, cols, "left").withColumn("reason", reason).drop("__lives")


def _reasons(refs: DataFrame, parents: DataFrame, cols: list[str]) -> DataFrame:
    """refs with `reason`; refs and parents are read more than once."""
    hot = kept(parents.groupBy(*cols).agg(F.count("*").alias("__n")).filter(F.col("__n") > LIFETIMES).select(*cols))
    if hot.isEmpty():
        return _by_lifetimes(refs, parents, cols)
    few = _by_lifetimes(refs.join(hot, cols, "left_anti"), parents.join(hot, cols, "left_anti"), cols)
    many = _by_ranges(refs.join(hot, cols, "left_semi"), parents.join(hot, cols, "left_semi"), cols)
    return few.unionByName(many.select(*few.columns))


def orphans(refs: DataFrame, parents: DataFrame, scope: list[str]) -> DataFrame:
    """The references without a living target at their time, with the reason.

    refs: the columns of scope, ref_key, at (the time) and any others, which are kept; parents: the columns
    of scope, ref_key, begins, ends. reason: 'missing' if no parent has the key in the scope; 'late' if all
    begin after `at`; 'deleted' if some began by then and all of those ended by then. A parent without
    begin doesn't exist at any time and counts as none; one without end is alive for ever. A reference
    without time can't be placed: it is an orphan only if its target is missing. Null in a scope column or
    key matches nothing. Repeated references come out as often as they come in. Empty tables are fine: without
    parents, every reference is missing. A column `reason` of refs is replaced; parents' other columns are not read.
    """
    cols = [*scope, "ref_key"]
    n = parents.count()  # before keys are made, so that no column is read
    parents = parents.select(*cols, F.col("begins").cast("timestamp_ntz"), F.col("ends").cast("timestamp_ntz")).dropna(subset=[*cols, "begins"])
    hit = maybe_in(bloom_filter(parents, cols, n), refs, cols)
    probed = kept(refs.withColumn("__maybe", hit))
    missing = probed.filter(~F.col("__maybe")).drop("__maybe", "reason").withColumn("reason", F.lit("missing"))
    asked = probed.filter("__maybe").drop("__maybe")
    meant = kept(parents.filter(maybe_in(bloom_filter(asked, cols, asked.count()), parents, cols)))
    verified = _reasons(asked, meant, cols).filter(F.col("reason").isNotNull())
    return missing.unionByName(verified.select(*missing.columns))


def path_key(c: Column, *, file: bool = False) -> Column:
    """A path as key: trimmed, with / for \\, without a leading ./; file: the last part alone, else without a final .md."""
    p = F.regexp_replace(F.translate(trimmed(c), "\\", "/"), r"^\./", "")
    return F.regexp_extract(p, r"([^/]*)$", 1) if file else F.regexp_replace(p, r"\.md$", "")


def trimmed(c: Column) -> Column:
    """Without blanks of any kind at either end."""
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def is_reference(c: Column) -> Column:
    """Neither null nor blank nor a dash."""
    return c.isNotNull() & ~trimmed(c).isin("", "-")


# What each field refers to.
TARGETS = {"knowledge_ref": "topic", "see_also": "topic", "related_parameters": "register", "diagrams": "image"}


def manual_references(registers: DataFrame, knowledge: DataFrame) -> DataFrame:
    """All references of registers and topic files: src_table, row_id, manual_id, ref_field, target, ref_key, at; each key once for a row and field."""

    def keys(array: Column, field: str, raw) -> Column:
        key = lambda x: F.upper(trimmed(raw(x))) if field == "related_parameters" else path_key(raw(x), file=field == "diagrams")
        named = F.array_distinct(F.transform(F.filter(array, lambda x: is_reference(raw(x))), key))
        return F.coalesce(F.transform(named, lambda k: F.struct(F.lit(field).alias("f"), k.alias("k"))), F.array())

    found = F.concat(keys(F.col("related_parameters"), "related_parameters", lambda x: x["id"]), keys(F.col("see_also"), "see_also", lambda x: x), keys(F.col("diagrams"), "diagrams", lambda x: x["filename"]))
    know = knowledge.select(F.lit("knowledge").alias("src_table"), F.col("know_id").alias("row_id"), "manual_id", F.explode(found).alias("r"), F.col("written_at").alias("at"))
    know = know.select("src_table", "row_id", "manual_id", F.col("r.f").alias("ref_field"), F.col("r.k").alias("ref_key"), "at")
    ref = F.col("knowledge_ref")
    regs = registers.filter(is_reference(ref)).select(F.lit("device_registers").alias("src_table"), F.col("reg_id").alias("row_id"), "manual_id", F.lit("knowledge_ref").alias("ref_field"), path_key(ref).alias("ref_key"), F.col("linked_at").alias("at"))
    target = F.when(F.col("ref_field") == "related_parameters", TARGETS["related_parameters"]).when(F.col("ref_field") == "diagrams", TARGETS["diagrams"]).otherwise("topic")
    return regs.unionByName(know).filter(F.col("ref_key") != "").withColumn("target", target)


def manual_targets(registers: DataFrame, knowledge: DataFrame, images: DataFrame) -> DataFrame:
    """What references can point to: target, manual_id, ref_key, begins, ends."""
    reg = registers.select(F.lit("register").alias("target"), "manual_id", F.upper(trimmed(F.col("param_id"))).alias("ref_key"), F.col("extracted_at").alias("begins"), F.col("deleted_at").alias("ends"))
    top = knowledge.select(F.lit("topic").alias("target"), "manual_id", path_key(F.col("rel_path")).alias("ref_key"), F.col("written_at").alias("begins"), F.col("deleted_at").alias("ends"))
    img = images.select(F.lit("image").alias("target"), "manual_id", F.col("filename").alias("ref_key"), F.col("saved_at").alias("begins"), F.col("deleted_at").alias("ends"))
    return reg.unionByName(top).unionByName(img)


def orphan_references(registers: DataFrame, knowledge: DataFrame, images: DataFrame) -> DataFrame:
    """Every orphan reference of the manuals with its table, field, key, reason and month."""
    found = orphans(manual_references(registers, knowledge), manual_targets(registers, knowledge, images), ["target", "manual_id"])
    return found.select("src_table", "row_id", "ref_field", "ref_key", "reason", F.date_format("at", "yyyy-MM").alias("ref_month"))


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per table, field, month and reason."""
    return found.groupBy("src_table", "ref_field", "ref_month", "reason").agg(F.count("*").alias("n_refs"), F.countDistinct("row_id").alias("n_rows"))
