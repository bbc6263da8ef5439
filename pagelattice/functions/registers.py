"""Cells of parameter tables as typed values; column expressions throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelattice.functions.text import let

# Patterns of numbers, ranges, units and options that must match as the manuals' extractor matches.
_INT, _POWER = r"^-?\d+$", r"^(-?)2\^(\d+)(-1)?$"


def _blank(v: Column) -> Column:
    t = F.trim(F.coalesce(v, F.lit("")))
    return (t == "") | (t == "-")


def power_value(v: Column) -> Column:
    """An integer, or [-]2^n[-1] with n up to 124, as double; null for anything else."""

    def of(t: Column) -> Column:
        sign = F.when(F.startswith(t, F.lit("-")), -1.0).otherwise(1.0)
        power = sign * F.pow(F.lit(2.0), F.regexp_extract(t, _POWER, 2).try_cast("double")) - F.when(F.regexp_extract(t, _POWER, 3) == "-1", 1.0).otherwise(0.0)
        return F.when(t.rlike(_INT), t.try_cast("double")).when(t.rlike(_POWER) & (F.regexp_extract(t, _POWER, 2).try_cast("int") <= 124), power)

    return let(F.replace(F.trim(v), F.lit(" "), F.lit("")), of)


def number_value(v: Column) -> Column:
    """A plain number or power; null for - and other text."""
    plain = let(F.trim(v), lambda t: F.when(t.rlike(r"^-?\d+(\.\d+)?$"), t.try_cast("double")))
    return F.when(~_blank(v), F.coalesce(power_value(v), plain))


def _limits(v: Column, power, plain) -> Column:
    """struct(min, max) of a printed range by three grammars in turn, its ends read by power or plain; null if none fits."""
    compact = F.regexp_replace(F.replace(F.trim(v), F.lit(" "), F.lit("")), r"\^\{(\d+)\}", r"^$1")
    g1, g2 = r"^(\d+)-\((2\^\d+(?:-1)?)\)$", r"^\(?(-?2\^\d+)\)?-\(?(-?2\^\d+(?:-1)?)\)?$"
    g3 = r"(?i)^\s*(-?\d+(?:\.\d+)?)\s*(?:to|-)\s*(-?\d+(?:\.\d+)?)\s*$"
    ends = lambda t, p: F.array(F.regexp_extract(t, p, 1), F.regexp_extract(t, p, 2))
    texts = let(compact, lambda t: F.when(t.rlike(g1), ends(t, g1)).when(t.rlike(g2), ends(t, g2)))
    powers = F.transform(texts, power)
    plain_ = F.when(v.rlike(g3), F.transform(ends(v, g3), plain))
    both = lambda x: F.when(~F.exists(x, lambda y: y.isNull()), x)
    pair = F.coalesce(both(powers), both(plain_))
    return let(F.when(~_blank(v), pair), lambda x: F.when(x.isNotNull(), F.struct(F.get(x, 0).alias("min"), F.get(x, 1).alias("max"))))


def range_value(v: Column) -> Column:
    """struct(min, max) of a printed range by three grammars in turn; null if none fits."""
    return _limits(v, power_value, lambda t: t.try_cast("double"))


def _limit_text(t: Column) -> Column:
    """A plain number without needless zeros: 7 for 007, 0.5 for 0.50, 88.0 for 88.0."""
    short = F.regexp_replace(F.regexp_replace(t, r"^(-?)0+(?=\d)", "$1"), r"(\.\d+?)0+$", "$1")
    return F.when(short == "-0", "0").otherwise(short)


def _power_text(t: Column) -> Column:
    """An integer or power as digits; null for what power_value doesn't read."""
    return F.when(t.rlike(_INT), _limit_text(t)).when(t.rlike(_POWER), exact_integer(t).cast("string"))


def exact_integer(v: Column) -> Column:
    """An integer of 38 digits at most, or [-]2^n[-1] with n up to 124, as decimal(38,0), exactly; null for anything else."""

    def of(t: Column) -> Column:
        n = F.regexp_extract(t, _POWER, 2).try_cast("int")
        half = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k).cast("decimal(19,0)")
        power = (half(F.floor(n / 2).cast("int")) * half((n - F.floor(n / 2)).cast("int"))).cast("decimal(38,0)")
        signed = F.when(F.startswith(t, F.lit("-")), -power).otherwise(power) - F.when(F.regexp_extract(t, _POWER, 3) == "-1", F.lit(1)).otherwise(F.lit(0)).cast("decimal(1,0)")
        return F.when(t.rlike(_INT), t.try_cast("decimal(38,0)")).when(t.rlike(_POWER) & (n <= 124), signed.cast("decimal(38,0)"))

    return let(F.replace(F.trim(v), F.lit(" "), F.lit("")), of)


def number_text(v: Column) -> Column:
    """As number_value, as a brief prints it: whole numbers exactly, decimal ones with their point."""
    plain = let(F.trim(v), lambda t: F.when(t.rlike(r"^-?\d+(\.\d+)?$"), _limit_text(t)))
    return F.when(~_blank(v), F.coalesce(_power_text(F.replace(F.trim(v), F.lit(" "), F.lit(""))), plain))


def range_texts(v: Column) -> Column:
    """As range_value, with the limits as a brief prints them: whole numbers as such, decimal ones with their point."""
    return _limits(v, _power_text, _limit_text)


# Printed data types.
DATA_TYPES = {"u16": "uint16", "i16": "int16", "u32": "uint32", "i32": "int32", "f32": "float32", "bool": "bool"}


def data_type(v: Column) -> Column:
    """The printed type's name; string if unknown, uint16 if there is none."""
    t = F.lower(F.trim(v))
    out = F.when(F.coalesce(v, F.lit("")) == "", "uint16")
    for printed, name in DATA_TYPES.items():
        out = out.when(t == printed, name)
    return out.otherwise("string")


def register_count(data_type_: Column) -> Column:
    return F.when(data_type_.isin("uint32", "int32", "float32"), 2).otherwise(1)


def unit_and_scale(v: Column) -> Column:
    """struct(unit, scale): a leading number is the scale."""
    p = r"^([+-]?\d+(?:\.\d+)?)\s*(.+)$"

    def of(t: Column) -> Column:
        rest = F.trim(F.regexp_extract(t, p, 2))
        return F.struct(F.when(rest != "", rest).otherwise(t).alias("unit"), F.when(rest != "", F.regexp_extract(t, p, 1).try_cast("double")).alias("scale"))

    none = F.struct(F.lit(None).cast("string").alias("unit"), F.lit(None).cast("double").alias("scale"))
    return F.when(_blank(v), none).otherwise(let(F.trim(v), of))


def _last_wins(entries: Column) -> Column:
    """Key-value structs in order, of equal keys the last value at the first one's place."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    return F.transform(keys, lambda k: F.struct(k.alias("k"), F.element_at(F.filter(entries, lambda e: e["k"] == k), -1)["v"].alias("v")))


def value_map(v: Column) -> Column:
    """array of struct(k, v) of `n: label` options; null without any."""
    p = r"(-?\d+)\s*:\s*([^:]+?)(?=(?:\s+-?\d+\s*:)|$)"
    entries = F.arrays_zip(F.regexp_extract_all(F.trim(v), F.lit(p), 1).alias("k"), F.regexp_extract_all(F.trim(v), F.lit(p), 2).alias("v"))
    entries = F.transform(entries, lambda e: F.struct(e["k"].try_cast("bigint").cast("string").alias("k"), F.trim(F.regexp_replace(e["v"], r"\s+", " ")).alias("v")))
    return F.when(~_blank(v) & (F.size(entries) > 0), _last_wins(entries))


def bit_layout(v: Column) -> Column:
    """array of struct(k, v) of `BitNN: text` options; null without any."""
    t = F.trim(F.regexp_replace(v, r"\s+", " "))
    p = r"(?i)Bit(\d+)\s*:\s*(.*?)(?=Bit\d+\s*:|$)"
    entries = F.arrays_zip(F.regexp_extract_all(t, F.lit(p), 1).alias("k"), F.regexp_extract_all(t, F.lit(p), 2).alias("v"))
    entries = F.filter(F.transform(entries, lambda e: F.struct(e["k"].try_cast("bigint").cast("string").alias("k"), F.trim(e["v"]).alias("v"))), lambda e: e["v"] != "")
    return F.when(~_blank(v) & (F.size(entries) > 0), _last_wins(entries))


def write_condition(v: Column) -> Column:
    t = F.lower(v)
    return F.when(F.contains(t, F.lit("at stop")), "stopped").when(F.contains(t, F.lit("during operation")), "any_state")


def takes_effect(v: Column) -> Column:
    t = F.lower(v)
    return F.when(F.contains(t, F.lit("immediate")), "immediate").when(F.contains(t, F.lit("power")), "power_cycle")


def modbus_address(pid: Column) -> Column:
    """The hexadecimal digits of group and offset as one number."""
    return F.conv(F.concat(F.substring(pid, 2, 2), F.substring(pid, 5, 2)), 16, 10).cast("int")


def modbus_block(pid: Column, data_type_: Column) -> Column:
    a = modbus_address(pid)
    return F.struct(a.alias("address"), F.format_string("0x%04X", a).alias("address_hex"), F.lit("holding").alias("reg_table"), register_count(data_type_).alias("register_count"))


def source_page(page: Column, delta: int = -2) -> Column:
    """The printed page of a 0-based page; null for null."""
    return F.when(page.isNotNull(), F.greatest(F.lit(1), page + 1 + delta))


def access_of(pid: Column) -> Column:
    return F.when(F.startswith(pid, F.lit("U")), "read_only").otherwise("read_write")


def is_placeholder(brief: Column) -> Column:
    return F.coalesce(F.lower(F.trim(brief)), F.lit("")).isin("", "no description in manual.")


def is_two_state(map_keys: Column, low: Column, high: Column) -> Column:
    """Whether a value map names just 0 and 1 over the range 0 to 1."""
    return F.coalesce((F.array_sort(map_keys) == F.array(F.lit("0"), F.lit("1"))) & (low == 0) & (high == 1), F.lit(False))


def brief_of(name: Column, low: Column, high: Column, states: Column, default: Column, unit: Column, condition: Column, effect: Column) -> Column:
    """A sentence for each thing known of a parameter."""
    says = lambda c, before, after=".": F.when(c.isNotNull(), F.concat(F.lit(before), c.cast("string"), F.lit(after)))
    span = F.when(low.isNotNull() & high.isNotNull(), F.concat(F.lit("Range "), low, F.lit(" to "), high, F.lit(".")))
    return F.concat_ws(" ", name, span, says(states, "States: "), says(default, "Default "), says(F.nullif(unit, F.lit("")), "Unit "), says(condition, "Write condition "), says(effect, "Takes effect "))


# Ranks of completeness and confidence, from least.
COMPLETENESS, CONFIDENCE = ("stub", "partial", "complete"), ("low", "medium", "high")


def rank_of(c: Column, order: tuple[str, ...]) -> Column:
    """1 for the least; 0 for unknown."""
    return F.coalesce(F.array_position(F.array(*(F.lit(x) for x in order)), c), F.lit(0)).cast("int")


def confidence_of(length: Column) -> Column:
    return F.when(length > 500, "high").when(length > 150, "medium").otherwise("low")


def completeness_of(length: Column) -> Column:
    return F.when(length > 800, "complete").when(length > 250, "partial").otherwise("stub")
