"""Parameter records: read from tables in markup, found in narrative text, merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from pagelattice.functions import registers as R
from pagelattice.functions import text as X

# What the headers of the columns of a parameter table hold.
COLUMNS = {
    "parameter": ("parameter",), "name": ("name",), "range": ("value range", "range"), "default": ("default",), "unit": ("unit",), "options": ("options", "description"),
    "dtype": ("data type", "datatype"), "mode": ("modification mode",), "effect": ("effective time",), "index": ("index",),
}
MERGED = "id string, name string, brief string, data_type string, access string, low double, high double, default double, low_text string, high_text string, default_text string, unit string, scale double, value_map array<struct<k:string,v:string>>, bit_layout array<struct<k:string,v:string>>, write_condition string, takes_effect string, source_page int, register_count int, priority int"


def column_at(header: Column, names: tuple[str, ...]) -> Column:
    """The first column whose header holds any of the names, from 0; null without one."""
    hits = F.transform(header, lambda h: F.exists(F.array(*(F.lit(n) for n in names)), lambda n: F.contains(h, n)))
    at = F.array_position(hits, True)
    return F.when(at > 0, (at - 1).cast("int"))


def html_tables(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, table_no, header (lower case), rows of each table in html. Nodes without a table don't reach the regular expressions."""
    tables = nodes.filter(F.contains(F.lower("html"), F.lit("<table"))).select(*keys, F.posexplode(X.tables_in(F.col("html"))).alias("table_no", "t"))
    rows = tables.select(*keys, "table_no", X.table_rows(F.col("t")).alias("all")).filter(F.size("all") > 0)
    return rows.select(*keys, "table_no", F.transform(F.get("all", 0), F.lower).alias("header"), F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))).alias("rows"))


def raw_records(tables: DataFrame, keys: list[str]) -> DataFrame:
    """keys, table_no, row_no, priority and the cells of each row with a parameter id, in upper case; missing cells are empty."""
    placed = tables.withColumns({f"at_{k}": column_at(F.col("header"), names) for k, names in COLUMNS.items()})
    priority = F.when(F.col("at_index").isNotNull() & F.col("at_dtype").isNotNull() & F.col("at_mode").isNotNull() & F.col("at_effect").isNotNull(), 3).when(F.col("at_range").isNotNull() & F.col("at_default").isNotNull(), 2).otherwise(1)
    rows = placed.filter(F.col("at_parameter").isNotNull() & F.col("at_name").isNotNull()).withColumn("priority", priority)
    rows = rows.select(*keys, "table_no", "priority", *(f"at_{k}" for k in COLUMNS), F.posexplode("rows").alias("row_no", "row"))
    rows = rows.filter((F.size("row") > F.col("at_parameter")) & (F.size("row") > F.col("at_name")))
    cell = lambda k: F.coalesce(F.trim(F.get("row", F.col(f"at_{k}"))), F.lit(""))
    out = rows.select(*keys, "table_no", "row_no", "priority", F.upper(cell("parameter")).alias("id"), *(cell(k).alias(f"{k}_text") for k in COLUMNS if k not in ("parameter", "index")))
    return out.filter(F.col("id").rlike(r"^[CFRU][0-9A-F]{2}\.[0-9A-F]{2}$"))


def typed_records(raw: DataFrame, keys: list[str], page: Column) -> DataFrame:
    """Records with typed values, of the shape of MERGED; a bit layout makes a bitfield."""
    opts = F.col("options_text")
    rng, printed, us, bits = R.range_value(F.col("range_text")), R.range_texts(F.col("range_text")), R.unit_and_scale(F.col("unit_text")), R.bit_layout(opts)
    kind = F.when(bits.isNotNull(), "bitfield").otherwise(R.data_type(F.col("dtype_text")))
    return raw.select(
        *keys, "table_no", "row_no", "id", F.when(F.col("name_text") != "", F.col("name_text")).otherwise(F.col("id")).alias("name"),
        F.when(~opts.isin("", "-"), opts).otherwise("No description in manual.").alias("brief"), kind.alias("data_type"), R.access_of(F.col("id")).alias("access"),
        rng["min"].alias("low"), rng["max"].alias("high"), R.number_value(F.col("default_text")).alias("default"),
        printed["min"].alias("low_text"), printed["max"].alias("high_text"), R.number_text(F.col("default_text")).alias("default_text"), us["unit"].alias("unit"), us["scale"].alias("scale"),
        F.when(bits.isNull(), R.value_map(opts)).alias("value_map"), bits.alias("bit_layout"), R.write_condition(F.col("mode_text")).alias("write_condition"), R.takes_effect(F.col("effect_text")).alias("takes_effect"),
        R.source_page(page).cast("int").alias("source_page"), R.register_count(kind).alias("register_count"), "priority",
    )


def in_groups(records: DataFrame, groups: DataFrame, scope: list[str]) -> DataFrame:
    """The records whose group is listed: scope and group_id (upper case) in groups."""
    return records.withColumn("group_id", F.substring_index("id", ".", 1)).join(groups.select(*scope, F.upper("group_id").alias("group_id")).distinct(), [*scope, "group_id"], "left_semi")


def _merge(m: Column, c: Column) -> Column:
    """One step of the merge: what is known of a parameter and the next record of it."""
    higher = c["priority"] > m["priority"]
    better = lambda k: F.when(higher & c[k].isNotNull() & ~c[k].cast("string").isin("", "-"), c[k]).otherwise(m[k])
    fill = lambda now, k: F.coalesce(now, c[k])
    real = lambda x, i: x.isNotNull() & (x != "") & (x != i)
    page = fill(better("source_page"), "source_page")
    page = F.when((c["priority"] == m["priority"]) & (c["source_page"] > page), c["source_page"]).otherwise(page)
    name, kind, brief = better("name"), better("data_type"), better("brief")
    has_bits = c["bit_layout"].isNotNull()
    return F.struct(
        m["id"].alias("id"), F.when(~real(name, m["id"]) & real(c["name"], m["id"]), c["name"]).otherwise(name).alias("name"),
        F.when(R.is_placeholder(brief) & ~R.is_placeholder(c["brief"]), c["brief"]).otherwise(brief).alias("brief"),
        F.when(has_bits, "bitfield").when((kind == "string") & (F.coalesce(c["data_type"], F.lit("string")) != "string"), c["data_type"]).otherwise(kind).alias("data_type"), better("access").alias("access"),
        F.coalesce(m["low"], F.when(m["high"].isNull(), c["low"])).alias("low"), F.coalesce(m["high"], F.when(m["low"].isNull(), c["high"])).alias("high"),
        fill(m["default"], "default").alias("default"), F.coalesce(m["low_text"], F.when(m["high"].isNull(), c["low_text"])).alias("low_text"), F.coalesce(m["high_text"], F.when(m["low"].isNull(), c["high_text"])).alias("high_text"), fill(m["default_text"], "default_text").alias("default_text"), fill(m["unit"], "unit").alias("unit"), fill(m["scale"], "scale").alias("scale"),
        F.when(~has_bits & m["bit_layout"].isNull(), fill(m["value_map"], "value_map")).alias("value_map"), F.coalesce(c["bit_layout"], m["bit_layout"]).alias("bit_layout"),
        fill(m["write_condition"], "write_condition").alias("write_condition"), fill(m["takes_effect"], "takes_effect").alias("takes_effect"), page.alias("source_page"),
        F.when(has_bits, F.greatest(F.lit(1), c["register_count"])).otherwise(F.greatest(m["register_count"], c["register_count"])).alias("register_count"), F.greatest(m["priority"], c["priority"]).alias("priority"),
    )


def merge_records(records: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """One record for each id of a scope: the records folded in order. A record of higher priority overrides, others fill in.

    The fold depends on the order, so a parameter's records meet in one task: as many as there are tables
    that list it in one manual.
    """
    fields = [x.split()[0] for x in MERGED.replace("struct<k:string,v:string>", "s").split(", ")]
    rows = records.select(*scope, F.struct(*order).alias("o"), F.struct(*fields).alias("r"))
    lists = rows.groupBy(*scope, F.col("r.id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "r"))), lambda x: x["r"]).alias("all"))
    folded = F.aggregate(F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))), F.get("all", 0).cast(f"struct<{MERGED.replace(' string', ':string').replace(' double', ':double').replace(' array', ':array').replace(' int', ':int')}>"), _merge)
    return lists.select(*scope, folded.alias("r")).select(*scope, "r.*")


def finished_records(merged: DataFrame) -> DataFrame:
    """Two-state registers become bool without range, and placeholder briefs are written from what is known."""
    two = (F.col("data_type") != "bitfield") & R.is_two_state(F.transform("value_map", lambda e: e["k"]), F.col("low"), F.col("high"))
    out = merged.withColumn("two", two).withColumns({"data_type": F.when(F.col("two"), "bool").otherwise(F.col("data_type")), "register_count": F.when(F.col("two"), 1).otherwise(F.col("register_count")), **{k: F.when(~F.col("two"), F.col(k)) for k in ("low", "high", "low_text", "high_text")}})
    ordered = F.array_sort("value_map", lambda a, b: F.when(a["k"].cast("int") < b["k"].cast("int"), -1).when(a["k"].cast("int") > b["k"].cast("int"), 1).otherwise(0))
    states = F.when((F.col("data_type") == "bool") & (F.size("value_map") > 0), F.array_join(F.transform(ordered, lambda e: F.concat(e["k"], F.lit("="), e["v"])), "; "))
    brief = R.brief_of(F.col("name"), F.col("low_text"), F.col("high_text"), states, F.col("default_text"), F.col("unit"), F.col("write_condition"), F.col("takes_effect"))
    return out.withColumn("brief", F.when(R.is_placeholder(F.col("brief")), brief).otherwise(F.col("brief"))).drop("two")


def record_registers(records: DataFrame) -> DataFrame:
    """Records in the columns of the table device_registers that links and checks read, and bit_layout; reg_id counts in each manual."""
    nth = F.row_number().over(Window.partitionBy("manual_id").orderBy("id")).cast("long")
    span = F.concat("low_text", F.lit("-"), "high_text")
    return records.select(nth.alias("reg_id"), "manual_id", F.col("id").alias("param_id"), F.lower(F.substring_index("id", ".", 1)).alias("group_id"), "data_type", span.alias("value_range"), "value_map", "bit_layout", F.lit(None).cast("string").alias("knowledge_ref"), R.modbus_block(F.col("id"), F.col("data_type")).alias("modbus"))


def mentions(nodes: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """keys, id, nth of each parameter id in a text, and the text around that very place (120 characters before, 160 after)."""
    t = nodes.select(*keys, text.alias("t")).filter(F.col("t") != "")
    between = F.transform(F.split("t", X.PARAMETER_ID, -1), F.length)
    ids = t.select(*keys, "t", between.alias("between"), F.posexplode(F.regexp_extract_all("t", F.lit(X.PARAMETER_ID), 0)).alias("nth", "id"))
    at = F.aggregate(F.slice("between", F.lit(1), F.col("nth") + 1), F.lit(1), lambda a, n: a + n) + 6 * F.col("nth")  # an id has six characters
    around = F.trim(F.substring("t", F.greatest(at - 120, F.lit(1)), F.when(at > 120, 120).otherwise(at - 1) + 166))
    return ids.select(*keys, "nth", "id", around.alias("around"))


def first_mentions(found: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """The first mention of each id of a scope."""
    values = [c for c in found.columns if c not in (*scope, "id")]
    first = found.groupBy(*scope, "id").agg(F.min_by(F.struct(*values), F.struct(*order)).alias("v"))
    return first.select(*scope, "id", "v.*")


def text_records(found: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """A record of the shape of MERGED for each id that found (mentions with their page) names: its first surroundings as brief, its first known page."""
    place = F.struct(*order)
    first = found.groupBy(*scope, "id").agg(F.min_by("around", place).alias("brief"), F.min_by("page", F.when(F.col("page").isNotNull(), place)).alias("page"))
    given = {"id": F.col("id"), "name": F.col("id"), "brief": F.col("brief"), "data_type": F.lit("uint16"), "access": R.access_of(F.col("id")), "source_page": R.source_page(F.col("page")), "register_count": F.lit(1), "priority": F.lit(0)}
    fields = StructType.fromDDL(MERGED)
    return first.select(*scope, *(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


def group_labels(lines: DataFrame, scope: list[str], order: str) -> DataFrame:
    """group_id and label of `| 8.n | Label (Cxx) |` lines; the last line of a group counts."""
    # fixed value: the line of a group in a manual's table of groups
    p = r"\|\s*8\.\d+\s*\|\s*([^|]+?)\s*\((?:[0-9A-Fa-f]+h/)?([CFRU][0-9A-Fa-f]{2})\)\s*\|"
    rows = lines.filter(F.col("line").rlike(p)).select(*scope, order, F.lower(F.regexp_extract("line", p, 2)).alias("group_id"), F.regexp_extract("line", p, 1).alias("label"))
    return rows.groupBy(*scope, "group_id").agg(F.max_by("label", order).alias("label"))


def gap_fill(existing: DataFrame, found: DataFrame, keys: list[str], fields: list[str], weak: dict[str, list[str]] | None = None) -> DataFrame:
    """Missing rows are added and null or weak fields filled from found; what is there stays, also where found has nothing. Rows of equal keys in found must be one.

    weak: values of a field that say as little as null, such as a placeholder brief.
    """
    strong = lambda x: F.when(~F.lower(F.trim(f"e.{x}")).isin(*weak[x]), F.col(f"e.{x}")) if x in (weak or {}) else F.col(f"e.{x}")
    e, f = existing.select(*keys, *fields).alias("e"), found.select(*keys, *fields).alias("f")
    on = [F.col(f"e.{k}") == F.col(f"f.{k}") for k in keys]
    return e.join(f, on, "full").select(*(F.coalesce(f"e.{k}", f"f.{k}").alias(k) for k in keys), *(F.coalesce(strong(x), F.col(f"f.{x}"), F.col(f"e.{x}")).alias(x) for x in fields))


def nth_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The second and later rows of equal keys."""
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("nth > 1")
