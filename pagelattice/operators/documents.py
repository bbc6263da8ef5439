"""The documents of a manual as nested rows: its registers, its index, its sections and the frontmatter of its topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelattice.functions import registers as R
from pagelattice.operators import links


def _map(entries: Column) -> Column:
    """Key-value structs as a map; null for null."""
    return F.when(entries.isNotNull(), F.map_from_arrays(F.transform(entries, lambda e: e["k"]), F.transform(entries, lambda e: e["v"])))


def labelled_groups(records: DataFrame, labels: DataFrame) -> DataFrame:
    """manual_id, id, label of the groups of a manual's records; a group without a label is called by its id in capitals.

    records: manual_id, id (of a parameter); labels: manual_id, group_id, label, one row a group.
    """
    groups = records.select("manual_id", F.lower(F.substring_index("id", ".", 1)).alias("id")).distinct()
    named = labels.select("manual_id", F.lower("group_id").alias("id"), "label")
    return groups.join(named, ["manual_id", "id"], "left").select("manual_id", "id", F.coalesce("label", F.upper("id")).alias("label"))


def parameter_entry(delta: int = -2) -> Column:
    """A finished record as the entry of a register document."""
    c = F.col
    limits = F.when(c("low").isNotNull() & c("high").isNotNull(), F.struct(c("low_text").alias("min"), c("high_text").alias("max")))
    modbus = R.modbus_block(c("id"), c("data_type"))
    return F.struct(
        c("id"), c("name"), F.lower(F.substring_index("id", ".", 1)).alias("group"), c("brief"), c("data_type"), c("access"), limits.alias("range"), c("default_text").alias("default"), c("scale"), c("unit"),
        _map(c("value_map")).alias("value_map"), _map(c("bit_layout")).alias("bit_layout"), F.array().cast("array<string>").alias("dependencies"), c("write_condition"), c("takes_effect"), F.lit(None).cast("string").alias("knowledge_ref"), c("source_page"),
        F.struct(F.struct(modbus["address"].alias("address"), modbus["address_hex"].alias("address_hex"), modbus["reg_table"].alias("table"), c("register_count").alias("register_count")).alias("modbus")).alias("protocols"),
    )


def register_documents(records: DataFrame, manuals: DataFrame, devices: DataFrame, labels: DataFrame, delta: int = -2) -> DataFrame:
    """manual_id and doc: the register document of each manual, parameters and groups in the order of their ids.

    records are finished ones with manual_id; a document holds one manual's parameters, as many as its device has.
    Manuals without records have none; a manual whose device is not listed has null names.
    """
    parameters = records.select("manual_id", parameter_entry(delta).alias("p")).groupBy("manual_id").agg(F.array_sort(F.collect_list("p"), lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)).alias("parameters"))
    groups = labelled_groups(records, labels).groupBy("manual_id").agg(F.array_sort(F.collect_list(F.struct("id", "label"))).alias("groups"))
    named = parameters.join(groups, "manual_id").join(manuals.select("manual_id", "device_id", "manual_source", "manual_revision", "manual_language"), "manual_id", "left").join(devices, "device_id", "left")
    modbus = F.struct(F.col("default_baud"), F.col("default_slave_id"), F.lit("1_based").alias("addressing"), F.lit("big_endian").alias("byte_order"), F.lit("big_endian").alias("word_order"))
    device = F.struct(
        "manufacturer", F.col("model_name").alias("model"), F.nullif("firmware", F.lit("")).alias("firmware"), "manual_source", "manual_revision", "manual_language", "device_type",
        F.struct(F.col("supported_protocols"), modbus.alias("modbus")).alias("communication"),
    )
    metadata = F.struct(F.lit("printed_manual_footer").alias("source_page_basis"), F.lit(delta).alias("pdf_file_page_1based_to_source_page_delta"))
    return named.select("manual_id", F.struct(F.lit("1.0").alias("schema_version"), metadata.alias("extraction_metadata"), device.alias("device"), "groups", "parameters").alias("doc"))


def index_documents(registers: DataFrame, knowledge: DataFrame, manuals: DataFrame, devices: DataFrame, day: Column | None = None) -> DataFrame:
    """manual_id and doc: the coverage index of each manual that has registers or topics; sections in the order of their path's parts, groups of their id.

    day: the date of the run, today by default.
    """
    entries = links.index_sections(knowledge).select("manual_id", F.struct(F.split("path", "/").alias("at"), F.struct("path", "title", "completeness", "confidence", "parameter_count").alias("e")).alias("s"))
    sections = entries.groupBy("manual_id").agg(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["e"]).alias("knowledge_sections"))
    reason = F.lit("No knowledge section generated from narrative content.").alias("reason")
    open_ = links.uncovered_groups(registers, knowledge).groupBy("manual_id").agg(F.array_sort(F.collect_list(F.struct(F.col("group_id").alias("group"), "parameter_count", reason))).alias("uncovered_groups"))
    totals = registers.groupBy("manual_id").agg(F.count("*").alias("total_parameters"))
    who = manuals.select("manual_id", "device_id", "parse_mode", "quality_score", "manual_source").join(devices.select("device_id", "manufacturer", F.col("model_name").alias("model"), "firmware"), "device_id", "left")
    every = totals.join(sections, "manual_id", "full").join(open_, "manual_id", "left").join(who, "manual_id", "left")
    none = lambda c: F.coalesce(F.col(c), F.filter(F.col(c), lambda x: F.lit(False)), F.from_json(F.lit("[]"), every.schema[c].dataType)).alias(c)
    metadata = F.struct((F.current_date() if day is None else day).cast("string").alias("extraction_date"), F.col("parse_mode").alias("parser_mode"), F.col("quality_score").alias("parse_quality_score"), "manual_source")
    doc = F.struct(F.lit("1.0").alias("schema_version"), F.struct("manufacturer", "model", "firmware").alias("device"), metadata.alias("extraction_metadata"), F.coalesce("total_parameters", F.lit(0)).alias("total_parameters"), none("knowledge_sections"), none("uncovered_groups"))
    return every.select("manual_id", doc.alias("doc"))


def frontmatters(sections: DataFrame, topics: DataFrame, diagrams: DataFrame, devices: DataFrame) -> DataFrame:
    """manual_id, section_id, rel_path and front: the whole frontmatter of each topic. topics: of topic_rows, paths unique; diagrams: of section_diagrams; devices: manual_id, device (its name)."""
    first, last = F.col("page_start"), F.col("page_end")
    pages = F.when(first.isNull(), F.array().cast("array<int>")).when(last >= first, F.sequence(first, last)).otherwise(F.array(first)).cast("array<int>")
    shown = diagrams.groupBy("section_id").agg(F.array_sort(F.collect_list(F.struct("source_page", "filename", "content_summary"))).alias("d"))
    rows = topics.join(sections.select("section_id", pages.alias("source_pages")), "section_id").join(shown, "section_id", "left").join(devices.select("manual_id", "device"), "manual_id", "left")
    related = F.transform("related_parameters", lambda x: F.struct(x.alias("id"), F.lit("Referenced in manual narrative").alias("role")))
    drawn = F.transform("d", lambda x: F.struct(x["filename"].alias("filename"), x["content_summary"].alias("content_summary"), x["source_page"].alias("source_page")))
    none = F.array().cast("array<string>")
    front = F.struct(
        "device", F.regexp_replace("rel_path", r"\.md$", "").alias("section"), "title", "source_pages", "extraction_confidence", "content_completeness", related.alias("related_parameters"), none.alias("prerequisites"), none.alias("see_also"),
        F.coalesce(drawn, F.filter(drawn, lambda x: F.lit(False)), F.from_json(F.lit("[]"), "array<struct<filename:string,content_summary:string,source_page:int>>")).alias("diagrams"),
    )
    return rows.select("manual_id", "section_id", "rel_path", front.alias("front"))


def section_documents(sections: DataFrame) -> DataFrame:
    """manual_id and doc: the sections of each manual as one list in their order, as a sections file holds them."""
    entry = F.struct("section_heading", F.array("page_start", "page_end").alias("page_range"), "content_type", "suggested_group", "suggested_knowledge_topic", "excerpt")
    return sections.groupBy("manual_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("sec_no", "section_id", entry.alias("e")))), lambda x: x["e"]).alias("doc"))


def as_files(documents: DataFrame, path: Column) -> DataFrame:
    """rel_path and content of each document, as JSON with its keys in order; JSON is YAML too. files.as_yaml writes the block style."""
    return documents.select(path.alias("rel_path"), F.to_json("doc", {"ignoreNullFields": "false"}).alias("content"))


def decoded_images(df: DataFrame, name: str, data: str) -> DataFrame:
    """name and content of images given in base64; entries that are none are left out."""
    return df.select(name, F.try_to_binary(F.col(data), F.lit("base64")).alias("content")).filter(F.col("content").isNotNull())


def tolerant_json(c: Column, path: str, kind: str) -> Column:
    """A value of a JSON text; null where the text is missing or cut off."""
    return F.try_variant_get(F.try_parse_json(c), path, kind)


def spot_rows(registers: DataFrame, k: int = 5) -> DataFrame:
    """k registers for review with their address and page as shown; - where there is none."""
    address = F.concat(F.lit("0x"), F.lower(F.hex("modbus.address")))
    return links.sampled(registers, k).select("reg_id", "param_id", F.coalesce(address, F.lit("-")).alias("address"), F.coalesce(F.col("source_page").cast("string"), F.lit("-")).alias("page"))


def all_parameter_ids(tables: DataFrame, texts: DataFrame) -> DataFrame:
    """manual_id, id, origin of the parameters of tables and of those that only texts name."""
    keys = ["manual_id", "id"]
    listed = tables.select(*keys).distinct()
    return listed.withColumn("origin", F.lit("table")).unionByName(texts.select(*keys).distinct().join(listed, keys, "left_anti").withColumn("origin", F.lit("text")))


def named_pages(registers: DataFrame, mentions: DataFrame) -> DataFrame:
    """reg_id and the page where the text first names the parameter, else its own. mentions: manual_id, id, named."""
    regs = registers.select("reg_id", "manual_id", F.upper(F.trim("param_id")).alias("id"), "source_page")
    return regs.join(mentions, ["manual_id", "id"], "left").select("reg_id", F.coalesce("named", "source_page").alias("source_page"))


