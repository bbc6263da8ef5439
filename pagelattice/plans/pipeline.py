"""The whole run over many manuals: classify, merge, write topics, link, index, check. One application; sinks are the only actions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelattice.functions import classify as C
from pagelattice.functions import text as X
from pagelattice.operators import links, pages, records
from pagelattice.sources.tables import kept

#: Extractors by name: from the nodes of pages (pages.page_nodes) to parameter records. Manuals of another make register their own; there is no silent fallback.
EXTRACTORS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def extractor(name: str):
    def register(f: Callable[[DataFrame], DataFrame]):
        EXTRACTORS[name] = f
        return f

    return register


@extractor("tables")
def from_tables(nodes: DataFrame) -> DataFrame:
    """Nodes of pages.page_nodes to one finished record for each parameter of a manual: those of tables, and those that only text names."""
    keys = ["manual_id", "idx", "page_id", "node_seq", "page"]
    order = ["idx", "page_id", "node_seq"]
    table = C.has_table(F.col("html"))
    shown = nodes.filter(F.col("html").isNotNull()).select(*keys, table.alias("has_table"), F.when(table, F.col("html")).otherwise(X.clean_cell(F.col("html"))).alias("html"))
    shown = kept(shown.filter(F.col("has_table") | F.col("html").rlike(X.PARAMETER_ID)))  # read for tables and for text
    raw = records.raw_records(records.html_tables(shown.filter("has_table"), keys), keys)
    merged = kept(records.merge_records(records.typed_records(raw, keys, F.col("page")), ["manual_id"], [*order, "table_no", "row_no"]))
    named = records.text_records(records.mentions(shown.filter("not has_table"), keys, F.col("html")), ["manual_id"], [*order, "nth"])
    return records.finished_records(merged.unionByName(named.join(merged.select("manual_id", "id").hint("merge"), ["manual_id", "id"], "left_anti")))


@dataclass
class Run:
    """What a run is to do. hooks: functions applied to sections, topics or records, such as a language model's second reading or filling of gaps.

    with_registers None: registers are extracted where the run is given none, and those given are taken where it is.
    """

    extractor: str = "tables"
    with_registers: bool | None = True
    hooks: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)


def run(parsed: DataFrame, knowledge: DataFrame | None, registers: DataFrame | None, images: DataFrame, how: Run | None = None) -> dict[str, DataFrame]:
    """The tables of a run by name. With with_registers False, what needs registers is left out.

    Without knowledge or registers, the run's own topics or records are linked, indexed and checked; those of an
    earlier run take their place where given. Index totals and groups are always those of the run's own records.
    """
    how = how or Run()
    extracts = how.with_registers or (how.with_registers is None and registers is None)
    if extracts and how.extractor not in EXTRACTORS:
        raise ValueError(f"no extractor {how.extractor}; there are {sorted(EXTRACTORS)}")
    sections = pages.merged_sections(pages.classified_pages(pages.page_views(parsed)))
    if "sections" in how.hooks:
        sections = how.hooks["sections"](sections)
    out = {"sections": kept(sections.withColumn("section_id", F.xxhash64("manual_id", "sec_no")))}
    topics = pages.with_unique_paths(kept(pages.topic_rows(out["sections"], pages.section_bodies(out["sections"], parsed))))
    out["topics"] = kept(how.hooks["topics"](topics) if "topics" in how.hooks else topics)
    if knowledge is None:
        knowledge = kept(pages.topic_knowledge(out["topics"], pages.section_diagrams(out["sections"], parsed)))
    out["index"] = links.index_sections(knowledge)
    if how.with_registers is None and registers is not None:
        out["linked"] = links.link_parameters(registers, knowledge)
        out["uncovered"] = links.uncovered_groups(registers, knowledge)
        counts = registers.groupBy("manual_id").agg(F.count("*").alias("total"))
        out["findings"] = links.findings(registers, knowledge, images, counts)
    elif extracts:
        extracted = EXTRACTORS[how.extractor](pages.page_nodes(parsed))
        out["extracted"] = kept(how.hooks["records"](extracted) if "records" in how.hooks else extracted)
        own = records.record_registers(out["extracted"])
        if registers is None:
            registers = kept(own)
            out["linked"] = kept(links.link_parameters(registers, knowledge))
            checked = registers.drop("knowledge_ref").join(out["linked"].select("manual_id", "reg_id", F.col("ref").alias("knowledge_ref")), ["manual_id", "reg_id"])
        else:
            out["linked"] = links.link_parameters(registers, knowledge)
            checked = registers
        out["uncovered"] = links.uncovered_groups(registers, knowledge)
        counts = own.groupBy("manual_id").agg(F.count("*").alias("n"))
        totals = registers.select("manual_id").distinct().join(counts, "manual_id", "left").select("manual_id", F.coalesce("n", F.lit(0)).alias("total"))
        out["findings"] = links.findings(checked, knowledge, images, totals, own.select("manual_id", "group_id").distinct())
    return out


def failed(findings: DataFrame) -> bool:
    """Whether a check found an error."""
    return not findings.filter("severity = 'E'").isEmpty()
