"""Queries of the operators for training text: standing lines (p3), scanned text (p4), tokens (p6), containers (p7), subjects (p8)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelattice.llm import packing, scans, standing, subjects, tokens
from pagelattice.sources.tables import closed_list, kept, table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return standing.manual_standing_lines(table(spark, d, "parsed"), table(spark, d, "sections"))


def p3_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages without their standing lines."""
    parsed = table(spark, d, "parsed")
    return standing.without_lines(parsed, "page_id", "html", p3_found(spark, d), "parsed")


def p3_headings(spark: SparkSession, d: str) -> DataFrame:
    """The section headings, emptied where they are standing lines."""
    sections = table(spark, d, "sections")
    return standing.without_lines(sections, "section_id", "section_heading", p3_found(spark, d), "sections")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.repaired(table(spark, d, "parsed"), table(spark, d, "sections"))


def p4_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The continuous paragraphs of each page and excerpt."""
    return scans.repaired(table(spark, d, "parsed"), table(spark, d, "sections"), texts=True)


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_column(table(spark, d, "documents"), "doc_id", "text")


def p6_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """For each document whether its ids decode to the text."""
    documents = table(spark, d, "documents", "doc_id", "text")
    encoded = tokens.encode_column(documents, "doc_id", "text")
    decoded = tokens.decode_column(encoded, "doc_id", "ids", "decoded")
    return documents.join(decoded, "doc_id").select("doc_id", (F.coalesce("text", F.lit("")) == F.col("decoded")).alias("same"))


def _capacities(spark: SparkSession, d: str) -> list[tuple[int, int]]:
    """The closed list of container sizes."""
    return sorted((r["capacity_id"], r["capacity_tokens"]) for r in closed_list(table(spark, d, "capacities"), 1000))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    sizes = kept(tokens.encode_column(table(spark, d, "documents"), "doc_id", "text", "n_tokens", counts=True))
    return packing.pack(sizes, _capacities(spark, d), "doc_id", "n_tokens")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p7_containers(spark, d), _capacities(spark, d))


def p7_whole(spark: SparkSession, d: str) -> DataFrame:
    """For each capacity and document whether its parts are the whole text, none above the capacity and split only if the text alone exceeds it, and its containers not overfull."""
    sizes = kept(tokens.encode_column(table(spark, d, "documents"), "doc_id", "text", "n", counts=True))
    caps = F.create_map(*(F.lit(x) for pair in _capacities(spark, d) for x in pair))
    packed = kept(packing.pack(sizes, _capacities(spark, d), "doc_id", "n"))
    cap = caps[F.col("capacity_id")]
    filled = packed.groupBy("capacity_id", "container_id").agg((F.sum("n_tokens") <= F.first(cap)).alias("fits"))
    parts = packed.join(filled, ["capacity_id", "container_id"]).groupBy("capacity_id", "doc_id").agg(F.sum("n_tokens").alias("total"), F.count("*").alias("parts"), F.max("n_tokens").alias("most"), F.every("fits").alias("fits"))
    met = parts.join(sizes, "doc_id")
    fine = (F.col("total") == F.col("n")) & (F.col("parts") == F.greatest(F.lit(1), F.ceil(F.col("n") / cap))) & (F.col("most") <= cap) & F.col("fits")
    return met.select("capacity_id", "doc_id", fine.alias("whole"))


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).select("doc_id", "subject")


def p8_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(_subjects(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p3_found, p3_pages, p3_headings, p4_found, p4_paragraphs, p6_ids, p6_round_trip, p7_containers, p7_fill, p7_whole, p8_found, p8_composition)
}
SQL: dict[str, str] = {
    "p6_round_trip": "SELECT doc_id, true AS same FROM documents",
    "p7_whole": "SELECT capacity_id, doc_id, true AS whole FROM capacities, documents WHERE capacity_tokens > 0",
}
