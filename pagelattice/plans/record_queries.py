"""Queries of the general record operators: nested records (p1), units (p2), orphan references (p5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelattice.operators import nested, orphans, units
from pagelattice.sources.tables import kept, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten_records(table(spark, d, "parsed"), ["page_id"], payload=False).select("page_id", "kind", "item_seq", "parent_seq", "eff_page")


def p1_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The blocks with their place; those whose block_type or html is no string are shown as JSON text by the operator and as null here."""
    text = lambda c: F.when(~F.col(c).rlike(r'^(?:[\[{].*[\]}]|-?\d+(?:\.\d+)?|true|false)$'), F.col(c)).alias(c)
    return nested.block_table(table(spark, d, "parsed"), ["page_id", "manual_id"]).select("page_id", "manual_id", "node_seq", "parent_seq", "eff_page", text("block_type"), text("html"))


def p1_images(spark: SparkSession, d: str) -> DataFrame:
    return nested.image_table(table(spark, d, "parsed"), ["page_id", "manual_id"]).drop("node_post")


def p1_subtrees(spark: SparkSession, d: str) -> DataFrame:
    return nested.subtree_sizes(nested.block_table(table(spark, d, "parsed"), ["page_id"], payload=False), ["page_id"])


def p1_tables_below(spark: SparkSession, d: str) -> DataFrame:
    """For each block with blocks below, how many tables it contains, by interval containment."""
    blocks = kept(nested.block_table(table(spark, d, "parsed"), ["page_id"]).drop("html"))  # read twice
    counted = nested.counted_below(blocks, ["page_id"], F.coalesce(F.col("block_type") == "Table", F.lit(False)))
    return counted.filter("n > 0").select("page_id", F.col("node_seq").alias("anc_seq"), F.col("n").alias("n_tables"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return units.to_base_units(table(spark, d, "device_registers")).filter(F.col("base_value").isNotNull()).select("reg_id", "value_field", "base_unit", "base_value")


def p2_units(spark: SparkSession, d: str) -> DataFrame:
    return units.unit_usage(units.to_base_units(table(spark, d, "device_registers")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_references(table(spark, d, "device_registers"), table(spark, d, "knowledge"), table(spark, d, "images"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(p5_found(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_blocks, p1_images, p1_subtrees, p1_tables_below, p2_found, p2_units, p5_found, p5_report)
}

_KEY = r"regexp_replace(replace(regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', ''), '\', '/'), '^\./', '')"
_PATH = r"regexp_replace(" + _KEY + r", '\.md$', '')"
_FILE = "regexp_extract(" + _KEY + ", '([^/]*)$', 1)"
_P5 = f"""
WITH raw AS (
  SELECT 'device_registers' AS src_table, reg_id AS row_id, manual_id, 'knowledge_ref' AS ref_field, 'topic' AS target, knowledge_ref AS raw, {_PATH.format("knowledge_ref")} AS ref_key, linked_at AS ts FROM device_registers
  UNION ALL SELECT 'knowledge', know_id, manual_id, 'related_parameters', 'register', u.id, upper(trim(u.id)), written_at FROM (SELECT know_id, manual_id, written_at, unnest(related_parameters) AS u FROM knowledge)
  UNION ALL SELECT 'knowledge', know_id, manual_id, 'see_also', 'topic', u, {_PATH.format("u")}, written_at FROM (SELECT know_id, manual_id, written_at, unnest(see_also) AS u FROM knowledge)
  UNION ALL SELECT 'knowledge', know_id, manual_id, 'diagrams', 'image', u.filename, {_FILE.format("u.filename")}, written_at FROM (SELECT know_id, manual_id, written_at, unnest(diagrams) AS u FROM knowledge)
), refs AS (
  SELECT DISTINCT src_table, row_id, manual_id, ref_field, target, ref_key, ts FROM raw WHERE raw IS NOT NULL AND trim(raw) NOT IN ('', '-') AND ref_key <> ''
), targets AS (
  SELECT 'register' AS target, manual_id, upper(trim(param_id)) AS ref_key, extracted_at AS begins, deleted_at AS ends FROM device_registers
  UNION ALL SELECT 'topic', manual_id, {_PATH.format("rel_path")}, written_at, deleted_at FROM knowledge
  UNION ALL SELECT 'image', manual_id, filename, saved_at, deleted_at FROM images
), met AS (
  SELECT r.src_table, r.row_id, r.ref_field, r.ref_key, r.ts, count(t.begins) AS n, count(*) FILTER (WHERE t.begins <= r.ts) AS begun,
    count(*) FILTER (WHERE t.begins <= r.ts AND (t.ends IS NULL OR t.ends > r.ts)) AS living
  FROM refs r LEFT JOIN targets t ON t.target = r.target AND t.manual_id = r.manual_id AND t.ref_key = r.ref_key
  GROUP BY ALL
), found AS (
  SELECT src_table, row_id, ref_field, ref_key, CASE WHEN n = 0 THEN 'missing' WHEN begun = 0 THEN 'late' ELSE 'deleted' END AS reason, strftime(ts, '%Y-%m') AS ref_month
  FROM met WHERE n = 0 OR (ts IS NOT NULL AND living = 0)
)
"""

_WALK = """
WITH RECURSIVE walk AS (
  SELECT page_id, CAST([] AS INT[]) AS path, CAST(children AS JSON) AS v, CAST([] AS INT[]) AS parent, coalesce(page, -1) AS eff FROM parsed WHERE json_valid(children)
  UNION ALL
  SELECT page_id, list_append(path, CAST(i AS INT)), item, CASE WHEN json_type(v) = 'OBJECT' THEN path ELSE parent END, eff2 FROM (
    SELECT *, unnest(items) AS item, generate_subscripts(items, 1) AS i FROM (
      SELECT *, CASE WHEN json_type(v) = 'ARRAY' THEN from_json(v, '["JSON"]') ELSE [json_extract(v, '$.children')] END AS items,
        CASE WHEN json_type(v) = 'OBJECT' AND json_type(v, '$.page') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract_string(v, '$.page') AS INT) ELSE eff END AS eff2
      FROM walk WHERE json_type(v) IN ('ARRAY', 'OBJECT'))
  ) WHERE json_type(item) IN ('ARRAY', 'OBJECT')
), nodes AS (
  SELECT page_id, path, parent, v, row_number() OVER (PARTITION BY page_id ORDER BY path) AS seq, CASE WHEN json_type(v, '$.page') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract_string(v, '$.page') AS INT) ELSE eff END AS eff
  FROM walk WHERE json_type(v) = 'OBJECT'
), numbered AS (
  SELECT n.page_id, n.seq, coalesce(p.seq, 0) AS parent_seq, n.eff, n.v FROM nodes n LEFT JOIN nodes p ON p.page_id = n.page_id AND p.path = n.parent AND len(n.path) > len(p.path)
), pictures AS (
  SELECT page_id, seq, eff, unnest(found) AS x, generate_subscripts(found, 1) AS no FROM (
    SELECT page_id, seq, eff, list_filter(CASE json_type(v, '$.images') WHEN 'ARRAY' THEN from_json(json_extract(v, '$.images'), '["JSON"]') WHEN 'OBJECT' THEN [json_extract(v, '$.images')] ELSE [] END, lambda x: json_type(x) = 'OBJECT') AS found FROM numbered)
)
"""

_BELOW = """, below AS (
  SELECT page_id, seq, parent_seq AS anc FROM numbered WHERE parent_seq > 0
  UNION ALL SELECT b.page_id, b.seq, n.parent_seq FROM below b JOIN numbered n ON n.page_id = b.page_id AND n.seq = b.anc WHERE n.parent_seq > 0
)
"""

SQL: dict[str, str] = {
    "p1_found": _WALK + """
SELECT page_id, 'node' AS kind, 0 AS item_seq, -1 AS parent_seq, coalesce(page, -1) AS eff_page FROM parsed
UNION ALL SELECT page_id, 'node', CAST(seq AS INT), CAST(parent_seq AS INT), eff FROM numbered
UNION ALL SELECT page_id, 'image', CAST(no AS INT), CAST(seq AS INT), eff FROM pictures""",
    "p1_blocks": _WALK + """, deep AS (
  SELECT *, json_extract_string(v, '$.block_type') AS kind FROM numbered)
SELECT d.page_id, p.manual_id, CAST(d.seq AS INT) AS node_seq, CAST(d.parent_seq AS INT) AS parent_seq, d.eff AS eff_page,
  CASE WHEN json_type(d.v, '$.block_type') = 'VARCHAR' THEN kind END AS block_type, CASE WHEN json_type(d.v, '$.html') = 'VARCHAR' THEN json_extract_string(d.v, '$.html') END AS html
FROM deep d JOIN parsed p ON p.page_id = d.page_id""",
    "p1_images": _WALK + """
SELECT i.page_id, p.manual_id, CAST(seq AS INT) AS node_seq, CAST(no AS INT) AS image_no, eff AS eff_page, CASE WHEN json_type(x, '$.src') = 'VARCHAR' THEN json_extract_string(x, '$.src') END AS src, CASE WHEN json_type(x, '$.alt') = 'VARCHAR' THEN json_extract_string(x, '$.alt') END AS alt
FROM pictures i JOIN parsed p ON p.page_id = i.page_id""",
    "p1_subtrees": _WALK + _BELOW + "SELECT n.page_id, CAST(n.seq AS INT) AS node_seq, CAST(n.parent_seq AS INT) AS parent_seq, CAST(count(b.seq) AS INT) AS n_descendants FROM numbered n LEFT JOIN below b ON b.page_id = n.page_id AND b.anc = n.seq GROUP BY ALL",
    "p1_tables_below": _WALK + _BELOW + "SELECT b.page_id, CAST(b.anc AS INT) AS anc_seq, count(*) AS n_tables FROM below b JOIN numbered n ON n.page_id = b.page_id AND n.seq = b.seq WHERE json_extract_string(n.v, '$.block_type') = 'Table' GROUP BY ALL",
    "p5_found": _P5 + "SELECT * FROM found",
    "p5_report": _P5 + "SELECT src_table, ref_field, ref_month, reason, count(*) AS n_refs, count(DISTINCT row_id) AS n_rows FROM found GROUP BY ALL",
}
