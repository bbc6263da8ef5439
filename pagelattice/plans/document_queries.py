"""Queries of whole trees, documents and document checks over the test tables, and the same results in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelattice.functions import registers as R
from pagelattice.functions import text as X
from pagelattice.operators import documents, links, pages, records
from pagelattice.plans import manual_queries as M
from pagelattice.sources.tables import kept, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


_NODES = """nodes AS (
  SELECT manual_id, idx, page_id, 0 AS node_seq, html FROM parsed
  UNION ALL SELECT manual_id, idx, page_id, row_number() OVER (PARTITION BY page_id ORDER BY t.id), CASE WHEN json_type(t.value, '$.html') = 'VARCHAR' THEN json_extract_string(t.value, '$.html') END
  FROM (SELECT *, CASE WHEN json_valid(children) THEN children ELSE '[]' END AS tree FROM parsed) p, json_tree(p.tree) t WHERE t.type = 'OBJECT')"""


@query(f"WITH {_NODES} SELECT page_id, count(*) AS n_nodes, count(html) AS n_html FROM nodes GROUP BY 1")
def t4_all_nodes(spark, d):
    """The objects of each page at any depth and under any key, and those with markup."""
    nodes = pages.page_nodes(table(spark, d, "parsed"))
    is_text = ~F.coalesce(F.col("html"), F.lit("[]")).rlike(r'^(?:[\[{].*[\]}]|-?\d+(?:\.\d+)?|true|false)$') | (F.col("node_seq") == 0)  # other values are shown as JSON text
    return nodes.groupBy("page_id").agg(F.count("*").alias("n_nodes"), F.count(F.when(is_text, F.col("html"))).alias("n_html"))


_CELLS = f"list_filter(list_transform(regexp_extract_all(t, '(?is)<tr[^>]*>(.*?)</tr>', 1), lambda r: list_transform(regexp_extract_all(r, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1), lambda c: {M.s_cell('c')})), lambda r: len(r) > 0)"
_TABLES = f"""tabs AS (SELECT page_id, node_seq, unnest(found) AS t, generate_subscripts(found, 1) - 1 AS table_no FROM (SELECT page_id, node_seq, regexp_extract_all(html, '(?is)<table[^>]*>.*?</table>', 0) AS found FROM nodes WHERE contains(lower(html), '<table'))),
read AS (SELECT page_id, node_seq, table_no, {_CELLS} AS cells FROM tabs),
placed AS (SELECT *, list_position(list_transform(cells[1], lambda h: contains(lower(h), 'parameter')), true) AS p, list_position(list_transform(cells[1], lambda h: contains(lower(h), 'name')), true) AS n,
  CASE WHEN len(list_filter(cells[1], lambda h: contains(lower(h), 'range'))) > 0 AND len(list_filter(cells[1], lambda h: contains(lower(h), 'default'))) > 0 THEN 2 ELSE 1 END AS priority FROM read WHERE len(cells) > 0),
listed AS (SELECT page_id, node_seq, table_no, p, n, priority, unnest(cells[2:]) AS r, generate_subscripts(cells[2:], 1) - 1 AS row_no FROM placed WHERE p > 0 AND n > 0)"""


@query(f"WITH {_NODES}, {_TABLES} SELECT page_id, CAST(node_seq AS INT) AS node_seq, CAST(table_no AS INT) AS table_no, CAST(row_no AS INT) AS row_no, priority, upper(trim(r[p])) AS id, trim(r[n]) AS name_text FROM listed WHERE len(r) >= greatest(p, n) AND regexp_matches(upper(trim(r[p])), '^[CFRU][0-9A-F]{{2}}\\.[0-9A-F]{{2}}$')")
def f14_parsed_records(spark, d):
    """The rows with a parameter id of every table in the tree of every page."""
    keys = ["page_id", "node_seq"]
    nodes = pages.page_nodes(table(spark, d, "parsed"))
    return records.raw_records(records.html_tables(nodes, keys), keys).select(*keys, "table_no", "row_no", "priority", "id", "name_text")


@query(f"""WITH {_NODES}, plain AS (SELECT manual_id, idx, page_id, node_seq, {M.s_cell("html")} AS t FROM nodes WHERE html IS NOT NULL AND NOT contains(lower(html), '<table')),
met AS (SELECT *, unnest(regexp_extract_all(t, '{M._S_ID}')) AS id, generate_subscripts(regexp_extract_all(t, '{M._S_ID}'), 1) - 1 AS nth FROM plain),
spots AS (SELECT *, 1 + 6 * nth + CAST(list_sum(list_transform(string_split_regex(t, '{M._S_ID}')[1:nth + 1], lambda x: length(x))) AS BIGINT) AS pos_ FROM met)
SELECT manual_id, id, arg_min(trim(substr(t, greatest(pos_ - 120, 1), least(120, pos_ - 1) + 166)), (idx, page_id, node_seq, nth)) AS brief FROM spots GROUP BY ALL""")
def a3_text_records(spark, d):
    """A record for each parameter that the text of any node names, with the text around its first mention."""
    keys = ["manual_id", "idx", "page_id", "node_seq", "page"]
    nodes = pages.page_nodes(table(spark, d, "parsed"))
    plain = nodes.filter(F.col("html").isNotNull() & ~F.contains(F.lower("html"), F.lit("<table")))
    found = records.mentions(plain, keys, X.clean_cell(F.col("html")))
    return records.text_records(found, ["manual_id"], ["idx", "page_id", "node_seq", "nth"]).select("manual_id", "id", "brief")


@query(f"WITH v AS (SELECT reg_id, default_value, CASE WHEN reg_id % 3 = 0 THEN '2^' || (reg_id % 100) ELSE '-2^' || (reg_id % 100) || '-1' END AS p FROM device_registers) SELECT reg_id, {M.s_printed('default_value')} AS printed, {M.s_printed('p')} AS power FROM v")
def f26_printed_numbers(spark, d):
    """Defaults, and powers up to 2^99, exactly as printed."""
    regs = table(spark, d, "device_registers", "reg_id", "default_value")
    n = F.concat(F.lit("2^"), (F.col("reg_id") % 100).cast("string"))
    power = F.when(F.col("reg_id") % 3 == 0, n).otherwise(F.concat(F.lit("-"), n, F.lit("-1")))
    return regs.select("reg_id", R.number_text(F.col("default_value")).alias("printed"), R.number_text(power).alias("power"))


_FIRST = f"{M._S_ROWS}, firsts AS (SELECT * FROM rows QUALIFY row_number() OVER (PARTITION BY manual_id, id ORDER BY block, row_no) = 1)"
_LABELS = "labels AS (SELECT DISTINCT manual_id, lower(group_id) AS g, 'Group ' || upper(group_id) AS label FROM device_registers WHERE regexp_matches(group_id, '[02468]$'))"


def _first_records(spark, d):
    w = Window.partitionBy("manual_id", "id").orderBy("block", "row_no")
    typed = M._typed(spark, d).withColumn("nth", F.row_number().over(w)).filter("nth = 1").drop("nth")
    return records.finished_records(typed)


def _labels(spark, d):
    g = F.col("group_id")
    return table(spark, d, "device_registers").filter(g.rlike("[02468]$")).select("manual_id", F.lower(g).alias("group_id"), F.concat(F.lit("Group "), F.upper(g)).alias("label")).distinct()


@query(f"WITH {_FIRST}, {_LABELS} SELECT DISTINCT f.manual_id, lower(split_part(f.id, '.', 1)) AS id, coalesce(l.label, upper(split_part(f.id, '.', 1))) AS label FROM firsts f LEFT JOIN labels l ON l.manual_id = f.manual_id AND l.g = lower(split_part(f.id, '.', 1))")
def j4_labelled_groups(spark, d):
    """The groups of each manual's records with their labels, else their id in capitals."""
    return documents.labelled_groups(_first_records(spark, d), _labels(spark, d))


@query(f"""WITH {_FIRST}, {_LABELS}, g AS (SELECT manual_id, list_sort(list(DISTINCT gid || '=' || lab)) AS groups FROM (SELECT f.manual_id, lower(split_part(f.id, '.', 1)) AS gid, coalesce(l.label, upper(split_part(f.id, '.', 1))) AS lab FROM firsts f LEFT JOIN labels l ON l.manual_id = f.manual_id AND l.g = lower(split_part(f.id, '.', 1))) GROUP BY 1)
SELECT f.manual_id, '1.0' AS schema_version, any_value(v.manufacturer) AS manufacturer, any_value(v.model_name) AS model, any_value(nullif(v.firmware, '')) AS firmware, any_value(v.default_baud) AS baud, any_value(g.groups) AS groups,
list_sort(list(f.id || ' ' || name_text_or_id || ' ' || CASE WHEN f.id LIKE 'U%' THEN 'read_only' ELSE 'read_write' END || ' ' || CAST('0x' || f.id[2:3] || f.id[5:6] AS INT) || ' ' || printf('0x%04X', CAST('0x' || f.id[2:3] || f.id[5:6] AS INT)))) AS parameters
FROM (SELECT *, CASE WHEN name_text <> '' THEN name_text ELSE id END AS name_text_or_id FROM firsts) f JOIN g ON g.manual_id = f.manual_id LEFT JOIN manuals m ON m.manual_id = f.manual_id LEFT JOIN devices v ON v.device_id = m.device_id GROUP BY 1""")
def f42_register_documents(spark, d):
    """The register document of each manual with its parameters as entries; shown here in part."""
    docs = documents.register_documents(_first_records(spark, d), table(spark, d, "manuals"), table(spark, d, "devices"), _labels(spark, d))
    p = F.transform("doc.parameters", lambda x: F.concat_ws(" ", x["id"], x["name"], x["access"], x["protocols"]["modbus"]["address"].cast("string"), x["protocols"]["modbus"]["address_hex"]))
    return docs.select("manual_id", F.col("doc.schema_version"), F.col("doc.device.manufacturer"), F.col("doc.device.model"), F.col("doc.device.firmware"), F.col("doc.device.communication.modbus.default_baud").alias("baud"), F.transform("doc.groups", lambda g: F.concat(g["id"], F.lit("="), g["label"])).alias("groups"), p.alias("parameters"))


@query(r"""WITH c AS (SELECT DISTINCT manual_id, split_part(regexp_replace(rel_path, '\.md$', ''), '/', 1) AS c FROM knowledge),
u AS (SELECT manual_id, list_sort(list(group_id || ' ' || n)) AS uncovered FROM (SELECT manual_id, group_id, count(*) AS n FROM device_registers g WHERE coalesce(group_id, '') <> '' AND NOT EXISTS (SELECT 1 FROM c WHERE c.manual_id = g.manual_id AND (c = group_id OR c = split_part(group_id, '/', 1))) GROUP BY ALL) GROUP BY 1),
t AS (SELECT manual_id, count(*) AS n FROM device_registers GROUP BY 1), s AS (SELECT manual_id, list(rel_path || ' ' || CASE WHEN coalesce(content_completeness, '') <> '' THEN content_completeness ELSE 'partial' END || ' ' || CASE WHEN coalesce(extraction_confidence, '') <> '' THEN extraction_confidence ELSE 'medium' END || ' ' || coalesce(len(related_parameters), 0) ORDER BY string_split(rel_path, '/'), title NULLS FIRST, content_completeness, extraction_confidence, len(related_parameters)) AS sections FROM knowledge GROUP BY 1)
SELECT coalesce(t.manual_id, s.manual_id) AS manual_id, coalesce(n, 0) AS total_parameters, list_sort(coalesce(sections, [])) AS sections, coalesce(uncovered, []) AS uncovered, v.model_name AS model, m.quality_score AS score, '2024-02-03' AS "day"
FROM t FULL JOIN s ON s.manual_id = t.manual_id LEFT JOIN u ON u.manual_id = coalesce(t.manual_id, s.manual_id) LEFT JOIN manuals m ON m.manual_id = coalesce(t.manual_id, s.manual_id) LEFT JOIN devices v ON v.device_id = m.device_id""")
def f43_index_documents(spark, d):
    """The coverage index of each manual with its entries; shown here in part."""
    docs = documents.index_documents(table(spark, d, "device_registers"), table(spark, d, "knowledge"), table(spark, d, "manuals"), table(spark, d, "devices"), F.lit("2024-02-03"))
    s = F.transform("doc.knowledge_sections", lambda x: F.concat_ws(" ", x["path"], x["completeness"], x["confidence"], x["parameter_count"].cast("string")))
    u = F.transform("doc.uncovered_groups", lambda x: F.concat_ws(" ", x["group"], x["parameter_count"].cast("string")))
    return docs.select("manual_id", F.col("doc.total_parameters"), F.array_sort(s).alias("sections"), u.alias("uncovered"), F.col("doc.device.model"), F.col("doc.extraction_metadata.parse_quality_score").alias("score"), F.col("doc.extraction_metadata.extraction_date").alias("day"))


@query(f"""WITH t AS ({M.SQL["f40_topics"]}), im AS ({M.SQL["j8_diagrams"]}), f AS (SELECT section_id, list_sort(list(source_page || ' ' || filename)) AS diagrams FROM im GROUP BY 1)
SELECT t.section_id, t.manual_id, m.device_id AS device, regexp_replace(rel_path, '\\.md$', '') AS section, CASE WHEN s.page_start IS NULL THEN [] WHEN s.page_end >= s.page_start THEN range(s.page_start, s.page_end + 1) ELSE [s.page_start] END AS source_pages,
list_transform(related_parameters, lambda x: x || ' Referenced in manual narrative') AS related, coalesce(diagrams, []) AS diagrams, 0 AS n_prerequisites
FROM t JOIN sections s ON s.section_id = t.section_id LEFT JOIN manuals m ON m.manual_id = t.manual_id LEFT JOIN f ON f.section_id = t.section_id""")
def f40_frontmatters(spark, d):
    """The whole frontmatter of each topic; shown here in part."""
    sections = table(spark, d, "sections")
    topics = pages.topic_rows(sections, pages.section_bodies(sections, table(spark, d, "parsed")))
    fronts = documents.frontmatters(sections, topics, M.j8_diagrams(spark, d), table(spark, d, "manuals").select("manual_id", F.col("device_id").alias("device")))
    f = "front."
    return fronts.select(
        "section_id", "manual_id", f + "device", f + "section", F.transform(f + "source_pages", lambda p: p.cast("long")).alias("source_pages"), F.transform(f + "related_parameters", lambda x: F.concat_ws(" ", x["id"], x["role"])).alias("related"),
        F.array_sort(F.transform(f + "diagrams", lambda x: F.concat_ws(" ", x["source_page"].cast("string"), x["filename"]))).alias("diagrams"), F.size(f + "prerequisites").alias("n_prerequisites"),
    )


_N = "CAST(regexp_extract(manual_id, '(\\d+)', 1) AS INT)"


@query(f"""WITH m AS (SELECT manual_id AS path, {_N} % 5 AS k FROM manuals)
SELECT path, 'E' AS severity, 'parameters_no_list' AS rule, 'parameters' AS subject FROM m WHERE k IN (0, 3)
UNION ALL SELECT path, 'E', 'parameter_no_mapping', unnest(['0', '2']) FROM m WHERE k = 1
UNION ALL SELECT path, 'E', 'ref_no_string', unnest(['1', '4']) FROM m WHERE k = 1""")
def v_document_findings(spark, d):
    """Documents that are no mapping, whose parameters are no list or no mappings, or whose references are no strings."""
    k = F.regexp_extract("manual_id", r"(\d+)", 1).cast("int") % 5
    doc = F.when(k == 0, '{"parameters": 5}').when(k == 1, '{"parameters": [1, {"id": "a", "knowledge_ref": 3}, "x", {"id": "b", "knowledge_ref": null}, {"id": "c", "knowledge_ref": {"y": 1}}]}').when(k == 2, '{"parameters": [{"id": "x", "knowledge_ref": "a/b"}, {"id": "z"}]}').when(k == 4, '{"parameters": []}')
    return links.document_findings(table(spark, d, "manuals").select(F.col("manual_id").alias("path"), doc.alias("doc")))


@query(f"""WITH m AS (SELECT manual_id, {_N} AS k FROM manuals), f AS (
SELECT manual_id, 'index_missing' AS rule, '_index.yaml' AS subject FROM m WHERE k % 3 = 0 UNION ALL SELECT manual_id, 'index_unreadable', '_index.yaml' FROM m WHERE k % 3 = 1
UNION ALL SELECT manual_id, 'rules_missing', 'rules' FROM m WHERE k % 4 = 0 UNION ALL SELECT manual_id, 'device_rule_missing', 'device-*.mdc' FROM m WHERE k % 4 = 1) SELECT manual_id, 'W' AS severity, rule, subject FROM f""")
def v_file_findings(spark, d):
    """Manuals without an index or with one that can't be read, without rule files or without one for the device."""
    m = table(spark, d, "manuals").select("manual_id", F.regexp_extract("manual_id", r"(\d+)", 1).cast("int").alias("k"))
    indexes = m.filter("k % 3 > 0").select("manual_id", F.when(F.col("k") % 3 == 2, "{}").alias("doc"))
    rules = m.filter("k % 4 > 0").select("manual_id", F.when(F.col("k") % 4 == 1, "general.mdc").otherwise("device-x.mdc").alias("filename"))
    return links.file_findings(m, indexes, rules)


@query("""WITH a AS (SELECT device_id, parsed_at, manual_id, quality_score AS score, coalesce(force_ocr_hint_used, false) AS forced FROM manuals),
f AS (SELECT device_id, arg_min({'m': manual_id, 's': score}, (parsed_at, manual_id)) FILTER (WHERE NOT forced) AS first, arg_min({'m': manual_id, 's': score}, (parsed_at, manual_id)) FILTER (WHERE forced) AS retry FROM a GROUP BY 1)
SELECT device_id, CASE WHEN first.s < 3.0 AND retry.s >= first.s THEN retry.m ELSE coalesce(first.m, retry.m) END AS manual_id FROM f""")
def p16_accepted_parses(spark, d):
    """The parse that stands for each device: the first, or the forced one if it was called for and is no worse."""
    attempts = table(spark, d, "manuals").select("device_id", F.coalesce("force_ocr_hint_used", F.lit(False)).alias("forced"), F.col("quality_score").alias("score"), F.struct("parsed_at", "manual_id").alias("attempt"), "manual_id")
    return links.accepted_parses(attempts, "device_id").select("device_id", "manual_id")


@query(r"""WITH r AS (SELECT know_id, manual_id, unnest(see_also) AS x FROM knowledge), f AS (SELECT DISTINCT manual_id, regexp_replace(rel_path, '\.md$', '') AS p FROM knowledge),
c AS (SELECT n.know_id, greatest(0, coalesce(len(see_also), 0) - count(f.p)) AS gone FROM knowledge n LEFT JOIN r ON r.know_id = n.know_id LEFT JOIN f ON f.manual_id = r.manual_id AND f.p = replace(trim(r.x), '\', '/') GROUP BY n.know_id, see_also)
SELECT CAST(sum(gone) AS BIGINT) AS n_pruned, count(*) FILTER (WHERE gone > 0) AS n_rewritten FROM c""")
def a19_prune_report(spark, d):
    """References left out and files written again for it."""
    return links.prune_report(links.pruned_refs(table(spark, d, "knowledge")))


@query("""WITH e AS (SELECT manual_id, param_id, arg_min({'b': brief, 'k': data_type, 'u': unit}, reg_id) AS v FROM device_registers WHERE param_id IS NOT NULL AND manual_id IS NOT NULL GROUP BY ALL)
SELECT manual_id, param_id, CASE WHEN v.b IS NULL OR lower(trim(v.b)) IN ('', 'no description in manual.') THEN 'Found text' ELSE v.b END AS brief, CASE WHEN v.k IS NULL OR v.k = 'string' THEN 'uint16' ELSE v.k END AS data_type, coalesce(v.u, 'V') AS unit FROM e""")
def j18_weak_fields(spark, d):
    """Placeholder briefs, unknown types and missing units filled; whatever else is there stays."""
    keys, first = ["manual_id", "param_id"], F.struct("brief", "data_type", "unit")
    e = table(spark, d, "device_registers").filter("param_id is not null and manual_id is not null").groupBy(*keys).agg(F.min_by(first, "reg_id").alias("v")).select(*keys, "v.*")
    e = kept(e)
    found = e.select(*keys, F.lit("Found text").alias("brief"), F.lit("uint16").alias("data_type"), F.lit("V").alias("unit"))
    return records.gap_fill(e, found, keys, ["brief", "data_type", "unit"], {"brief": ["", "no description in manual."], "data_type": ["string"]})
