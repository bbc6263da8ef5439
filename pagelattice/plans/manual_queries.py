"""Queries of the manual operators over the test tables, and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelattice.functions import classify as C
from pagelattice.functions import registers as R
from pagelattice.functions import text as X
from pagelattice.operators import documents, links, pages, records
from pagelattice.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that checks it."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# ---- SQL pieces: written for themselves, so that they check the constants too ----

_S_ID = r"\b[CFRU][0-9A-F]{2}\.[0-9A-F]{2}\b"
_S_IMG = """(?i)<img[^>]*alt="([^"]*)"[^>]*>"""
_S_CODE = r"(?i)\b[cfru][0-9a-f]{2}\b"


def s_ws(e: str) -> str:
    return rf"trim(regexp_replace({e}, '[\s\x{{85}}\p{{Z}}]+', ' ', 'g'))"


def s_clean(e: str, to: str = " ") -> str:
    return s_ws(rf"regexp_replace({e}, '<[^>]+>', '{to}', 'g')")


def s_slug(e: str, joint: str = "_") -> str:
    s = f"regexp_replace(regexp_replace(lower({e}), '[^a-z0-9]+', '{joint}', 'g'), '^{joint}|{joint}$', '', 'g')"
    return f"CASE WHEN {s} = '' THEN 'section' ELSE {s} END" if joint == "_" else s


def s_entities(e: str) -> str:
    for name, to in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", "\u00a0"), ("&ndash;", "\u2013"), ("&mdash;", "\u2014"), ("&deg;", "\u00b0"), ("&copy;", "\u00a9"), ("&micro;", "\u00b5"), ("&times;", "\u00d7"), ("&amp;", "&")):
        e = f"replace({e}, '{name}', '{to}')"
    return e


def s_cell(e: str) -> str:
    return s_ws(rf"regexp_replace({s_entities(rf'''regexp_replace({e}, '(?i)<sup>\s*([+-]?\d+)\s*</sup>', '^\1', 'g')''')}, '<[^>]+>', ' ', 'g')")


def s_any(t: str, words) -> str:
    return "(" + " OR ".join(f"contains({t}, '{w}')" for w in words) + ")"


_S_GROUP = """CASE WHEN regexp_matches({t}, 'velocity|speed loop') THEN 'tuning/velocity' WHEN regexp_matches({t}, 'position loop|positioning|pulse|electronic gear') THEN 'tuning/position'
WHEN regexp_matches({t}, 'torque|current loop|current limit') THEN 'tuning/current' WHEN regexp_matches({t}, 'homing|origin return|home return') THEN 'motion/homing'
WHEN regexp_matches({t}, 'modbus|communication|baud|station no|slave id') THEN 'communication' WHEN regexp_matches({t}, 'fault|alarm|diagnostic|error code') THEN 'diagnostics'
WHEN regexp_matches({t}, 'input terminal|digital input|x0|x1') THEN 'io/digital_inputs' WHEN regexp_matches({t}, 'output terminal|digital output|y0|y1') THEN 'io/digital_outputs'
WHEN regexp_matches({t}, 'protection|overvoltage|overcurrent|limit') THEN 'protection' WHEN regexp_matches({t}, 'motor|encoder|pole|rated') THEN 'motor'
WHEN regexp_matches({t}, 'installation|mounting|dimension|clearance') THEN 'installation' WHEN regexp_matches({t}, 'wiring|connector|pin|terminal|cn1|cn2|cn3') THEN 'wiring'
WHEN regexp_matches({t}, 'trial run|commissioning|jog|test run') THEN 'commissioning' WHEN regexp_matches({t}, 'gain|tuning|pid|filter|bandwidth') THEN 'tuning' END"""


def s_group(t: str) -> str:
    return _S_GROUP.format(t=t)


def s_words(t: str) -> str:
    return f"(CASE WHEN {t} = '' THEN 0 ELSE len(string_split({t}, ' ')) END)"


_S_KIND = r"""CASE WHEN contains({t}, 'table of contents') OR regexp_matches({t}, '\.\.\.\s*\d+\b') THEN 'table_of_contents' WHEN regexp_matches({t}, 'revision history|change history') THEN 'revision_history'
WHEN regexp_matches({t}, 'appendix|annex') THEN 'appendix' WHEN {table} AND regexp_matches({t}, 'fault code|alarm code|error code') THEN 'fault_code_table'
WHEN {table} AND regexp_matches({t}, 'parameter|\b[cfru][0-9a-f]{{2}}\.[0-9a-f]{{2}}\b') THEN 'parameter_table' WHEN regexp_matches({t}, 'wiring diagram|terminal wiring|connection diagram') THEN 'wiring_diagram'
WHEN regexp_matches({t}, 'block diagram|control block|signal flow') THEN 'block_diagram' WHEN regexp_matches({t}, 'specification|rated|dimension') THEN 'specifications'
WHEN regexp_matches({t}, 'danger|warning|caution') AND {words} < 200 THEN 'safety_warning' WHEN {words} < 15 THEN 'cover_page' ELSE 'narrative_knowledge' END"""


def s_kind(text: str, html: str) -> str:
    return _S_KIND.format(t=f"lower({text})", table=f"contains(lower({html}), '<table')", words=s_words(text))


def s_heading(html: str) -> str:
    heads = f"list_filter(list_transform(regexp_extract_all({html}, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1), lambda h: {s_clean('h')}), lambda h: length(h) > 3)"
    text = s_clean(html)
    sentence = rf"trim(string_split_regex({text}, '[.!?][\s\x{{85}}\p{{Z}}]+')[1])"
    return f"CASE WHEN len({heads}) > 0 THEN left({heads}[1], 96) WHEN length({sentence}) BETWEEN 5 AND 96 THEN {sentence} WHEN {text} <> '' THEN array_to_string(string_split({text}, ' ')[1:10], ' ') ELSE 'Untitled section' END"


_KIDS = "list_filter(CASE WHEN json_valid(children) AND json_type(children) = 'ARRAY' THEN from_json(children, '[\"JSON\"]') END, lambda x: json_type(x) = 'OBJECT')"
_VIEWS = f"""
views AS (
  SELECT page_id, manual_id, device_id, idx, coalesce(page, list_filter(list_transform(kids, lambda v: CASE WHEN json_type(v, '$.page') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract_string(v, '$.page') AS INT) END), lambda p: p IS NOT NULL)[1], idx) + 1 AS page_num, html,
    array_to_string(list_concat(CASE WHEN coalesce(html, '') <> '' THEN [html] ELSE [] END, coalesce(list_filter(list_transform(kids, lambda v: CASE WHEN json_type(v, '$.html') = 'VARCHAR' THEN json_extract_string(v, '$.html') END), lambda h: h IS NOT NULL AND h <> ''), [])), chr(10)) AS full_html
  FROM (SELECT *, {_KIDS} AS kids FROM parsed)
), seen AS (SELECT *, {s_clean("full_html")} AS text FROM views), shown AS (SELECT * FROM seen WHERE text <> '')"""
_PAGES = f"""{_VIEWS}, classified AS (
  SELECT *, CASE WHEN suggested_group IS NOT NULL THEN suggested_group || '/' || {s_slug("section_heading")} END AS suggested_knowledge_topic FROM (
  SELECT page_id, manual_id, device_id, idx, page_num, {s_heading("full_html")} AS section_heading, {s_kind("text", "full_html")} AS content_type, {s_group("lower(text)")} AS suggested_group, left(text, 700) AS excerpt FROM shown))"""
_MERGED = f"""{_PAGES}, marked AS (
  SELECT *, CASE WHEN content_type = lag(content_type) OVER w AND page_num <= lag(page_num) OVER w + 1 AND (content_type = 'narrative_knowledge' OR suggested_group IS NOT DISTINCT FROM lag(suggested_group) OVER w) THEN 0 ELSE 1 END AS starts
  FROM classified WINDOW w AS (PARTITION BY manual_id ORDER BY idx, page_id)
), numbered AS (SELECT *, sum(starts) OVER (PARTITION BY manual_id ORDER BY idx, page_id) AS sec_no, row_number() OVER (PARTITION BY manual_id ORDER BY idx, page_id) AS rn FROM marked
), moved AS (SELECT *, last_value(suggested_group IGNORE NULLS) OVER (PARTITION BY manual_id, sec_no ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM numbered
), merged AS (SELECT manual_id, any_value(device_id) AS device_id, sec_no, arg_min(section_heading, rn) AS section_heading, arg_min(page_num, rn) AS page_start, arg_max(page_num, rn) AS page_end, any_value(content_type) AS content_type,
  arg_max(suggested_group, rn) FILTER (WHERE suggested_group IS NOT NULL) AS suggested_group,
  arg_max(suggested_knowledge_topic, rn) FILTER (WHERE suggested_group IS NOT NULL AND suggested_group IS DISTINCT FROM before) AS suggested_knowledge_topic, arg_min(excerpt, rn) AS excerpt, count(*) AS n_pages
  FROM moved GROUP BY manual_id, sec_no)"""


# ---- tree and pages ----


@query(f"SELECT page_id, CAST(pos AS INT) AS pos, CASE WHEN json_type(v, '$.block_type') = 'VARCHAR' THEN json_extract_string(v, '$.block_type') END AS block_type, CASE WHEN json_type(v, '$.page') IN ('UBIGINT', 'BIGINT') THEN CAST(json_extract_string(v, '$.page') AS INT) END AS own_page, CASE WHEN json_type(v, '$.html') = 'VARCHAR' THEN json_extract_string(v, '$.html') END AS html FROM (SELECT page_id, unnest({_KIDS}) AS v, generate_subscripts({_KIDS}, 1) - 1 AS pos FROM parsed)")
def t1_blocks(spark, d):
    return pages.top_blocks(table(spark, d, "parsed"))


@query(f"WITH {_VIEWS} SELECT page_id, page_num, full_html, text, {s_words('text')} AS n_words FROM shown")
def t2_page_views(spark, d):
    return pages.page_views(table(spark, d, "parsed")).select("page_id", "page_num", "full_html", "text", X.word_count(F.col("text")).alias("n_words"))


@query(f"WITH {_PAGES} SELECT page_id, section_heading, content_type, suggested_group, suggested_knowledge_topic, excerpt FROM classified")
def c2_classified(spark, d):
    return pages.classified_pages(pages.page_views(table(spark, d, "parsed"))).select("page_id", "section_heading", "content_type", "suggested_group", "suggested_knowledge_topic", "excerpt")


@query(f"WITH {_MERGED} SELECT manual_id, sec_no, section_heading, page_start, page_end, content_type, suggested_group, suggested_knowledge_topic, excerpt, n_pages FROM merged")
def w1_sections(spark, d):
    return pages.merged_sections(pages.classified_pages(pages.page_views(table(spark, d, "parsed")))).drop("device_id")


@query(f"WITH {_MERGED} SELECT content_type, count(*) AS n_sections, sum(n_pages) AS n_pages FROM merged GROUP BY 1")
def a7_section_kinds(spark, d):
    return w1_sections(spark, d).groupBy("content_type").agg(F.count("*").alias("n_sections"), F.sum("n_pages").alias("n_pages"))


# ---- text ----


@query(f"SELECT page_id, {s_clean('html')} AS spaced, {s_clean('html', '')} AS joined, {s_cell('html')} AS cell FROM parsed WHERE html IS NOT NULL")
def f1_cleaned(spark, d):
    h = F.col("html")
    return table(spark, d, "parsed", "page_id", "html").filter(h.isNotNull()).select("page_id", X.clean_spaced(h).alias("spaced"), X.clean_joined(h).alias("joined"), X.clean_cell(h).alias("cell"))


def _s_segments(e: str) -> str:
    return f"list_filter(string_split(replace({e}, '\\', '/'), '/'), lambda p: {s_ws('p')} <> '')"


def _s_group_path(e: str) -> str:
    p = f"array_to_string(list_transform({_s_segments(f'''coalesce({e}, '')''')}, lambda p: {s_slug('p')}), '/')"
    return f"CASE WHEN {p} = '' THEN 'misc' ELSE {p} END"


def _s_topic_slug(e: str) -> str:
    s = f"({s_slug(e)})"
    return f"CASE WHEN length({s}) > 60 THEN regexp_replace(left({s}, 60), '_+$', '') ELSE {s} END"


def _s_path(no: str) -> str:
    parts = _s_segments("coalesce(trim(suggested_knowledge_topic), '')")
    seed = f"CASE WHEN len({parts}) > 0 THEN {parts}[-1] WHEN coalesce(section_heading, '') <> '' THEN section_heading ELSE printf('section_%03d', {no}) END"
    own = f"array_to_string(list_transform({parts}[1:len({parts}) - 1], lambda p: {s_slug('p')}), '/')"
    return f"CASE WHEN coalesce(suggested_group, '') = '' AND len({parts}) > 1 THEN {own} ELSE {_s_group_path('suggested_group')} END || '/' || {_s_topic_slug(f'({seed})')} || '.md'"


@query(f"SELECT section_id, {s_slug('coalesce(section_heading, chr(32))')} AS slug, {s_slug('coalesce(section_heading, chr(32))', '-')} AS dashed, regexp_replace(coalesce(section_heading, ''), '[^A-Za-z0-9]+', '', 'g') AS glob, {_s_topic_slug('coalesce(section_heading, chr(32))')} AS topic, {_s_group_path('suggested_group')} AS folder, {_s_path('CAST(section_id AS INT)')} AS path, CASE WHEN trim(coalesce(section_heading, '')) = '' THEN 'Untitled Knowledge Section' ELSE left(trim(section_heading), 96) END AS title FROM sections")
def f4_paths(spark, d):
    h, g = F.coalesce("section_heading", F.lit(" ")), F.col("suggested_group")
    return table(spark, d, "sections").select(
        "section_id", X.slug(h).alias("slug"), X.slug(h, "-", None).alias("dashed"), X.model_glob(F.coalesce("section_heading", F.lit(""))).alias("glob"), X.topic_slug(h).alias("topic"), X.group_path(g).alias("folder"),
        X.topic_path(g, F.col("suggested_knowledge_topic"), F.col("section_heading"), F.col("section_id").cast("int")).alias("path"), X.title_of(F.col("section_heading")).alias("title"),
    )


def _s_table(t: str) -> str:
    rows = f"list_filter(list_transform(regexp_extract_all({t}, '(?is)<tr[^>]*>(.*?)</tr>', 1), lambda r: list_transform(regexp_extract_all(r, '(?is)<t[dh][^>]*>(.*?)</t[dh]>', 1), lambda c: {s_clean('c', '')})), lambda r: len(list_filter(r, lambda x: x <> '')) > 0)"
    return f"(SELECT CASE WHEN len(rows) = 0 THEN '' WHEN len(rows) = 1 THEN array_to_string(rows[1], ' | ') ELSE array_to_string(list_concat(list_transform(rows[1:1], lambda r: array_to_string(list_transform(widths, lambda w, k: rpad(coalesce(r[k], ''), w, ' ')), ' | ')), [array_to_string(list_transform(widths, lambda w: repeat('-', w)), ' | ')], list_transform(rows[2:], lambda r: array_to_string(list_transform(widths, lambda w, k: rpad(coalesce(r[k], ''), w, ' ')), ' | '))), chr(10)) END FROM (SELECT rows, list_transform(range(1, list_max(list_transform(rows, lambda r: len(r))) + 1), lambda k: CAST(greatest(3, list_max(list_transform(rows, lambda r: length(coalesce(r[k], ''))))) AS INT)) AS widths FROM (SELECT {rows} AS rows)))"


@query(f"WITH t AS (SELECT page_id, unnest(regexp_extract_all(full_html, '(?is)<table[^>]*>.*?</table>', 0)) AS t, generate_subscripts(regexp_extract_all(full_html, '(?is)<table[^>]*>.*?</table>', 0), 1) - 1 AS table_no FROM (WITH {_VIEWS} SELECT * FROM shown)) SELECT page_id, CAST(table_no AS INT) AS table_no, {_s_table('t')} AS padded FROM t")
def f13_table_text(spark, d):
    v = pages.page_views(table(spark, d, "parsed")).filter(F.contains(F.lower("full_html"), F.lit("<table")))
    return v.select("page_id", F.posexplode(X.tables_in(F.col("full_html"))).alias("table_no", "t")).select("page_id", "table_no", X.table_text(F.col("t")).alias("padded"))


def _s_text(h: str) -> str:
    heads = f"list_transform(list_filter(list_transform(regexp_extract_all({h}, '(?is)<h[1-6][^>]*>.*?</h[1-6]>', 0), lambda x: {{'l': CAST(regexp_extract(x, '(?i)^<h([1-6])', 1) AS INT), 't': {s_clean(f'''regexp_extract(x, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1)''', '')}}}), lambda x: x.t <> ''), lambda x: chr(10) || repeat('#', least(x.l + 1, 4)) || ' ' || x.t || chr(10))"
    rest = f"regexp_replace({h}, '(?is)<h[1-6][^>]*>.*?</h[1-6]>', '', 'g')"
    bare = f"regexp_replace(regexp_replace({rest}, '(?is)<table.*?</table>', '', 'g'), '{_S_IMG}', '', 'g')"
    images = f"list_transform(list_filter(list_transform(regexp_extract_all({rest}, '{_S_IMG}', 1), lambda a: trim(a)), lambda a: a <> ''), lambda a: chr(10) || '[Image: ' || a || ']' || chr(10))"
    paras = rf"list_filter(list_transform(regexp_extract_all({bare}, '(?is)<p[^>]*>(.*?)</p>', 1), lambda p: {s_clean(rf'''regexp_replace(p, '(?i)<br\s*/?>', chr(10), 'g')''', '')}), lambda p: length(p) > 3)"
    items = f"list_transform(list_filter(list_transform(regexp_extract_all({bare}, '(?is)<li[^>]*>(.*?)</li>', 1), lambda x: {s_clean('x', '')}), lambda x: x <> ''), lambda x: '- ' || x)"
    parts = f"list_concat({heads}, {images}, {paras}, {items})"
    return rf"regexp_replace(CASE WHEN len({parts}) > 0 THEN array_to_string({parts}, chr(10) || chr(10)) ELSE {s_clean(bare, '')} END, '^[\s\x{{85}}\p{{Z}}]+|[\s\x{{85}}\p{{Z}}]+$', '', 'g')"


_BODIES = f"""texts AS (SELECT page_id, manual_id, idx, {_s_text("html")} AS t FROM parsed WHERE trim(coalesce(html, '')) <> ''),
bodies AS (SELECT s.section_id, string_agg(t, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY p.idx, p.page_id) AS body FROM sections s JOIN texts p ON p.manual_id = s.manual_id AND p.idx BETWEEN s.page_start - 1 AND (CASE WHEN s.page_end >= s.page_start THEN s.page_end ELSE s.page_start END) - 1 WHERE t <> '' GROUP BY 1)"""


@query(f"WITH {_BODIES} SELECT section_id, body FROM bodies")
def j7_bodies(spark, d):
    return pages.section_bodies(table(spark, d, "sections"), table(spark, d, "parsed"))


_IMAGE_HTML = "(SELECT page_id, manual_id, idx, '<p><img alt=\"' || coalesce(a, '') || '\" src=\"img/' || f || '\"></p>' AS html FROM (SELECT p.page_id, p.manual_id, p.idx, i.filename AS f, CASE WHEN i.image_id % 3 = 0 THEN NULL ELSE 'Figure ' || i.image_id END AS a FROM parsed p JOIN images i ON i.manual_id = p.manual_id AND i.image_id % 20 = p.idx))"


@query(f"""SELECT DISTINCT s.section_id, trim(split_part(regexp_extract(html, 'src="([^"]+)"', 1), '/', -1)) AS filename, CASE WHEN regexp_extract(html, 'alt="([^"]*)"', 1) = '' THEN 'Diagram extracted from manual page ' || (idx + 1) || '.' ELSE regexp_extract(html, 'alt="([^"]*)"', 1) END AS content_summary, idx + 1 AS source_page
FROM sections s JOIN {_IMAGE_HTML} p ON p.manual_id = s.manual_id AND p.idx BETWEEN s.page_start - 1 AND (CASE WHEN s.page_end >= s.page_start THEN s.page_end ELSE s.page_start END) - 1""")
def j8_diagrams(spark, d):
    """Images on the pages of sections; the markup is written from the image table, which is read back."""
    image = table(spark, d, "images").select("manual_id", "filename", (F.col("image_id") % 20).cast("int").alias("idx"), F.when(F.col("image_id") % 3 != 0, F.concat(F.lit("Figure "), "image_id")).otherwise("").alias("alt"))
    html = F.concat(F.lit('<p><img alt="'), "alt", F.lit('" src="img/'), "filename", F.lit('"></p>'))
    return pages.section_diagrams(table(spark, d, "sections"), table(spark, d, "parsed").select("manual_id", "page_id", "idx").join(image, ["manual_id", "idx"]).withColumn("html", html))


@query(f"""WITH {_BODIES}, kept AS (SELECT s.*, row_number() OVER (PARTITION BY manual_id ORDER BY sec_no, s.section_id) AS no, CASE WHEN length(coalesce(body, '')) >= 20 THEN body WHEN trim(coalesce(excerpt, '')) <> '' THEN trim(excerpt) ELSE 'No narrative content could be extracted for this section.' END AS text
FROM sections s LEFT JOIN bodies b ON b.section_id = s.section_id WHERE content_type IN ('narrative_knowledge', 'safety_warning', 'wiring_diagram', 'block_diagram', 'specifications', 'fault_code_table'))
SELECT section_id, manual_id, CAST(no AS INT) AS no, {_s_path("no")} AS rel_path, CASE WHEN trim(coalesce(section_heading, '')) = '' THEN 'Untitled Knowledge Section' ELSE left(trim(section_heading), 96) END AS title,
CASE WHEN length(text) > 500 THEN 'high' WHEN length(text) > 150 THEN 'medium' ELSE 'low' END AS extraction_confidence, CASE WHEN length(text) > 800 THEN 'complete' WHEN length(text) > 250 THEN 'partial' ELSE 'stub' END AS content_completeness,
list_sort(list_distinct(list_transform(regexp_extract_all(text, '(?i){_S_ID}'), lambda x: upper(x))))[1:30] AS related_parameters FROM kept""")
def f40_topics(spark, d):
    sections = table(spark, d, "sections")
    return pages.topic_rows(sections, pages.section_bodies(sections, table(spark, d, "parsed"))).drop("body")


@query()
def w4_unique_paths(spark, d):
    sections = table(spark, d, "sections")
    return pages.unique_paths(pages.topic_rows(sections, sections.select("section_id", F.col("excerpt").alias("body"))))


@query(r"""WITH l AS (SELECT know_id, unnest(string_split(regexp_replace(body, '[ \t]+', ' ', 'g'), chr(10))) AS x, generate_subscripts(string_split(regexp_replace(body, '[ \t]+', ' ', 'g'), chr(10)), 1) AS i FROM (SELECT know_id, replace(body, '. ', '.' || chr(10)) || chr(10) || chr(10) || chr(10) || chr(10) || title || chr(10) || title AS body FROM knowledge)),
m AS (SELECT know_id, i, regexp_replace(x, '\s+$', '') AS x FROM l), n AS (SELECT *, lag(x) OVER (PARTITION BY know_id ORDER BY i) AS p FROM m)
SELECT know_id, trim(regexp_replace(string_agg(x, chr(10) ORDER BY i), '\n{3,}', chr(10) || chr(10), 'g')) AS tidy FROM n WHERE x = '' OR p IS NULL OR x <> p GROUP BY know_id""")
def w2_tidy_bodies(spark, d):
    body = F.concat(F.replace("body", F.lit(". "), F.lit(".\n")), F.lit("\n\n\n\n"), "title", F.lit("\n"), "title")
    return table(spark, d, "knowledge").filter(body.isNotNull()).select("know_id", X.tidy_body(body).alias("tidy"))


@query(f"SELECT know_id, list_transform(regexp_extract_all(body, '(?i){_S_ID}'), lambda x: upper(x)) AS ids, list_transform(regexp_extract_all(body, '{_S_ID}'), lambda x: upper(x)) AS exact_ids, list_transform(regexp_extract_all(rel_path || ' ' || coalesce(title, ''), '{_S_CODE}'), lambda x: lower(x)) AS groups FROM knowledge WHERE body IS NOT NULL")
def f23_ids(spark, d):
    k = table(spark, d, "knowledge").filter("body is not null")
    return k.select("know_id", X.parameter_ids(F.col("body")).alias("ids"), X.parameter_ids(F.col("body"), False).alias("exact_ids"), X.group_codes(F.concat("rel_path", F.lit(" "), F.coalesce("title", F.lit("")))).alias("groups"))


# ---- register values ----


def _pairs(entries):
    """Key-value structs as texts."""
    return F.transform(entries, lambda e: F.concat(e["k"], F.lit("="), e["v"]))


_S_BLANK = "trim(coalesce({0}, '')) IN ('', '-')"


def s_power(e: str) -> str:
    t = f"replace(trim({e}), ' ', '')"
    return rf"CASE WHEN regexp_matches({t}, '^-?\d+$') THEN TRY_CAST({t} AS DOUBLE) WHEN regexp_matches({t}, '^(-?)2\^(\d+)(-1)?$') AND TRY_CAST(regexp_extract({t}, '2\^(\d+)', 1) AS INT) <= 124 THEN (CASE WHEN {t}[1] = '-' THEN -1 ELSE 1 END) * pow(2.0, CAST(regexp_extract({t}, '2\^(\d+)', 1) AS INT)) - (CASE WHEN regexp_matches({t}, '\d-1$') THEN 1 ELSE 0 END) END"


def s_number(e: str) -> str:
    return rf"CASE WHEN NOT {_S_BLANK.format(e)} THEN coalesce({s_power(e)}, CASE WHEN regexp_matches(trim({e}), '^-?\d+(\.\d+)?$') THEN TRY_CAST(trim({e}) AS DOUBLE) END) END"


def s_range(e: str, k: int) -> str:
    c = rf"regexp_replace(replace(trim({e}), ' ', ''), '\^\{{(\d+)\}}', '^\1', 'g')"
    g1, g2 = r"^(\d+)-\((2\^\d+(?:-1)?)\)$", r"^\(?(-?2\^\d+)\)?-\(?(-?2\^\d+(?:-1)?)\)?$"
    g3 = r"(?i)^\s*(-?\d+(?:\.\d+)?)\s*(?:to|-)\s*(-?\d+(?:\.\d+)?)\s*$"
    return f"CASE WHEN {_S_BLANK.format(e)} THEN NULL WHEN regexp_matches({c}, '{g1}') THEN {s_power(f'''regexp_extract({c}, '{g1}', {k})''')} WHEN regexp_matches({c}, '{g2}') THEN {s_power(f'''regexp_extract({c}, '{g2}', {k})''')} WHEN regexp_matches({e}, '{g3}') THEN TRY_CAST(regexp_extract({e}, '{g3}', {k}) AS DOUBLE) END"


_UNIT_P = r"^([+-]?\d+(?:\.\d+)?)\s*(.+)$"


def s_unit(e: str) -> str:
    return f"CASE WHEN {_S_BLANK.format(e)} THEN NULL WHEN regexp_matches(trim({e}), '{_UNIT_P}') AND trim(regexp_extract(trim({e}), '{_UNIT_P}', 2)) <> '' THEN trim(regexp_extract(trim({e}), '{_UNIT_P}', 2)) ELSE trim({e}) END"


def s_scale(e: str) -> str:
    return f"CASE WHEN NOT {_S_BLANK.format(e)} AND regexp_matches(trim({e}), '{_UNIT_P}') AND trim(regexp_extract(trim({e}), '{_UNIT_P}', 2)) <> '' THEN TRY_CAST(regexp_extract(trim({e}), '{_UNIT_P}', 1) AS DOUBLE) END"


@query(f"SELECT reg_id, {s_range('value_range', 1)} AS low, {s_range('value_range', 2)} AS high, {s_number('default_value')} AS default_number, {s_unit('unit')} AS unit_name, {s_scale('unit')} AS scale FROM device_registers")
def f29_values(spark, d):
    r, u = R.range_value(F.col("value_range")), R.unit_and_scale(F.col("unit"))
    return table(spark, d, "device_registers").select("reg_id", r["min"].alias("low"), r["max"].alias("high"), R.number_value(F.col("default_value")).alias("default_number"), u["unit"].alias("unit_name"), u["scale"].alias("scale"))


_PRINTED = "CASE data_type WHEN 'uint16' THEN 'U16' WHEN 'int16' THEN 'i16' WHEN 'uint32' THEN 'U32 ' WHEN 'int32' THEN 'I32' WHEN 'float32' THEN 'F32' WHEN 'bool' THEN 'Bool' WHEN 'string' THEN 'ASCII' ELSE '' END"


@query("""SELECT reg_id, CASE WHEN data_type IN ('uint16', 'int16', 'uint32', 'int32', 'float32', 'bool', 'string') THEN data_type ELSE 'uint16' END AS kind, CASE WHEN data_type IN ('uint32', 'int32', 'float32') THEN 2 ELSE 1 END AS n_registers, CASE write_condition WHEN 'stopped' THEN 'stopped' WHEN 'any_state' THEN 'any_state' END AS condition, CASE takes_effect WHEN 'immediate' THEN 'immediate' WHEN 'power_cycle' THEN 'power_cycle' END AS effect,
CASE WHEN source_page IS NULL THEN NULL ELSE greatest(1, source_page - 1) END AS printed_page, CASE WHEN param_id LIKE 'U%' THEN 'read_only' ELSE 'read_write' END AS access, lower(trim(coalesce(brief, ''))) IN ('', 'no description in manual.') AS placeholder FROM device_registers""")
def f30_enums(spark, d):
    """Printed cells, written from the typed columns, read back as types, conditions and effects."""
    c = F.col
    printed = F.when(c("data_type") == "uint16", "U16").when(c("data_type") == "int16", "i16").when(c("data_type") == "uint32", "U32 ").when(c("data_type") == "int32", "I32").when(c("data_type") == "float32", "F32").when(c("data_type") == "bool", "Bool").when(c("data_type") == "string", "ASCII").otherwise("")
    mode = F.when(c("write_condition") == "stopped", "At stop").when(c("write_condition") == "any_state", "During operation").otherwise("-")
    effect = F.when(c("takes_effect") == "immediate", "Immediately").when(c("takes_effect") == "power_cycle", "After power-on").otherwise("-")
    kind = R.data_type(printed)
    return table(spark, d, "device_registers").select("reg_id", kind.alias("kind"), R.register_count(kind).alias("n_registers"), R.write_condition(mode).alias("condition"), R.takes_effect(effect).alias("effect"), R.source_page(c("source_page")).alias("printed_page"), R.access_of(F.coalesce("param_id", F.lit(""))).alias("access"), R.is_placeholder(c("brief")).alias("placeholder"))


@query(r"SELECT reg_id, CAST('0x' || upper(trim(param_id))[2:3] || upper(trim(param_id))[5:6] AS INT) AS address, printf('0x%04X', CAST('0x' || upper(trim(param_id))[2:3] || upper(trim(param_id))[5:6] AS INT)) AS address_hex FROM device_registers WHERE regexp_matches(upper(trim(param_id)), '^[CFRU][0-9A-F]{2}\.[0-9A-F]{2}$')")
def f37_addresses(spark, d):
    pid = F.upper(F.trim("param_id"))
    ok = table(spark, d, "device_registers").filter(pid.rlike(r"^[CFRU][0-9A-F]{2}\.[0-9A-F]{2}$"))
    b = R.modbus_block(pid, F.lit("uint16"))
    return ok.select("reg_id", b["address"].alias("address"), b["address_hex"].alias("address_hex"))


@query()
def f33_states(spark, d):
    """Value maps printed as `0: Off 1: On` and read back, labels with digits and colons too; no SQL dialect here has the lookahead, so it is tested by brute force."""
    printed = F.array_join(F.transform(F.map_entries("value_map"), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), " ")
    maps = table(spark, d, "device_registers").filter(F.size("value_map") > 0)
    return maps.select("reg_id", F.coalesce(_pairs(R.value_map(printed)), F.array().cast("array<string>")).alias("states"))


@query("SELECT o_orderkey, ['0=order ' || o_orderpriority[3:], '7=status ' || o_orderstatus] AS bits FROM orders")
def f34_bits(spark, d):
    printed = F.concat(F.lit("Bit00: order "), F.substring("o_orderpriority", 3, 99), F.lit("  bit07 : status "), "o_orderstatus")
    return table(spark, d, "orders").select("o_orderkey", _pairs(R.bit_layout(printed)).alias("bits"))


def _register_pages(spark, d):
    """Parameter tables in markup, ten registers each, from the register table; the header's wording changes by table."""
    esc = lambda c: F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("-")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    regs = table(spark, d, "device_registers").withColumn("nth", F.row_number().over(Window.partitionBy("manual_id").orderBy("reg_id")) - 1).withColumn("block", F.floor(F.col("nth") / 10).cast("int"))
    cells = F.concat(*(F.concat(F.lit("<td>"), esc(c), F.lit("</td>")) for c in ("param_id", "param_name", "value_range", "default_value", "unit", "brief")))
    head = F.when(F.col("block") % 2 == 0, "<tr><th>Parameter</th><th>Name</th><th>Value <b>Range</b></th><th>Default</th><th>Unit</th><th>Options</th></tr>").otherwise("<TR class='h'><TH>Parameter No.</TH><TH>Name</TH><TH>Limits</TH><TH>Default</TH><TH>Unit</TH><TH>Description</TH></TR>")
    rows = regs.select("manual_id", "block", "nth", F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("r"))
    return rows.groupBy("manual_id", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "r"))), lambda x: x["r"]), "\n").alias("r")).select("manual_id", "block", F.concat(F.lit("<p>Table</p><table border=1>"), head, "r", F.lit("</table>")).alias("html"))


def _typed(spark, d):
    raw = records.raw_records(records.html_tables(_register_pages(spark, d), ["manual_id", "block"]), ["manual_id", "block"])
    return records.typed_records(raw, ["manual_id", "block"], F.col("block") * 10)


_S_ROWS = r"""src AS (SELECT *, row_number() OVER (PARTITION BY manual_id ORDER BY reg_id) - 1 AS nth FROM device_registers),
cells AS (SELECT manual_id, CAST(nth // 10 AS INT) AS block, CAST(nth % 10 AS INT) AS row_no, upper({id}) AS id, {name} AS name_text, CASE WHEN (nth // 10) % 2 = 0 THEN {rng} ELSE '' END AS range_text, {dflt} AS default_text, {unit} AS unit_text, {brief} AS options_text FROM src),
rows AS (SELECT * FROM cells WHERE regexp_matches(id, '^[CFRU][0-9A-F]{{2}}\.[0-9A-F]{{2}}$'))""".format(**{k: s_cell(f"coalesce({c}, '-')") for k, c in {"id": "param_id", "name": "param_name", "rng": "value_range", "dflt": "default_value", "unit": "unit", "brief": "brief"}.items()})


@query(f"WITH {_S_ROWS} SELECT manual_id, block, row_no, id, CASE WHEN name_text <> '' THEN name_text ELSE id END AS name, CASE WHEN options_text NOT IN ('', '-') THEN options_text ELSE 'No description in manual.' END AS brief, {s_range('range_text', 1)} AS low, {s_range('range_text', 2)} AS high, {s_number('default_text')} AS dflt, {s_unit('unit_text')} AS unit, {s_scale('unit_text')} AS scale, CASE WHEN id LIKE 'U%' THEN 'read_only' ELSE 'read_write' END AS access, CASE WHEN block % 2 = 0 THEN 2 ELSE 1 END AS priority, greatest(1, block * 10 - 1) AS source_page FROM rows")
def f14_table_records(spark, d):
    return _typed(spark, d).select("manual_id", "block", "row_no", "id", "name", "brief", "low", "high", F.col("default").alias("dflt"), "unit", "scale", "access", "priority", "source_page")


@query()
def a1_merged_records(spark, d):
    """Registers recorded twice as one record, and briefs written where there is none."""
    merged = records.merge_records(_typed(spark, d), ["manual_id"], ["block", "table_no", "row_no"])
    return records.finished_records(merged)


@query(f"WITH {_S_ROWS}, big AS (SELECT manual_id, lower(split_part(id, '.', 1)) AS g FROM rows GROUP BY ALL HAVING count(*) >= 3) SELECT r.manual_id, r.id, count(*) AS n FROM rows r JOIN big b ON b.manual_id = r.manual_id AND b.g = lower(split_part(r.id, '.', 1)) GROUP BY ALL")
def j1_listed_groups(spark, d):
    """Records of the groups that a manual has three registers of, by semi-join."""
    typed = _typed(spark, d).select("manual_id", "id")
    big = typed.groupBy("manual_id", F.lower(F.substring_index("id", ".", 1)).alias("group_id")).agg(F.count("*").alias("n")).filter("n >= 3")
    return records.in_groups(typed, big, ["manual_id"]).groupBy("manual_id", "id").agg(F.count("*").alias("n"))


_S_MENTIONS = f"""nodes AS (SELECT manual_id, page_id, idx, {s_cell("html")} AS t FROM parsed WHERE html IS NOT NULL AND NOT contains(lower(html), '<table')),
found AS (SELECT manual_id, page_id, idx, unnest(regexp_extract_all(t, '{_S_ID}')) AS id, generate_subscripts(regexp_extract_all(t, '{_S_ID}'), 1) - 1 AS nth FROM nodes),
firsts AS (SELECT manual_id, id, arg_min({{'idx': idx, 'page_id': page_id, 'nth': nth}}, (idx, page_id, nth)) AS v FROM found GROUP BY ALL)"""


@query(f"WITH {_S_MENTIONS} SELECT manual_id, id, v.idx AS idx, v.page_id AS page_id, CAST(v.nth AS INT) AS nth, greatest(1, v.idx - 1) AS source_page FROM firsts")
def a2_first_mentions(spark, d):
    return _mentions(spark, d).select("manual_id", "id", "idx", "page_id", "nth", R.source_page(F.col("idx")).cast("int").alias("source_page"))


def _mentions(spark, d):
    nodes = table(spark, d, "parsed").filter(F.col("html").isNotNull() & ~C.has_table(F.col("html")))
    found = records.mentions(nodes, ["manual_id", "idx", "page_id"], X.clean_cell(F.col("html"))).drop("around")
    return records.first_mentions(found, ["manual_id"], ["idx", "page_id", "nth"])


@query(f"WITH {_S_MENTIONS} SELECT manual_id, id FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM device_registers r WHERE r.manual_id = f.manual_id AND upper(trim(r.param_id)) = f.id AND r.source_page IS NOT NULL)")
def j2_narrative_only(spark, d):
    """Parameters that no table with a page lists, only the text."""
    known = table(spark, d, "device_registers").filter("source_page is not null").select("manual_id", F.upper(F.trim("param_id")).alias("id"))
    return _mentions(spark, d).select("manual_id", "id").join(known, ["manual_id", "id"], "left_anti")


@query(f"WITH {_S_MENTIONS}, t AS (SELECT manual_id, upper(trim(param_id)) AS id, min(source_page) AS p FROM device_registers WHERE param_id IS NOT NULL GROUP BY ALL) SELECT coalesce(t.manual_id, f.manual_id) AS manual_id, coalesce(t.id, f.id) AS id, coalesce(t.p, CASE WHEN f.id IS NOT NULL THEN greatest(1, f.v.idx - 1) END) AS source_page FROM t FULL JOIN firsts f ON t.manual_id = f.manual_id AND t.id = f.id")
def j18_gap_fill(spark, d):
    """Registers with their page, filled and extended by what the text names."""
    regs = table(spark, d, "device_registers").filter("param_id is not null").groupBy("manual_id", F.upper(F.trim("param_id")).alias("id")).agg(F.min("source_page").alias("source_page"))
    found = _mentions(spark, d).select("manual_id", "id", R.source_page(F.col("idx")).cast("int").alias("source_page"))
    return records.gap_fill(regs, found, ["manual_id", "id"], ["source_page"])


@query("SELECT n_regionkey, 'c' || printf('%02x', n_regionkey) AS group_id, arg_max(n_name, n_nationkey) AS label FROM nation GROUP BY ALL")
def a4_group_labels(spark, d):
    """Labels from markdown lines that are written from the nations; the last line of a group counts."""
    line = F.format_string("| 8.%d | %s (2003h/C%02X) |", "n_nationkey", "n_name", "n_regionkey")
    return records.group_labels(table(spark, d, "nation").withColumn("line", line), ["n_regionkey"], "n_nationkey")


# ---- links, index, rules, checks ----

_S_LINK = """ent AS (
  SELECT manual_id, know_id, CASE WHEN trim(coalesce(section_ref, '')) <> '' THEN trim(section_ref) ELSE regexp_replace(rel_path, '\\.md$', '') END AS ref, related_parameters, title, CASE content_completeness WHEN 'stub' THEN 1 WHEN 'partial' THEN 2 WHEN 'complete' THEN 3 ELSE 0 END AS c, CASE extraction_confidence WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE 0 END AS f FROM knowledge),
keys AS (SELECT manual_id, know_id, ref, c, f, 'id' AS tier, upper(trim(u.id)) AS key FROM (SELECT *, unnest(related_parameters) AS u FROM ent)
  UNION ALL SELECT manual_id, know_id, ref, c, f, 'group', unnest(list_distinct(list_concat(CASE WHEN contains(ref, '/') THEN [split_part(ref, '/', 1)] ELSE [] END, list_transform(regexp_extract_all(concat_ws(' ', ref, title), '(?i)\\b[cfru][0-9a-f]{2}\\b'), lambda x: lower(x))))) FROM ent),
best AS (SELECT manual_id, tier, key, arg_max(ref, (c, f, -length(ref), -know_id)) AS ref FROM keys WHERE coalesce(key, '') <> '' GROUP BY ALL),
regs AS (SELECT reg_id, manual_id, lower(coalesce(group_id, '')) AS group_id, upper(trim(param_id)) AS pid, knowledge_ref AS old FROM device_registers),
one AS (SELECT r.*, i.ref AS id_ref, g.ref AS group_ref, coalesce(i.ref, g.ref) AS ref FROM regs r LEFT JOIN best i ON i.tier = 'id' AND i.manual_id = r.manual_id AND i.key = r.pid LEFT JOIN best g ON g.tier = 'group' AND g.manual_id = r.manual_id AND g.key = r.group_id),
counts AS (SELECT manual_id, group_id, ref, count(*) AS n, min(reg_id) AS f FROM one WHERE ref IS NOT NULL AND group_id <> '' GROUP BY ALL),
dom AS (SELECT manual_id, group_id, arg_max(ref, (n, -length(ref), -f)) AS dominant, max(n) AS n FROM counts GROUP BY ALL),
linked AS (SELECT o.reg_id, o.manual_id, o.group_id, o.old, coalesce(o.ref, d.dominant) AS ref, CASE WHEN id_ref IS NOT NULL THEN 'id' WHEN group_ref IS NOT NULL THEN 'group' WHEN d.dominant IS NOT NULL THEN 'propagated' END AS by FROM one o LEFT JOIN dom d ON d.n >= 2 AND d.manual_id = o.manual_id AND d.group_id = o.group_id)"""


@query(f"WITH {_S_LINK} SELECT manual_id, tier, key, ref FROM best")
def a5_best_topics(spark, d):
    return links.best_refs(links.topic_entries(table(spark, d, "knowledge")))


@query(f'WITH {_S_LINK} SELECT reg_id, manual_id, group_id, old, ref, "by" FROM linked')
def j5_linked(spark, d):
    return links.link_parameters(table(spark, d, "device_registers"), table(spark, d, "knowledge"))


@query(f"""WITH {_S_LINK} SELECT manual_id, count(*) FILTER (WHERE old IS DISTINCT FROM ref) AS n_changed, count(*) FILTER (WHERE "by" IN ('id', 'group')) AS n_first_pass, count(*) FILTER (WHERE "by" = 'propagated') AS n_propagated, round(count(ref) / count(*) * 100, 4) AS coverage FROM linked GROUP BY 1""")
def a13_link_report(spark, d):
    return links.link_report(j5_linked(spark, d))


@query(r"""WITH r AS (SELECT know_id, manual_id, unnest(see_also) AS x, generate_subscripts(see_also, 1) AS i FROM knowledge), f AS (SELECT DISTINCT manual_id, regexp_replace(rel_path, '\.md$', '') AS p FROM knowledge),
k AS (SELECT know_id, list(replace(trim(x), '\', '/') ORDER BY i) AS kept FROM r WHERE EXISTS (SELECT 1 FROM f WHERE f.manual_id = r.manual_id AND p = replace(trim(x), '\', '/')) GROUP BY 1)
SELECT n.know_id, coalesce(kept, []) AS see_also, CAST(greatest(0, coalesce(len(see_also), 0) - coalesce(len(kept), 0)) AS INT) AS n_pruned FROM knowledge n LEFT JOIN k ON k.know_id = n.know_id""")
def j9_pruned(spark, d):
    return links.pruned_refs(table(spark, d, "knowledge"))


@query("SELECT know_id, manual_id, rel_path AS path, CASE WHEN coalesce(title, '') <> '' THEN title ELSE array_to_string(list_transform(string_split(regexp_replace(split_part(rel_path, '/', -1), '\\.md$', ''), '_'), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') END AS title, CASE WHEN coalesce(content_completeness, '') <> '' THEN content_completeness ELSE 'partial' END AS completeness, CASE WHEN coalesce(extraction_confidence, '') <> '' THEN extraction_confidence ELSE 'medium' END AS confidence, CAST(coalesce(len(related_parameters), 0) AS INT) AS parameter_count FROM knowledge")
def a10_index_sections(spark, d):
    return links.index_sections(table(spark, d, "knowledge"))


@query(r"WITH c AS (SELECT DISTINCT manual_id, split_part(regexp_replace(rel_path, '\.md$', ''), '/', 1) AS c FROM knowledge) SELECT manual_id, group_id, count(*) AS parameter_count FROM device_registers g WHERE coalesce(group_id, '') <> '' AND NOT EXISTS (SELECT 1 FROM c WHERE c.manual_id = g.manual_id AND (c = group_id OR c = split_part(group_id, '/', 1))) GROUP BY ALL")
def j10_uncovered_groups(spark, d):
    return links.uncovered_groups(table(spark, d, "device_registers"), table(spark, d, "knowledge"))


_S_KEYS = "keys AS (SELECT manual_id, rel_path, row_number() OVER (PARTITION BY manual_id ORDER BY string_split(rel_path, '/')) AS no FROM (SELECT DISTINCT manual_id, rel_path FROM knowledge) QUALIFY no <= 20)"


@query(f"WITH {_S_KEYS} SELECT manual_id, rel_path, CAST(no AS INT) AS no FROM keys")
def o4_key_topics(spark, d):
    return links.key_topics(table(spark, d, "knowledge"))


@query(f"""WITH {_S_KEYS}, l AS (SELECT manual_id, string_agg('- `docs/knowledge/' || rel_path || '`', chr(10) ORDER BY no) AS lines FROM keys GROUP BY 1), n AS (SELECT m.manual_id, concat_ws(' ', manufacturer, model_name) AS who, coalesce(model_name, '') AS model, lines FROM manuals m JOIN devices d ON d.device_id = m.device_id LEFT JOIN l ON l.manual_id = m.manual_id)
SELECT manual_id, {s_slug("who", "-")} AS model_slug, '---' || chr(10) || 'description: "' || who || ' device reference"' || chr(10) || 'globs:' || chr(10) || '  - "**/' || regexp_replace(model, '[^A-Za-z0-9]+', '', 'g') || '*"' || chr(10) || 'alwaysApply: false' || chr(10) || '---' || chr(10) || chr(10) || '## ' || who || chr(10) || chr(10) || 'Key topics:' || chr(10) || coalesce(lines, '- No knowledge files generated.') || chr(10) AS content FROM n""")
def k8_rule_texts(spark, d):
    return links.rule_texts(table(spark, d, "manuals"), table(spark, d, "devices"), links.key_topics(table(spark, d, "knowledge")))


@query("""WITH e AS (SELECT device_type, list_sort(list_distinct(list('- **' || manufacturer || ' ' || model_name || '**'))) AS new FROM devices GROUP BY 1), x AS (SELECT device_type, ['- **' || min(manufacturer || ' ' || model_name) || '**'] AS lines FROM devices WHERE default_slave_id = 1 GROUP BY 1)
SELECT coalesce(x.device_type, e.device_type) AS device_type, list_concat(coalesce(lines, []), list_filter(coalesce(new, []), lambda v: NOT list_contains(coalesce(lines, []), v))) AS lines FROM x FULL JOIN e ON e.device_type = x.device_type""")
def k9_inventory(spark, d):
    """Inventory lines appended where they are missing."""
    devices = table(spark, d, "devices").filter("manufacturer is not null and model_name is not null")
    who = F.concat("manufacturer", F.lit(" "), "model_name")
    existing = devices.filter("default_slave_id = 1").groupBy("device_type").agg(F.array(F.concat(F.lit("- **"), F.min(who), F.lit("**"))).alias("lines"))
    return links.appended_lines(existing, devices.select("device_type", F.concat(F.lit("- **"), who, F.lit("**")).alias("entry")), "device_type")


@query(r"""WITH good AS (SELECT * FROM device_registers WHERE trim(coalesce(param_id, '')) <> ''), files AS (SELECT DISTINCT manual_id, regexp_replace(rel_path, '\.md$', '') AS r FROM knowledge), cnt AS (SELECT manual_id, count(*) AS n FROM device_registers GROUP BY 1), tot AS (SELECT manual_id, count(*) AS total FROM device_registers WHERE deleted_at IS NULL GROUP BY 1),
grp AS (SELECT manual_id, lower(group_id) AS g FROM device_registers WHERE group_id IS NOT NULL GROUP BY ALL HAVING count(*) >= 3),
f AS (
SELECT manual_id, 'E' AS severity, 'id' AS rule, CAST(reg_id AS VARCHAR) AS subject FROM device_registers WHERE trim(coalesce(param_id, '')) = ''
UNION ALL SELECT manual_id, 'E', 'duplicate_id', param_id || ':' || reg_id FROM (SELECT *, row_number() OVER (PARTITION BY manual_id, param_id ORDER BY reg_id) AS nth FROM good) WHERE nth > 1
UNION ALL SELECT manual_id, 'W', 'bitfield_with_values', param_id || ':' || reg_id FROM good WHERE data_type = 'bitfield' AND coalesce(len(map_keys(value_map)), 0) > 0
UNION ALL SELECT manual_id, 'W', 'values_over_0_1', param_id || ':' || reg_id FROM good WHERE coalesce(len(map_keys(value_map)), 0) > 0 AND regexp_replace(value_range, '\s', '', 'g') IN ('0-1', '0to1') AND coalesce(data_type, '') <> 'bool'
UNION ALL SELECT manual_id, 'E', 'duplicate_address', param_id || ':' || reg_id FROM (SELECT *, row_number() OVER (PARTITION BY manual_id, modbus.address ORDER BY reg_id) AS nth FROM good WHERE modbus.address IS NOT NULL) WHERE nth > 1
UNION ALL SELECT manual_id, 'W', 'few_parameters', CAST(n AS VARCHAR) FROM cnt WHERE n < 10
UNION ALL SELECT manual_id, 'E', 'blank_ref', param_id || ':' || reg_id FROM good WHERE trim(knowledge_ref) = ''
UNION ALL SELECT manual_id, 'W', 'missing_topic', knowledge_ref FROM good g WHERE trim(knowledge_ref) <> '' AND EXISTS (SELECT 1 FROM files f WHERE f.manual_id = g.manual_id) AND NOT EXISTS (SELECT 1 FROM files f WHERE f.manual_id = g.manual_id AND f.r = g.knowledge_ref)
UNION ALL SELECT manual_id, 'W', 'missing_see_also', r FROM (SELECT manual_id, unnest(see_also) AS r FROM knowledge) x WHERE NOT EXISTS (SELECT 1 FROM files f WHERE f.manual_id = x.manual_id AND f.r = x.r)
UNION ALL SELECT manual_id, 'W', 'missing_diagram', r FROM (SELECT manual_id, unnest(list_transform(diagrams, lambda v: v.filename)) AS r FROM knowledge) x WHERE NOT EXISTS (SELECT 1 FROM images i WHERE i.manual_id = x.manual_id AND i.filename = x.r)
UNION ALL SELECT manual_id, 'W', 'missing_parameter', r FROM (SELECT DISTINCT manual_id, r FROM (SELECT manual_id, unnest(list_transform(related_parameters, lambda v: v.id)) AS r FROM knowledge)) x WHERE NOT EXISTS (SELECT 1 FROM device_registers i WHERE i.manual_id = x.manual_id AND i.param_id = x.r)
UNION ALL SELECT c.manual_id, 'E', 'index_total', CAST(total AS VARCHAR) FROM cnt c JOIN tot t ON t.manual_id = c.manual_id WHERE n <> total
UNION ALL SELECT manual_id, 'E', 'unknown_group', param_id || ':' || reg_id FROM good g WHERE group_id IS NOT NULL AND EXISTS (SELECT 1 FROM grp WHERE grp.manual_id = g.manual_id) AND NOT EXISTS (SELECT 1 FROM grp WHERE grp.manual_id = g.manual_id AND grp.g = lower(g.group_id)))
SELECT * FROM f""")
def v_findings(spark, d):
    """Every breach of the integrity rules; the index totals leave out deleted registers, groups of fewer than three registers of a manual count as unlisted."""
    regs = table(spark, d, "device_registers")
    totals = regs.filter("deleted_at is null").groupBy("manual_id").agg(F.count("*").alias("total"))
    groups = regs.filter("group_id is not null").groupBy("manual_id", F.lower("group_id").alias("group_id")).agg(F.count("*").alias("n")).filter("n >= 3").select("manual_id", "group_id")
    return links.findings(regs, table(spark, d, "knowledge"), table(spark, d, "images"), totals, groups)


@query(SQL["v_findings"].replace("SELECT * FROM f", "SELECT severity, rule, count(*) AS n FROM f GROUP BY ALL"))
def v_report(spark, d):
    return v_findings(spark, d).groupBy("severity", "rule").agg(F.count("*").alias("n"))


@query("SELECT reg_id, param_id, coalesce('0x' || lower(to_hex(modbus.address)), '-') AS address, coalesce(CAST(source_page AS VARCHAR), '-') AS page FROM device_registers ORDER BY md5(CAST(reg_id AS VARCHAR)) LIMIT 5")
def o6_spot_check(spark, d):
    """Five registers for review."""
    return documents.spot_rows(table(spark, d, "device_registers"))


@query("SELECT know_id, extraction_confidence, content_completeness FROM knowledge WHERE extraction_confidence = 'low' OR content_completeness = 'stub'")
def c13_refine_targets(spark, d):
    return links.refine_targets(table(spark, d, "knowledge", "know_id", "extraction_confidence", "content_completeness"))


@query("SELECT device_id, arg_max(manual_id, (coalesce(quality_score, -1), parsed_at, manual_id)) AS manual_id, count(*) FILTER (WHERE quality_score < 3.0 AND NOT coalesce(force_ocr_hint_used, false)) AS n_to_retry FROM manuals GROUP BY 1")
def c16_parse_attempts(spark, d):
    """The best parse of each device, and how many parses call for a retry."""
    retry = F.sum(F.when((F.col("quality_score") < 3.0) & ~F.coalesce("force_ocr_hint_used", F.lit(False)), 1).otherwise(0))
    return table(spark, d, "manuals").groupBy("device_id").agg(F.max_by("manual_id", F.struct(F.coalesce("quality_score", F.lit(-1.0)), "parsed_at", "manual_id")).alias("manual_id"), retry.alias("n_to_retry"))


@query("SELECT s_suppkey, CAST(octet_length(encode(s_name)) AS INT) AS n_bytes FROM supplier WHERE s_suppkey % 4 <> 0")
def s12_decoded_images(spark, d):
    """Base64 entries decoded, bad ones skipped."""
    entry = F.when(F.col("s_suppkey") % 4 == 0, "@@").otherwise(F.base64(F.encode("s_name", "utf-8")))
    return documents.decoded_images(table(spark, d, "supplier").withColumn("entry", entry), "s_suppkey", "entry").select("s_suppkey", F.octet_length("content").alias("n_bytes"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 3 = 0")
def s10_tolerant_json(spark, d):
    """JSON read as empty where it is cut off."""
    cut = F.when(F.col("event_id") % 3 == 0, F.left("props", F.length("props") - 1)).otherwise(F.col("props"))
    return table(spark, d, "events").select("event_id", documents.tolerant_json(cut, "$.k", "int").alias("k"))


@query("SELECT manual_id, count(*) AS total_parameters, count(DISTINCT group_id) AS n_groups, list_sort(list_distinct(list(group_id) FILTER (WHERE group_id IS NOT NULL))) AS groups FROM device_registers GROUP BY 1")
def a9_totals(spark, d):
    return table(spark, d, "device_registers").groupBy("manual_id").agg(F.count("*").alias("total_parameters"), F.countDistinct("group_id").alias("n_groups"), F.array_sort(F.collect_set("group_id")).alias("groups"))


@query("SELECT DISTINCT manual_id, upper(trim(u.id)) AS id FROM (SELECT manual_id, unnest(related_parameters) AS u FROM knowledge) WHERE u.id IS NOT NULL")
def a16_related_union(spark, d):
    return table(spark, d, "knowledge").select("manual_id", F.explode("related_parameters").alias("u")).filter("u.id is not null").select("manual_id", F.upper(F.trim("u.id")).alias("id")).distinct()


# ---- assembled records, documents and files ----


@query(f"SELECT reg_id, coalesce(list_sort(map_keys(value_map)) = ['0', '1'] AND {s_range('value_range', 1)} = 0 AND {s_range('value_range', 2)} = 1, false) AS two_state FROM device_registers")
def f27_two_state(spark, d):
    r = R.range_value(F.col("value_range"))
    return table(spark, d, "device_registers").select("reg_id", R.is_two_state(F.map_keys("value_map"), r["min"], r["max"]).alias("two_state"))


def s_printed(e: str) -> str:
    """A number as a brief prints it, with HUGEINT in place of decimals."""
    t = f"replace(trim({e}), ' ', '')"
    n = rf"CAST(regexp_extract({t}, '2\^(\d+)', 1) AS INT)"
    power = f"(CASE WHEN {t}[1] = '-' THEN -1 ELSE 1 END)::HUGEINT * (1::HUGEINT << {n}) - (CASE WHEN regexp_matches({t}, '\\d-1$') THEN 1 ELSE 0 END)"
    return rf"CASE WHEN regexp_matches({t}, '^-?\d+$') THEN CAST(TRY_CAST({t} AS HUGEINT) AS VARCHAR) WHEN regexp_matches({t}, '^(-?)2\^(\d+)(-1)?$') THEN CAST({power} AS VARCHAR) WHEN regexp_matches(trim({e}), '^-?\d+\.\d+$') THEN CAST(CAST(trim({e}) AS DOUBLE) AS VARCHAR) END"


def s_range_text(e: str, k: int) -> str:
    c = rf"regexp_replace(replace(trim({e}), ' ', ''), '\^\{{(\d+)\}}', '^\1', 'g')"
    g1, g2 = r"^(\d+)-\((2\^\d+(?:-1)?)\)$", r"^\(?(-?2\^\d+)\)?-\(?(-?2\^\d+(?:-1)?)\)?$"
    g3 = r"(?i)^\s*(-?\d+(?:\.\d+)?)\s*(?:to|-)\s*(-?\d+(?:\.\d+)?)\s*$"
    end = lambda x, g: s_printed(f"regexp_extract({x}, '{g}', {k})")
    return f"CASE WHEN {_S_BLANK.format(e)} THEN NULL WHEN regexp_matches({c}, '{g1}') THEN {end(c, g1)} WHEN regexp_matches({c}, '{g2}') THEN {end(c, g2)} WHEN regexp_matches({e}, '{g3}') THEN {end(e, g3)} END"


@query(f"SELECT reg_id, concat_ws(' ', param_name, 'Range ' || {s_range_text('value_range', 1)} || ' to ' || {s_range_text('value_range', 2)} || '.', 'Default ' || default_value || '.', 'Unit ' || nullif(unit, '') || '.', 'Write condition ' || write_condition || '.', 'Takes effect ' || takes_effect || '.') AS brief FROM device_registers WHERE lower(trim(coalesce(brief, ''))) IN ('', 'no description in manual.')")
def f28_briefs(spark, d):
    """Briefs written where the manual has none, whatever the form of the range."""
    r = R.range_texts(F.col("value_range"))
    regs = table(spark, d, "device_registers").filter(R.is_placeholder(F.col("brief")))
    brief = R.brief_of(F.col("param_name"), r["min"], r["max"], F.lit(None).cast("string"), F.col("default_value"), F.col("unit"), F.col("write_condition"), F.col("takes_effect"))
    return regs.select("reg_id", brief.alias("brief"))


@query(f"WITH f AS (SELECT know_id, unnest(regexp_extract_all(body, '{_S_ID}')) AS id, generate_subscripts(regexp_extract_all(body, '{_S_ID}'), 1) - 1 AS nth, body FROM knowledge WHERE body <> '') SELECT know_id, CAST(nth AS INT) AS nth, id, trim(substr(body, greatest(pos_ - 120, 1), least(120, pos_ - 1) + 166)) AS around FROM (SELECT *, 1 + 6 * nth + CAST(list_sum(list_transform(string_split_regex(body, '{_S_ID}')[1:nth + 1], lambda x: length(x))) AS BIGINT) AS pos_ FROM f)")
def w8_snippets(spark, d):
    """The text around each parameter id."""
    return records.mentions(table(spark, d, "knowledge"), ["know_id"], F.col("body"))


@query(f"WITH {_S_MENTIONS} SELECT reg_id, coalesce(CASE WHEN f.id IS NOT NULL THEN greatest(1, f.v.idx - 1) END, source_page) AS source_page FROM device_registers r LEFT JOIN firsts f ON f.manual_id = r.manual_id AND f.id = upper(trim(r.param_id))")
def j3_mention_pages(spark, d):
    """The page where a parameter is first named, else its own."""
    found = _mentions(spark, d).select("manual_id", "id", R.source_page(F.col("idx")).cast("int").alias("named"))
    return documents.named_pages(table(spark, d, "device_registers"), found)


@query(f"WITH {_S_ROWS}, {_S_MENTIONS} SELECT DISTINCT manual_id, id, 'table' AS origin FROM rows UNION ALL SELECT manual_id, id, 'text' FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM rows r WHERE r.manual_id = f.manual_id AND r.id = f.id)")
def u1_all_records(spark, d):
    """Parameters of tables, and those that only the text names."""
    return documents.all_parameter_ids(_typed(spark, d), _mentions(spark, d))


@query()
def u1_parsed_records(spark, d):
    """The pipeline's records of the tables and texts of all nodes of parsed."""
    from pagelattice.plans import pipeline

    return pipeline.from_tables(pages.page_nodes(table(spark, d, "parsed")))


@query("SELECT m.manual_id, '1.0' AS schema_version, v.manufacturer, v.model_name AS model, list_sort(list_distinct(list(lower(group_id)) FILTER (WHERE group_id IS NOT NULL))) AS groups, list_sort(list(param_id) FILTER (WHERE param_id IS NOT NULL)) AS parameters FROM manuals m JOIN devices v ON v.device_id = m.device_id JOIN device_registers r ON r.manual_id = m.manual_id GROUP BY ALL")
def f42_documents(spark, d):
    """The register document of each manual."""
    lists = table(spark, d, "device_registers").groupBy("manual_id").agg(F.array_sort(F.collect_set(F.lower("group_id"))).alias("groups"), F.array_sort(F.collect_list("param_id")).alias("parameters"))
    named = table(spark, d, "manuals").select("manual_id", "device_id").join(table(spark, d, "devices").select("device_id", "manufacturer", F.col("model_name").alias("model")), "device_id")
    return named.join(lists, "manual_id").select("manual_id", F.lit("1.0").alias("schema_version"), "manufacturer", "model", "groups", "parameters")


@query(r"WITH c AS (SELECT DISTINCT manual_id, split_part(regexp_replace(rel_path, '\.md$', ''), '/', 1) AS c FROM knowledge), u AS (SELECT manual_id, list_sort(list(DISTINCT group_id)) AS uncovered FROM device_registers g WHERE coalesce(group_id, '') <> '' AND NOT EXISTS (SELECT 1 FROM c WHERE c.manual_id = g.manual_id AND (c = group_id OR c = split_part(group_id, '/', 1))) GROUP BY 1), t AS (SELECT manual_id, count(*) AS total_parameters FROM device_registers GROUP BY 1) SELECT k.manual_id, any_value(total_parameters) AS total_parameters, list_sort(list(rel_path)) AS paths, coalesce(any_value(uncovered), []) AS uncovered FROM knowledge k LEFT JOIN t ON t.manual_id = k.manual_id LEFT JOIN u ON u.manual_id = k.manual_id GROUP BY 1")
def f43_indexes(spark, d):
    """The coverage index of each manual."""
    k, regs = table(spark, d, "knowledge"), table(spark, d, "device_registers")
    paths = links.index_sections(k).groupBy("manual_id").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    open_ = links.uncovered_groups(regs, k).groupBy("manual_id").agg(F.array_sort(F.collect_list("group_id")).alias("uncovered"))
    totals = regs.groupBy("manual_id").agg(F.count("*").alias("total_parameters"))
    return paths.join(totals, "manual_id", "left").join(open_, "manual_id", "left").select("manual_id", "total_parameters", "paths", F.coalesce("uncovered", F.array().cast("array<string>")).alias("uncovered"))


@query("WITH refs AS (SELECT DISTINCT split_part(replace(u.filename, '\\', '/'), '/', -1) AS filename FROM (SELECT unnest(diagrams) AS u FROM knowledge) WHERE trim(u.filename) <> '') SELECT image_id, filename FROM images i WHERE filename IN (SELECT filename FROM refs) AND filename NOT IN (SELECT filename FROM images WHERE deleted_at IS NOT NULL AND filename IS NOT NULL)")
def j17_images_to_copy(spark, d):
    """Images that topics show and that are not there yet; the deleted ones stand for those that are."""
    from pagelattice.sources.files import images_to_copy

    images = table(spark, d, "images")
    shown = table(spark, d, "knowledge").select(F.explode("diagrams").alias("u")).select(F.element_at(F.split(F.translate("u.filename", "\\", "/"), "/"), -1).alias("filename"))
    return images_to_copy(shown, images, images.filter("deleted_at is not null")).select("image_id", "filename")
