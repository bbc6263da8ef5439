"""Text and HTML as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import html.entities
import json
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must match as the manuals' extractor matches.
BLANKS = r"[\s\x{85}\p{Z}]+"
TAG = r"<[^>]+>"
ANY_TABLE = r"(?is)<table[^>]*>.*?</table>"
ANY_ROW, ANY_CELL = r"(?is)<tr[^>]*>(.*?)</tr>", r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"
ANY_HEADING = r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"
ANY_PARAGRAPH, ANY_ITEM = r"(?is)<p[^>]*>(.*?)</p>", r"(?is)<li[^>]*>(.*?)</li>"
ANY_IMAGE, NAMED_IMAGE = r"(?i)<img[^>]*>", r"(?i)<img[^>]*alt=\"([^\"]*)\"[^>]*>"
PARAMETER_ID = r"\b[CFRU][0-9A-F]{2}\.[0-9A-F]{2}\b"
GROUP_CODE = r"(?i)\b[cfru][0-9a-f]{2}\b"


def let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f uses it; keeps the generated code small too."""
    return F.get(F.transform(F.array(value), f), 0)


def squeezed(c: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def clean_spaced(c: Column) -> Column:
    """Tags become spaces."""
    return squeezed(F.regexp_replace(c, TAG, " "))


def clean_joined(c: Column) -> Column:
    """Tags vanish."""
    return squeezed(F.regexp_replace(c, TAG, ""))


@lru_cache(maxsize=1)
def _entity_table() -> str:
    """JSON of all entities of HTML and what they stand for, the numbers of control characters included, from Python's own table."""
    table = {f"&{name}": to for name, to in html.entities.html5.items()}
    for n in range(128, 160):  # meant as the Windows code page
        table[f"&#{n};"] = bytes([n]).decode("cp1252", "replace").replace("\ufffd", chr(n))
    return json.dumps(table)


def unescaped(c: Column) -> Column:
    """All entities of HTML written out, numbered ones too; unknown ones stay. What an &amp; begins is no entity."""
    known = F.from_json(F.lit(_entity_table()), "map<string,string>")

    def meaning(e: Column) -> Column:
        digits = F.regexp_extract(e, r"^&#[xX]?([0-9a-fA-F]+);?$", 1)
        n = F.when(e.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        windows = F.element_at(known, F.concat(F.lit("&#"), n.cast("string"), F.lit(";")))
        char = F.when((n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "\ufffd").otherwise(F.coalesce(windows, F.decode(F.unhex(F.lpad(F.hex(n), F.lit(8), F.lit("0"))), "UTF-32")))
        return F.when(F.startswith(e, F.lit("&#")), char).otherwise(F.element_at(known, e))

    def written(t: Column) -> Column:
        met = F.array_distinct(F.regexp_extract_all(t, F.lit(r"&(?:#[0-9]{1,10};?|#[xX][0-9a-fA-F]{1,8};?|[A-Za-z][A-Za-z0-9]{1,31};?)"), 0))
        pairs = F.filter(F.transform(met, lambda e: F.struct(e.alias("e"), meaning(e).alias("to"))), lambda p: p["to"].isNotNull())
        # longer ones first, as &lt begins &lt; too; & itself last
        ordered = F.array_sort(pairs, lambda p, q: F.when((p["to"] == "&") != (q["to"] == "&"), F.when(p["to"] == "&", 1).otherwise(-1)).otherwise(F.length(q["e"]) - F.length(p["e"])))
        return F.aggregate(ordered, t, lambda acc, p: F.replace(acc, p["e"], p["to"]))

    return let(c, lambda t: F.when(F.contains(t, F.lit("&")), written(t)).otherwise(t))


def clean_cell(c: Column) -> Column:
    """Superscripts as ^n, entities written out, tags become spaces."""
    return squeezed(F.regexp_replace(unescaped(F.regexp_replace(c, r"(?i)<sup>\s*([+-]?\d+)\s*</sup>", r"^$1")), TAG, " "))


def slug(c: Column, joint: str = "_", default: str | None = "section") -> Column:
    """Letters and digits in lower case, anything else as one joint."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", joint), f"^{joint}|{joint}$", "")
    return s if default is None else F.when(s == "", default).otherwise(s)


def model_glob(c: Column) -> Column:
    """Letters and digits alone."""
    return F.regexp_replace(c, "[^A-Za-z0-9]+", "")


def topic_slug(c: Column) -> Column:
    """A slug of 60 characters at most, without joints at its end."""
    s = slug(c)
    return F.when(F.length(s) > 60, F.regexp_replace(F.left(s, F.lit(60)), "_+$", "")).otherwise(s)


def _segments(c: Column) -> Column:
    return F.filter(F.split(F.translate(c, "\\", "/"), "/"), lambda p: squeezed(p) != "")


def group_path(c: Column) -> Column:
    """Each segment of a path as slug; misc without any."""
    p = F.array_join(F.transform(_segments(F.coalesce(c, F.lit(""))), lambda p: slug(p)), "/")
    return F.when(p == "", "misc").otherwise(p)


def topic_path(group: Column, topic: Column, heading: Column, index: Column) -> Column:
    """The place of a topic file: the group's path, or the topic's own if there is no group, and the topic's last segment as slug."""
    parts = _segments(F.coalesce(F.trim(topic), F.lit("")))
    n = F.size(parts)
    seed = F.when(n > 0, F.element_at(parts, -1)).when(F.coalesce(heading, F.lit("")) != "", heading).otherwise(F.format_string("section_%03d", index))
    own = F.array_join(F.transform(F.slice(parts, 1, F.greatest(n - 1, F.lit(0))), lambda p: slug(p)), "/")
    folder = F.when((F.coalesce(group, F.lit("")) == "") & (n > 1), own).otherwise(group_path(group))
    return F.concat(folder, F.lit("/"), topic_slug(seed), F.lit(".md"))


def heading_of(html: Column) -> Column:
    """The first heading of more than three characters, else the first sentence of 5 to 96, else the first ten words."""

    def of_text(text: Column) -> Column:
        words = F.array_join(F.slice(F.split(text, " "), 1, 10), " ")
        rest = F.when(text != "", words).otherwise("Untitled section")
        sentence = F.trim(F.element_at(F.split(text, r"[.!?][\s\x{85}\p{Z}]+", 2), 1))
        return let(sentence, lambda s: F.when((F.length(s) > 4) & (F.length(s) <= 96), s).otherwise(rest))

    heads = F.filter(F.transform(F.regexp_extract_all(html, F.lit(ANY_HEADING), 1), clean_spaced), lambda h: F.length(h) > 3)
    return let(F.get(heads, 0), lambda h: F.when(h.isNotNull(), F.left(h, F.lit(96))).otherwise(let(clean_spaced(html), of_text)))


def word_count(text: Column) -> Column:
    """Words of a squeezed text."""
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def tables_in(html: Column) -> Column:
    """The tables of a page."""
    return F.regexp_extract_all(html, F.lit(ANY_TABLE), 0)


def table_rows(table: Column) -> Column:
    """The rows of a table as arrays of cleaned cells, without empty rows."""
    rows = F.transform(F.regexp_extract_all(table, F.lit(ANY_ROW), 1), lambda r: F.transform(F.regexp_extract_all(r, F.lit(ANY_CELL), 1), clean_cell))
    return F.filter(rows, lambda r: F.size(r) > 0)


def table_text(table: Column) -> Column:
    """A table in padded columns with a dashed line under the first row; of one row alone, the row."""
    cell = lambda r, k: F.coalesce(F.get(r, k), F.lit(""))

    def padded(x: Column) -> Column:
        rows, widths = x["rows"], x["widths"]
        line = lambda r: F.array_join(F.transform(widths, lambda w, k: F.rpad(cell(r, k), w, F.lit(" "))), " | ")
        rule = F.array_join(F.transform(widths, lambda w: F.repeat(F.lit("-"), w)), " | ")
        rest = F.transform(F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))), line)
        return F.array_join(F.concat(F.array(line(F.get(rows, 0)), rule), rest), "\n")

    def of(rows: Column) -> Column:
        at = F.sequence(F.lit(0), F.array_max(F.transform(rows, F.size)) - 1)
        widths = F.transform(at, lambda k: F.greatest(F.lit(3), F.array_max(F.transform(rows, lambda r: F.length(cell(r, k))))))
        many = let(F.struct(rows.alias("rows"), widths.alias("widths")), padded)
        return F.when(F.size(rows) == 0, "").when(F.size(rows) == 1, F.array_join(F.get(rows, 0), " | ")).otherwise(many)

    rows = F.transform(F.regexp_extract_all(table, F.lit(ANY_ROW), 1), lambda r: F.transform(F.regexp_extract_all(r, F.lit(ANY_CELL), 1), clean_joined))
    return let(F.filter(rows, lambda r: F.exists(r, lambda x: x != "")), of)


def _none() -> Column:
    return F.array().cast("array<string>")


def html_text(html: Column) -> Column:
    """Readable text of a page, by kind: headings, image descriptions, tables, paragraphs, list items; the bare text if there is none."""
    whole_heading, whole_table = r"(?is)<h[1-6][^>]*>.*?</h[1-6]>", r"(?is)<table.*?</table>"
    heads = F.transform(F.regexp_extract_all(html, F.lit(whole_heading), 0), lambda h: F.struct(F.regexp_extract(h, r"(?i)^<h([1-6])", 1).cast("int").alias("level"), clean_joined(F.regexp_extract(h, ANY_HEADING, 1)).alias("t")))
    heads = F.transform(F.filter(heads, lambda h: h["t"] != ""), lambda h: F.concat(F.lit("\n"), F.repeat(F.lit("#"), F.least(h["level"] + 1, F.lit(4))), F.lit(" "), h["t"], F.lit("\n")))

    def of_bare(bare: Column, first: Column) -> Column:
        paragraphs = F.transform(F.regexp_extract_all(bare, F.lit(ANY_PARAGRAPH), 1), lambda p: clean_joined(F.regexp_replace(p, r"(?i)<br\s*/?>", "\n")))
        items = F.filter(F.transform(F.regexp_extract_all(bare, F.lit(ANY_ITEM), 1), clean_joined), lambda t: t != "")
        parts = F.concat(first, F.filter(paragraphs, lambda p: F.length(p) > 3), F.transform(items, lambda t: F.concat(F.lit("- "), t)))
        return let(parts, lambda x: F.when(F.size(x) > 0, F.array_join(x, "\n\n")).otherwise(clean_joined(bare)))

    def of_rest(rest: Column) -> Column:
        images = F.filter(F.transform(F.regexp_extract_all(rest, F.lit(NAMED_IMAGE), 1), F.trim), lambda a: a != "")
        tables = F.filter(F.transform(F.regexp_extract_all(rest, F.lit(whole_table), 0), table_text), lambda t: t != "")
        around = lambda a, before, after: F.transform(a, lambda x: F.concat(F.lit(before), x, F.lit(after)))
        some = F.contains(F.lower(rest), F.lit("<table")) | F.contains(F.lower(rest), F.lit("<img"))  # most pages have neither
        first = F.concat(heads, F.when(some, F.concat(around(images, "\n[Image: ", "]\n"), around(tables, "\n", "\n"))).otherwise(_none()))
        bare = F.when(some, F.regexp_replace(F.regexp_replace(rest, whole_table, ""), NAMED_IMAGE, "")).otherwise(rest)
        return let(F.struct(bare.alias("bare"), first.alias("first")), lambda x: of_bare(x["bare"], x["first"]))

    return F.regexp_replace(let(F.regexp_replace(html, whole_heading, ""), of_rest), r"^[\s\x{85}\p{Z}]+|[\s\x{85}\p{Z}]+$", "")


def image_refs(html: Column, page_no: Column) -> Column:
    """(filename, content_summary, source_page) of the images of a page, the first of each file."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(ANY_IMAGE), 0), lambda t: F.regexp_extract(t, r'(?i)src="([^"]+)"', 1) != "")
    found = F.transform(tags, lambda t: F.struct(
        F.trim(F.element_at(F.split(F.regexp_replace(F.regexp_extract(t, r'(?i)src="([^"]+)"', 1), "/+$", ""), "/"), -1)).alias("filename"),
        F.trim(F.regexp_extract(t, r'(?i)alt="([^"]*)"', 1)).alias("alt"),
    ))
    named = F.filter(found, lambda x: x["filename"] != "")
    first = F.filter(named, lambda x, i: F.array_position(F.transform(named, lambda y: y["filename"]), x["filename"]) == i + 1)
    return F.transform(first, lambda x: F.struct(
        x["filename"].alias("filename"),
        F.left(F.when(x["alt"] == "", F.concat(F.lit("Diagram extracted from manual page "), page_no.cast("string"), F.lit("."))).otherwise(x["alt"]), F.lit(400)).alias("content_summary"),
        page_no.alias("source_page"),
    ))


def title_of(heading: Column) -> Column:
    """A heading's first 96 characters."""
    h = F.trim(F.coalesce(heading, F.lit("")))
    return F.when(h == "", "Untitled Knowledge Section").otherwise(F.left(h, F.lit(96)))


def tidy_body(body: Column) -> Column:
    """Blanks squeezed within lines, lines repeated in a row once, at most one empty line in a row."""
    lines = F.transform(F.split(F.regexp_replace(body, r"[ \t]+", " "), "\n"), lambda x: F.regexp_replace(x, r"\s+$", ""))
    lines = F.filter(lines, lambda x, i: (x == "") | (i == 0) | (x != F.get(lines, i - 1)))
    return F.trim(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"))


def ref_key(c: Column) -> Column:
    """A reference trimmed, with / for \\."""
    return F.translate(F.trim(c), "\\", "/")


def section_ref(section: Column, path: Column) -> Column:
    """The stated section, else the path without .md."""
    s = F.trim(F.coalesce(section, F.lit("")))
    return F.when(s != "", s).otherwise(F.regexp_replace(path, r"\.md$", ""))


def stem_title(path: Column) -> Column:
    """A title from a file name."""
    return F.initcap(F.translate(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.md$", ""), "_", " "))


def parameter_ids(text: Column, ignore_case: bool = True) -> Column:
    """The parameter ids in a text, in upper case, as they come."""
    return F.transform(F.regexp_extract_all(text, F.lit(("(?i)" if ignore_case else "") + PARAMETER_ID), 0), F.upper)


def related_ids(text: Column, most: int = 30) -> Column:
    """The first 30 distinct parameter ids in order. The cut is the feature: files list no more."""
    return F.slice(F.array_sort(F.array_distinct(parameter_ids(text))), 1, most)


def group_codes(text: Column) -> Column:
    """The group codes in a text, in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(GROUP_CODE), 0), F.lower)
