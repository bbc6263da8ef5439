"""Pages of manuals: their blocks, text, kind and group, and the sections that adjacent pages form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagelattice.functions import classify as C
from pagelattice.functions import text as X
from pagelattice.operators import nested


def _children(c: Column) -> Column:
    """The objects of a JSON list; null for invalid text and other values."""
    return F.filter(F.try_variant_get(F.try_parse_json(c), "$", "array<variant>"), lambda x: F.startswith(F.schema_of_variant(x), F.lit("OBJECT")))


def _string(v: Column, path: str) -> Column:
    inner = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(inner) == "STRING", F.try_variant_get(v, path, "string"))


def _integer(v: Column, path: str) -> Column:
    inner = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(inner) == "BIGINT", F.try_variant_get(v, path, "int"))


def top_blocks(parsed: DataFrame) -> DataFrame:
    """The blocks directly below each page with their place: page_id, pos, block_type, own_page, html. Invalid JSON has none."""
    return parsed.select("page_id", F.posexplode(_children(F.col("children"))).alias("pos", "v")).select(
        "page_id", "pos", _string(F.col("v"), "$.block_type").alias("block_type"), _integer(F.col("v"), "$.page").alias("own_page"), _string(F.col("v"), "$.html").alias("html")
    )


def page_views(parsed: DataFrame, *carried: str) -> DataFrame:
    """Each page with its whole markup (own, then its direct children's), cleaned text and 1-based number.

    The number is the page's own, else the first of a child, else its place in the manual. Pages without
    text are left out. Null markup counts as empty. Columns in carried come along.
    """
    kids = _children(F.col("children"))
    inner = F.filter(F.transform(kids, lambda v: _string(v, "$.html")), lambda h: h.isNotNull() & (h != ""))
    own = F.when(F.coalesce("html", F.lit("")) != "", F.array("html")).otherwise(F.array().cast("array<string>"))
    full = F.array_join(F.concat(own, F.coalesce(inner, F.array().cast("array<string>"))), "\n")
    first = F.get(F.filter(F.transform(kids, lambda v: _integer(v, "$.page")), lambda p: p.isNotNull()), 0)
    views = parsed.select("page_id", "manual_id", "device_id", "idx", (F.coalesce("page", first, "idx") + 1).alias("page_num"), "html", full.alias("full_html"), *carried)
    return views.withColumn("text", X.clean_spaced(F.col("full_html"))).filter(F.col("text") != "")


def page_nodes(parsed: DataFrame) -> DataFrame:
    """Each page and every object below it at any depth and under any key: manual_id, idx, page_id, node_seq (0 for the page, then pre-order), page, html.

    page is the nearest one named on the way up; null without any. Reading order: idx, page_id, node_seq.
    """
    keys = ["manual_id", "idx", "page_id"]
    own = parsed.select(*keys, F.lit(0).alias("node_seq"), F.col("page").cast("int").alias("page"), "html")
    below = nested.block_table(parsed, keys, any_key=True).select(*keys, "node_seq", F.when(F.col("eff_page") != -1, F.col("eff_page")).alias("page"), "html")
    return own.unionByName(below)


def classified_pages(views: DataFrame, *carried: str) -> DataFrame:
    """Each page as a section of its own: heading, kind, group, topic, excerpt of 700 characters."""
    group, heading = C.group_of(F.col("text")), X.heading_of(F.col("full_html"))
    out = views.select("page_id", "manual_id", "device_id", "idx", "page_num", heading.alias("section_heading"), C.content_type(F.col("text"), F.col("full_html")).alias("content_type"), group.alias("suggested_group"), F.left("text", F.lit(700)).alias("excerpt"), *carried)
    return out.withColumn("suggested_knowledge_topic", F.when(F.col("suggested_group").isNotNull(), F.concat("suggested_group", F.lit("/"), X.slug(F.col("section_heading")))))


def merged_sections(pages: DataFrame) -> DataFrame:
    """Adjacent pages of one kind and group as one section; narrative pages merge whatever their group.

    A narrative section takes the last group named in it, and the topic of the page where that group last
    changed. Order within a manual: idx, then page_id. One window sort per manual.
    """
    w = Window.partitionBy("manual_id").orderBy("idx", "page_id")
    same = (F.col("content_type") == F.lag("content_type").over(w)) & (F.col("page_num") <= F.lag("page_num").over(w) + 1)
    same = same & ((F.col("content_type") == "narrative_knowledge") | F.col("suggested_group").eqNullSafe(F.lag("suggested_group").over(w)))
    starts = pages.withColumn("starts", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("sec_no", F.sum("starts").over(w))
    inside = Window.partitionBy("manual_id", "sec_no").orderBy("idx", "page_id")
    before = F.last("suggested_group", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    moves = F.col("suggested_group").isNotNull() & ~F.col("suggested_group").eqNullSafe(before)
    marked = starts.withColumn("place", F.struct("idx", "page_id")).withColumn("moves", moves)
    group_at = F.when(F.col("suggested_group").isNotNull(), F.col("place"))
    return marked.groupBy("manual_id", "device_id", "sec_no").agg(
        F.min_by("section_heading", "place").alias("section_heading"), F.min_by("page_num", "place").alias("page_start"), F.max_by("page_num", "place").alias("page_end"),
        F.first("content_type").alias("content_type"), F.max_by("suggested_group", group_at).alias("suggested_group"),
        F.max_by("suggested_knowledge_topic", F.when(F.col("moves"), F.col("place"))).alias("suggested_knowledge_topic"), F.min_by("excerpt", "place").alias("excerpt"), F.count("*").alias("n_pages"),
    )


def section_pages(sections: DataFrame) -> DataFrame:
    """Each section with each page of its range; the first alone where the end is missing or earlier."""
    end = F.when(F.col("page_end") >= F.col("page_start"), F.col("page_end")).otherwise(F.col("page_start"))
    return sections.filter(F.col("page_start").isNotNull()).withColumn("page_no", F.explode(F.sequence("page_start", end)))


def section_bodies(sections: DataFrame, parsed: DataFrame) -> DataFrame:
    """section_id and the readable text of its pages, parted by ---. The range join is an equi-join on the pages of the range."""
    pages = parsed.filter(F.trim(F.coalesce("html", F.lit(""))) != "").select("manual_id", (F.col("idx") + 1).alias("page_no"), "page_id", X.html_text(F.col("html")).alias("t"))
    parts = section_pages(sections.select("section_id", "manual_id", "page_start", "page_end")).join(pages, ["manual_id", "page_no"]).filter("t <> ''")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("page_no", "page_id", "t"))), lambda x: x["t"])
    return parts.groupBy("section_id").agg(F.array_join(texts, "\n\n---\n\n").alias("body"))


def section_diagrams(sections: DataFrame, parsed: DataFrame) -> DataFrame:
    """The images on a section's pages, each file once a page."""
    refs = X.image_refs(F.col("html"), F.col("idx") + 1)
    pages = parsed.filter(F.contains(F.lower("html"), F.lit("<img"))).select("manual_id", (F.col("idx") + 1).alias("page_no"), F.explode(refs).alias("d"))
    hit = section_pages(sections.select("section_id", "manual_id", "page_start", "page_end")).join(pages, ["manual_id", "page_no"])
    return hit.select("section_id", "d.filename", "d.content_summary", "d.source_page").dropDuplicates(["section_id", "filename", "source_page"])


def topic_rows(sections: DataFrame, bodies: DataFrame) -> DataFrame:
    """The frontmatter of the topic file of each section of a kind that gets one, numbered in its manual; path not yet unique."""
    from pagelattice.functions import registers as R

    kept = sections.filter(F.col("content_type").isin(*C.TOPIC_KINDS)).join(bodies, "section_id", "left")
    own, excerpt = F.coalesce("body", F.lit("")), F.trim(F.coalesce("excerpt", F.lit("")))
    body = F.when(F.length(own) >= 20, own).otherwise(F.when(excerpt != "", excerpt).otherwise("No narrative content could be extracted for this section."))
    rows = kept.withColumn("body", body).withColumn("no", F.row_number().over(Window.partitionBy("manual_id").orderBy("sec_no", "section_id")))
    path = X.topic_path(F.col("suggested_group"), F.col("suggested_knowledge_topic"), F.col("section_heading"), F.col("no"))
    n = F.length("body")
    return rows.select("section_id", "manual_id", "no", path.alias("rel_path"), X.title_of(F.col("section_heading")).alias("title"), R.confidence_of(n).alias("extraction_confidence"), R.completeness_of(n).alias("content_completeness"), X.related_ids(F.col("body")).alias("related_parameters"), "body")


def unique_paths(rows: DataFrame) -> DataFrame:
    """rel_path made unique in its manual by _02, _03, … against all paths used so far, in the order of no.

    Only paths that share a stem can meet, so a group is one stem of one manual, and most hold one row.
    """
    stem = F.regexp_replace(F.regexp_replace("rel_path", r"\.md$", ""), r"(_\d{2,})+$", "")

    def resolve(key, frame):
        used, out = set(), []
        tried: dict[str, int] = {}  # all numbers of a path below this one are used
        for path in frame.sort_values("no")["rel_path"]:
            base, free = path[:-3], path
            while free in used:
                n = tried.get(base, 2)
                free, tried[base] = f"{base}_{n:02d}.md", n + 1
            used.add(free)
            out.append(free)
        frame = frame.sort_values("no")
        frame["rel_path"] = out
        return frame[["section_id", "manual_id", "no", "rel_path"]]

    keyed = rows.select("section_id", "manual_id", "no", "rel_path", stem.alias("stem")).withColumn("met", F.count("*").over(Window.partitionBy("manual_id", "stem")))
    alone = keyed.filter("met = 1").select("section_id", "manual_id", "no", "rel_path")
    types = dict(alone.dtypes)
    ddl = ", ".join(f"{c} {types[c]}" for c in alone.columns)
    return alone.unionByName(keyed.filter("met > 1").groupBy("manual_id", "stem").applyInPandas(resolve, ddl))


def with_unique_paths(topics: DataFrame) -> DataFrame:
    """Topics with their rel_path made unique. topics is read twice: give a stored table."""
    return topics.drop("rel_path").join(unique_paths(topics).select("section_id", "rel_path"), "section_id").select(*topics.columns)


def topic_knowledge(topics: DataFrame, diagrams: DataFrame) -> DataFrame:
    """Topics and the diagrams of their sections in the columns of the table knowledge that links and checks read; know_id counts in each manual."""
    shown = diagrams.groupBy("section_id").agg(F.array_sort(F.collect_list(F.struct("filename", "content_summary", "source_page"))).alias("diagrams"))
    related = F.transform("related_parameters", lambda x: F.struct(x.alias("id")))
    return topics.join(shown, "section_id", "left").select(F.col("no").cast("long").alias("know_id"), "manual_id", "rel_path", F.lit(None).cast("string").alias("section_ref"), "title", "extraction_confidence", "content_completeness", related.alias("related_parameters"), F.array().cast("array<string>").alias("see_also"), "diagrams")
