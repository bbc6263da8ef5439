"""Files of manuals: parse trees, markdown, topic files with frontmatter, images; read as tables and written from them."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelattice.functions import text as X
from pagelattice.sources.tables import write_bytes


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    """path and the JSON text of each parse tree below a folder; `tree` is null where the text is no JSON."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value", F.try_parse_json("value").alias("tree"))


def tree_pages(trees: DataFrame) -> DataFrame:
    """path, idx, page, html, children (JSON text) of the page objects of each tree; trees without a list of children have none."""
    kids = F.try_variant_get("tree", "$.children", "array<variant>")
    v = F.col("v")
    return trees.select("path", F.posexplode(kids).alias("idx", "v")).filter(F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))).select(
        "path", "idx", F.try_variant_get(v, "$.page", "int").alias("page"), F.try_variant_get(v, "$.html", "string").alias("html"), F.to_json(F.try_variant_get(v, "$.children", "variant")).alias("children")
    )


def read_markdown_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no, line of the markdown files below a folder; bytes that are no UTF-8 are left out; a replacement character of a valid file stays."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(path)
    given = F.col("content").cast("string")
    text = F.when(F.is_valid_utf8(given), given).otherwise(F.replace(F.make_valid_utf8(given), F.lit("�"), F.lit("")))
    return files.select("path", F.posexplode(F.split(text, "\r?\n")).alias("line_no", "line"))


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    """The rows of sections files, which hold one list each."""
    schema = "section_heading string, page_range array<int>, content_type string, suggested_group string, suggested_knowledge_topic string, excerpt string"
    rows = spark.read.schema(schema).json(path, multiLine=True)
    return rows.withColumns({"page_start": F.get("page_range", 0), "page_end": F.get("page_range", 1)}).drop("page_range")


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """rel_path, front (the frontmatter's text, null without one), body of the topic files below a folder, without indexes."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(path, wholetext=True)
    root = path.rstrip("/").removeprefix("file:").lstrip("/")
    rel = F.regexp_replace(F.regexp_replace("_metadata.file_path", "^file:/*", ""), "^" + root.replace(".", r"\.") + "/", "")
    rows = files.select(rel.alias("rel_path"), F.col("value").alias("md")).filter(~F.endswith("rel_path", F.lit("_index.md")))
    return split_frontmatter(rows, "md")


def split_frontmatter(df: DataFrame, md: str) -> DataFrame:
    """front and body of a text that begins with a line --- and has a closing one; front is null for others."""
    end = F.locate("\n---\n", F.col(md), 5)
    has = F.startswith(F.col(md), F.lit("---\n")) & (end > 0)
    rest = F.substring(F.col(md), end + 5, F.length(md))
    return df.withColumns({"front": F.when(has, F.substring(F.col(md), F.lit(5), end - 5)), "body": F.when(has, F.regexp_replace(rest, "^\n+", "")).otherwise(F.col(md))})


def front_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """Adds a JSON text column for each named field of `front`; null where it is missing.

    Fields as this module writes them, one line each, are read in the JVM. Other YAML is read where the yaml
    library is at hand.
    """
    one_line = F.regexp_extract
    for n in names:
        df = df.withColumn(n, F.nullif(one_line("front", rf"(?m)^{n}: (.*)$", 1), F.lit("")))
    return df


def yaml_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """As front_fields for any YAML, in Arrow batches; frontmatter that is no mapping has no fields."""
    import yaml  # noqa: F401

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import yaml

        for b in batches:
            rows = []
            for text in b.column("front").to_pylist():
                try:
                    doc = yaml.safe_load(text) if text else None
                except yaml.YAMLError:
                    doc = None
                doc = doc if isinstance(doc, dict) else {}
                rows.append([json.dumps(doc[n], ensure_ascii=False, default=str) if n in doc else None for n in names])
            extra = [pa.array([r[i] for r in rows], pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=[*b.schema.names, *names])

    ddl = ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), *(f"`{n}` string" for n in names)])
    return df.mapInArrow(parse, ddl)


def json_line(name: str, value: Column, kind: str) -> Column:
    """`name: value` with the value as JSON, which is YAML too."""
    if kind == "string":
        body = F.regexp_replace(F.to_json(F.struct(value.alias("x"))), r'^\{"x":(.*)\}$', "$1")
        return F.concat(F.lit(f"{name}: "), F.when(value.isNull(), "null").otherwise(body))
    return F.concat(F.lit(f"{name}: "), F.coalesce(F.to_json(value) if kind.startswith(("array", "struct", "map")) else value.cast("string"), F.lit("null")))


def rendered_topics(df: DataFrame, fields: list[str], *, heading: str = "always") -> DataFrame:
    """rel_path and content: frontmatter of the fields in order, the title as heading, the body.

    heading: always; missing (only if the body doesn't begin with one); never.
    """
    types = dict(df.dtypes)
    front = F.concat_ws("\n", *(json_line(n, F.col(n), types[n]) for n in fields))
    title = F.concat(F.lit("## "), F.coalesce("title", F.lit("")), F.lit("\n\n"))
    body = F.coalesce("body", F.lit(""))
    if heading == "always":
        body = F.concat(title, body)
    elif heading == "missing":
        body = F.when(F.startswith(body, F.lit("## ")), body).otherwise(F.concat(title, body))
    return df.select("rel_path", F.concat(F.lit("---\n"), front, F.lit("\n---\n\n"), body, F.lit("\n")).alias("content"))


def write_files(df: DataFrame, folder: str, *, dry_run: bool = False) -> int:
    """Writes each row's content (text or bytes) to folder/rel_path on a file system that all executors share; returns the number of files.

    A file is written under a name of its own and then moved, so that two attempts of a task don't meet and readers see whole files.
    """
    if dry_run:
        return df.count()
    total = df.sparkSession.sparkContext.accumulator(0)

    def write(rows):
        import posixpath
        import uuid

        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))
        for r in rows:
            to = posixpath.normpath(posixpath.join(root, r["rel_path"]))
            if not to.startswith(posixpath.normpath(root) + "/"):
                raise ValueError(f"{r['rel_path']} leaves the folder")
            data = r["content"]
            where.create_dir(posixpath.dirname(to), recursive=True)
            own = f"{to}.{uuid.uuid4().hex}.tmp"
            with where.open_output_stream(own) as f:
                f.write(data.encode("utf-8", "replace") if isinstance(data, str) else bytes(data or b""))
            where.move(own, to)
            total.add(1)

    df.select("rel_path", "content").foreachPartition(write)
    return total.value


def as_yaml(df: DataFrame) -> DataFrame:
    """rel_path and content with JSON contents written as YAML in block style, keys in order and letters as they are."""
    import yaml  # noqa: F401

    def dump(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import yaml

        for b in batches:
            texts = [None if x is None else yaml.safe_dump(json.loads(x), sort_keys=False, allow_unicode=True) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["rel_path", "content"])

    return df.select("rel_path", "content").mapInArrow(dump, "rel_path string, content string")


def read_yaml(spark: SparkSession, path: str, glob: str = "*.yaml") -> DataFrame:
    """path and doc (JSON text; null if the file is unreadable or no mapping) of the YAML files below a folder."""
    import yaml  # noqa: F401

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import yaml

        for b in batches:
            docs = []
            for text in b.column(1).to_pylist():
                try:
                    doc = yaml.safe_load(text)
                except yaml.YAMLError:
                    doc = None
                docs.append(json.dumps(doc, ensure_ascii=False, default=str) if isinstance(doc, dict) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(docs, pa.string())], names=["path", "doc"])

    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), "value").mapInArrow(parse, "path string, doc string")


def listed_parameters(documents: DataFrame) -> DataFrame:
    """path, pos, id and parameter (JSON text) of each parameter of register documents (of read_yaml) that is a mapping."""
    tree = F.try_parse_json("doc")
    each = documents.select("path", F.posexplode(F.try_variant_get(tree, "$.parameters", "array<variant>")).alias("pos", "x")).filter(F.startswith(F.schema_of_variant("x"), F.lit("OBJECT")))
    return each.select("path", "pos", F.try_variant_get("x", "$.id", "string").alias("id"), F.to_json("x").alias("parameter"))


def topic_mappings(spark: SparkSession, path: str) -> DataFrame:
    """rel_path and front (JSON text, {} without frontmatter) of the topic files below a folder, in the order of their path's parts; none if the folder is not there."""
    import yaml  # noqa: F401

    if not exists(spark, path):
        return spark.createDataFrame([], "rel_path string, front string")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import yaml

        for b in batches:
            fronts = []
            for text in b.column(1).to_pylist():
                try:
                    doc = yaml.safe_load(text) if text else None
                except yaml.YAMLError:
                    doc = None
                fronts.append(json.dumps(doc if isinstance(doc, dict) else {}, ensure_ascii=False, default=str))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fronts, pa.string())], names=["rel_path", "front"])

    return read_topics(spark, path).select("rel_path", "front").mapInArrow(parse, "rel_path string, front string").orderBy(F.split("rel_path", "/"))


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def publish(df: DataFrame, path: str) -> None:
    """Writes df as a new version below path and then turns the pointer to it in one step: readers of read_published see the old table or the new one."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    fs, root = _file_system(spark, path)
    old = current_version(spark, path)
    write_bytes(spark, f"{path}/CURRENT.{version}", version.encode())
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.makeQualified(root).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(hadoop.Path(f"{path}/CURRENT.{version}")), fs.makeQualified(hadoop.Path(f"{path}/CURRENT")), overwrite)
    if old:
        fs.delete(hadoop.Path(f"{path}/{old}"), True)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The name of the version that a published table's pointer shows; null without one."""
    if not exists(spark, f"{path}/CURRENT"):
        return None
    return spark.read.text(f"{path}/CURRENT", wholetext=True).first()[0].strip()


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The table that was published last; FileNotFoundError if none was."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/{version}")


def exists(spark: SparkSession, *paths: str) -> bool:
    """Whether all of the paths are there: a parse that need not be repeated."""
    return all(fs.exists(p) for fs, p in (_file_system(spark, x) for x in paths))


def images_to_copy(refs: DataFrame, source: DataFrame, present: DataFrame) -> DataFrame:
    """The images that are referred to, at hand and not yet there; each has filename."""
    return source.join(refs.select("filename").filter(F.trim("filename") != "").distinct(), "filename", "left_semi").join(present.select("filename"), "filename", "left_anti")


def copied_images(spark: SparkSession, refs: DataFrame, source: str, target: str) -> int:
    """Copies the images that are referred to, at hand in source and not yet in target, with their bytes; returns how many. refs: filename."""
    named = lambda folder: spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).withColumn("filename", F.element_at(F.split("path", "/"), -1))
    there = named(target).select("filename") if exists(spark, target) else spark.createDataFrame([], "filename string")
    wanted = images_to_copy(refs, named(source), there).dropDuplicates(["filename"])
    return write_files(wanted.select(F.col("filename").alias("rel_path"), "content"), target)


def repository_root(path: str) -> str | None:
    """The nearest folder at or above path that holds .git; null without one."""
    at = os.path.abspath(path)
    while not os.path.exists(os.path.join(at, ".git")):
        if os.path.dirname(at) == at:
            return None
        at = os.path.dirname(at)
    return at


def upserted_blocks(df: DataFrame, text: str, entry: str, name: str) -> Column:
    """A text with an entry in its marked block: once, after those that are there; the block is added at the end if there is none."""
    begin, end = f"<!-- {name}:start -->", f"<!-- {name}:end -->"
    t, e = F.coalesce(F.col(text), F.lit("")), F.col(entry)
    a, b = F.locate(begin, t), F.locate(end, t)
    inner = F.substring(t, a + len(begin), b - a - len(begin))
    lines = F.array_union(F.filter(F.split(inner, "\n"), lambda x: F.trim(x) != ""), F.array(e))
    inside = F.concat(F.substring(t, F.lit(1), a - 1), F.lit(begin + "\n"), F.array_join(lines, "\n"), F.lit("\n"), F.substring(t, b, F.length(t)))
    added = F.concat(F.when(t == "", "").when(F.endswith(t, F.lit("\n")), F.concat(t, F.lit("\n"))).otherwise(F.concat(t, F.lit("\n\n"))), F.lit(f"## Device Documentation\n{begin}\n"), e, F.lit(f"\n{end}\n\n"))
    return F.when((a > 0) & (b > a), inside).otherwise(added)
