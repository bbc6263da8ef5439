import json

import pytest
from pyspark.sql import functions as F

from pagelattice.plans import pipeline
from pagelattice.sources import files
from pagelattice.streaming import pages as streaming


def test_trees_and_markdown(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/parsed.json").write_text(json.dumps({"children": [{"page": 0, "html": "<p>x</p>", "children": [{"html": "y"}]}, 5]}))
    (tmp_path / "bad.json").write_text("{")
    (tmp_path / "parsed.md").write_bytes(b"| 8.1 | Motor (C00) |\n\xff| 8.2 | Gain (2003h/C01) |\r\nlast")
    trees = files.read_trees(spark, str(tmp_path))
    assert trees.count() == 2
    assert [(r.idx, r.page, r.html, r.children) for r in files.tree_pages(trees).collect()] == [(0, 0, "<p>x</p>", '[{"html":"y"}]')]
    lines = [r.line for r in files.read_markdown_lines(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert lines == ["| 8.1 | Motor (C00) |", "| 8.2 | Gain (2003h/C01) |", "last"]


def test_topics_round_trip(spark, tmp_path):
    rows = [("io/a.md", 'He said "é": x', ["C00.01"], [1, 2], "Body\nmore"), ("b.md", None, None, None, None)]
    df = spark.createDataFrame(rows, "rel_path string, title string, related_parameters array<string>, source_pages array<int>, body string")
    out = files.rendered_topics(df, ["title", "related_parameters", "source_pages"])
    assert files.write_files(out, str(tmp_path), dry_run=True) == 2 and not list(tmp_path.iterdir())
    assert files.write_files(out, str(tmp_path)) == 2
    (tmp_path / "_index.md").write_text("no")
    back = files.front_fields(files.read_topics(spark, str(tmp_path)), ["title", "related_parameters", "missing"])
    got = {r.rel_path: r for r in back.collect()}
    assert set(got) == {"io/a.md", "b.md"}
    assert json.loads(got["io/a.md"].title) == 'He said "é": x' and json.loads(got["io/a.md"].related_parameters) == ["C00.01"]
    assert got["io/a.md"].body == '## He said "é": x\n\nBody\nmore\n' and got["io/a.md"].missing is None
    general = {r.rel_path: r for r in files.yaml_fields(files.read_topics(spark, str(tmp_path)), ["title", "source_pages"]).collect()}
    assert json.loads(general["io/a.md"].source_pages) == [1, 2]
    again = files.rendered_topics(back.select("rel_path", F.lit("T").alias("title"), "body"), ["title"], heading="missing").collect()
    assert any("## He said" in r.content and "## T" not in r.content for r in again)


def test_publish_replaces(spark, tmp_path):
    to = str(tmp_path / "t")
    files.publish(spark.range(3), to)
    files.publish(spark.range(5), to)
    assert files.read_published(spark, to).count() == 5 and len([x for x in (tmp_path / "t").iterdir() if x.name.startswith("v-")]) == 1
    assert files.exists(spark, to) and not files.exists(spark, to, str(tmp_path / "no"))


def test_blocks_and_copies(spark):
    df = spark.createDataFrame([(1, None), (2, "old"), (3, "a\n<!-- d:start -->\nx\n<!-- d:end -->\nz")], "i int, t string").withColumn("e", F.lit("new"))
    got = [r.x for r in df.select("i", files.upserted_blocks(df, "t", "e", "d").alias("x")).orderBy("i").collect()]
    assert got[2] == "a\n<!-- d:start -->\nx\nnew\n<!-- d:end -->\nz" and got[1].startswith("old\n\n## Device Documentation\n<!-- d:start -->\nnew\n")
    twice = spark.createDataFrame([(got[2],)], "t string").withColumn("e", F.lit("new"))
    assert twice.select(files.upserted_blocks(twice, "t", "e", "d").alias("x")).first().x == got[2]
    f = lambda *n: spark.createDataFrame([(x,) for x in n], "filename string")
    assert [r.filename for r in files.images_to_copy(f("a", "b", "a", " "), f("a", "b", "c"), f("b")).collect()] == ["a"]


def test_sections_file(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"section_heading": "H", "page_range": [2, 3], "content_type": "x"}]))
    r = files.read_sections(spark, str(tmp_path / "s.json")).first()
    assert (r.section_heading, r.page_start, r.page_end) == ("H", 2, 3)


def test_pipeline(spark, read):
    out = pipeline.run(read("parsed"), read("knowledge"), read("device_registers"), read("images"))
    assert set(out) == {"sections", "topics", "index", "extracted", "linked", "uncovered", "findings"}
    assert out["sections"].count() > 0 and out["linked"].count() == read("device_registers").count()
    assert out["extracted"].count() == out["extracted"].select("manual_id", "id").distinct().count() > 0
    assert pipeline.failed(out["findings"])
    without = pipeline.run(read("parsed"), read("knowledge"), None, read("images"), pipeline.Run(with_registers=False))
    assert set(without) == {"sections", "topics", "index"}
    try:
        pipeline.run(read("parsed"), read("knowledge"), None, read("images"), pipeline.Run(extractor="none"))
        raise AssertionError
    except ValueError:
        pass


def test_pipeline_on_its_own_topics_and_records(spark):
    cells = lambda *c: "<tr>%s</tr>" % "".join(f"<td>{x}</td>" for x in c)
    tables = [{"html": "<table>%s%s</table>" % (cells("Parameter", "Name"), cells("C00.01", "Speed"))}]
    same = "<h2>Troubleshooting the drive</h2><p>Alarm and fault handling of C00.01 and of the drive in general.</p>"
    pages_ = [("m", "d", i, i, i, same if i % 2 == 0 else "<p>x</p>", json.dumps(tables) if i == 1 else None) for i in range(5)]
    parsed = spark.createDataFrame(pages_, "manual_id string, device_id string, idx int, page_id long, page int, html string, children string")
    images = spark.createDataFrame([], "manual_id string, filename string")

    def twice(sections):  # each section as two of one group and heading
        again = sections.withColumn("sec_no", F.col("sec_no") + 1000)
        return sections.unionByName(again).withColumns({"content_type": F.lit("narrative_knowledge"), "suggested_group": F.lit("c00"), "suggested_knowledge_topic": F.lit("c00/drive")})

    out = pipeline.run(parsed, None, None, images, pipeline.Run(hooks={"sections": twice}))
    topics = out["topics"].collect()
    assert len(topics) > 1 and len({r.rel_path for r in topics}) == len(topics)
    assert {r.path for r in out["index"].collect()} == {r.rel_path for r in topics}
    assert [(r.manual_id, r.by, f"{r.ref}.md" in {t.rel_path for t in topics}) for r in out["linked"].collect()] == [("m", "id", True)]
    assert {(r.rule, r.subject) for r in out["findings"].collect()} == {("few_parameters", "1")}
    given = spark.createDataFrame([(i, "m", f"C0{i}.01", f"C0{i}", "bitfield", None, None, None, None, None) for i in range(2)], "reg_id long, manual_id string, param_id string, group_id string, data_type string, value_range string, value_map map<string,string>, bit_layout map<string,string>, knowledge_ref string, modbus struct<address:int>")
    found = {(r.rule, r.subject) for r in pipeline.run(parsed, None, given, images)["findings"].collect()}
    assert {("index_total", "1"), ("unknown_group", "C01.01:1"), ("bitfield_without_layout", "C00.01:0"), ("bitfield_without_layout", "C01.01:1")} <= found
    assert ("unknown_group", "C00.01:0") not in found  # group codes differ in case


def test_streams(spark, small, read, tmp_path):
    folder = tmp_path / "in"
    read("parsed").write.parquet(str(folder))
    read("parsed").write.mode("append").parquet(str(folder))  # every page delivered twice
    source = lambda: streaming.once(streaming.arriving_pages(spark, str(folder), read("parsed").schema).filter("loaded_at is not null"))
    for name, stream in (("flat", streaming.flattened(source())), ("kinds", streaming.kinds_per_day(streaming.arriving_pages(spark, str(folder), read("parsed").schema)))):
        q = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    from pagelattice.operators import nested

    assert spark.table("flat").count() == nested.flatten_records(read("parsed").filter("loaded_at is not null"), ["page_id"]).count()
    assert spark.table("kinds").count() > 0


def test_kept_tables_are_forgotten(spark):
    from pagelattice.sources import tables

    tables.forget(spark)
    kept = [tables.kept(spark.range(n)) for n in (2, 3)]
    assert [k.count() for k in kept] == [2, 3] and tables.forget(spark) == 2 and tables.forget(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FAILED_READ_FILE|FILE_NOT_EXIST"):
        kept[0].withColumn("x", F.lit(1)).collect()


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace as N

    from pagelattice.sources import tables

    conf = N(get=lambda *a: None)
    far = N(sparkContext=N(master="spark://host:7077", getConf=lambda: conf), conf=conf)
    with pytest.raises(RuntimeError, match="checkpoint"):
        tables.shared_dir(far)
