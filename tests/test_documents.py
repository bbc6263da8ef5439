"""Documents, their files, checks of documents as loaded, and plugged-in conversion."""

import html
import json

import pytest
from pyspark.sql import functions as F

from pagelattice.functions import registers as R
from pagelattice.functions import text as X
from pagelattice.operators import documents, links, nested, records
from pagelattice.sources import conversion, files


def values(spark, texts, *columns):
    return [tuple(r) for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(*columns).collect()]


def test_entities_as_html_means_them(spark):
    texts = ["&lt;b&gt; &amp;lt; &Omega;&plusmn;5 &#8486; &#x3A9; &copy 2020", "&#150; &#0; &#xD800; &nosuch; & plain", "&eacute;&Eacute;&frac12;&hellip;", "no entity", "", None, "&amp;&amp;amp;", "&#39;&#039;&apos;&quot;"]
    got = values(spark, texts, X.unescaped(F.col("t")).alias("x"))
    assert [x[0] for x in got] == [t if t is None else html.unescape(t) for t in texts]


def test_numbers_are_exact(spark):
    texts = ["2^62-1", "-2^62", "2^99", "9007199254740993", "-2^31-1", "007", "1.50", "2^125", "x", "", None, "-"]
    got = values(spark, texts, R.exact_integer(F.col("t")).cast("string").alias("n"), R.number_text(F.col("t")).alias("s"))
    assert [x[0] for x in got[:5]] == [str(2**62 - 1), str(-(2**62)), str(2**99), "9007199254740993", str(-(2**31) - 1)]
    assert [x[1] for x in got] == [str(2**62 - 1), str(-(2**62)), str(2**99), "9007199254740993", str(-(2**31) - 1), "7", "1.5", None, None, None, None, None]


@pytest.mark.parametrize("text,want", [("0: Disable 1: Enable", {"0": "Disable", "1": "Enable"}), ("0: off: none 1: on", {"1": "on"}), ("-1: low 2 bar 5: 3 phase", {"-1": "low 2 bar", "5": "3 phase"}), ("01: a 1: b", {"1": "b"}), ("-", None), ("text", None)])
def test_value_maps_with_digits_and_colons(spark, text, want):
    got = values(spark, [text], R.value_map(F.col("t")).alias("m"))[0][0]
    assert (None if got is None else {e["k"]: e["v"] for e in got}) == want


def test_finished_briefs_print_numbers_as_the_manual_does(spark):
    raw = spark.createDataFrame([(1, 0, 0, 2, "C00.01", "Gain", "0-(2^32-1)", "1.50", "0.1Hz", "-", "u32", "at stop", "-"), (1, 0, 1, 2, "C00.02", "Mode", "0-1", "0", "-", "0: Off 1: On", "", "", "")], "m int, table_no int, row_no int, priority int, id string, name_text string, range_text string, default_text string, unit_text string, options_text string, dtype_text string, mode_text string, effect_text string")
    done = {r.id: r for r in records.finished_records(records.merge_records(records.typed_records(raw, ["m"], F.lit(4)), ["m"], ["table_no", "row_no"])).collect()}
    assert done["C00.01"].brief == "Gain Range 0 to 4294967295. Default 1.5. Unit Hz. Write condition stopped."
    assert done["C00.02"].data_type == "bool" and done["C00.02"].brief == "0: Off 1: On"


def test_each_mention_shows_its_own_place(spark):
    text = "C00.01 first" + " x" * 200 + " then C00.01 second"
    got = [r.around for r in records.mentions(spark.createDataFrame([(1, text), (2, None), (3, "")], "m int, t string"), ["m"], F.col("t")).orderBy("nth").collect()]
    assert got == [text[0:166].strip(), text[text.rindex("C00") - 120 :].strip()]


def test_documents_go_through_yaml(spark, read, tmp_path):
    from pagelattice.plans import document_queries as D

    small = "/root/testdata/sf0.001"
    docs = documents.register_documents(D._first_records(spark, small), read("manuals"), read("devices"), D._labels(spark, small))
    out = documents.as_files(docs, F.concat("manual_id", F.lit("/device_registers.yaml")))
    n = docs.count()
    assert n and files.write_files(files.as_yaml(out), str(tmp_path)) == n
    first = sorted(tmp_path.glob("*/device_registers.yaml"))[0].read_text()
    assert first.startswith("schema_version: '1.0'\nextraction_metadata:\n") and "{" not in first.splitlines()[0]
    (tmp_path / "bad.yaml").write_text("- 1\n")
    (tmp_path / "worse.yaml").write_text("a: [")
    back = files.read_yaml(spark, str(tmp_path))
    assert back.count() == n + 2 and back.filter("doc is null").count() == 2
    listed = files.listed_parameters(back)
    want = docs.select(F.explode("doc.parameters").alias("p")).count()
    assert listed.count() == want and listed.filter("id is null").count() == 0
    assert links.document_findings(back).count() == 2
    index = documents.index_documents(read("device_registers"), read("knowledge"), read("manuals"), read("devices"))
    loaded = json.loads(documents.as_files(index, F.col("manual_id")).first().content)
    assert loaded["schema_version"] == "1.0" and isinstance(loaded["uncovered_groups"], list) and loaded["extraction_metadata"]["extraction_date"].count("-") == 2


def test_sections_files_round_trip(spark, read, tmp_path):
    sections = read("sections")
    docs = documents.section_documents(sections)
    assert files.write_files(documents.as_files(docs, F.concat("manual_id", F.lit("/sections.json"))), str(tmp_path)) == docs.count()
    assert files.read_sections(spark, str(tmp_path / "*/sections.json")).count() == sections.count()


def test_topic_mappings_and_root(spark, tmp_path):
    (tmp_path / "k/b").mkdir(parents=True)
    (tmp_path / ".git").mkdir()
    (tmp_path / "k/b/x.md").write_text("---\ntitle: é\nsee_also: [a]\n---\n\nBody")
    (tmp_path / "k/b_c.md").write_text("no front")
    got = [(r.rel_path, json.loads(r.front)) for r in files.topic_mappings(spark, str(tmp_path / "k")).collect()]
    assert got == [("b/x.md", {"title": "é", "see_also": ["a"]}), ("b_c.md", {})]
    assert files.topic_mappings(spark, str(tmp_path / "none")).count() == 0
    assert files.repository_root(str(tmp_path / "k/b")) == str(tmp_path) and files.repository_root("/") is None


def test_images_are_copied_with_their_bytes(spark, tmp_path):
    (tmp_path / "from").mkdir()
    (tmp_path / "to").mkdir()
    for name in "abc":
        (tmp_path / "from" / f"{name}.png").write_bytes(name.encode() * 3)
    (tmp_path / "to/b.png").write_bytes(b"old")
    refs = spark.createDataFrame([(x,) for x in ("a.png", "b.png", "a.png", "z.png", None)], "filename string")
    assert files.copied_images(spark, refs, str(tmp_path / "from"), str(tmp_path / "to")) == 1
    assert (tmp_path / "to/a.png").read_bytes() == b"aaa" and (tmp_path / "to/b.png").read_bytes() == b"old" and not (tmp_path / "to/c.png").exists()


def test_markdown_keeps_replacement_characters_of_valid_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("x�y")
    assert [r.line for r in files.read_markdown_lines(spark, str(tmp_path)).collect()] == ["x�y"]


def test_conversion_is_plugged_in(spark, tmp_path, monkeypatch):
    for name, size in (("good", 9), ("poor", 2), ("worse", 1), ("none", 5)):
        (tmp_path / f"{name}.pdf").write_bytes(b"x" * size)

    def convert(content, options):
        ocr = bool(options["additional_config"])
        score = {9: 4.0, 2: 2.5 if ocr else 2.0, 1: 0.5 if ocr else 1.0, 5: None}[len(content)]
        return {"markdown": f"ocr {ocr}", "json": {"children": []}, "score": score, "images": {"a": "eA=="}}

    got = {r.path.rsplit("/", 1)[1]: r for r in conversion.converted(conversion.pdf_files(spark, str(tmp_path)), convert, conversion.convert_options()).collect()}
    assert {k: (r.forced, r.score) for k, r in got.items()} == {"good.pdf": (False, 4.0), "poor.pdf": (True, 2.5), "worse.pdf": (False, 1.0), "none.pdf": (False, None)}
    assert got["poor.pdf"].markdown == "ocr True" and json.loads(got["good.pdf"].tree) == {"children": []} and got["good.pdf"].images == {"a": "eA=="}
    monkeypatch.delenv("NO_SUCH_KEY", raising=False)
    with pytest.raises(RuntimeError, match="NO_SUCH_KEY"):
        conversion.required_key("NO_SUCH_KEY")


def test_prerequisites_and_layouts(spark):
    know = spark.createDataFrame([(1, "m", "a/b.md", ["a/b", "x"], [" a\\b", "y"])], "know_id int, manual_id string, rel_path string, prerequisites array<string>, see_also array<string>")
    assert links.pruned_refs(know, "prerequisites").first() == (1, ["a/b"], 1) and links.pruned_refs(know).first() == (1, ["a/b"], 1)
    assert links.refine_targets(know, force=True).count() == 1


def test_every_key_is_walked(spark):
    tree = '[{"html": "a", "extra": {"page": 3, "html": "b", "list": [{"html": "c"}]}, "children": [{"html": "d"}]}]'
    df = spark.createDataFrame([(1, tree, 0)], "k int, children string, page int")
    rows = [(r.node_seq, r.parent_seq, r.eff_page, r.html) for r in nested.block_table(df, ["k"], any_key=True).orderBy("node_seq").collect()]
    assert rows == [(1, 0, 0, "a"), (2, 1, 3, "b"), (3, 2, 3, "c"), (4, 1, 0, "d")]


def test_counts_below_without_pairs(spark, read):
    blocks = nested.block_table(read("parsed"), ["page_id"])
    is_table = F.coalesce(F.col("block_type") == "Table", F.lit(False))
    got = {(r.page_id, r.node_seq): r.n for r in nested.counted_below(blocks, ["page_id"], is_table).collect()}
    pairs = nested.contained_pairs(blocks, blocks.filter(is_table).select("page_id", "node_seq", "post"), ["page_id"]).groupBy("page_id", "anc_seq").count().collect()
    assert {k: n for k, n in got.items() if n} == {(r.page_id, r.anc_seq): r["count"] for r in pairs} and len(got) == blocks.count()
