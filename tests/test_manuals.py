import json
import random
import re

import pytest
from pyspark.sql import functions as F

from pagelattice.functions import classify as C
from pagelattice.functions import registers as R
from pagelattice.functions import text as X
from pagelattice.operators import links, nested, pages, records


def ask(spark, make, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_ranges_and_numbers(spark):
    got = ask(spark, R.range_value, "0-20000", "1 to 31", "-9999-9999", "-2^31-(2^31-1)", "0-(2^32-1)", "1-(2^{32}-1)", "-", "", "0~5", None, "1.5-2")
    assert [tuple(x) if x else None for x in got] == [(0, 20000), (1, 31), (-9999, 9999), (-(2**31), 2**31 - 1), (0, 2**32 - 1), (1, 2**32 - 1), None, None, None, None, (1.5, 2)]
    assert ask(spark, R.number_value, "-", "12", "-3.5", "2^4-1", "2^99", "2^125", "x", None, " 7 ") == [None, 12, -3.5, 15, 2.0**99, None, None, None, 7]


def test_units_maps_and_bits(spark):
    got = ask(spark, R.unit_and_scale, "0.1Hz", "0.01ms", "0.1%", "ms", "-", "10", "0.1", None)
    assert [tuple(x) for x in got] == [("Hz", 0.1), ("ms", 0.01), ("%", 0.1), ("ms", None), (None, None), ("0", 1.0), (".1", 0.0), (None, None)]
    pairs = lambda x: [(e.k, e.v) for e in x] if x else None
    assert [pairs(x) for x in ask(spark, R.value_map, "0: Disable 1: Enable", "0: off: none 1: on", "00: a 0: b", "-", None)] == [[("0", "Disable"), ("1", "Enable")], [("1", "on")], [("0", "b")], None, None]
    assert [pairs(x) for x in ask(spark, R.bit_layout, "Bit00: a  bit 1 Bit01 : b c", "none")] == [[("0", "a bit 1"), ("1", "b c")], None]


def test_addresses_types_and_pages(spark):
    assert ask(spark, R.modbus_address, "C00.13", "F05.17") == [19, 0x0517]
    assert ask(spark, R.data_type, "U32", "", "ASCII", " i16 ") == ["uint32", "uint16", "string", "int16"]
    df = spark.createDataFrame([(0,), (5,), (None,)], "p int")
    assert [r.x for r in df.select(R.source_page(F.col("p")).alias("x")).collect()] == [1, 4, None]
    n = spark.createDataFrame([(500,), (501,), (150,), (151,), (800,), (801,), (250,), (251,)], "n int")
    assert [tuple(r) for r in n.select(R.confidence_of(F.col("n")), R.completeness_of(F.col("n"))).collect()][:4] == [("medium", "partial"), ("high", "partial"), ("low", "stub"), ("medium", "stub")]


def test_text(spark):
    assert ask(spark, X.clean_cell, "2<sup> 31 </sup>-1") == ["2^31-1"]
    assert ask(spark, X.heading_of, "<h2>AB</h2><h3>Main <b>part</b></h3>", "<p>One two. Three</p>", "", "<p>" + "word " * 40 + "</p>") == ["Main part", "One two", "Untitled section", " ".join(["word"] * 10)]
    assert ask(spark, X.slug, "A  B!", "!!", "Ä x") == ["a_b", "section", "x"]
    assert ask(spark, X.topic_slug, "x" * 59 + " yy") == ["x" * 59]
    assert ask(spark, X.group_path, "A b\\c//D", "", None) == ["a_b/c/d", "misc", "misc"]
    assert ask(spark, X.table_text, "<table><tr><th>a</th><th>long</th></tr><tr><td>xyz1</td></tr></table>", "<table><tr><td>a</td><td>b</td></tr></table>", "<table></table>") == ["a    | long\n---- | ----\nxyz1 |     ", "a | b", ""]
    assert ask(spark, X.html_text, "<h1>T</h1><p>para<br>one</p><li>x</li><img alt='n' src='y'>", "bare <b>text</b>") == ["## T\n\n\npara one\n\n- x", "bare text"]
    assert ask(spark, X.tidy_body, "a  b\na b\n\n\n\nc \nc") == ["a b\n\nc"]


def test_kinds_and_groups(spark):
    kind = lambda c: C.content_type(X.clean_spaced(c), c)
    texts = ["Table of Contents", "Intro ..... 5", "<table>C00.01</table>", "<table>error code</table>", "DANGER", "few words", " ".join(["word"] * 20), "generated " * 20]
    assert ask(spark, kind, *texts) == ["table_of_contents", "table_of_contents", "parameter_table", "fault_code_table", "safety_warning", "cover_page", "narrative_knowledge", "specifications"]
    assert ask(spark, C.group_of, "Speed loop", "spinning", "nothing", "default") == ["tuning/velocity", "wiring", None, "diagnostics"]


def merge_by_fold(rows):
    """Adjacent pages merged one after the other."""
    out = []
    for r in rows:
        p = out[-1] if out else None
        if p and p["k"] == r["k"] and r["n"] <= p["end"] + 1 and (p["g"] == r["g"] or r["k"] == "narrative_knowledge"):
            if r["g"] and r["g"] != p["g"]:
                p["g"], p["t"] = r["g"], r["t"]
            elif r["g"] and r["k"] == "narrative_knowledge" and p["g"] != r["g"]:
                p["t"] = r["t"]
            p["end"] = r["n"]
        else:
            out.append(dict(r, start=r["n"], end=r["n"]))
    return [(p["start"], p["end"], p["k"], p["g"]) for p in out]


def test_merge_is_the_fold(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for m in range(60):
        pages_ = [{"k": rng.choice(["narrative_knowledge", "x"]), "g": rng.choice(["a", "b", None]), "n": max(1, i + rng.choice([0, 0, 0, 1, -1])), "t": f"t{i}"} for i in range(rng.randint(0, 9))]
        want[str(m)] = merge_by_fold(pages_)
        rows += [(i, str(m), "D", i, p["n"], f"h{i}", p["k"], p["g"], "e", p["t"]) for i, p in enumerate(pages_)]
    df = spark.createDataFrame(rows, "page_id long, manual_id string, device_id string, idx int, page_num int, section_heading string, content_type string, suggested_group string, excerpt string, suggested_knowledge_topic string")
    got = {}
    for r in pages.merged_sections(df).orderBy("manual_id", "sec_no").collect():
        got.setdefault(r.manual_id, []).append((r.page_start, r.page_end, r.content_type, r.suggested_group))
    assert got == {m: w for m, w in want.items() if w}


def test_paths_become_unique(spark):
    df = spark.createDataFrame([(1, "m", 1, "a/x.md"), (2, "m", 2, "a/x_02.md"), (3, "m", 3, "a/x.md"), (4, "m", 4, "a/x.md"), (5, "n", 1, "a/x.md")], "section_id long, manual_id string, no int, rel_path string")
    assert [r.rel_path for r in pages.unique_paths(df).orderBy("section_id").collect()] == ["a/x.md", "a/x_02.md", "a/x_03.md", "a/x_04.md", "a/x.md"]


def record(pid, **kw):
    base = dict(id=pid, name=pid, brief="No description in manual.", data_type="uint16", access="read_write", low=None, high=None, default=None, low_text=None, high_text=None, default_text=None, unit=None, scale=None, value_map=None, bit_layout=None, write_condition=None, takes_effect=None, source_page=1, register_count=1, priority=1)
    return base | kw


def test_record_merge(spark):
    rows = [record("C00.01", unit="V", source_page=2, data_type="string"), record("C00.01", name="Real", priority=3, data_type="int32", register_count=2, source_page=9, brief="text"), record("C00.01", name="Late", priority=3, source_page=11, default=4.0, low=0.0, high=1.0), record("C00.01", bit_layout=[("0", "x")], data_type="bitfield", priority=1)]
    fields = [x.split()[0] for x in records.MERGED.replace("struct<k:string,v:string>", "s").split(", ")]
    df = spark.createDataFrame([("m", i, *(r[f] for f in fields)) for i, r in enumerate(rows)], "m string, seq int, " + records.MERGED)
    got = records.merge_records(df, ["m"], ["seq"]).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.name, r.brief, r.data_type, r.source_page, r.unit, r.default, r.low, r.high, r.register_count, r.priority) == ("Real", "text", "bitfield", 11, "V", 4.0, 0.0, 1.0, 1, 3)
    two = spark.createDataFrame([("m", *(record("C00.02", low=0.0, high=1.0, value_map=[("1", "On"), ("0", "Off")], data_type="uint16")[f] for f in fields))], "m string, " + records.MERGED)
    done = records.finished_records(two).first()
    assert (done.data_type, done.low, done.brief) == ("bool", None, "C00.02 States: 0=Off; 1=On.")


def test_mentions_keep_their_surroundings(spark):
    df = spark.createDataFrame([("m", 1, "x" * 200 + " C00.01 and c00.02 then C00.01 " + "y" * 200), ("m", 2, None), ("m", 3, "")], "m string, p int, t string")
    found = records.mentions(df, ["m", "p"], F.col("t")).collect()
    assert [(r.id, r.nth) for r in found] == [("C00.01", 0), ("C00.01", 1)]
    assert found[0].around.startswith("x" * 119) and len(found[0].around) <= 120 + 166
    assert records.first_mentions(records.mentions(df, ["m", "p"], F.col("t")), ["m"], ["p", "nth"]).count() == 1


def test_appended_lines_and_dominant(spark):
    have = spark.createDataFrame([("a", ["x"]), ("b", None)], "k string, lines array<string>")
    new = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], "k string, entry string")
    assert {r.k: r.lines for r in links.appended_lines(have, new, "k").collect()} == {"a": ["x", "y"], "b": [], "c": ["z"]}
    linked = spark.createDataFrame([(1, "m", "g", "long"), (2, "m", "g", "ab"), (3, "m", "g", "long"), (4, "m", "g", "ab"), (5, "m", "h", "q")], "reg_id long, manual_id string, group_id string, ref string")
    assert [(r.group_id, r.dominant) for r in links.dominant_refs(linked).collect()] == [("g", "ab")]


@pytest.mark.parametrize("name", ["parsed", "sections"])
def test_empty_tables(spark, read, name):
    df = read(name).limit(0)
    if name == "parsed":
        assert pages.merged_sections(pages.classified_pages(pages.page_views(df))).count() == 0
    else:
        assert pages.section_bodies(df, read("parsed")).count() == 0


def test_records_of_nodes_at_any_depth(spark):
    from pagelattice.plans import pipeline

    cells = lambda *c: "<tr>%s</tr>" % "".join(f"<td>{x}</td>" for x in c)
    markup = lambda *rows: "<table>%s%s</table>" % (cells("Parameter", "Name"), "".join(cells(*r) for r in rows))
    deep = [{"html": "<p>See C00.09 or C00.01</p>", "children": [{"page": 7, "children": [{"html": markup(("C00.01", "Deep"))}]}]}, {"html": markup(("C00.02", "Flat"))}, {"page": 9, "html": "<p>C00.09 again</p>"}]
    rows = [("m", 0, 1, None, None, json.dumps(deep)), ("m", 1, 2, 20, markup(("C00.03", "Own")), None)]
    df = spark.createDataFrame(rows, "manual_id string, idx int, page_id long, page int, html string, children string")
    assert [(r.page_id, r.node_seq, r.page) for r in pages.page_nodes(df).orderBy("page_id", "node_seq").collect()] == [(1, 0, None), (1, 1, None), (1, 2, 7), (1, 3, 7), (1, 4, None), (1, 5, 9), (2, 0, 20)]
    got = {r.id: (r.name, r.source_page, r.brief, r.priority) for r in pipeline.from_tables(pages.page_nodes(df)).collect()}
    assert got == {"C00.01": ("Deep", 6, "Deep", 1), "C00.02": ("Flat", None, "Flat", 1), "C00.03": ("Own", 19, "Own", 1), "C00.09": ("C00.09", 8, "See C00.09 or C00.01", 0)}


def test_every_id_of_parsed_is_extracted(spark, small, read):
    from pagelattice.plans import manual_queries

    want = set()
    for r in read("parsed").collect():
        work = [{"html": r.html, "children": nested.parse_json(r.children)[1]}]
        while work:
            node = work.pop()
            work += [x for v in (node.values() if isinstance(node, dict) else node) for x in [v] if isinstance(x, (dict, list))]
            text = node.get("html") if isinstance(node, dict) else None
            if not isinstance(text, str):
                continue
            if "<table" in text.lower():
                for t in re.findall(r"(?is)<table[^>]*>.*?</table>", text):
                    lines = [[re.sub(r"<[^>]+>", " ", c).strip() for c in re.findall(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>", x)] for x in re.findall(r"(?is)<tr[^>]*>(.*?)</tr>", t)]
                    lines = [x for x in lines if x] or [[]]
                    at = [next((i for i, h in enumerate(lines[0]) if k in h.lower()), None) for k in ("parameter", "name")]
                    want |= {(r.manual_id, x[at[0]].upper()) for x in lines[1:] if None not in at and len(x) > max(at) and re.fullmatch(r"[CFRU][0-9A-F]{2}\.[0-9A-F]{2}", x[at[0]].upper())}
            else:
                want |= {(r.manual_id, x) for x in re.findall(r"\b[CFRU][0-9A-F]{2}\.[0-9A-F]{2}\b", re.sub(r"<[^>]+>", " ", text))}
    got = [(r.manual_id, r.id) for r in manual_queries.u1_parsed_records(spark, small).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_limits_as_printed(spark):
    got = ask(spark, R.range_texts, "0.0-88.50", "007 to 1.5", "-0.10 - 0.1", "-2^31-(2^31-1)", "0-(2^62-1)", "-0-5", "0 .. 5", "-", None)
    assert [tuple(x) if x else None for x in got] == [("0.0", "88.5"), ("7", "1.5"), ("-0.1", "0.1"), ("-2147483648", "2147483647"), ("0", str(2**62 - 1)), ("0", "5"), None, None, None]


def test_briefs_of_all_registers(spark, small, read):
    from pagelattice.plans import manual_queries

    def limit(t):
        t = t.strip("()")
        if "^" in t:
            n = re.fullmatch(r"(-?)2\^(\d+)(-1)?", t)
            return str((-1 if n[1] else 1) * 2 ** int(n[2]) - (1 if n[3] else 0))
        return str(float(t) if "." in t else int(t))

    want = {}
    for r in read("device_registers").collect():
        if (r.brief or "").strip().lower() not in ("", "no description in manual."):
            continue
        v = re.sub(r"\^\{(\d+)\}", r"^\1", r.value_range or "")
        m = re.fullmatch(r"(?i)\s*(-?\d+(?:\.\d+)?)\s*(?:to|-)\s*(-?\d+(?:\.\d+)?)\s*", v)
        m = m or re.fullmatch(r"(\d+)-(\(2\^\d+(?:-1)?\))", v.replace(" ", "")) or re.fullmatch(r"\(?(-?2\^\d+)\)?-(\(?-?2\^\d+(?:-1)?\)?)", v.replace(" ", ""))
        parts = [r.param_name, f"Range {limit(m[1])} to {limit(m[2])}." if m else None]
        parts += [f"{k} {x}." if x is not None else None for k, x in (("Default", r.default_value), ("Unit", r.unit or None), ("Write condition", r.write_condition), ("Takes effect", r.takes_effect))]
        want[r.reg_id] = " ".join(x for x in parts if x is not None)
    got = {r.reg_id: r.brief for r in manual_queries.f28_briefs(spark, small).collect()}
    assert got == want and any(re.search(r"Range -?\d+\.\d", x) for x in got.values())


def test_states_of_all_maps(spark, small, read):
    from pagelattice.plans import manual_queries

    want = {}
    for r in read("device_registers").collect():
        if not r.value_map:
            continue
        text = " ".join(f"{k}: {v or ''}" for k, v in r.value_map.items()).strip()
        last = {}
        for k, v in re.findall(r"(-?\d+)\s*:\s*([^:]+?)(?=(?:\s+-?\d+\s*:)|$)", text):
            last[str(int(k))] = re.sub(r"\s+", " ", v).strip()
        want[r.reg_id] = sorted(f"{k}={v}" for k, v in last.items())
    got = {r.reg_id: sorted(r.states) for r in manual_queries.f33_states(spark, small).collect()}
    assert got == want and len(got) > 20
