import re
from collections import defaultdict

import pytest

from pagelattice.llm import standing as S

ROW = "page_id long, device_id string, html string, wording string, h long"


def found(spark, rows, **kw):
    df = spark.createDataFrame([(i, d, t, "clash", 0) for i, (d, t) in enumerate(rows)], ROW)
    lines = S.lines_of(df, "device_id", "page_id", "html", "parsed")
    n = df.selectExpr("'parsed' as src_table", "coalesce('=' || device_id, '') as source").groupBy("src_table", "source").count().withColumnRenamed("count", "n")
    return {(r.row_id, r.line_no) for r in S.standing_lines(lines, n, **kw).collect()}


NOTE = "Warranty is void if the seal of the TA-000013B is broken"


def test_wording_and_page_numbers():
    w = lambda t: S.wording(S.visible(t))
    assert w("<p>&copy; Copyright 2023 Zä (C) ﬁne.</p>") == w("copyright 2020 zä fine") == "copyrightzäfine"
    for t in ("Page 3 of 20", "- 2 -", "[8]", "5/16", "PAGE 12", "p. 3", "l4", "2O", "Seite 4 von 9"):
        assert S.is_page_number(t, S.wording(t)), t
    for t in ("Example:", "Part 2", "Not used.", "Repeat."):
        assert not S.is_page_number(t, S.wording(t)), t


def test_threshold_variants_and_repeats(spark):
    rows = [("d", f"body {i * 7} alpha{chr(97 + i)}\n<p>{NOTE}</p>" if i < 3 else f"text number {chr(97 + i) * 5}") for i in range(25)]
    rows[1] = ("d", f"x\n{NOTE.replace('seal', 's1al').upper()}")  # a misread letter, other case
    rows[2] = ("d", f"{NOTE.replace('broken', 'brolen')} 7\n{NOTE}\n{NOTE}")  # counts once for the row
    got = found(spark, rows)
    assert got == {(0, 2), (1, 2), (2, 1), (2, 2), (2, 3)}
    assert found(spark, rows[:3] + rows[3:] * 2) == set()  # 3 of 47 rows are less than a tenth


def test_sources_nulls_and_empty(spark):
    rows = [(None, NOTE)] * 3 + [("", NOTE)] * 2 + [("a", NOTE)] * 2 + [("b", None), ("b", ""), ("b", "1\n\n2")] * 2 + [("c", "Page 1")] * 5
    assert found(spark, rows) == {(0, 1), (1, 1), (2, 1)}
    assert found(spark, [("a", "x" * 3_000_000 + " end")] * 3) == {(0, 1), (1, 1), (2, 1)}
    empty = spark.createDataFrame([], ROW)
    n = spark.createDataFrame([], "src_table string, source string, n long")
    assert S.standing_lines(S.lines_of(empty, "device_id", "page_id", "html", "parsed"), n).count() == 0


@pytest.mark.parametrize("limit", [0, 100_000])
def test_against_brute_force(spark, read, monkeypatch, limit):
    monkeypatch.setattr(S, "BROADCAST_SEEDS", limit)
    monkeypatch.setattr(S, "BROADCAST_BYTES", limit * 80)  # 0: the way with a filter and a shuffle
    parsed, sections = read("parsed"), read("sections")
    got = {tuple(r) for r in S.manual_standing_lines(parsed, sections).collect()}
    for name, rows in (("parsed", parsed.select("device_id", "page_id", "html").collect()), ("sections", sections.select("device_id", "section_id", "section_heading").collect())):
        total, docs, where = defaultdict(int), defaultdict(set), defaultdict(set)
        for device, row, text in rows:
            total[device] += 1
            for no, line in enumerate((text or "").split("\n") if name == "parsed" else [text or ""], 1):
                w = re.sub(r"[^a-z]", "", re.sub(r"<[^>]*>|&#?\w+;|\(c\)", " ", line.lower().translate(str.maketrans(S._LOOKS))))
                if w and not S.is_page_number(S.visible(line), w):
                    docs[device, w].add(row)
                    where[device, w].add((name, row, no))
        need = {d: max(3, -(-n // 10)) for d, n in total.items()}
        plain = {x for (d, w), rs in docs.items() if len(rs) >= need[d] for x in where[d, w]}
        assert plain <= got
        extra = {x for x in got if x[0] == name} - plain
        near = {x for (d, w), xs in where.items() for (d2, v), rs in docs.items() if d == d2 and w != v and 2 * len(rs) >= need[d] and abs(len(w) - len(v)) <= 2 and len(set(zip(w, w[1:], w[2:])) ^ set(zip(v, v[1:], v[2:]))) <= 16 for x in xs}
        assert extra <= near


def test_texts_without_the_lines(spark, read):
    parsed = read("parsed")
    lines = S.manual_standing_lines(parsed, read("sections"))
    out = S.without_lines(parsed, "page_id", "html", lines, "parsed")
    assert out.count() == parsed.count()
    removed = lines.filter("src_table = 'parsed'").count()
    assert out.agg({"n_removed": "sum"}).first()[0] == removed
    n = lambda df: sum(r.html.count("\n") + 1 for r in df.collect() if r.html)
    assert n(parsed) - n(out) >= removed - out.filter("html = ''").count() > 0
