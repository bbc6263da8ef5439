import random

import pytest

from pagelattice.llm import scans as S

PARSED = "page_id long, device_id string, idx int, page int, html string, kind string, word string"
SECTION = "section_id long, device_id string, excerpt string, line_no int"
WORDS = "the motor cable controller position threshold stable display message supply voltage change before remove protective cover value of is on low-pass built-in filter operation restart".split()


def prose(rng, n):
    return [" ".join(rng.choice(WORDS) for _ in range(8)) for _ in range(n)]


def corpus(spark, extra_pages=(), extra_excerpts=(), n=60):
    rng = random.Random(3)
    rows = [(i, "d", i, i, "<p>ACME guide X-1 | %d</p>\n<p>%s</p>\nLegal notice about everything here" % (i + 1, "\n".join(prose(rng, 6))), "k", "w") for i in range(n)]
    rows += [(1000 + i, "d", 5, 4, t, "k", "w") for i, t in enumerate(extra_pages)]
    parsed = spark.createDataFrame(rows, PARSED)
    sections = spark.createDataFrame([(i, "d", t, 1) for i, t in enumerate(extra_excerpts)], SECTION)
    return parsed, sections


def test_cases(spark):
    page = "<p>ACME gu1de X-1 5</p>\n- 5 -\n<h2>Thc motor cahle</h2>\n<p>Befor\u00ac\ne you rernove the c0ntroller, sfable low-\npass f!lter and the thresh-\n[8]\nold is on</p>\nLegal n0tice about everything here\n<p>C00.01 vo\xad <br/>\nltage Supply</p>"
    parsed, sections = corpus(spark, [page, None, "", "<p></p>"], ["If the dis\u2010\nplay\n[8]\nis stαble on", None, ""])
    got = {(r.src_table, r.row_id, r.line_no, r.kind, r.word) for r in S.repaired(parsed, sections).collect()}
    mine = {x[2:] for x in got if x[:2] == ("parsed", 1000)}
    assert mine == {(1, "header", "-"), (2, "header", "-"), (4, "hyphen", "before"), (5, "char", "remove"), (5, "char", "controller"), (5, "char", "stable"), (5, "hyphen", "low-pass"), (6, "char", "filter"), (6, "hyphen", "threshold"), (7, "header", "-"), (10, "hyphen", "voltage")}
    assert {x[2:] for x in got if x[0] == "sections"} == {(1, "hyphen", "display"), (3, "header", "-"), (4, "char", "stable")}
    assert {x[2:] for x in got if x[0] == "parsed" and x[1] < 1000} == {(1, "header", "-")}
    assert not [x for x in got if x[1] in (1001, 1002, 1003)]
    texts = {(r.src_table, r.row_id): r.paragraphs for r in S.repaired(parsed, sections, texts=True).collect()}
    assert texts["parsed", 1000] == ["Thc motor cahle", "Before you remove the controller, stable low-pass filter and the threshold is on", "C00.01 voltage Supply"]
    assert texts["sections", 0] == ["If the display is stable on"]


def test_slices_of_the_lexicon_find_the_same(spark, monkeypatch):
    parsed, sections = corpus(spark, ["<p>sfable thresh-\nold and c0ntroller f!lter\nlow-\npass rernove</p>"])
    want = sorted(tuple(r) for r in S.repaired(parsed, sections).collect())
    monkeypatch.setattr(S, "LEXICON", 5)
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    assert sorted(tuple(r) for r in S.repaired(parsed, sections).collect()) == want


def test_a_large_lexicon_gives_the_same_cases_and_texts(spark, monkeypatch):
    rng = random.Random(9)
    spoilt = [" ".join(w.replace("o", "0", 1) if rng.random() < 0.1 else w.replace("t", "f", 1) if rng.random() < 0.1 else w for w in line.split()) for line in prose(rng, 120)]
    pages = ["<p>" + "\n".join(spoilt[i : i + 6]) + "\nthresh-</p>\n\nold of" for i in range(0, 120, 6)]
    parsed, sections = corpus(spark, pages, ["low-\npass sfable filter"], n=200)
    run = lambda: [sorted((tuple(r) for r in S.repaired(parsed, sections, texts=t).collect()), key=repr) for t in (False, True)]
    want = run()
    monkeypatch.setattr(S, "LEXICON", 5)
    assert run() == want and len(want[0]) > 100 and len(want[1]) == 221


def test_empty_tables(spark):
    parsed, sections = corpus(spark, n=0)
    assert S.repaired(parsed, sections).count() == 0


def test_held_out_noise(spark):
    """Words spoilt at random in a clean corpus are read as they were."""
    rng = random.Random(5)
    reverse = [(to, x) for x, tos in S.CONFUSIONS.items() for to in tos if x not in ("|", "3", "4", "7", "8")]
    pages, want = [], set()
    for i in range(60):
        lines = [line.split() for line in prose(rng, 6)]
        for no in range(6):
            k = rng.randrange(8)
            options = [(to, x) for to, x in reverse if to in lines[no][k]]
            if options and rng.random() < 0.4:
                to, x = rng.choice(options)
                want.add((1000 + i, no + 1, "char", lines[no][k]))
                lines[no][k] = lines[no][k].replace(to, x, 1)
        pages.append("<p>" + "\n".join(map(" ".join, lines)) + "</p>")
    parsed, sections = corpus(spark, pages, n=200)
    got = {tuple(r)[1:] for r in S.repaired(parsed, sections).collect() if r.row_id >= 1000}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)


@pytest.mark.parametrize("a,b,near", [("abc", "abc", True), ("abcd", "abd", True), ("abcdef", "axcdxf", True), ("abcdef", "bcdefa", True), ("abcdef", "xbcxex", False), ("abc", "abcxyz", False)])
def test_close(a, b, near):
    assert S.close(a, b, 2) is near


def test_both_sides_of_a_confusion_have_one_skeleton():
    for read, printed in S.CONFUSIONS.items():
        for to in printed:
            assert read.translate(S._SKELETON) == to.translate(S._SKELETON)


@pytest.mark.parametrize("x,v,used", [("c0nfro11er", "controller", 4), ("rnotor", "motor", 1), ("fhe", "the", 1), ("ﬁll", "fill", 1), ("motor", "motor", 0), ("liigli", "high", 2), ("moter", "motor", None), ("7e57", "test", 3)])
def test_confusions_between(x, v, used):
    got = S.confusions_between(x, v)
    assert (None if got is None else len(got)) == used


WORDS_ = [("cast", "cast", 40, 0, 0.0, True), ("east", "east", 5000, 0, 0.0, True), ("cast", "east", 5000, 1, -6.2, True), ("iron", "iron", 300, 0, 0.0, True), ("the", "the", 9000, 0, 0.0, True)]


def test_viterbi_uses_the_neighbours():
    r = S.Repairer(WORDS_, {"the east": 900, "iron cast": 30}, 20000.0)
    assert r.line(["the", "cast"]) == ["the", "east"] and r.line(["iron"]) == ["iron"]
    assert r.line(["iron", "cast"]) == ["iron", "cast"]  # its pair is far more frequent than misreadings of 'iron east' could be
    assert r.joined("ea", "st", "the", "") == "east" and r.joined("ir", "on", "", "") == "iron"
    assert S.Repairer(WORDS_, {"iron cast": 30}, 20000.0, 0.0).line(["iron", "cast"]) == ["iron", "east"]


def test_viterbi_is_the_best_of_all_paths():
    import itertools
    import math

    words = "ab ac ba bc ca".split()
    rng = random.Random(1)
    pairs = {f"{a} {b}": rng.randint(0, 40) for a in words for b in words}
    r = S.Repairer([], pairs, 500.0)
    for _ in range(30):
        choices = [tuple((w, float(rng.randint(1, 60)), -rng.random() * 6, 0.0, True) for w in rng.sample(words, rng.randint(1, 4))) for _ in range(4)]

        def score(path):
            s = 0.0
            for i, o in enumerate(path):
                follow = min(pairs[f"{path[i - 1][0]} {o[0]}"] / max(path[i - 1][1], 1.0), 1.0) if i else 0.0
                s += o[2] + math.log(S.PAIRS * follow + (1 - S.PAIRS) * o[1] / 500.0 + 1e-300)
            return s

        assert r.lattice(choices) == [o[0] for o in max(itertools.product(*choices), key=score)]


def test_pairs_decide_planted_words(spark):
    """'tan' and 'fan' are both words; a 'tan' misread as 'fan' is told by its neighbours alone."""
    rng = random.Random(6)
    right = ["the cooling fan of the motor", "measure arc tan position"]
    noisy = lambda line: " ".join(w.replace("t", "f", 1) if "t" in w and rng.random() < 0.015 else w for w in line.split())
    pages = ["<p>" + "\n".join([right[rng.random() < 0.85] for _ in range(6)] + list(map(noisy, prose(rng, 6)))) + "</p>" for _ in range(150)]
    pages[7] = "<p>remove\nmeasure arc fan position</p>"
    parsed, sections = corpus(spark, pages)
    run = lambda weight: {tuple(r)[2:] for r in S.repaired(parsed, sections, weight=weight).collect() if r.row_id == 1007}
    noise = run(0.0)
    assert (2, "char", "tan") not in noise and run(S.PAIRS) - noise == {(2, "char", "tan")}


def test_hyphens_are_joined_by_neighbours():
    words = [("form", "form", 300, 0, 0.0, True), ("re-form", "re-form", 60, 0, 0.0, True), ("reform", "reform", 80, 0, 0.0, True), ("law", "law", 50, 0, 0.0, True)]
    assert S.Repairer(words, {}, 5000.0).joined("re", "form", "law", "") == "reform"
    assert S.Repairer(words, {"law re-form": 20}, 5000.0).joined("re", "form", "law", "") == "re-form"


def test_long_lines_and_null_devices(spark):
    notice = "This long legal notice about everything is part of the manual and remains so " * 6
    rows = [(i, None if i % 2 else "", i, i, f"<p>text of page</p>\n{notice if i > 1 else notice.replace('legal', 'lcgal')}", "k", "w") for i in range(12)]
    got = S.repaired(spark.createDataFrame(rows, PARSED), spark.createDataFrame([], SECTION))
    assert got.filter("line_no = 2").count() == 0
