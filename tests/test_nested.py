import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagelattice.operators import nested

VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text("ab", max_size=3),
    lambda inner: st.lists(inner, max_size=4) | st.fixed_dictionaries({}, optional={"children": inner, "page": st.none() | st.integers(0, 9) | st.text("1", max_size=1), "images": inner, "x": inner}),
    max_leaves=25,
)


def brute(value, root):
    """The rows of a record by plain recursion."""
    rows, n = [("node", 0, -1, root)], 0

    def walk(v, parent, eff):
        nonlocal n
        if isinstance(v, list):
            for x in v:
                walk(x, parent, eff)
        elif isinstance(v, dict):
            n += 1
            own = n
            p = v.get("page")
            eff = p if isinstance(p, int) and not isinstance(p, bool) else eff
            rows.append(("node", own, parent, eff))
            images = v.get("images")
            found = [x for x in (images if isinstance(images, list) else [images]) if isinstance(x, dict)]
            rows.extend(("image", i, own, eff) for i, _ in enumerate(found, 1))
            walk(v.get("children"), own, eff)

    walk(value, 0, root)
    return sorted(rows)


@settings(max_examples=200, deadline=None)
@given(VALUES)
def test_labels_contain_as_recursion_nests(value):
    nodes, post = nested.interval_labels(value)
    parents, depths = nested.containing(post)
    want = [r for r in brute(value, 0) if r[0] == "node" and r[1] > 0]
    assert [(i + 1, p) for i, p in enumerate(parents)] == [(r[1], r[2]) for r in want]
    for i, p in enumerate(post):  # descendants from the labels alone
        inside = sum(1 for j, q in enumerate(post) if j > i and q < p)
        assert inside == p - (i + 1) + depths[i] - 1


@settings(max_examples=150, deadline=None)
@given(VALUES)
def test_deep_parser_reads_what_json_reads(value):
    text = json.dumps(value, ensure_ascii=False, indent=1)
    assert nested._parse_deep(text) == value
    for cut in {1, len(text) // 2, len(text) - 1}:
        whole = text[:cut]
        try:
            want = json.loads(whole)
        except ValueError:
            with pytest.raises(ValueError):
                nested._parse_deep(whole)
        else:
            assert nested._parse_deep(whole) == want


def rows_of(spark, *records, **kw):
    df = spark.createDataFrame([(i, p, c, "x") for i, (p, c) in enumerate(records)], "page_id long, page int, children string, html string")
    return nested.flatten_records(df, ["page_id"], **kw)


def test_odd_records(spark):
    deep = '{"children":' * 5000 + "{}" + "}" * 5000
    records = [(None, None), (3, ""), (3, "[1, {"), (3, "NaN"), (3, "[] []"), (4, '{"page": "7"}'), (4, '[[{"page": 2.0}, [{"page": true}]], 5, null]'), (0, deep), (1, '{"images": {"src": 5, "alt": "\\ud800"}, "children": "no"}'), (1, '{"page": 99999999999}')]
    got = sorted((r.page_id, r.kind, r.item_seq, r.parent_seq, r.eff_page) for r in rows_of(spark, *records).collect())
    by = {i: [r[1:] for r in got if r[0] == i] for i in range(len(records))}
    assert by[0] == [("node", 0, -1, -1)]
    assert all(by[i] == [("node", 0, -1, 3)] for i in (1, 2, 3, 4))
    assert by[5] == [("node", 0, -1, 4), ("node", 1, 0, 4)]
    assert by[6] == [("node", 0, -1, 4), ("node", 1, 0, 4), ("node", 2, 0, 4)]
    assert len(by[7]) == 5002 and by[7][-1] == ("node", 5001, 5000, 0)
    assert by[8] == [("image", 1, 1, 1), ("node", 0, -1, 1), ("node", 1, 0, 1)]
    assert by[9][-1] == ("node", 1, 0, 1)


def test_clashing_names_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, '[{"images": [{}, 3, {"src": "a"}]}]', "k", 7)], "page_id long, page int, children string, kind string, item_seq int")
    assert nested.flatten_records(df, ["page_id"]).count() == 4
    with pytest.raises(ValueError):
        nested.flatten_records(df, ["kind"])
    assert nested.flatten_records(df.limit(0), ["page_id"]).count() == 0
    assert nested.flatten_records(df.union(df), ["page_id"]).count() == 8


def test_tables_are_linked(spark, read):
    parsed = read("parsed")
    blocks = nested.block_table(parsed, ["page_id"]).cache()
    sizes = {(r.page_id, r.node_seq): r.n_descendants for r in nested.subtree_sizes(blocks, ["page_id"]).collect()}
    pairs = nested.contained_pairs(blocks, blocks.select("page_id", "node_seq", "post"), ["page_id"]).groupBy("page_id", "anc_seq").count().collect()
    assert {(r.page_id, r.anc_seq): r["count"] for r in pairs} == {k: n for k, n in sizes.items() if n}
    images = nested.image_table(parsed, ["page_id"])
    assert images.join(blocks, ["page_id", "node_seq"], "left_anti").count() == 0
    want = sum(len(brute(json.loads(r.children) if nested.parse_json(r.children)[0] else None, 0)) for r in parsed.collect())
    assert nested.flatten_records(parsed, ["page_id"]).count() == want
