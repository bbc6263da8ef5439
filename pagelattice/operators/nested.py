"""Deeply nested records as flat tables linked by interval labels.

One depth-first traversal gives every node of a record a pre-order and a post-order number. Node a is an
ancestor of node b exactly if pre(a) < pre(b) and post(a) > post(b): the tables below are linked by that
containment alone, so that any subtree question is a comparison of two numbers within a record and needs
neither recursion nor a second look at the JSON text. A record is labelled where it is read: no shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_NODE_FIELDS = (
    "kind string, item_seq int, pre int, post int, parent_seq int, depth int, eff_page int, "
    "block_type string, html string, src string, alt string"
)
_NUMBER = re.compile(r"-?(?:0|[1-9]\d*)(\.\d+)?([eE][-+]?\d+)?")
_BLANK = re.compile(r"[ \t\n\r]*")
_WORDS = {"true": True, "false": False, "null": None}


def _refuse(name: str):
    raise ValueError(f"{name} is not JSON")


_DECODER = json.JSONDecoder(parse_constant=_refuse)


def _parse_deep(text: str):
    """The value of a JSON text of any depth, without recursion. ValueError if it isn't valid."""
    open_values: list = []  # containers that are still open
    keys: list = []  # the pending key of each open object
    at, n = _BLANK.match(text, 0).end(), len(text)
    want = "value"  # what may come next: value, first (value or ]), key, firstkey (key or }), sep, end

    while True:
        at = _BLANK.match(text, at).end()
        if want == "end":
            if at != n:
                raise ValueError("more than one value")
            return result
        if at >= n:
            raise ValueError("cut off")
        ch = text[at]
        if want in ("key", "firstkey"):
            if ch == "}" and want == "firstkey":
                value, at = open_values.pop(), at + 1
                keys.pop()
            elif ch == '"':
                keys[-1], at = scanstring(text, at + 1, True)
                at = _BLANK.match(text, at).end()
                if text[at : at + 1] != ":":
                    raise ValueError("no colon")
                at, want = at + 1, "value"
                continue
            else:
                raise ValueError("no key")
        elif want == "sep":
            top = open_values[-1]
            if ch == ",":
                want, at = ("key" if isinstance(top, dict) else "value"), at + 1
                continue
            if ch != ("}" if isinstance(top, dict) else "]"):
                raise ValueError("no comma")
            value, at = open_values.pop(), at + 1
            if isinstance(value, dict):
                keys.pop()
        elif ch == "]" and want == "first":
            value, at = open_values.pop(), at + 1
        elif ch == "{":
            open_values.append({})
            keys.append(None)
            want, at = "firstkey", at + 1
            continue
        elif ch == "[":
            open_values.append([])
            want, at = "first", at + 1
            continue
        elif ch == '"':
            value, at = scanstring(text, at + 1, True)
        elif m := _NUMBER.match(text, at):
            value, at = float(m[0]) if m[1] or m[2] else int(m[0]), m.end()
        else:
            word = next((w for w in _WORDS if text.startswith(w, at)), None)
            if word is None:
                raise ValueError("no value")
            value, at = _WORDS[word], at + len(word)
        if not open_values:
            result, want = value, "end"
            continue
        top = open_values[-1]
        if isinstance(top, dict):
            top[keys[-1]] = value
        else:
            top.append(value)
        want = "sep"


def parse_json(text: str | None):
    """(True, value), or (False, None) if text is null or not valid JSON."""
    if text is None:
        return False, None
    try:
        return True, _DECODER.decode(text)
    except RecursionError:
        pass
    except ValueError:
        return False, None
    try:
        return True, _parse_deep(text)
    except ValueError:
        return False, None


def interval_labels(value, any_key: bool = False) -> tuple[list[dict], list[int]]:
    """The objects reached from value through lists and `children` (any_key: through every key), in pre-order, and the post-order number of each."""
    nodes: list[dict] = []
    post: list[int] = []
    done = 0
    work: list = [value] if type(value) in (dict, list) else []
    while work:
        x = work.pop()
        if type(x) is int:  # the subtree of node x is complete
            done += 1
            post[x] = done
        elif type(x) is list:
            work.extend(y for y in reversed(x) if type(y) in (dict, list))
        elif type(x) is dict:
            work.append(len(nodes))
            nodes.append(x)
            post.append(0)
            if any_key:
                work.extend(y for y in reversed(x.values()) if type(y) in (dict, list))
            elif type(x.get("children")) in (dict, list):
                work.append(x["children"])
    return nodes, post


def containing(post: list[int]) -> tuple[list[int], list[int]]:
    """For the intervals in pre-order: the 1-based number of the smallest one that contains each (0: none), and how many contain it."""
    parents: list[int] = []
    depths: list[int] = []
    open_: list[int] = []
    for i, p in enumerate(post):
        while open_ and post[open_[-1]] < p:
            open_.pop()
        parents.append(open_[-1] + 1 if open_ else 0)
        depths.append(len(open_) + 1)
        open_.append(i)
    return parents, depths


def _page_of(value, inherited: int) -> int:
    return value if type(value) is int and -(2**31) <= value < 2**31 else inherited


def _text(value) -> str | None:
    """A string that UTF-8 can hold; other JSON values as JSON text."""
    if value is None:
        return None
    if not isinstance(value, str):
        try:
            value = json.dumps(value, ensure_ascii=False)
        except RecursionError:
            return None
    return value if value.isascii() else value.encode("utf-8", "replace").decode("utf-8")


def _flattener(keys: list[str], schema: pa.Schema, payload: bool, wanted: frozenset[str], any_key: bool):
    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in schema]
        extra = names[len(keys) :]
        for batch in batches:
            index: list[int] = []
            cols: dict[str, list] = {n: [] for n in extra}

            def flush():
                taken = batch.take(pa.array(index, pa.int32()))
                arrays = [taken.column(k) for k in keys] + [pa.array(cols[n], schema.field(n).type) for n in extra]
                return pa.RecordBatch.from_arrays(arrays, schema=schema)

            pages = batch.column("__page").to_pylist()
            texts = batch.column("__json").to_pylist()
            for row, (page, text) in enumerate(zip(pages, texts)):
                valid, value = parse_json(text)
                nodes, post = interval_labels(value, any_key) if valid else ([], [])
                parents, depths = containing(post)
                root = -1 if page is None else page
                rows = []
                if "page" in wanted:
                    rows.append(("node", 0, 0, len(nodes) + 1, -1, 0, root, None, None, None, None))
                effective = [root]
                for i, node in enumerate(nodes):
                    eff = _page_of(node.get("page"), effective[parents[i]])
                    effective.append(eff)
                    if "node" in wanted:
                        kind, html = (_text(node.get("block_type")), _text(node.get("html"))) if payload else (None, None)
                        rows.append(("node", i + 1, i + 1, post[i], parents[i], depths[i], eff, kind, html, None, None))
                    if "image" in wanted and type(node.get("images")) in (dict, list):
                        images = node["images"]
                        found = [x for x in (images if type(images) is list else [images]) if type(x) is dict]
                        for k, x in enumerate(found, 1):
                            src, alt = (_text(x.get("src")), _text(x.get("alt"))) if payload else (None, None)
                            rows.append(("image", k, i + 1, post[i], i + 1, depths[i] + 1, eff, None, None, src, alt))
                index.extend([row] * len(rows))
                for n, values in zip(extra, zip(*rows) if rows else [()] * len(extra)):
                    cols[n].extend(values)
                if len(index) >= 50_000:
                    yield flush()
                    index, cols = [], {n: [] for n in extra}
            if index:
                yield flush()

    return flatten


def flatten_records(
    df: DataFrame,
    keys: list[str],
    json_col: str = "children",
    page_col: str = "page",
    *,
    payload: bool = True,
    wanted: frozenset[str] = frozenset({"page", "node", "image"}),
    any_key: bool = False,
) -> DataFrame:
    """One row per page, node and image item of each record, with interval labels.

    keys are carried along unchanged. Columns added: kind ('node' or 'image'), item_seq, pre, post,
    parent_seq, depth, eff_page and, with payload, block_type, html, src, alt. The page is node 0 with
    parent_seq -1; its interval contains all others. An image carries the interval of its node. With any_key, the objects
    under every key are nodes, not those under `children` alone.

    Null or invalid JSON (cut off, NaN, two values) gives the page row alone; values of another type than
    usual are shown as JSON text. A page that is null counts as -1. Numbers outside int32 are no page. Rows
    delivered twice come out twice. An empty table gives an empty one. Only keys, json_col and page_col are
    read, so other columns, whatever their names, don't matter; a key named as one of the added columns is
    refused with ValueError.
    """
    added = [x.split()[0] for x in _NODE_FIELDS.split(", ")]
    if clash := set(keys) & {*added, "__json", "__page"}:
        raise ValueError(f"keys clash with the added columns: {sorted(clash)}")
    types = dict(df.select(*keys).dtypes)
    ddl = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", " + _NODE_FIELDS
    narrow = df.select(*keys, F.col(json_col).cast("string").alias("__json"), F.col(page_col).cast("int").alias("__page"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return narrow.mapInArrow(_flattener(list(keys), schema, payload, wanted, any_key), ddl)


def block_table(df: DataFrame, keys: list[str], **kw) -> DataFrame:
    """The nodes of each record, one row per object below the page."""
    return flatten_records(df, keys, wanted=frozenset({"node"}), **kw).drop("kind", "item_seq", "src", "alt").withColumnRenamed("pre", "node_seq")


def image_table(df: DataFrame, keys: list[str], **kw) -> DataFrame:
    """The image items of each record, linked to their node by its number and interval."""
    out = flatten_records(df, keys, wanted=frozenset({"image"}), **kw)
    return out.select(*keys, F.col("parent_seq").alias("node_seq"), F.col("post").alias("node_post"), F.col("item_seq").alias("image_no"), "eff_page", "src", "alt")


def subtree_sizes(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """For each node its number of descendants, from the labels alone: descendants = post - pre + depth - 1.

    In a forest numbered from 1 in both orders, the nodes before x in pre-order that are not ancestors are
    those before it in post-order, so post(x) = (pre(x) - 1) - (depth(x) - 1) + descendants(x) + 1.
    """
    return blocks.select(*keys, "node_seq", "parent_seq", (F.col("post") - F.col("node_seq") + F.col("depth") - 1).alias("n_descendants"))


def counted_below(blocks: DataFrame, keys: list[str], marked) -> DataFrame:
    """keys, node_seq, n: for each node how many of the nodes below it hold a condition, from the labels alone.

    The nodes below x are the next ones in pre-order, as many as it has descendants: a difference of running counts
    within the record, so that no pairs of nodes are made.
    """
    w = Window.partitionBy(*keys).orderBy("node_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = blocks.select(*keys, "node_seq", (F.col("post") + F.col("depth") - 1).cast("int").alias("last"), F.sum(F.when(marked, 1).otherwise(0)).over(w).alias("upto"))
    ends = run.select(*keys, F.col("node_seq").alias("last"), F.col("upto").alias("at_last"))
    return run.join(ends, [*keys, "last"]).select(*keys, "node_seq", (F.col("last") - F.col("node_seq")).alias("n_descendants"), (F.col("at_last") - F.col("upto")).alias("n"))


def contained_pairs(ancestors: DataFrame, nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Each given ancestor with the nodes below it, by interval containment within one record."""
    a = ancestors.select(*keys, F.col("node_seq").alias("anc_seq"), F.col("post").alias("anc_post"))
    return a.join(nodes, keys).filter((F.col("anc_seq") < F.col("node_seq")) & (F.col("anc_post") > F.col("post")))
