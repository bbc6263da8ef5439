"""Lines repeated across one source's documents.

The wording of every line (letters alone, in lower case) is hashed with its source; documents are counted per hash,
and a line is standing where its wording is on a given share of the source's documents. Wordings that come
near the threshold are seeds: a line that differs from one by a misread character has its wording and counts with it.
Such lines are found by the hash of their first or last letters, so no two lines are compared that share neither; lines
that are spelt as a seed, which are most of the standing ones, are told by their hash alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelattice.operators.orphans import bloom_filter, maybe_in
from pagelattice.sources.tables import kept, within, within_bytes

#: A wording is standing on this share of its source's rows, and at least so many.
SHARE, LEAST = 0.1, 3
#: Letters at either end by which a misread line is found; seeds, and bytes of their wordings, that are broadcast at most (else a filter and a shuffle).
END, BROADCAST_SEEDS, BROADCAST_BYTES = 6, 100_000, 8_000_000
# Characters that scans give for others, and the words of page numbers.
_LOOKS = {"α": "a", "ν": "v", "ο": "o", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff"}
PAGE_WORDS = frozenset("page pages pageof pagesof p pg pof pgof pp of seite seitevon s svon blatt sheet sheetof pageno no l o i lof pagel pageofl".split())
_MARKUP = re.compile(r"<[^>]*>|&#?\w{1,10};")
_NO_LETTER = re.compile(r"[\W\d_]+")
_FOLD = str.maketrans(_LOOKS)
_ASCII = str.maketrans("", "", "".join(c for c in map(chr, range(128)) if not c.isalpha()))
_NUMBER_ONLY = re.compile(r"[\W_]*(?:p(?:a[gq][ec])?[gp]?\.?|seite|blatt|sheet|s\.)?[\W_]*(?:no\.?)?[\W_]*[\dlioOSBZ|]{1,5}(?:[\W_]*(?:of|von|/|\|)?[\W_]*[\dliOSBZ]{1,5})?[\W_]*", re.IGNORECASE)


def source_of(c: Column) -> Column:
    """A source as a key: null is a source of its own, apart from the empty one."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def visible(line: str) -> str:
    """The text of a line without markup and entities."""
    return _MARKUP.sub(" ", line) if "<" in line or "&" in line else line


def wording(text: str) -> str:
    """The letters of a visible text in lower case, without marks for copyright."""
    t = text.lower()
    if "(c)" in t:
        t = t.replace("(c)", "")
    return t.translate(_ASCII) if t.isascii() else _NO_LETTER.sub("", t.translate(_FOLD))


def is_page_number(shown: str, letters: str) -> bool:
    """Whether a visible text, whose wording is letters, is a page number and no more."""
    return letters in PAGE_WORDS or (len(letters) < 12 and _NUMBER_ONLY.fullmatch(shown) is not None)


def _splitter(single: bool):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index: list[int] = []
            numbers: list[int] = []
            words: list[str] = []
            size = 0

            def flush():
                taken = batch.take(pa.array(index, pa.int32()))
                return pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(numbers, pa.int32()), pa.array(words, pa.string())], names=["source", "row_id", "line_no", "wording"])

            for at, text in enumerate(batch.column(2).to_pylist()):
                for no, line in enumerate((text,) if single else text.split("\n"), 1):
                    shown = visible(line)
                    w = wording(shown)
                    if w and not (len(w) < 12 and is_page_number(shown, w)):
                        index.append(at)
                        numbers.append(no)
                        words.append(w)
                        size += len(w)
                if size > 1 << 24:
                    yield flush()
                    index, numbers, words, size = [], [], [], 0
            if index:
                yield flush()

    return split


def lines_of(df: DataFrame, source: str, row: str, text: str, name: str, *, single: bool = False) -> DataFrame:
    """src_table, source, row_id, line_no, wording, h (of source and wording) of every line with a wording; page numbers have none."""
    rows = df.select(source_of(F.col(source)).alias("source"), F.col(row).cast("long").alias("row_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    lines = rows.mapInArrow(_splitter(single), "source string, row_id long, line_no int, wording string").withColumn("src_table", F.lit(name))
    return lines.select("src_table", "source", "row_id", "line_no", "wording", F.xxhash64("src_table", "source", "wording").alias("h"))


def _ends(w: Column) -> Column:
    """Keys of the two ends of a wording, within a source."""
    return F.array(F.xxhash64("src_table", "source", F.lit("<"), F.left(w, F.lit(END))), F.xxhash64("src_table", "source", F.lit(">"), F.right(w, F.lit(END))))


def standing_lines(lines: DataFrame, n_rows: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """The standing lines among `lines` (of lines_of): src_table, source, row_id, line_no, seed (the hash of its wording).

    n_rows: src_table, source, n: the rows of each source. A row counts once for a wording, however often
    it repeats it. A misread line differs from the seed by one letter (two in wordings of 15 or more). Sources
    with fewer rows than `least` have none; lines without letters never are. Null source is a source of
    its own; null texts have no lines.
    """
    lines = kept(lines)  # each line is cut and folded once
    need = F.greatest(F.lit(float(least)), F.ceil(F.lit(share) * F.col("n") - 1e-9))
    # rows of a hash: equal lines of one row meet in the task that reads it, so partial counts need no distinct
    per_row = lines.groupBy("src_table", "source", "h", "row_id").agg(F.lit(1).alias("one"))
    counts = per_row.groupBy("src_table", "source", "h").agg(F.count("*").alias("rows")).filter("rows >= 2")
    seeds = counts.join(n_rows.filter(F.col("n") >= least), ["src_table", "source"]).filter(F.col("rows") >= F.ceil(need / 2)).select("h", need.alias("need"))
    seeds = kept(seeds)
    hint = F.broadcast if within(seeds, BROADCAST_SEEDS) else (lambda x: x)
    marked = lines.join(hint(seeds), "h", "left")  # need is null where the wording is no seed
    exact = marked.filter(F.col("need").isNotNull())
    place = ["src_table", "source", "row_id", "line_no"]
    text = kept(exact.groupBy("h").agg(F.any_value("wording").alias("seed_wording"), F.any_value("src_table").alias("src_table"), F.any_value("source").alias("source"), F.any_value("need").alias("need")))
    text = text.filter(F.length("seed_wording") >= 5)
    keys = text.select(F.explode(_ends(F.col("seed_wording"))).alias("key"), F.col("h").alias("seed"), "seed_wording", "need")
    w = F.col("wording")
    probes = marked.filter(F.col("need").isNull()).select(*place, "wording", F.explode(_ends(w)).alias("key"))
    small = within_bytes(text, BROADCAST_BYTES, 2 * F.octet_length("seed_wording") + 100)
    if not small:
        probes = probes.filter(maybe_in(bloom_filter(keys, ["key"], 2 * text.count()), probes, ["key"]))
    limit = F.when(F.length("seed_wording") >= 15, 2).otherwise(1)
    far = F.when(F.abs(F.length(w) - F.length("seed_wording")) > 2, -1).otherwise(F.levenshtein(w, F.col("seed_wording"), 2))
    near = probes.join(F.broadcast(keys) if small else keys, "key").withColumn("far", far).filter((F.col("far") >= 0) & (F.col("far") <= limit))
    near = near.groupBy(*place).agg(F.min(F.struct("far", "seed", "need")).alias("best")).select(*place, "best.seed", "best.need")
    best = exact.select(*place, F.col("h").alias("seed"), "need").unionByName(near)
    best = kept(best)
    rows = best.groupBy("seed", "row_id").agg(F.first("need").alias("need")).groupBy("seed").agg(F.count("*").alias("rows"), F.first("need").alias("need"))
    return best.drop("need").join(rows.filter(F.col("rows") >= F.col("need")).select("seed"), "seed", "left_semi")


def manual_lines(parsed: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines of pages and section headings, and the rows of each device in either table."""
    lines = lines_of(parsed, "device_id", "page_id", "html", "parsed").unionByName(lines_of(sections, "device_id", "section_id", "section_heading", "sections", single=True))
    count = lambda df, name: df.groupBy(source_of(F.col("device_id")).alias("source")).agg(F.count("*").alias("n")).withColumn("src_table", F.lit(name))
    return lines, count(parsed, "parsed").unionByName(count(sections, "sections"))


def manual_standing_lines(parsed: DataFrame, sections: DataFrame) -> DataFrame:
    """src_table, row_id, line_no of the standing lines of pages and section headings."""
    return standing_lines(*manual_lines(parsed, sections)).select("src_table", "row_id", "line_no")


def without_lines(df: DataFrame, row: str, text: str, standing: DataFrame, name: str) -> DataFrame:
    """row and text without its standing lines, and how many were left out. Rows without any come out as they are; null stays null."""
    drop = standing.filter(F.col("src_table") == name).groupBy(F.col("row_id").alias(row)).agg(F.collect_set("line_no").alias("drop"))
    joined = df.select(row, text).join(drop, row, "left")
    rest = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("drop", i + 1)), "\n")
    return joined.select(row, F.when(F.col("drop").isNull(), F.col(text)).otherwise(rest).alias(text), F.coalesce(F.size("drop"), F.lit(0)).alias("n_removed")).withColumn("n_removed", F.when(F.col("n_removed") < 0, 0).otherwise(F.col("n_removed")))
