"""Repair of text from scanned pages: broken words, misread characters, running titles and page numbers.

Noisy channel: a printed word v is read as x with the product of the probabilities of the character confusions between
them, which are estimated from the corpus; the corpus also gives the frequency of words and of their pairs. Words that
some confusions turn into each other have the same skeleton, by which candidates are joined, however many
confusions lie between. Viterbi picks the words of each line, and those broken over its end, among their candidates.
Running titles are lines that stand on many rows of a device and carry the number of the page.

Two passes over the text: the first counts words, pairs and lines in each task; the second repairs row by row.
"""

from __future__ import annotations

import html as html_
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelattice.llm.standing import END, LEAST, SHARE, is_page_number, source_of, visible, wording
from pagelattice.sources.tables import kept, within, within_bytes

# What a scan shows, and what was printed.
CONFUSIONS = {
    "c": ("e",), "f": ("t",), "α": ("a",), "ri": ("n",), "0": ("o",), "!": ("i",), "1": ("i", "l"), "5": ("s",), "€": ("c",), "cl": ("d",), "ii": ("u",), "rn": ("m",),
    "9": ("g",), "li": ("h",), "6": ("b",), "ν": ("v",), "vv": ("w",), "ﬁ": ("fi",), "ﬂ": ("fl",), "ﬀ": ("ff",), "2": ("z",), "ο": ("o",), "|": ("l", "i"), "8": ("b",), "3": ("e",), "4": ("a",), "7": ("t",),
}
#: Strokes of the letters that confusions change; both sides of a confusion have the same.
_STROKES = {
    **dict.fromkeys("e€3", "c"), **dict.fromkeys("f7", "t"), **dict.fromkeys("α4", "a"), **dict.fromkeys("0ο", "o"), **dict.fromkeys("!1l|", "i"), "5": "s", "9": "g", **dict.fromkeys("68", "b"), "ν": "v", "2": "z",
    "n": "ri", "m": "rri", "d": "ci", "u": "ii", "h": "ii", "w": "vv", "ﬁ": "ti", "ﬂ": "ti", "ﬀ": "tt",
}
_SKELETON = str.maketrans(_STROKES)
#: Probability of a confusion before the corpus is seen, and how many places that counts for; how many times that a misreading may be more frequent than expected; weight of pairs; how
#: many times more than its candidates' a pair of a word as rare as misreadings must be met to speak for it.
MISREAD, PRIOR, SLACK, PAIRS, DOUBT = 0.002, 500, 10.0, 0.6, 5
#: Entries of the lexicon and pairs of words that are broadcast (of more, each text gets its own); bytes of standing lines that are broadcast.
LEXICON, PAIR_ENTRIES, BROADCAST_BYTES = 400_000, 400_000, 16_000_000
_HYPHENS = "-‐‑­¬"
_BROKEN = re.compile(r"[^\W\d_][" + _HYPHENS + r"]+$")
_EDGES = ".,;:()[]{}\"'*?…“”„‘’«»<>=+"
_CODE = re.compile(r"[a-z]\w{2}\.\w{2}|.*\d.*\d.*\d.*|\d+")
_HAS_LETTER = re.compile(r"[^\W\d_]")
_HEADING = re.compile(r"<h[1-6][\s>]", re.IGNORECASE)
_OPENS, _CLOSES = re.compile(r"<(?:p|li|td|th|div|blockquote)[\s>]", re.IGNORECASE), re.compile(r"</(?:p|li|td|th|div|blockquote)>", re.IGNORECASE)
_EDGE_NUMBER = re.compile(r"[\W_]*(\d{1,5})\b|.*?\b(\d{1,5})[\W_]*$", re.DOTALL)


def shown(line: str) -> str:
    """The visible text of a line, entities written out."""
    if "&" in line:
        line = re.sub(r"<[^>]*>", " ", line) if "<" in line else line
        return html_.unescape(line)
    return visible(line)


def word_of(token: str) -> str:
    """A token without the punctuation around it, in lower case; empty if it is no word but a code or number."""
    w = token.strip(_EDGES).lower()
    return w if w and _HAS_LETTER.search(w) and not _CODE.fullmatch(w) else ""


class _Words(dict):
    """Tokens met before and their words."""

    def __missing__(self, token: str) -> str:
        if len(self) > 200_000:
            self.clear()
        w = self[token] = word_of(token)
        return w


_WORDS = _Words()


def _is_broken(token: str) -> bool:
    return token[-1] in _HYPHENS and _BROKEN.search(token) is not None


def _edge_numbers(text: str) -> set[int]:
    return {int(x) for m in (re.match(r"[\W_]*(\d{1,5})\b", text), re.search(r"\b(\d{1,5})[\W_]*$", text)) if m for x in [m[1]]}


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, a, b, n, e): w word; p pair of words; s source and line (e: with its page's number)."""
    words: Counter = Counter()
    pairs: Counter = Counter()
    lines: dict[tuple[str, str], list[int]] = {}
    size = 0

    def flush():
        rows = [("w", w, "", n, 0) for w, n in words.items()]
        rows += [("p", a, b, n, 0) for (a, b), n in pairs.items()]
        rows += [("s", a, b, n, e) for (a, b), (n, e) in lines.items()]
        for at in range(0, len(rows), 50_000):
            cols = list(zip(*rows[at : at + 50_000]))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], names=["kind", "a", "b", "n", "e"])
        words.clear(), pairs.clear(), lines.clear()

    for batch in batches:
        for source, number, is_page, text in zip(*(batch.column(k).to_pylist() for k in ("source", "number", "is_page", "text"))):
            inside = broken = False
            seen: dict[str, int] = {}
            row_words: list[str] = []
            row_pairs: list[tuple[str, str]] = []
            for line in text.split("\n"):
                text_ = shown(line)
                tokens = text_.split()
                if is_page:
                    opens = len(_OPENS.findall(line)) - len(_CLOSES.findall(line)) if "<" in line else 0
                    if not inside and opens <= 0:
                        w = wording(text_)
                        if len(w) >= 5:
                            mark = 1 if number is not None and str(number) in text_ and number in _edge_numbers(text_) else 0
                            seen[w] = max(seen.get(w, 0), mark)
                    inside = inside and opens >= 0 or opens > 0
                if not tokens:
                    continue
                first, broken = (1 if broken else 0), _is_broken(tokens[-1])
                own = [w for w in map(_WORDS.__getitem__, tokens[first : len(tokens) - broken] if first or broken else tokens) if w]
                row_words += own
                row_pairs += zip(own, own[1:])
            words.update(row_words)
            pairs.update(row_pairs)
            for w, mark in seen.items():
                entry = lines.get((source, w))
                if entry is None:
                    entry = lines[source, w] = [0, 0]
                    size += len(w)
                entry[0] += 1
                entry[1] += mark
        if len(words) + len(pairs) + 2 * len(lines) > 600_000 or size > 32_000_000:
            yield from flush()
            size = 0
    yield from flush()


def _clean(w: str) -> bool:
    return w.isascii() and w.replace("-", "").isalpha() and not w.startswith("-") and not w.endswith("-")


def confusions_between(x: str, v: str) -> list[str] | None:
    """The fewest confusions (read>printed) by which v is read as x; null if there is no way."""
    best: list[dict[int, list[str]]] = [{} for _ in range(len(x) + 1)]
    best[0][0] = []
    for i in range(len(x)):
        for j, used in best[i].items():
            steps = [(1, 1, [])] if j < len(v) and x[i] == v[j] else []
            steps += [(len(s), len(t), [f"{s}>{t}"]) for s in (x[i], x[i : i + 2]) for t in CONFUSIONS.get(s, ()) if v.startswith(t, j)]
            for di, dj, more in steps:
                old = best[i + di].get(j + dj)
                if old is None or len(old) > len(used) + len(more):
                    best[i + di][j + dj] = used + more
    return best[len(x)].get(len(v))


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = b.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([w.translate(_SKELETON) for w in words], pa.string()), b.column(0), b.column(1), pa.array([_clean(w) for w in words])], names=["s", "word", "n", "clean"])


def _derived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        used = [confusions_between(x, v) for x, v in zip(b.column("x").to_pylist(), b.column("v").to_pylist())]
        at = pa.array([i for i, u in enumerate(used) if u], pa.int32())
        yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in ("x", "n", "v", "nv")), pa.array([u for u in used if u], pa.list_(pa.string()))], names=["x", "n", "v", "nv", "used"])


def _standing_for(derived: DataFrame, logs: dict[str, float]) -> DataFrame:
    """derived with k, r (log probability of the confusions) and sure: whether x is no more frequent than misreadings of v are."""
    table = F.create_map(*(F.lit(y) for pair in logs.items() for y in pair))
    out = derived.withColumns({"k": F.size("used"), "r": F.aggregate(F.transform("used", lambda c: table[c]), F.lit(0.0), lambda a, c: a + c)})
    odd = ~F.col("x").rlike("^[a-z-]+$")
    few = (F.col("n") - 1 <= F.pow(F.lit(SLACK), F.col("k")) * F.exp("r") * F.col("nv")) & (F.col("nv") >= 5)
    return out.withColumn("sure", F.when(odd, True).otherwise(few) & ((F.col("k") == 1) | (F.col("nv") >= 50 * F.col("n")))).withColumn("odd", odd)


def confusion_probabilities(derived: DataFrame, known: DataFrame) -> dict[str, float]:
    """The probability of each confusion: words that stand for others by it alone, over the places where it could be. One row to the driver."""
    names = [(s, t) for s, tos in CONFUSIONS.items() for t in tos]
    alone = _standing_for(derived, {f"{s}>{t}": math.log(MISREAD) for s, t in names}).filter("sure and k = 1")
    met = {r["c"]: r["n"] for r in alone.groupBy(F.get("used", 0).alias("c")).agg(F.sum("n").alias("n")).collect()}
    places = known.agg(*(F.sum(F.col("n") * (F.length("word") - F.length(F.replace("word", F.lit(t), F.lit("")))) / len(t)).alias(str(i)) for i, (_, t) in enumerate(names))).first()
    return {f"{s}>{t}": min(0.2, (met.get(f"{s}>{t}", 0) + MISREAD * PRIOR) / ((places[i] or 0) + PRIOR)) for i, (s, t) in enumerate(names)}


def lexicon(words: DataFrame) -> DataFrame:
    """(x, v, n, k, r, sure) for each word x that may be a misreading of v, and (v, v, n, 0, 0, true) for each known word.

    words: word, n. n: the count of v; k: confusions; r: their log probability; sure: x is no more frequent than what
    the misreadings of v are expected to be, SLACK times for each confusion. Where it isn't, x is a word of its own too, and
    only a single confusion is held against it: the neighbours decide.
    """
    marked = kept(words.mapInArrow(_skeletons, "s string, word string, n long, clean boolean"))
    known = marked.filter("clean and n >= 2")
    pairs = marked.select("s", F.col("word").alias("x"), "n").join(known.select("s", F.col("word").alias("v"), F.col("n").alias("nv")), "s").filter("x <> v and n <= nv")
    derived = kept(pairs.select("x", "n", "v", "nv").mapInArrow(_derived, "x string, n long, v string, nv long, used array<string>"))
    chances = confusion_probabilities(derived, known)
    met = _standing_for(derived, {c: math.log(p) for c, p in chances.items()})
    met = met.filter(F.col("sure") | (~F.col("odd") & (F.col("k") == 1) & (F.col("nv") >= 5))).select("x", "v", F.col("nv").alias("n"), "k", "r", "sure")
    own = known.filter(F.col("word").rlike("^[a-z-]+$")).select(F.col("word").alias("x"), F.col("word").alias("v"), "n", F.lit(0).alias("k"), F.lit(0.0).alias("r"), F.lit(True).alias("sure"))
    return met.unionByName(own)


def telling_pairs(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """(pair, n) of the pairs met twice or more in which a word is a candidate for another, or has one. pairs: a, b, n."""
    met = entries.filter("k > 0")
    words = met.select(F.explode(F.array("x", "v")).alias("w")).distinct()
    some = pairs.filter("n >= 2")
    either = some.join(words.withColumnRenamed("w", "a"), "a", "left_semi").select("a", "b", "n").union(some.join(words.withColumnRenamed("w", "b"), "b", "left_semi").select("a", "b", "n"))
    return either.distinct().select(F.concat_ws(" ", "a", "b").alias("pair"), "n")


def close(a: str, b: str, most: int) -> bool:
    """Whether a becomes b by at most `most` (1 or 2) changes of one letter each."""
    if abs(len(a) - len(b)) > most:
        return False
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    while len(a) > lo and len(b) > lo and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    a, b = a[lo:], b[lo:]
    if max(len(a), len(b)) <= 1:
        return True
    if most < 2 or (not a or not b):
        return max(len(a), len(b)) <= most
    return close(a[1:], b[1:], most - 1) or close(a[1:], b, most - 1) or close(a, b[1:], most - 1)


class Standing:
    """The standing lines of a device, and which are running titles."""

    def __init__(self, entries):
        self.of = {w: title for w, title in entries}
        self.by_end: dict[str, list[str]] = {}
        for w in self.of:
            for end in {"<" + w[:END], ">" + w[-END:]}:
                self.by_end.setdefault(end, []).append(w)

    def kind(self, w: str) -> bool | None:
        """True for a running title, False for another standing line, None for neither."""
        if w in self.of:
            return self.of[w]
        for seed in (*self.by_end.get("<" + w[:END], ()), *self.by_end.get(">" + w[-END:], ())):
            if close(w, seed, 2 if len(seed) >= 15 else 1):
                return self.of[seed]
        return None


class Repairer:
    """The channel and the language model, of all words and pairs or of those that a text asks for."""

    def __init__(self, words: list[tuple], pairs: dict[str, int], total: float, weight: float = PAIRS):
        self.known: dict[str, int] = {}
        self.suspects: dict[str, list[tuple]] = {}
        for x, v, n, k, r, sure in words:
            if k == 0:
                self.known[x] = n
            else:
                self.suspects.setdefault(x, []).append((k, -r, -n, v, sure))
        for found in self.suspects.values():
            found.sort()
        self.pairs, self.total, self.weight = pairs, max(total, 1.0), weight  # weight of pairs against single words
        self.seen: dict[str, tuple] = {}

    def pair(self, a: str, b: str) -> int:
        return self.pairs.get(f"{a} {b}", 0)

    def options(self, w: str) -> tuple:
        """(word, its count, log probability of the reading, expected share of misreadings of it, whether its own pairs count in full) that w may stand for, itself first."""
        out = self.seen.get(w)
        if out is None:
            found = self.suspects.get(w, ())
            own = float(self.known.get(w, 1))
            likely = [(math.exp(-cost) * SLACK**k, -n) for k, cost, n, _, sure in found if sure]
            if likely:
                own = max(own - 1 - max(rate * n for rate, n in likely), 0.01)
                if not _clean(w):
                    own = min(own, 0.001)
            share = max((rate for rate, _ in likely), default=0.0)
            out = ((w, own, 0.0, share, not found), *((v, float(-n), -cost, 0.0, True) for k, cost, n, v, _ in found))
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[w] = out
        return out

    def _follow(self, a: tuple, b: tuple, others: tuple) -> float:
        """The share of the first word's places where the second follows. A pair with a doubtful word counts without this place of it; if the
        word is no more frequent than misreadings, its pair must be met DOUBT times more than half as often as that with a candidate, and says nothing of what follows."""
        n = self.pair(a[0], b[0])
        if n and not (a[4] and b[4]):
            if a[3] or b[3] and not _clean(b[0]):
                return 0.0
            n -= 1
            if b[3]:
                n -= DOUBT + max(b[3], 0.5) * max((self.pair(a[0], o[0]) for o in others if o[0] != b[0]), default=0)
        return min(n / max(a[1], 1.0), 1.0) if n > 0 else 0.0

    def lattice(self, choices: list[tuple]) -> list[str]:
        """The most likely word of each place by Viterbi."""
        scores, back, before = [0.0], [], None
        for place in choices:
            new, from_ = [], []
            for option in place:
                v, n, reading = option[0], option[1], option[2]
                alone = (1 - self.weight) * n / self.total
                if before is None or not v:
                    ways = [s + math.log(alone + 1e-300) for s in scores]
                else:
                    ways = [s + math.log(self.weight * self._follow(a, option, place) + alone + 1e-300) if a[0] else s + math.log(alone + 1e-300) for s, a in zip(scores, before)]
                k = max(range(len(ways)), key=ways.__getitem__)
                new.append(ways[k] + reading)
                from_.append(k)
            scores, before = new, place
            back.append(from_)
        at = max(range(len(scores)), key=scores.__getitem__)
        path = []
        for place, from_ in zip(reversed(choices), reversed(back)):
            path.append(place[at][0])
            at = from_[at]
        return path[::-1]

    def line(self, words: list[str]) -> list[str]:
        """The most likely words of a line."""
        if self.suspects.keys().isdisjoint(words):
            return words
        return self.lattice([self.options(w) for w in words])

    def joined(self, left: str, right: str, before: str, after: str) -> str:
        """The whole word of two parts, with a hyphen if it is a compound; the words around it have their say."""
        plain, compound = left + right, left + "-" + right
        choices = [o for form in (plain, compound) for o in self.options(form) if o[0] in self.known]
        if not choices:
            return plain
        return self.lattice([self.options(before)[:1], tuple(choices), self.options(after)[:1]])[1]


class _AskingWords:
    """Stands for a Repairer to learn which words of the lexicon a text asks for."""

    def __init__(self):
        self.asked: set[str] = set()

    def line(self, words: list[str]) -> list[str]:
        self.asked.update(words)
        return words

    def joined(self, left: str, right: str, before: str, after: str) -> str:
        self.asked.update((left + right, left + "-" + right, before, after))
        return left + right


class _AskingPairs(Repairer):
    """A Repairer without pairs that learns which ones it asks for; that does not depend on their counts."""

    def __init__(self, words: list[tuple]):
        super().__init__(words, {}, 1.0)
        self.asked: set[str] = set()

    def pair(self, a: str, b: str) -> int:
        self.asked.add(f"{a} {b}")
        return 1


def repair(text: str, device: Standing, r: Repairer | _AskingWords, markup: bool) -> tuple[set[tuple[int, str, str]], list[str]]:
    """The cases of a text (line, kind, word), and its paragraphs as they should read."""
    cases: set[tuple[int, str, str]] = set()
    paragraphs: list[str] = []
    current: list[str] = []
    held = None  # (line, left part, its token, the word before) of a word that is broken at the end of the last body line

    def end():
        if current:
            paragraphs.append(" ".join(current))
            current.clear()

    for no, line in enumerate(text.split("\n"), 1):
        visible_ = shown(line)
        tokens = visible_.split()
        if not tokens:
            if not markup or held is None:
                end()
            continue
        letters = wording(visible_)
        if (len(letters) < 12 and is_page_number(visible_, letters)) or not letters and any(c.isdigit() for c in visible_) and len(visible_.strip()) < 16:
            cases.add((no, "header", "-"))
            continue
        kind = device.kind(letters) if len(letters) >= 5 else None
        if kind is not None:
            if kind:
                cases.add((no, "header", "-"))
            continue
        if markup and _HEADING.search(line):
            end()
            paragraphs.append(" ".join(tokens))
            held = None
            continue
        if markup and "<" in line and _OPENS.search(line) and held is None:
            end()
        start = 0
        if held is not None:
            at, left, token, before = held
            right = _WORDS[tokens[0]]
            if right:
                whole = r.joined(left, right, before, _WORDS[tokens[1]] if len(tokens) > 1 else "")
                cases.add((at, "hyphen", whole))
                lead, tail = token[: len(token) - len(token.lstrip(_EDGES))], tokens[0][len(tokens[0].rstrip(_EDGES)) :]
                current.append(lead + _like(token, whole) + tail)
                start = 1
            else:
                current.append(token)
            held = None
        closes = markup and "</" in line and _CLOSES.search(line) is not None
        last = len(tokens)
        if _is_broken(tokens[-1]) and not closes and last > start:
            left = tokens[-1].rstrip(_HYPHENS).lstrip(_EDGES).lower()
            if not _CODE.fullmatch(left):
                held = (no, left, tokens[-1].rstrip(_HYPHENS), _WORDS[tokens[last - 2]] if last - 1 > start else "")
                last -= 1
        if start or last < len(tokens):
            tokens = tokens[start:last]
        observed = list(map(_WORDS.__getitem__, tokens))
        read = r.line(observed)
        if read is observed:
            current += tokens
            if closes:
                end()
            continue
        for token, w, v in zip(tokens, observed, read):
            if v != w:
                cases.add((no, "char", v))
                at = token.lower().find(w)
                token = token[:at] + _like(token[at:], v) + token[at + len(w) :]
            current.append(token)
        if closes:
            end()
    if held is not None:
        current.append(held[2])
    end()
    return cases, paragraphs


def _like(token: str, word: str) -> str:
    """word with the case of token."""
    if token[:1].isupper():
        return word.upper() if len(token) > 2 and token.isupper() else word[:1].upper() + word[1:]
    return word


def _devices():
    """A function from a source and its entries to its standing lines, which remembers some."""
    devices: dict[str, Standing] = {}
    none = Standing(())

    def of(source: str, lines: pa.Array, i: int) -> Standing:
        device = devices.get(source)
        if device is None:
            if len(devices) > 2_000:
                devices.clear()
            entries = lines[i].as_py()
            device = devices[source] = Standing([(x["w"], x["title"]) for x in entries]) if entries else none
        return device

    return of


_ENTRY = ("x", "v", "n", "k", "r", "sure")


def _entries(cell) -> list[tuple]:
    return [tuple(e[k] for k in _ENTRY) for e in cell or ()]


def _asking(pairs: bool):
    """Rows (src_table, row_id, x) of the words, or of the pairs once the words are there, that repairing a text looks up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        device = _devices()
        for b in batches:
            names, rows, sources, markup, contents = (b.column(k).to_pylist() for k in ("src_table", "row_id", "source", "markup", "text"))
            lines = b.column("lines")
            out = []
            for i, text in enumerate(contents):
                r = _AskingPairs(_entries(b.column("entries")[i].as_py())) if pairs else _AskingWords()
                repair(text, device(sources[i], lines, i), r, markup[i])
                out += [(names[i], rows[i], x) for x in r.asked if x.strip()]
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["src_table", "row_id", "x"])

    return run


def _repairing(shared, texts: bool, own_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, total, weight = shared.value
        r = Repairer(words, pairs, total, weight)
        device = _devices()
        for b in batches:
            names, rows, sources, markup, contents = (b.column(k).to_pylist() for k in ("src_table", "row_id", "source", "markup", "text"))
            lines = b.column("lines")
            out = []
            for i, text in enumerate(contents):
                if own_words:
                    r = Repairer(_entries(b.column("entries")[i].as_py()), {e["x"]: e["n"] for e in b.column("pairs")[i].as_py() or ()}, total, weight)
                cases, paragraphs = repair(text, device(sources[i], lines, i), r, markup[i])
                if texts:
                    out.append((names[i], rows[i], 0, "", "", paragraphs))
                else:
                    out += [(names[i], rows[i], *c) for c in sorted(cases)]
            if out:
                cols = list(zip(*out))
                arrays = [pa.array(cols[0]), pa.array(cols[1], pa.int64())]
                if texts:
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array(cols[5], pa.list_(pa.string()))], names=["src_table", "row_id", "paragraphs"])
                else:
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array(cols[2], pa.int32()), pa.array(cols[3]), pa.array(cols[4])], names=["src_table", "row_id", "line_no", "kind", "word"])

    return run


def _with_own(rows: DataFrame, asked: DataFrame, table: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    """rows with the rows of a table that each asks for (by x), as an array."""
    found = asked.join(table.hint("merge"), "x").groupBy(F.col("src_table").alias("of_table"), F.col("row_id").alias("of_row")).agg(F.collect_set(F.struct(*columns)).alias(name))
    return rows.join(found.hint("merge"), (F.col("src_table") == F.col("of_table")) & F.col("row_id").eqNullSafe(F.col("of_row")), "left").drop("of_table", "of_row")


def _rows(parsed: DataFrame, sections: DataFrame) -> DataFrame:
    source = source_of(F.col("device_id")).alias("source")
    pages = parsed.select(F.lit("parsed").alias("src_table"), F.col("page_id").cast("long").alias("row_id"), source, (F.coalesce("page", "idx") + 1).cast("int").alias("number"), F.lit(True).alias("markup"), F.col("html").alias("text"))
    excerpts = sections.select(F.lit("sections").alias("src_table"), F.col("section_id").cast("long").alias("row_id"), source, F.lit(None).cast("int").alias("number"), F.lit(False).alias("markup"), F.col("excerpt").alias("text"))
    return pages.unionByName(excerpts).filter(F.col("text").isNotNull() & (F.col("text") != ""))


def repaired(parsed: DataFrame, sections: DataFrame, *, texts: bool = False, weight: float = PAIRS) -> DataFrame:
    """src_table, row_id, line_no, kind, word of the repairs of pages and excerpts; with texts, src_table, row_id and paragraphs.

    kind: hyphen (a word broken at the end of the line), char (a misread word), header (a running title or
    page number). Null and empty texts have no row; a text without noise comes out in its own paragraphs. Words are
    judged by the counts of all pages and excerpts. Of candidates equally likely the first in the order of the
    text's confusions is taken, the word as it stands before all.
    """
    rows = _rows(parsed, sections)
    counted = kept(rows.select("source", "number", F.col("markup").alias("is_page"), "text").mapInArrow(_counting, "kind string, a string, b string, n long, e long"))
    words = kept(counted.filter("kind = 'w'").groupBy(F.col("a").alias("word")).agg(F.sum("n").alias("n")))
    total = float(words.agg(F.sum("n")).first()[0] or 0)

    n_rows = parsed.groupBy(source_of(F.col("device_id")).alias("source")).agg(F.count("*").alias("rows"))
    lines = counted.filter("kind = 's'").groupBy(F.col("a").alias("source"), F.col("b").alias("w")).agg(F.sum("n").alias("n"), F.sum("e").alias("e")).filter("n >= 2")
    need = F.greatest(F.lit(float(LEAST)), F.lit(SHARE) * F.col("rows") * 0.75)  # misread ones aren't counted yet
    standing = lines.join(n_rows, "source").filter(F.col("n") >= need).select("source", F.struct("w", ((F.col("e") >= 2) & (F.col("e") >= 0.08 * F.col("n"))).alias("title")).alias("x"))
    standing = kept(standing.groupBy("source").agg(F.collect_list("x").alias("lines")))  # some dozens a device: each is on a tenth of its rows
    small = within_bytes(standing, BROADCAST_BYTES, F.aggregate("lines", F.lit(32), lambda a, x: a + F.length(x["w"]) + 32))
    joined = rows.join(F.broadcast(standing) if small else standing, "source", "left").select("src_table", "row_id", "source", "markup", "text", "lines")

    entries = kept(lexicon(words))
    pairs = kept(telling_pairs(counted.filter("kind = 'p'").groupBy("a", "b").agg(F.sum("n").alias("n")), entries))
    schema = "src_table string, row_id long, " + ("paragraphs array<string>" if texts else "line_no int, kind string, word string")
    small = within(entries, LEXICON) and within(pairs, PAIR_ENTRIES)
    own = [tuple(x) for x in entries.select(*_ENTRY).toPandas().itertuples(index=False, name=None)] if small else []
    spoken = dict(pairs.toPandas().itertuples(index=False, name=None)) if small else {}
    shared = parsed.sparkSession.sparkContext.broadcast((own, spoken, total, weight))
    if not small:  # each row with the part of the lexicon, then with the pairs that its text asks for
        word = "src_table string, row_id long, x string"
        joined = kept(_with_own(joined, joined.mapInArrow(_asking(False), word), entries, _ENTRY, "entries"))
        joined = _with_own(joined, joined.mapInArrow(_asking(True), word), pairs.withColumnRenamed("pair", "x"), ("x", "n"), "pairs")
    return joined.mapInArrow(_repairing(shared, texts, not small), schema)
