"""Subject areas of documents by seeded non-negative factorisation.

The document-term matrix V is factored into mixtures W (documents by components) and profiles H (components by terms)
by alternating multiplicative updates for the Kullback-Leibler divergence. One component is anchored at each subject
by the documents that readers labelled; one more, not anchored, takes up what all subjects share. The paragraphs are then
decomposed over the anchored components alone, on the terms these own, and a document's mixture is the mean of theirs.

Terms are hashed into BLOCK buckets for each language, so H has a fixed size whatever the corpus holds, and every
component has a profile of its own in each language (the language is read from the text). In a pass each task fits the
mixtures of its own documents to the shared H and sums up its part of the next H.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelattice.llm.articles import own_paragraphs
from pagelattice.sources.tables import closed_list, kept

#: Buckets of terms of a language; passes over the corpus; updates of the mixtures in a pass and of the paragraphs at the end.
BLOCK, PASSES, INNER, FINAL_INNER = 1 << 15, 3, 4, 6
# Frequent words by which a text's language is told, and the languages (the last: any other).
LANGUAGES = ("en", "de", "fr", "es", "")
_FREQUENT = {
    "en": "the and that with for are was this from its not has which were been have their can",
    "de": "der die das und ist von mit auf den des dem ein eine nicht sich auch werden wird fur als bei aus uber durch",
    "fr": "les des est une dans que pour pas sur qui par avec sont ces cette nous aux plus ete entre",
    "es": "los las del una que por con para como este esta son mas sin sobre entre pero han fue sus",
}
_LANGUAGE_OF = {}
for _l, _words in _FREQUENT.items():
    for _w in _words.split():
        _LANGUAGE_OF.setdefault(_w, []).append(LANGUAGES.index(_l))
TERMS = BLOCK * len(LANGUAGES)
#: Subjects that a closed list may have.
MOST_SUBJECTS = 1000
#: The share of a document's mixture from which on a component is one of its subjects.
SHARE = 0.3
#: How many times more frequent with a subject than in what all share a term must be to count for it.
OWN = 8.0
#: A paragraph has a subject if one explains so many of its terms, and such a part of those of any subject.
LEAST_TERMS, LEAST_PART = 1.0, 0.5
_TINY = 1e-12


def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % BLOCK


def language_of(paragraphs: list[list[str]], stated: str) -> int:
    """The language with most frequent words in the text; without any, the stated one."""
    hits = [0] * len(LANGUAGES)
    for words in paragraphs:
        for w in words:
            for k in _LANGUAGE_OF.get(w, ()):
                hits[k] += 1
    top = max(hits)
    return hits.index(top) if top else LANGUAGES.index(stated if stated in LANGUAGES else "")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    for batch in batches:
        stated = batch.column(1).to_pylist()
        start = 0
        terms: list[bytes] = []
        languages: list[int] = []
        lengths, ends = array("i"), [0]
        size = 0

        def packed(start: int, end: int):
            per_paragraph = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lengths, pa.int32()))
            return pa.RecordBatch.from_arrays([batch.slice(start, end - start).column(0), pa.array(languages, pa.int8()), pa.array(terms, pa.binary()), per_paragraph], names=["key", "language", "terms", "lengths"])

        for i, text in enumerate(batch.column(2)):
            paragraphs = own_paragraphs(text.as_py())
            own = array("H")
            for words in paragraphs:
                for w in words:
                    t = known.get(w)
                    if t is None:
                        if len(known) > 500_000:
                            known.clear()
                        t = known[w] = _bucket(w)
                    own.append(t)
                lengths.append(len(words))
            languages.append(language_of(paragraphs, stated[i]))
            terms.append(own.tobytes())
            ends.append(len(lengths))
            size += len(own)
            if size > 2_000_000:
                yield packed(start, i + 1)
                start, terms, languages, lengths, ends, size = i + 1, [], [], array("i"), [0], 0
        if start < batch.num_rows:
            yield packed(start, batch.num_rows)


def term_table(documents: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """key, language (its number), terms (buckets in order, two bytes each), lengths (terms of each paragraph)."""
    two = F.lower(F.left(F.trim(F.coalesce(F.col(lang), F.lit(""))), F.lit(2)))
    kind = dict(documents.dtypes)[key]
    rows = documents.select(F.col(key).alias("key"), two.alias("lang"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_terms, f"key {kind}, language tinyint, terms binary, lengths array<int>")


def _terms_in(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a batch of rows, in the block of their language, and the number of each row."""
    column = b.column("terms")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 2 if len(column) else np.zeros(1, np.int32)
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint16)[ends[0] : ends[-1]].astype(np.int64) if data is not None and ends[-1] > ends[0] else np.zeros(0, np.int64)
    lengths = np.diff(ends)
    return values + np.repeat(b.column("language").to_numpy().astype(np.int64) * BLOCK, lengths), lengths


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the length of each list."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], np.diff(offsets)


def _counted(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the rows' distinct terms, by row."""
    rows = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)
    pairs, counts = np.unique(rows * TERMS + values, return_counts=True)
    return pairs // TERMS, pairs % TERMS, counts.astype(np.float64)


def fit_mixtures(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, profiles: np.ndarray, n: int, updates: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mixtures, seen profiles, counts over their expectation) after multiplicative updates from an even start.

    profiles: terms by components, each summing to 1 over the terms.
    """
    seen = profiles[terms]
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    own = rows[starts] if len(rows) else rows
    mixtures = np.full((n, profiles.shape[1]), 1.0)
    ratio = counts
    for step in range(updates + 1):
        ratio = counts / np.maximum(np.einsum("ij,ij->i", mixtures[rows], seen), _TINY)
        if step == updates or not len(rows):
            break
        mixtures[own] *= np.add.reduceat(ratio[:, None] * seen, starts, axis=0)
    return mixtures, seen, ratio


def _summed(df: DataFrame, add: Callable[[np.ndarray, pa.RecordBatch], None], width: int) -> np.ndarray:
    """A terms by width table summed over all rows of df: a dense one in each task, the sums of its terms to the driver (TERMS rows at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS, width))
        for b in batches:
            add(total, b)
        at = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(total[at, k]) for k in range(width))], names=["t", *(f"k{k}" for k in range(width))])

    names = [f"k{k}" for k in range(width)]
    rows = df.mapInArrow(run, "t int, " + ", ".join(f"{n} double" for n in names)).groupBy("t").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    out = np.zeros((TERMS, width))
    out[rows["t"].to_numpy()] = rows[names].to_numpy()
    return out


def _scaled(table: np.ndarray) -> np.ndarray:
    """Each component's profile scaled to 1 in each language."""
    blocks = table.reshape(len(LANGUAGES), BLOCK, -1)
    return (blocks / np.maximum(blocks.sum(axis=1, keepdims=True), _TINY)).reshape(table.shape)


def anchored_profiles(terms: DataFrame, labels: DataFrame, subjects: list[str], hints: dict[str, str] | None = None) -> np.ndarray:
    """The profiles to start from: the labelled documents' terms weighted by how much they are one subject's own, and the terms of all documents.

    terms: of term_table; labels: key and labels (array). A document's terms count for each of its subjects
    in equal parts. hints: words that describe a subject count as a weak label each.
    """
    n = len(subjects)
    of_subject = {s: k for k, s in enumerate(subjects)}

    def add(total: np.ndarray, b: pa.RecordBatch) -> None:
        values, lengths = _terms_in(b)
        total[:, n] += np.bincount(values, minlength=TERMS)
        ends = np.cumsum(lengths)
        for i, named in enumerate(b.column("labels").to_pylist()):
            own = {of_subject[x] for x in named or () if x in of_subject}
            for k in own:
                np.add.at(total[:, k], values[ends[i] - lengths[i] : ends[i]], 1.0 / len(own))

    counts = _summed(terms.join(labels, "key", "left").select("language", "terms", "labels"), add, n + 1)
    anchored = _scaled(counts[:, :n])
    part = anchored / np.maximum(anchored.sum(axis=1, keepdims=True), _TINY)
    anchored = anchored * part**2
    for s, text in (hints or {}).items():
        for w in own_paragraphs(text):
            for t in w:
                anchored[_bucket(t), of_subject[s]] += 1e-4
    floor = 1e-7 * (counts[:, n:] > 0)
    even = np.maximum(part.max(axis=1, keepdims=True) - 1 / n, 0) * n / max(n - 1, 1)  # 0: as much with every subject, 1: with one alone
    return _scaled(np.hstack([_scaled(anchored) + floor, _scaled(counts[:, n:] * (1 - even) ** 2) + floor]))


def factor(terms: DataFrame, profiles: np.ndarray, passes: int = PASSES) -> np.ndarray:
    """The profiles after alternating updates over all documents."""
    for _ in range(passes):
        shared = terms.sparkSession.sparkContext.broadcast(profiles)

        def add(total: np.ndarray, b: pa.RecordBatch, shared=shared) -> None:
            rows, at, counts = _counted(*_terms_in(b))
            mixtures, _, ratio = fit_mixtures(rows, at, counts, shared.value, b.num_rows, INNER)
            for k in range(total.shape[1]):
                total[:, k] += np.bincount(at, weights=mixtures[rows, k] * ratio, minlength=TERMS)

        sums = _summed(terms.select("language", "terms"), add, profiles.shape[1])
        profiles = _scaled(profiles * sums + 1e-12 * (sums.sum(axis=1, keepdims=True) > 0))
    return profiles


def owned_terms(profiles: np.ndarray, n: int) -> np.ndarray:
    """Whether a term is a subject's own: far more frequent with it than in what all share, and with few other subjects."""
    subject, common = profiles[:, :n], profiles[:, n:]
    top, rest = subject.max(axis=1), np.maximum(common.max(axis=1), _TINY)
    part = top / np.maximum(subject.sum(axis=1), _TINY)
    return (top > OWN * rest) & (part > max(0.3, min(0.8, 2 / n))) & (top > 1e-6)


def subjects_of(terms: DataFrame, profiles: np.ndarray, subjects: list[str]) -> DataFrame:
    """key, subject, n_paragraphs, share: the components with a share of SHARE or more of the mixture of the document's paragraphs with a subject, two at most."""
    n = len(subjects)
    shared = terms.sparkSession.sparkContext.broadcast((_scaled(profiles[:, :n] * owned_terms(profiles, n)[:, None]), owned_terms(profiles, n)))
    key = terms.schema["key"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, keep = shared.value
        for b in batches:
            values, _ = _terms_in(b)
            lengths, paragraphs = _flat(b.column("lengths"))
            rows = np.repeat(np.arange(len(lengths)), lengths)
            kept_ = keep[values] if len(values) else np.zeros(0, bool)
            rows, values = rows[kept_], values[kept_]
            pairs, counts = np.unique(rows.astype(np.int64) * TERMS + values, return_counts=True)
            rows, at = pairs // TERMS, pairs % TERMS
            mixtures, _, _ = fit_mixtures(rows, at, counts.astype(float), own, len(lengths), FINAL_INNER)
            total = np.bincount(rows, weights=counts, minlength=len(lengths))
            top = mixtures.max(axis=1, initial=0.0)
            sure = (total > 0) & (top >= LEAST_TERMS) & (top >= LEAST_PART * total)
            doc = np.repeat(np.arange(b.num_rows), paragraphs)
            n_paragraphs = np.bincount(doc[sure], minlength=b.num_rows)
            whole = mixtures[sure] / mixtures[sure].sum(axis=1, keepdims=True)
            shares = np.stack([np.bincount(doc[sure], weights=whole[:, k], minlength=b.num_rows) for k in range(n)], axis=1) / np.maximum(n_paragraphs, 1)[:, None]
            order = np.argsort(-shares, axis=1, kind="stable")[:, :2]
            picked = np.take_along_axis(shares, order, axis=1)
            good = (picked > 0) & ((picked >= SHARE) | (np.arange(picked.shape[1]) == 0))
            i, j = np.nonzero(good)
            yield pa.RecordBatch.from_arrays(
                [b.column("key").take(pa.array(i)), pa.array([subjects[k] for k in order[i, j]], pa.string()), pa.array(n_paragraphs[i].astype(np.int32)), pa.array(picked[i, j])],
                names=["key", "subject", "n_paragraphs", "share"],
            )

    return terms.select("key", "language", "terms", "lengths").mapInArrow(decode, f"key {key}, subject string, n_paragraphs int, share double")


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, subject, n_paragraphs (with a subject), share (of the mixture) of each document.

    subjects is the closed list of subjects, ValueError above 1000; labels outside it, null or
    given twice, don't matter. Null, empty and blank texts, and those without a paragraph of their own on a
    subject, have no row. Paragraphs without a subject (no term of one) don't count. Ties go to the subject that
    sorts first. Repeated documents count and come out as often as they come in. Without labels the subjects'
    own descriptions are the only anchors.
    """
    listed = closed_list(subjects.filter(F.col("subject").isNotNull()).select("subject", F.concat_ws(" ", "title", "scope_note").alias("hint")), MOST_SUBJECTS)
    hints = {r["subject"]: r["hint"] for r in listed}
    names = sorted(hints)
    terms = kept(term_table(documents, key, text, lang))
    if not names:
        return terms.select(F.col("key").alias(key), F.lit("").alias("subject"), F.lit(0).alias("n_paragraphs"), F.lit(0.0).alias("share")).filter(F.lit(False))
    named = labels.filter(F.col("subject").isin(names)).groupBy(F.col(key).alias("key")).agg(F.collect_set("subject").alias("labels"))
    profiles = factor(terms, anchored_profiles(terms, named, names, hints))
    return subjects_of(terms, profiles, names).withColumnRenamed("key", key)


def composition(found: DataFrame) -> DataFrame:
    """Documents and paragraphs of each subject."""
    return found.groupBy("subject").agg(F.count("*").alias("n_documents"), F.round(F.sum(F.col("n_paragraphs") * F.col("share")), 4).alias("n_paragraphs"))
