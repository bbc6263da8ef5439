import random

import numpy as np
import pytest

from pagelattice.llm import subjects as S
from pagelattice.llm.articles import own_paragraphs

TOPICS = {"physics": "photon laser plasma quark neutrino lattice", "law": "court treaty statute liability appeal verdict", "sport": "coach referee stadium sprint marathon goalkeeper", "earth": "glacier sediment monsoon aquifer coastline permafrost", "chemistry": "ester solvent ligand titration alkene catalyst", "economics": "tariff auction subsidy inflation portfolio bargaining"}
FILL = "the results of this work are shown in the figure and with that we report which has been seen from these"


def test_own_text():
    text = r"""\documentclass{a}\newcommand{\tm}{wave packet}\def\q{quark}
\begin{document}\maketitle % court
\begin{abstract}The \tm{} and \q\  r\'esum\'e. % verdict
\end{abstract}
\section{Court}
One~\cite{court} $x_court$ two \emph{three}.

\begin{comment}
hidden words
\end{comment}
\iffalse hidden \fi
\begin{thebibliography}{9}\bibitem{a} hidden \end{thebibliography}
\end{document} after"""
    assert own_paragraphs(text) == [["the", "wave", "packet", "and", "quark", "resume"], ["one", "two", "three"]]
    assert own_paragraphs(None) == own_paragraphs("") == own_paragraphs(" \r\n ") == own_paragraphs(r"\input{x}") == []
    assert own_paragraphs("plain é text\r\n\r\nnext\\% part") == [["plain", "text"], ["next", "part"]]
    assert own_paragraphs("\\begin{comment} never closed") == []


def article(rng, *paragraphs):
    body = "\n\n".join(" ".join(rng.sample(FILL.split(), 8) + rng.choices(TOPICS[t].split(), k=4)) if t else FILL for t in paragraphs)
    return "\\begin{document}\n" + body + "\n\\end{document}"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    names = sorted(TOPICS)
    truth, docs = {}, []
    for i in range(480):
        a, b = rng.sample(names, 2)
        plan = [a] * 3 if i % 3 else [a, a, b]
        if i % 5 == 0:
            plan = [a, a, a, None, b]  # a passing remark
        truth[i] = {a, b} if i % 3 == 0 and i % 5 else {a}
        docs.append((i, article(rng, *plan), "en" if i % 7 else None, "s", "p"))
    docs += [(900, None, "en", "s", "p"), (901, "", None, "s", "p"), (902, "  ", "de", "s", "p"), (903, "\\begin{document}\\include{x}\\end{document}", "en", "s", "p"), (904, FILL, "en", "s", "p")]
    labels = [(i, t if i % 40 else rng.choice(names), "x") for i in range(0, 480, 5) for t in sorted(truth[i])] + [(0, None, "x"), (None, "law", "x"), (6, "no such", "x")]
    s = spark.createDataFrame([(n, n, None) for n in names] + [(None, "t", "n")], "subject string, title string, scope_note string")
    return truth, spark.createDataFrame(docs, "doc_id long, text string, lang string, subject string, labels string"), spark.createDataFrame(labels, "doc_id long, subject string, labeller string"), s


def test_held_out_accuracy(corpus):
    truth, docs, labels, listed = corpus
    got = {}
    for r in S.document_subjects(docs, labels, listed).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    assert sum(got.get(i) == t for i, t in truth.items()) >= 0.95 * len(truth)
    assert not {900, 901, 902, 903, 904} & set(got)


def test_edges(corpus):
    _, docs, labels, listed = corpus
    assert S.document_subjects(docs.limit(0), labels, listed).count() == 0
    assert S.document_subjects(docs, labels, listed.limit(0)).count() == 0
    once = S.document_subjects(docs, labels, listed).count()
    assert S.document_subjects(docs.union(docs), labels, listed).count() == 2 * once
    S.document_subjects(docs, labels.limit(0), listed).count()
    assert S.composition(S.document_subjects(docs, labels, listed)).count() == 6


def test_updates_raise_the_likelihood():
    rng = np.random.default_rng(0)
    profiles = rng.random((S.TERMS, 3)) * (np.arange(S.TERMS) < 50)[:, None]
    profiles /= profiles.sum(axis=0)
    rows, terms = np.repeat(np.arange(4), 10), np.tile(np.arange(10), 4)
    counts = rng.integers(1, 5, 40).astype(float)
    before = None
    for updates in (0, 1, 3, 10, 40):
        mixtures, seen, _ = S.fit_mixtures(rows, terms, counts, profiles, 5, updates)
        fit = np.einsum("ij,ij->i", mixtures[rows], seen)
        value = (counts * np.log(fit)).sum() - (mixtures @ profiles.sum(axis=0)).sum()
        assert before is None or value >= before - 1e-9
        before = value
    assert (mixtures[4] == 1).all()


def test_language():
    assert S.LANGUAGES[S.language_of([["der", "die", "haus"]], "en")] == "de"
    assert S.LANGUAGES[S.language_of([["haus"]], "fr")] == "fr" and S.LANGUAGES[S.language_of([], "xx")] == ""


def test_longer_lists_are_refused(spark, tmp_path, monkeypatch):
    from pagelattice.llm import queries

    spark.range(1001).selectExpr("cast(id as int) as capacity_id", "512 as capacity_tokens").write.parquet(str(tmp_path / "capacities.parquet"))
    with pytest.raises(ValueError):
        queries._capacities(spark, str(tmp_path))
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, subject string")
    listed = spark.range(1001).selectExpr("cast(id as string) as subject", "'' as title", "'' as scope_note")
    with pytest.raises(ValueError):
        S.document_subjects(docs, labels, listed)
