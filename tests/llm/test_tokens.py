import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagelattice.llm import tokens as K

pytestmark = pytest.mark.skipif(not os.path.exists(K.VOCABULARY), reason="no vocabulary")
ODD = ["", " ", "\n\n a  b\t", "it's 'twas I'll", "<|endoftext|>", "x" * 3000, "日本語\u3000テキスト", "\U0001f600é\u0301 \x85\x1c ", "a\r\nb", "\u00a0\u2028 z", "1234567890 000", "    def f():\n\treturn\n"]


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(K.VOCABULARY)
    t.encode_special_tokens = True
    return t


def test_same_ids_as_the_library(library, read):
    texts = ODD + [r.text for r in read("documents").select("text").collect() if r.text]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert list(K.encoder().encode(text)) == want.ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(" \n\t'abAB1.é\u2003", max_size=60))
def test_any_text(text):
    import tokenizers

    t = tokenizers.Tokenizer.from_file(K.VOCABULARY)
    t.encode_special_tokens = True
    ids = list(K.encoder().encode(text))
    assert ids == t.encode(text, add_special_tokens=False).ids and K.encoder().decode(ids) == text


def naive(enc, data):
    """Merges the pair of least rank, leftmost first, until there is none."""
    s = [enc.byte_ids[b] for b in data]
    while True:
        best = min(((enc.ranks[p][0], i) for i, p in enumerate(zip(s, s[1:])) if p in enc.ranks), default=None)
        if best is None:
            return s
        i = best[1]
        s[i : i + 2] = [enc.ranks[s[i], s[i + 1]][1]]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40) | st.text("abehinrt", max_size=30).map(str.encode))
def test_queue_merges_as_the_rule_says(data):
    enc = K.encoder()
    assert enc.merge(data) == naive(enc, data)


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (2, "", "k"), (None, "a b", "k"), (4, " ".join(["lorem"] * 400_000), "k")], "doc_id long, text string, __key string")
    out = K.encode_column(df.drop("__key"), "doc_id", "text").collect()
    assert [len(r.ids) for r in out][:4] == [0, 0, 0, 2] and out[3].doc_id is None
    assert [r.n for r in K.encode_column(df, "doc_id", "text", "n", counts=True).collect()] == [len(r.ids) for r in out]
    back = K.decode_column(K.encode_column(df, "doc_id", "text"), "doc_id", "ids").collect()
    assert [r.text for r in back] == ["", "", "", "a b", " ".join(["lorem"] * 400_000)]
    assert K.encode_column(df.limit(0), "doc_id", "text").count() == 0


def test_memory_of_stretches_is_bounded(monkeypatch):
    monkeypatch.setattr(K, "REMEMBERED", 10)
    enc = K.Encoder()
    want = K.encoder().encode(" ".join(f"w{i}" for i in range(100)))
    assert enc.encode(" ".join(f"w{i}" for i in range(100))) == want and len(enc.known_stretches) <= 10
