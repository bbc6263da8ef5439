"""Encoding of texts with a public byte-level BPE vocabulary.

A piece of text is merged with a priority queue of merge ranks over a doubly linked list of its symbols: the
queue holds (rank, position) of every adjacent pair that the vocabulary knows, and entries whose pair has changed
since are skipped when they surface. Ids decode by concatenating the vocabulary's byte strings.

Text is cut where white space follows other characters. No token reaches over such a cut, and what comes before
has no bearing on what comes after, so a stretch that was met before in the same worker is looked up.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Default place of the vocabulary; every function takes another as parameter.
VOCABULARY = os.environ.get("PAGELATTICE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.json")
# The pattern of pieces of this vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Stretches and pieces remembered in a worker before it starts afresh.
REMEMBERED = 300_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """A vocabulary file and its merge rules. Special tokens are never produced."""

    def __init__(self, path: str = VOCABULARY, data: bytes | None = None):
        if data is None:
            with open(path, "rb") as f:
                data = f.read()
        model = json.loads(data)["model"]
        letters = byte_letters()
        raw = {word: bytes(letters[c] for c in word) for word in model["vocab"] if all(c in letters for c in word)}
        self.ids = {b: model["vocab"][w] for w, b in raw.items()}
        self.strings = {i: b for b, i in self.ids.items()}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = raw[left], raw[right]
            self.ranks[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        self.pieces = regex.compile(PIECES)
        self.stretches = regex.compile(r"\s*\S+|\s+")
        self.known_stretches: dict[str, tuple[int, ...]] = {}
        self.known_pieces: dict[str, tuple[int, ...]] = {}

    def merge(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        symbols = [self.byte_ids[b] for b in data]
        n = len(symbols)
        if n < 2:
            return symbols
        after = list(range(1, n + 1))  # n: the end
        before = list(range(-1, n - 1))
        ranks = self.ranks
        queue = [(*found, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (found := ranks.get((a, b)))]
        heapify(queue)
        # entries are (rank, merged id, position, left id, right id)
        while queue:
            _, merged, i, a, b = heappop(queue)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # stale: one of the pair was merged meanwhile
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := ranks.get((merged, symbols[k])):
                    heappush(queue, (*found, i, merged, symbols[k]))
            h = before[i]
            if h >= 0 and (found := ranks.get((symbols[h], merged))):
                heappush(queue, (*found, h, symbols[h], merged))
        return [s for s in symbols if s >= 0]

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.known_pieces.get(piece)
        if ids is None:
            ids = tuple(self.merge(piece.encode("utf-8", "replace")))
            if len(piece) <= 64:
                if len(self.known_pieces) >= REMEMBERED:
                    self.known_pieces.clear()
                self.known_pieces[piece] = ids
        return ids

    def _stretch(self, stretch: str) -> tuple[int, ...]:
        ids = tuple(i for p in self.pieces.findall(stretch) for i in self._piece(p))
        if len(stretch) <= 64:
            if len(self.known_stretches) >= REMEMBERED:
                self.known_stretches.clear()
            self.known_stretches[stretch] = ids
        return ids

    def encode(self, text: str | None) -> array:
        """The ids of a text; none for null and empty ones."""
        out = array("i")
        if text:
            known, extend, new = self.known_stretches, out.extend, self._stretch
            for s in self.stretches.findall(text):
                extend(known.get(s) or new(s))
        return out

    def decode(self, ids) -> str:
        return b"".join(self.strings[i] for i in ids).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str = VOCABULARY, shared=None) -> Encoder:
    """The process's encoder of a vocabulary file, made once; from the broadcast bytes of the file, where they are given."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, None if shared is None else shared.value)
    return _ENCODERS[path]


def _shipped(df: DataFrame, path: str):
    """The vocabulary file, read by the driver, as a broadcast: workers need not have it."""
    sc = df.sparkSession.sparkContext
    held = sc.__dict__.setdefault("_pagelattice_vocabularies", {})
    if path not in held:
        with open(path, "rb") as f:
            held[path] = sc.broadcast(f.read())
    return held[path]


def _batches(path: str, shared, counts: bool):
    kind = pa.int32() if counts else pa.list_(pa.int32())
    limit = 1 << 22  # ids in a batch that goes back to the JVM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, shared)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            start, offsets, flat = 0, [0], array("i")
            for i, text in enumerate(texts):
                ids = enc.encode(text.as_py())
                if counts:
                    flat.append(len(ids))
                    continue
                flat.extend(ids)
                offsets.append(len(flat))
                if len(flat) >= limit:
                    yield _packed(keys.slice(start, i + 1 - start), offsets, flat)
                    start, offsets, flat = i + 1, [0], array("i")
            if counts:
                yield pa.RecordBatch.from_arrays([keys, pa.array(flat, kind)], names=["__key", "__out"])
            elif start < batch.num_rows:
                yield _packed(keys.slice(start), offsets, flat)

    return run, "array<int>" if not counts else "int"


def _packed(keys: pa.Array, offsets: list[int], flat: array) -> pa.RecordBatch:
    values = pa.Array.from_buffers(pa.int32(), len(flat), [None, pa.py_buffer(flat.tobytes())])
    return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=["__key", "__out"])


def encode_column(df: DataFrame, key: str, text: str, out: str = "ids", *, path: str = VOCABULARY, counts: bool = False) -> DataFrame:
    """key and the token ids of text (counts: their number), in one narrow pass without shuffle.

    Null and empty texts give an empty list (0). The whole text is encoded, however long. The ids are
    those of the vocabulary without special tokens; their strings in a text are ordinary text. Repeated
    rows and null keys come out as they come in; other columns are not read.
    """
    run, kind = _batches(path, _shipped(df, path), counts)
    key_type = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).mapInArrow(run, f"__key {key_type}, __out {kind}").select(F.col("__key").alias(key), F.col("__out").alias(out))


def decode_column(df: DataFrame, key: str, ids: str, out: str = "text", *, path: str = VOCABULARY) -> DataFrame:
    """key and the text of the ids; null for null. Bytes that are no UTF-8 become the replacement character."""

    shared = _shipped(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, shared)
        for b in batches:
            texts = [None if x is None else enc.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["__key", "__out"])

    key_type = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("__key"), F.col(ids).alias("__ids")).mapInArrow(run, f"__key {key_type}, __out string").select(F.col("__key").alias(key), F.col("__out").alias(out))
