"""Byte-level BPE encoding and decoding with the tokenizers library (operator 6).

A pattern cuts a text into pieces (words with the space before them, numbers, signs, white space), bytes
become the characters that stand for them, and the library's BPE model encodes each piece. Pieces mostly
recur, so each worker keeps the ids of some ``CACHE`` recent pieces (twice as many at most, and those of a run); that never changes a result.
Texts of Latin-1 characters go in runs of ``RUN`` characters: piece starts are found for the whole run at once
(``starts``), and each distinct piece of the run is looked up once. Other texts, and other patterns than ``SPLIT``,
are cut by regular expressions.

``encode`` gives ids, and on request the byte and character span of each id (one character may be split over
several ids; such ids share its span). ``decode`` reverses the byte table: ids give bytes, also where an id
holds part of a character, and whole texts come back exactly.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.common import id_text, limit_batches, text_rows

CACHE, RUN = 400_000, 4 << 20
#: The pattern that ``starts`` follows.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Of each Latin-1 character: 0 white space, 1 a sign, 2 a letter, 3 a number.
_KIND = np.array([next((k for k, c in ((0, r"\s"), (2, r"\p{L}"), (3, r"\p{N}")) if regex.match(c, chr(b))), 1)
                  for b in range(256)], dtype=np.uint8)
_WORKER: dict = {}


def byte_characters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def model_from_ranks(ranks: dict[bytes, int]):
    """A BPE model of the library that merges as the ranks say: every split of a token into two is a merge to it."""
    from tokenizers import models

    chars = byte_characters()
    shown = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = []
    for t, _ in sorted(ranks.items(), key=lambda x: x[1]):
        halves = [(t[:i], t[i:]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        merges += [(shown[a], shown[b]) for a, b in sorted(halves, key=lambda h: (ranks[h[0]], ranks[h[1]]))]
    return models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)


def _latin(pattern: str) -> str:
    """The pattern for texts of Latin-1 characters alone, in plain classes that re runs twice as fast as regex."""
    letters, numbers, spaces = (
        "".join(f"\\x{b:02x}" for b in range(256) if regex.match(c, chr(b))) for c in (r"\p{L}", r"\p{N}", r"\s"))
    return (pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]")
            .replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]"))


def starts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where ``SPLIT`` starts a piece, of Latin-1 characters; texts start at ``first`` (none is empty)."""
    kind = _KIND[data]
    new = np.ones(len(data), dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[first] = True
    # the last white space before something else is a piece of its own, or a space that belongs to what follows
    last = np.flatnonzero((kind[:-1] == 0) & new[1:])
    opens = np.zeros(len(data), dtype=bool)
    opens[first] = True
    last = last[~opens[last + 1]]
    new[last] = True
    new[last[data[last] == 32] + 1] = False
    quote = np.flatnonzero(data == 39)
    quote = quote[new[quote]]
    if len(quote):
        ends = np.append(first, len(data))
        room = ends[np.searchsorted(ends, quote, side="right")] - quote
        a, b = (np.append(data, np.zeros(2, dtype=np.uint8))[quote + i] for i in (1, 2))
        short = np.isin(a, np.frombuffer(b"stmd", dtype=np.uint8)) & (room > 1)
        long = (np.isin(a, np.frombuffer(b"rv", dtype=np.uint8)) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))) & (room > 2)
        for on, n in ((short, 2), (long, 3)):
            new[quote[on] + 1] = False
            end = quote[on] + n
            new[end[end < len(data)]] = True
    return new


class _Pieces(dict):
    """ids of pieces, as bytes; what is missing is made."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        self[piece] = ids = self.make(piece)
        return ids


class PieceEncoder:
    """ids of texts by the library's BPE model, called for each piece of the pattern that the worker doesn't hold.

    The library's pre-tokenizers carry offset tables through every step, which costs most of the time of a
    whole-text call; pieces are independent of each other, so the ids are the same.
    """

    def __init__(self, model, pattern: str):
        self.model, self.any, self.latin = model, regex.compile(pattern).findall, re.compile(_latin(pattern)).findall
        self.runs, self.kept, self.old = pattern == SPLIT, _Pieces(self._ids), {}
        self.shown = dict(enumerate(byte_characters()))

    def cut(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any(text)
        return self.latin(text)

    def _ids(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            if piece.isascii() and piece.isprintable():  # all but the space stand for themselves
                shown = piece.replace(" ", self.shown[32])
            else:
                shown = piece.encode("utf-8", "replace").decode("latin-1").translate(self.shown)
            ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        if len(self.kept) > CACHE:  # used pieces return from the old generation, others go with it
            self.old, self.kept = dict(self.kept), _Pieces(self._ids)
        return list(map(self.kept.__getitem__, pieces))

    def _encode_run(self, texts: list[bytes]) -> list[np.ndarray]:
        """ids of Latin-1 texts, none empty."""
        edges = np.cumsum([0, *map(len, texts)])
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        begin = np.flatnonzero(starts(data, edges[:-1]))
        offsets = np.append(begin, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        own = self._ids_of([p.decode("latin-1") for p in pieces.dictionary.to_pylist()])
        ids = pa.array(own, pa.large_binary()).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int64)[ids.offset:ids.offset + len(ids) + 1] // 4
        flat = np.frombuffer(ids.buffers()[2], dtype=np.uint32, count=int(ends[-1]))
        cuts = ends[np.searchsorted(begin, edges)].tolist()
        return [flat[x:y] for x, y in zip(cuts, cuts[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out, at, run, held = [np.zeros(0, dtype=np.uint32)] * len(texts), [], [], 0

        def flush():
            for i, ids in zip(at, self._encode_run(run), strict=True):
                out[i] = ids

        for i, t in enumerate(texts):
            try:
                data = t.encode("latin-1") if self.runs else None
            except UnicodeEncodeError:
                data = None
            if data is None:
                out[i] = np.frombuffer(b"".join(self._ids_of(self.cut(t))), dtype=np.uint32)
            elif data:
                at.append(i)
                run.append(data)
                held += len(data)
                if held >= RUN:
                    flush()
                    at, run, held = [], [], 0
        if run:
            flush()
        return out


class Codec:
    """Encoder and byte table of one vocabulary: ranks of a .tiktoken file and the pattern that splits text."""

    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self.encoder = PieceEncoder(model_from_ranks(ranks), pattern)
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.bytes[r] = t

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encoder.encode(texts)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.asarray(ids, dtype=np.uint32).tolist()))

    def spans(self, text: str, ids: list[int]) -> list[tuple[int, int, int, int]]:
        """(first byte, end byte, first character, end character) of each id; part of a character counts as it."""
        data = text.encode()
        at = np.cumsum([0, *(len(self.bytes[i]) for i in ids)]).tolist()
        lead = np.frombuffer(data, dtype=np.uint8)
        char = np.concatenate([np.cumsum((lead & 0xC0) != 0x80) - 1, [len(text)]])  # of each byte
        return [(int(a), int(b), int(char[a]), int(char[b - 1]) + 1) for a, b in zip(at, at[1:], strict=False)]


def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process and vocabulary."""
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = Codec(path, pattern)
    return _WORKER[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, spans: bool = False) -> DataFrame:
    """(doc_id, ids array<int>[, spans array<struct<byte_start,byte_end,char_start,char_end>>]) of whole texts.

    Null texts are empty and have no ids; repeated rows are encoded each; an empty table gives no rows; other
    columns are not read; a null doc_id keeps its row.
    """
    limit_batches(docs.sparkSession)

    def run(batches):
        c = codec(path, pattern)
        for ids, texts in text_rows(batches):
            coded = c.encode(texts)
            columns = [pa.array(ids, pa.int64()), pa.array([x.view(np.int32) for x in coded], pa.list_(pa.int32()))]
            if spans:
                kind = pa.list_(pa.struct([(n, pa.int32()) for n in _SPAN]))
                columns.append(pa.array([[dict(zip(_SPAN, s, strict=True)) for s in c.spans(t, i)]
                                         for t, i in zip(texts, coded, strict=True)], kind))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "spans"][:len(columns)])

    schema = "doc_id long, ids array<int>"
    if spans:
        schema += ", spans array<struct<" + ", ".join(f"{n}: int" for n in _SPAN) + ">>"
    return id_text(docs).mapInArrow(run, schema)


_SPAN = ("byte_start", "byte_end", "char_start", "char_end")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes binary) of (doc_id, ids); null ids give no bytes."""
    limit_batches(coded.sparkSession)

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([c.decode(i or []) for i in b.column(1).to_pylist()], pa.binary())],
                names=["doc_id", "bytes"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, its ids decoded, and digests of both."""
    limit_batches(docs.sparkSession)

    def run(batches):
        c = codec(path, pattern)
        shown = [str(i) for i in range(len(c.bytes))]
        for ids, texts in text_rows(batches):
            coded = c.encode(texts)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(x) for x in coded], pa.int64()),
                pa.array([hashlib.sha256(" ".join([shown[i] for i in x.tolist()]).encode()).hexdigest() for x in coded]),
                pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in coded])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
