"""Fill-in-middle transformation (operator 13): whole texts cut at unit ends into prefix, middle and suffix.

A unit is a line with its ``\\n``, or what follows the last one. A task looks at the UTF-8 bytes of a whole Arrow
batch as 64-bit words: arithmetic on a word marks the bytes that end a unit (bit 7 of each), ``bitwise_count``
and a running sum give the marks before every word, a binary search of that sum finds the word of the k-th
mark, and the mark inside the word is resolved by clearing lower ones. Code points are counted by the same
ranks, over the bytes that start one. Nothing is shuffled; a row's result depends on its id and text alone.

Null texts are empty, empty texts and texts that hold a sentinel are ``plain`` (output is the text itself). A
null doc_id draws as the empty string does. Rows that share an id draw alike, each cut by its own units; other
columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import limit_batches, trim

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_HIGH, _LOW7 = np.uint64(0x8080808080808080), np.uint64(0x7F7F7F7F7F7F7F7F)
_ONES, _1, _8 = np.uint64(0x0101010101010101), np.uint64(1), np.uint64(8)


def as_words(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, zeros at the end, and one more word so that any end can be looked up."""
    out = np.zeros(len(data) // 8 + 2, dtype="<u8")
    out.view(np.uint8)[:len(data)] = data
    return out


def byte_marks(words: np.ndarray, byte: int) -> np.ndarray:
    """Bit 7 of every byte that equals ``byte``: exact, no carry crosses a byte."""
    x = words ^ (_ONES * np.uint64(byte))
    return ~(((x & _LOW7) + _LOW7) | x | _LOW7)


def start_marks(words: np.ndarray) -> np.ndarray:
    """Bit 7 of every byte that starts a code point (all but 10xxxxxx)."""
    return _HIGH & ~(words & ~(words << _1))


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before each byte position."""
        word = at >> 3
        below = (_1 << ((at & 7).astype(np.uint64) * _8)) - _1
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Byte position of the mark that has ``nth`` marks before it."""
        word = np.searchsorted(self.before, nth, side="right") - 1
        left, x = nth - self.before[word], self.marks[word]
        while (left > 0).any():
            x = np.where(left > 0, x & (x - _1), x)
            left = left - 1
        lowest = x & (~x + _1)
        return (word << 3) + (np.bitwise_count(lowest - _1) >> 3)


def _draws(ids: list, seed: int) -> np.ndarray:
    """Four numbers a row: the first 8-digit groups of the sha256 of ``seed:doc_id``."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).digest()[:16] for k in ids)
    return np.frombuffer(raw, dtype=">u4").astype(np.int64).reshape(-1, 4)


def cut(data: np.ndarray, ends: np.ndarray, draws: np.ndarray):
    """Units of each text, and where its prefix and middle end (bytes), for texts laid end to end in ``data``.

    ``ends`` has one entry more than there are texts: text i is data[ends[i]:ends[i + 1]].
    """
    words = as_words(data)
    lines, first, last = Marks(byte_marks(words, 10)), ends[:-1], ends[1:]
    before, upto = lines.rank(first), lines.rank(last)
    open_end = (last > first) & (data[np.maximum(last, 1) - 1] != 10) if len(data) else np.zeros(len(first), bool)
    n = upto - before + open_end
    a, b = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)

    def place(k):
        out = np.where(k == 0, first, last)
        inner = (k > 0) & (k <= upto - before)  # these units end in a newline; a last one without ends the text
        out[inner] = lines.select((before + k - 1)[inner]) + 1
        return out

    return n, place(np.minimum(a, b)), place(np.maximum(a, b)), Marks(start_marks(words))


def _batch(ids: list, texts: pa.Array, seed: int, rate: int, spm: int) -> pa.RecordBatch:
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    draws = _draws(ids, seed)
    n, p, m, starts = cut(whole, ends, draws)
    chars = starts.rank(np.stack([ends[:-1], p, m]))
    raw, tags = whole.tobytes(), [t.encode() for t in (PREFIX, SUFFIX, MIDDLE)]
    forms, outs = [], []
    for i, (h3, h4) in enumerate(draws[:, 2:].tolist()):
        s, e = int(ends[i]), int(ends[i + 1])
        if s == e or h3 % 100 >= rate or any(raw.find(t, s, e) >= 0 for t in tags):
            forms.append("plain")
            outs.append(raw[s:e])
            continue
        head, mid, tail = raw[s:p[i]], raw[p[i]:m[i]], raw[m[i]:e]
        is_spm = h4 % 100 < spm
        forms.append("spm" if is_spm else "psm")
        outs.append(b"".join((tags[1], tail, tags[0], head) if is_spm else (tags[0], head, tags[1], tail))
                    + tags[2] + mid)
    plain = np.array([f == "plain" for f in forms], dtype=bool)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
         pa.array(chars[1] - chars[0], pa.int64(), mask=plain), pa.array(chars[2] - chars[1], pa.int64(), mask=plain),
         pa.array(outs, pa.binary())], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """(doc_id, n units, form, prefix_chars, middle_chars, output) of each row's whole text.

    ``rate`` of 100 texts are transformed, ``spm`` of 100 of these are written suffix first; the draws come from
    the hash of ``seed`` and doc_id. The character counts are null in plain rows.
    """
    limit_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _batch(b.column(0).to_pylist(), b.column(1).cast(pa.binary()), seed, rate, spm)
        trim()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The exact text again, from output and form: each sentinel stands once in a transformed output."""

    def between(a: str, b: str) -> Column:
        return F.substring_index(F.substring_index(output, b, 1), a, -1)

    mid = F.substring_index(output, MIDDLE, -1)
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), mid, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), mid, between(SUFFIX, PREFIX)))
            .otherwise(output))
