"""Token ids as directly addressable codes (operator 2).

A segment holds the ids of whole documents. Its ids are split into chunks of ``WIDTH`` bits, lowest first: level
0 has the first chunk of every id, level l + 1 the next chunk of those ids that have one, in order. Each level
has a bitmap of the ids that go on in the next level, and a rank directory with the number of ones before
every block of ``BLOCK`` bits. The chunk of id i on the next level stands at rank(i), so any id or range of ids
is read from a few places, with no block to decode.

Segment: magic, counts, document ids and first positions, then for each level its length, chunks, bitmap and
directory; numbers are little-endian. Spark writes segments in ascending doc_id order as rows of a Parquet
table in the shared folder, so a lost executor's segments are written again by the commit protocol.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bpe import PieceEncoder
from strata.llm.common import id_text, limit_batches, shared_path, text_rows

MAGIC, WIDTH, BLOCK = b"DAC1", 8, 512
SEGMENT_IDS = 1 << 18
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_WORKER: dict = {}


def pack(doc_ids: list, counts: list[int], ids: np.ndarray) -> bytes:
    """One segment; a null doc_id is written as the smallest long."""
    keys = np.array([-(1 << 63) if d is None else d for d in doc_ids], dtype="<i8")
    first = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    out, levels, v = [], 0, ids.astype("<u4")
    while True:
        more = v >> np.uint32(WIDTH)
        on = more > 0
        bits = np.packbits(on, bitorder="little")
        padded = np.pad(_ONES[bits].astype("<u4"), (0, -len(bits) % (BLOCK // 8)))
        ranks = np.concatenate([[0], np.cumsum(padded.reshape(-1, BLOCK // 8).sum(axis=1))]).astype("<u4")
        out += [struct.pack("<Q", len(v)), (v & np.uint32((1 << WIDTH) - 1)).astype(np.uint8).tobytes(),
                bits.tobytes(), ranks.tobytes()]
        levels += 1
        if not on.any():
            break
        v = more[on]
    return b"".join([MAGIC, struct.pack("<QQQ", len(keys), len(ids), levels), keys.tobytes(), first.tobytes(), *out])


class Segment:
    """Random access to a packed segment."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment")
        self.n_docs, self.n_ids, n_levels = struct.unpack_from("<QQQ", data, 4)
        at = 28

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.doc_ids, self.first = take("<i8", self.n_docs), take("<u8", self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            n = int(take("<u8", 1)[0])
            n_bits = -(-n // 8)
            self.levels.append((take(np.uint8, n), take(np.uint8, n_bits), take("<u4", -(-n_bits // (BLOCK // 8)) + 1)))

    def rank(self, level: int, i: int) -> int:
        """Ones before position i of a level's bitmap."""
        _, bits, ranks = self.levels[level]
        block, byte = i // BLOCK, i // 8
        out = int(ranks[block]) + int(_ONES[bits[block * (BLOCK // 8):byte]].sum())
        return out + (int(_ONES[bits[byte] & ((1 << i % 8) - 1)]) if i % 8 else 0)

    def __getitem__(self, i: int) -> int:
        out, shift = 0, 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            out |= int(chunks[i]) << shift
            if not bits[i // 8] >> i % 8 & 1:
                return out
            i, shift = self.rank(level, i), shift + WIDTH
        raise ValueError("damaged segment")

    def slice(self, a: int, b: int, level: int = 0) -> np.ndarray:
        """ids a to b, from one contiguous range of each level."""
        chunks, bits, _ = self.levels[level]
        out = chunks[a:b].astype("<u4")
        on = np.unpackbits(bits[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a].view(bool)
        if on.any():
            first = self.rank(level, a)
            out[on] |= self.slice(first, first + int(on.sum()), level + 1) << np.uint32(WIDTH)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.first[k]), int(self.first[k + 1]))


class FileEncoder:
    """ids as the tokenizer file's whole-text call gives them: by pieces, unless a text holds an added token."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.pieces = PieceEncoder(self.whole.model, pattern)
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = self.pieces.encode(texts)
        for i, t in enumerate(texts):
            if any(a in t for a in self.added):
                out[i] = np.array(self.whole.encode(t, add_special_tokens=False).ids, dtype=np.uint32)
        return out


def file_encoder(path: str, pattern: str) -> FileEncoder:
    """The worker's encoder for this file, made once."""
    if (path, pattern) not in _WORKER:
        _WORKER[path, pattern] = FileEncoder(path, pattern)
    return _WORKER[path, pattern]


def write(docs: DataFrame, tokenizer: str, pattern: str, end_id: int, out: str) -> None:
    """Encode whole texts, end each with ``end_id``, and write segments in ascending doc_id order to ``out``.

    Rows: part and segment number (their order is the order of the ids), ids before the segment in its part,
    number of ids, payload. Nulls first; rows that share a doc_id stand in text order.
    """
    limit_batches(docs.sparkSession)

    def run(batches):
        encoder, part = file_encoder(tokenizer, pattern), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=np.uint32)
        keys, arrays, held, before, number = [], [], 0, 0, 0

        def segment():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([held], pa.int64()),
                 pa.array([pack(keys, [len(a) for a in arrays], np.concatenate(arrays))], pa.large_binary())],
                schema=_SEGMENT)

        for ids, texts in text_rows(batches):
            for at in range(0, len(ids), 256):
                for k, a in zip(ids[at:at + 256], encoder.encode(texts[at:at + 256]), strict=True):
                    keys.append(k)
                    arrays.append(np.concatenate([a, end]))
                    held += len(a) + 1
                    if held >= SEGMENT_IDS:
                        yield segment()
                        before, number = before + held, number + 1
                        keys, arrays, held = [], [], 0
        if keys:
            yield segment()

    (id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, "part int, number int, before long, n_ids long, payload binary")
     .write.option("compression", "zstd").parquet(out))


_SEGMENT = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                      ("payload", pa.large_binary())])


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the segments alone.

    The driver gets one total for each part (a range partition of the writer), never anything of a document.
    """
    limit_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # rows are segments of some MB here
    stored = spark.read.parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").toArrow().to_pydict()
    base = dict(zip(totals["part"], np.cumsum([0, *totals["n"]])[:-1].tolist(), strict=True))

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                s = Segment(r["payload"])
                at = base[r["part"]] + r["before"]
                ids = memoryview(s.slice(0, s.n_ids).astype("<u4")).cast("B")
                first = s.first.astype(np.int64)
                crc = [zlib.crc32(ids[4 * x:4 * y]) for x, y in zip(first.tolist(), first[1:].tolist(), strict=False)]
                keys = [None if d == -(1 << 63) else d for d in s.doc_ids.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(first[:-1] + at), pa.array(np.diff(first)),
                     pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store(docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 2) -> DataFrame:
    """Write the ids of ``docs`` and read them back: (doc_id, start, n_tokens, ids_crc32).

    Null and empty texts hold the end id alone; null doc_ids come first; repeated rows are stored each; an
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "token-ids")
    write(docs, tokenizer, pattern, end_id, path)
    return read(spark, path)
