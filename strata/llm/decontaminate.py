"""Benchmark decontamination by size-partitioned MinHash containment search (operator 9).

Test items are short and documents long, so a document's own MinHash says little about an item in it. Items
are therefore partitioned by size: an item of q distinct shingles falls in the class of the power of two x
with x/2 < q <= x. For each class that has items, the shingles of the documents are cut into pieces of x, and
piece and item are compared under K hash functions: they are candidates if their minima agree under one.

Recall: let an item have a share c of its shingles in a document, wherever they stand. Under one function,
the chance that the item's minimum is in the document and is the minimum of its piece is at least
c * q / (q + x) >= c / 3; for c = 0.8 and K = 32 functions a pair is missed with a chance below 0.00005.
Every candidate is then verified by exact containment of shingle strings.

A benchmark of up to ``BLOCK_BYTES`` of text (measured before) is broadcast, and the work needs no shuffle. A larger
one stays distributed: the documents are read once, their minima that pass a Bloom filter of the items' minima
(``FILTER_BITS``, of fixed size) meet these in a join, and each document with candidates is verified beside them.
Both ways compare the same minima and give the same rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, keep_rows, limit_batches, shared_path, slices, text_rows, trim
from strata.llm.words import folded_words, hash_words, mix, shingle_hashes

FUNCTIONS = 32
BLOCK_BYTES, FILTER_BITS = 4 << 20, 1 << 26
SCHEMA = "doc_id long, item_id long, n_shingles long, n_found long, containment double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()),
                    ("n_found", pa.int64()), ("containment", pa.float64())])


def _strings(words: list[bytes], n: int) -> set[bytes]:
    if not words:
        return set()
    n = min(n, len(words))
    return {b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def item_minima(text: str, n: int, a: np.ndarray):
    """(shingles, words of a shingle, size class, a minimum for each function) of an item; None without words."""
    words = folded_words(text)
    own = _strings(words, n)
    if not own:
        return None
    # an item of fewer than n words is one shingle of its own length
    h = np.unique(shingle_hashes(hash_words(words), n))
    return own, min(n, len(words)), 1 << max(0, len(own) - 1).bit_length(), (h[None, :] * a[:, None]).min(axis=1)


def piece_minima(h: np.ndarray, a: np.ndarray, classes: list[int]):
    """(function, size class, the minimum of each piece) of the shingle hashes of documents."""
    for i in range(FUNCTIONS):
        v, have = h * a[i], 1
        for x in classes:
            pad = -len(v) % (x // have)
            if pad:
                v = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)])
            v, have = v.reshape(-1, x // have).min(axis=1), x
            yield i, x, v


def laid_out(texts: list[str], widths: list[int], classes):
    """For each width: (width, slices of the shingle hashes of all texts end to end with their first position, where each
    text starts, shingles a text). A slice is a multiple of every smaller piece, and keeps the arrays in cache."""
    hashes = [hash_words(folded_words(t)) for t in texts]
    for width in widths:
        own = [shingle_hashes(w, width) if len(w) >= width else w[:0] for w in hashes]
        start = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        flat = np.concatenate(own) if own else np.zeros(0, dtype=np.uint64)
        step = max(1 << 18, max(classes[width]))
        parts = [(at, flat[at:at + step]) for at in range(0, len(flat), step)]
        yield width, parts, start, len(flat)


def rows_of(start: np.ndarray, a: int, b: int) -> list[int]:
    """The texts that positions a to b (exclusive) touch."""
    first, last = np.searchsorted(start, a, "right") - 1, np.searchsorted(start, b - 1, "right") - 1
    return [r for r in range(int(first), int(last) + 1) if start[r + 1] > start[r]]


class ItemIndex:
    """The minima of a block of items, by size class and hash function, and their shingles for verification."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.n, self.shingles = n, {}
        self.a = _multipliers()
        by_class: dict[int, list] = defaultdict(list)
        for key, (item_id, text) in enumerate(items):
            if (found := item_minima(text, n, self.a)) is not None:
                own, width, x, minima = found
                self.shingles[key] = (item_id, own, width)
                by_class[width, x].append((key, minima))
        self.classes = {}
        for (width, x), rows in sorted(by_class.items()):
            minima = np.stack([m for _, m in rows], axis=1)  # function, item
            keys = np.array([k for k, _ in rows])
            tables = []
            for i in range(FUNCTIONS):
                order = np.argsort(minima[i], kind="stable")
                low = np.zeros(1 << 16, dtype=bool)
                low[(minima[i] & np.uint64(0xFFFF)).astype(np.int64)] = True
                tables.append((low, minima[i][order], keys[order]))
            self.classes.setdefault(width, {})[x] = tables

    def candidates(self, h: np.ndarray, width: int) -> list[tuple[int, int, int]]:
        """(first shingle, end, item key) of pieces that share a minimum with an item."""
        found, by_x = set(), self.classes[width]
        for i, x, v in piece_minima(h, self.a, sorted(by_x)):
            low, minima, keys = by_x[x][i]
            for p in np.flatnonzero(low[(v & np.uint64(0xFFFF)).astype(np.int64)]):
                a, b = np.searchsorted(minima, v[p], "left"), np.searchsorted(minima, v[p], "right")
                found.update((int(p) * x, (int(p) + 1) * x, int(k)) for k in keys[a:b])
        return sorted(found)

    def search(self, texts: list[str], threshold: float) -> list[tuple[int, int, int, int]]:
        """(row, item id, item's shingles, shingles found) for the texts that hold an item."""
        out = []
        for rows, part in slices(list(range(len(texts))), texts):
            out += [(rows[r], *hit) for r, *hit in self._search(part, threshold)]
        return out

    def _search(self, texts: list[str], threshold: float) -> list[tuple[int, int, int, int]]:
        pairs = set()
        for width, parts, start, end in laid_out(texts, list(self.classes), self.classes):
            for at, h in parts:
                for a, b, key in self.candidates(h, width):
                    b = min(at + b, end)
                    if at + a < b:
                        pairs.update((r, key) for r in rows_of(start, at + a, b))
        out, at, sets = [], None, {}
        for row, key in sorted(pairs):
            if row != at:
                at, sets, words = row, {}, folded_words(texts[row])
            item_id, shingles, width = self.shingles[key]
            if width not in sets:
                sets[width] = _strings(words, width)
            n = len(shingles & sets[width])
            if n >= threshold * len(shingles) - 1e-9:
                out.append((row, item_id, len(shingles), n))
        return out


def _item_rows(items: DataFrame) -> DataFrame:
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _block(items: DataFrame) -> list[tuple] | None:
    """All items, if they are at most BLOCK_BYTES; None otherwise."""
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    return [tuple(r) for r in items.collect()] if size <= BLOCK_BYTES else None


def _hit_columns(hits: list[tuple]) -> pa.RecordBatch:
    """(doc_id, item_id, n_shingles, n_found) as rows of the result."""
    cols = [pa.array([h[i] for h in hits], pa.int64()) for i in range(4)]
    return pa.RecordBatch.from_arrays([*cols, pa.array([h[3] / h[2] for h in hits], pa.float64())], schema=_ARROW)


_KEY = "cls int, fn int, low long"


def _filter_at(low: np.ndarray, cls: int, fn: int) -> np.ndarray:
    """The filter's bit for a minimum."""
    return (mix(low ^ np.uint64((cls << 8 | fn) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _indexed(items: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The items with a key for each row, and (key, cls, fn, low, bit): their minima by size class and function; written."""
    spark, path = items.sparkSession, shared_path(items.sparkSession, "items")
    items.withColumn("key", F.monotonically_increasing_id()).write.parquet(f"{path}/items")
    held = spark.read.parquet(f"{path}/items")

    def run(batches):
        a = _multipliers()
        for b in batches:
            out = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if (found := item_minima(text, n, a)) is not None:
                    cls = found[1] << 6 | found[2].bit_length()
                    out += [(key, cls, i, int(m.view(np.int64)), int(_filter_at(m[None], cls, i)[0])) for i, m in enumerate(found[3])]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                                             ["key", "cls", "fn", "low", "bit"])

    held.select("key", "text").mapInArrow(run, "key long, " + _KEY + ", bit long").write.parquet(f"{path}/minima")
    return held, spark.read.parquet(f"{path}/minima")


def _candidates(texts: DataFrame, minima: DataFrame) -> DataFrame:
    """(doc_id, text_key, key): the documents and items that share a minimum. The documents are read once."""
    spark = texts.sparkSession
    classes: dict[int, list[int]] = defaultdict(list)  # of each width; an item's size has at most 64 powers of two
    for r in sorted(minima.select("cls").distinct().collect()):
        classes[r["cls"] >> 6].append(1 << (r["cls"] & 63) - 1)
    words = minima.groupBy(F.shiftright("bit", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("b")).collect()  # at most FILTER_BITS / 64
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for r in words:
        table[r["w"]] = r["b"]
    shared, classes = spark.sparkContext.broadcast(table.view(np.uint64)), dict(classes)

    def run(batches):
        a, bits = _multipliers(), shared.value
        for ids, keys, texts in ((b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()) for b in batches):
            for rows, some in slices(list(range(len(texts))), texts):
                out = set()
                for width, parts, start, end in laid_out(some, sorted(classes), classes):
                    for at, h in parts:
                        for fn, x, v in piece_minima(h, a, classes[width]):
                            cls = width << 6 | x.bit_length()
                            bit = _filter_at(v, cls, fn)
                            on = bits[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)
                            for p in np.flatnonzero(on):
                                first, last = at + int(p) * x, min(at + (int(p) + 1) * x, end)
                                if first < last:
                                    out.update((rows[r], cls, fn, int(v[p].view(np.int64))) for r in rows_of(start, first, last))
                cols = [[ids[r] for r, *_ in out], [keys[r] for r, *_ in out], *([h[k] for h in out] for k in (1, 2, 3))]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 ["doc_id", "text_key", "cls", "fn", "low"])
        trim()

    found = texts.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, "doc_id long, text_key long, " + _KEY)
    return found.join(minima.select("key", "cls", "fn", "low"), ["cls", "fn", "low"]).select("doc_id", "text_key", "key").distinct()


def _joined(texts: DataFrame, items: DataFrame, n: int, threshold: float) -> DataFrame:
    """The hits of a large benchmark: (doc_id, text_key, item_id, n_shingles, n_found) for each distinct document and item row."""
    held, minima = _indexed(items, n)
    pairs = _candidates(texts, minima).join(held, "key").select(
        F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "item_id", F.col("text").alias("item"))
    pairs = pairs.withColumn("d", F.coalesce("d", F.lit(-(1 << 63))))
    wanted = pairs.select("d", "k").distinct()
    own = texts.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.xxhash64("text").alias("k"), "text").join(
        wanted, ["d", "k"], "left_semi").dropDuplicates(["d", "k"])

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for d, k, text in zip(*(c.to_pylist() for c in left.columns), strict=True):
            words, sets = folded_words(text), {}
            for item_id, item in zip(right.column("item_id").to_pylist(), right.column("item").to_pylist(), strict=True):
                mine = folded_words(item)
                width, shingles = min(n, len(mine)), _strings(mine, n)
                if width not in sets:
                    sets[width] = _strings(words, width)
                both = len(shingles & sets[width])
                if both >= threshold * len(shingles) - 1e-9:
                    out.append((d, k, item_id, len(shingles), both))
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(5)], names=["d", "k", "item_id", "n_shingles", "n_found"])

    hits = own.groupBy("d", "k").cogroup(pairs.groupBy("d", "k")).applyInArrow(
        verify, "d long, k long, item_id long, n_shingles long, n_found long")
    return hits


def find_contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment): documents holding at least ``threshold`` of an item.

    Words are folded (A-Z lowered; other ASCII signs than letters and digits end a word); an item of fewer
    words than the shingle counts as one shingle of all its words. Items and texts that are null, empty or
    without words match nothing; repeated items and repeated documents are reported each; an empty table of
    either kind gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    items, texts = _item_rows(items), id_text(docs)
    block = _block(items)
    if block is None:
        hits = _joined(texts, items, shingle, threshold)
        mine = texts.select("doc_id", F.xxhash64("text").alias("k"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"))
        out = mine.join(hits, ["d", "k"])
        return out.select("doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))
    shared = spark.sparkContext.broadcast(block)

    def search(batches):
        index = None
        for ids, rows in text_rows(batches):
            index = index or ItemIndex(shared.value, shingle)
            yield _hit_columns([(ids[r], *hit) for r, *hit in index.search(rows, threshold)])

    return texts.mapInArrow(search, SCHEMA)


def remove_contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents that hold no item, with all their columns; the rules of find_contaminated."""
    spark = docs.sparkSession
    limit_batches(spark)
    items = _item_rows(items)
    block = _block(items)
    if block is None:
        bad = _joined(id_text(docs), items, shingle, threshold).select(F.col("d").alias("__d"), F.col("k").alias("__k")).distinct()
        here = (F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))) == F.col("__d")) & (
            F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("__k"))
        return docs.join(bad, here, "left_anti")
    shared = spark.sparkContext.broadcast(block)

    def judge():
        index = ItemIndex(shared.value, shingle)

        def keeps(texts):
            bad = {r for r, *_ in index.search(texts, threshold)}
            return [i not in bad for i in range(len(texts))]

        return keeps

    return keep_rows(docs, judge)
