"""SimHash near-dedup by covering locality-sensitive hashing (operator 3).

Fingerprints of 64 bits link at ``radius`` or fewer differing bits. The covering family: every bit position i
gets a non-zero vector m(i) of radius + 1 bits; table v, for each non-zero vector v, keeps the positions
with <m(i), v> = 1. The at most ``radius`` positions in which two linked fingerprints differ span less than
the whole space, so some v is orthogonal to all of them: that table sees equal keys. No pair is missed.

Work is on distinct fingerprints, so exact copies cost one row. A table's bucket of at most ``SMALL``
fingerprints is compared in place. A larger bucket (thousands of near copies) is not: for radius 2 its
fingerprints are sent to themselves and their 64 one-bit neighbours; two fingerprints share such a key exactly
if they differ in 2 bits or fewer, and a key has at most 65 fingerprints, which form a star. That is exact,
linear in the bucket, and leaves no large group in any task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, limit_batches, shared_checkpoint, text_rows
from strata.llm.components import connected_components

SMALL = 16


def fingerprint(text: str, shingle: int) -> int:
    """Bit b is set if it is set in over half the XXH64 (seed 42) of the shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, \x20 and \x09-\x0D only
    if not words:
        return 0
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(b" ".join(s), 42) for s in zip(*(words[i:] for i in range(n)), strict=False)),
                    dtype="<u8", count=len(words) - n + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint as a signed long; null or wordless texts have fingerprint 0."""
    limit_batches(docs.sparkSession)

    def run(batches):
        for ids, texts in text_rows(batches):
            fp = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "fp"])

    return id_text(docs).mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """One 64-bit mask for each non-zero vector of radius + 1 bits."""
    n = (1 << (radius + 1)) - 1
    vectors = [1 + i % n for i in range(64)]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct_fp: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints (column fp) just as all pairs within the radius do."""
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for t, m in enumerate(covering_masks(radius))))
    keyed = distinct_fp.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").withColumnsRenamed(
        {"t": "bt", "key": "bkey"})
    held = keyed.join(sizes, (F.col("t") == F.col("bt")) & (F.col("key") == F.col("bkey"))).select("fp", "t", "key", "n")
    held = shared_checkpoint(held)
    small = held.where(F.col("n") <= SMALL).groupBy("t", "key").agg(F.collect_list("fp").alias("l"))
    pairs = F.flatten(F.transform("l", lambda a: F.transform(
        F.filter("l", lambda b: (b > a) & (F.bit_count(a.bitwiseXOR(b)) <= radius)),
        lambda b: F.struct(a.alias("a"), b.alias("b")))))
    near = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    hot = held.where(F.col("n") > SMALL).select("fp").distinct()
    if radius == 2:
        flips = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)))
        stars = (hot.select("fp", F.explode(flips).alias("key")).groupBy("key")
                 .agg(F.min("fp").alias("a"), F.collect_list("fp").alias("l")).where(F.size("l") > 1)
                 .select("a", F.explode("l").alias("b")).where("a != b"))
        near = near.unionByName(stars)
    elif not hot.isEmpty():
        raise ValueError(f"buckets of over {SMALL} fingerprints need radius 2")
    return near.distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint hex, component_id): component_id is the smallest doc_id reachable by links.

    Null and wordless texts have fingerprint 0 and link like any other; a null doc_id keeps its row, and
    counts only where its component has no other id; repeated rows give repeated rows; an empty table gives
    no rows; other columns are not read.
    """
    fp = shared_checkpoint(fingerprints(docs, shingle))
    first = fp.groupBy("fp").agg(F.min("doc_id").alias("first"))
    comp = connected_components(links(first.select("fp"), radius))
    own = first.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    lowest = own.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = own.select("fp", "component").join(lowest, "component").select("fp", "component_id")
    return fp.join(labels, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents with the smallest doc_id of their component, all columns; a null doc_id always stays."""
    gone = near_duplicates(docs, shingle, radius).where("doc_id != component_id").select(
        F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
