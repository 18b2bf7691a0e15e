"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions alone (operator 10).

Tokens are runs of letters, digits and underscores, and runs of other signs. The one- and two-token grams of a
text are hashed to ``BUCKETS`` buckets. One multinomial is counted over the trusted target (all documents
labelled quality 1), one over the whole raw corpus, both in one pass. A text's score is the mean over its grams of the log-ratio of the two, so length does not
count, and every document is decided by the same threshold: no sampling, no random noise.

Counting ships at most ``BUCKETS`` pairs of partial sums a task. The table of log-ratios has a fixed size and reaches the
tasks as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, shared_checkpoint

BUCKETS, PRIOR, THRESHOLD = 1 << 13, 1000, -0.15
BROADCAST_IDS = 1 << 20
SPACES = r"[\x20\x09-\x0D]+"
_TOKENS = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]+"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pairs(values: Column, step: int) -> Column:
    """The hash of every value with the one ``step`` further on."""
    n = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b))


def grams(text: Column) -> Column:
    """The buckets of a text's one-token and then two-token grams."""
    def buckets(hashes):
        return F.transform(hashes, lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))

    tokens = F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0))
    return let(F.transform(tokens, lambda t: F.xxhash64(t)), lambda h: F.concat(buckets(h), buckets(_pairs(h, 1))))


def _doubled(step: int):
    return lambda h: _pairs(h, step)


def repeat_words(words: Column, width: int = 8) -> Column:
    """Words in a window of ``width`` (a power of two) words that stands twice or more, first included."""
    def of(hashes):
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(ordered, lambda s: F.filter(F.transform(s, lambda x, k: F.when(
            (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])), lambda i: i.isNotNull()))
        covered = F.aggregate(F.array_sort(twice), F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n")),
                              lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(width), i - a["last"])).alias("n")),
                              lambda a: a["n"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)

    # a window's hash from those of its halves; where no half stands twice, no window does
    hashes, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while 2 * step < width:
        hashes = let(hashes, _doubled(step))
        step *= 2
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
        let(_pairs(h, step), of)))


def base_features(text: Column) -> list[Column]:
    words = F.filter(F.split(text, SPACES, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return [let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")]


def log_ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row with ``table``: the log-ratio target to raw of every bucket.

    Raw counts are taken plus one; the target's shares are smoothed towards the raw ones by ``PRIOR`` grams, so
    where the target says little the ratio is near nought.
    """
    good = (labels.select(F.col("doc_id").cast("long").alias("k"), "quality").where("quality = 1 AND k IS NOT NULL")
            .select("k").distinct())
    good = shared_checkpoint(good)
    if good.count() <= BROADCAST_IDS:  # else the texts are shuffled to their labels
        good = F.broadcast(good)
    marked = docs.join(good, F.col("doc_id") == F.col("k"), "left")
    counts = (marked.select(F.col("k").isNotNull().cast("long").alias("own"), F.explode(grams(F.col("text"))).alias("bucket"))
              .groupBy("bucket").agg(F.sum("own").alias("t"), F.count("*").alias("r")))
    both = (docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
            .select("bucket", F.coalesce("t", F.lit(0)).alias("t"), F.coalesce("r", F.lit(0)).alias("r")))
    both = shared_checkpoint(both)
    sums = both.agg(F.sum("t").alias("nt"), F.sum("r").alias("nr")).first()
    share = (F.col("r") + 1) / F.lit(float(sums["nr"] + BUCKETS))
    ratio = F.log((F.col("t") + PRIOR * share) / (float(sums["nt"] + PRIOR) * share))
    return both.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", ratio.alias("v")))), lambda x: x["v"]).alias("table"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept).

    Null texts are empty: no word, base_failed, score 0, not kept. A null doc_id keeps its row; repeated rows
    are judged each; an empty table gives no rows; without trusted documents every
    ratio is nought; other columns are not read.
    """
    docs = id_text(docs)
    docs = docs.withColumn("__ratios", shared_checkpoint(log_ratios(docs, labels)).scalar())
    mean = let(grams(F.col("text")), lambda g: F.when(F.size(g) == 0, F.lit(0.0)).otherwise(
        F.aggregate(g, F.lit(0.0), lambda a, b: a + F.get(F.col("__ratios"), b)) / F.size(g)))
    out = docs.select("doc_id", *base_features(F.col("text")), mean.alias("score"))
    failed = (F.col("w.n_words") < 20) | (100 * F.col("w.n_repeat_words") > 30 * F.col("w.n_words"))
    return out.select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
                      failed.alias("base_failed"), "score", (~failed & (F.col("score") >= threshold)).alias("kept"))
