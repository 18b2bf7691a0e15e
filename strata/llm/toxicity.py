"""Toxicity from the nearest labelled examples by exact TF-IDF cosine (operator 8).

Fitting. Labelled rows outside the held-out fold (crc32 of the id's text mod 4 is not 2) give at most
``PER_CLASS`` examples of each class, the first by a hash of their ids: a documented bound, so the sample may be
broadcast. Rows that share an id are one example, by the text of the smallest hash. Terms are folded words and word beginnings of 4 to 8 bytes, and a term that stands 2, 3 or 5 times in a
text is a term of its own each time; kept are all terms that mark label 1 in the examples by chi-squared and lift
(``MIN_CHI2``, ``MIN_LIFT``, ``MIN_EXAMPLES``); the sample bounds their number. Their document frequencies are counted over all documents.

Most texts hold none of these. They are compared with the examples that hold none either, over a general vocabulary: all
words that stand in ``MIN_EXAMPLES`` examples or more and at most a share of ``COMMON`` of them, weighed by 1 + log(times)
and idf. Their document frequencies too are counted over all documents, in the same pass.

Scoring. Examples are unit TF-IDF vectors in an inverted index cut into blocks of ``BLOCK`` examples (``WIDE`` in the
general index), with the
largest weight of each term in each block. A text's blocks are visited by their upper bound until the bound is
below the k-th best cosine, so the k nearest (and all ties of the last) are exact. Neighbours vote with squared
cosine, weighed back to the classes' shares among the labels, and shrunk to the share of label 1: of all examples, or
in the general index of those in it. A text without any term of either kind gets that last share. The
nearest ids are the evidence.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, keep_rows, limit_batches, shared_checkpoint, text_rows
from strata.llm.words import folded_words

PER_CLASS, MIN_CHI2, MIN_LIFT, MIN_EXAMPLES = 3000, 25.0, 4.0, 3
NEIGHBOURS, BLOCK, SHRINK, THRESHOLD = 25, 64, 1.0, 0.3
COMMON, COMMON_LEAST, WIDE = 0.02, 10, 512
EXAMPLE_PARTS = 12  # the sample is bounded, and so are its files
BEGINNINGS, TIMES = (4, 5, 6, 7, 8), (2, 3, 5)


def terms_of(words: list[bytes]) -> set[bytes]:
    """The words, the beginnings of longer words (marked by *), and what stands several times (marked by the times)."""
    n = Counter(words)
    for k in BEGINNINGS:
        n.update([w[:k] + b"*" for w in words if len(w) > k])
    return set(n) | {b"%s#%d" % (t, times) for t, c in n.items() if c > 1 for times in TIMES if c >= times}


class Index:
    """Unit vectors (terms, weights), in blocks of ``WIDE``, with the largest weight of each term in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        n_blocks = -(-len(vectors) // WIDE)
        self.bound = np.zeros((n_blocks, n_terms), dtype=np.float64)
        self.blocks = []
        for b in range(n_blocks):
            own = vectors[b * WIDE:(b + 1) * WIDE]
            t, w = np.concatenate([t for t, _ in own]), np.concatenate([w for _, w in own])
            at = np.repeat(np.arange(len(own)), [len(t) for t, _ in own])
            order = np.argsort(t, kind="stable")
            t, w, at = t[order], w[order], at[order]
            np.maximum.at(self.bound[b], t, w)
            self.blocks.append((np.searchsorted(t, np.arange(n_terms + 1)).astype(np.int32), at.astype(np.int32), w))

    def cosines(self, b: int, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Of all examples of a block."""
        first, at, w = self.blocks[b]
        start, n = first[terms], first[terms + 1] - first[terms]
        places = np.arange(n.sum()) + np.repeat(start - np.cumsum(n) + n, n)
        return np.bincount(at[places], w[places] * np.repeat(weights, n), minlength=WIDE)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """(cosine, number) of the k nearest with a cosine over 0, and ties of the last."""
        bounds = self.bound[:, terms] @ weights
        best, kth = [], 0.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or bounds[b] < kth - 1e-12:
                break
            sims = self.cosines(b, terms, weights)
            best += [(float(sims[i]), int(b) * WIDE + int(i)) for i in np.flatnonzero(sims > max(0.0, kth - 1e-12))]
            if len(best) >= k:
                best.sort(key=lambda r: (-r[0], r[1]))
                kth = best[k - 1][0]
                best = [r for r in best if r[0] >= kth - 1e-12]
        best.sort(key=lambda r: (-r[0], r[1]))
        return best


class General:
    """The general vocabulary with its idf, and the index of the examples without a kept term."""

    def __init__(self, idf: dict[bytes, float], examples: list[tuple[int, int, list[int], list[int]]]):
        self.number = {t: i for i, t in enumerate(sorted(idf))}
        self.idf = np.array([idf[t] for t in sorted(idf)])
        # examples that share their most common terms (a language's) stand together, so few blocks are near a text
        common = np.argsort(np.argsort(self.idf, kind="stable"), kind="stable")
        held = [e for e in examples if len(e[2])]
        held.sort(key=lambda e: (sorted(common[e[2]].tolist())[:4], e[0]))
        self.ids, self.labels = [k for k, *_ in held], [y for _, y, *_ in held]
        self.index = Index([self.unit(np.array(t), np.array(n)) for _, _, t, n in held], len(idf))

    def counts(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """The numbers of a text's terms, ascending, and how often each stands in it."""
        number = self.number
        n = Counter(number[w] for w in words if w in number)
        terms = sorted(n)
        return terms, [n[t] for t in terms]

    def unit(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(times)) * self.idf[terms]
        return terms, w / np.sqrt((w * w).sum())


class Model:
    """Kept terms with their idf, and the examples' index; ``general`` for texts without a kept term."""

    def __init__(self, idf: dict[bytes, float], examples: list[tuple[int, int, list[int]]],
                 weights: tuple[float, float], prior: float, general: General | None = None):
        self.general = general
        self.number = {t: i for i, t in enumerate(sorted(idf))}
        self.idf = np.array([idf[t] for t in sorted(idf)])
        self.starts = {t.partition(b"#")[0].rstrip(b"*")[:min(BEGINNINGS)] for t in idf}
        self.prior, self.weights = prior, weights
        # examples with equal vectors stand together, so few blocks hold what a text needs
        rows = sorted((sorted(own), y, k) for k, y, own in examples)
        empty = [y for tf, y, _ in rows if not tf]
        rows = [r for r in rows if r[0]]
        w = sum(weights[y] for y in empty)
        self.no_term = (sum(weights[1] for y in empty if y) + SHRINK * prior) / (w + SHRINK)
        self.ids = np.array([k for _, _, k in rows], dtype=np.int64)
        self.labels = np.array([y for _, y, _ in rows], dtype=np.int64)
        n_blocks = -(-len(rows) // BLOCK)
        self.bound = np.zeros((len(idf), max(1, n_blocks)))
        self.postings: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        held: dict[tuple[int, int], list] = {}
        for e, (tf, _, _) in enumerate(rows):
            for t, v in self._unit(tf):
                held.setdefault((t, e // BLOCK), []).append((e % BLOCK, v))
        for (t, b), own in held.items():
            at, v = np.array([a for a, _ in own]), np.array([v for _, v in own])
            self.postings[t, b] = (at, v)
            self.bound[t, b] = v.max()
        self.seen: dict[tuple, tuple[float, list[int]]] = {}

    def _unit(self, terms) -> list[tuple[int, float]]:
        norm = math.sqrt(sum(self.idf[t] ** 2 for t in terms)) or 1.0
        return [(t, self.idf[t] / norm) for t in terms]

    def vector(self, words: list[bytes]) -> tuple:
        """The numbers of the kept terms among a text's words."""
        starts, n, number = self.starts, min(BEGINNINGS), self.number
        near = [w for w in words if w[:n] in starts]
        return tuple(sorted(number[t] for t in terms_of(near) if t in number)) if near else ()

    def nearest(self, tf: tuple, k: int) -> list[tuple[float, int]]:
        """(cosine, example) of the k nearest examples with a cosine over 0, and ties of the last."""
        q = self._unit(tf)
        bounds = sum(x * self.bound[t] for t, x in q)
        best, kth = [], 0.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or bounds[b] < kth - 1e-12:
                break
            sims = np.zeros(BLOCK)
            for t, x in q:
                if (t, b) in self.postings:
                    at, v = self.postings[t, b]
                    sims[at] += x * v
            best += [(float(sims[i]), int(b) * BLOCK + int(i)) for i in np.flatnonzero(sims > max(0.0, kth - 1e-12))]
            if len(best) >= k:
                best.sort(key=lambda r: (-r[0], r[1]))
                kth = best[k - 1][0]
                best = [r for r in best if r[0] >= kth - 1e-12]
        best.sort(key=lambda r: (-r[0], r[1]))
        return best

    def score(self, text: str) -> tuple[float, list[int]]:
        """The calibrated score, and the ids of the three nearest examples."""
        words = folded_words(text)
        tf = self.vector(words)
        if not tf:
            return self._by_general(words)
        if tf not in self.seen:
            got = self._vote(self.nearest(tf, NEIGHBOURS), self.ids, self.labels, self.prior)
            if len(self.seen) > 100_000:
                self.seen.clear()
            self.seen[tf] = got
        return self.seen[tf]

    def _by_general(self, words: list[bytes]) -> tuple[float, list[int]]:
        terms, times = self.general.counts(words) if self.general else ((), ())
        if not terms:
            return self.no_term, []
        near = self.general.index.nearest(*self.general.unit(np.array(terms), np.array(times)), NEIGHBOURS)
        return self._vote(near, self.general.ids, self.general.labels, self.no_term)

    def _vote(self, near: list[tuple[float, int]], ids, labels, prior: float) -> tuple[float, list[int]]:
        votes = [(s * s * self.weights[labels[e]], labels[e]) for s, e in near]
        total = sum(w for w, _ in votes)
        return (float((sum(w for w, y in votes if y) + SHRINK * prior) / (total + SHRINK)),
                [int(ids[e]) for _, e in near[:3]])


def held_out(doc_id):
    """True for the fold that labels are never learned from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``labels`` (doc_id, toxic 0/1); several labels of a document count as their largest.

    Labels that are null, in the held-out fold or of absent documents teach nothing; without examples of both
    classes no term is kept and every text gets the same score.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    docs = id_text(docs)
    known = (labels.select(F.col("doc_id").cast("long").alias("k"), F.col("toxic").cast("int").alias("toxic"))
             .where("toxic IN (0, 1) AND k IS NOT NULL").where(~held_out(F.col("k")))
             .groupBy("k").agg(F.max("toxic").alias("toxic")))
    n_known = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("toxic") == y).orderBy(F.xxhash64("k"), "k").limit(PER_CLASS)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = shared_checkpoint(chosen)
    # of rows that share an id one text, so that the examples are no more than the chosen ids
    examples = (docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("k")).groupBy("doc_id", "toxic")
                .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")))
    examples = shared_checkpoint(examples.select("doc_id", "least.text", "toxic").repartition(EXAMPLE_PARTS))

    def count(batches):
        for b in batches:
            n = {0: Counter(), 1: Counter()}
            for text, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                n[y].update(terms_of(folded_words(text)))
                n[y][b" "] += 1  # the examples of the class
            terms = list(n[0].keys() | n[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.binary()), pa.array([n[1][t] for t in terms], pa.int64()),
                 pa.array([n[0][t] for t in terms], pa.int64())], names=["term", "n1", "n0"])

    counts = shared_checkpoint(examples.mapInArrow(count, "term binary, n1 long, n0 long")
                               .groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))
    total = counts.where(F.col("term") == F.lit(b" ")).first()
    n1, n0 = (total["n1"], total["n0"]) if total else (0, 0)
    a, b = F.col("n1").cast("double"), F.col("n0").cast("double")
    under = (a + b) * (n1 + n0 - a - b) * float(n1) * float(n0)
    chi2 = F.when(under > 0, float(n1 + n0) * F.pow(a * (n0 - b) - b * (n1 - a), F.lit(2.0)) / under)
    kept = (counts.where((F.col("n1") >= MIN_EXAMPLES) & (F.length("term") > 1) & (a * n0 >= MIN_LIFT * b * n1))
            .withColumn("chi2", chi2).where(F.col("chi2") >= MIN_CHI2).select("term").collect())
    terms = sorted(bytes(r["term"]) for r in kept)
    # whole words alone, of neither too few nor too many examples; the sample bounds their number
    both = F.col("n1") + F.col("n0")
    words = counts.where((both >= MIN_EXAMPLES) & (both <= max(COMMON * (n1 + n0), COMMON_LEAST)) & ~F.contains("term", F.lit(b"#"))
                         & ~F.contains("term", F.lit(b"*")) & (F.col("term") != F.lit(b" "))).select("term").collect()
    general = sorted({bytes(r["term"]) for r in words} - set(terms)) if n1 and n0 else []
    blank = Model({t: 1.0 for t in terms}, [], (1.0, 1.0), 0.0, General({t: 1.0 for t in general}, []))
    shared = spark.sparkContext.broadcast(blank)
    after = len(terms)  # numbers of general terms in the counts below

    def frequency(batches):
        model, n, docs_seen = shared.value, Counter(), 0
        number = model.general.number
        for _, texts in text_rows(batches):
            docs_seen += len(texts)
            for t in texts:
                own = folded_words(t)
                n.update(model.vector(own))
                n.update([after + number[w] for w in set(own) if w in number])
        n[-1] = docs_seen
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())],
                                         names=["term", "n"])

    df = {r["term"]: r["n"] for r in docs.mapInArrow(frequency, "term long, n long")
          .groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs = max(1, df.get(-1, 0))
    idf = {t: math.log((1 + n_docs) / (1 + df.get(i, 0))) + 1 for i, t in enumerate([*terms, *general])}

    def vectors(batches):
        model = shared.value
        for b in batches:
            words = [folded_words(t) for t in b.column(1).to_pylist()]
            own = [model.vector(w) for w in words]
            wide = [((), ()) if v else model.general.counts(w) for v, w in zip(own, words, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), *(pa.array(x, pa.list_(pa.int32())) for x in (own, [t for t, _ in wide], [n for _, n in wide]))],
                names=["doc_id", "y", "terms", "words", "times"])

    found = examples.mapInArrow(vectors, "doc_id long, y int, terms array<int>, words array<int>, times array<int>").orderBy("doc_id").collect()
    rows = [(r["doc_id"], r["y"], list(r["terms"])) for r in found]
    wide = General({t: idf[t] for t in general}, [(r["doc_id"], r["y"], list(r["words"]), list(r["times"])) for r in found if not r["terms"]])
    have = Counter(y for _, y, _ in rows)
    weights = [n_known.get(y, 0) / have[y] if have[y] else 1.0 for y in (0, 1)]
    weights = (weights[0] / weights[1], 1.0)  # what an example stands for, in examples of label 1
    prior = (n_known.get(1, 0) + 0.5) / (sum(n_known.values()) + 1)
    return Model({t: idf[t] for t in terms}, rows, weights, prior, wide)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence): every document's toxicity by a model of ``fit``.

    Null and empty texts get the score of texts without any term; a null doc_id keeps its row; repeated rows
    are scored each; an empty table gives no rows; columns other than doc_id and text are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        for ids, texts in text_rows(batches):
            own = [model.value.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([s for s, _ in own], pa.float64()),
                 pa.array([int(s >= THRESHOLD) for s, _ in own], pa.int32()),
                 pa.array([e for _, e in own], pa.list_(pa.int64()))],
                names=["doc_id", "score", "predicted", "evidence"])

    out = id_text(docs).mapInArrow(run, "doc_id long, score double, predicted int, evidence array<long>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


def keep_harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``score`` does not predict toxic, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def judge():
        return lambda texts: [model.value.score(t)[0] < THRESHOLD for t in texts]

    return keep_rows(docs, judge)
