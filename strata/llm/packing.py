"""Packing of documents into training sequences by cutting-stock column generation (operator 12).

1. ``pieces``: tasks encode whole texts, end each with ``end_id`` and cut it into pieces of ``SIZE`` tokens and what
   is left. Pieces carry a rank: how many of their length the same task has made before. They are written once
   to the shared folder, so ranks are fixed.
2. ``plan``: the histogram of lengths (at most ``SIZE`` numbers) goes to the driver, where lengths are classed by
   ``GRID``. A linear program over patterns (how many pieces of each class a sequence holds) covers the histogram
   with the fewest sequences: a simplex basis of one column a class, priced by an unbounded knapsack's dynamic
   program over the duals, until no pattern improves it, the bound is within ``GAP``, or ``PIVOTS`` steps are made
   (any step's patterns are right, later ones waste less). Patterns are used in whole multiples, rounded down.
   What is left, a few pieces for each pattern, is packed first-fit decreasing. Then some of the
   sequences with ``LOOSE`` or more tokens of room are taken apart and cut to fill the others; what is left of them,
   less than a sequence, becomes sequences of powers of two, which need no padding.
3. ``assign``: ranks count the pieces of a length over all tasks, by one running sum of counts a task; a range of
   ranks of a length has its pattern, its sequences and its place there, so pieces find theirs by a join with the
   plan. The plan's size depends on ``SIZE`` alone, not on the data.

Null texts are empty: a document of the end token alone. Rows that share an id are documents of their own. Empty
tables give no rows; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bpe import RUN
from strata.llm.common import id_text, limit_batches, shared_path, slices, text_rows
from strata.llm.token_store import file_encoder

#: Tokens of a sequence; step of the length classes; the program's gap and steps; gaps that are filled by cutting.
SIZE, GRID, GAP, PIVOTS, LOOSE = 2048, 4, 2e-4, 1000, 16
PIECES = "doc_id long, doc_tokens long, start long, length int, width int, ids binary, part int, nth long"
PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
PLAN = "p_length int, lo long, hi long, cut_from int, cut_to int, sequence long, offset int"


def pieces(docs: DataFrame, tokenizer: str, pattern: str, end_id: int, size: int = SIZE) -> DataFrame:
    """The pieces of all documents (``PIECES``), written and reread. ids are little-endian numbers of ``width`` bytes: 2
    where all ids of the file and ``end_id`` fit, as the bytes are shuffled once, and 4 otherwise."""
    from tokenizers import Tokenizer

    limit_batches(docs.sparkSession)
    width = 2 if max(end_id, *Tokenizer.from_file(tokenizer).get_vocab().values()) < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = file_encoder(tokenizer, pattern), TaskContext.get().partitionId()
        end, made = np.array([end_id], dtype=f"<u{width}").tobytes(), [0] * (size + 1)
        for ids, texts in text_rows(batches):
            for keys, some in slices(ids, texts, RUN):
                rows = []
                for k, tokens in zip(keys, encoder.encode(some), strict=True):
                    raw = tokens.astype(f"<u{width}").tobytes() + end
                    n = len(raw) // width
                    for at in range(0, n, size):
                        length = min(size, n - at)
                        own = raw[width * at:width * (at + length)]
                        rows.append((k, n, at, length, width, own, part, made[length]))
                        made[length] += 1
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 [c.split()[0] for c in PIECES.split(", ")])

    path = shared_path(docs.sparkSession, "pieces")
    id_text(docs).mapInArrow(run, PIECES).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def knapsack(sizes: np.ndarray, values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of items (``sizes`` ascending) in ``room``, and its number of each."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            got = values[:k] + best[c - sizes[:k]]
            i = int(got.argmax())
            if got[i] > best[c]:
                best[c], last[c] = got[i], i
    counts, c = np.zeros(len(sizes), dtype=np.int64), room
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(best[room]), counts


def greedy_basis(sizes: np.ndarray, demand: np.ndarray, room: int) -> np.ndarray:
    """Patterns, one column a class, that start the simplex: each is filled from the largest class down with
    classes not used up yet, and used until one of them is, so the columns are triangular and feasible."""
    m = len(sizes)
    basis, left, active = np.zeros((m, m)), demand.astype(float).copy(), np.arange(m)
    for j in range(m):
        space, own = room, active
        while len(own) and space >= sizes[own[0]]:
            i = own[np.searchsorted(sizes[own], space, side="right") - 1]
            basis[i, j] = space // sizes[i]
            space -= int(basis[i, j] * sizes[i])
            own = own[:np.searchsorted(own, i)]
        held = active[basis[active, j] > 0]
        times = left[held] / basis[held, j]
        out = held[int(times.argmin())]
        left[held] = np.maximum(left[held] - times.min() * basis[held, j], 0)
        active = active[active != out]
    return basis


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP, pivots: int = PIVOTS):
    """Patterns (columns of whole numbers) and how often each is used, which cover ``demand``: the linear program's
    least number of sequences, up to ``gap`` or as far as ``pivots`` steps get. Also a lower bound of that number."""
    basis = greedy_basis(sizes, demand, room)
    inverse, cost = np.linalg.inv(basis), np.ones(len(sizes))
    used, bound = np.maximum(inverse @ demand, 0), float((sizes * demand).sum() / room)
    for _ in range(pivots):
        duals = cost @ inverse
        low = int(duals.argmin())
        if duals[low] < -1e-9:  # more of this class than asked for makes it cheaper: its surplus enters
            column, price = np.zeros(len(sizes)), 0.0
            column[low] = -1
        else:
            worth, column = knapsack(sizes, duals, room)
            price, total = 1.0, float(cost @ used)
            bound = max(bound, total / worth)
            if worth <= 1 + 1e-9 or total <= bound * (1 + gap):
                break
        d = inverse @ column
        ratios = np.full(len(sizes), np.inf)
        np.divide(used, d, out=ratios, where=d > 1e-9)
        row = int(ratios.argmin())
        used = np.maximum(used - ratios[row] * d, 0)
        used[row] = ratios[row]
        pivot = inverse[row] / d[row]
        inverse -= np.outer(d, pivot)
        inverse[row] = pivot
        basis[:, row], cost[row] = column, price
    return basis[:, cost > 0].round().astype(np.int64), used[cost > 0], bound


def first_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Indices of ``lengths`` (descending) in sequences, each put in the first that has room for it."""
    out, room = [], np.zeros(0, dtype=np.int64)
    for i, n in enumerate(lengths):
        at = int((room >= n).argmax()) if len(room) else 0
        if not len(room) or room[at] < n:
            at = len(out)
            out.append([])
            room = np.append(room, size)
        out[at].append(i)
        room[at] -= n
    return out


def _filled(groups: list[tuple], size: int) -> list[tuple]:
    """Plan rows of groups (times, slots): ``times`` sequences alike, whose slots (length, first rank) stand one
    after the other. Groups with less than ``LOOSE`` room stay; some of the others, large and empty ones, are cut up."""
    rows, sequence, loose = [], 0, []

    def put(times, slots):
        nonlocal sequence
        at = 0
        for n, r in slots:
            rows.append((n, r, r + times, 0, n, sequence, at))
            at += n
        sequence += times
        return sequence - times, times, at, size - at

    for times, slots in groups:
        fill = sum(n for n, _ in slots)
        if size - fill < LOOSE:
            put(times, slots)
        else:
            loose.append((fill, times, slots))
    loose.sort(key=lambda g: (g[1].bit_length(), -g[0]))  # large groups are cut up, so that few rows say how
    total = sum(fill * times for fill, times, _ in loose)
    whole, hosts, pool = total // size, [], []
    for _, times, slots in loose:
        kept = min(times, whole)
        whole -= kept
        if kept:
            hosts.append(put(kept, slots))
        if times > kept:
            pool += [(n, r + kept, times - kept, 0) for n, r in slots]
    hosts += [(sequence + k, 1, 0, 0) for k in range(whole)]
    hosts = [(s, t, at, size - at) for s, t, at, _ in hosts]
    sequence += whole
    for bit in range(size.bit_length()):  # less than a sequence: one for each bit of its length
        if total % size >> bit & 1:
            hosts.append((sequence, 1, 0, 1 << bit))
            sequence += 1
    # the largest group of each side first (by minus its number), so that large groups are not cut up by small ones
    free, items = [(-t, s, at, room) for s, t, at, room in hosts], [(-t, -n, r, done) for n, r, t, done in pool]
    heapq.heapify(free)
    heapq.heapify(items)
    while free:
        t, s, at, room = heapq.heappop(free)
        many, n, r, done = heapq.heappop(items)
        k, n = min(-t, -many), -n
        take = min(room, n - done)
        rows.append((n, r, r + k, done, done + take, s, at))
        if -t > k:
            heapq.heappush(free, (t + k, s + k, at, room))
        if room > take:
            heapq.heappush(free, (-k, s, at + take, room - take))
        if -many > k:
            heapq.heappush(items, (many + k, -n, r + k, done))
        if n > done + take:
            heapq.heappush(items, (-k, -n, r, done + take))
    return rows


def plan(counts: dict[int, int], size: int = SIZE, grid: int = GRID, gap: float = GAP) -> list[tuple]:
    """Where each piece goes: rows (``PLAN``): the pieces of a length with ranks lo to hi (exclusive), from token
    cut_from to cut_to, stand at ``offset`` in sequences sequence, sequence + 1 and so on, by rank."""
    groups = [(counts[size], [(size, 0)])] if counts.get(size) else []
    lengths = sorted(n for n in counts if 0 < n < size and counts[n])
    if not lengths:
        return _filled(groups, size)
    classes = sorted({-(-n // grid) for n in lengths})
    # within a class pieces are ranked by length, then by rank: [length, first class rank, end]
    spans: dict[int, list] = {c: [] for c in classes}
    for n in lengths:
        own = spans[-(-n // grid)]
        first = own[-1][2] if own else 0
        own.append((n, first, first + counts[n]))
    demand = np.array([spans[c][-1][2] for c in classes], dtype=float)
    patterns, used, _ = column_generation(np.array(classes), demand, size // grid, gap)
    nxt = [0] * len(classes)
    for j in np.argsort(-used, kind="stable"):
        held = [(i, int(k)) for i, k in enumerate(patterns[:, j]) if k > 0]
        times = min([int(used[j] + 1e-6)] + [(spans[classes[i]][-1][2] - nxt[i]) // k for i, k in held])
        if times < 1 or not held:
            continue
        slots = []  # (class, its first rank), one for each piece of the pattern
        for i, k in held:
            slots += [(classes[i], nxt[i] + t * times) for t in range(k)]
            nxt[i] += k * times
        edges = {0, times}  # between these, every slot has one length
        for c, first in slots:
            edges.update(a - first for _, a, _ in spans[c] if first < a < first + times)
        edges = sorted(edges)
        for a, b in zip(edges, edges[1:], strict=False):
            own = [(first + a, next(s for s in spans[c] if s[1] <= first + a < s[2])) for c, first in slots]
            groups.append((b - a, [(s[0], r - s[1]) for r, s in own]))
    left = [(n, r - a) for i, c in enumerate(classes) for n, a, b in spans[c] for r in range(max(a, nxt[i]), b)]
    left.sort(reverse=True)
    groups += [(1, [left[i] for i in p]) for p in first_fit([n for n, _ in left], size)]
    return _filled(groups, size)


def assign(made: DataFrame, size: int = SIZE, grid: int = GRID) -> DataFrame:
    """Every piece of the result: doc_id, start, length, ids (little-endian unsigned 32-bit numbers), doc_tokens,
    sequence_id, offset.

    ``made`` are the rows of ``pieces``, as written. A piece of the residue may be cut again.
    """
    spark = made.sparkSession
    per = made.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(F.col("part").alias("s_part"), F.col("length").alias("s_length"),
                        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    rows = spark.createDataFrame(plan(counts, size, grid), PLAN)
    ranked = (made.join(starts, (F.col("part") == F.col("s_part")) & (F.col("length") == F.col("s_length")))
              .withColumn("rank", F.col("first") + F.col("nth")))
    placed = ranked.join(F.broadcast(rows), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("lo"))
                         & (F.col("rank") < F.col("hi")))  # the plan's size is bounded by ``size``
    own, width = F.col("cut_to") - F.col("cut_from"), F.col("width")
    narrow = placed.select("width", "doc_id", (F.col("start") + F.col("cut_from")).alias("start"), own.cast("long").alias("length"),
                           F.substring("ids", F.col("cut_from") * width + 1, own * width).alias("ids"), "doc_tokens",
                           (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id"),
                           F.col("offset").cast("long").alias("offset"))
    return narrow.mapInArrow(_widened, PACKED)


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of a batch as 32-bit numbers; all pieces of a table have one width."""
    for b in batches:
        if not b.num_rows:
            continue
        width, ids = b.column(0)[0].as_py(), b.column(4)
        if width == 2:
            ends = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset:ids.offset + len(ids) + 1]
            data = np.frombuffer(ids.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].view("<u2").astype("<u4")
            ids = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((ends - ends[0]) * np.int32(2)), pa.py_buffer(data)])
        columns = b.columns[1:4] + [ids] + b.columns[5:]
        yield pa.RecordBatch.from_arrays(columns, b.schema.names[1:])


def pack(docs: DataFrame, tokenizer: str, pattern: str, end_id: int, size: int = SIZE) -> DataFrame:
    """Pieces of all documents with their places: see ``assign``."""
    return assign(pieces(docs, tokenizer, pattern, end_id, size), size)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the tokens of each sequence, at most ``SIZE`` of them, from the pieces of ``pack``."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(own, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))
