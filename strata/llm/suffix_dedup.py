"""Removal of repeated byte strings with a logarithmic family of suffix arrays (operator 1).

A byte of a document goes if a string of ``WINDOW`` bytes that covers it also starts in a document with a smaller
doc_id. Documents come in batches (what a task reads). A batch gets a suffix array, is merge-scanned against
the levels of the index that exist, and levels of equal size merge, so an entry is merged a logarithmic number
of times. The family is cut by the hash of a suffix's leading bytes, so that every part of it is small and is
kept by one task; a batch sends each part a sorted run.

Not every suffix is stored. A window's leader is its smallest hashed substring of ``LEAD`` bytes; successive
windows with one leader form a run of windows, and the run's string stands for them: about one entry for 14
bytes. Which windows form a run depends on the text alone, so equal strings give equal entries. Order is by the
hash of leader and string (a suffix order under a random alphabet). Where two entries are equal, the one with
the larger doc_id is marked: all its windows go.

Windows that a document shares although the runs around them differ (at the ends of copies) are settled in a
second round: runs with an equal leader but different strings send their single windows through a second
family. A window is thus removed exactly if a smaller doc_id holds it, up to equal 96-bit hashes.

Copies are combined where they are read: a batch sends one entry for equal strings, of the smallest doc_id, so
a hot string costs a part one entry for each batch. The marks of each round are checkpointed in the
cluster's shared folder and the round's shuffles dropped; texts meet their marks in parts of bounded size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_shuffles, id_text, limit_batches, shared_checkpoint, text_rows, trim

WINDOW, LEAD = 50, 24
SPREAD = WINDOW - LEAD + 1
LONGEST_RUN = 32  # of windows; longer runs (periodic texts) are cut
BATCH_BYTES, PIECE_BYTES, PART_BYTES, BUCKET_BYTES = 8 << 20, 1 << 20, 8 << 20, 4 << 20
MARKS_A_ROW = 1 << 10
_U = np.uint64
_C = [_U(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                      0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x27D4EB2F165667C5, 0x2545F4914F6CDD1D)]
_LEAST = -(1 << 63)  # stands for a null doc_id


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _C[4]
    return x ^ (x >> _U(29))


class Hashed:
    """The windows of some pieces of text, laid end to end, and their runs."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        data = b"".join(pieces)
        self.n = max(0, len(data) - WINDOW + 1)
        if self.n:
            eights = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
            self.eights = _mix(eights * _C[0])

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows that start at these places: 64 bits and 32 bits."""
        a, b = np.zeros(len(at), dtype=np.uint64), np.zeros(len(at), dtype=np.uint64)
        for i, offset in enumerate((*range(0, WINDOW - 8, 8), WINDOW - 8)):
            x = self.eights[at + offset]
            a = (a + x) * _C[1 + i % 3]
            b = (b ^ x) * _C[5 + i % 3]
            a ^= a >> _U(31)
            b ^= b >> _U(33)
        return _mix(a), (_mix(b) >> _U(32)).astype(np.uint32)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last window of every run, its leader's hash, and 32 bits of its string's hash."""
        none = np.zeros(0, dtype=np.int64)
        if not self.n:
            return none, none, none.astype(np.uint64), none.astype(np.uint32)
        x = self.eights
        h = _mix(x[:-16] * _C[1] + x[8:-8] * _C[2] + x[16:] * _C[3])
        width = 1
        while 2 * width <= SPREAD:
            h = np.minimum(h[:-width], h[width:])
            width *= 2
        if width < SPREAD:
            h = np.minimum(h[:width - SPREAD], h[SPREAD - width:])
        whole = np.zeros(self.n + 1, dtype=np.int8)
        ok = self.lengths >= WINDOW
        whole[self.offsets[ok]] = 1
        whole[self.offsets[ok] + self.lengths[ok] - WINDOW + 1] -= 1
        whole = np.cumsum(whole[:-1], dtype=np.int8).view(bool)
        new = np.empty(self.n, dtype=bool)
        new[0] = True
        np.not_equal(h[1:], h[:-1], out=new[1:])
        new[1:] |= ~whole[:-1]
        last = np.empty(self.n, dtype=bool)
        last[-1] = True
        last[:-1] = new[1:] | ~whole[1:]
        lo, hi = np.flatnonzero(new & whole), np.flatnonzero(last & whole)
        if (hi - lo >= LONGEST_RUN).any():
            times = (hi - lo) // LONGEST_RUN + 1
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            lo, hi = np.repeat(lo, times) + nth * LONGEST_RUN, np.repeat(hi, times)
            hi = np.minimum(hi, lo + LONGEST_RUN - 1)
        (a, _), (b, _) = self.windows(lo), self.windows(hi)
        string = _mix(a * _C[2] + b * _C[3] + (hi - lo).astype(np.uint64))
        return lo, hi, h[lo], (string >> _U(32)).astype(np.uint32)

    def piece(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, "right") - 1


def pieces_of(texts: list[bytes]):
    """Lists of (row, first byte, bytes): together some PIECE_BYTES; a longer text is cut, its windows are not."""
    out, size = [], 0
    for row, t in enumerate(texts):
        for at in range(0, max(1, len(t) - WINDOW + 1), PIECE_BYTES):
            part = t[at:at + PIECE_BYTES + WINDOW - 1] if len(t) > PIECE_BYTES else t
            out.append((row, at, part))
            size += len(part)
            if size >= PIECE_BYTES:
                yield out
                out, size = [], 0
    if out:
        yield out


def _order(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by hashed key in which equal (a, b) stand together, and the keys in it."""
    key = _mix(a + b.astype(np.uint64) * _C[5])
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = np.flatnonzero(key[1:] == key[:-1])
    x, y = order[same], order[same + 1]
    if ((a[x] != a[y]) | (b[x] != b[y])).any():  # different entries with one key: as good as never
        order = np.lexsort((doc, b, a, _mix(a + b.astype(np.uint64) * _C[5])))
    return order, key


class Run:
    """A sorted array of entries (a, b, doc): of equal (a, b) only the smallest doc; others are in ``marked``."""

    def __init__(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray, ready: bool = False):
        """``ready``: the entries are a run's, in its order."""
        if ready:
            self.key, self.a, self.b, self.doc = _mix(a + b.astype(np.uint64) * _C[5]), a, b, doc.copy()
            self.marked = (a[:0], b[:0], doc[:0])
            return
        order, key = _order(a, b, doc)
        a, b, doc = a[order], b[order], doc[order]
        first = np.ones(len(a), dtype=bool)
        first[1:] = (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        starts = np.flatnonzero(first)
        if len(starts) == len(a):
            self.key, self.a, self.b, self.doc = key, a, b, doc
            self.marked = (a[:0], b[:0], doc[:0])
            return
        least = np.minimum.reduceat(doc, starts)
        late = doc > least[np.cumsum(first) - 1]
        self.marked = (a[late], b[late], doc[late])
        self.key, self.a, self.b, self.doc = key[starts], a[starts], b[starts], least

    def __len__(self):
        return len(self.a)


class Family:
    """Levels of sorted runs; a level is at least twice the size of the next."""

    def __init__(self):
        self.levels: list[Run] = []
        self.marked: list[tuple] = []

    def _mark(self, marked: tuple) -> None:
        if len(marked[0]):
            self.marked.append(marked)

    def add(self, run: Run) -> None:
        self._mark(run.marked)
        for level in self.levels:
            self._scan(level, run)
        self.levels.append(run)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            self._merge()

    def _scan(self, level: Run, run: Run) -> None:
        """Marks the larger doc of equal entries; both keep the smaller."""
        if not len(level):
            return
        at = np.minimum(np.searchsorted(level.key, run.key), len(level) - 1)
        met = np.flatnonzero(level.key[at] == run.key)
        if not len(met):
            return
        at = at[met]
        met = met[(level.a[at] == run.a[met]) & (level.b[at] == run.b[met]) & (level.doc[at] != run.doc[met])]
        at = np.searchsorted(level.key, run.key[met])
        small, large = np.minimum(level.doc[at], run.doc[met]), np.maximum(level.doc[at], run.doc[met])
        self._mark((run.a[met], run.b[met], large))
        level.doc[at], run.doc[met] = small, small

    def _merge(self) -> None:
        y, x = self.levels.pop(), self.levels.pop()
        both = Run(*(np.concatenate([getattr(x, f), getattr(y, f)]) for f in ("a", "b", "doc")))
        self._mark(both.marked)
        self.levels.append(both)

    def finish(self) -> tuple[Run, tuple]:
        """The whole index as one run, and the marks (a, b, doc), each once."""
        while len(self.levels) > 1:
            self._merge()
        if not self.marked:
            return self.levels[0], self.levels[0].marked
        a, b, doc = (np.concatenate(x) for x in zip(*self.marked, strict=True))
        self.marked = []
        key = Marks.keys(a, b, doc)
        order = np.argsort(key, kind="stable")
        a, b, doc = a[order], b[order], doc[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (doc[1:] != doc[:-1])
        return self.levels[0], (a[new], b[new], doc[new])


def _pack(a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> bytes:
    """Entries by column; documents relative to the smallest, their bytes in planes, which compress."""
    base = int(doc.min()) if len(doc) else 0
    rest = (doc.view(np.uint64) - np.int64(base).view(np.uint64))
    planes = rest.view(np.uint8).reshape(-1, 8).T
    return b"".join([np.array([len(a), base], dtype="<i8").tobytes(), a.tobytes(), b.tobytes(),
                     np.ascontiguousarray(planes).tobytes()])


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, base = np.frombuffer(data, dtype="<i8", count=2).tolist()
    a = np.frombuffer(data, dtype=np.uint64, count=n, offset=16)
    b = np.frombuffer(data, dtype=np.uint32, count=n, offset=16 + 8 * n)
    planes = np.frombuffer(data, dtype=np.uint8, count=8 * n, offset=16 + 12 * n).reshape(8, n)
    doc = np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1) + np.int64(base).view(np.uint64)
    return a, b, doc.view(np.int64)


def _by_bucket(a, b, doc, buckets: int):
    """(bucket, packed entries) by the leading bits of a's hash: leaders are minima, so their own are mostly 0."""
    shift = _U(64 - max(1, buckets.bit_length() - 1))
    at = (_mix(a * _C[7]) >> shift).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, a, b, doc = at[order], a[order], b[order], doc[order]
    cuts = np.flatnonzero(np.diff(at)) + 1
    for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
        if y > x:
            yield int(at[x]), _pack(a[x:y], b[x:y], doc[x:y])


def _entry_rows(own: Run, buckets: int) -> tuple[list, list, list]:
    """(bucket, run, marked): the run by bucket; the marks, which are settled and only pass through, dealt out
    evenly, so that a string with many copies does not gather in the bucket of its hash."""
    rows = [(k, packed, None) for k, packed in _by_bucket(own.a, own.b, own.doc, buckets)]
    a, b, doc = own.marked
    for at in range(0, len(a), MARKS_A_ROW):
        part = slice(at, at + MARKS_A_ROW)
        rows.append((int(_mix(doc[at:at + 1].view(np.uint64) + a[at:at + 1])[0]) % buckets, None, _pack(a[part], b[part], doc[part])))
    return tuple(map(list, zip(*rows, strict=True))) if rows else ([], [], [])


def _runs_of(keys: np.ndarray, texts: list[bytes]):
    """(leader, string, doc, row, first byte, end byte) of all runs."""
    got = [[] for _ in range(6)]
    for pieces in pieces_of(texts):
        h = Hashed([p for *_, p in pieces])
        lo, hi, a, b = h.runs()
        at = h.piece(lo)
        row = np.array([r for r, *_ in pieces], dtype=np.int64)[at]
        shift = np.array([f for _, f, _ in pieces], dtype=np.int64)[at] - h.offsets[at]
        for out, x in zip(got, (a, b, keys[row], row, lo + shift, hi + shift + WINDOW), strict=True):
            out.append(x)
    return [np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in got]


_ENTRIES = "bucket int, run binary, marked binary"


def _batches(docs: DataFrame, buckets: int) -> DataFrame:
    """Sorted runs of every batch, by bucket, and the marks that a batch settles by itself."""
    def run(batches):
        keys, texts, size = [], [], 0

        def batch():
            a, b, doc, *_ = _runs_of(np.array(keys, dtype=np.int64), texts)
            own = Run(a.astype(np.uint64), b.astype(np.uint32), doc)
            at, runs, marks = _entry_rows(own, buckets)
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(runs, pa.binary()), pa.array(marks, pa.binary())],
                                              names=["bucket", "run", "marked"])

        for ids, rows in text_rows(batches):
            for k, t in zip(ids, rows, strict=True):
                data = t.encode("utf-8", "surrogatepass")
                if len(data) < WINDOW:
                    continue
                keys.append(_LEAST if k is None else k)
                texts.append(data)
                size += len(data)
                if size >= BATCH_BYTES:
                    yield batch()
                    keys, texts, size = [], [], 0
        if texts:
            yield batch()
        trim()

    return docs.select("doc_id", "text").mapInArrow(run, _ENTRIES)


def _part(doc: np.ndarray, parts: int) -> np.ndarray:
    """What pmod(xxhash64(doc_id), parts) gives in Spark."""
    p1, p2, p3, p4, p5 = (_U(c) for c in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                          0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    x = doc.view(np.uint64) * p2
    h = (((x << _U(31)) | (x >> _U(33))) * p1) ^ (_U(42) + p5 + _U(8))
    h = ((h << _U(27)) | (h >> _U(37))) * p1 + p4
    h = (h ^ (h >> _U(33))) * p2
    h = (h ^ (h >> _U(29))) * p3
    return (h ^ (h >> _U(32))).view(np.int64) % parts


def _index(entries: DataFrame, parts: int, unsettled: bool) -> DataFrame:
    """(part, kind, payload): marks (kind 0) and, on request, runs to be settled by window (kind 1), by documents."""
    def run(group: pa.Table) -> pa.Table:
        family = Family()
        for packed in group.column("marked").to_pylist():
            if packed:
                family.marked.append(_unpack(packed))
        for packed in group.column("run").to_pylist():
            if packed:
                family.add(Run(*_unpack(packed), ready=True))
        out = []
        if not family.levels:
            family.add(Run(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64)))
        index, marks = family.finish()
        kinds = [(0, marks)]
        if unsettled and len(index):
            order = np.argsort(index.a, kind="stable")
            a, b, doc = index.a[order], index.b[order], index.doc[order]
            new = np.ones(len(a), dtype=bool)
            new[1:] = a[1:] != a[:-1]
            group_of = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            several = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
            on = several[group_of]
            kinds.append((1, (a[on], b[on], doc[on])))
        for kind, (a, b, doc) in kinds:
            at = _part(doc, parts)
            order = np.argsort(at, kind="stable")
            at, a, b, doc = at[order], a[order], b[order], doc[order]
            cuts = np.flatnonzero(np.diff(at)) + 1
            out += [(int(at[x]), kind, _pack(a[x:y], b[x:y], doc[x:y]))
                    for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True) if y > x]
        return pa.table([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
                         pa.array([x[2] for x in out], pa.binary())], names=["part", "kind", "payload"])

    return entries.groupBy("bucket").applyInArrow(run, "part int, kind int, payload binary")


class Marks:
    """Entries (a, b, doc) of a kind, to be looked up."""

    def __init__(self, table: pa.Table, kind: int):
        own = [_unpack(p) for k, p in zip(table.column("kind").to_pylist(), table.column("payload").to_pylist(), strict=True)
               if k == kind]
        self.a, self.b, self.doc = (np.concatenate(x) for x in zip(*own, strict=True)) if own else (
            np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64))
        self.key = np.sort(self.keys(self.a, self.b, self.doc))
        self.docs = np.unique(self.doc)

    @staticmethod
    def keys(a, b, doc):
        return _mix(_mix(a + doc.view(np.uint64) * _C[6]) + b.astype(np.uint64) * _C[7])

    def hit(self, a, b, doc) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(a), dtype=bool)
        k = self.keys(a, b, doc)
        return self.key[np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)] == k


def _docs_of(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    keys = np.array([_LEAST if k is None else k for k in table.column("doc_id").to_pylist()], dtype=np.int64)
    return keys, [t.encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]


def _window_entries(keys: np.ndarray, texts: list[bytes], open_runs: Marks):
    """(hash, hash, doc, row, first byte) of every window in the runs that are not settled."""
    got = [[] for _ in range(5)]
    rows = [i for i in np.flatnonzero(np.isin(keys, open_runs.docs)).tolist()]
    for pieces in pieces_of([texts[i] for i in rows]):
        h = Hashed([p for *_, p in pieces])
        lo, hi, a, b = h.runs()
        at = h.piece(lo)
        row = np.array(rows, dtype=np.int64)[np.array([r for r, *_ in pieces], dtype=np.int64)[at]]
        shift = np.array([f for _, f, _ in pieces], dtype=np.int64)[at] - h.offsets[at]
        on = open_runs.hit(a, b, keys[row])
        lo, hi, row, shift = lo[on], hi[on], row[on], shift[on]
        n = hi - lo + 1
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(lo, n) + nth
        wa, wb = h.windows(start)
        row, shift = np.repeat(row, n), np.repeat(shift, n)
        for out, x in zip(got, (wa, wb, keys[row], row, start + shift), strict=True):
            out.append(x)
    kinds = (np.uint64, np.uint32, np.int64, np.int64, np.int64)
    return [np.concatenate(x) if x else np.zeros(0, k) for x, k in zip(got, kinds, strict=True)]


def _windows(parts: DataFrame, marks: DataFrame, buckets: int) -> DataFrame:
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        keys, texts = _docs_of(docs)
        own = Run(*_window_entries(keys, texts, Marks(found, 1))[:3])
        at, runs, marked = _entry_rows(own, buckets)
        return pa.table([pa.array(at, pa.int32()), pa.array(runs, pa.binary()), pa.array(marked, pa.binary())],
                        names=["bucket", "run", "marked"])

    return parts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(run, _ENTRIES)


def _remove(parts: DataFrame, marks: DataFrame, digest: bool) -> DataFrame:
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        keys, texts = _docs_of(docs)
        whole, windows = Marks(found, 0), Marks(found, 2)
        firsts, ends, rows = [], [], []
        some = np.flatnonzero(np.isin(keys, whole.docs))
        a, b, doc, row, first, end = _runs_of(keys[some], [texts[i] for i in some.tolist()])
        on = whole.hit(a.astype(np.uint64), b.astype(np.uint32), doc)
        firsts.append(first[on])
        ends.append(end[on])
        rows.append(some[row[on]])
        wa, wb, doc, row, first = _window_entries(keys, texts, Marks(found, 1))
        on = windows.hit(wa, wb, doc)
        firsts.append(first[on])
        ends.append(first[on] + WINDOW)
        rows.append(row[on])
        first, end, row = np.concatenate(firsts), np.concatenate(ends), np.concatenate(rows)
        order = np.lexsort((first, row))
        first, end, row = first[order], end[order], row[order]
        at = np.searchsorted(row, np.arange(len(texts) + 1))
        out = {"doc_id": [], "n_bytes": [], "spans": [], "kept": []}
        for i, t in enumerate(texts):
            spans = []
            for x, y in zip(first[at[i]:at[i + 1]].tolist(), end[at[i]:at[i + 1]].tolist(), strict=True):
                if spans and x <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], y)
                else:
                    spans.append([x, y])
            kept = b"".join(t[x:y] for x, y in zip([0, *(y for _, y in spans)], [*(x for x, _ in spans), len(t)], strict=True))
            out["doc_id"].append(None if keys[i] == _LEAST else int(keys[i]))
            out["n_bytes"].append(len(t))
            out["spans"].append([{"first": x, "end": y} for x, y in spans])
            out["kept"].append(kept)
        spans = out["spans"]
        columns = [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_bytes"], pa.int64()),
                   pa.array([sum(s["end"] - s["first"] for s in x) for x in spans], pa.int64()),
                   pa.array([len(x) for x in spans], pa.int64())]
        if digest:
            columns.append(pa.array([hashlib.sha256(k).hexdigest() for k in out["kept"]]))
        else:
            columns += [pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                        pa.array(out["kept"], pa.binary())]
        return pa.table(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", *_TAIL[digest][0]])

    return parts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, " + _TAIL[digest][1])


_TAIL = {True: (["kept_sha256"], "kept_sha256 string"),
         False: (["spans", "kept"], "spans array<struct<first: bigint, end: bigint>>, kept binary")}


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept) of every document, or kept_sha256 for the last two.

    spans are the maximal removed runs of bytes, kept is what is left, end to end. Null texts are empty; texts
    under 50 bytes lose nothing. A null doc_id counts as the smallest; rows that share a doc_id do not count
    against each other; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    docs = id_text(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, size // PART_BYTES + 1)
    buckets = 1 << (max(least, size // BUCKET_BYTES + 1) - 1).bit_length()
    marks = shared_checkpoint(_index(_batches(docs, buckets), parts, unsettled=True))
    free_shuffles(spark)
    key = F.coalesce(F.col("doc_id"), F.lit(_LEAST))
    shared = docs.select("doc_id", "text", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part"))
    settled = shared_checkpoint(_index(_windows(shared, marks, buckets), parts, unsettled=False).select(
        "part", F.lit(2).alias("kind"), "payload"))
    free_shuffles(spark)
    return _remove(shared, marks.unionByName(settled), digest)

