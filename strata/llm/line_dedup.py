"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard, distributed union-find (operator 7).

Lines are compared without surrounding white space and with A-Z lowered, as bytes; a blank line is never a
duplicate and always stays. A line's shingles are its strings of ``SHINGLE`` bytes (a shorter line is one shingle).
Two lines link if their shingle sets have a Jaccard similarity of ``threshold`` or more and agree in one of
``BANDS`` bands of ``ROWS`` minima, which lines of similarity 0.8 do with a chance of 0.9998. Of each component of
links the first line, by doc_id and line number, stays.

Every stage works on distinct lines. The signature is a one-permutation MinHash: the smallest shingle hash in each
of ``BANDS * ROWS`` bins, an empty bin borrowing from another. Tasks send packed band keys. A band group links its
members by a star to its smallest line, so no pairs are listed. Where a group's members then have several labels (the
smallest line two links away), those outside of the most frequent get further stars, to members inside that differ from group to group. What
is still outside is held against all members, in cells of bounded size (in the first band that a pair shares). So a link
of the group is never lost, and a family of near lines that are linked costs rows in proportion to it. Lines that share
bands and are not linked are compared all the same: a family of such costs its square, in cells of bounded size.

Texts of candidates are looked up by joins on doc_id and the hash of the text, links and components stay distributed, and every stage's
result is a checkpoint or a table in the cluster's shared folder.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_shuffles, id_text, limit_batches, shared_checkpoint, shared_path, text_rows, trim
from strata.llm.components import connected_components

SHINGLE, ROWS, BANDS, THRESHOLD = 8, 4, 16, 0.8
CELL, CENTRES = 256, 8
BLOCK_BYTES, PIECE_BYTES, BUCKET_BYTES = 8 << 20, 1 << 18, 4 << 20  # a piece's words stay in the processor's cache
_U, _MAX = np.uint64, np.iinfo(np.uint64).max
_LEAST = -(1 << 63)  # stands for a null doc_id
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)


def normal(line: str) -> bytes:
    return line.strip().encode("utf-8", "surrogatepass").lower()


def line_id(line: bytes) -> int:
    """A signed 64-bit hash: lines are the same if it is."""
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _B
    return x ^ (x >> _U(31))


def _words(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of the lines as 64-bit words, line after line, and their numbers; no line is shorter than one."""
    n = np.array([len(x) - SHINGLE + 1 for x in lines], dtype=np.int64)
    data = b"".join(lines)
    inside = np.ones(len(data) - SHINGLE + 1, dtype=bool)
    ends = np.cumsum(n + SHINGLE - 1)[:-1]
    for i in range(1, SHINGLE):  # no shingle crosses from a line to the next
        inside[ends - i] = False
    return np.ndarray(len(inside), dtype="<u8", buffer=data, strides=(1,))[inside], n


def signatures(lines: list[bytes]) -> np.ndarray:
    """One row of BANDS * ROWS minima for each line."""
    bins = BANDS * ROWS
    out = np.full(len(lines) * bins, _MAX, dtype=np.uint64)
    pieces, rows, size = [], [], 0

    def flush():
        h, n = _words(pieces)
        h *= _A
        h ^= h >> _U(32)  # _mix, in place
        h *= _B
        h ^= h >> _U(31)
        at = h >> _U(32)
        at *= _U(bins)
        at >>= _U(32)
        at = at.view(np.int64)
        at += np.repeat(np.array(rows, dtype=np.int64) * bins, n)
        np.minimum.at(out, at, h)

    for row, line in enumerate(lines):
        line = line.ljust(SHINGLE, b"\0")
        for at in range(0, len(line) - SHINGLE + 1, PIECE_BYTES):
            pieces.append(line[at:at + PIECE_BYTES + SHINGLE - 1])
            rows.append(row)
            size += len(pieces[-1])
            if size >= PIECE_BYTES:
                flush()
                pieces, rows, size = [], [], 0
    if pieces:
        flush()
    out = out.reshape(-1, bins)
    own = out != _MAX
    r, c = np.nonzero(~own)
    tries = 0
    while len(r):  # a line has a shingle, so every bin finds a full one
        tries += 1
        other = (_mix(c.astype(np.uint64) * _A + _U(tries)) % _U(bins)).astype(np.int64)
        full = own[r, other]
        out[r[full], c[full]] = _mix(out[r[full], other[full]] + _U(tries))
        r, c = r[~full], c[~full]
    return out


def band_keys(lines: list[bytes]) -> np.ndarray:
    """BANDS keys of 64 bits for each line."""
    s = signatures(lines).reshape(len(lines), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _B, s.shape[:2]).copy()
    for i in range(ROWS):
        key = _mix((key ^ s[:, :, i]) * _A)
    return key


def _lines_of(ids: list, texts: list[str]):
    """(doc, line number, normal line) of all lines that aren't blank."""
    for k, text in zip(ids, texts, strict=True):
        doc = _LEAST if k is None else k
        for n, line in enumerate(text.split("\n")):
            own = normal(line)
            if own:
                yield doc, n, own


def _text_key(text: Column) -> Column:
    """32 bits of the text's hash: they tell rows that share a doc_id apart."""
    return F.xxhash64(text).bitwiseAND(0xFFFFFFFF)


def _line(place: str) -> Column:
    """A place is the line number, then its text's key."""
    return F.shiftright(place, 32)


def _occurrences(docs: DataFrame) -> DataFrame:
    """(id, doc, place): where each line stands."""
    def run(batches):
        for ids, texts in text_rows(batches):
            rows = []
            for k, text in zip(ids, texts, strict=True):
                key = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42) & 0xFFFFFFFF
                rows += [(line_id(x), d, n << 32 | key) for d, n, x in _lines_of([k], [text])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                                             names=["id", "doc", "place"])

    return docs.mapInArrow(run, "id long, doc long, place long")


def _packed_bands(docs: DataFrame, bits: int) -> DataFrame:
    """(bucket, payload): 40 bits of band keys, the last being the band's number, and the ids of a task's
    distinct lines, by leading key bits."""
    def run(batches):
        held, size = {}, 0

        def block():
            lines = list(held.values())
            ids = np.fromiter(held, dtype=np.int64, count=len(held))
            keys = band_keys(lines)
            ids = np.repeat(ids, BANDS)
            keys = keys.reshape(-1)
            at = (keys >> _U(64 - bits)).astype(np.uint16 if bits <= 16 else np.int64)  # short ones take a radix sort
            order = np.argsort(at, kind="stable")
            band = (np.arange(len(keys)) % BANDS).astype(np.uint64)[order]
            at, ids = at[order], ids[order]
            keys = ((keys[order] >> _U(24 - bits)) & _U((1 << 40) - BANDS)) | band
            cuts = np.flatnonzero(np.diff(at)) + 1
            spans = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(at[x]) for x, _ in spans], pa.int32()), pa.array(
                    [(keys[x:y] & _U(0xFFFFFFFF)).astype("<u4").tobytes() + (keys[x:y] >> _U(32)).astype(np.uint8).tobytes()
                     + ids[x:y].tobytes() for x, y in spans], pa.binary())], names=["bucket", "payload"])

        for ids, texts in text_rows(batches):
            for _, _, line in _lines_of(ids, texts):
                k = line_id(line)
                if k not in held:
                    held[k] = line
                    size += len(line) + 8 * BANDS * ROWS // 4
                    if size >= BLOCK_BYTES:
                        yield block()
                        held, size = {}, 0
        if held:
            yield block()
        trim()

    return docs.mapInArrow(run, "bucket int, payload binary")


def _groups(bands: DataFrame) -> DataFrame:
    """(pivot, n, members, key): the n distinct lines of each band key that has several, sorted, in rows of at most
    ``CELL``; pivot is the smallest. Groups of the same members, as near lines have in many bands, are one, of the
    smallest key; those of several rows stay as they are."""
    def run(group: pa.Table) -> pa.Table:
        bucket = group.column("bucket")[0].as_py()
        keys, ids = [], []
        for p in group.column("payload").to_pylist():
            n = len(p) // 13
            keys.append(np.frombuffer(p, "<u4", n).astype(np.int64) | np.frombuffer(p, np.uint8, n, 4 * n).astype(np.int64) << 32)
            ids.append(np.frombuffer(p, np.int64, n, 5 * n))
        key, own = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(key)
        again = key[order[1:]] == key[order[:-1]]
        order = order[np.append(again, False) | np.insert(again, 0, False)] if len(order) else order
        key, own = key[order], own[order]
        order = np.lexsort((own, key))
        key, own = key[order], own[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
        key, own = key[new], own[new]
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        at = np.cumsum(first) - 1
        several = np.bincount(at)[at] > 1 if len(at) else first
        key, own, first = key[several], own[several], np.flatnonzero(first[several])
        n = np.diff(np.append(first, len(key)))
        begin = np.repeat(first, n)
        cuts = np.flatnonzero((np.arange(len(key)) - begin) % CELL == 0)
        members = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(key)), pa.int32()), pa.array(own))
        return pa.table([pa.array(key[cuts] | bucket << 40), pa.array(own[begin[cuts]]), pa.array(np.repeat(n, n)[cuts]), members],
                        names=["key", "pivot", "n", "members"])

    groups = bands.groupBy("bucket").applyInArrow(run, "key long, pivot long, n long, members array<long>")
    part = F.when(F.col("n") > F.size("members"), F.col("key"))
    return groups.groupBy(part.alias("part"), "pivot", "n", "members").agg(F.min("key").alias("key")).drop("part")


def _first_places(occurrences: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, doc, place, n, near): the first place and the number of places of the wanted ids (``near``) and of all others
    that stand more than once; a line that is neither has no duplicate."""
    first = occurrences.groupBy("id").agg(F.min(F.struct("doc", "place")).alias("p"), F.count("*").alias("n"))
    return first.join(wanted.withColumn("near", F.lit(True)), "id", "left").where("n > 1 OR near").select(
        "id", "p.doc", "p.place", "n", "near")


def _texts_of(docs: DataFrame, first: DataFrame) -> DataFrame:
    """(id, text): the normal lines of these ids, read from where they first stand."""
    need = first.select("id", "doc", _line("place").cast("int").alias("line"),
                                           F.col("place").bitwiseAND(0xFFFFFFFF).alias("key"))
    need = need.groupBy("doc", "key").agg(F.collect_list(F.struct("line", "id")).alias("need"))

    def run(batches):
        for b in batches:
            found = {}
            for text, need in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                lines = text.split("\n")
                for r in need:
                    if r["line"] < len(lines):
                        own = normal(lines[r["line"]])
                        if line_id(own) == r["id"]:  # texts of one key may differ
                            found[r["id"]] = own
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())],
                                             names=["id", "text"])

    here = (F.coalesce("doc_id", F.lit(_LEAST)) == F.col("doc")) & (_text_key(F.col("text")) == F.col("key"))
    # rows that repeat give the same lines
    return docs.join(need, here).select("text", "need").mapInArrow(run, "id long, text binary").dropDuplicates(["id"])


def _alike(pairs: list[tuple[bytes, bytes]], threshold: float) -> list[bool]:
    """Whether the shingle sets of each pair are that similar; a line stands in many pairs."""
    row = {}
    for pair in pairs:
        for x in pair:
            row.setdefault(x, len(row))
    words, n = _words([x.ljust(SHINGLE, b"\0") for x in row])
    ends = np.cumsum(n)
    first = ends - n
    for x, y in zip(first.tolist(), ends.tolist(), strict=True):
        words[x:y].sort()
    new = np.ones(len(words), dtype=bool)
    np.not_equal(words[1:], words[:-1], out=new[1:])
    new[first] = True
    size = np.add.reduceat(new, first, dtype=np.int64)
    sets = np.split(words[new], np.cumsum(size)[:-1])
    at = np.array([[row[x], row[y]] for x, y in pairs])
    both = np.concatenate([sets[i] for i in at.ravel().tolist()])
    total = size[at].sum(axis=1)
    ends = np.cumsum(total)
    first = ends - total
    for x, y in zip(first.tolist(), ends.tolist(), strict=True):
        both[x:y].sort(kind="stable")  # merges two sorted runs
    again = np.zeros(len(both), dtype=bool)
    np.equal(both[1:], both[:-1], out=again[1:])
    again[first] = False
    common = np.add.reduceat(again, first, dtype=np.int64)
    return (common >= threshold * (total - common)).tolist()


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose lines are that similar."""
    def run(batches):
        for b in batches:
            on, some, size = [], [], 0
            for pair in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                some.append(pair)
                size += len(pair[0]) + len(pair[1])
                if size >= PIECE_BYTES:
                    on += _alike(some, threshold)
                    some, size = [], 0
            if some:
                on += _alike(some, threshold)
            yield b.select([0, 1]).filter(pa.array(on, pa.bool_()))
        trim()

    both = (pairs.join(texts.withColumnsRenamed({"id": "ia", "text": "ta"}), F.col("a") == F.col("ia"))
            .join(texts.withColumnsRenamed({"id": "ib", "text": "tb"}), F.col("b") == F.col("ib")))
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _labels(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node at most two links away, or the node itself. Nodes of one label are of one component
    (not the other way round), which takes two aggregates and no search for the components."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = shared_checkpoint(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("near")))
    far = both.join(near, F.col("v") == F.col("node")).groupBy("u").agg(F.min("near").alias("label"))
    return shared_checkpoint(far.select(F.col("u").alias("node"), F.least("u", "label").alias("label")))


def _open_groups(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, component, main, n, outside): the members of groups in which not all are of one label; main is the label
    that most of the n members have, ``outside`` the number of those that have another."""
    groups = groups.where("n > 2")  # a group of two is its star
    own = groups.join(labels, groups["member"] == labels["node"], "left").select(
        "key", F.col("member").alias("id"), F.coalesce("label", "member").alias("component"))
    sizes = own.groupBy("key", "component").agg(F.count("*").alias("n"))
    sums = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"))
    live = sums.where("parts > 1").select(
        F.col("key").alias("k"), F.col("top.component").alias("main"), "n", (F.col("n") - F.col("top.n")).alias("outside"))
    live = shared_checkpoint(live)  # so that the join can split a large group
    return own.join(live, F.col("key") == F.col("k")).drop("k")


def _second_stars(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of each open group of more than a cell: ``CENTRES`` members of its main component, others in every group,
    with all members outside. The bands' groups of a family differ in these, so what stays outside of all is little."""
    large = rows.where(F.col("n") > CELL)
    picked = [F.min(F.struct(F.xxhash64("id", "key", F.lit(i)).alias("h"), "id"))["id"] for i in range(CENTRES)]
    centre = shared_checkpoint(large.where("component = main").groupBy(F.col("key").alias("k")).agg(F.array(*picked).alias("ids")))
    pairs = large.where("component != main").join(centre, F.col("key") == F.col("k")).withColumn("centre", F.explode("ids"))
    return pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()


def _open_cells(rows: DataFrame) -> DataFrame:
    """(key, i, j, id, component, left): open groups in cells: chunk i of the members outside of the main component (``left``)
    against chunk j of all members."""
    rows = rows.withColumns({"chunks": F.ceil(F.col("n") / CELL).cast("int"), "out_chunks": F.ceil(F.col("outside") / CELL).cast("int")})
    hashed = F.xxhash64("id")
    right = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("out_chunks") - 1))).withColumn(
        "j", F.pmod(hashed, F.col("chunks")).cast("int")).withColumn("left", F.lit(False))
    left = rows.where("component != main").withColumn("i", F.pmod(hashed, F.col("out_chunks")).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("left", F.lit(True))
    return left.unionByName(right).select("key", "i", "j", "id", "component", "left")


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """The number of common words of two sorted sets."""
    if len(x) < len(y):
        x, y = y, x
    return int(np.count_nonzero(x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y))


def _shingle_words(line: bytes) -> np.ndarray:
    """The shingle set as sorted 64-bit words (a shingle has eight bytes)."""
    line = line.ljust(SHINGLE, b"\0")
    words = np.sort(np.ndarray(len(line) - SHINGLE + 1, dtype="<u8", buffer=line, strides=(1,)))
    new = np.ones(len(words), dtype=bool)
    np.not_equal(words[1:], words[:-1], out=new[1:])
    return words[new]


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The number of common shingles of each pair (positions in left and right): pair by pair if they are few,
    else all at once, as a product of 0/1 matrices over some thousand shingles at a time."""
    if len(pairs) <= 2 * len(sets):
        return np.array([_overlap(sets[left[x]], sets[right[y]]) for x, y in pairs])
    ids, flat = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(ids), 4096):
        a, b = np.searchsorted(flat, at), np.searchsorted(flat, at + 4096)
        part = np.zeros((len(sets), 4096), dtype=np.float32)
        part[row[a:b], flat[a:b] - at] = 1
        out += part[left] @ part[right].T
    return out[pairs[:, 0], pairs[:, 1]]


def _cell_links(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join components of a cell. A pair is looked at in the first band whose open group it shares."""
    cells = _open_cells(rows)
    bands = rows.groupBy(F.col("id").alias("member")).agg(F.collect_list("key").alias("bands"))
    held = texts.join(bands, texts["id"] == bands["member"]).select(F.col("id").alias("own"), "text", "bands")

    def links(key, i, j, rows) -> list[tuple]:
        left = np.array([n for n, r in enumerate(rows) if r[2]])
        right = np.array([n for n, r in enumerate(rows) if not r[2]])
        if not len(left) or not len(right):
            return []
        keys = np.full((len(rows), BANDS), -1, dtype=np.int64)
        for n, r in enumerate(rows):
            own = np.array(r[4], dtype=np.int64)
            keys[n, own % BANDS] = own
        same = keys[left][:, None, :] == keys[right][None, :, :]
        same &= keys[left][:, None, :] >= 0
        component = np.unique([r[1] for r in rows], return_inverse=True)[1]
        mask = (same.argmax(axis=2) == key % BANDS) & (component[left][:, None] != component[right][None, :])
        if not mask.any():
            return []
        sets = [_shingle_words(r[3]) for r in rows]
        size = np.array([len(x) for x in sets])
        a, b = size[left][:, None], size[right][None, :]
        mask &= np.minimum(a, b) >= threshold * np.maximum(a, b)
        pairs = np.argwhere(mask)
        if not len(pairs):
            return []
        both = _common(sets, left, right, pairs)
        x, y = left[pairs[:, 0]], right[pairs[:, 1]]
        on = both / (size[x] + size[y] - both) >= threshold
        parent = list(range(component.max() + 1))

        def root(n):
            while parent[n] != n:
                parent[n] = n = parent[parent[n]]
            return n

        out = []
        for n, m in zip(x[on].tolist(), y[on].tolist(), strict=True):
            p, q = root(component[n]), root(component[m])
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((rows[n][0], rows[m][0]))
        return out

    def run(batches):
        cell, rows = None, []
        for b in batches:
            found = []
            for key, i, j, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (key, i, j) != cell:
                    if cell:
                        found += links(*cell, rows)
                    cell, rows = (key, i, j), []
                rows.append(row)
            yield _edges(found)
        if cell:
            yield _edges(links(*cell, rows))
        trim()

    return (cells.join(held, F.col("id") == F.col("own")).select("key", "i", "j", "id", "component", "left", "text", "bands")
            .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id").mapInArrow(run, "a long, b long"))


def _edges(found: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
                                      names=["a", "b"])


def line_components(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """occurrences (id, doc, place), the first places of lines that may have duplicates, and components
    (node, component) of the ids that have links."""
    spark = docs.sparkSession
    limit_batches(spark)
    docs = id_text(docs)
    at = shared_path(spark, "lines")
    _occurrences(docs).write.option("compression", "zstd").parquet(f"{at}/occurrences")
    occurrences = spark.read.parquet(f"{at}/occurrences")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(24, (max(2 * least, size // BUCKET_BYTES + 1) - 1).bit_length())
    _groups(_packed_bands(docs, bits)).write.option("compression", "zstd").parquet(f"{at}/groups")
    free_shuffles(spark)
    groups = spark.read.parquet(f"{at}/groups").select("key", "pivot", "n", F.explode("members").alias("member"))
    wanted = groups.select(F.col("member").alias("id")).distinct()
    _first_places(occurrences, wanted).write.option("compression", "zstd").parquet(f"{at}/first")
    first = spark.read.parquet(f"{at}/first")
    _texts_of(docs, first.where("near")).write.option("compression", "zstd").parquet(f"{at}/texts")
    free_shuffles(spark)
    texts = spark.read.parquet(f"{at}/texts")
    stars = groups.where("member != pivot").select(F.col("pivot").alias("a"), F.col("member").alias("b")).distinct()
    links = shared_checkpoint(_verified(stars, texts, threshold))
    rows = shared_checkpoint(_open_groups(groups, _labels(links)))
    more = shared_checkpoint(_verified(_second_stars(rows), texts, threshold))
    if not more.isEmpty():
        links = links.unionByName(more)
        rows = shared_checkpoint(_open_groups(groups, _labels(links)))
    more = shared_checkpoint(_cell_links(rows, texts, threshold))
    free_shuffles(spark)
    components = connected_components(links.unionByName(more))
    free_shuffles(spark)
    return occurrences, first, components


def duplicate_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc, key, gone array<struct<line, id>>): the lines that go from texts of that key; the first line of every
    component stays."""
    occurrences, first, components = line_components(docs, threshold)
    own = first.join(components, first["id"] == components["node"], "left").where("n > 1 OR component IS NOT NULL").select(
        "id", F.coalesce("component", "id").alias("c"), "doc", "place")
    keeper = own.groupBy("c").agg(F.min(F.struct("doc", "place")).alias("keep")).select(
        F.col("c").alias("k"), F.col("keep.doc").alias("keep_doc"), _line("keep.place").alias("keep_line"))
    keeper = shared_checkpoint(keeper)  # so that the joins can split a large component, below the places of a frequent line
    keeper = own.join(keeper, F.col("c") == F.col("k")).select(F.col("id").alias("k"), "keep_doc", "keep_line")
    keeper = shared_checkpoint(keeper)
    late = occurrences.withColumn("line", _line("place")).join(keeper, F.col("id") == F.col("k")).where(
        (F.col("doc") != F.col("keep_doc")) | (F.col("line") != F.col("keep_line")))
    late = late.select("doc", F.col("place").bitwiseAND(0xFFFFFFFF).alias("key"), F.col("line").cast("int").alias("line"), "id")
    return late.groupBy("doc", "key").agg(F.collect_set(F.struct("line", "id")).alias("gone"))


def _apply(docs: DataFrame, threshold: float, run, schema) -> DataFrame:
    gone = duplicate_lines(docs, threshold).withColumnsRenamed({"doc": "__doc", "key": "__key", "gone": "__gone"})
    here = (F.coalesce(docs["doc_id"].cast("long"), F.lit(_LEAST)) == gone["__doc"]) & (
        _text_key(F.coalesce(docs["text"].cast("string"), F.lit(""))) == gone["__key"])
    return docs.join(gone, here, "left").drop("__doc", "__key").mapInArrow(run, schema)


def _kept(text: str, gone) -> tuple[list[str], int]:
    """The lines that stay and the number of those that go."""
    lines = text.split("\n")
    marks = {(r["line"], r["id"]) for r in gone or ()}
    if not marks:
        return lines, 0
    at = {n for n, _ in marks}
    stay = [x for n, x in enumerate(lines) if n not in at or (n, line_id(normal(x))) not in marks]
    return stay, len(lines) - len(stay)


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without their duplicate lines, all columns; n_chars, if there, is the new length.

    Texts lose lines, never rows: a text of duplicates only becomes empty. Null texts stay null. Rows that
    share a doc_id are one document: equal lines at equal places stay or go together. A null doc_id counts as
    the smallest; an empty table gives no rows.
    """
    names = [c.lower() for c in docs.columns]
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    schema = docs.schema

    def run(batches):
        for b in batches:
            own = [None if t is None else "\n".join(_kept(t, g)[0]) for t, g in zip(
                b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True)]
            columns = b.columns[:-1]
            columns[at] = pa.array(own, b.schema.field(at).type)
            if chars is not None:
                columns[chars] = pa.array([None if t is None else len(t) for t in own], pa.int64()).cast(b.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:-1])

    return _apply(docs, threshold, run, schema)


def line_report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256): what dedup_lines does to each document; null texts are empty."""
    def run(batches):
        for b in batches:
            own = [_kept(t, g) for t, g in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) + n for x, n in own], pa.int64()), pa.array([n for _, n in own], pa.int64()),
                 pa.array([hashlib.sha256("\n".join(x).encode("utf-8", "surrogatepass")).hexdigest() for x, _ in own])],
                names=["doc_id", "n_lines", "n_removed", "kept_sha256"])

    return _apply(id_text(docs), threshold, run, "doc_id long, n_lines long, n_removed long, kept_sha256 string")
