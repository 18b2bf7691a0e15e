"""Whitening, packing and fill-in-middle: brute force on hard cases and driver tables."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import fim, packing, registry, whitening

from .fixtures import CLASHES, frame, hard_rows, lines

JSON, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


# op 11

def vectors(spark, rows, extra=True):
    schema = "vec_id long, embedding array<float>, label int"
    data = [(k, v, 0) for k, v in rows]
    if extra:
        schema += "".join(f", {c} string" for c in (*CLASHES, "x", "i", "s", "component"))
        data = [r + ("clash",) * (len(CLASHES) + 4) for r in data]
    return spark.createDataFrame(data, schema)


def whitened(rows, k=4):
    """Brute force: rows of whiten() by the covariance's eigenvectors; |projection| as signs are free."""
    ok = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64)) for i, v in rows
          if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.unique(np.array([x for _, x in ok]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    return [(i, j + 1, n, sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s, strict=True)),
             abs(float((x - s / n) @ q[:, j] / np.sqrt(e[j]))), float(e[j] / e.sum()))
            for i, x in ok for j in range(min(k, len(e)))]


def same_whitening(got, want):
    def key(r):
        return (-1 << 62 if r[0] is None else r[0], r[1], r[3])
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-8, atol=1e-9)


def test_whitening_matches_eigenvectors_on_hard_rows(spark):
    rng = np.random.default_rng(3)
    data = (rng.standard_normal((60, 6)) * [4, 3, 2, 1, 0.5, 0.2]).astype(np.float32)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(data)]
    rows += [(100, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (None, rows[5][1])] + [(200, rows[7][1])] * 50
    bad = [(300, None), (301, [1.0, None] + [0.0] * 4), (302, [float("nan")] + [0.0] * 5),
           (303, [float("inf")] + [0.0] * 5), (304, [])]
    got = whitening.whiten(vectors(spark, rows + bad).repartition(5)).collect()
    same_whitening(got, whitened(rows))
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_of_the_driver_table(spark):
    got = registry.SPARK["op11_whitening"](spark, SF).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same_whitening(got, whitened(rows))


def test_whitening_without_variance_or_rows(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None)])).collect() == []
    got = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got} == {
        (i, c, 1, 0, None, None) for i in (1, 2) for c in (1, 2)}
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 1.0, 2.0]) for i in range(5)])).collect()
    assert {r.component: r.whitened is None for r in flat} == {1: False, 2: True, 3: True}
    mixed = whitening.whiten(vectors(spark, [(i, [float(i), float(i * i)]) for i in range(5)] + [(9, [1.0])])).collect()
    assert {r.vec_id for r in mixed} == set(range(5))  # another dimension than the most frequent one


@pytest.mark.parametrize("values", [[9, 9, 5, 5, 1, 1, 1, 1], [3] * 8, [1, 0, 0, 0, 0, 0, 0, 0], [5, 4, 3, 2, 1, 1e-9, 0, 0]])
def test_equal_and_zero_singular_values_are_all_found(values):
    rng = np.random.default_rng(5)
    u, _, vt = np.linalg.svd(rng.standard_normal((50, 8)), full_matrices=False)
    x = u * np.array(values, dtype=float) @ vt
    got = whitening.leading(lambda w: (x.T @ (x @ w), (x @ w) @ (x @ w)), 8, 4, float(np.linalg.norm(x)))
    assert np.allclose([s for s, _ in got], sorted(values, reverse=True)[:4], atol=1e-12)
    v = np.array([q for _, q in got])
    assert np.allclose(v @ v.T, np.eye(4), atol=1e-12)
    for s, q in got:
        assert np.allclose(x.T @ (x @ q), s * s * q, atol=1e-11)


def test_deviations_are_exact_beyond_53_bits():
    x = np.array([[10**6, -(10**6)], [10**7, 3], [10**9, 1]])
    assert whitening._deviations(x, 1001, np.array([7, 5])) == [
        (1001 * 10**6 - 7) ** 2 + (1001 * 10**6 + 5) ** 2, None, None]


# op 12

def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    return [t.encode(x or "", add_special_tokens=False).ids + [1] for x in texts]


def check_packing(got, rows, size=2048):
    """Every id of every document lies in one piece; sequences are gapless, at most ``size`` long and little padded."""
    want = sorted(((-1 << 62 if k is None else k), tuple(ids)) for (k, _), ids in
                  zip(rows, whole_ids([t for _, t in rows]), strict=True))
    seqs, docs = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length > 0
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault(-1 << 62 if r.doc_id is None else r.doc_id, []).append((r.doc_tokens, r.start, ids))
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(i for d in docs.values() for _, _, ids in d for i in ids) == sorted(i for _, t in want for i in t)
    for k, own in docs.items():
        mine = [t for d, t in want if d == k]
        if len(mine) == 1:
            own.sort(key=lambda p: p[1])
            assert [i for _, _, ids in own for i in ids] == list(mine[0])
            assert all(n == len(mine[0]) for n, _, _ in own)
            assert [s for _, s, _ in own] == np.cumsum([0] + [len(ids) for _, _, ids in own])[:-1].tolist()
    used = [sum(n for _, n in own) for own in seqs.values()]
    return sum(size - u for u in used if u & (u - 1)) / sum(used)


@pytest.mark.parametrize("size", [2048, 64])
def test_packing_keeps_every_id(spark, size):
    rows = hard_rows() + [(50, lines(3, 900)), (51, "a <|endoftext|> b")] + [(60 + i, "one two three") for i in range(40)]
    packed = packing.pack(frame(spark, rows).repartition(4), JSON, PATTERN, 1, size)
    assert check_packing(packed.collect(), rows, size) < 0.05
    got = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(0 < len(x) <= 4 * size for x in got.values())
    assert sum(map(len, got.values())) == 4 * sum(map(len, whole_ids([t for _, t in rows])))


def test_packing_of_the_driver_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    packed = packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), JSON, PATTERN, 1).collect()
    assert check_packing(packed, rows) < 0.005
    digest = registry.SPARK["op12_packing"](spark, SF).collect()
    ids = {k: np.array(x, dtype="<u4") for (k, _), x in zip(rows, whole_ids([t for _, t in rows]), strict=True)}
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) for r in digest)
    assert sum(r.length for r in digest) == sum(map(len, ids.values()))


def test_packing_of_an_empty_table(spark):
    assert packing.pack(frame(spark, []), JSON, PATTERN, 1).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), min_size=1, max_size=20))
def test_plans_place_every_rank_once(counts):
    held, seqs = {n: np.zeros((c, n), dtype=int) for n, c in counts.items()}, {}
    for n, lo, hi, a, b, seq, at in packing.plan(counts, 64, 2):
        held[n][lo:hi, a:b] += 1
        for k in range(hi - lo):
            seqs.setdefault(seq + k, []).append((at, b - a))
    assert all((h == 1).all() for h in held.values())
    used = []
    for own in seqs.values():
        assert [o for o, _ in sorted(own)] == np.cumsum([0] + [n for _, n in sorted(own)])[:-1].tolist()
        used.append(sum(n for _, n in own))
    assert max(used) <= 64
    assert all(u > 64 - packing.LOOSE or u & (u - 1) == 0 for u in used)


def test_columns_are_generated_until_the_bound():
    sizes, demand = np.array([34, 45, 51, 66, 75]), np.array([48.0, 35, 24, 10, 8])
    patterns, used, bound = packing.column_generation(sizes, demand, 100, gap=0)
    assert (patterns.T @ sizes <= 100).all()
    assert (patterns @ used >= demand - 1e-9).all()
    # all whole-number patterns, by brute force, cannot beat the duals' bound
    assert used.sum() == pytest.approx(bound, abs=1e-6)


def test_knapsack_matches_brute_force():
    sizes, values = np.array([3, 4, 7]), np.array([4.0, 5.0, 10.0])
    for room in range(30):
        best = max(4 * a + 5 * b + 10 * c for a in range(11) for b in range(9) for c in range(6)
                   if 3 * a + 4 * b + 7 * c <= room)
        worth, counts = packing.knapsack(sizes, values, room)
        assert worth == best == counts @ values
        assert counts @ sizes <= room


def test_a_hot_length_needs_few_plan_rows():
    small, large = (len(packing.plan({683: n, 700: n // 100 + 1, 90: n // 7})) for n in (1000, 10**7))
    assert large < 20 * small + 5000


# op 13

def filled(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < spm:
        return (doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}")
    return (doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}")


@pytest.mark.parametrize("rate", [100, 50])
def test_fill_in_middle_matches_brute_force(spark, rate):
    extra = [(30 + i, t) for i, t in enumerate(
        ["\n", "\n\n\n", "a\n", "a\nb", "é\n😀\n", "x <P> y\nz", "<S", "M>\n<M", "<<S>\n", "line\r\nline\r\n", "a\x00b\n\x0bc"])]
    rows = hard_rows() + extra + [(100 + i, "é" * i + "\n" * (i % 7) + "z😀\n" * i) for i in range(60)]
    made = fim.transform(frame(spark, rows).repartition(3), rate=rate)
    got = made.select("*", fim.restored(made.output, made.form).alias("again")).collect()
    assert sorted(map(repr, [tuple(r)[:6] for r in got])) == sorted(map(repr, [filled(*r, rate=rate) for r in rows]))
    assert sorted(r.again for r in got) == sorted(t or "" for _, t in rows)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=0, max_size=100))
def test_marks_rank_and_select(data):
    raw = np.frombuffer(data, dtype=np.uint8)
    for marks, want in ((fim.byte_marks(fim.as_words(raw), 10), [i for i, c in enumerate(data) if c == 10]),
                        (fim.start_marks(fim.as_words(raw)), [i for i, c in enumerate(data) if c >> 6 != 2])):
        m = fim.Marks(marks)
        assert m.rank(np.arange(len(data) + 1)).tolist() == [sum(p < i for p in want) for i in range(len(data) + 1)]
        assert m.select(np.arange(len(want))).tolist() == want


def test_fill_in_middle_of_an_empty_table(spark):
    assert fim.transform(frame(spark, [])).collect() == []
