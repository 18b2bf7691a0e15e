"""Suffix dedup, token store, SimHash, PII, BPE, quality: brute force on hard cases and driver tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import bpe, pii, quality, simhash, suffix_dedup, token_store

from .fixtures import frame, hard_rows, lines, prose

JSON, RANKS, PATTERN = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN)


def bag(rows):
    return sorted(map(repr, rows))


# op 1

def repeats(rows):
    first: dict[bytes, int] = {}
    low = -(1 << 63)
    data = [(low if k is None else k, (t or "").encode()) for k, t in rows]
    for k, b in data:
        for i in range(len(b) - 49):
            w = b[i:i + 50]
            first[w] = min(first.get(w, k), k)
    out = []
    for (k, b), (own, _) in zip(data, rows, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < k:
                gone[i:i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((own, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("batch", [16 << 20, 3000])
def test_repeats_match_brute_force(spark, monkeypatch, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    got = suffix_dedup.remove_repeats(frame(spark, hard_rows()).repartition(4), digest=True).collect()
    assert bag(tuple(r) for r in got) == bag(repeats(hard_rows()))


def test_repeats_at_the_ends_of_copies(spark):
    a, b, c = prose(21, 60), prose(22, 60), prose(23, 60)
    rows = [(1, a + b), (2, b + c), (3, c + a), (4, a[:120] + c[:49] + b[:50] + "z" + b[51:]), (5, a[7:57]), (6, a[7:56]),
            (7, "ab" * 300), (8, "ba" * 40), (9, a[:30] + a + c[:25] + c)]
    got = suffix_dedup.remove_repeats(frame(spark, rows, extra=False).repartition(3)).collect()
    assert bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == bag(repeats(rows))
    for r in got:
        text = dict(rows)[r.doc_id].encode()
        left = bytearray(text)
        for s in reversed(r.spans):
            del left[s.first:s.end]
        assert bytes(left) == r.kept


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.text("ab", min_size=40, max_size=160)), min_size=2, max_size=8))
def test_family_marks_what_a_smaller_document_holds(rows):
    family = suffix_dedup.Family()
    entries = []
    for k, t in rows:
        a, b, doc, *_ = suffix_dedup._runs_of(np.array([k]), [t.encode()])
        family.add(suffix_dedup.Run(a.astype(np.uint64), b.astype(np.uint32), doc))
        entries += list(zip(a.tolist(), b.tolist(), doc.tolist(), strict=True))
    least = {}
    for a, b, d in entries:
        least[a, b] = min(d, least.get((a, b), d))
    index, marks = family.finish()
    assert set(zip(*(x.tolist() for x in marks), strict=True)) == {(a, b, d) for a, b, d in entries if d > least[a, b]}
    assert {(a, b): d for a, b, d in zip(index.a.tolist(), index.b.tolist(), index.doc.tolist(), strict=True)} == least


def test_levels_shrink_geometrically():
    family = suffix_dedup.Family()
    rng = np.random.default_rng(0)
    for k in range(64):
        family.add(suffix_dedup.Run(rng.integers(0, 1 << 60, 100, dtype=np.uint64), np.zeros(100, np.uint32),
                                    np.full(100, k, np.int64)))
        sizes = [len(x) for x in family.levels]
        assert len(sizes) <= 8 and all(x >= 2 * y for x, y in zip(sizes, sizes[1:], strict=False))


def test_entries_survive_packing():
    doc = np.array([-(1 << 63), (1 << 63) - 1, 5, -7], dtype=np.int64)
    a, b = np.arange(4, dtype=np.uint64) << np.uint64(60), np.arange(4, dtype=np.uint32)
    for x, y in zip((a, b, doc), suffix_dedup._unpack(suffix_dedup._pack(a, b, doc)), strict=True):
        assert x.tolist() == y.tolist()


def test_parts_agree_with_spark(spark):
    from pyspark.sql import functions as F

    ids = [0, 1, -1, 7, 1 << 62, -(1 << 63)]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "k long").select(
        F.pmod(F.xxhash64("k"), F.lit(37)).cast("int")).collect()]
    assert suffix_dedup._part(np.array(ids, dtype=np.int64), 37).tolist() == got


# op 2 and op 6

def test_stored_ids_match_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    rows = sorted(hard_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, at = [], 0
    for k, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((k, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    got = token_store.store(frame(spark, hard_rows()).repartition(5), JSON, PATTERN).collect()
    assert bag(tuple(r) for r in got) == bag(expected)


def test_stored_ids_know_the_added_tokens_of_the_file(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    rows = [(1, "a <|endoftext|> b"), (2, "x<|endoftext|><|endoftext|>é😀\n"), (3, "<|endoftext|"), (4, "plain " + prose(4, 30)),
            (5, "<|endoftext|>"), (6, "<|endof<|endoftext|>text|>  z"), (7, None)]
    expected, at = [], 0
    for k, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((k, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert t.encode(rows[0][1], add_special_tokens=False).ids == [64, 220, 50256, 275]
    got = token_store.store(frame(spark, rows).repartition(3), JSON, PATTERN).collect()
    assert bag(tuple(r) for r in got) == bag(expected)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 32) - 1) | st.integers(0, 300), max_size=700), max_size=4))
def test_directly_addressable_codes_round_trip(docs):
    ids = np.array([i for d in docs for i in d], dtype=np.uint32)
    s = token_store.Segment(token_store.pack(list(range(len(docs))), [len(d) for d in docs], ids))
    assert [s.document(k).tolist() for k in range(len(docs))] == docs
    assert [s[i] for i in range(len(ids))] == ids.tolist()
    for a in range(0, len(ids), 97):
        assert s.slice(a, min(len(ids), a + 300)).tolist() == ids[a:a + 300].tolist()


@pytest.fixture(scope="module")
def reference_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.characters(max_codepoint=0x24FF, exclude_categories=["Cs", "Cn"]) | st.sampled_from(" \n\t'é😀"), max_size=60))
def test_ids_match_the_other_library_and_decode(reference_encoding, text):
    c = bpe.codec(RANKS, PATTERN)
    ids = c.encode([text])[0].tolist()
    assert ids == reference_encoding.encode_ordinary(text)
    assert c.decode(ids) == text.encode()
    data = text.encode()
    spans = c.spans(text, ids)
    assert b"".join(data[a:b] for a, b, *_ in spans) == data
    assert all(data[a:b].decode(errors="ignore") in text[x:y] for a, b, x, y in spans)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=255) | st.sampled_from("   \n\t\xa0''stmdrevl1.a"), max_size=40), max_size=6))
def test_pieces_of_a_run_start_where_the_pattern_cuts(texts):
    texts = [t for t in texts if t]
    own = bpe.codec(RANKS, PATTERN).encoder
    assert bpe.SPLIT == PATTERN
    cut = [own.any(t) for t in texts]
    assert cut == [own.cut(t) for t in texts]
    if texts:
        data = np.frombuffer("".join(texts).encode("latin-1"), dtype=np.uint8)
        got = bpe.starts(data, np.cumsum([0, *map(len, texts)])[:-1])
        assert np.flatnonzero(got).tolist() == np.cumsum([0, *(len(p) for c in cut for p in c)])[:-1].tolist()


def test_a_run_looks_up_each_distinct_piece_once(reference_encoding, monkeypatch):
    own = bpe.PieceEncoder(bpe.codec(RANKS, PATTERN).encoder.model, PATTERN)
    asked, made = [], own._ids_of
    monkeypatch.setattr(own, "_ids_of", lambda pieces: asked.extend(pieces) or made(pieces))
    texts = [prose(i, 50) for i in range(40)] * 5 + ["", "\u20ac then \u00e9"]
    got = own.encode(texts)
    assert [x.tolist() for x in got] == reference_encoding.encode_ordinary_batch(texts)
    assert len(asked) - len(own.cut(texts[-1])) == len({p for t in texts[:-1] for p in own.cut(t)})


@pytest.mark.parametrize("run", [1, 300])
def test_ids_do_not_depend_on_runs_and_cache(reference_encoding, monkeypatch, run):
    monkeypatch.setattr(bpe, "RUN", run)
    monkeypatch.setattr(bpe, "CACHE", 5)
    texts = [t or "" for _, t in hard_rows()] + ["it's we'll\n\n  they're'd  ", "  ", "caf\u00e9  \u4f60'll"]
    own = bpe.PieceEncoder(bpe.codec(RANKS, PATTERN).encoder.model, PATTERN)
    assert [x.tolist() for x in own.encode(texts)] == reference_encoding.encode_ordinary_batch(texts)


def test_round_trip_on_hard_rows(spark, reference_encoding):
    expected = []
    for k, t in hard_rows():
        ids = reference_encoding.encode_ordinary(t or "")
        expected.append((k, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    docs = frame(spark, hard_rows())
    assert bag(tuple(r) for r in bpe.round_trip(docs, RANKS, PATTERN).collect()) == bag(expected)
    coded = bpe.encode(docs, RANKS, PATTERN, spans=True)
    assert all(len(r.ids) == len(r.spans) for r in coded.collect())
    assert bag((r.doc_id, bytes(r.bytes).decode()) for r in bpe.decode(coded, RANKS, PATTERN).collect()) == bag(
        (k, t or "") for k, t in hard_rows())


# op 3

def fingerprint(text, n=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))
    s = [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, linked):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_simhash_matches_brute_force(spark):
    rows = hard_rows() + [(100 + i, lines(1, 6) + " " + w) for i, w in enumerate("alpha beta gamma delta".split())]
    fp = [fingerprint(t) for _, t in rows]
    roots = components(len(rows), lambda i, j: bin(fp[i] ^ fp[j]).count("1") <= 2)
    least = {}
    for r, (k, _) in zip(roots, rows, strict=True):
        if k is not None:
            least[r] = min(k, least.get(r, k))
    expected = [(k, f"{f:016x}", least.get(r)) for (k, _), f, r in zip(rows, fp, roots, strict=True)]
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert bag(tuple(r) for r in got) == bag(expected)


def test_masks_cover_every_pair_of_positions():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(i + 1):
            assert any(not m & (1 << i | 1 << j) for m in masks)


@pytest.mark.parametrize("base", [0, 0x123456789ABCDEF0])
def test_hot_buckets_link_as_all_pairs_do(spark, base):
    """Many fingerprints around one: buckets over SMALL go the one-bit way."""
    from strata.llm.components import connected_components

    fps = sorted({base} | {base ^ (1 << i) for i in range(20)} | {base ^ (1 << i) ^ (1 << (i + 7)) ^ (1 << 50) for i in range(30)})
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = simhash.links(df)
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in links.collect())
    got = {r.node & (1 << 64) - 1: r.component for r in connected_components(links).collect()}
    roots = components(len(fps), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 2)
    groups = {}
    for f, r in zip(fps, roots, strict=True):
        groups.setdefault(r, set()).add(f)
    made = {}
    for f in fps:
        made.setdefault(got.get(f, ("alone", f)), set()).add(f)
    assert sorted(map(sorted, made.values())) == sorted(map(sorted, groups.values()))


def test_one_of_each_group_stays(spark):
    kept = simhash.keep_one_of_each(frame(spark, hard_rows()))
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 1 in ids and 2 not in ids and 4 in ids and 5 not in ids and None in ids
    assert kept.columns == frame(spark, hard_rows()).columns


# op 5

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            if {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PRIVATE = ["a@b.c+x@d.e", "mail é😀 to x.y-z@host.example.org. now", "1.2.3.4.5.6.7.8 and 256.1.1.1 and 0255.000.1.9",
           "4111 1111 1111 1111 or 4111-1111-1111-1112 or 79927398713", "+1 (123) 555-7890 x +49 30 123456 +1()()",
           "12 " * 3000, "1" * 5000, "a" * 5000, "a.b." * 2000, "user@" * 1000, "@@..++", "+" * 50, "9" * 13 + " " + "0" * 16]


@settings(max_examples=20, deadline=None)
@given(extra=st.lists(st.text("0123456789 -.+()@ab", max_size=60), min_size=20, max_size=30))
def test_base_spans_match_brute_force(spark, extra):
    rows = list(enumerate(PRIVATE + extra))
    got = pii.base_spans(frame(spark, rows, extra=False)).collect()
    for r in got:
        assert [f"{s.kind}:{s.start}:{s.end}" for s in r.spans] == base_spans(rows[r.doc_id][1]), rows[r.doc_id][1]


def test_disclosing_terms(spark):
    """A term that only stands beside one card is removed; frequent words beside it stay."""
    card = "4111111111111111"
    rows = [(i, f"the account of wilhelmina uses {card} with the bank") for i in range(3)]
    rows += [(10 + i, f"the account with the bank uses numbers {prose(i, 12)}") for i in range(30)]
    rows += [(90, None), (91, ""), (None, "write to nobody@example.org")]
    got = {r.doc_id: r for r in pii.find_personal_data(frame(spark, rows)).collect()}
    text = rows[0][1]
    at = text.index("wilhelmina")
    assert got[0].spans.split(",") == [*base_spans(text), f"term:{at}:{at + 10}"] and got[0].term_actions == "remove"
    assert got[0].n_card == 1 and got[90].spans == "" and got[None].n_email == 1
    assert got[90].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(spark, rows)).collect()}
    assert clean[0] == "the account of  uses [CARD] with the bank" and clean[11] == rows[4][1] and clean[90] == ""
    assert clean[None] == "write to [EMAIL]"


def entity(kind, value):
    return value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value)


def term_spans(rows):
    """Brute force: for each distinct (doc_id, text) its term spans with their shares, by the definition."""
    docs = sorted(set((k, t or "") for k, t in rows), key=repr)
    held, words = {}, {}
    for d in docs:
        spans = [s.split(":") for s in base_spans(d[1])]
        held[d] = {(k, entity(k, d[1][int(a):int(b)])) for k, a, b in spans}
        mails = [(int(a), int(b)) for k, a, b in spans if k == "email"]
        cuts = [0, *[x for m in mails for x in m], len(d[1])]
        words[d] = [(m[0].lower(), cuts[i] + m.start(), cuts[i] + m.end()) for i in range(0, len(cuts), 2)
                    for m in regex.finditer(r"\p{L}{4,}", d[1][cuts[i]:cuts[i + 1]])]
    n, out = len(docs), {d: {} for d in docs}
    nt = Counter(w for d in docs for w in {x[0] for x in words[d]})
    nc = Counter(e for d in docs for e in held[d])
    nct = Counter((e, w) for d in docs for e in held[d] for w in {x[0] for x in words[d]})
    for (e, w), both in nct.items():
        if both >= 2 and nc[e] < n:
            share = math.log2(both * n / (nc[e] * nt[w])) / math.log2(n / nc[e])
            if share >= pii.GENERALISE:
                for d in docs:
                    if e in held[d]:
                        for x in words[d]:
                            if x[0] == w:
                                out[d][x[1:]] = max(share, out[d].get(x[1:], 0))
    return out


def disclosing_rows():
    """Cards with terms beside and far from them, repeated rows, shared and null ids, mail words that are no terms."""
    card, far = "4111111111111111", " ".join(f"filler{'abcdefghij'[i % 10]}" for i in range(60))
    rows = [(i, f"Wilhelmina has {card} here {prose(i, 8)} {far} Éloïse and wilhelmina") for i in range(3)]
    rows += [(10 + i, f"the account with the bank uses numbers {prose(i, 12)}") for i in range(30)]
    rows += [(0, rows[0][1])] * 60 + [(10, rows[3][1])] * 5  # repeated rows count once
    rows += [(None, f"jakobine writes to anna.specialword@mail.example.org {i}") for i in range(3)]
    rows += [(None, "plain text"), (None, "write to nobody@example.org now"), (7, "call +49 30 1234567 soon"), (7, "other text")]
    rows += [(50 + i, f"{prose(60 + i, 9)} 10.0.0.{i % 3} jakobine") for i in range(6)] + [(90, None), (91, ""), (92, "ab@c.de")]
    return rows


def test_terms_match_brute_force(spark):
    rows = disclosing_rows()
    want = term_spans(rows)
    assert sum(map(len, want.values())) > 10
    got = pii.find_personal_data(frame(spark, rows).repartition(5)).collect()
    shown = []
    for k, t in rows:
        found = want[k, t or ""]
        spans = base_spans(t or "") + [f"term:{a}:{b}" for a, b in sorted(found)]
        shown.append((k, ",".join(spans), ",".join("remove" if found[x] >= pii.REMOVE else "generalise" for x in sorted(found))))
    assert bag((r.doc_id, r.spans, r.term_actions) for r in got) == bag(shown)


def test_terms_beyond_what_is_broadcast(spark, monkeypatch):
    rows = disclosing_rows()
    df = frame(spark, rows, extra=False)
    one = bag(tuple(r) for r in pii.find_personal_data(df).collect())
    monkeypatch.setattr(pii, "BROADCAST_REPEATS", 0)
    assert bag(tuple(r) for r in pii.find_personal_data(df).collect()) == one


def test_sanitised_texts_hold_no_base_span(spark):
    extra = [(None, "card 4111 1111 1111 1111 and +1 (123) 555-7890 or 4111111111111111"), (None, PRIVATE[1]), (3, "+1 (123) 555-7890 x +49 30 123456"),
             (3, "+1 (123) 555-7890 x +49 30 123456"), (3, "+4111111111111111 x@y.zz"), (4, "+4222222222222 and (4222222222222)"), (5, "1.2.3.4@example.org")]
    rows = disclosing_rows() + extra
    got = pii.sanitise(frame(spark, rows).repartition(3)).collect()
    want = term_spans(rows)

    def clean(k, t):
        marks = [(int(s.split(":")[1]), -int(s.split(":")[2]), f"[{s.split(':')[0].upper()}]") for s in base_spans(t)]
        marks += [(a, -b, "" if share >= pii.REMOVE else "[TERM]") for (a, b), share in want[k, t].items()]
        out, at = "", 0
        for a, b, mark in sorted(marks):
            if a >= at:
                out += t[at:a] + mark
            at = max(at, -b)
        return out + t[at:]

    assert bag((r.doc_id, r.text) for r in got) == bag((k, clean(k, t or "")) for k, t in rows)
    for r in got:
        assert "@" not in r.text and "4111" not in r.text and not re.search(r"\+[0-9]", r.text), r.text
    assert [r.text for r in got if "plain" in r.text] == ["plain text"]


# op 10

def features(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    own = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(own) - len(set(own)), len(inside),
            len(w) < 20 or 100 * len(inside) > 30 * len(w))


def test_quality_features_match_brute_force(spark):
    rows = hard_rows() + [(200, "a\nb\na\n \n \nb"), (201, "#*$%&|<>x \xa0 y"), (202, prose(3, 9) + " " + prose(3, 9)),
                          (203, " ".join(["x"] * 30)), (204, prose(4, 30) + " q " + prose(4, 30) + " z " + prose(4, 30))]
    labels = spark.createDataFrame([(1, 1), (13, 1), (8, 0), (None, 1), (999, 1)], "doc_id long, quality int")
    got = quality.judge(frame(spark, rows), labels).collect()
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == bag(
        (k, *features(t)) for k, t in rows)
    assert not any(r.kept for r in got if r.base_failed)


def test_likelihood_ratio_tells_noise_from_prose(spark):
    good = [(i, prose(i, 60)) for i in range(40)]
    bad = [(100 + i, "*** ".join(prose(500 + i, 40).split()) + " ### $$$") for i in range(10)]
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.judge(frame(spark, good + bad), labels).collect()}
    assert all(got[i].kept for i in range(40)) and not any(got[100 + i].kept for i in range(10))
    table = quality.log_ratios(frame(spark, good + bad).select("doc_id", "text"), labels).first()["table"]
    assert len(table) == quality.BUCKETS


@pytest.mark.parametrize("ids", [1 << 20, 0])
def test_every_trusted_document_counts(spark, monkeypatch, ids):
    monkeypatch.setattr(quality, "BROADCAST_IDS", ids, raising=False)
    docs = frame(spark, [(i, f"w{i % 50} of w{i}") for i in range(9000)], extra=False)
    labels = docs.selectExpr("doc_id", "1 AS quality")
    raw = Counter(b for r in docs.select(quality.grams(docs["text"]).alias("g")).collect() for b in r.g)
    n, got = sum(raw.values()), quality.log_ratios(docs, labels).first()["table"]
    r = np.array([raw[b] for b in range(quality.BUCKETS)], dtype=float)
    share = (r + 1) / (n + quality.BUCKETS)
    assert np.allclose(got, np.log((r + quality.PRIOR * share) / ((n + quality.PRIOR) * share)))


def test_empty_tables_give_empty_results(spark):
    none = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (suffix_dedup.remove_repeats(none, digest=True), token_store.store(none, JSON, PATTERN), simhash.near_duplicates(none),
               pii.find_personal_data(none), bpe.round_trip(none, RANKS, PATTERN), quality.judge(none, labels)):
        assert df.collect() == []
