"""Small documents with the hard cases, and their brute-force results' helpers."""

import random

WORDS = "the and of river stone window paper quiet morning engine garden yellow simple answer carry walk".split()
CLASHES = ("id", "fp", "part", "kind", "doc", "need", "spans", "score", "key", "component", "bucket", "words")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", r.choice("abcdefgh") + r.choice("klmno")]) for _ in range(n))


def lines(seed: int, n: int, words: int = 14) -> str:
    return "\n".join(prose(seed * 1000 + i, words) for i in range(n))


def hard_rows() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, repeated rows, ties, copies, near copies, a long text."""
    base = lines(1, 6)
    passage = prose(77, 60)
    rows = [(1, base), (2, base), (3, base.replace("river", "rivers", 1)), (4, None), (5, ""), (6, " \n\t "),
            (7, "é😀 ünïcode " + passage), (8, prose(5, 30) + "\n" + passage + "\n" + prose(6, 30)), (9, "one"),
            (10, "aaaa " * 200), (11, "a" * 400), (12, prose(9, 40)), (12, prose(9, 40)), (None, prose(10, 40)),
            (None, None), (13, lines(2, 400)), (14, lines(2, 400) + "\n" + passage), (-5, prose(11, 25)),
            (15, "x" * 49), (16, "x" * 50), (17, "THE AND OF"), (18, "the and of")]
    return rows


def frame(spark, rows, extra: bool = True):
    """documents with those rows, and columns whose names clash with the operators' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(k, t, "en", "src0", None if t is None else len(t)) for k, t in rows]
    if extra:
        schema += "".join(f", {c} string" for c in CLASHES)
        data = [r + ("clash",) * len(CLASHES) for r in data]
    return spark.createDataFrame(data, schema)
