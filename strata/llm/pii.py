"""Personal data and the terms that give it away, in DataFrame functions alone (operator 5).

Base: e-mail, IP, card and phone numbers by pattern. The patterns here match what the plain ones match, but their
loops are possessive and a run of characters is tried once, so a very long text costs linear time.

Information-theoretic sanitisation: a protected entity c is one base value (normalised), a term t a word of four
letters or more outside e-mail addresses. With n(c, t) documents that hold both, n(c) that hold c, n(t) that hold t
and N in all, t discloses PMI(c; t) = log2(n(c, t) N / (n(c) n(t))) of the IC(c) = log2(N / n(c)) bits of c. A term
of at least ``MIN_DOCS`` documents with c and a share PMI / IC of ``GENERALISE`` is generalised wherever it stands in
documents that hold c, and removed from a share of ``REMOVE`` on. All counts are of all documents, and a document
is a (doc_id, text): rows that repeat one count once in all four.

As n(c, t) is at most n(c), only terms with n(t) <= n(c) ** GENERALISE * N ** (1 - GENERALISE) can reach the
share: others are dropped before terms meet entities, so a long document with many values does not give all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import id_text, shared_checkpoint, shared_path
from strata.llm.quality import let

MIN_DOCS, GENERALISE, REMOVE = 2, 0.75, 0.95
#: Repeated documents that may be broadcast; with more, texts are shuffled to them.
BROADCAST_REPEATS = 100_000
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{4,}"
_CHUNK = 64
_NO_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"
_NO_TERMS = "array<struct<term:string,start:int,end:int>>"


def _running(lengths: Column) -> Column:
    """The sum of all earlier lengths, for each; in chunks, so that appending costs linear time."""
    def within(part, first):
        return F.aggregate(part, F.struct(first.alias("at"), F.array().cast("array<int>").alias("out")), lambda a, x: F.struct(
            (a["at"] + x).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: a["out"])

    def of(v):
        starts = F.sequence(F.lit(1), F.size(v), F.lit(_CHUNK))
        sums = F.transform(starts, lambda s: F.aggregate(F.slice(v, s, _CHUNK), F.lit(0), lambda a, x: a + x))
        return let(within(sums, F.lit(0)), lambda firsts: F.flatten(F.transform(
            starts, lambda s, k: within(F.slice(v, s, _CHUNK), F.get(firsts, k)))))

    return let(lengths, of)


def _luhn(digits: Column) -> Column:
    def add(a, i):
        x = F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return a + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]+", "")
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return value.rlike(f"^{part}(?:\\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.char_length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    return {"email": F.lower(value), "ip": value}.get(kind, F.regexp_replace(value, "[^0-9]+", ""))


def find(kind: str, text: Column) -> Column:
    """The valid matches of a kind: (kind, start, end, value), code points, end exclusive."""
    pattern = PATTERNS[kind]

    def place(found):
        def around(between):
            at = _running(F.zip_with(F.slice(between, 1, F.size(found)), found, lambda a, b: F.char_length(a) + F.char_length(b)))
            rows = let(at, lambda starts: F.transform(found, lambda value, i: F.struct(
                F.lit(kind).alias("kind"), (F.get(starts, i) + F.char_length(F.get(between, i))).alias("start"),
                (F.get(starts, i) + F.char_length(F.get(between, i)) + F.char_length(value)).alias("end"),
                value.alias("value"))))
            return F.filter(rows, lambda r: _valid(kind, r["value"]))

        return F.when(F.size(found) == 0, F.array().cast(_NO_SPANS)).otherwise(let(F.split(text, pattern, -1), around))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def _terms(text: Column, first: Column) -> Column:
    """(term, start, end) of a text that starts at ``first``."""
    def place(found):
        def around(between):
            at = _running(F.zip_with(F.slice(between, 1, F.size(found)), found, lambda a, b: F.char_length(a) + F.char_length(b)))
            return let(at, lambda starts: F.transform(found, lambda t, i: F.struct(
                F.lower(t).alias("term"), (first + F.get(starts, i) + F.char_length(F.get(between, i))).alias("start"),
                (first + F.get(starts, i) + F.char_length(F.get(between, i)) + F.char_length(t)).alias("end"))))

        return F.when(F.size(found) == 0, F.array().cast(_NO_TERMS)).otherwise(let(F.split(text, TERM, -1), around))

    return let(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), place)


def terms(text: Column) -> Column:
    """(term, start, end) of all terms of a whole text, those in e-mail addresses left out."""
    def of(found):
        def around(between):
            ends = F.zip_with(between, F.concat(found, F.array(F.lit(""))), lambda a, b: F.char_length(a) + F.char_length(b))
            return let(_running(ends), lambda starts: F.flatten(F.transform(between, lambda part, i: _terms(part, F.get(starts, i)))))

        return let(F.split(text, PATTERNS["email"], -1), around)

    whole = _terms(text, F.lit(0))
    return F.when(F.contains(text, F.lit("@")), let(F.regexp_extract_all(text, F.lit(PATTERNS["email"]), F.lit(0)), of)).otherwise(whole)


def distinct_terms(text: Column) -> Column:
    """Each term of a whole text once."""
    outside = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    return F.array_distinct(F.transform(F.regexp_extract_all(outside, F.lit(TERM), F.lit(0)), lambda t: F.lower(t)))


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(
        s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


ROW = ["doc_id", "text_key"]


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text): the key tells the documents of one doc_id apart."""
    return id_text(docs).select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans, text): base spans by kind and start; the text only where there are any."""
    rows = _rows(docs).select(*ROW, F.concat(*(find(k, F.col("text")) for k in KINDS)).alias("spans"), "text")
    return rows.withColumn("text", F.when(F.size("spans") > 0, F.col("text")))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _on_row(left: DataFrame, right: DataFrame, how: str, also: tuple = ()) -> DataFrame:
    """Join on the document, a null doc_id being equal to another, and on the columns ``also``."""
    r = right.withColumnsRenamed({c: f"__{c}" for c in (*ROW, *also)})
    same = F.col("doc_id").eqNullSafe(F.col("__doc_id"))
    for c in (*ROW[1:], *also):
        same = same & (F.col(c) == F.col(f"__{c}"))
    return left.join(r, same, how).drop(*[f"__{c}" for c in (*ROW, *also)])


def _term_counts(docs: DataFrame, times: DataFrame) -> DataFrame:
    """(term, nt): documents that hold a term; a document that stands in m rows counts 1 / m in each of them."""
    repeated = shared_checkpoint(times.where(F.col("times") > 1))
    if repeated.count() <= BROADCAST_REPEATS:
        repeated = F.broadcast(repeated)
    rows = _on_row(_rows(docs), repeated, "left")
    each = rows.select(F.explode(distinct_terms(F.col("text"))).alias("term"), (1 / F.coalesce("times", F.lit(1))).alias("part"))
    return each.groupBy("term").agg(F.round(F.sum("part")).cast("bigint").alias("nt")).where(F.col("nt") >= MIN_DOCS)


def disclosing_terms(docs: DataFrame, base: DataFrame) -> DataFrame:
    """(doc_id, text_key, terms): for documents with any, (start, end, share) of the terms that disclose an entity in them."""
    times = base.groupBy(*ROW).agg(F.count(F.lit(1)).alias("times"))
    n = float(times.count())
    held = base.where(F.size("spans") > 0).groupBy(*ROW).agg(F.first("spans").alias("spans"), F.first("text").alias("text"))
    held = _written(held, "pii-texts")
    s = F.col("s")
    entity = F.when(s["kind"] == "email", _entity("email", s["value"])).when(
        s["kind"] == "ip", _entity("ip", s["value"])).otherwise(_entity("card", s["value"]))
    entities = held.select(*ROW, F.explode("spans").alias("s")).select(*ROW, s["kind"].alias("kind"), entity.alias("entity")).distinct()
    n_entity = shared_checkpoint(entities.groupBy("kind", "entity").agg(F.count("*").alias("nc")).where(F.col("nc") >= MIN_DOCS))
    known = entities.join(n_entity, ["kind", "entity"])
    n_term = _written(_term_counts(docs, times), "pii-terms")
    own = held.select(*ROW, F.explode(distinct_terms(F.col("text"))).alias("term")).join(n_term, "term")
    # the largest n(t) that can reach the share, with a little room for rounding
    reach = F.pow(F.col("nc"), F.lit(GENERALISE)) * (n ** (1 - GENERALISE) * (1 + 1e-9))
    pairs = _on_row(own, known, "inner").where(F.col("nt") <= reach)
    pairs = _written(pairs.select(*ROW, "kind", "entity", "term", "nc", "nt"), "pii-pairs")
    scored = pairs.groupBy("kind", "entity", "term", "nc", "nt").agg(F.count("*").alias("nct")).where(F.col("nct") >= MIN_DOCS)
    share = F.log2(F.col("nct") * n / (F.col("nc") * F.col("nt"))) / F.log2(F.lit(n) / F.col("nc"))
    # an entity that every document holds has no information, and its share is not a number
    scored = scored.select("kind", "entity", "term", share.alias("share")).where((F.col("share") >= GENERALISE) & ~F.isnan("share"))
    told = pairs.select(*ROW, "kind", "entity", "term").join(shared_checkpoint(scored), ["kind", "entity", "term"])
    told = told.groupBy(*ROW, "term").agg(F.max("share").alias("share"))
    places = held.select(*ROW, F.explode(terms(F.col("text"))).alias("t")).select(*ROW, "t.term", "t.start", "t.end")
    found = _on_row(places, told, "inner", ("term",))
    return found.groupBy(*ROW).agg(F.array_sort(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))


def _found(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans, terms) of every row."""
    base = _written(base_spans(docs), "pii-base")
    rows = _on_row(base.select(*ROW, "spans"), disclosing_terms(docs, base), "left")
    return rows.withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,share:double>>")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, term_actions).

    ``spans`` has the base spans and then those of disclosing terms, as kind:start:end; term_actions says for each
    of these, in order, whether it is generalised or removed. Null texts are empty and have no spans; a null
    doc_id keeps its row; repeated rows are reported each, and count as one document for the statistics; an empty
    table gives no rows; other columns are not read.
    """
    rows = _found(docs)
    told = F.transform("terms", lambda t: F.struct(F.lit("term").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    plain = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    actions = F.transform("terms", lambda t: F.when(t["share"] >= REMOVE, "remove").otherwise("generalise"))
    return rows.select("doc_id", *counts, F.sha2(_shown(F.col("spans")), 256).alias("base_sha256"),
                       _shown(F.concat(plain, told)).alias("spans"), F.array_join(actions, ",").alias("term_actions"))


def sanitise(docs: DataFrame) -> DataFrame:
    """(doc_id, text): base spans become [KIND], generalised terms [TERM], removed terms nothing; whole texts, a row for
    each row, whatever ids they share.

    Spans that overlap are replaced together, by the mark of the one that starts first (then of the longer one).
    """
    found = _found(docs).where((F.size("spans") > 0) | (F.size("terms") > 0)).groupBy(*ROW).agg(
        F.first("spans").alias("spans"), F.first("terms").alias("terms"))
    rows = _on_row(_rows(docs), found, "left")

    def mark(x, name):
        return F.struct(x["start"].alias("start"), (-x["end"]).alias("minus_end"), name.alias("mark"))

    base = F.transform("spans", lambda x: mark(x, F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))))
    told = F.transform("terms", lambda x: mark(x, F.when(x["share"] >= REMOVE, "").otherwise("[TERM]")))
    walked = F.aggregate(F.array_sort(F.concat(base, told)), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
                         lambda a, m: F.when(m["start"] < a["at"], F.struct(
                             F.greatest(a["at"], -m["minus_end"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
                                 (-m["minus_end"]).alias("at"),
                                 F.concat(a["out"], F.array(F.col("text").substr(a["at"] + 1, m["start"] - a["at"]), m["mark"])).alias("out"))))
    done = let(walked, lambda w: F.concat(F.array_join(w["out"], ""), F.col("text").substr(w["at"] + 1, F.char_length("text"))))
    return rows.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(done).alias("text"))
