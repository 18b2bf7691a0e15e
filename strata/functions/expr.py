"""Column-expression helpers.

Every helper returns a plain ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: ColumnLike, den: ColumnLike) -> Column:
    """num / den with NULL for a zero or NULL denominator (ANSI-safe).

    SQLite yields NULL for x/0 and pandas yields inf/NaN that the reference then
    maps to NULL, so NULL is the common meaning.
    """
    d = col(den)
    return F.when(d != 0, col(num) / d)


def pct(num: ColumnLike, den: ColumnLike) -> Column:
    """100 * num / den as DOUBLE (the literal is a double, not a DECIMAL)."""
    return F.lit(100.0) * col(num) / F.when(col(den) != 0, col(den))


def clip(c: ColumnLike, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest``/``least`` would skip it)."""
    x = col(c)
    out = x
    if hi is not None:
        out = F.when(x > F.lit(hi), F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(x < F.lit(lo), F.lit(lo)).otherwise(out)
    return out


def floor_zero(c: ColumnLike) -> Column:
    return clip(c, lo=0)


def round_half_even(c: ColumnLike, digits: int = 0) -> Column:
    """pandas ``.round`` semantics (banker's rounding)."""
    return F.bround(col(c), digits)


def round_half_up(c: ColumnLike, digits: int = 0) -> Column:
    """SQL ``ROUND`` semantics (half away from zero)."""
    return F.round(col(c), digits)


def strip_all(c: ColumnLike) -> Column:
    """Python ``str.strip()``: drop every leading/trailing whitespace character."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def title_case(c: ColumnLike) -> Column:
    """Python ``str.title()``: upper-case a letter that follows a non-letter.

    ``initcap`` only restarts after a space, so ``GUINEA-BISSAU`` would become
    ``Guinea-bissau``. Splitting after every non-letter and capitalising each
    piece keeps the Python behaviour (``Guinea-Bissau``, ``D'Ivoire``).
    """
    pieces = F.split(F.lower(col(c)), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(pieces, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.right(w, F.length(w) - 1))), "")


def month_key(c: ColumnLike) -> Column:
    """``substr(date, 1, 7)`` on an ISO date, i.e. ``yyyy-MM``."""
    return F.date_format(col(c), "yyyy-MM")


def year_key(c: ColumnLike) -> Column:
    return F.year(col(c))


def bucket(c: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """CASE WHEN c < e1 THEN l1 WHEN c < e2 THEN l2 ... ELSE l_last END.

    NULL input falls into the ELSE label, as in SQL.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need len(edges) + 1 labels")
    x = col(c)
    out = None
    for edge, label in zip(edges, labels):
        out = F.when(x < F.lit(edge), F.lit(label)) if out is None else out.when(x < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1])) if out is not None else F.lit(labels[-1])


def lookup(index: ColumnLike, values: Sequence[float]) -> Column:
    """0-based lookup into a fixed literal list (e.g. a weekday factor table)."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), col(index) + 1)


def md5_fraction_below(key_cols: Sequence[ColumnLike], fraction: float) -> Column:
    """Deterministic sampling predicate: the first 8 hex digits of md5(key) below
    ``fraction * 2^32``, compared as fixed-width lowercase hex text; 1 keeps every row.

    Reproducible in any engine and under any partitioning, unlike ``sample``.
    Use integer or text keys: their string form is the same everywhere.
    """
    key = F.concat_ws("|", *[col(k).cast("string") for k in key_cols])
    if fraction >= 1:
        return F.lit(True)
    bound = format(int(max(fraction, 0.0) * (1 << 32)), "08x")
    return F.substring(F.md5(key), 1, 8) < F.lit(bound)
