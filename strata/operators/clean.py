"""Cleaning operators (E1-E11, E17, E18, E24-E26), in the order they must run:
names -> dedupe -> floor -> fill -> derive -> validate.

Each returns a lazy DataFrame; audits are DataFrames too (one aggregate each),
so a caller decides when to run them. ``assert_valid`` is the only step that
triggers a job and raises.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.functions.expr import clip, strip_all, title_case
from strata.operators import features as feat
from strata.operators.star import DIM_NOT_NULL, FACT_NOT_NULL


# ---------------------------------------------------------------- E1-E3
def standardize_names(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Strip all whitespace, then Python-style title case."""
    return df.withColumn(out or column, title_case(strip_all(column)))


def map_labels(df: DataFrame, column: str, mapping: Mapping[str, str], out: str | None = None) -> DataFrame:
    """Replace labels found in ``mapping``; others pass through.

    The map is a literal (driver-side constant). For a mapping table that
    grows with data, join it instead (``map_labels_table``).
    """
    if not mapping:
        return df if out is None else df.withColumn(out, F.col(column))
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(out or column, F.coalesce(F.element_at(m, F.col(column)), F.col(column)))


def map_labels_table(df: DataFrame, column: str, mapping: DataFrame, src: str, dst: str,
                     out: str | None = None) -> DataFrame:
    """E2 for large dictionaries: left join on the label (planner/AQE pick broadcast by size)."""
    j = df.join(mapping.select(F.col(src).alias("__src"), F.col(dst).alias("__dst")),
                F.col(column) == F.col("__src"), "left")
    return j.withColumn(out or column, F.coalesce("__dst", F.col(column))).drop("__src", "__dst")


def distinct_label_audit(before: DataFrame, after: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """Distinct labels before and after a step, one row."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    b = before.select(fn(column).alias("n"))
    a = after.select(fn(column).alias("n"))
    return before.sparkSession.range(1).select(
        b.scalar().cast("bigint").alias("labels_before"), a.scalar().cast("bigint").alias("labels_after"))


# ---------------------------------------------------------------- E4
def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order`` (an explicit ingest order).

    ``row_number() == 1``: Catalyst puts a partial WindowGroupLimit before the
    shuffle, so a key with a huge number of copies ships one row per map task.
    ``order`` plus the remaining columns form a total order, so the kept row is
    deterministic. (An aggregate ``min(struct(...))`` over whole rows can't hash
    and sorts them on both sides of the shuffle.)
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


# ---------------------------------------------------------------- E5-E7
def floor_negatives(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E5: clip below at 0, NULL kept."""
    return df.withColumns({c: clip(c, lo=0) for c in columns})


def negative_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """E5 audit: rows below 0 per column, one aggregate, long form (column, violations)."""
    aggs = [F.count_if(F.col(c) < 0).alias(c) for c in columns]
    return _long(df.agg(*aggs), columns, "column", "violations")


def clip_range(df: DataFrame, column: str, lo: float, hi: float, out: str | None = None) -> DataFrame:
    """Clip to [lo, hi]."""
    return df.withColumn(out or column, clip(column, lo, hi))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column in one pass, long form (column, n_null)."""
    cols = list(columns or df.columns)
    return _long(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]), cols, "column", "n_null")


def _long(one_row: DataFrame, cols: Sequence[str], key: str, value: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return one_row.selectExpr(f"stack({len(cols)}, {pairs}) as ({key}, {value})")


# ---------------------------------------------------------------- E8-E11
def recompute_missing_ratio(df: DataFrame, rate: str, num: str, den: str, digits: int = 4) -> DataFrame:
    """Fill a NULL ratio with num/den (den 0 -> NULL), then 0; half-even on every row."""
    fill = F.col(num) / F.when(F.col(den) != 0, F.col(den))
    return df.withColumn(rate, F.bround(F.coalesce(F.col(rate), fill, F.lit(0.0)), digits))


def fill_series_gaps(df: DataFrame, columns: Sequence[str], entity: str, date: str,
                     default: float | int = 0) -> DataFrame:
    """Per entity by date, forward fill, then back fill the leading gap, then ``default``."""
    w = feat.series_window(entity, date)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    # after the forward fill only the leading gap is open: the series' first value closes it, in one pass
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(back),
                                         F.first(c, ignorenulls=True).over(whole), F.lit(default))
                           for c in columns})


def round_to_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Half-even to an integer (BIGINT)."""
    return df.withColumns({c: F.bround(F.col(c)).cast("bigint") for c in columns})


def sort_panel(df: DataFrame, entity: str, date: str, num_partitions: int | None = None) -> DataFrame:
    """File layout for writes: entity-clustered, date-sorted within each file.

    Order inside Spark belongs to windows; this only makes parquet row-group
    statistics useful for entity/date filters.
    """
    parts = [num_partitions] if num_partitions else []
    return df.repartition(*parts, entity).sortWithinPartitions(entity, date)


# ---------------------------------------------------------------- E17, E18
def validate_panel(df: DataFrame, entity: str = "country", date: str = "date",
                   flows: Sequence[str] = ("new_cases",), deaths: str = "total_deaths",
                   cases: str = "total_cases") -> DataFrame:
    """(check, violations) for the hard checks, two aggregates.

    A missing flow or stock is a violation: a check holds only where it is known to hold.
    """
    def fails(ok: Column) -> Column:
        return F.count_if(~F.coalesce(ok, F.lit(False)))

    row_checks = [F.count_if(F.col(date).isNull()).alias("null_date")]
    row_checks += [fails(F.col(f) >= 0).alias(f"negative_{f}") for f in flows]
    row_checks.append(fails(F.col(deaths) <= F.col(cases) + 1).alias("deaths_exceed_cases"))
    names = ["null_date"] + [f"negative_{f}" for f in flows] + ["deaths_exceed_cases"]
    rows = _long(df.agg(*row_checks), names, "check", "violations")
    dups = (df.groupBy(entity, date).count().where(F.col("count") > 1)
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("violations"))
            .select(F.lit("duplicate_key").alias("check"), "violations"))
    return rows.select("check", F.col("violations").cast("bigint")).unionByName(dups)


def assert_valid(report: DataFrame) -> None:
    """Raise if any check in a ``validate_panel`` report has violations (one small job)."""
    bad = report.where(F.col("violations") > 0).collect()
    if bad:
        raise ValueError("validation failed: " + ", ".join(f"{r['check']}={r['violations']}" for r in bad))


def row_audit(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter; the count is read from the Observation after the next action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


# ---------------------------------------------------------------- E24-E26
def constraint_checks(fact: DataFrame, dim: DataFrame, entity: str = "country_id", date: str = "report_date",
                      name: str = "country_name", not_null: Sequence[str] = FACT_NOT_NULL,
                      dim_not_null: Sequence[str] = DIM_NOT_NULL) -> DataFrame:
    """NOT NULL of both tables, UNIQUE(name), UNIQUE(entity, date), foreign key fact -> dim, as (check, violations).

    A column that a table lacks is NULL in all its rows.
    """
    def nulls(t: DataFrame, c: str) -> Column:
        return F.count_if(F.col(c).isNull()) if c in t.columns else F.count(F.lit(1))

    parts = [_long(t.agg(*[nulls(t, c).alias(c) for c in nn]), nn, "column", "v")
             .select(F.concat(F.lit("not_null_"), F.col("column")).alias("check"), F.col("v").alias("violations"))
             for t, nn in ((fact, list(not_null)), (dim, list(dim_not_null))) if nn]
    parts.append(dim.groupBy(name).count().where("count > 1")
                 .agg(F.count(F.lit(1)).alias("violations")).select(F.lit("unique_name").alias("check"), "violations"))
    parts.append(fact.groupBy(entity, date).count().where("count > 1")
                 .agg(F.count(F.lit(1)).alias("violations")).select(F.lit("unique_key").alias("check"), "violations"))
    orphans = fact.select(entity).join(dim.select(entity), entity, "left_anti")
    parts.append(orphans.agg(F.count(F.lit(1)).alias("violations")).select(F.lit("foreign_key").alias("check"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("check", F.col("violations").cast("bigint"))


def sanity_metrics(fact: DataFrame, dim: DataFrame, entity: str = "country_id", date: str = "report_date",
                   approx: bool = False) -> DataFrame:
    """Row counts, distinct entities, date range as (label, value) text rows."""
    distinct = F.approx_count_distinct(entity) if approx else F.count_distinct(entity)
    f = fact.agg(F.count(F.lit(1)).alias("n"), distinct.alias("d"), F.min(date).alias("lo"), F.max(date).alias("hi"))
    d = dim.agg(F.count(F.lit(1)).alias("n"))
    return f.select(
        F.lit(d.scalar()).cast("string").alias("dim_rows"), F.col("n").cast("string").alias("fact_rows"),
        F.col("d").cast("string").alias("distinct_entities"),
        F.col("lo").cast("string").alias("min_date"), F.col("hi").cast("string").alias("max_date"),
    ).selectExpr("stack(5, 'dim_rows', dim_rows, 'fact_rows', fact_rows, 'distinct_entities', distinct_entities,"
                 " 'min_date', min_date, 'max_date', max_date) as (label, value)")


def clean_panel(raw: DataFrame, entity: str = "country", date: str = "date", *,
                   names: bool = True, dedupe_order: Sequence[str] | None = None,
                   population: str = "population", audit: list | None = None) -> DataFrame:
    """E1 -> E4 -> E5 -> E8 -> E9/E10 -> E12..E16 on a raw panel.

    ``names=False`` skips E1 for labels that are already clean. ``dedupe_order``
    (ingest-order columns) turns on E4; a panel built on a date spine is unique
    by construction and needs no dedupe shuffle. ``audit`` (a list) gets (step, Observation)
    pairs: the rows before and after each step that can drop some, counted while the frame runs.
    """
    def count(frame: DataFrame, step: str) -> DataFrame:
        if audit is None:
            return frame
        frame, seen = row_audit(frame, step)
        audit.append((step, seen))
        return frame

    df = count(raw, "input")
    if names:
        df = standardize_names(df, entity)
    if dedupe_order:
        df = count(dedupe_keep_first(df, [entity, date], dedupe_order), "deduplicated")
    df = floor_negatives(df, ["new_cases"])
    df = recompute_missing_ratio(df, "positive_rate", "new_cases", "new_tests", 4)
    df = fill_series_gaps(df, ["icu_patients"], entity, date)
    df = round_to_int(df, ["icu_patients"])
    df = feat.fatality_rate(df)
    df = feat.per_million(df, "total_cases", population, "cases_per_million")
    df = feat.per_million(df, "total_deaths", population, "deaths_per_million")
    df = feat.coverage_pct(df, "people_fully_vaccinated", population, "vaccination_rate_pct", 2, cap=True)
    df = feat.coverage_pct(df, "total_tests", population, "testing_rate_pct", 2, cap=False)
    df = feat.rolling_mean(df, "new_cases", "new_cases_7day_avg", 7, 1, entity, date, digits=1)
    df = feat.rolling_mean(df, "new_deaths", "new_deaths_7day_avg", 7, 1, entity, date, digits=1)
    df = feat.growth_wow(df, "new_cases_7day_avg", "case_growth_wow_pct", 7, entity, date, 2)
    return df
