"""Profiling: one or two aggregations per table, results as rows, nothing looped per column."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import lookup
from tidemark.functions.hashing import row_hash
from tidemark.operators.history import LINEAGE
from tidemark.operators.segments import segmented
from tidemark.session import stored

ID_SUFFIXES = ("_id", "_number")
CATEGORICAL_LIMIT = 25
#: Values of a column up to which they are counted, and the relative error of the sketch that says so.
FEW_VALUES, DISTINCT_ERROR = 10_000, 0.02
#: Rank errors: of the sketches, and how far from a rank its bracket reaches.
SKETCH_ERROR, BRACKET = 1e-4, 3e-4


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def _as_rows(wide: DataFrame, names: Sequence[str], fields: Sequence[str], label: str = "column") -> DataFrame:
    """One row per name from a one-row frame whose columns are called name__field."""
    items = F.array(*[F.struct(F.lit(n).alias(label), *[F.col(f"{n}__{f}").alias(f) for f in fields])
                      for n in names])
    return wide.select(F.explode(items).alias("_i")).select("_i.*")


def profile_table(df: DataFrame, table: str, key: str, batch: Column | None = None) -> DataFrame:
    """Rows, keys, duplicates and batches of one table, in one pass."""
    batch = F.lit(1) if batch is None else batch
    stats = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("distinct_non_null"),
                   F.count_if(F.col(key).isNull()).alias("null_keys"), F.countDistinct(batch).alias("batches"))
    # A NULL key is one more distinct key, as in SELECT DISTINCT.
    distinct = F.col("distinct_non_null") + F.when(F.col("null_keys") > 0, 1).otherwise(0)
    return stats.select(
        F.lit(table).alias("table"), "rows", distinct.alias("distinct_keys"),
        (F.col("rows") - distinct).alias("duplicate_keys"), "null_keys",
        F.lit(len([c for c in df.columns if c not in LINEAGE])).alias("columns"), "batches")


def duplicate_content(df: DataFrame, key: str) -> DataFrame:
    """Rows whose non-key content repeats another row's; only digests are shuffled."""
    content = [c for c in df.columns if c != key and c not in LINEAGE]
    return df.select(row_hash(content).alias("h")).agg(
        (F.count(F.lit(1)) - F.countDistinct("h")).alias("repeated_rows"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as text, n): map-side combined, so a frequent value costs one row per task."""
    cells = F.expr("array({})".format(", ".join(f"struct('{c}' AS column, CAST(`{c}` AS STRING) AS value)" for c in columns)))
    return (df.select(F.explode(cells).alias("_c")).groupBy("_c.column", "_c.value")
            .agg(F.count(F.lit(1)).alias("n")).select("column", "value", "n"))


def column_sketches(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, column, data_type, rows, nulls, estimate) of every column of every table: one pass per table, mergeable sketches only."""
    def one(name: str, df: DataFrame) -> DataFrame:
        columns = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in LINEAGE}
        # as SQL text: a call into the JVM for each operator of each column would take longer than the pass
        text = {c: f"`{c}`" if kind in ("int", "bigint", "string") else f"CAST(`{c}` AS STRING)" for c, kind in columns.items()}
        wide = df.agg(F.expr("count(1) AS _rows"), *[F.expr(a) for c in columns for a in (
            f"count_if(`{c}` IS NULL) AS `{c}__nulls`", f"hll_sketch_estimate(hll_sketch_agg({text[c]}, 12)) AS `{c}__estimate`")])
        cells = F.expr("array({})".format(", ".join(
            f"struct('{c}' AS column, '{kind}' AS data_type, _rows AS rows, `{c}__nulls` AS nulls, `{c}__estimate` AS estimate)" for c, kind in columns.items())))
        return wide.select(F.lit(name).alias("table"), F.explode(cells).alias("_c")).select("table", "_c.*")

    return union_all([one(name, df) for name, df in tables.items()])


def _counted(tables: dict[str, DataFrame], chosen: Sequence[tuple[str, str]]) -> DataFrame | None:
    """(table, column, value, n) of the chosen columns, exactly."""
    parts = [value_counts(df, mine).withColumn("table", F.lit(name)) for name, df in tables.items()
             if (mine := [c for t, c in chosen if t == name])]
    return union_all(parts) if parts else None


def profile_columns(tables: dict[str, DataFrame], limit: int = FEW_VALUES) -> DataFrame:
    """(table, column, data_type, nulls, null_pct, distinct, many) of every column of every table.

    Sketches of all columns come first. Values are then counted exactly, cell by cell, in the columns that may have up
    to limit of them; those with more, such as ids, are never shuffled: many is true and distinct is null.
    """
    sketched = column_sketches(tables).collect()  # a row per column
    # a column near the limit is counted; the exact count then decides
    chosen = [(r["table"], r["column"]) for r in sketched if r["estimate"] <= limit * (1 + 10 * DISTINCT_ERROR)]
    known = tables[next(iter(tables))].sparkSession.createDataFrame(
        [(*r, (r["table"], r["column"]) in chosen) for r in sketched],
        '`table` string, `column` string, data_type string, rows bigint, nulls bigint, estimate bigint, chosen boolean')
    counted = _counted(tables, chosen)
    if counted is None:
        met = known.withColumn("distinct", F.lit(None).cast("bigint"))
    else:
        exact = counted.groupBy("table", "column").agg(F.count("value").alias("distinct"))
        met = known.join(exact, ["table", "column"], "left")
    # a column that was chosen and has no counts belongs to an empty table
    distinct = F.when(F.col("chosen"), F.coalesce("distinct", F.lit(0)))
    many = distinct.isNull() | (distinct > limit)
    return met.select("table", "column", "data_type", "nulls", F.round(100.0 * F.col("nulls") / F.nullif("rows", F.lit(0)), 2).alias("null_pct"),
                      F.when(~many, distinct).alias("distinct"), many.alias("many"))


def profile_categoricals(tables: dict[str, DataFrame], exclude: Sequence[str] = ()) -> DataFrame:
    """(table, column, value, n): frequencies of the text and boolean columns with 2 to 25 distinct values.

    Only columns whose sketch says that they may have so few are counted.
    """
    kinds = {t: {f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude} for t, df in tables.items()}
    chosen = [(r["table"], r["column"]) for r in column_sketches(tables).collect()
              if r["column"] in kinds[r["table"]] and r["estimate"] <= CATEGORICAL_LIMIT * (1 + 10 * DISTINCT_ERROR)]
    counts = _counted(tables, chosen)
    if counts is None:
        return tables[next(iter(tables))].sparkSession.createDataFrame([], "`table` string, `column` string, value string, n bigint")
    counts = stored(counts, "values")
    few = (counts.groupBy("table", "column").agg(F.count("value").alias("d"))
           .where(F.col("d").between(2, CATEGORICAL_LIMIT)).select("table", "column"))
    return counts.join(F.broadcast(few), ["table", "column"])  # a row per column


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = (T.IntegerType, T.LongType, T.ShortType, T.DoubleType, T.FloatType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)
            and not f.name.endswith(ID_SUFFIXES) and f.name not in LINEAGE]


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Range, mean, deviation, negatives, zeros and nulls of the measure columns; one pass."""
    names = list(columns or numeric_columns(df))

    def stats(c: str) -> list[Column]:
        x = F.col(c).cast("double")
        return [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__mean"),
                F.stddev(x).alias(f"{c}__stddev"), F.count_if(x < 0).alias(f"{c}__negatives"),
                F.count_if(x == 0).alias(f"{c}__zeros"), F.count_if(x.isNull()).alias(f"{c}__nulls"),
                F.count(F.lit(1)).alias(f"{c}__rows")]

    fields = ["min", "max", "mean", "stddev", "negatives", "zeros", "nulls", "rows"]
    wide = df.agg(*[a for c in names for a in stats(c)])
    return _as_rows(wide, names, fields).withColumn(
        "zero_pct", F.round(100.0 * F.col("zeros") / F.col("rows"), 2))


# --- quantiles -----------------------------------------------------------------

def numeric_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as double, n) of the non-null values, map-side combined."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return (df.select(F.explode(cells).alias("_c")).where(F.col("_c.value").isNotNull())
            .groupBy("_c.column", "_c.value").agg(F.count(F.lit(1)).alias("n"))
            .select("column", "value", "n"))


def approximate_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                          error: float = 0.01) -> DataFrame:
    """(column, q: array) from a mergeable sketch, one pass."""
    accuracy = int(1 / error)
    wide = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probabilities), accuracy).alias(f"{c}__q")
                    for c in columns])
    return _as_rows(wide, list(columns), ["q"])


def _brackets(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], error: float) -> dict[str, list[list[float]]]:
    """For each column the disjoint value ranges [lo, hi] that should hold the ranks, from sketches in one pass."""
    around = sorted({min(max(p + side * error, 0.0), 1.0) for p in probabilities for side in (-1, 1)})
    found = {r["column"]: r["q"] for r in approximate_quantiles(df, columns, around, SKETCH_ERROR).collect()}  # a row per column
    out = {}
    for c in columns:
        at = dict(zip(around, found[c] or [], strict=False))
        ranges: list[list[float]] = []
        for p in sorted(probabilities) if at else ():
            lo, hi = p - error, p + error
            r = [at[lo] if lo > 0 else -math.inf, at[hi] if hi < 1 else math.inf]
            if ranges and r[0] <= ranges[-1][1]:
                ranges[-1][1] = max(ranges[-1][1], r[1])
            else:
                ranges.append(r)
        out[c] = ranges
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(column, q: array): exact interpolated quantiles in two passes over df, without collecting a column anywhere.

    Mergeable sketches bracket each rank by two values. The second pass counts: values inside a bracket by value, all
    others only by the gap between brackets that they fall in. What is left is about a thousandth of the rows, in order and with exact
    counts before it, and running counts find the ranks. Should a sketch have missed a rank, its column is
    bracketed anew, ten times as wide, so the result is exact whatever the sketches say.
    """
    missing, wide, done = list(columns), BRACKET, []
    while missing:
        found = stored(_ranked(df, missing, probabilities, wide), "quantiles")
        done.append(found.where("met").drop("met"))
        missing, wide = [r[0] for r in found.where("NOT met").select("column").collect()], wide * 10
    return functools.reduce(DataFrame.unionByName, done)


def _ranked(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], error: float) -> DataFrame:
    """(column, q, met): met is false where a rank lies outside the brackets."""
    brackets = _brackets(df, columns, probabilities, error)

    def cell(c: str) -> Column:
        value = F.col(c).cast("double")
        ends = [(F.lit(lo), F.lit(math.nan if hi == math.inf else hi)) for lo, hi in brackets[c]]  # NaN is the greatest value
        inside = functools.reduce(lambda a, b: a | b, [value.between(lo, hi) for lo, hi in ends], F.lit(False))
        gap = functools.reduce(lambda a, b: a + b, [F.when(value > hi, 1).otherwise(0) for _, hi in ends], F.lit(0))
        return F.struct(F.lit(c).alias("column"), value.isNotNull().alias("known"), gap.alias("gap"), F.when(inside, value).alias("value"))

    cells = (df.select(F.explode(F.array(*map(cell, columns))).alias("_c")).where("_c.known")
             .groupBy("_c.column", "_c.gap", "_c.value").agg(F.count(F.lit(1)).alias("n")))
    # the values of a gap come first, those of its bracket behind them; a null stands for all values of a gap
    running = segmented(cells, ["column"], ["gap", "value"], running={"upto": F.col("n")})
    # One row per profiled column: its total is a handful of numbers.
    totals = running.groupBy("column").agg(F.max("upto").alias("total"))
    ranked = running.join(F.broadcast(totals), "column")

    def at(rank: Column) -> Column:
        """The value at a zero-based rank: of the least running count that exceeds it."""
        return F.min_by("value", F.when(F.col("upto") > rank, F.col("upto")))

    picks, out, met = [], [], F.lit(True)
    for i, p in enumerate(probabilities):
        position = (F.col("total") - 1) * F.lit(float(p))
        picks += [at(F.floor(position)).alias(f"lo{i}"), at(F.ceil(position)).alias(f"hi{i}"),
                  F.max(position - F.floor(position)).alias(f"w{i}")]
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * F.col(f"w{i}")))
        met = met & F.col(f"lo{i}").isNotNull() & F.col(f"hi{i}").isNotNull()
    return ranked.groupBy("column").agg(*picks).select("column", F.array(*out).alias("q"), met.alias("met"))


def rank_errors(df: DataFrame, quantiles: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(column, probability, rank_error): how far the rank of a given quantile is from the one asked for, as a share of the rows.

    Counted in one pass: a value's ranks reach from the rows below it to the rows up to it.
    """
    given = {r["column"]: r["q"] for r in quantiles.collect()}  # a row per column
    asked = [(c, p, given[c][i]) for c in columns for i, p in enumerate(probabilities) if given.get(c)]
    value = [F.col(c).cast("double") for c, _, _ in asked]
    counted = df.agg(*[F.array(F.count_if(v < q), F.count_if(v <= q), F.count(v)).alias(f"a{i}") for i, (v, (_, _, q)) in enumerate(zip(value, asked, strict=True))])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("probability"), F.col(f"a{i}").alias("n")) for i, (c, p, _) in enumerate(asked)]
    each = counted.select(F.explode(F.array(*rows)).alias("r")).select("r.column", "r.probability", "r.n")
    rank = F.col("probability") * (F.col("n")[2] - 1)
    off = F.greatest(F.col("n")[0] - rank, rank - (F.col("n")[1] - 1), F.lit(0.0)) / F.col("n")[2]
    return each.select("column", "probability", off.alias("rank_error"))


def profile_outliers(df: DataFrame, columns: Sequence[str] | None = None, error: float | None = None) -> DataFrame:
    """Fences at 1.5 interquartile ranges, values beyond three deviations, and a skew sign.

    error None gives exact quartiles; a number gives sketched ones.
    """
    names = list(columns or numeric_columns(df))
    quarters = [0.25, 0.5, 0.75]
    quartiles = (exact_quantiles(df, names, quarters) if error is None
                 else approximate_quantiles(df, names, quarters, error))
    moments = profile_numeric(df, names).select("column", "mean", "stddev", "rows")
    q = F.col("q")
    limits = quartiles.join(moments, "column").select(
        "column", "mean", "stddev", "rows", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        (q[0] - 1.5 * (q[2] - q[0])).alias("lower_fence"), (q[2] + 1.5 * (q[2] - q[0])).alias("upper_fence"))
    # limits holds one row per profiled column.
    cells = numeric_cells(df, names).join(F.broadcast(limits), "column")
    value, n = F.col("value"), F.col("n")
    fixed = ["mean", "stddev", "rows", "q1", "median", "q3", "lower_fence", "upper_fence"]
    counted = cells.groupBy("column", *fixed).agg(
        F.sum(F.when((value < F.col("lower_fence")) | (value > F.col("upper_fence")), n).otherwise(0))
        .alias("iqr_outliers"),
        F.sum(F.when((F.col("stddev") > 0)
                     & (F.abs(value - F.col("mean")) > 3 * F.col("stddev")), n).otherwise(0)).alias("z3_outliers"))
    return counted.withColumns({
        "iqr_pct": F.round(100.0 * F.col("iqr_outliers") / F.col("rows"), 2),
        "skew_indicator": F.when(F.col("stddev") > 0, (F.col("mean") - F.col("median")) / F.col("stddev"))})


# --- dates and text ------------------------------------------------------------

def profile_dates(df: DataFrame, columns: Sequence[str], today: Column) -> DataFrame:
    """Range, distinct dates, rows per date, future and missing dates of all columns in one pass.

    Rows are counted per date first, so what is shuffled is bounded by the calendar.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("timestamp").alias("at")) for c in columns])
    days = (df.select(F.explode(cells).alias("_c")).groupBy("_c.column", F.col("_c.at").cast("date").alias("day"))
            .agg(F.min("_c.at").alias("lo"), F.max("_c.at").alias("hi"), F.count(F.lit(1)).alias("n")))
    zero = F.lit(0).cast("bigint")
    rows = days.groupBy("column").agg(
        F.min("lo").alias("min"), F.max("hi").alias("max"), F.count("day").alias("distinct_dates"),
        F.coalesce(F.sum(F.when(F.col("day") > today, F.col("n"))), zero).alias("future_dated"),
        F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col("n"))), zero).alias("nulls"), F.sum("n").alias("rows"))
    return rows.withColumn("rows_per_date", F.round(F.col("rows") / F.nullif("distinct_dates", F.lit(0)), 1))


def daily_counts(df: DataFrame, column: str) -> DataFrame:
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("n")))


def continuity(df: DataFrame, column: str) -> DataFrame:
    """Span, days present and missing, and rows per day; an aggregate of daily counts."""
    return daily_counts(df, column).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        (F.datediff(F.max("day"), F.min("day")) + 1).alias("span_days"), F.count("day").alias("days_present"),
        F.min("n").alias("min_per_day"), F.avg("n").alias("avg_per_day"), F.max("n").alias("max_per_day"),
    ).withColumn("days_missing", F.col("span_days") - F.col("days_present"))


def monthly_volume(df: DataFrame, column: str) -> DataFrame:
    return (daily_counts(df, column).groupBy(F.date_format("day", "yyyy-MM").alias("month"))
            .agg(F.sum("n").alias("rows")))


def profile_text(df: DataFrame, column: str) -> DataFrame:
    length = F.length(column)
    return df.agg(F.count(column).alias("non_null"), F.countDistinct(column).alias("distinct"),
                  F.min(length).alias("min_len"), F.avg(length).alias("avg_len"), F.max(length).alias("max_len"))


def top_values(df: DataFrame, column: str, k: int = 20) -> DataFrame:
    """The k most frequent values; ties by value, so the answer is fixed."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(column).asc_nulls_last()).limit(k))


# --- referential integrity -------------------------------------------------------

def reference_checks(tables: dict[str, DataFrame], keys: dict[str, str], references: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(child, column, parent, rows, nulls, null_pct, orphans, orphan_pct) of each foreign key (child, column, parent).

    One pass per table: a row says its references and, if its table is a parent, its key. All of it is stacked and counted by
    (parent, value), map-side combined, so a reference half the rows share is one row per task, and a value's
    parent and children meet without a join, whatever the number of foreign keys.
    """
    parents = {parent for _, _, parent in references}

    def said(table: str, df: DataFrame) -> DataFrame:
        cells = [f"struct({i} AS fk, '{parent}' AS parent, CAST(`{column}` AS STRING) AS value)"
                 for i, (child, column, parent) in enumerate(references) if child == table]
        cells += [f"struct(-1 AS fk, '{table}' AS parent, CAST(`{keys[table]}` AS STRING) AS value)"] if table in parents else []
        return df.select(F.expr(f"inline(array({', '.join(cells)}))"))

    used = [t for t in tables if t in parents or any(t == child for child, _, _ in references)]
    counts = [f"count_if(fk = {i}) AS n{i}" for i in range(len(references))]
    met = union_all([said(t, tables[t]) for t in used]).groupBy("parent", "value").agg(F.expr("max(fk = -1) AS known"), *map(F.expr, counts))
    each = ", ".join(f"struct({i} AS fk, n{i} AS n)" for i in range(len(references)))
    per_key = met.selectExpr("value", "known", f"inline(array({each}))").where("n > 0").groupBy("fk").agg(
        F.sum("n").alias("rows"), F.sum(F.expr("CASE WHEN value IS NULL THEN n ELSE 0 END")).alias("nulls"),
        F.sum(F.expr("CASE WHEN value IS NOT NULL AND NOT known THEN n ELSE 0 END")).alias("orphans"))

    def named(at: int) -> Column:
        return F.element_at(F.array(*[F.lit(r[at]) for r in references]), F.col("fk") + 1)

    return per_key.select(
        named(0).alias("child"), named(1).alias("column"), named(2).alias("parent"), "rows", "nulls",
        F.round(100.0 * F.col("nulls") / F.col("rows"), 2).alias("null_pct"), "orphans",
        F.round(100.0 * F.col("orphans") / F.col("rows"), 2).alias("orphan_pct"))
