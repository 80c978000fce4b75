"""Ordered computations per key that survive a hot key: a scan over range partitions.

A window partitioned by a key sorts all rows of that key in one task. When one key
may hold a third of the table that task never ends. Here the rows are range-partitioned by key, order and tie, so a hot
key lies in several partitions and every partition holds about as many rows. The window runs per (partition,
key); a key that goes on over a border carries one row of state per partition into the next. The
result is exact, whatever bursts, far-off values or equal order values the data holds: nothing is counted or binned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

_PART = "_part"


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df with _part, the number of its range partition by keys and order, as a written table.

    Spark samples the borders of the ranges, so another computation of the same rows may draw them elsewhere. They
    are written once, and every use reads the same partitions. Partitions are as many as a shuffle has.
    """
    dealt = df.repartitionByRange(*[F.col(c).asc() for c in (*keys, *order)])
    return stored(dealt.withColumn(_PART, F.spark_partition_id()), "ranged")


def spanning(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that go on over a border of partitions: at most one per partition."""
    ends = rows.groupBy(_PART).agg(F.min(F.struct(*keys)).alias("_lo"), F.max(F.struct(*keys)).alias("_hi"))
    along = Window.orderBy(_PART)  # one row per partition
    return ends.select("_hi", F.lead("_lo").over(along).alias("_next")).where(F.col("_hi") == F.col("_next")).select("_hi.*").distinct()


def segmented(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lag: dict[str, Column] | None = None,
    last: dict[str, Column] | None = None,
    running: dict[str, Column] | None = None,
) -> DataFrame:
    """Add ordered per-key columns to df.

    keys must be non-null and order ascending and total within a key: its later columns break the ties of the first. The rows are
    written on the way, see ranged().

    lag      {name: expression}  the expression's value on the previous row
    last     {name: expression}  its latest non-null value up to this row
    running  {name: expression}  its sum up to this row
    """
    lag, last, running = lag or {}, last or {}, running or {}
    place = F.struct(*[F.col(c) for c in order])
    inner = Window.partitionBy(_PART, *keys).orderBy(*[F.col(c).asc() for c in order])
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    rows = ranged(df, keys, order)
    # Wrapped, so that a NULL value and a missing previous row stay different.
    values = {f"_v_{n}": F.struct(v.alias("v")) for n, v in lag.items()} | {f"_v_{n}": v for n, v in {**last, **running}.items()}
    rows = rows.withColumns(values)
    own = {f"_i_{n}": F.lag(f"_v_{n}").over(inner) for n in lag}
    own.update({f"_i_{n}": F.last(f"_v_{n}", ignorenulls=True).over(upto) for n in last})
    own.update({f"_i_{n}": F.sum(f"_v_{n}").over(upto) for n in running})

    # at most one key per border, so two rows of state per partition
    few = rows.join(F.broadcast(spanning(rows, keys)), list(keys), "left_semi")
    summary = few.groupBy(*keys, _PART).agg(
        *[F.max_by(f"_v_{n}", place).alias(f"_s_{n}") for n in lag],
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), place)).alias(f"_s_{n}") for n in last],
        *[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in running],
    )
    across = Window.partitionBy(*keys).orderBy(_PART)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys, _PART,
        *[F.lag(f"_s_{n}").over(across).alias(f"_c_{n}") for n in lag],
        *[F.last(f"_s_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in last],
        *[F.sum(f"_s_{n}").over(before).alias(f"_c_{n}") for n in running],
    )
    joined = rows.withColumns(own).join(F.broadcast(carried), [*keys, _PART], "left")
    result = {n: F.coalesce(f"_i_{n}", f"_c_{n}")["v"] for n in lag}
    result.update({n: F.coalesce(f"_i_{n}", f"_c_{n}") for n in last})
    result.update({
        n: F.when(F.col(f"_i_{n}").isNull(), F.col(f"_c_{n}"))
        .otherwise(F.col(f"_i_{n}") + F.coalesce(f"_c_{n}", F.lit(0))) for n in running
    })
    return joined.select(*[F.col(c) for c in df.columns], *[v.alias(n) for n, v in result.items()])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the greatest by order. Partial aggregation, no per-key sort."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the smallest by order."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def numbered(df: DataFrame, ids: Sequence[str], name: str, start: Column | int = 0) -> DataFrame:
    """Dense numbers start+1, start+2, ... without a single-task sort.

    Rows are spread over 4,096 buckets by a digest of their id, numbered within a
    bucket, and shifted by the rows of the earlier buckets. Only the 4,096 bucket
    counts are ever summed in one task. The order is (digest prefix, ids): stable for
    the same rows, which is all a surrogate key needs.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ids])
    spread = df.withColumn("_bucket", F.substring(F.md5(text.cast("binary")), 1, 3))
    within = Window.partitionBy("_bucket").orderBy(*ids)
    counts = spread.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    start_at = F.lit(start) if isinstance(start, int) else start
    return (
        spread.withColumn("_rank", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket")
        .select(*df.columns, (start_at + F.col("_offset") + F.col("_rank")).cast("bigint").alias(name))
    )
