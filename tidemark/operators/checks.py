"""Assertion queries over a built star: no rows, or only zeros, means healthy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key
from tidemark.operators.control import _successes, cdf_checkpoint
from tidemark.operators.detect import KeyLink
from tidemark.operators.profile import union_all


def two_way_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: distinct rows of left not in right, and of right not in left.

    Set difference both ways in one shuffle: stack, group by the row, keep who has it.
    """
    columns = left.columns
    tagged = (left.select(*columns, F.lit(True).alias("_l"))
              .unionByName(right.select(*columns, F.lit(False).alias("_l"))))
    rows = tagged.groupBy(*columns).agg(F.bool_or("_l").alias("in_left"), F.bool_or(~F.col("_l")).alias("in_right"))
    return rows.agg(F.count_if(F.col("in_left") & ~F.col("in_right")).alias("left_only"),
                    F.count_if(F.col("in_right") & ~F.col("in_left")).alias("right_only"))


def facts_match(fact: DataFrame, silver: DataFrame, name: str, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows, keys, live rows and carried columns of a fact against its current-state table.

    One shuffle for everything: both sides are stacked and grouped by the carried row.
    """
    f = fact.select(*columns, F.col("is_deleted_in_source").alias("deleted"), F.lit(True).alias("_g"))
    s = silver.select(*columns, F.col("_is_deleted_in_source").alias("deleted"), F.lit(False).alias("_g"))
    rows = f.unionByName(s).groupBy(*columns, "deleted").agg(
        F.count_if("_g").alias("_gold"), F.count_if(~F.col("_g")).alias("_silver"))
    gold, other, live = F.col("_gold"), F.col("_silver"), ~F.col("deleted")
    return rows.agg(
        F.sum(other).alias("silver_rows"), F.sum(gold).alias("gold_rows"),
        F.countDistinct(F.when(gold > 0, F.col(key))).alias("gold_keys"),
        F.sum(F.when(live, other).otherwise(0)).alias("silver_active"),
        F.sum(F.when(live, gold).otherwise(0)).alias("gold_active"),
        F.count_if((gold > 0) & (other == 0)).alias("gold_not_in_silver"),
        F.count_if((other > 0) & (gold == 0)).alias("silver_not_in_gold")).select(F.lit(name).alias("fact"), "*")


def _members(dim: DataFrame, link: KeyLink, id_column: str) -> tuple[DataFrame, DataFrame]:
    real = dim.where(F.col(link.dim_key) > 0)
    version = real.select(F.col(link.dim_key).alias("_k"), F.col(id_column).alias("_id"),
                          F.col("valid_from_date_key").alias("_from"), F.col("valid_to_date_key").alias("_to"))
    return version, real.select(F.col(id_column).alias("_mid")).distinct().withColumn("_exists", F.lit(True))


def bad_member_keys(rows: DataFrame, dim: DataFrame, link: KeyLink, id_column: str, reference: str,
                    date_column: str, hops: Sequence[tuple[Column, Column]] = ()) -> DataFrame:
    """rows with `bad_<column>`: the key is not the member's valid version nor the right special member.

    hops are (reference, found) pairs that come before the member on a multi-hop path.
    """
    version, known = _members(dim, link, id_column)
    rows = rows.join(version, F.col(link.column) == F.col("_k"), "left").join(
        known, F.col(reference) == F.col("_mid"), "left")
    key, day = F.col(link.column), F.col(date_column)
    right = ((F.col("_id") == F.col(reference)) & (day >= F.col("_from")) & (day < F.col("_to")))
    unknown = (key == -1) & F.col("_exists").isNull()
    ok = F.when(F.col(reference).isNull(), key == 0).otherwise(F.coalesce(right, F.lit(False)) | unknown)
    for ref, found in reversed(list(hops)):
        ok = F.when(ref.isNull(), key == 0).when(found.isNull(), key == -1).otherwise(ok)
    return rows.withColumn(f"bad_{link.column}", ~ok).drop("_k", "_id", "_from", "_to", "_mid", "_exists")


def count_bad(rows: DataFrame, fact: str, columns: Sequence[str], key_columns: Sequence[str]) -> DataFrame:
    """One row: how many rows fail each key, and how many hold an Unknown (reported only)."""
    unknown = F.array_contains(F.array(*[F.col(c).cast("bigint") for c in key_columns]), -1)
    return rows.agg(*[F.count_if(F.col(c)).alias(c) for c in columns],
                    F.count_if(unknown).alias("rows_with_unknown")).select(F.lit(fact).alias("fact"), "*")


def bad_date(column: str, value: Column) -> Column:
    """The date key is not the value's own: 0 for no value, else its YYYYMMDD."""
    return F.col(column) != date_key(value)


def special_members(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Dimensions whose special members are not exactly 0, -1 and -2: (dim, special_rows)."""
    parts = []
    for name, (dim, key) in dims.items():
        k = F.col(key)
        parts.append(dim.where(k <= 0).agg(
            F.count(F.lit(1)).alias("special_rows"), F.countDistinct(k).alias("d"), F.min(k).alias("lo"),
            F.max(k).alias("hi")).select(F.lit(name).alias("dim"), "special_rows", "d", "lo", "hi"))
    all_ = union_all(parts)
    good = ((F.col("special_rows") == 3) & (F.col("d") == 3) & (F.col("lo") == -2) & (F.col("hi") == 0))
    return all_.where(~F.coalesce(good, F.lit(False))).select("dim", "special_rows")


def duplicate_keys(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(model_table, duplicate_keys) for every dimension."""
    return union_all([
        dim.agg((F.count(F.lit(1)) - F.countDistinct(key)).alias("duplicate_keys"))
        .select(F.lit(name).alias("model_table"), "duplicate_keys") for name, (dim, key) in dims.items()])


def price_check(purchases: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Rows whose stated price differs from cost / gallons, and the greatest difference."""
    rows = purchases.where(~F.col("_is_deleted_in_source") & (F.col("gallons") > 0))
    gap = F.abs(F.col("total_cost") / F.col("gallons") - F.col("price_per_gallon")).cast("double")
    return rows.agg(F.count_if(gap >= tolerance).alias("rows_differing"), F.max(gap).alias("max_abs_difference"))


def control_problems(expected: DataFrame, ledger: DataFrame, run_log: DataFrame, worklist: DataFrame) -> DataFrame:
    """(problem, step_name, source_table, run_id, n): missing or extra checkpoints, leftovers."""
    have = cdf_checkpoint(ledger, run_log).select("step_name", "source_table")
    none = F.lit(None).cast("string")
    pair = ["step_name", "source_table"]

    def listed(df: DataFrame, problem: str) -> DataFrame:
        return df.select(F.lit(problem).alias("problem"), *pair, none.alias("run_id"),
                         F.lit(None).cast("bigint").alias("n"))

    left = (worklist.groupBy("run_id", "step_name").agg(F.count(F.lit(1)).alias("n"))
            .join(_successes(run_log).select("run_id", "step_name"), ["run_id", "step_name"], "left_semi")
            .select(F.lit("worklist rows left by a successful run").alias("problem"), "step_name",
                    none.alias("source_table"), F.col("run_id").cast("string").alias("run_id"), "n"))
    return union_all([listed(expected.join(have, pair, "left_anti"), "checkpoint missing"),
                      listed(have.join(expected, pair, "left_anti"), "unexpected checkpoint"), left])


def reconciliation_problems(results: DataFrame) -> DataFrame:
    """Failing verified metrics of the most recent attempt of the most recent run."""
    newest = results.agg(F.max_by(F.struct("run_id", "checked_at"), F.struct("checked_at", "run_id"))).scalar()
    return (results.withColumn("_n", newest)
            .where((F.col("run_id") == F.col("_n.run_id")) & (F.col("checked_at") == F.col("_n.checked_at"))
                   & F.col("is_verified") & (F.col("status") != "pass"))
            .select("run_id", "baseline_name", "metric_name", "status"))


def fingerprint(df: DataFrame, table: str) -> DataFrame:
    """Rows, deleted rows and the latest change in microseconds: zone-neutral and cheap."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("_is_deleted_in_source").alias("deleted_rows"),
        F.max(F.unix_micros(F.col("_source_changed_at").cast("timestamp"))).alias("changed_micros"),
    ).select(F.lit(table).alias("table"), "rows", "deleted_rows", "changed_micros")


def stale_copies(copy_a: DataFrame, copy_b: DataFrame) -> DataFrame:
    """Tables whose fingerprints differ between two copies."""
    fields = ["rows", "deleted_rows", "changed_micros"]
    a = copy_a.select("table", F.struct(*fields).alias("a"))
    b = copy_b.select("table", F.struct(*fields).alias("b"))
    return (a.join(b, "table", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
            .select("table", F.col("a.rows").alias("rows_a"), F.col("b.rows").alias("rows_b")))


def silver_contract(df: DataFrame, table: str, key: str, expected_live: Column) -> DataFrame:
    """rows == keys, contract columns never NULL, live rows as expected; one row with ok."""
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("keys"),
        F.count_if(F.col("_is_deleted_in_source").isNull() | F.col("_source_changed_at").isNull())
        .alias("null_contract"), F.count_if(~F.col("_is_deleted_in_source")).alias("live"))
    ok = ((F.col("rows") == F.col("keys")) & (F.col("null_contract") == 0) & (F.col("live") == F.col("expected_live")))
    return stats.withColumn("expected_live", expected_live).select(
        F.lit(table).alias("table"), "rows", "keys", "null_contract", "live", "expected_live", ok.alias("ok"))
