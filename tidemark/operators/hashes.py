"""Row-hash comparison of two tables and the decisions taken on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.operators.profile import union_all

#: Columns a row hash leaves out: where and when a row came from.
HASH_EXCLUDED = ("_source_ingest_date", "_silver_created_at", "_silver_updated_at", "_silver_run_id",
                 "_source_changed_at", "_source_batch_id", "_source_sequence")


def row_hashes(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(business_key, row_hash) over all columns but the lineage ones."""
    columns = [c for c in df.columns if c not in HASH_EXCLUDED] if columns is None else list(columns)
    return df.select(F.col(key).cast("string").alias("business_key"), row_hash(columns).alias("row_hash"))


def compare_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    """(business_key, status, repeated) for every key of two hash frames.

    Both sides are tagged, stacked and aggregated by key: one shuffle with map-side
    combining, and a key repeated a million times stays one row per task.
    """
    tagged = left.withColumn("_left", F.lit(True)).unionByName(right.withColumn("_left", F.lit(False)))
    mine = F.col("_left")
    per_key = tagged.groupBy("business_key").agg(
        F.count_if(mine).alias("n_left"), F.count_if(~mine).alias("n_right"),
        F.min("row_hash").alias("lo"), F.max("row_hash").alias("hi"))
    status = (F.when(F.col("n_right") == 0, "only_left").when(F.col("n_left") == 0, "only_right")
              .when(F.col("lo") == F.col("hi"), "equal").otherwise("changed"))
    return per_key.select("business_key", status.alias("status"),
                          ((F.col("n_left") > 1).cast("int") + (F.col("n_right") > 1).cast("int")).alias("repeated"))


def compare_hashes(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: keys equal, changed, only_left, only_right and repeated_keys."""
    status = F.col("status")
    return compare_keys(left, right).agg(
        *[F.count_if(status == s).alias(s) for s in ("equal", "changed", "only_left", "only_right")],
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated_keys"))


def difference_examples(left: DataFrame, right: DataFrame, sample: int = 5) -> DataFrame:
    """Up to `sample` least keys of each kind of difference; a top-k per kind, never a list per kind."""
    keys = compare_keys(left, right)
    return union_all([
        keys.where(F.col("status") == kind).select("status", "business_key").orderBy("business_key").limit(sample)
        for kind in ("changed", "only_left", "only_right")])


def snapshot_decision(batch: DataFrame, current: DataFrame, table: str) -> DataFrame:
    """One row per table: load into an empty target, unchanged when all equal, else reject.

    batch and current are hash frames. `current` empty is read off the same comparison.
    """
    stats = compare_hashes(batch, current)
    stored = F.col("equal") + F.col("changed") + F.col("only_right")
    differs = F.col("changed") + F.col("only_left") + F.col("only_right") + F.col("repeated_keys")
    decision = F.when(stored == 0, "load").when(differs > 0, "reject").otherwise("unchanged")
    return stats.select(F.lit(table).alias("table"), decision.alias("decision"), "*")


def batch_outcome(decisions: DataFrame) -> DataFrame:
    """One row for the whole batch: any reject rejects it, any load applies it."""
    d = F.col("decision")
    return decisions.agg(
        F.when(F.count_if(d == "reject") > 0, "rejected").when(F.count_if(d == "load") > 0, "applied")
        .otherwise("unchanged").alias("outcome"),
        F.count_if(d == "load").alias("to_load"), F.count_if(d == "reject").alias("rejected_tables"))


def capture_baseline(tables: dict[str, tuple[DataFrame, str]], label: str) -> DataFrame:
    """(label, table, business_key, row_hash) of several tables, to be appended once."""
    return union_all([row_hashes(df, key).select(F.lit(label).alias("label"), F.lit(name).alias("table"),
                                                 "business_key", "row_hash")
                      for name, (df, key) in tables.items()])


def compare_baseline(baseline: DataFrame, now: DataFrame) -> DataFrame:
    """Per table: equal, changed, only_left (baseline), only_right (now) and repeated keys."""
    tag = lambda df, left: df.select("table", "business_key", "row_hash", F.lit(left).alias("_left"))
    mine = F.col("_left")
    per_key = tag(baseline, True).unionByName(tag(now, False)).groupBy("table", "business_key").agg(
        F.count_if(mine).alias("n_left"), F.count_if(~mine).alias("n_right"),
        F.min("row_hash").alias("lo"), F.max("row_hash").alias("hi"))
    same = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    return per_key.groupBy("table").agg(
        F.count_if(same & (F.col("lo") == F.col("hi"))).alias("equal"),
        F.count_if(same & (F.col("lo") != F.col("hi"))).alias("changed"),
        F.count_if(F.col("n_right") == 0).alias("only_left"),
        F.count_if(F.col("n_left") == 0).alias("only_right"),
        F.sum((F.col("n_left") > 1).cast("int") + (F.col("n_right") > 1).cast("int")).alias("repeated_keys"))
