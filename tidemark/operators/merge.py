"""Keyed merges, change feeds and publishing over immutable tables.

Every function takes and returns whole DataFrames: Parquet has no in-place update, so
a merge is a full outer join on the key that yields the next version of the table.
Keys are unique on both sides, which keeps those joins free of skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed, differs

#: A change of these alone is no change of the row.
NON_BUSINESS = ("_silver_run_id", "_source_ingest_date", "_source_changed_at")


def _paired(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, _l (the left row without its keys) and _r (the right one), one line per key."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(F.lit(True).alias("_here"), *[c for c in df.columns if c not in keys]).alias(name))

    return side(left, "_l").join(side(right, "_r"), list(keys), "full_outer")


def merge_upsert(target: DataFrame, source: DataFrame, key: str, exclude: Sequence[str] = NON_BUSINESS,
                 now: Column | None = None, with_action: bool = False) -> DataFrame:
    """The next version of target: rows that differ updated, new rows inserted, none removed.

    target holds source's columns plus _silver_created_at and _silver_updated_at. A row
    whose compared columns are all equal, NULL to NULL, stays as it is, so that the
    change feed stays quiet.
    """
    now = F.current_timestamp() if now is None else now
    columns = [c for c in source.columns if c != key]
    compared = [c for c in columns if c not in exclude]
    pair = _paired(target, source, [key])
    action = (
        F.when(F.col("_l").isNull(), "insert").when(F.col("_r").isNull(), "keep")
        .when(differs([F.col(f"_l.{c}") for c in compared], [F.col(f"_r.{c}") for c in compared]), "update")
        .otherwise("keep"))
    pair = pair.withColumn("_action", action)
    written = F.col("_action") != "keep"
    out = [F.when(written, F.col(f"_r.{c}")).otherwise(F.col(f"_l.{c}")).alias(c) for c in columns]
    out.append(F.when(F.col("_action") == "insert", now).otherwise(F.col("_l._silver_created_at"))
               .alias("_silver_created_at"))
    out.append(F.when(written, now).otherwise(F.col("_l._silver_updated_at")).alias("_silver_updated_at"))
    if with_action:
        out.append(F.col("_action"))
    return pair.select(key, *out)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], carry: Sequence[str] | None = None) -> DataFrame:
    """Rows that changed between two versions, with _change_type.

    An update yields its pre-image and its post-image, so a key that moved away from a
    parent is still visible. With carry, images hold the keys and those columns alone; a digest tells if any other
    column changed, so whole rows are not shuffled. Both rows of a key are compared, no others: a change is missed
    by a chance of one in 2^64.
    """
    if carry is not None:
        kept = [*keys, *carry]

        def narrow(df: DataFrame) -> DataFrame:
            rest = [c for c in before.columns if c not in kept]
            # the hash passes over NULLs, so which columns hold them is hashed as well
            return df.select(*kept, F.xxhash64(*rest, *[F.col(c).isNull() for c in rest]).alias("_digest"))

        return change_feed(narrow(before), narrow(after), keys).drop("_digest")
    pair = _paired(before, after, keys)
    old, new = F.col("_l"), F.col("_r")

    def image(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), row.alias("row"))

    images = (
        F.when(old.isNull(), F.array(image("insert", new)))
        .when(new.isNull(), F.array(image("delete", old)))
        .when(~old.eqNullSafe(new), F.array(image("update_preimage", old), image("update_postimage", new))))
    changed = pair.select(*keys, F.explode(images).alias("_i"))
    return changed.select(*[F.col(c) if c in keys else F.col(f"_i.row.{c}") for c in before.columns], "_i._change_type")


def _marked(target: DataFrame, stage: DataFrame, worklist: DataFrame, key: str) -> DataFrame:
    """target with _staged and _listed, both on the same partitioning by key."""
    return (
        target.join(stage.select(key).distinct().withColumn("_staged", F.lit(True)), key, "left")
        .join(worklist.select(key).distinct().withColumn("_listed", F.lit(True)), key, "left"))


def publish_by_key(target: DataFrame, stage: DataFrame, worklist: DataFrame, key: str,
                   flag: str = "is_deleted_in_source") -> DataFrame:
    """The next version of target: staged keys replaced, listed keys without a stage row
    flagged deleted, every other row as it was."""
    listed_only = F.col("_listed").isNotNull()
    kept = _marked(target, stage, worklist, key).where(F.col("_staged").isNull()).select(
        *[(F.col(c) | listed_only).alias(c) if c == flag else F.col(c) for c in target.columns])
    return kept.unionByName(stage.select(*target.columns))


def publish_counts(target: DataFrame, stage: DataFrame, worklist: DataFrame, key: str,
                   key_columns: Sequence[str], flag: str = "is_deleted_in_source") -> DataFrame:
    """One row: active_before, inserted, updated, deleted and unknown of a publish."""
    new_flag = stage.select(key, F.col(flag).alias("_new_flag"))
    was = target.select(key, F.col(flag).alias("_old_flag"))
    listed = worklist.select(key).distinct().withColumn("_listed", F.lit(True))
    joined = was.join(new_flag, key, "full_outer").join(listed, key, "left")
    active = F.col("_old_flag") == F.lit(False)
    staged, existing = F.col("_new_flag").isNotNull(), F.col("_old_flag").isNotNull()
    moves = joined.agg(
        F.count_if(active).alias("active_before"),
        F.count_if(staged & ~existing).alias("inserted"),
        F.count_if(staged & existing).alias("updated"),
        F.count_if(active & (F.col("_new_flag") | (~staged & F.col("_listed").isNotNull()))).alias("deleted"))
    unknown = stage.agg(F.count_if(F.array_contains(F.array(*[F.col(c).cast("bigint") for c in key_columns]), -1))
                        .alias("unknown"))
    return moves.withColumn("unknown", unknown.scalar())


def mass_delete_verdict(counts: DataFrame, allow: bool = False, need_active: bool = True) -> DataFrame:
    """counts (active_before, deleted) with `blocked`: more than a tenth would be deleted.

    Facts need a non-empty target before they block (need_active); dimensions do not.
    """
    over = (F.col("deleted") > 0) & (F.col("deleted") * 10 > F.col("active_before"))
    if need_active:
        over = over & (F.col("active_before") > 0)
    return counts.withColumn("blocked", F.lit(False) if allow else over)


def mass_delete_guard(counts: DataFrame, what: str, allow: bool = False, need_active: bool = True) -> None:
    """Raise when the verdict blocks. Reads the one verdict row."""
    row = mass_delete_verdict(counts, allow, need_active).first()
    if row["blocked"]:
        raise CheckFailed(f"{what}: {row['deleted']} of {row['active_before']} active rows would be deleted")


def touch_rows(table: DataFrame, keys: DataFrame, key: str, run_id: str) -> DataFrame:
    """Rewrite the listed keys with equal values: only their run id changes."""
    listed = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    return table.join(listed, key, "left").select(
        *[F.when(F.col("_hit").isNotNull(), F.lit(run_id)).otherwise(F.col(c)).alias(c)
          if c == "_silver_run_id" else F.col(c) for c in table.columns])


def flag_deleted(table: DataFrame, keys: DataFrame, key: str, at: Column) -> DataFrame:
    """Flag the listed keys deleted, dated at."""
    listed = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    hit = F.col("_hit").isNotNull()
    swap = {"_is_deleted_in_source": F.lit(True), "_source_changed_at": at}
    return table.join(listed, key, "left").select(
        *[F.when(hit, swap[c]).otherwise(F.col(c)).alias(c) if c in swap else F.col(c) for c in table.columns])


def restore_flags(table: DataFrame, earlier: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Give the listed keys the deletion flag and change date of an earlier version."""
    back = (earlier.join(keys.select(key).distinct(), key, "left_semi")
            .select(key, F.col("_is_deleted_in_source").alias("_f"), F.col("_source_changed_at").alias("_d"))
            .withColumn("_hit", F.lit(True)))
    hit = F.col("_hit").isNotNull()
    swap = {"_is_deleted_in_source": F.col("_f"), "_source_changed_at": F.col("_d")}
    return table.join(back, key, "left").select(
        *[F.when(hit, swap[c]).otherwise(F.col(c)).alias(c) if c in swap else F.col(c) for c in table.columns])
