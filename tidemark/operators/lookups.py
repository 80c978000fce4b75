"""Surrogate key resolution with the three special members.

0 Missing: the reference is NULL. -1 Unknown: it is there but its lookup fails.
-2 Not Applicable: the thing referred to cannot exist yet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed
from tidemark.operators.segments import segmented

MISSING, UNKNOWN, NOT_APPLICABLE = 0, -1, -2


def key_or_special(reference: Column, hit: Column, *, possible: Column | None = None) -> Column:
    """The resolved key: -2 where not possible yet, 0 for no reference, -1 for a miss."""
    key = F.when(reference.isNull(), F.lit(MISSING)).otherwise(F.coalesce(hit, F.lit(UNKNOWN)))
    return key if possible is None else F.when(~possible, F.lit(NOT_APPLICABLE)).otherwise(key)


def as_of(rows: DataFrame, dim: DataFrame, id_column: str, key_column: str, date_key: str,
          out: str, reference: str | None = None) -> DataFrame:
    """Add `out`: the surrogate key of the version valid at date_key, NULL without one.

    Equality on the business id carries the join; the half-open validity range
    [valid_from, valid_to) is a residual condition on it. The versions of one id are
    few, so a hot id on the fact side is a skewed join that Spark splits at run time.
    """
    reference = reference or id_column
    versions = dim.where(F.col(key_column) > 0).select(
        F.col(id_column).alias("_id"), F.col(key_column).alias(out),
        F.col("valid_from_date_key").alias("_from"), F.col("valid_to_date_key").alias("_to"))
    valid = ((F.col(reference) == F.col("_id")) & (F.col(date_key) >= F.col("_from"))
             & (F.col(date_key) < F.col("_to")))
    return rows.join(versions, valid, "left").drop("_id", "_from", "_to")


def as_of_scan(rows: DataFrame, dim: DataFrame, id_column: str, key_column: str, date_key: str, out: str,
               reference: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """as_of() for ids with very many versions: no row meets more than the one version it takes.

    Rows and versions are stacked in order of (id, day) and the version opened last is carried forward along the scan of
    ``segmented``, so the work is the sum of both sides, not their product. Versions of an id don't overlap. carry names
    columns of dim that come along.
    """
    reference = reference or id_column
    opened = F.struct(F.col(key_column).alias("key"), F.col("valid_to_date_key").alias("until"), *carry)
    versions = dim.where((F.col(key_column) > 0) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("_id"), F.col("valid_from_date_key").alias("_at"), F.lit(0).alias("_kind"),
        F.col(key_column).cast("bigint").alias("_tie"), opened.alias("_version"))
    # a digest tells rows of one id and day apart, so that the ranges can part them
    mine = rows.select(F.col(reference).alias("_id"), F.col(date_key).alias("_at"), F.lit(1).alias("_kind"),
                       F.xxhash64(*rows.columns).alias("_tie"), F.struct(*rows.columns).alias("_row"))
    stacked = versions.unionByName(mine, allowMissingColumns=True)
    met = segmented(stacked, ["_id"], ["_at", "_kind", "_tie"], last={"_open": F.col("_version")}).where("_kind = 1")
    valid = F.col("_id").isNotNull() & (F.col("_at") < F.col("_open.until"))
    return met.select("_row.*", *[F.when(valid, F.col(f"_open.{c}")).alias(n) for c, n in (("key", out), *((c, c) for c in carry))])


def by_columns(rows: DataFrame, dim: DataFrame, columns: Sequence[str] | dict[str, str], key_column: str,
               out: str) -> DataFrame:
    """Add `out`: the key of the dimension row equal on the given columns."""
    pairs = columns if isinstance(columns, dict) else {c: c for c in columns}
    members = dim.where(F.col(key_column) > 0).select(
        *[F.col(d).alias(f"_m_{d}") for d in pairs.values()], F.col(key_column).alias(out))
    on = F.lit(True)
    for mine, theirs in pairs.items():
        on = on & (F.col(mine) == F.col(f"_m_{theirs}"))
    return rows.join(members, on, "left").drop(*[f"_m_{d}" for d in pairs.values()])


def date_role(rows: DataFrame, dim_date: DataFrame, role_key: str, out: str) -> DataFrame:
    """Add `out`: role_key where dim_date holds that day, else NULL.

    A calendar is bounded, so the join is one hash probe per row and role.
    """
    days = dim_date.where(F.col("date_key") > 0).select(F.col("date_key").alias(out))
    return rows.join(days, F.col(role_key) == F.col(out), "left")


def special_date(value: Column, hit: Column, missing: int = MISSING) -> Column:
    """A date key with its special members: `missing` for no date, -1 outside dim_date."""
    return F.when(value.isNull(), F.lit(missing)).otherwise(F.coalesce(hit, F.lit(UNKNOWN))).cast("int")


def assert_grain(stage: DataFrame, key: str, what: str) -> DataFrame:
    """stage itself, after checking that no key resolved to two dimension rows."""
    row = stage.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key).alias("d")).first()
    if row["n"] != row["d"]:
        raise CheckFailed(f"{what}: {row['n']} rows for {row['d']} keys")
    return stage
