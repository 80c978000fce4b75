"""Null-safe comparisons and guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True where any pair differs, NULL equal to NULL."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


def any_flag(flags: Sequence[Column]) -> Column:
    """OR of flags; a NULL flag counts as not set."""
    result = F.lit(False)
    for flag in flags:
        result = result | F.coalesce(flag, F.lit(False))
    return result


def ratio(numerator: Column, denominator: Column) -> Column:
    """Total over total as a double, NULL where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def decimal_ratio(numerator: Column, denominator: Column) -> Column:
    """Total over total in decimals, for figures that are rounded and compared exactly."""
    return numerator / F.nullif(denominator, F.lit(0))


def mean(values: Column) -> Column:
    """Exact total over count, so the result does not depend on the order of the rows."""
    return ratio(F.sum(values), F.count(values))


def lookup(values: dict, key: Column) -> Column:
    """The value a short fixed mapping gives for key, NULL without one."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


class CheckFailed(ValueError):
    """A data check that stops a load."""


def fail_if(df: DataFrame, message: str) -> None:
    """Raise when df has any row. Reads one row, wherever it is."""
    if not df.isEmpty():
        raise CheckFailed(message)
