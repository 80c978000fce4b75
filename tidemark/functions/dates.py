"""Date keys, durations and calendar expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the open end of a validity interval.
OPEN_END = 99991231


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(day) -> Column:
    """YYYYMMDD as an int; 0 for a NULL date, so no validity interval contains it."""
    d = _col(day)
    return F.coalesce(F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d), F.lit(0)).cast("int")


def key_month(key) -> Column:
    """First day of a date key's month; the caller keeps special keys (<= 0) out."""
    k = _col(key)
    return F.make_date(F.floor(k / 10000).cast("int"), (F.floor(k / 100) % 100).cast("int"), F.lit(1))


def key_date(key) -> Column:
    k = _col(key)
    return F.make_date(F.floor(k / 10000).cast("int"), (F.floor(k / 100) % 100).cast("int"), (k % 100).cast("int"))


def micros_between(start, end) -> Column:
    return F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))


def hours_between(start, end) -> Column:
    """Hours at full microsecond precision, half-up to two decimals."""
    hours = micros_between(start, end).cast("decimal(20,0)") / F.lit(Decimal(3600000000))
    return F.round(hours, 2).cast("decimal(10,2)")


def month_name(day) -> Column:
    return F.date_format(_col(day), "MMMM")
