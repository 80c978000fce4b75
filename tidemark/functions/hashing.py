"""Row hashes over a text in which no two different rows look alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_text(columns: Sequence[str]) -> Column:
    """The columns' texts in order, each behind its length in bytes; a dash stands for NULL."""
    def field(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat_ws(",", *map(field, columns))


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the named columns; equal rows hash equally, '' and NULL do not."""
    return F.sha2(row_text(columns), 256)
