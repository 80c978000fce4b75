"""What the operators share: tables, Arrow batches of bounded size, written intermediate tables, hot keys."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut, scratch_path, shared_root

__all__ = ["aside", "cut", "discard", "drop", "mark_hot", "open_shared", "pack", "put_back", "row_slices", "scratch_path", "shared_root", "slices", "split_join", "spread", "stored", "table", "tokenizer", "unpack"]

#: Rows of one Arrow batch; slices() then cuts or joins batches by bytes.
BATCH_ROWS = 1000
#: A key with more than this share of the rows is hot, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read in Arrow batches of few rows because texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, read by several branches."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.scratch = path
    return kept


def discard(*tables: DataFrame) -> None:
    """Delete tables of stored() that nothing reads any more."""
    for df in tables:
        drop(df.sparkSession, df.scratch)


def drop(spark: SparkSession, folder: str) -> None:
    """Delete a folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, mb: int = 64, least: int = 1) -> int:
    """A number of partitions that follows the estimated bytes of df, so that each holds about mb.

    For a df whose size Spark doesn't know (not read from files) it is the session's number.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > 1 << 60:
        return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, size // (mb << 20) + 1)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """The rows of batches regrouped so that column has about limit bytes; one longer row stands alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        bytes_ = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        lo = 0
        while lo < batch.num_rows:
            ends = np.cumsum(bytes_[lo:])
            n = int(np.searchsorted(ends, limit - size, side="right"))
            if n == 0 and not held:
                n = 1
            if n:
                held.append(batch.slice(lo, n))
                size += int(ends[n - 1])
                lo += n
            if lo < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def row_slices(batches: Iterable[pa.RecordBatch], column: str, limit: int, most: int = 64) -> Iterator[pa.Table]:
    """slices() with also a bound on rows, those of ``most`` batches: texts may all be empty."""
    rest = iter(batches)
    for first in rest:
        yield from slices(itertools.chain([first], itertools.islice(rest, most - 1)), column, limit)


def pack(values: np.ndarray) -> bytes:
    """An integer array, its bytes by significance and compressed."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def aside(df: DataFrame, *own: str) -> Column:
    """All columns of df but own as one struct column _row, so that no name of theirs meets an operator's own."""
    rest = [c for c in df.columns if c not in own]
    return F.struct(*[df[f"`{c}`"] for c in rest] or [F.lit(None).alias("none")]).alias("_row")


def put_back(columns: list[str], *own: str) -> list[Column]:
    """The columns of a frame that went through aside(), in their order."""
    return [F.col(c) if c in own else F.col(f"_row.`{c}`").alias(c) for c in columns]


def mark_hot(keyed: DataFrame, count: str) -> DataFrame:
    """keyed, one row per key with the key's rows in count, with the flag _hot: over HOT_SHARE of all rows.

    Such keys are at most 1 / HOT_SHARE many, whatever the size.
    """
    total = keyed.agg(F.sum(count).alias("_total"))
    return keyed.crossJoin(F.broadcast(total)).withColumn("_hot", F.col(count) > F.col("_total") * HOT_SHARE).drop("_total")


def split_join(rows: DataFrame, marked: DataFrame, keys: list[str]) -> DataFrame:
    """rows left-joined with marked, one row per key as mark_hot made it. Null keys match null keys.

    Hot keys are broadcast, being few by their definition. The others are left to Spark, and there the rows
    of hot keys are dealt out evenly, so that no partition gets a hot key's rows.
    """
    values = [c for c in marked.columns if c not in keys and c != "_hot"]

    def side(hot: bool, prefix: str) -> DataFrame:
        return marked.where("_hot" if hot else "not _hot").select(*[F.col(k).alias(f"{prefix}k_{k}") for k in keys], *[F.col(c).alias(f"{prefix}v_{c}") for c in values], F.lit(True).alias(f"{prefix}met"))

    def same(prefix: str):
        return functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}k_{k}")) for k in keys])

    met = rows.join(F.broadcast(side(True, "_h")), same("_h"), "left")
    met = met.withColumn("_deal", F.when(F.col("_hmet"), F.monotonically_increasing_id()).otherwise(F.xxhash64(*keys)))
    cold = side(False, "_c").withColumn("_cdeal", F.xxhash64(*[F.col(f"_ck_{k}") for k in keys]))
    met = met.join(cold, same("_c") & (F.col("_deal") == F.col("_cdeal")), "left")
    return met.select(*[rows[c] for c in rows.columns], *[F.coalesce(F.col(f"_hv_{c}"), F.col(f"_cv_{c}")).alias(c) for c in values])


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """A tokenizer of the tokenizers library, loaded once in each Python worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    import tokenizers

    return tokenizers.Tokenizer.from_file(path)


def open_shared(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a place in the shared folder, for tasks that read or write whole files."""
    return pa.fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
