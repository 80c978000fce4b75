"""Tables laid out by key bucket, whose merges read and write only what a batch touches.

A table's rows lie in folders by bucket, a digest of the key; the number of buckets follows the bytes. A
merge takes the keys of a batch, rewrites the buckets they fall in and commits folders for those alone, so its work
follows the batch. The same write leaves the images of the rows that changed (before and after, with the
version) beside the data, under the same commit: the change feed is read by version and never joins two versions.

Keys are non-null and unique in a table. What a merge does to rows outside its batch's keys is nothing, by construction: the
merging function is given the batch's rows alone.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.compare import CheckFailed
from tidemark.operators.merge import change_feed
from tidemark.session import COMPACT, Steps, discard, is_large, stored
from tidemark.sources.versions import COMMIT, TableLog, side_by_side

#: A bucket holds about so many bytes; with four times as many on average the next merge makes four times as many buckets.
BUCKET_BYTES = 256 << 20
#: What a commit says of a bucketed table beside its version.
LAYOUT = "keys array<string>, buckets int, touched array<int>, filled array<int>, bytes bigint, feed boolean, schema string"


@dataclass(frozen=True)
class Merge:
    """keys: the batch's keys. next: from the table's rows of those keys to what takes their place."""

    keys: DataFrame
    next: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Layout:
    """A table at a version: the folder of each bucket that holds rows."""

    version: int
    keys: list[str]
    buckets: int
    folders: dict[int, str]
    schema: StructType
    bucket_bytes: float


def bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_for(df: DataFrame, bucket_bytes: int) -> int:
    """By the bytes of the tables that df reads, so it grows with the data. A source of unknown size counts as nothing: merges
    make more buckets once theirs are too full."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(1, math.ceil(sum(x for x in sizes if x < 1 << 60) / bucket_bytes))


class BucketLog(TableLog):
    """The bucketed tables under one root folder."""

    def __init__(self, spark, root: str, bucket_bytes: int = BUCKET_BYTES):
        super().__init__(spark, root)
        self.bucket_bytes = bucket_bytes
        self._read: dict[str, list[dict]] = {}

    def commits(self) -> DataFrame:
        return self.logged(f"{COMMIT}, {LAYOUT}")

    def entries(self) -> list[dict]:
        """The commit rows on the driver, in order. Commit files never change, so each is read once."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_commits")
        fs = folder.getFileSystem(conf)
        for status in fs.listStatus(folder) if fs.exists(folder) else ():
            name = status.getPath().getName()
            if name.endswith(".json") and name not in self._read:
                stream = fs.open(status.getPath())
                try:
                    text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
                self._read[name] = [json.loads(line) for line in text.splitlines()]
        return [row for name in sorted(self._read) for row in self._read[name]]

    def publish(self, run_id: str, tables: dict[str, DataFrame]) -> int:
        raise TypeError("a bucketed table has keys: use create")

    def layout(self, table: str, version: int | None = None) -> Layout:
        """Where the table's rows lie: its commits since it was last written whole, a short list, folded."""
        rows = [r for r in self.entries() if r["table"] == table and (version is None or r["version"] <= version)]
        folders: dict[int, str] = {}
        row = None
        for row in rows:
            if len(row["touched"]) == row["buckets"]:
                folders = {}
            for b in row["touched"]:
                folders.pop(b, None)
            folders |= {b: row["path"] for b in row["filled"]}
        if row is None or version is not None and row["version"] != version:
            raise KeyError(f"{table} has no version {version if version is not None else ''}".rstrip())
        size = row["bytes"] / max(1, len(row["filled"]))
        return Layout(row["version"], row["keys"], row["buckets"], folders, StructType.fromJson(json.loads(row["schema"])), size)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        return self._rows(self.layout(table, version))

    def _rows(self, at: Layout, buckets: Sequence[int] | None = None) -> DataFrame:
        paths = [f"{path}/_kind=row/_bucket={b}" for b, path in sorted(at.folders.items()) if buckets is None or b in set(buckets)]
        if not paths:
            return self.spark.createDataFrame([], at.schema)
        return self.spark.read.schema(at.schema).parquet(*paths)

    def create(self, run_id: str, tables: dict[str, tuple[DataFrame, Sequence[str]]], buckets: int | None = None) -> int:
        """Write tables (rows, keys) whole, as their next version; there is no feed over such a version."""
        sequence, known = self._next(), {r["table"]: r["version"] for r in self.entries()}

        def whole(item) -> dict:
            name, (df, keys) = item
            n = buckets or buckets_for(df, self.bucket_bytes)
            return self._written(name, run_id, known.get(name, 0) + 1, list(keys), n, list(range(n)), df, None)

        # large ones one at a time, so that disk holds the shuffle of one whole table
        large = {name for name, (df, _) in tables.items() if is_large(df)}
        rows = side_by_side(whole, [x for x in tables.items() if x[0] not in large]) + [whole(x) for x in tables.items() if x[0] in large]
        return self.commit(sequence, [{"commit_seq": sequence, **r} for r in rows])

    def rows_of(self, table: str, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The buckets of a table that the given keys fall in."""
        at = self.layout(table, version)
        return self._rows(at, self._touched(keys, at))

    def _touched(self, keys: DataFrame, at: Layout) -> list[int]:
        return [r[0] for r in keys.select(bucket(at.keys, at.buckets)).distinct().collect()]  # bucket numbers

    def merge(self, run_id: str, merges: dict[str, Merge]) -> int:
        """Apply the merges to their tables and commit them together."""
        sequence = self._next()

        def one(item) -> dict:
            name, merge = item
            at = self.layout(name)
            wide = at.bucket_bytes > 4 * self.bucket_bytes
            n = at.buckets * 4 if wide else at.buckets
            keys = stored(merge.keys.select(*at.keys).distinct(), "keys")   # a file's size is known: few keys are broadcast
            touched = sorted(at.folders) if wide else self._touched(keys, at)
            rows = self._rows(at, touched)
            names = at.schema.names
            # where the batch is large each join is done before the next shuffle begins
            steps = [Steps(), Steps()]
            batch = steps[0].after(rows.join(keys, at.keys, "left_semi").select(*names), keys)
            after = stored(merge.next(batch).select(*[F.col(f.name).cast(f.dataType) for f in at.schema]), "after")
            rest = steps[1].after(rows.join(keys, at.keys, "left_anti").select(*names), keys)
            done = self._written(name, run_id, at.version + 1, at.keys, n, list(range(n)) if wide else touched,
                                 rest.unionByName(after), change_feed(batch, after, at.keys))
            discard(keys)
            discard(after)
            for step in steps:
                step.end()
            return done

        return self.commit(sequence, [{"commit_seq": sequence, **r} for r in side_by_side(one, list(merges.items()))])

    def _next(self) -> int:
        return max((r["commit_seq"] for r in self.entries()), default=0) + 1

    def _written(self, name: str, run_id: str, version: int, keys: list[str], n: int, touched: list[int], rows: DataFrame,
                 images: DataFrame | None) -> dict:
        """Write rows and images of the touched buckets into a folder of this attempt; a task writes whole buckets, in order of the
        keys, as keys beside each other share their beginnings."""
        path = f"{self.root}/{name}/v{version:08d}-{run_id}-{uuid.uuid4().hex[:12]}"
        schema = rows.schema
        out = rows.withColumns({"_change_type": F.lit(None).cast("string"), "_kind": F.lit("row")})
        if images is not None:
            out = out.unionByName(images.withColumn("_kind", F.lit("change")))
        out = out.withColumns({"_version": F.lit(version).cast("bigint"), "_bucket": bucket(keys, n)})
        out = out.repartition(max(1, len(touched)), "_bucket").sortWithinPartitions("_kind", "_bucket", *keys)
        out.write.partitionBy("_kind", "_bucket").mode("errorifexists").options(**COMPACT).parquet(path)
        found = self._listed(f"{path}/_kind=row")
        filled = sorted(int(f.rpartition("=")[2]) for f, _ in found)
        if not set(filled) <= set(touched):
            raise CheckFailed(f"{name}: the merge made rows of keys that its batch doesn't hold")
        return {"run_id": run_id, "table": name, "version": version, "path": path, "keys": keys, "buckets": n, "touched": touched,
                "filled": filled, "bytes": sum(size for _, size in found), "feed": images is not None, "schema": schema.json()}

    def _listed(self, path: str) -> list[tuple[str, int]]:
        """(name, bytes) of the folders under path; none where it is missing."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        return [(s.getPath().getName(), fs.getContentSummary(s.getPath()).getLength()) for s in fs.listStatus(folder)]

    # --- the feed ---

    def changes(self, table: str, after: int, upto: int | None = None) -> DataFrame:
        """The images of the changes of versions after < version <= upto, with _change_type and _version.

        Equal versions give no rows. A version that was written whole has no feed: the window can't be read.
        """
        at = self.layout(table, upto)
        rows = [r for r in self.entries() if r["table"] == table and after < r["version"] <= at.version]
        if len(rows) != at.version - after or not all(r["feed"] for r in rows):
            raise CheckFailed(f"{table}: the changes after version {after} can't be read up to {at.version}")
        schema = StructType([*at.schema.fields, *StructType.fromDDL("_change_type string, _version bigint").fields])
        paths = [p for r in rows if self._listed(p := f"{r['path']}/_kind=change")]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def net_changes(self, table: str, after: int, upto: int | None = None) -> DataFrame:
        """changes() folded to one step: each key's first image before and last image after, where they differ."""
        at = self.layout(table, upto)
        feed = self.changes(table, after, upto)
        row = F.struct(*at.schema.names)
        old, new = F.col("_change_type").isin("update_preimage", "delete"), F.col("_change_type").isin("update_postimage", "insert")
        # an insert is no image before, a delete none after: the first and last event of a key say whether there was one
        folded = feed.groupBy(*at.keys).agg(
            F.min_by(F.struct(F.when(old, row).alias("row")), F.struct("_version", F.when(old, 0).otherwise(1))).alias("_first"),
            F.max_by(F.struct(F.when(new, row).alias("row")), F.struct("_version", F.when(new, 1).otherwise(0))).alias("_last"))
        a, b = F.col("_first.row"), F.col("_last.row")

        def image(kind: str, value):
            return F.struct(F.lit(kind).alias("_change_type"), value.alias("row"))

        images = (F.when(a.isNull() & b.isNull(), F.array().cast(f"array<struct<_change_type:string,row:{at.schema.simpleString()}>>"))
                  .when(a.isNull(), F.array(image("insert", b))).when(b.isNull(), F.array(image("delete", a)))
                  .when(~a.eqNullSafe(b), F.array(image("update_preimage", a), image("update_postimage", b))))
        return folded.select(F.explode(images).alias("_i")).select("_i.row.*", "_i._change_type")
