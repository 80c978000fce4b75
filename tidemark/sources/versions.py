"""Table versions as Parquet folders and one commit row per table and run.

A run writes all its tables into new folders first and appends its commit rows last, in
one file, so readers see either the whole run or none of it. Earlier versions stay
readable, which is what a change feed and a restore need.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import COMPACT
from tidemark.sources.sinks import exists, write_text

COMMIT = "commit_seq bigint, run_id string, table string, version bigint, path string"


def side_by_side(write: Callable, rows: list) -> list:
    """Independent writes; Spark runs the jobs of several threads side by side."""
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(rows)))) as pool:
        return list(pool.map(write, rows))


class TableLog:
    """The versioned tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> DataFrame:
        return self.logged(COMMIT)

    def logged(self, schema: str) -> DataFrame:
        """The commit rows, with the fields asked for."""
        path = f"{self.root}/_commits"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", "*.json").json(path)

    def current(self) -> DataFrame:
        """The newest version per table: a few rows, one per table."""
        newest = self.commits().groupBy("table").agg(
            F.max_by(F.struct("version", "path"), "commit_seq").alias("c"), F.max("commit_seq").alias("commit_seq"))
        return newest.select("table", "c.version", "c.path", "commit_seq")

    def publish(self, run_id: str, tables: dict[str, DataFrame]) -> int:
        """Write new versions of the tables and commit them together; returns the sequence.

        The commit is one new file whose name is its sequence. Creating it fails when another
        run committed that sequence first, so two writers cannot both win. Folders are new with each
        attempt: what a run that died has left behind is in nobody's way.
        """
        attempt = uuid.uuid4().hex[:12]
        known = {r["table"]: r for r in self.current().collect()}  # one row per table
        sequence = max((r["commit_seq"] for r in known.values()), default=0) + 1
        rows = []
        for name in tables:
            version = known[name]["version"] + 1 if name in known else 1
            rows.append({"commit_seq": sequence, "run_id": run_id, "table": name, "version": version,
                         "path": f"{self.root}/{name}/v{version:08d}-{run_id}-{attempt}"})
        side_by_side(lambda r: tables[r["table"]].write.mode("errorifexists").options(**COMPACT).parquet(r["path"]), rows)
        return self.commit(sequence, rows)

    def commit(self, sequence: int, rows: list[dict]) -> int:
        """One new file holds a run's rows; they are visible from then on. Fails where the sequence is taken."""
        lines = [json.dumps(r) for r in rows]
        write_text(self.spark, f"{self.root}/_commits/commit-{sequence:010d}.json", "\n".join(lines) + "\n")
        return sequence

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table at a version, the newest committed one by default."""
        rows = self.commits().where(F.col("table") == table)
        if version is not None:
            rows = rows.where(F.col("version") == version)
        row = rows.orderBy(F.col("commit_seq").desc()).select("path").first()
        if row is None:
            raise KeyError(f"{table} has no version {version if version is not None else ''}".rstrip())
        return self.spark.read.parquet(row["path"])
