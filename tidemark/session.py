"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every operator relies on. UTC and ANSI change results; the adaptive
#: settings let Spark coalesce small shuffles and split skewed join partitions. Shuffle files are
#: deleted when the execution that wrote them ends, not when the driver happens to collect garbage.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

#: How table versions and intermediate tables are written: business keys are long texts that share their beginnings, so they are
#: stored as differences.
COMPACT = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_scratch: dict[str, str] = {}


def build_session(app: str = "tidemark", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench. On a cluster, use the cluster's own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to a session somebody else built.

    On a cluster shuffles start with eight partitions per core, so that those of a large
    input fit in memory; adaptive execution merges the small ones again. A number the
    session already states is left alone.
    """
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if not spark.sparkContext.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: spark.checkpoint.dir.

    Only a local session may go without the setting; it then gets one temporary
    folder per application. A cluster session without it is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _scratch:
        _scratch[sc.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _scratch[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, whatever reads it, and there if executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**COMPACT).parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.scratch = path
    return kept


def discard(df: DataFrame) -> None:
    """Delete a table of stored() that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def is_large(df: DataFrame) -> bool:
    """Whether a join with df shuffles the other side, by Spark's own estimate. That of joins is the product of their sides: it
    counts for no more than the tables read."""
    most = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most)
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return min(read, int(str(plan.stats().sizeInBytes()))) > limit


class Steps:
    """Joins with large tables, one after the other: the rows that come to each are written first, so what the join before
    has shuffled is gone, and disk holds the shuffle of one join instead of all."""

    def __init__(self):
        self.last: DataFrame | None = None

    def before(self, rows: DataFrame, other: DataFrame) -> DataFrame:
        """rows as they are to be joined with other; written if that shuffles them."""
        if not is_large(other):
            return rows
        kept = stored(rows, "step")
        self.end()
        self.last = kept
        return kept

    #: The rows of a join with other, written if that shuffled them.
    after = before

    def end(self) -> None:
        """Delete the rows written last, when nothing reads them any more."""
        if self.last is not None:
            discard(self.last)
            self.last = None

    def apart(self, other: DataFrame) -> DataFrame:
        """What rows are joined with, written first if it is large, so that its own joins are behind it."""
        return stored(other, "step") if is_large(other) else other


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and drop its lineage.

    A reliable checkpoint survives lost executors; a local one would not.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{shared_root(df.sparkSession)}/checkpoints")
    return df.checkpoint(eager=True)
