"""Writers: slices, appends and batch exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed
from tidemark.functions.hashing import row_hash


def replace_slice(df: DataFrame, path: str, column: str = "_ingest_date") -> None:
    """Write df, replacing only the slices it holds; a rerun of a day is idempotent."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(path))


def append(df: DataFrame, path: str, column: str = "_ingest_date") -> None:
    """Append; rows a boundary read twice are kept twice."""
    df.write.mode("append").partitionBy(column).parquet(path)


def export_table(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Write one table of a batch: sorted by key within each file, never over an existing one.

    Range partitioning spreads the rows evenly even when one key is frequent, as the other
    columns break ties; files None lets Spark choose the number.
    """
    order = [key, *[c for c in df.columns if c != key]]
    spread = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    spread.sortWithinPartitions(*order).write.mode("errorifexists").option(
        "compression", "snappy").parquet(path)


def verify_export(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Read the files back and compare every row by digest; any difference is an error."""
    back = spark.read.parquet(path)
    if back.schema.simpleString() != df.schema.simpleString():
        raise CheckFailed(f"{path}: schema changed on the way")
    sides = (df.select(row_hash(df.columns).alias("h"), F.lit(1).alias("n"))
             .unionByName(back.select(row_hash(df.columns).alias("h"), F.lit(-1).alias("n"))))
    if not sides.groupBy("h").agg(F.sum("n").alias("n")).where("n <> 0").isEmpty():
        raise CheckFailed(f"{path}: rows read back differ from the rows written")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file through the cluster's file system, there as a whole or not at all, never replacing one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final, aside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.{uuid.uuid4().hex[:12]}.tmp"))
    fs = final.getFileSystem(conf)
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(aside, final, no_options)
    except Exception:
        fs.delete(aside, False)
        raise


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_text(spark: SparkSession, path: str) -> str | None:
    """One small text file on the driver, also one whose name Spark's sources skip; None where there is none."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    fs = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> set[str]:
    """The names in a folder, without those of checksums and of Spark's own marks."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = {s.getPath().getName() for s in fs.listStatus(path)} if fs.exists(path) else set()
    return {n for n in names if not n.startswith(".") and n != "_SUCCESS"}
