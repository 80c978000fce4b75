import datetime as dt
import hashlib

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import CheckFailed
from tidemark.session import shared_root, tune
from tidemark.sources import readers as R
from tidemark.sources import sinks as K
from tidemark.sources.versions import TableLog


def test_jdbc_options():
    o = R.jdbc_options("jdbc:x", "t", partition=("c", "2022-01-01", "2025-01-01", 8))
    assert o["dbtable"] == "t" and o["fetchsize"] == "10000" and o["numPartitions"] == "8"
    assert R.jdbc_options("jdbc:x", "t", query="select 1")["query"] == "select 1"
    with pytest.raises(ValueError):
        R.jdbc_options("jdbc:x", "t", query="q", partition=("c", 1, 2, 3))


def test_strides_hold_every_row(make):
    lo, hi = dt.date(2024, 1, 1), dt.date(2024, 1, 11)
    df = make("d date", (None,), (dt.date(2020, 1, 1),), (lo,), (dt.date(2024, 1, 6),), (hi,), (dt.date(2030, 1, 1),))
    assert rows_of(df.select("d", R.stride("d", lo, hi, 2).alias("s")), "s") == [(0,), (0,), (0,), (1,), (1,), (1,)]


def test_watermark_is_inclusive_and_reaches_the_scan(spark, tmp_path):
    spark.range(100).select(F.col("id"), (F.col("id") % 10).alias("t")).write.parquet(str(tmp_path / "s"))
    src = spark.read.parquet(str(tmp_path / "s"))
    landed = src.where("t <= 7")
    assert R.since_watermark(src, landed, "t").count() == 30
    assert R.after_watermark(src, landed, "t").count() == 20
    assert R.since_watermark(src, landed.where("false"), "t").count() == 100
    plan = R.since_watermark(src, landed, "t")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(t,7)" in plan


def test_csv_is_typed_and_strict(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,d,x\nA,2024-01-01,1.50\nB,,\n")
    schema = T.StructType.fromDDL("id string, d date, x decimal(8,2)")
    assert rows_of(R.read_csv(spark, str(tmp_path), schema), "id", "d") == [("A", dt.date(2024, 1, 1)), ("B", None)]
    (tmp_path / "b.csv").write_text("id,d,x\nC,yesterday,1\n")
    with pytest.raises(Exception):
        R.read_csv(spark, str(tmp_path), schema).collect()


def test_digests(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "short.parquet").write_bytes(b"PAR1 cut off")
    got = {r["path"].rsplit("/", 1)[1]: r for r in R.file_digests(spark, str(tmp_path)).collect()}
    for file in (tmp_path / "t").glob("*.parquet"):
        r = got[file.name]
        assert r["sha256"] == hashlib.sha256(file.read_bytes()).hexdigest() and r["bytes"] == file.stat().st_size
        assert r["complete"] == (file.name != "short.parquet")


def test_slices_are_replaced_and_appends_kept(make, spark, tmp_path):
    path = str(tmp_path / "b")
    df = make("k int, _ingest_date string", (1, "d1"), (2, "d2"))
    K.replace_slice(df, path)
    K.replace_slice(make("k int, _ingest_date string", (9, "d2")), path)
    read = lambda: rows_of(spark.read.schema("k int, _ingest_date string").parquet(path), "k", "_ingest_date")
    assert read() == [(1, "d1"), (9, "d2")]
    K.append(df, path)
    assert read() == [(1, "d1"), (1, "d1"), (2, "d2"), (9, "d2")]


def test_export_never_overwrites_and_is_verified(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    path = str(tmp_path / "x")
    K.export_table(df, path, "k", files=3)
    K.verify_export(spark, df, path)
    with pytest.raises(CheckFailed):
        K.verify_export(spark, df.withColumn("v", F.col("v") + 1), path)
    with pytest.raises(Exception):
        K.export_table(df, path, "k")


def test_versions_commit_together(spark, tmp_path):
    log = TableLog(spark, str(tmp_path / "log"))
    with pytest.raises(KeyError):
        log.read("a")
    log.publish("r1", {"a": spark.range(3), "b": spark.range(1)})
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception):
        log.publish("r2", {"a": spark.range(9), "b": bad})
    assert (log.read("a").count(), log.read("b").count()) == (3, 1)  # nothing of the failed run is visible
    with pytest.raises(Exception):
        log.publish("r3", {"a": spark.range(9), "b": bad})
    log.publish("r3", {"a": spark.range(5)})  # the same run again after it died between writing and committing
    assert (log.read("a").count(), log.read("a", 1).count()) == (5, 3)
    assert rows_of(log.current(), "table", "version", "commit_seq") == [("a", 2, 2), ("b", 1, 1)]


def test_session_rules(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Vienna")
    assert tune(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    assert shared_root(spark) == shared_root(spark)
