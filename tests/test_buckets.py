"""Bucketed tables: what a merge reads, writes and leaves in the feed."""

import pathlib
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed
from tidemark.operators.merge import change_feed
from tidemark.session import shared_root
from tidemark.sources.buckets import BucketLog, Merge, buckets_for

ROW = "k int, v string"


def replaced(rows):
    """A merge that puts rows in place of the batch's keys."""
    return lambda _: rows


@pytest.fixture
def log(spark, tmp_path):
    return BucketLog(spark, str(tmp_path / "log"))


def test_untouched_buckets_keep_their_files(spark, make, log):
    table = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    log.create("r1", {"t": (table, ["k"])}, buckets=16)
    before = log.layout("t")
    batch = make(ROW, (7, "b"), (2000, "n"))
    log.merge("r2", {"t": Merge(batch, replaced(batch))})
    after = log.layout("t")
    moved = {b for b in range(16) if before.folders.get(b) != after.folders.get(b)}
    assert 1 <= len(moved) <= 2
    assert all(after.folders[b].split("/")[-1].startswith("v00000001") for b in after.folders if b not in moved)
    assert log.read("t").count() == 1001 and rows_of(log.read("t").where("v <> 'a'"), "k", "v") == [(2000, "n"), (7, "b")]
    assert log.read("t", 1).count() == 1000


def test_a_merge_leaves_no_intermediate_tables(spark, make, log):
    """Keys and new rows of a batch lay in the shared folder for good."""
    table = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    log.create("r1", {"t": (table, ["k"])}, buckets=4)
    left = {f.name for f in pathlib.Path(shared_root(spark)).rglob("rdd-*")} | {f.name for f in pathlib.Path(shared_root(spark)).iterdir()}
    batch = make(ROW, (7, "b"), (2000, "n"))
    log.merge("r2", {"t": Merge(batch, replaced(batch))})
    now = {f.name for f in pathlib.Path(shared_root(spark)).rglob("rdd-*")} | {f.name for f in pathlib.Path(shared_root(spark)).iterdir()}
    assert now == left and log.read("t").count() == 1001


def test_rows_read_follow_the_batch_and_not_the_target(spark, make, log):
    for n in (1000, 8000):
        table = spark.range(n).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
        log.create(f"r{n}", {f"t{n}": (table, ["k"])}, buckets=n // 125)
    batch = make(ROW, (7, "b"))
    read = [log.rows_of(f"t{n}", batch).count() for n in (1000, 8000)]
    assert max(read) < 250


def test_feed_equals_the_join_of_both_versions_in_1000_random_batches(spark, make, log):
    rng = random.Random(4)
    cases = range(1000)
    old = {(c, k): rng.choice(["a", "b", None]) for c in cases for k in range(5) if rng.random() < 0.6}
    keys = {(c, k) for c in cases for k in range(5) if rng.random() < 0.4}
    new = {x: rng.choice(["a", "b", None]) for x in keys if rng.random() < 0.8}
    schema = "c int, k int, v string"
    before = make(schema, *[(*x, v) for x, v in old.items()])
    log.create("r1", {"t": (before, ["c", "k"])}, buckets=8)
    fresh = make(schema, *[(*x, v) for x, v in new.items()])
    log.merge("r2", {"t": Merge(make("c int, k int", *keys), replaced(fresh))})
    expected = {x: v for x, v in old.items() if x not in keys} | new
    columns = ["c", "k", "v"]
    assert rows_of(log.read("t"), *columns) == rows_of(make(schema, *[(*x, v) for x, v in expected.items()]), *columns)
    feed = log.changes("t", 1)
    assert rows_of(feed, *columns, "_change_type") == rows_of(change_feed(log.read("t", 1), log.read("t"), ["c", "k"]), *columns, "_change_type")
    assert "Join" not in feed._jdf.queryExecution().toString()


def test_feed_over_several_versions_folds_to_one_step(spark, make, log):
    rng = random.Random(9)
    state = {k: "a" for k in range(6)}
    log.create("r0", {"t": (make(ROW, *state.items()), ["k"])}, buckets=3)
    for i in range(5):
        keys = rng.sample(range(10), 4)
        rows = [(k, rng.choice("abc")) for k in keys if rng.random() < 0.7]
        fresh = make(ROW, *rows)
        log.merge(f"r{i + 1}", {"t": Merge(make("k int", *[(k,) for k in keys]), replaced(fresh))})
    for after, upto in ((1, 6), (2, 4), (3, 3)):
        expected = change_feed(log.read("t", after), log.read("t", upto), ["k"])
        assert rows_of(log.net_changes("t", after, upto), "k", "v", "_change_type") == rows_of(expected, "k", "v", "_change_type")
    assert log.changes("t", 6).isEmpty()


def test_a_version_written_whole_has_no_feed(make, log):
    log.create("r1", {"t": (make(ROW, (1, "a")), ["k"])})
    log.create("r2", {"t": (make(ROW, (1, "b")), ["k"])})
    with pytest.raises(CheckFailed):
        log.changes("t", 1)
    with pytest.raises(KeyError):
        log.read("t", 9)


def test_a_merge_outside_its_batch_is_refused(spark, make, log):
    table = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    log.create("r1", {"t": (table, ["k"])}, buckets=16)
    with pytest.raises(CheckFailed):
        log.merge("r2", {"t": Merge(make("k int", (1,)), replaced(table.withColumn("v", F.lit("z"))))})
    assert log.layout("t").version == 1


def test_buckets_follow_the_bytes_and_grow(spark, make, tmp_path):
    log = BucketLog(spark, str(tmp_path / "log"), bucket_bytes=2000)
    wide = spark.range(3000).select(F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    for n in (300, 3000):
        wide.limit(n).coalesce(1).write.parquet(str(tmp_path / f"n{n}"))
    assert 1 < 5 * buckets_for(spark.read.parquet(str(tmp_path / "n300")), 2000) < buckets_for(spark.read.parquet(str(tmp_path / "n3000")), 2000)
    log.create("r1", {"t": (make(ROW, (1, "a")), ["k"])}, buckets=1)
    log.merge("r2", {"t": Merge(wide.select("k"), replaced(wide))})
    assert log.layout("t").buckets == 1
    batch = make(ROW, (5, "b"))
    log.merge("r3", {"t": Merge(batch, replaced(batch))})
    assert log.layout("t").buckets == 4 and log.read("t").count() == 3000
    assert rows_of(log.changes("t", 2).where("v = 'b'"), "k", "_change_type") == [(5, "update_postimage")]


def test_empty_tables_and_batches(make, log):
    empty = make(ROW, (1, "a")).where("false")
    log.create("r1", {"t": (empty, ["k"])}, buckets=2)
    assert log.read("t").isEmpty() and log.read("t").columns == ["k", "v"]
    log.merge("r2", {"t": Merge(empty, replaced(empty))})
    assert log.read("t").isEmpty() and log.changes("t", 1).isEmpty()
    one = make(ROW, (1, "a"))
    log.merge("r3", {"t": Merge(one, replaced(one))})
    log.merge("r4", {"t": Merge(one, replaced(empty))})
    assert log.read("t").isEmpty() and rows_of(log.changes("t", 3), "k", "_change_type") == [(1, "delete")]


def test_buckets_are_written_compactly(spark, tmp_path):
    log = BucketLog(spark, str(tmp_path / "log"))
    log.create("run-1", {"t": (spark.range(10).withColumnRenamed("id", "k"), ["k"])})
    files = [f.name for f in (tmp_path / "log").rglob("*.parquet") if f.is_file()]
    assert files and all(".zstd." in f for f in files)
