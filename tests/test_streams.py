import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators.history import sequenced
from tidemark.sources.buckets import BucketLog
from tidemark.streaming.landing import ingest, landed_stream, merge_stream

EVENT = ("k int, v string, _operation string, _event_id string, _source_sequence bigint, _source_changed_at timestamp, "
         "_batch_id string")
T = dt.datetime(2024, 1, 1)


def land(df, root, seq):
    df.coalesce(1).write.parquet(f"{root}/batch_seq={seq:06d}/t")


def test_ingest_resumes_without_repeats(spark, make, tmp_path):
    root = str(tmp_path / "landing")
    df = make("k int", (1,), (2,))
    land(df, root, 0)

    def run():
        ingest(landed_stream(spark, root, df.schema), str(tmp_path / "out"), str(tmp_path / "cp"))
        return rows_of(spark.read.parquet(str(tmp_path / "out")), "batch_seq", "k")

    assert run() == [(0, 1), (0, 2)]
    assert run() == [(0, 1), (0, 2)]
    land(df, root, 1)
    assert run() == [(0, 1), (0, 2), (1, 1), (1, 2)]


def test_merge_ignores_late_files(spark, make, tmp_path):
    root, log = str(tmp_path / "landing"), BucketLog(spark, str(tmp_path / "state"))
    start = make("k int, v string, _is_deleted_in_source boolean, _source_changed_at timestamp", (1, "a", False, T))
    log.create("start", {"t": (sequenced(start), ["k"])})
    newer = make(EVENT, (1, "c", "UPDATE", "e", 5, T, "b2"), (2, "n", "INSERT", "e", 6, T, "b2"))
    older = make(EVENT, (1, "b", "UPDATE", "e", 3, T, "b1"), (2, "x", "DELETE", "e", 2, T, "b1"))
    land(newer, root, 1)

    def run():
        merge_stream(landed_stream(spark, root, newer.schema, 1), log, "t", "k", str(tmp_path / "cp"))
        return rows_of(log.read("t"), "k", "v", "_is_deleted_in_source", "_source_sequence")

    want = [(1, "c", False, 5), (2, "n", False, 6)]
    assert run() == want
    land(older, root, 2)
    assert run() == want and run() == want


def test_batch_numbers_of_any_length(spark, make, tmp_path):
    root = str(tmp_path / "landing")
    df = make("k int", (1,))
    land(df, root, 3_000_000_001)
    ingest(landed_stream(spark, root, df.schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows_of(spark.read.parquet(str(tmp_path / "out")), "batch_seq") == [(3_000_000_001,)]
    df.write.parquet(f"{root}/elsewhere")
    with pytest.raises(Exception, match="no batch folder"):
        ingest(landed_stream(spark, root, df.schema), str(tmp_path / "out"), str(tmp_path / "cp"))


def test_merge_goes_on_after_a_run_that_died(spark, make, tmp_path, monkeypatch):
    root, log = str(tmp_path / "landing"), BucketLog(spark, str(tmp_path / "state"))
    start = make("k int, v string, _is_deleted_in_source boolean, _source_changed_at timestamp, _source_sequence bigint, _source_batch_id string",
                 (1, "a", False, T, 0, None))
    log.create("start", {"t": (start, ["k"])})
    newer = make(EVENT, (1, "c", "UPDATE", "e", 5, T, "b2"))
    land(newer, root, 1)

    def run():
        merge_stream(landed_stream(spark, root, newer.schema, 1), log, "t", "k", str(tmp_path / "cp"))

    with monkeypatch.context() as m:
        m.setattr("tidemark.sources.versions.write_text", lambda *_: (_ for _ in ()).throw(OSError("died before the commit")))
        with pytest.raises(Exception, match="died"):
            run()
    run()
    assert rows_of(log.read("t"), "k", "v") == [(1, "c")]


def test_work_follows_the_batch(spark, make, tmp_path):
    """A micro-batch of one key writes one bucket of many, and its rows are in the feed."""
    root, log = str(tmp_path / "landing"), BucketLog(spark, str(tmp_path / "state"))
    start = spark.range(2000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"), F.lit(False).alias("_is_deleted_in_source"), F.lit(T).alias("_source_changed_at"))
    log.create("start", {"t": (sequenced(start), ["k"])}, buckets=20)
    newer = make(EVENT, (1, "c", "UPDATE", "e", 5, T, "b2"))
    land(newer, root, 1)
    merge_stream(landed_stream(spark, root, newer.schema, 1), log, "t", "k", str(tmp_path / "cp"))
    before, after = log.layout("t", 1), log.layout("t")
    assert sum(before.folders[b] != after.folders[b] for b in range(20)) == 1
    assert rows_of(log.changes("t", 1), "k", "v", "_change_type") == [(1, "a", "update_preimage"), (1, "c", "update_postimage")]
