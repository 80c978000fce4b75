"""Structured Streaming forms of landing and merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.history import sequenced
from tidemark.plans import landing
from tidemark.plans.registry import query
from tidemark.plans.trucking import given
from tidemark.session import scratch_path
from tidemark.sources.buckets import BucketLog
from tidemark.streaming.landing import ingest, landed_stream, merge_stream


def _write_batches(df, root):
    """One folder batch_seq=NNNNNN per value of seq, the way batches land; a large batch is written by several tasks."""
    named = df.withColumns({"batch_seq": F.format_string("%06d", "seq"), "_part": F.pmod(F.xxhash64(*df.columns), F.lit(8))}).drop("seq")
    named.repartition("batch_seq", "_part").drop("_part").write.partitionBy("batch_seq").parquet(root)


@query("stream_landing_ingest", "batch_seq bigint, rows bigint, total double", """
    SELECT day(ts) - 1 AS batch_seq, count(*) AS rows, sum(CAST(value AS DECIMAL(14,2))) AS total
    FROM events GROUP BY 1""")
def stream_landing_ingest(spark, sf):
    """A batch per day lands as files; the stream ingests all of them and stops."""
    events = given(spark, sf, "events").select(
        "event_id", "user_id", F.col("value").cast("decimal(14,2)").alias("value"),
        (F.dayofmonth("ts") - 1).alias("seq"))
    root = scratch_path(spark, "landing")
    schema = events.drop("seq").schema
    _write_batches(events, root)
    ingest(landed_stream(spark, root, schema, 10), f"{root}-bronze", f"{root}-checkpoint")
    landed = spark.read.parquet(f"{root}-bronze")
    return landed.groupBy("batch_seq").agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("total"))


@query("stream_merge_current_state", "user_id bigint, event_type string, value double, deleted flag, seq bigint", """
    WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn
                                 FROM user_changes) WHERE rn = 1)
    SELECT coalesce(s.user_id, l.user_id) AS user_id, coalesce(l.event_type, s.event_type) AS event_type,
           coalesce(l.value, s.value) AS value, coalesce(l.operation = 'DELETE', s.deleted) AS deleted,
           coalesce(l.seq, 0) AS seq
    FROM user_snapshot AS s FULL JOIN last AS l ON l.user_id = s.user_id""")
def stream_merge_current_state(spark, sf):
    """Change events arrive in files of several days; late files do not undo newer rows."""
    snapshot, events = landing.user_change_events(spark, sf)
    root = scratch_path(spark, "landing")
    # Ten-day batches, the latest first, so that files arrive out of order.
    staged = events.withColumn("seq", (3 - F.floor(F.dayofmonth("_source_changed_at") / 10)).cast("int"))
    _write_batches(staged, root)
    log = BucketLog(spark, f"{root}-state", 4 << 20)
    log.create("snapshot", {"users": (sequenced(snapshot), ["user_id"])})
    merge_stream(landed_stream(spark, root, events.schema, 8), log, "users", "user_id", f"{root}-checkpoint")
    return log.read("users").select("user_id", "event_type", "value", F.col("_is_deleted_in_source").alias("deleted"),
                                    F.col("_source_sequence").alias("seq"))
