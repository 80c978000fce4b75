"""Landed batches, manifests and control tables derived from the given tables.

The reference data of these operators is a handful of rows. Here every order day is a
batch, so the tables grow with the data, and defects are planted by arithmetic on the day
number so that every rule fires.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.manifests import content_hash, folder_name
from tidemark.plans.trucking import given, source

DAY0 = "1995-01-01"


def day_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, day, n): one batch per order day, with its number of orders."""
    day = F.col("o_orderdate").cast("date")
    return (given(spark, sf_dir, "orders").groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.datediff("day", F.lit(DAY0).cast("date")).cast("bigint").alias("seq"), "day", "n"))


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(folder, path, content, landed_at): a manifest text per batch, some of them broken.

    seq 0 is the initial snapshot. By seq modulo 20: 3 has no JSON, 5 no content hash
    field, 7 a wrong sequence, 9 an empty path, 11 wrong operation counts, 13 a wrong
    content hash, 15 a table without change batches.
    """
    b = day_batches(spark, sf_dir)
    seq, n, kind = F.col("seq"), F.col("n"), F.col("seq") % 20
    snapshot = seq == 0
    digest = F.sha2(F.concat_ws("|", seq.cast("string"), n.cast("string")).cast("binary"), 256)
    table = F.when(kind == 15, "routes").otherwise("loads")
    path = F.when(kind == 9, "loads/").otherwise(F.concat(table, F.lit("/part-0.parquet")))
    inserts = n - F.when(kind == 11, 1).otherwise(0)
    spec = F.struct(
        F.array(F.struct(path.alias("path"), (n * 10).alias("bytes"), digest.alias("sha256"))).alias("files"),
        n.alias("row_count"), F.when(snapshot, 0).otherwise(1).cast("bigint").alias("min_sequence"),
        F.when(snapshot, 0).otherwise(n).cast("bigint").alias("max_sequence"),
        F.when(~snapshot, F.struct(inserts.alias("INSERT"), F.lit(0).alias("UPDATE"), F.lit(0).alias("DELETE")))
        .alias("operation_counts"))
    typed = F.create_map(table, spec)
    spec_type = ("map<string,struct<files:array<struct<path:string,bytes:bigint,sha256:string>>,row_count:bigint,"
                 "min_sequence:bigint,max_sequence:bigint,operation_counts:struct<INSERT:bigint,UPDATE:bigint,"
                 "DELETE:bigint>>>")
    right = content_hash(typed.cast(spec_type))
    options = {"ignoreNullFields": "false"}
    fields = [
        F.lit("1").alias("contract_version"),
        F.format_string("batch-%06d", seq).alias("batch_id"),
        F.when(kind == 7, seq + 1).otherwise(seq).alias("batch_seq"),
        F.when(snapshot, "INITIAL_SNAPSHOT").otherwise("CHANGE_BATCH").alias("mode"),
        F.when(~snapshot, F.col("day").cast("string")).alias("business_date"),
        F.when(snapshot, F.col("day").cast("string")).alias("as_of_date"),
        F.when(~snapshot, F.format_string("batch-%06d", seq - 1)).alias("previous_batch_id"),
        F.lit(None).cast("string").alias("supersedes_batch_id"),
        F.struct(F.lit("export").alias("name")).alias("producer"),
    ]
    hashed = F.when(kind == 13, F.sha2(F.lit("other").cast("binary"), 256)).otherwise(right).alias("content_hash")
    whole = F.to_json(F.struct(*fields, hashed, typed.alias("tables")), options)
    without = F.to_json(F.struct(*fields, typed.alias("tables")), options)
    text = F.when(kind == 3, "not json").when(kind == 5, without).otherwise(whole)
    return b.select(
        folder_name(seq).alias("folder"), F.concat(folder_name(seq), F.lit("/_manifest.json")).alias("path"),
        text.alias("content"), F.col("day").cast("timestamp").alias("landed_at"))


#: The same manifests, judged: what the oracle expects without parsing any JSON.
EXPECTED = """
    SELECT seq, day, n,
           CASE WHEN seq % 20 = 3 THEN 'not a JSON object'
                WHEN seq % 20 = 5 THEN 'missing fields'
                WHEN seq = 0 THEN 'snapshot tables'
                WHEN seq % 20 = 7 THEN 'folder'
                WHEN seq % 20 = 9 THEN 'loads: file_path'
                WHEN seq % 20 = 11 THEN 'loads: change_operations'
                WHEN seq % 20 = 13 THEN 'content_hash'
                WHEN seq % 20 = 15 THEN 'change tables' END AS problems
    FROM (SELECT date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS seq,
                 CAST(o_orderdate AS DATE) AS day, count(*) AS n
          FROM orders GROUP BY ALL)"""


# --- the batch registry ----------------------------------------------------------

def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log rows of landed batches: one per order, with reused ids and repeated folders.

    batch_seq is the order number; the earliest two thirds are settled history and the rest
    is open, so that the frontier lies inside the table.
    """
    return spark.sql(REGISTRY, orders=given(spark, sf_dir, "orders"))


def batch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BATCH_EVENTS, orders=given(spark, sf_dir, "orders"))


# One text for both engines. Folder k*40+7 repeats the id and content of k*40+6, k*40+9 the id of
# k*40+8 with other content; k*40+11 is registered twice; k*40+13 is invalid and replaced by k*40+14.
REGISTRY = """
    SELECT batch_seq, batch_id, batch_mode, business_date, supersedes_batch_id, content_hash, is_valid, problems,
           discovered_at
    FROM (SELECT CAST(o_orderkey AS INT) AS batch_seq,
                 'b-' || CAST(CASE WHEN o_orderkey % 40 IN (7, 9) THEN o_orderkey - 1 ELSE o_orderkey END AS STRING)
                     AS batch_id,
                 CASE WHEN o_orderkey = 0 THEN 'INITIAL_SNAPSHOT' ELSE 'CHANGE_BATCH' END AS batch_mode,
                 CAST(o_orderdate AS DATE) AS business_date,
                 CASE WHEN o_orderkey % 40 = 14 THEN 'b-' || CAST(o_orderkey - 1 AS STRING) END
                     AS supersedes_batch_id,
                 CASE WHEN o_orderkey % 40 = 17 THEN NULL
                      ELSE 'h-' || CAST(CASE WHEN o_orderkey % 40 = 7 THEN o_orderkey - 1 ELSE o_orderkey END
                                        AS STRING) END AS content_hash,
                 o_orderkey % 40 <> 13 AS is_valid,
                 CASE WHEN o_orderkey % 40 = 13 THEN 'row_count' END AS problems,
                 CAST(o_orderdate AS TIMESTAMP) AS discovered_at
          FROM {orders}
          UNION ALL
          SELECT CAST(o_orderkey AS INT), 'b-' || CAST(o_orderkey AS STRING), 'CHANGE_BATCH',
                 CAST(o_orderdate AS DATE), NULL, 'h2-' || CAST(o_orderkey AS STRING), TRUE, NULL,
                 CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' DAY
          FROM {orders} WHERE o_orderkey % 40 = 11) AS r"""
# Settled batches: claimed, applied, completed. Conflicts are waived, some batches failed, some skip a state.
BATCH_EVENTS = """
    SELECT o.batch_seq, e.event_type, o.seen_at + INTERVAL '2' DAY * e.step AS event_at,
           CASE WHEN e.event_type = 'waived' THEN NULL
                ELSE 'run-' || CAST(o.batch_seq + CASE WHEN o.kind = 21 AND e.step > 2 THEN 1 ELSE 0 END AS STRING)
                END AS run_id,
           CASE WHEN e.event_type = 'waived' THEN 'operator' END AS actor,
           CASE WHEN e.event_type = 'waived' THEN 'checked'
                WHEN e.event_type = 'failed' AND o.batch_seq % 80 = 23 THEN 'timeout' END AS message,
           CASE WHEN e.event_type = 'waived' AND o.batch_seq % 80 = 11 THEN 'no effect' END AS integrity_note
    FROM (SELECT CAST(o_orderkey AS INT) AS batch_seq, CAST(o_orderdate AS TIMESTAMP) AS seen_at, o_orderkey % 40 AS kind,
                 CASE WHEN o_orderkey % 40 IN (9, 11) THEN 'waive' WHEN o_orderkey % 40 = 23 THEN 'fail'
                      WHEN o_orderkey % 40 = 25 THEN 'skip' WHEN o_orderkey % 40 IN (7, 13) THEN 'none'
                      ELSE 'done' END AS story
          FROM {orders}
          WHERE o_orderkey < (SELECT max(o_orderkey) FROM {orders}) * 2 / 3) AS o
    JOIN (SELECT 'done' AS story, 'claimed' AS event_type, 1 AS step
          UNION ALL SELECT 'done', 'silver_applied', 2 UNION ALL SELECT 'done', 'completed', 3
          UNION ALL SELECT 'fail', 'claimed', 1 UNION ALL SELECT 'fail', 'failed', 2
          UNION ALL SELECT 'skip', 'claimed', 1 UNION ALL SELECT 'skip', 'completed', 3
          UNION ALL SELECT 'waive', 'waived', 1) AS e ON e.story = o.story"""


# --- the run log --------------------------------------------------------------------

def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RUN_LOG, events=given(spark, sf_dir, "events"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LEDGER, events=given(spark, sf_dir, "events"))


def worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(WORKLIST, events=given(spark, sf_dir, "events"))


# Every event is one detection: its user and day make the run, its type the step. Even ones succeed a
# minute later, some succeed before their detection, every fiftieth reads everything.
_RUN = "'r-' || CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING)"
LEDGER = f"""
    SELECT {_RUN} AS run_id, event_type AS step_name,
           CASE WHEN event_id % 3 = 0 THEN 'silver_loads' ELSE 'silver_trips' END AS source_table,
           event_id - 10 AS version_from, CASE WHEN event_id % 11 = 0 THEN event_id + 5000 ELSE event_id END
               AS version_to,
           event_id % 50 = 0 AS is_full_scan, CAST(ts AS TIMESTAMP) AS detected_at
    FROM {{events}}"""
RUN_LOG = f"""
    SELECT {_RUN} AS run_id, event_type AS step_name,
           CASE WHEN event_id % 2 = 0 THEN 'succeeded' WHEN event_id % 5 = 0 THEN 'failed' ELSE 'started' END
               AS event_type,
           CASE WHEN event_id % 7 = 0 THEN CAST(ts AS TIMESTAMP) - INTERVAL '1' MINUTE
                ELSE CAST(ts AS TIMESTAMP) + INTERVAL '1' MINUTE END AS event_at
    FROM {{events}}"""
WORKLIST = f"""
    SELECT {_RUN} AS run_id, event_type AS step_name, event_id AS key, CAST(ts AS TIMESTAMP) AS detected_at
    FROM {{events}}"""


# --- history and change events ------------------------------------------------------

def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day is a complete load: the last event type of every user seen that day."""
    day = F.col("ts").cast("date")
    return (
        given(spark, sf_dir, "events").groupBy("user_id", day.alias("day"))
        .agg(F.max_by("event_type", "ts").alias("event_type"))
        .select("user_id", "event_type", F.col("day").cast("string").alias("_ingest_date"),
                F.col("day").cast("timestamp").alias("_ingested_at"), F.lit("events").alias("_source_system"),
                F.when(F.dayofmonth("day") % 7 == 0, "incremental").otherwise("full").alias("_load_mode")))


HISTORY = """
    SELECT user_id, arg_max(event_type, ts) AS event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS seen_at,
           CASE WHEN day(CAST(ts AS DATE)) % 7 = 0 THEN 'incremental' ELSE 'full' END AS mode
    FROM events GROUP BY user_id, CAST(ts AS DATE)"""


def customer_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The customers, and one deterministic edit of them: changed, removed, added."""
    before = source(spark, sf_dir, "customers")
    cid = F.col("customer_id")
    edited = before.where(cid % 23 != 0).withColumn(
        "account_status", F.when(cid % 17 == 0, "Changed").otherwise(F.col("account_status")))
    added = before.where(cid % 19 == 0).withColumn("customer_id", cid + 1_000_000)
    return before, edited.unionByName(added)


CUSTOMERS_AFTER = """
    SELECT * REPLACE (CASE WHEN customer_id % 17 = 0 THEN 'Changed' ELSE account_status END AS account_status)
    FROM raw_customers WHERE customer_id % 23 <> 0
    UNION ALL
    SELECT * REPLACE (customer_id + 1000000 AS customer_id) FROM raw_customers WHERE customer_id % 19 = 0"""


def user_change_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(snapshot, events): users numbered up to the most frequent half known and live, and all
    events as change events in id order; signup inserts, error deletes, the rest update."""
    events = given(spark, sf_dir, "events")
    snapshot = events.groupBy("user_id").agg(F.min("value").alias("value")).select(
        "user_id", F.lit("snapshot").alias("event_type"), F.col("value").cast("decimal(14,2)").alias("value"),
        (F.col("user_id") % 4 == 0).alias("_is_deleted_in_source"),
        F.lit("2023-12-31").cast("timestamp").alias("_source_changed_at"))
    changes = events.select(
        "user_id", "event_type", F.col("value").cast("decimal(14,2)").alias("value"),
        F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE")
        .otherwise("UPDATE").alias("_operation"),
        F.col("event_id").cast("string").alias("_event_id"), (F.col("event_id") + 1).alias("_source_sequence"),
        F.col("ts").cast("timestamp").alias("_source_changed_at"), F.lit("batch-1").alias("_batch_id"))
    return snapshot, changes


# --- one change later -----------------------------------------------------------------

def edited(spark: SparkSession, sf_dir: str, table: str) -> tuple[DataFrame, DataFrame]:
    """(before, after) of whole rows: moved, re-routed, corrected and removed ones."""
    values, kept = EDITS[table]
    before = source(spark, sf_dir, table)
    return before, before.where(kept).withColumns({c: F.expr(v).cast(before.schema[c].dataType) for c, v in values.items()})


# Table -> new values of columns, and which rows stay, in a text both engines read. Any column may change.
EDITS = {
    "loads": ({"route_id": "CASE WHEN load_id % 89 = 0 THEN 101 ELSE route_id END",
               "pieces": "CASE WHEN load_id % 97 = 5 THEN pieces + 1 ELSE pieces END"}, "load_id % 127 <> 0"),
    "trips": ({"load_id": "CASE WHEN driver_id % 17 = 3 AND load_id % 5 = 0 THEN load_id + 1 ELSE load_id END",
               "trip_status": "CASE WHEN load_id % 103 = 7 THEN NULL ELSE trip_status END"}, "TRUE"),
    "delivery_events": ({"load_id": "CASE WHEN load_id % 71 = 0 AND event_type = 'Pickup' THEN load_id + 2 ELSE load_id END",
                         "detention_minutes": "CASE WHEN load_id % 107 = 2 THEN detention_minutes + 1 ELSE detention_minutes END"},
                        "load_id IS NULL OR load_id % 301 <> 5"),
    "fuel_purchases": ({"gallons": "CASE WHEN gallons = 13 THEN gallons + 1 ELSE gallons END",
                        "location_city": "CASE WHEN truck_id % 109 = 4 THEN 'Elsewhere' ELSE location_city END"}, "TRUE"),
    "maintenance_records": ({"labor_hours": "CASE WHEN maintenance_id % 61 = 0 THEN labor_hours + 1 ELSE labor_hours END",
                             "service_description": "CASE WHEN maintenance_id % 113 = 1 THEN 'Corrected' ELSE service_description END"},
                            "maintenance_id % 83 <> 0"),
    "safety_incidents": ({"vehicle_damage_cost": "CASE WHEN incident_id % 59 = 0 THEN vehicle_damage_cost + 1 ELSE vehicle_damage_cost END",
                          "injury_flag": "CASE WHEN incident_id % 127 = 3 THEN NOT injury_flag ELSE injury_flag END"}, "incident_id % 79 <> 0"),
}
