"""Change-data and state operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import detect as X
from tidemark.operators import hashes as H
from tidemark.operators import history as I
from tidemark.operators import merge as G
from tidemark.operators.control import cdf_checkpoint
from tidemark.operators.detect import LINKS
from tidemark.operators.facts import FACTS, fact_trip
from tidemark.plans import landing
from tidemark.plans.oracle import define
from tidemark.plans.oracle_star import dk
from tidemark.plans.catalog.scalars import row_text_sql
from tidemark.plans.registry import query
from tidemark.plans.star import star
from tidemark.plans.trucking import columns, source
from tidemark.session import scratch_path
from tidemark.sources.buckets import BucketLog, Merge


STATE_OUT = "user_id bigint, event_type string, seen_on date, changed_at ts, deleted flag"


def _state(df):
    return df.select("user_id", "event_type", F.col("_ingested_at").cast("date").alias("seen_on"),
                     F.col("_source_changed_at").alias("changed_at"), F.col("_is_deleted_in_source").alias("deleted"))


@query("current_state", STATE_OUT, "SELECT *, CAST(seen_at AS DATE) AS seen_on FROM user_state")
def current_state(spark, sf):
    """One row per user: latest version, start of its unbroken run, or when it went away."""
    return _state(I.current_state(landing.user_history(spark, sf), "user_id"))


@query("latest_live_snapshot", "user_id bigint, event_type string, seen_on date", """
    SELECT user_id, arg_max(event_type, seen_at) AS event_type, CAST(max(seen_at) AS DATE) AS seen_on
    FROM user_days GROUP BY user_id HAVING max(seen_at) >= (SELECT max(seen_at) FROM user_days WHERE mode = 'full')""")
def latest_live_snapshot(spark, sf):
    return I.latest_live_snapshot(landing.user_history(spark, sf), "user_id").withColumn(
        "seen_on", F.col("_ingested_at").cast("date"))


@query("incremental_revive", "user_id bigint, event_type string, seen_on date, changed_at ts", """
    WITH gone AS (SELECT user_id, changed_at AS deleted_at FROM early_state WHERE deleted),
    back AS (SELECT h.user_id, min(h.seen_at) AS back_at FROM late_days AS h JOIN gone USING (user_id)
             WHERE h.seen_at > gone.deleted_at GROUP BY h.user_id)
    SELECT s.user_id, s.event_type, CAST(s.seen_at AS DATE) AS seen_on,
           CASE WHEN back_at > s.changed_at THEN back_at ELSE s.changed_at END AS changed_at
    FROM late_state AS s LEFT JOIN gone USING (user_id) LEFT JOIN back USING (user_id)
    WHERE gone.user_id IS NULL OR back.user_id IS NOT NULL""")
def incremental_revive(spark, sf):
    """Recent loads only, against a stored state in which some users are deleted."""
    history = landing.user_history(spark, sf)
    at = F.col("_ingested_at")
    stored = I.current_state(history.where(at <= F.lit("2024-01-20").cast("timestamp")), "user_id")
    recent = history.where(at >= F.lit("2024-01-15").cast("timestamp"))
    return _state(I.incremental_state(recent, stored, "user_id").withColumn(
        "_is_deleted_in_source", F.lit(False)))


OLD, NOW = "2024-01-01", "2024-02-01"
#: Of a bucket, so that the larger of the given tables have several.
BUCKET_BYTES = 4 << 20


def bucketed(spark, name, df, key):
    """A new table of buckets, at version 1."""
    log = BucketLog(spark, scratch_path(spark, name), BUCKET_BYTES)
    log.create("run-1", {name: (df, [key])})
    return log


def _silver_target(spark, sf):
    before, after = landing.customer_versions(spark, sf)
    old = F.lit(OLD).cast("timestamp")
    target = before.withColumns({"_silver_run_id": F.lit("run-1"), "_source_changed_at": old,
                                 "_silver_created_at": old, "_silver_updated_at": old})
    fresh = after.withColumns({"_silver_run_id": F.lit("run-2"), "_source_changed_at": F.lit(NOW).cast("timestamp")})
    return target, fresh


@query("merge_upsert", "customer_id bigint, account_status string, _silver_run_id string, _silver_created_at ts, "
                       "_silver_updated_at ts, _action string", f"""
    SELECT coalesce(t.customer_id, s.customer_id) AS customer_id,
           CASE WHEN act = 'keep' THEN t.account_status ELSE s.account_status END AS account_status,
           CASE WHEN act = 'keep' THEN 'run-1' ELSE 'run-2' END AS _silver_run_id,
           CASE WHEN act = 'insert' THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{OLD}' END AS _silver_created_at,
           CASE WHEN act = 'keep' THEN TIMESTAMP '{OLD}' ELSE TIMESTAMP '{NOW}' END AS _silver_updated_at, act AS _action
    FROM (SELECT t, s, CASE WHEN t.customer_id IS NULL THEN 'insert' WHEN s.customer_id IS NULL THEN 'keep'
                            WHEN t IS DISTINCT FROM s THEN 'update' ELSE 'keep' END AS act
          FROM raw_customers AS t FULL JOIN customers_after AS s ON s.customer_id = t.customer_id)""")
def merge_upsert(spark, sf):
    """Rows that differ are updated, new ones inserted, equal ones left alone, none removed."""
    target, fresh = _silver_target(spark, sf)
    now = F.lit(NOW).cast("timestamp")
    log = bucketed(spark, "customers", target, "customer_id")
    log.merge("run-2", {"customers": Merge(fresh.select("customer_id"), lambda rows: G.merge_upsert(rows, fresh, "customer_id", now=now))})
    action = (F.when(F.col("_silver_created_at") == now, "insert").when(F.col("_silver_updated_at") == now, "update")
              .otherwise("keep"))
    return log.read("customers").withColumn("_action", action)


FEED_OUT = "customer_id bigint, account_status string, _change_type string"


@query("change_feed", FEED_OUT, """
    SELECT t.customer_id, t.account_status, 'delete' AS _change_type FROM raw_customers AS t
    WHERE NOT EXISTS (SELECT 1 FROM customers_after AS s WHERE s.customer_id = t.customer_id)
    UNION ALL SELECT s.customer_id, s.account_status, 'insert' FROM customers_after AS s
    WHERE NOT EXISTS (SELECT 1 FROM raw_customers AS t WHERE s.customer_id = t.customer_id)
    UNION ALL SELECT t.customer_id, t.account_status, 'update_preimage' FROM raw_customers AS t
    JOIN customers_after AS s ON s.customer_id = t.customer_id WHERE s.account_status <> t.account_status
    UNION ALL SELECT s.customer_id, s.account_status, 'update_postimage' FROM raw_customers AS t
    JOIN customers_after AS s ON s.customer_id = t.customer_id WHERE s.account_status <> t.account_status""")
def change_feed(spark, sf):
    """The images that the publish of the later version left, read by version."""
    before, after = landing.customer_versions(spark, sf)
    log = bucketed(spark, "customers", before, "customer_id")
    keys = before.select("customer_id").unionByName(after.select("customer_id"))
    log.merge("run-2", {"customers": Merge(keys, lambda rows: after)})
    return log.changes("customers", 1)


@query("change_window", "step_name string, source_table string, version_from bigint, version_to bigint, "
                        "is_full_scan flag, reason string, is_empty flag", """
    WITH cp AS (SELECT step_name, source_table, version_to AS last_version FROM (
            SELECT *, row_number() OVER (PARTITION BY step_name, source_table ORDER BY detected_at DESC, version_to DESC) AS rn
            FROM ledger AS b WHERE b.step_name <> 'error' AND EXISTS (SELECT 1 FROM run_log AS r
                WHERE r.run_id = b.run_id AND r.step_name = b.step_name AND r.event_type = 'succeeded'
                  AND r.event_at >= b.detected_at)) WHERE rn = 1),
    cur AS (SELECT source_table, max(version_from) AS version, max(version_from) - 20 AS oldest_version
            FROM ledger GROUP BY 1),
    w AS (SELECT DISTINCT step_name, source_table FROM ledger)
    SELECT step_name, source_table, last_version AS version_from, version AS version_to, reason IS NOT NULL AS is_full_scan,
           reason, reason IS NULL AND last_version = version AS is_empty
    FROM (SELECT w.*, cp.last_version, cur.version,
                 CASE WHEN cp.last_version IS NULL THEN 'no checkpoint' WHEN cp.last_version > cur.version
                      THEN 'table version reset' WHEN cp.last_version < cur.version
                      AND cp.last_version + 1 < cur.oldest_version THEN 'window no longer readable' END AS reason
          FROM w LEFT JOIN cp USING (step_name, source_table) LEFT JOIN cur USING (source_table))""")
def change_window(spark, sf):
    """A version window per step and table, or a full scan with its reason."""
    ledger = landing.ledger(spark, sf)
    checkpoints = cdf_checkpoint(ledger.where("step_name <> 'error'"), landing.run_log(spark, sf))
    current = ledger.groupBy("source_table").agg(F.max("version_from").alias("version"),
                                                 (F.max("version_from") - 20).alias("oldest_version"))
    return X.change_windows(ledger.select("step_name", "source_table").distinct(), checkpoints, current)


# --- affected keys -------------------------------------------------------------------

def _changes(spark, sf, fact):
    out = {}
    for t in X.READS[fact]:
        before, after = landing.edited(spark, sf, t)
        out[t] = G.change_feed(before, after, [before.columns[0]], X.CARRIES.get(fact, {}).get(t, ()))
    return out


_AFFECTED_SQL = {
    "trip": "SELECT DISTINCT CAST(k AS VARCHAR) AS affected_key FROM (SELECT trip_id AS k FROM trips_changes "
            "UNION ALL SELECT trip_id FROM raw_trips WHERE load_id IN (SELECT load_id FROM loads_changes))",
    "delivery_event": "SELECT DISTINCT CAST(k AS VARCHAR) AS affected_key FROM (SELECT event_id AS k FROM "
                      "delivery_events_changes UNION ALL SELECT event_id FROM raw_delivery_events "
                      "WHERE load_id IN (SELECT load_id FROM loads_changes))",
    "fuel_purchase": "SELECT DISTINCT CAST(k AS VARCHAR) AS affected_key FROM (SELECT fuel_purchase_id AS k FROM "
                     "fuel_purchases_changes UNION ALL SELECT fuel_purchase_id FROM raw_fuel_purchases "
                     "WHERE trip_id IN (SELECT trip_id FROM trips_changes UNION ALL SELECT trip_id FROM raw_trips "
                     "WHERE load_id IN (SELECT load_id FROM loads_changes)))",
    "maintenance": "SELECT DISTINCT CAST(maintenance_id AS VARCHAR) AS affected_key FROM maintenance_records_changes",
    "safety_incident": "SELECT DISTINCT CAST(incident_id AS VARCHAR) AS affected_key FROM safety_incidents_changes",
    "load_lifecycle": "SELECT DISTINCT CAST(k AS VARCHAR) AS affected_key FROM (SELECT load_id AS k FROM loads_changes "
                      "UNION ALL SELECT load_id FROM trips_changes UNION ALL SELECT load_id FROM "
                      "delivery_events_changes) WHERE k IS NOT NULL",
}
for _fact, _sql in _AFFECTED_SQL.items():
    @query(f"affected_keys_{_fact}", "affected_key string", _sql)
    def affected(spark, sf, fact=_fact):
        """Keys to rebuild after the edit: changed rows, children of changed parents, pre-images."""
        silver = {t: source(spark, sf, t) for t in ("trips", "delivery_events", "fuel_purchases")}
        keys = X.AFFECTED[fact](_changes(spark, sf, fact), silver)
        return keys.toDF("affected_key")


@query("full_reconcile_keys", "trip_id string", """
    SELECT trip_id FROM raw_trips UNION SELECT trip_id || '-gone' FROM fact_trip WHERE driver_key = 0""")
def full_reconcile_keys(spark, sf):
    """Every key of either side; some gold keys are no longer in silver."""
    fact = star(spark, sf).fact("trip")
    lost = fact.where("driver_key = 0").select(F.concat("trip_id", F.lit("-gone")).alias("trip_id"))
    return X.full_reconcile_keys(source(spark, sf, "trips"), fact.select("trip_id").unionByName(lost), "trip_id")


# --- publishing ---------------------------------------------------------------------

def _publish_case(spark, sf):
    """A target without the youngest trips, a stage of changed and new ones, and their worklist."""
    fact = star(spark, sf).fact("trip")
    target = fact.where("route_key % 10 <> 4")
    staged = fact.where("route_key % 10 IN (3, 4)").withColumn(
        "is_deleted_in_source", F.col("is_deleted_in_source") | (F.col("driver_key") % 5 == 0))
    return target, staged, fact.where("route_key % 10 IN (3, 4, 5)").select("trip_id")


define("pub_target", "SELECT * FROM fact_trip WHERE route_key % 10 <> 4")
define("pub_stage", """
    SELECT * REPLACE (is_deleted_in_source OR driver_key % 5 = 0 AS is_deleted_in_source)
    FROM fact_trip WHERE route_key % 10 IN (3, 4)""")
define("pub_list", "SELECT trip_id FROM fact_trip WHERE route_key % 10 IN (3, 4, 5)")


@query("publish_by_key", "trip_id string, route_key bigint, is_deleted_in_source flag", """
    SELECT trip_id, route_key, is_deleted_in_source OR trip_id IN (SELECT trip_id FROM pub_list) AS is_deleted_in_source
    FROM pub_target WHERE trip_id NOT IN (SELECT trip_id FROM pub_stage)
    UNION ALL SELECT trip_id, route_key, is_deleted_in_source FROM pub_stage""")
def publish_by_key(spark, sf):
    """Only the buckets of staged and listed trips are read and written."""
    target, staged, listed = _publish_case(spark, sf)
    log = bucketed(spark, "fact_trip", target, "trip_id")
    keys = staged.select("trip_id").unionByName(listed)
    log.merge("run-2", {"fact_trip": Merge(keys, lambda rows: G.publish_by_key(rows, staged, listed, "trip_id"))})
    return log.read("fact_trip")


COUNTS_SQL = """
    SELECT (SELECT count(*) FROM pub_target WHERE NOT is_deleted_in_source) AS active_before,
           (SELECT count(*) FROM pub_stage WHERE trip_id NOT IN (SELECT trip_id FROM pub_target)) AS inserted,
           (SELECT count(*) FROM pub_stage WHERE trip_id IN (SELECT trip_id FROM pub_target)) AS updated,
           (SELECT count(*) FROM pub_target AS t JOIN pub_stage AS s USING (trip_id)
            WHERE NOT t.is_deleted_in_source AND s.is_deleted_in_source)
           + (SELECT count(*) FROM pub_target WHERE NOT is_deleted_in_source
              AND trip_id IN (SELECT trip_id FROM pub_list)
              AND trip_id NOT IN (SELECT trip_id FROM pub_stage)) AS deleted,
           (SELECT count(*) FROM pub_stage WHERE -1 IN (dispatch_date_key, driver_key, truck_key, trailer_key,
                                                        route_key)) AS unknown"""


@query("publish_counts", "active_before bigint, inserted bigint, updated bigint, deleted bigint, unknown bigint",
       COUNTS_SQL)
def publish_counts(spark, sf):
    return G.publish_counts(*_publish_case(spark, sf), "trip_id", FACTS["trip"][2])


@query("mass_delete_guard", "what string, active_before bigint, deleted bigint, blocked flag", f"""
    WITH c AS ({COUNTS_SQL})
    SELECT 'fact' AS what, active_before, deleted, deleted > 0 AND deleted * 10 > active_before AS blocked FROM c
    UNION ALL SELECT 'allowed', active_before, deleted, FALSE FROM c
    UNION ALL SELECT 'empty fact', 0, deleted, FALSE FROM c
    UNION ALL SELECT 'empty dimension', 0, deleted, deleted > 0 FROM c""")
def mass_delete_guard(spark, sf):
    """More than a tenth deleted blocks, unless allowed; an empty fact never does, a dimension does."""
    counts = G.publish_counts(*_publish_case(spark, sf), "trip_id", FACTS["trip"][2]).select("active_before", "deleted")
    empty = counts.withColumn("active_before", F.lit(0).cast("bigint"))

    def row(what, df, **how):
        return G.mass_delete_verdict(df, **how).select(F.lit(what).alias("what"), "*")

    return (row("fact", counts).unionByName(row("allowed", counts, allow=True))
            .unionByName(row("empty fact", empty)).unionByName(row("empty dimension", empty, need_active=False)))


# --- healing -------------------------------------------------------------------------

@query("heal_unknown", "trip_id string", """
    SELECT trip_id FROM fact_trip WHERE NOT is_deleted_in_source
      AND -1 IN (dispatch_date_key, driver_key, truck_key, trailer_key, route_key)""")
def heal_unknown(spark, sf):
    return X.heal_unknown(star(spark, sf).fact("trip"), "trip_id", FACTS["trip"][2])


define("fact_trip_first", f"""
    SELECT t.trip_id, {dk('t.dispatch_date')} AS day, CASE WHEN t.driver_id IS NULL THEN 0
           ELSE coalesce(d.driver_key, -1) END AS driver_key
    FROM raw_trips AS t LEFT JOIN dim_driver_first AS d ON d.driver_id = t.driver_id AND d.driver_key > 0
        AND {dk('t.dispatch_date')} >= d.valid_from_date_key AND {dk('t.dispatch_date')} < d.valid_to_date_key""")


@query("heal_wrong_version", "trip_id string", """
    SELECT f.trip_id FROM fact_trip_first AS f JOIN dim_driver AS d ON d.driver_key = f.driver_key
    JOIN dim_driver AS c ON c.driver_id = d.driver_id AND f.day >= c.valid_from_date_key AND f.day < c.valid_to_date_key
    WHERE f.driver_key > 0 AND c.driver_key <> f.driver_key""")
def heal_wrong_version(spark, sf):
    """Facts loaded before the second driver load point at versions that have since ended."""
    s = star(spark, sf)
    dims = {**s.dims(["date", "truck", "trailer", "route", "driver_first"]), }
    dims["driver"] = dims.pop("driver_first")
    fact = fact_trip(None, {"trips": s.current("trips"), "loads": s.current("loads")}, dims)
    return X.heal_wrong_version(fact, s.dim("driver"), "trip_id", LINKS["trip"][0])


@query("heal_orphans", "trip_id string", """
    SELECT trip_id FROM fact_trip
    WHERE driver_key NOT IN (SELECT driver_key FROM dim_driver WHERE driver_key % 10 <> 3)
       OR truck_key NOT IN (SELECT truck_key FROM dim_truck WHERE truck_key % 13 <> 5)
       OR trailer_key NOT IN (SELECT trailer_key FROM dim_trailer) OR route_key NOT IN (SELECT route_key FROM dim_route)""")
def heal_orphans(spark, sf):
    """Dimensions rebuilt without some rows leave facts pointing nowhere."""
    s = star(spark, sf)
    dims = s.dims(["driver", "truck", "trailer", "route"])
    dims["driver"] = dims["driver"].where("driver_key % 10 <> 3")
    dims["truck"] = dims["truck"].where("truck_key % 13 <> 5")
    return X.heal_orphans(s.fact("trip"), dims, "trip_id", LINKS["trip"])


# --- row hashes -----------------------------------------------------------------------

_PLAIN = columns("customers")
_HASH = f"sha256({row_text_sql(_PLAIN)})"


@query("row_hash", "business_key string, row_hash string",
       f"SELECT CAST(customer_id AS VARCHAR) AS business_key, {_HASH} AS row_hash FROM raw_customers")
def row_hash(spark, sf):
    return H.row_hashes(source(spark, sf, "customers").select(*_PLAIN), "customer_id")


@query("compare_hashes", "equal bigint, changed bigint, only_left bigint, only_right bigint, repeated_keys bigint", """
    SELECT count(*) FILTER (b.customer_id IS NOT NULL AND a.customer_id IS NOT NULL AND a.account_status = b.account_status)
               AS equal,
           count(*) FILTER (a.account_status <> b.account_status) AS changed,
           count(*) FILTER (a.customer_id IS NULL) AS only_left, count(*) FILTER (b.customer_id IS NULL) AS only_right,
           0 AS repeated_keys
    FROM raw_customers AS b FULL JOIN customers_after AS a ON a.customer_id = b.customer_id""")
def compare_hashes(spark, sf):
    before, after = landing.customer_versions(spark, sf)
    return H.compare_hashes(H.row_hashes(before, "customer_id"), H.row_hashes(after, "customer_id"))


@query("snapshot_plan", "table_name string, decision string, equal bigint, changed bigint", """
    SELECT 'customers' AS table_name, 'reject' AS decision, count(*) FILTER (a.account_status = b.account_status) AS equal,
           count(*) FILTER (a.account_status <> b.account_status) AS changed
    FROM raw_customers AS b JOIN customers_after AS a USING (customer_id)
    UNION ALL SELECT 'loads', 'unchanged', count(*), 0 FROM raw_loads
    UNION ALL SELECT 'trailers', 'load', 0, 0""")
def snapshot_plan(spark, sf):
    """Equal tables are unchanged, an empty target loads, any difference rejects."""
    before, after = landing.customer_versions(spark, sf)
    loads = H.row_hashes(source(spark, sf, "loads"), "load_id")
    trailers = H.row_hashes(source(spark, sf, "trailers"), "trailer_id")
    plans = (H.snapshot_decision(H.row_hashes(after, "customer_id"), H.row_hashes(before, "customer_id"), "customers")
             .unionByName(H.snapshot_decision(loads, loads, "loads"))
             .unionByName(H.snapshot_decision(trailers, trailers.where("false"), "trailers")))
    return plans.withColumnRenamed("table", "table_name")


@query("hash_baseline_capture", "label string, table_name string, business_key string, row_hash string", f"""
    SELECT 'before' AS label, 'customers' AS table_name, CAST(customer_id AS VARCHAR) AS business_key,
           {_HASH} AS row_hash FROM raw_customers""")
def hash_baseline_capture(spark, sf):
    frame = source(spark, sf, "customers").select(*_PLAIN)
    return H.capture_baseline({"customers": (frame, "customer_id")}, "before").withColumnRenamed("table", "table_name")


@query("hash_baseline_compare", "table_name string, equal bigint, changed bigint, only_left bigint, only_right bigint, "
                                "repeated_keys bigint", """
    SELECT 'customers' AS table_name, count(*) FILTER (a.account_status = b.account_status) AS equal,
           count(*) FILTER (a.account_status <> b.account_status) AS changed,
           count(*) FILTER (a.customer_id IS NULL) AS only_left, count(*) FILTER (b.customer_id IS NULL) AS only_right,
           0 AS repeated_keys
    FROM raw_customers AS b FULL JOIN customers_after AS a ON a.customer_id = b.customer_id
    UNION ALL SELECT 'loads', count(*), 0, 0, 0, 0 FROM raw_loads""")
def hash_baseline_compare(spark, sf):
    """A labelled baseline of two tables against their later state."""
    before, after = landing.customer_versions(spark, sf)
    loads = source(spark, sf, "loads")
    baseline = H.capture_baseline({"customers": (before, "customer_id"), "loads": (loads, "load_id")}, "before")
    now = H.capture_baseline({"customers": (after, "customer_id"), "loads": (loads, "load_id")}, "now")
    return H.compare_baseline(baseline, now).withColumnRenamed("table", "table_name")


# --- change batches ----------------------------------------------------------------------

@query("apply_change_batch", "user_id bigint, event_type string, value double, deleted flag, changed_at ts, seq bigint", """
    WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn
                                 FROM user_changes) WHERE rn = 1)
    SELECT coalesce(s.user_id, l.user_id) AS user_id, coalesce(l.event_type, s.event_type) AS event_type,
           coalesce(l.value, s.value) AS value, coalesce(l.operation = 'DELETE', s.deleted) AS deleted,
           coalesce(l.ts, s.changed_at) AS changed_at, coalesce(l.seq, 0) AS seq
    FROM user_snapshot AS s FULL JOIN last AS l ON l.user_id = s.user_id""")
def apply_change_batch(spark, sf):
    """The last event of a user decides; a delete keeps the image, a later event revives."""
    snapshot, events = landing.user_change_events(spark, sf)
    log = bucketed(spark, "users", I.sequenced(snapshot), "user_id")
    log.merge("batch-1", {"users": Merge(events, lambda rows: I.apply_change_batch(rows, events, "user_id"))})
    return log.read("users").select(
        "user_id", "event_type", "value", F.col("_is_deleted_in_source").alias("deleted"),
        F.col("_source_changed_at").alias("changed_at"), F.col("_source_sequence").alias("seq"))


@query("validate_change_batch", "rule string, business_key string, sequence bigint", """
    WITH o AS (SELECT c.*, lag(operation) OVER (PARTITION BY c.user_id ORDER BY seq) AS op_before, NOT s.deleted AS live0
               FROM user_changes AS c LEFT JOIN user_snapshot AS s ON s.user_id = c.user_id),
    l AS (SELECT *, CASE WHEN op_before IS NOT NULL THEN op_before <> 'DELETE' ELSE coalesce(live0, FALSE) END AS live FROM o)
    SELECT 'needs_live_key' AS rule, CAST(user_id AS VARCHAR) AS business_key, seq AS sequence FROM l
    WHERE operation IN ('UPDATE', 'DELETE') AND NOT live
    UNION ALL SELECT 'needs_absent_key', CAST(user_id AS VARCHAR), seq FROM l WHERE operation = 'INSERT' AND live
    UNION ALL SELECT 'after_business_day', CAST(user_id AS VARCHAR), seq FROM l
    WHERE CAST(ts AS DATE) > DATE '2024-01-28'
    UNION ALL SELECT 'sequence_not_contiguous', NULL, max(seq) FROM l
    HAVING min(seq) <> 1 OR max(seq) <> count(*) OR count(DISTINCT seq) <> count(*)""")
def validate_change_batch(spark, sf):
    snapshot, events = landing.user_change_events(spark, sf)
    return I.validate_change_batch(snapshot, events, "user_id", F.lit("2024-01-28").cast("date"))


@query("touch_delete_restore", "step string, _is_deleted_in_source flag, _silver_run_id string, rows bigint", """
    WITH k AS (SELECT customer_id, customer_id % 10 IN (1, 2) AS hit, _is_deleted_in_source AS d FROM raw_customers)
    SELECT 'touched' AS step, d AS _is_deleted_in_source, CASE WHEN hit THEN 'touch' ELSE 'run-1' END AS _silver_run_id,
           count(*) AS rows FROM k GROUP BY ALL
    UNION ALL SELECT 'deleted', d OR hit, 'run-1', count(*) FROM k GROUP BY ALL
    UNION ALL SELECT 'restored', d, 'run-1', count(*) FROM k GROUP BY ALL""")
def touch_delete_restore(spark, sf):
    """Controlled changes: rewrite unchanged, flag deleted, restore from the earlier version."""
    table, _ = _silver_target(spark, sf)
    keys, key = table.where("customer_id % 10 IN (1, 2)").select("customer_id"), "customer_id"
    touched, deleted = (bucketed(spark, "customers", table, key) for _ in range(2))
    touched.merge("touch", {"customers": Merge(keys, lambda rows: G.touch_rows(rows, keys, key, "touch"))})
    deleted.merge("delete", {"customers": Merge(keys, lambda rows: G.flag_deleted(rows, keys, key, F.lit(NOW).cast("timestamp")))})
    earlier = deleted.rows_of("customers", keys, 1)
    deleted.merge("restore", {"customers": Merge(keys, lambda rows: G.restore_flags(rows, earlier, keys, key))})
    steps = {"touched": touched.read("customers"), "deleted": deleted.read("customers", 2), "restored": deleted.read("customers")}
    out = None
    for name, df in steps.items():
        part = df.groupBy("_is_deleted_in_source", "_silver_run_id").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("step"), "*")
        out = part if out is None else out.unionByName(part)
    return out


