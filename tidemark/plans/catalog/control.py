"""Control tables treated as data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import control as C
from tidemark.operators import manifests as M
from tidemark.plans import landing
from tidemark.plans.oracle import define
from tidemark.plans.registry import query

REG_OUT = ("batch_seq int, batch_id string, batch_mode string, business_date date, as_of_date date, "
           "previous_batch_id string, content_known flag, is_valid flag, problems string, table_count int, "
           "row_count bigint, manifest_path string, landed_at ts, discovery_run_id string")


@query("register_batches", REG_OUT, """
    SELECT seq AS batch_seq,
           CASE WHEN seq % 20 = 3 THEN printf('batch_seq=%06d', seq) ELSE printf('batch-%06d', seq) END AS batch_id,
           CASE WHEN seq % 20 = 3 THEN NULL WHEN seq = 0 THEN 'INITIAL_SNAPSHOT' ELSE 'CHANGE_BATCH' END AS batch_mode,
           CASE WHEN seq % 20 <> 3 AND seq > 0 THEN day END AS business_date, CASE WHEN seq = 0 THEN day END AS as_of_date,
           CASE WHEN seq % 20 <> 3 AND seq > 0 THEN printf('batch-%06d', seq - 1) END AS previous_batch_id,
           seq % 20 NOT IN (3, 5) AS content_known, problems IS NULL AS is_valid, problems,
           CASE WHEN seq % 20 <> 3 THEN 1 END AS table_count, CASE WHEN seq % 20 <> 3 THEN n END AS row_count,
           printf('batch_seq=%06d/_manifest.json', seq) AS manifest_path, CAST(day AS TIMESTAMP) AS landed_at,
           'run-2' AS discovery_run_id
    FROM landed_manifests WHERE seq % 4 <> 1""")
def register_batches(spark, sf):
    """Registry rows for every manifest, less those an earlier run registered; a second run adds none."""
    judged = M.problems(M.parse(landing.manifests(spark, sf)), list(_SNAPSHOT_TABLES), list(_CHANGE_TABLES))
    rows = M.registrations(judged, "run-2", F.lit("2024-01-01").cast("timestamp"))
    known = rows.where("batch_seq % 4 = 1")
    return C.register_batches(rows, known).withColumn("content_known", F.col("content_hash").isNotNull())


_SNAPSHOT_TABLES = ("customers", "facilities", "drivers", "trucks", "trailers", "routes", "loads", "trips",
                    "fuel_purchases", "maintenance_records", "delivery_events", "safety_incidents")
_CHANGE_TABLES = ("customers", "drivers", "trucks", "loads", "trips", "fuel_purchases", "delivery_events")

define("reg_first", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_seq ORDER BY discovered_at, batch_id) AS rn FROM registry)
    WHERE rn = 1""")
define("reg_event", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_seq ORDER BY event_at DESC,
        CASE event_type WHEN 'waived' THEN 1 WHEN 'completed' THEN 2 WHEN 'rejected' THEN 3 WHEN 'failed' THEN 4
             WHEN 'silver_applied' THEN 5 ELSE 6 END) AS rn FROM batch_events) WHERE rn = 1""")
define("reg_base", """
    SELECT f.*, d.dup AS duplicate_of_seq, e.event_at, o.run_id AS owner_run_id,
           CASE WHEN e.event_type = 'waived' THEN 'waived' WHEN v.n > 1 OR c.clash IS NOT NULL THEN 'conflict'
                WHEN e.event_type IS NOT NULL THEN e.event_type WHEN NOT f.is_valid THEN 'rejected'
                WHEN d.dup IS NOT NULL THEN 'duplicate_ignored' ELSE 'discovered' END AS base
    FROM reg_first AS f
    JOIN (SELECT batch_seq, count(DISTINCT batch_id || '|' || coalesce(content_hash, '')) AS n FROM registry
          GROUP BY 1) AS v USING (batch_seq)
    LEFT JOIN reg_event AS e USING (batch_seq)
    LEFT JOIN (SELECT batch_seq, arg_max(run_id, event_at) AS run_id FROM batch_events WHERE event_type = 'claimed'
               GROUP BY 1) AS o USING (batch_seq)
    LEFT JOIN (SELECT l.batch_seq, min(x.batch_seq) AS dup FROM reg_first AS l JOIN reg_first AS x
               ON x.batch_id = l.batch_id AND x.content_hash = l.content_hash AND x.batch_seq < l.batch_seq
               WHERE l.is_valid GROUP BY 1) AS d USING (batch_seq)
    LEFT JOIN (SELECT l.batch_seq, min(x.batch_seq) AS clash FROM reg_first AS l JOIN reg_first AS x
               ON x.batch_id = l.batch_id AND x.batch_seq < l.batch_seq
               AND coalesce(x.content_hash, '') <> coalesce(l.content_hash, '') GROUP BY 1) AS c USING (batch_seq)""")
define("reg_settled", """
    SELECT b.*, CASE WHEN base = 'rejected' AND r.last_seq > b.batch_seq THEN 'superseded' ELSE base END AS settled
    FROM reg_base AS b
    LEFT JOIN (SELECT supersedes_batch_id AS replaced, max(batch_seq) AS last_seq FROM reg_base
               WHERE base = 'completed' GROUP BY 1) AS r ON r.replaced = b.batch_id""")
define("reg_open", """
    SELECT min(batch_seq) AS fseq FROM reg_settled
    WHERE settled NOT IN ('completed', 'waived', 'duplicate_ignored', 'superseded')""")
define("reg_front", """
    SELECT o.fseq, s.batch_id AS fid, s.settled AS fstate,
           (SELECT count(*) FROM reg_settled, reg_open WHERE batch_seq < fseq) <> o.fseq AS gap
    FROM reg_open AS o JOIN reg_settled AS s ON s.batch_seq = o.fseq""")
define("reg_state", """
    SELECT s.batch_seq, s.batch_id, s.batch_mode, s.supersedes_batch_id, s.is_valid, s.duplicate_of_seq, s.owner_run_id,
           coalesce(s.event_at, s.discovered_at) AS state_at,
           CASE WHEN settled = 'discovered' AND ((s.batch_seq = fseq AND gap) OR (s.batch_seq > fseq AND NOT (
                     fstate = 'rejected' AND coalesce(s.supersedes_batch_id, '') = fid))) THEN 'blocked'
                ELSE settled END AS state,
           settled IN ('completed', 'waived', 'duplicate_ignored', 'superseded') AS is_closed
    FROM reg_settled AS s LEFT JOIN reg_front ON TRUE""")


@query("batch_state", "batch_seq int, batch_id string, duplicate_of_seq int, state string, state_at ts, "
                      "owner_run_id string, is_closed flag", "SELECT * FROM reg_state")
def batch_state(spark, sf):
    """The derived state of every landed batch."""
    return C.batch_state(landing.registry(spark, sf), landing.batch_events(spark, sf))


@query("batch_next", "decision string, batch_seq int, batch_id string, batch_mode string", """
    SELECT decision, batch_seq, batch_id, batch_mode FROM (
        SELECT 1 AS p, 'in_flight' AS decision, batch_seq, batch_id, batch_mode FROM reg_state
        WHERE state IN ('claimed', 'silver_applied')
        UNION ALL SELECT 2, 'stop_conflict', batch_seq, batch_id, batch_mode FROM reg_state WHERE state = 'conflict'
        UNION ALL SELECT 3, 'wait_for_predecessor', batch_seq, batch_id, batch_mode FROM reg_state, reg_front
        WHERE batch_seq = fseq AND gap
        UNION ALL SELECT 4, CASE state WHEN 'failed' THEN 'retry' ELSE 'claim' END, batch_seq, batch_id, batch_mode
        FROM reg_state, reg_front WHERE batch_seq = fseq AND state IN ('failed', 'discovered')
        UNION ALL SELECT 4, 'claim', batch_seq, batch_id, batch_mode FROM reg_state, reg_front
        WHERE fstate = 'rejected' AND supersedes_batch_id = fid AND batch_seq > fseq AND is_valid AND state = 'discovered'
        UNION ALL SELECT 5, 'stop_rejected', batch_seq, batch_id, batch_mode FROM reg_state, reg_front
        WHERE batch_seq = fseq AND state = 'rejected'
        UNION ALL SELECT 6, 'nothing_to_do', NULL, NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM reg_front)
        UNION ALL SELECT 7, 'stop_unexpected_state', batch_seq, batch_id, batch_mode FROM reg_state, reg_front
        WHERE batch_seq = fseq)
    ORDER BY p, batch_seq LIMIT 1""")
def batch_next(spark, sf):
    """The one decision for the next run."""
    return C.batch_next(C.batch_state(landing.registry(spark, sf), landing.batch_events(spark, sf)))


@query("audit_transitions", "batch_seq int, event_type string, event_at ts, violation string", """
    WITH e AS (SELECT *, coalesce(lag(event_type) OVER w, 'discovered') AS state,
                      last_value(CASE WHEN event_type = 'claimed' THEN run_id END IGNORE NULLS) OVER (
                          PARTITION BY batch_seq ORDER BY event_at, event_type
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner
               FROM batch_events WINDOW w AS (PARTITION BY batch_seq ORDER BY event_at, event_type)),
    c AS (SELECT *, run_id IS NOT NULL AND owner IS NOT NULL AND run_id = owner AS own FROM e)
    SELECT batch_seq, event_type, event_at, 'not the owner' AS violation FROM c
    WHERE event_type IN ('silver_applied', 'completed', 'rejected') AND NOT own
    UNION ALL SELECT batch_seq, event_type, event_at, 'not a valid next state' FROM c
    WHERE (event_type = 'claimed' AND state NOT IN ('discovered', 'failed'))
       OR (event_type IN ('silver_applied', 'rejected') AND state <> 'claimed')
       OR (event_type = 'completed' AND state <> 'silver_applied')
       OR (event_type = 'failed' AND state NOT IN ('claimed', 'silver_applied'))
       OR (event_type = 'waived' AND state NOT IN ('rejected', 'conflict'))
    UNION ALL SELECT batch_seq, event_type, event_at, 'needs a reason' FROM c
    WHERE event_type IN ('rejected', 'failed') AND trim(coalesce(message, '')) = ''
    UNION ALL SELECT batch_seq, event_type, event_at, 'needs the operator' FROM c
    WHERE event_type = 'failed' AND NOT own AND trim(coalesce(actor, '')) = ''
    UNION ALL SELECT batch_seq, event_type, event_at, 'incomplete waiver' FROM c
    WHERE event_type = 'waived' AND (trim(coalesce(actor, '')) = '' OR trim(coalesce(message, '')) = ''
                                     OR trim(coalesce(integrity_note, '')) = '')
    UNION ALL SELECT batch_seq, event_type, event_at, 'gold not complete' FROM c
    WHERE event_type = 'completed' AND run_id NOT IN (
        SELECT run_id FROM batch_events WHERE event_type = 'silver_applied' AND batch_seq % 3 <> 0)""")
def audit_transitions(spark, sf):
    """Recorded events that should not have been accepted; two thirds of the applied runs finished gold."""
    events = landing.batch_events(spark, sf)
    gold = events.where("event_type = 'silver_applied' AND batch_seq % 3 <> 0")
    return C.audit_transitions(events, gold)


@query("cdf_checkpoint", "step_name string, source_table string, last_version bigint", """
    SELECT step_name, source_table, arg_max(version_to, (detected_at, version_to)) AS last_version
    FROM ledger AS b WHERE EXISTS (SELECT 1 FROM run_log AS r WHERE r.run_id = b.run_id AND r.step_name = b.step_name
        AND r.event_type = 'succeeded' AND r.event_at >= b.detected_at) GROUP BY ALL""")
def cdf_checkpoint(spark, sf):
    return C.cdf_checkpoint(landing.ledger(spark, sf), landing.run_log(spark, sf))


@query("unfinished_runs", "run_id string, step_name string, detected_at ts", """
    SELECT run_id, step_name, min(detected_at) AS detected_at FROM ledger AS b
    WHERE NOT EXISTS (SELECT 1 FROM run_log AS r WHERE r.run_id = b.run_id AND r.step_name = b.step_name
        AND r.event_type = 'succeeded') GROUP BY ALL""")
def unfinished_runs(spark, sf):
    return C.unfinished_runs(landing.ledger(spark, sf), landing.run_log(spark, sf))


RESULTS = """
    SELECT 'r-' || CAST(user_id AS STRING) AS run_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS checked_at,
           'driver_monthly_metrics' AS baseline_name, event_type AS metric_name, event_type <> 'view' AS is_verified,
           CASE WHEN sum(value) > 200 THEN 'fail' ELSE 'pass' END AS status
    FROM {events} GROUP BY user_id, CAST(ts AS DATE), event_type"""
define("recon_results", RESULTS.format(events="events"))


def results(spark, sf):
    """Reconciliation attempts: each user is a run, each day an attempt, each event type a metric."""
    from tidemark.plans.trucking import given
    return spark.sql(RESULTS, events=given(spark, sf, "events"))


@query("reconciliation_latest", "run_id string, checked_at ts, metric_name string, status string", """
    SELECT run_id, checked_at, metric_name, status FROM recon_results AS r
    WHERE checked_at = (SELECT max(checked_at) FROM recon_results AS x WHERE x.run_id = r.run_id)""")
def reconciliation_latest(spark, sf):
    return C.reconciliation_latest(results(spark, sf))


@query("run_complete", "run_id string, step_name string", """
    SELECT r.run_id, s.step_name FROM (SELECT DISTINCT run_id FROM run_log) AS r,
        (SELECT DISTINCT event_type AS step_name FROM events) AS s
    WHERE NOT EXISTS (SELECT 1 FROM run_log AS l WHERE l.run_id = r.run_id AND l.step_name = s.step_name
        AND l.event_type = 'succeeded')""")
def run_complete(spark, sf):
    """Steps each run still owes."""
    log = landing.run_log(spark, sf)
    return C.missing_steps(log, log, log.select("step_name").distinct())


@query("purge_redundant_keys", "run_id string, step_name string, key bigint", """
    WITH ok AS (SELECT b.* FROM ledger AS b JOIN (
            SELECT run_id, step_name, max(event_at) AS done FROM run_log WHERE event_type = 'succeeded' GROUP BY ALL) AS r
            ON r.run_id = b.run_id AND r.step_name = b.step_name AND r.done >= b.detected_at),
    full_runs AS (SELECT DISTINCT run_id, step_name FROM ledger WHERE is_full_scan),
    w AS (SELECT l.*, f.run_id IS NOT NULL AS from_full FROM worklist AS l
          LEFT JOIN full_runs AS f ON f.run_id = l.run_id AND f.step_name = l.step_name)
    SELECT run_id, step_name, key FROM w
    WHERE NOT (w.detected_at < TIMESTAMP '2024-01-28' - INTERVAL 24 HOUR
               AND EXISTS (SELECT 1 FROM ok WHERE ok.step_name = w.step_name AND ok.detected_at > w.detected_at
                           AND (ok.is_full_scan OR NOT w.from_full)))""")
def purge_redundant_keys(spark, sf):
    return C.purge_redundant_keys(landing.worklist(spark, sf), landing.ledger(spark, sf), landing.run_log(spark, sf),
                                  F.lit("2024-01-28").cast("timestamp"))
