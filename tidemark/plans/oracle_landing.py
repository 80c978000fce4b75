"""Oracle relations for landed batches, histories and control tables."""

from __future__ import annotations

from tidemark.plans import landing
from tidemark.plans.oracle import define
from tidemark.plans.trucking import DUCK

define("landed_manifests", landing.EXPECTED)
define("user_days", landing.HISTORY)
define("customers_after", landing.CUSTOMERS_AFTER)
define("registry", landing.REGISTRY.format(**DUCK.given))
define("batch_events", landing.BATCH_EVENTS.format(**DUCK.given))
define("ledger", landing.LEDGER.format(**DUCK.given))
define("run_log", landing.RUN_LOG.format(**DUCK.given))
define("worklist", landing.WORKLIST.format(**DUCK.given))

# Both versions of each edited table, and the images that changed between them.
for _table, (_values, _kept) in landing.EDITS.items():
    define(f"{_table}_before", f"SELECT * FROM raw_{_table}")
    define(f"{_table}_edited", f"SELECT * REPLACE ({', '.join(f'{v} AS {c}' for c, v in _values.items())}) FROM raw_{_table} WHERE {_kept}")
    define(f"{_table}_changes", f"""
        SELECT * FROM (SELECT * FROM {_table}_before EXCEPT SELECT * FROM {_table}_edited)
        UNION ALL SELECT * FROM (SELECT * FROM {_table}_edited EXCEPT SELECT * FROM {_table}_before)""")


def state_sql(history: str, detect: bool) -> str:
    """Current state of a (user_id, event_type, seen_at, mode) history, by windows and range joins."""
    snaps = f"(SELECT DISTINCT seen_at AS snap FROM {history} WHERE mode = 'full')"
    missed = (f"EXISTS (SELECT 1 FROM {snaps} WHERE snap > p.prev_at AND snap < p.seen_at)" if detect else "FALSE")
    gone = (f"(SELECT min(snap) FROM {snaps} WHERE snap > r.seen_at)" if detect else "CAST(NULL AS TIMESTAMP)")
    return f"""
        SELECT user_id, event_type, seen_at, coalesce({gone}, run_start) AS changed_at, {gone} IS NOT NULL AS deleted
        FROM (SELECT q.*, last_value(CASE WHEN starts THEN seen_at END IGNORE NULLS) OVER (
                         PARTITION BY user_id ORDER BY seen_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                         AS run_start,
                     row_number() OVER (PARTITION BY user_id ORDER BY seen_at DESC) AS rn
              FROM (SELECT p.*, prev_type IS NULL OR prev_type <> event_type OR {missed} AS starts
                    FROM (SELECT *, lag(event_type) OVER w AS prev_type, lag(seen_at) OVER w AS prev_at
                          FROM {history} WINDOW w AS (PARTITION BY user_id ORDER BY seen_at)) AS p) AS q) AS r
        WHERE rn = 1"""


define("user_state", state_sql("user_days", True))
define("early_days", "SELECT * FROM user_days WHERE seen_at <= TIMESTAMP '2024-01-20'")
define("late_days", "SELECT * FROM user_days WHERE seen_at >= TIMESTAMP '2024-01-15'")
define("early_state", state_sql("early_days", True))
define("late_state", state_sql("late_days", False))

# The user snapshot and the change events on it.
define("user_snapshot", """
    SELECT user_id, 'snapshot' AS event_type, CAST(min(value) AS DECIMAL(14,2)) AS value,
           user_id % 4 = 0 AS deleted, TIMESTAMP '2023-12-31' AS changed_at
    FROM events GROUP BY user_id""")
define("user_changes", """
    SELECT user_id, event_type, CAST(value AS DECIMAL(14,2)) AS value,
           CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
           event_id + 1 AS seq, ts FROM events""")
