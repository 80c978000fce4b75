"""An incremental load of one fact, from change feeds to a commit.

Gate, affected keys and heal keys, stage, grain check, guard, publish, run event: every step is an operator of its own; here
they are put together. The rows read and written follow the worklist: facts are bucketed by key, and only the buckets of its keys are
rewritten. Fact, checkpoints and run event appear in one commit, so a run that stops anywhere before leaves nothing
but its own failure on record.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed
from tidemark.operators.detect import AFFECTED, LINKS, READS, full_reconcile_keys, heal_keys
from tidemark.operators.facts import FACTS
from tidemark.operators.history import apply_change_batch, validate_change_batch
from tidemark.operators.lookups import assert_grain
from tidemark.operators.merge import mass_delete_guard, publish_by_key, publish_counts
from tidemark.session import cut, discard, stored
from tidemark.sources.buckets import BucketLog, Merge

RUN_LOG = "run_id string, step_name string, event_type string, event_at timestamp, detail string"
RUN_KEYS = ("run_id", "step_name", "event_type")
LEDGER = "run_id string, step_name string, source_table string, version_from bigint, version_to bigint, is_full_scan boolean, detected_at timestamp"
LEDGER_KEYS = ("run_id", "step_name", "source_table")


def _put(log: BucketLog, schema: str, rows: Sequence[tuple], keys: Sequence[str]) -> Merge:
    """A merge that adds a run's own few rows to a control table."""
    df = log.spark.createDataFrame(list(rows), schema)
    return Merge(df.select(*keys), lambda _: df)


def record(log: BucketLog, run_id: str, step: str, event: str, at: datetime, detail: str | None = None) -> Merge:
    return _put(log, RUN_LOG, [(run_id, step, event, at, detail)], RUN_KEYS)


def land_batch(log: BucketLog, table: str, events: DataFrame, key: str, business_date: str, run_id: str) -> int:
    """Apply a landed change batch to its raw table, after the gate: a batch that breaks a rule changes nothing.

    Returns the version before, from which on the table's feed holds what the batch changed.
    """
    events = stored(events, "landed")
    # the gate reads the batch's own buckets
    known = log.rows_of(table, events.select(key))
    broken = validate_change_batch(known, events, key, F.lit(business_date).cast("date")).groupBy("rule").count().collect()  # a row per rule
    if broken:
        raise CheckFailed(f"{table}: " + ", ".join(f"{r['rule']} {r['count']}" for r in sorted(broken)))
    before = log.layout(table).version
    log.merge(run_id, {table: Merge(events.select(key), lambda rows: apply_change_batch(rows, events, key))})
    discard(events)
    return before


def checkpoint(log: BucketLog, step: str, table: str) -> int | None:
    """The version of a table that a step has seen last; ledger rows are committed with the publish, so those are successes."""
    seen = log.read("ledger").where((F.col("step_name") == step) & (F.col("source_table") == table))
    return seen.agg(F.max("version_to")).first()[0]


def worklist(log: BucketLog, name: str, dims: dict[str, DataFrame]) -> tuple[DataFrame, list[tuple]]:
    """(keys to rebuild, ledger rows): affected by what changed since the checkpoints, and in need of healing.

    Without a checkpoint, or where a feed can't be read from it, every key of both sides is listed.
    """
    _, key, key_columns = FACTS[name]
    tables = READS[name]
    silver = {t: log.read(f"silver_{t}") for t in tables}
    fact = log.read(f"fact_{name}")
    seen = {t: checkpoint(log, name, f"silver_{t}") for t in tables}
    now = {t: log.layout(f"silver_{t}").version for t in tables}
    try:
        if None in seen.values():
            raise CheckFailed("no checkpoint")
        changes = {t: log.changes(f"silver_{t}", seen[t]) for t in tables}
        keys, full = AFFECTED[name](changes, silver), False
    except CheckFailed:
        keys, full = full_reconcile_keys(silver[tables[0]], fact.select(key), key), True
    healed = heal_keys(fact, dims, key, key_columns, LINKS[name])
    listed = keys.select(key).unionByName(healed.select(key)).distinct()
    return stored(listed, "worklist"), [(f"silver_{t}", seen[t], now[t], full) for t in tables]


def load_fact(log: BucketLog, name: str, dims: dict[str, DataFrame], run_id: str, at: datetime, allow_mass_delete: bool = False) -> dict:
    """Bring fact_<name> up to its silver tables; the counts of the publish. A check that fails is recorded, raised, and publishes nothing."""
    build, key, key_columns = FACTS[name]
    target = f"fact_{name}"
    try:
        keys, seen = worklist(log, name, dims)
        silver = {t: log.read(f"silver_{t}") for t in READS[name]}
        stage = assert_grain(stored(build(keys, silver, dims), "stage"), key, target)
        counts = cut(publish_counts(log.read(target), stage, keys, key, key_columns))   # one row, read twice
        mass_delete_guard(counts, target, allow_mass_delete)
    except CheckFailed as failed:
        log.merge(run_id, {"run_log": record(log, run_id, name, "failed", at, str(failed))})
        raise
    rows = [(run_id, name, table, before, now, full, at) for table, before, now, full in seen]
    log.merge(run_id, {target: Merge(keys, lambda mine: publish_by_key(mine, stage, keys, key)),
                       "ledger": _put(log, LEDGER, rows, LEDGER_KEYS), "run_log": record(log, run_id, name, "succeeded", at)})
    discard(keys)
    discard(stage)
    return counts.first().asDict()


def control_tables(log: BucketLog) -> dict[str, tuple[DataFrame, Sequence[str]]]:
    """The empty run log and ledger of a new warehouse."""
    empty = functools.partial(log.spark.createDataFrame, [])
    return {"run_log": (empty(RUN_LOG), RUN_KEYS), "ledger": (empty(LEDGER), LEDGER_KEYS)}
