"""Control tables treated as data: batch registry, checkpoints, run log, worklists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import lookup
from tidemark.operators.segments import first_per_key, latest_per_key, segmented
from tidemark.session import cut

#: Which of several events at one instant counts.
EVENT_RANK = {"waived": 1, "completed": 2, "rejected": 3, "failed": 4, "silver_applied": 5}
CLOSED = ("completed", "waived", "duplicate_ignored", "superseded")


def event_rank(event_type: Column) -> Column:
    return F.coalesce(lookup(EVENT_RANK, event_type), F.lit(6))


def register_batches(discovered: DataFrame, registered: DataFrame) -> DataFrame:
    """Registrations not seen before, by folder, batch id and content. Insert-only, texts kept whole."""
    identity = ["batch_seq", "batch_id", "_content"]
    content = F.coalesce("content_hash", F.lit(""))
    known = registered.select("batch_seq", "batch_id", content.alias("_content"))
    fresh = discovered.withColumn("_content", content).join(known, identity, "left_anti")
    return fresh.dropDuplicates(identity).drop("_content")


def first_registrations(manifest: DataFrame) -> DataFrame:
    """The first registration of each batch_seq."""
    return first_per_key(manifest, ["batch_seq"], [F.col("discovered_at"), F.col("batch_id")])


def latest_events(events: DataFrame) -> DataFrame:
    """The event that counts per batch: the latest, ties by kind."""
    return latest_per_key(events, ["batch_seq"], [F.col("event_at"), -event_rank(F.col("event_type"))])


def repeated_ids(first: DataFrame) -> DataFrame:
    """batch_seq, duplicate_of_seq and clash_seq: earlier uses of the same batch id.

    duplicate_of_seq is the earliest use with the same content, clash_seq the earliest with
    other content. Both come from minima per (id, content), so no row meets every other
    row of its id: the least use under other content is the least of the id, or, where
    that one is the row's own content, the second least.
    """
    content = F.coalesce("content_hash", F.lit(""))
    rows = first.select("batch_seq", "batch_id", "is_valid", content.alias("_c"),
                        F.col("content_hash").isNotNull().alias("_has"))
    per_content = rows.groupBy("batch_id", "_c").agg(F.min("batch_seq").alias("_first"))
    two = per_content.groupBy("batch_id").agg(
        F.min(F.struct("_first", "_c")).alias("_a"))
    second = (per_content.join(two, "batch_id").where(F.col("_c") != F.col("_a._c"))
              .groupBy("batch_id").agg(F.min("_first").alias("_b")))
    joined = (rows.join(per_content, ["batch_id", "_c"]).join(two, "batch_id")
              .join(second, "batch_id", "left"))
    other = F.when(F.col("_a._c") != F.col("_c"), F.col("_a._first")).otherwise(F.col("_b"))
    seq = F.col("batch_seq")
    return joined.select(
        "batch_seq",
        F.when(F.col("is_valid") & F.col("_has") & (F.col("_first") < seq), F.col("_first")).alias("duplicate_of_seq"),
        F.when(other < seq, other).alias("clash_seq"))


def batch_state(manifest: DataFrame, events: DataFrame) -> DataFrame:
    """One row per landed batch with its derived state.

    waived > conflict > latest event > rejected at discovery > duplicate_ignored > discovered;
    then superseded (a rejected batch a later completed one names) and blocked (an earlier
    batch is open or missing).
    """
    first = first_registrations(manifest)
    variants = manifest.groupBy("batch_seq").agg(F.countDistinct(
        F.concat_ws("|", "batch_id", F.coalesce("content_hash", F.lit("")))).alias("_variants"))
    last = latest_events(events).select(
        "batch_seq", F.col("event_type").alias("_event"), F.col("event_at").alias("_event_at"),
        F.col("message").alias("_message"))
    owner = latest_per_key(events.where(F.col("event_type") == "claimed"), ["batch_seq"], [F.col("event_at")])
    owner = owner.select("batch_seq", F.col("run_id").alias("owner_run_id"))
    base = (first.join(variants, "batch_seq").join(last, "batch_seq", "left").join(owner, "batch_seq", "left")
            .join(repeated_ids(first), "batch_seq", "left"))
    conflict = (F.col("_variants") > 1) | F.col("clash_seq").isNotNull()
    base = base.withColumn(
        "_base",
        F.when(F.col("_event") == "waived", "waived").when(conflict, "conflict")
        .when(F.col("_event").isNotNull(), F.col("_event")).when(~F.col("is_valid"), "rejected")
        .when(F.col("duplicate_of_seq").isNotNull(), "duplicate_ignored").otherwise("discovered"))

    completed = (base.where(F.col("_base") == "completed").groupBy(F.col("supersedes_batch_id").alias("batch_id"))
                 .agg(F.max("batch_seq").alias("_replaced_by")))
    settled = base.join(completed, "batch_id", "left").withColumn(
        "_settled", F.when((F.col("_base") == "rejected") & (F.col("_replaced_by") > F.col("batch_seq")),
                           "superseded").otherwise(F.col("_base")))
    # Read four times below; one row per batch is cheaper to store than to derive again.
    settled = cut(settled)

    # The frontier is the earliest open batch: one row, read as scalar subqueries.
    open_ = settled.where(~F.col("_settled").isin(*CLOSED))
    front = open_.agg(F.min(F.struct("batch_seq", "batch_id", "_settled")).alias("f"))
    out = settled.withColumn("_f", front.scalar())
    front_seq = F.col("_f.batch_seq")
    earlier = settled.select(F.col("batch_seq").alias("s")).agg(
        F.count_if(F.col("s") < front.select("f.batch_seq").scalar()).alias("n"))
    gap = earlier.scalar() != front_seq
    waits = (F.col("batch_seq") == front_seq) & gap
    behind = (F.col("batch_seq") > front_seq) & ~(
        (F.col("_f._settled") == "rejected")
        & (F.coalesce("supersedes_batch_id", F.lit("")) == F.col("_f.batch_id")))
    blocked = F.coalesce((F.col("_settled") == "discovered") & (waits | behind), F.lit(False))
    message = (
        F.when(F.col("_event") == "waived", F.col("_message"))
        .when(F.col("_variants") > 1, F.format_string("batch_seq %d has %d manifests", "batch_seq", "_variants"))
        .when(F.col("clash_seq").isNotNull(),
              F.format_string("batch_id %s is used at batch_seq %d with other content", "batch_id", "clash_seq"))
        .otherwise(F.coalesce("_message", "problems")))
    return out.select(
        *[c for c in first.columns if c not in ("problems",)], "duplicate_of_seq",
        F.when(blocked, "blocked").otherwise(F.col("_settled")).alias("state"),
        F.coalesce("_event_at", "discovered_at").alias("state_at"), "owner_run_id",
        message.alias("state_message"), F.col("_settled").isin(*CLOSED).alias("is_closed"))


def batch_next(state: DataFrame) -> DataFrame:
    """The one decision for the next run.

    Candidates are per-row flags on the state table; the earliest open batch and the count
    of batches before it are scalar subqueries, and the decision is one top-1.
    """
    seq = F.col("batch_seq")
    open_ = state.where(~F.col("is_closed"))
    front = open_.agg(F.min(F.struct("batch_seq", "batch_id", "state")).alias("f"))
    earlier = state.agg(F.count_if(seq < front.select("f.batch_seq").scalar()).alias("n"))
    rows = state.withColumn("_f", front.scalar()).withColumn("_earlier", earlier.scalar())
    at_front = seq == F.col("_f.batch_seq")
    replaces = ((F.col("_f.state") == "rejected") & (F.col("supersedes_batch_id") == F.col("_f.batch_id"))
                & (seq > F.col("_f.batch_seq")) & F.col("is_valid") & (F.col("state") == "discovered"))
    choice = (
        F.when(F.col("state").isin("claimed", "silver_applied"), F.struct(F.lit(1), F.lit("in_flight")))
        .when(F.col("state") == "conflict", F.struct(F.lit(2), F.lit("stop_conflict")))
        .when(at_front & (F.col("_earlier") != seq), F.struct(F.lit(3), F.lit("wait_for_predecessor")))
        .when(at_front & (F.col("state") == "failed"), F.struct(F.lit(4), F.lit("retry")))
        .when((at_front & (F.col("state") == "discovered")) | replaces, F.struct(F.lit(4), F.lit("claim")))
        .when(at_front & (F.col("state") == "rejected"), F.struct(F.lit(5), F.lit("stop_rejected")))
        .when(at_front, F.struct(F.lit(7), F.lit("stop_unexpected_state"))))
    choice = choice.cast("struct<priority:int,decision:string>")
    candidates = rows.withColumn("_c", choice).where(F.col("_c").isNotNull()).select(
        "_c.priority", "_c.decision", "batch_seq", "batch_id", "batch_mode")
    # An in-flight or conflicting frontier may also be one with a gap; the lower priority wins anyway.
    best = candidates.agg(F.min(F.struct("priority", "batch_seq", "decision", "batch_id", "batch_mode")).alias("b"))
    return best.select(
        F.coalesce("b.decision", F.lit("nothing_to_do")).alias("decision"),
        F.col("b.batch_seq").alias("batch_seq"), F.col("b.batch_id").alias("batch_id"),
        F.col("b.batch_mode").alias("batch_mode"))


# --- transitions ----------------------------------------------------------------

#: The states an event may follow.
ALLOWED_BEFORE = {
    "claimed": ("discovered", "failed"),
    "silver_applied": ("claimed",),
    "rejected": ("claimed",),
    "completed": ("silver_applied",),
    "failed": ("claimed", "silver_applied"),
    "waived": ("rejected", "conflict"),
}


def audit_transitions(events: DataFrame, gold_success: DataFrame) -> DataFrame:
    """Every recorded event that was not allowed: (batch_seq, event_type, event_at, violation).

    The state before an event is the event before it, or discovered. The owner is the run
    of the latest claim. gold_success holds the run ids whose gold load succeeded.
    """
    who = F.when(F.col("event_type") == "claimed", F.col("run_id"))
    rows = segmented(events, ["batch_seq"], ["event_at", "event_type"], lag={"_before": F.col("event_type")},
                     last={"_owner": who})
    rows = rows.withColumn("_state", F.coalesce("_before", F.lit("discovered")))
    done = gold_success.select("run_id").distinct().withColumn("_gold", F.lit(True))
    rows = rows.join(done, "run_id", "left")
    allowed = F.create_map(*[x for event, states in ALLOWED_BEFORE.items()
                             for x in (F.lit(event), F.array(*[F.lit(s) for s in states]))])
    kind = F.col("event_type")
    own = F.col("run_id").eqNullSafe(F.col("_owner")) & F.col("run_id").isNotNull()

    def blank(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""

    checks = {
        "not the owner": kind.isin("silver_applied", "completed", "rejected") & ~own,
        "not a valid next state": ~F.array_contains(allowed[kind], F.col("_state")),
        "needs a reason": kind.isin("rejected", "failed") & blank("message"),
        "needs the operator": (kind == "failed") & ~own & blank("actor"),
        "incomplete waiver": (kind == "waived") & (blank("actor") | blank("message") | blank("integrity_note")),
        "gold not complete": (kind == "completed") & F.col("_gold").isNull(),
    }
    broken = F.filter(F.array(*[F.when(test, F.lit(text)) for text, test in checks.items()]),
                      lambda v: v.isNotNull())
    return rows.select("batch_seq", "event_type", "event_at", F.explode(broken).alias("violation"))


# --- run log --------------------------------------------------------------------

def _successes(run_log: DataFrame) -> DataFrame:
    """The latest success per run and step: an aggregate, so the joins on it stay unique."""
    return (run_log.where(F.col("event_type") == "succeeded").groupBy("run_id", "step_name")
            .agg(F.max("event_at").alias("_succeeded_at")))


def successful_windows(ledger: DataFrame, run_log: DataFrame) -> DataFrame:
    """Detections whose step succeeded at or after them."""
    return (ledger.join(_successes(run_log), ["run_id", "step_name"])
            .where(F.col("_succeeded_at") >= F.col("detected_at")).drop("_succeeded_at"))


def cdf_checkpoint(ledger: DataFrame, run_log: DataFrame) -> DataFrame:
    """Where each (step, table) resumes: its most recent successful window, not its greatest."""
    return (successful_windows(ledger, run_log).groupBy("step_name", "source_table")
            .agg(F.max_by("version_to", F.struct("detected_at", "version_to")).alias("last_version")))


def unfinished_runs(ledger: DataFrame, run_log: DataFrame) -> DataFrame:
    """Detections with no success at all."""
    done = _successes(run_log).select("run_id", "step_name")
    return (ledger.join(done, ["run_id", "step_name"], "left_anti").groupBy("run_id", "step_name")
            .agg(F.min("detected_at").alias("detected_at")))


def reconciliation_latest(results: DataFrame) -> DataFrame:
    """The rows of each run's newest attempt."""
    newest = results.groupBy("run_id").agg(F.max("checked_at").alias("checked_at"))
    return results.join(newest, ["run_id", "checked_at"], "left_semi")


def missing_steps(run_log: DataFrame, runs: DataFrame, steps: DataFrame) -> DataFrame:
    """Steps a run has not finished successfully: (run_id, step_name).

    The steps are the fixed short list of the load, so each run is expanded by it.
    """
    wanted = runs.select("run_id").distinct().select(
        "run_id", F.explode(steps.agg(F.collect_set("step_name")).scalar()).alias("step_name"))
    return wanted.join(_successes(run_log).select("run_id", "step_name"), ["run_id", "step_name"], "left_anti")


def purge_redundant_keys(worklist: DataFrame, ledger: DataFrame, run_log: DataFrame, now: Column,
                         hours: int = 24) -> DataFrame:
    """The worklist rows kept: young ones, and those no later successful detection covers.

    worklist (run_id, step_name, key, detected_at). Rows a full scan put there wait for a
    later full scan. Per step only the latest successful detection matters.
    """
    if hours < 24:
        raise ValueError("rows younger than 24 hours may belong to a run in flight")
    latest = successful_windows(ledger, run_log).groupBy("step_name").agg(
        F.max("detected_at").alias("_any"),
        F.max(F.when(F.col("is_full_scan"), F.col("detected_at"))).alias("_full"))
    full_runs = (ledger.where("is_full_scan").select("run_id", "step_name").distinct()
                 .withColumn("_from_full", F.lit(True)))
    rows = worklist.join(full_runs, ["run_id", "step_name"], "left").join(latest, "step_name", "left")
    covered = F.when(F.col("_from_full").isNotNull(), F.col("_full")).otherwise(F.col("_any"))
    old = F.col("detected_at") < now - F.expr(f"INTERVAL {hours} HOURS")
    purge = F.coalesce(old & (covered > F.col("detected_at")), F.lit(False))
    return rows.where(~purge).select(*worklist.columns)
