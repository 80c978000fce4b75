import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import control as C


def at(n, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, minutes=minute)


MANIFEST = ("batch_seq int, batch_id string, batch_mode string, supersedes_batch_id string, content_hash string, "
            "is_valid boolean, problems string, discovered_at timestamp")
EVENT = "batch_seq int, event_type string, event_at timestamp, run_id string, actor string, message string, integrity_note string"


def m(seq, ident=None, content=None, valid=True, supersedes=None, found=0):
    ident = ident or f"b{seq}"
    return (seq, ident, "CHANGE_BATCH", supersedes, content or f"h{seq}", valid, None if valid else "bad", at(found))


def done(seq):
    return [(seq, k, at(seq, i), f"r{seq}", None, None, None) for i, k in enumerate(("claimed", "silver_applied", "completed"))]


def event(seq, kind, minute=0, run=None, actor=None, message=None, note=None):
    return (seq, kind, at(seq, minute), run or f"r{seq}", actor, message, note)


def states(make, manifest, events):
    e = make(EVENT, *events) if events else make(EVENT, event(999, "claimed")).where("false")
    state = C.batch_state(make(MANIFEST, *manifest), e)
    nxt = C.batch_next(state).first()
    return dict(rows_of(state, "batch_seq", "state")), (nxt["decision"], nxt["batch_seq"])


@pytest.mark.parametrize("manifest, events, want, decision", [
    ([m(0), m(1)], done(0), {0: "completed", 1: "discovered"}, ("claim", 1)),
    ([m(0), m(1)], [], {0: "discovered", 1: "blocked"}, ("claim", 0)),
    ([m(0), m(2)], done(0), {0: "completed", 2: "blocked"}, ("wait_for_predecessor", 2)),
    ([m(0)], done(0), {0: "completed"}, ("nothing_to_do", None)),
    ([m(0), m(1)], done(0) + [event(1, "claimed")], {0: "completed", 1: "claimed"}, ("in_flight", 1)),
    ([m(0), m(1)], done(0) + [event(1, "claimed"), event(1, "failed", 1, message="x")],
     {0: "completed", 1: "failed"}, ("retry", 1)),
    ([m(0), m(1, valid=False), m(2)], done(0), {0: "completed", 1: "rejected", 2: "blocked"}, ("stop_rejected", 1)),
    ([m(0), m(1, valid=False), m(2, supersedes="b1")], done(0), {0: "completed", 1: "rejected", 2: "discovered"},
     ("claim", 2)),
    ([m(0), m(1, valid=False), m(2, supersedes="b1")], done(0) + done(2),
     {0: "completed", 1: "superseded", 2: "completed"}, ("nothing_to_do", None)),
    ([m(0), m(1, "b0", "h0"), m(2)], done(0), {0: "completed", 1: "duplicate_ignored", 2: "discovered"}, ("claim", 2)),
    ([m(0), m(1, "b0", "other")], done(0), {0: "completed", 1: "conflict"}, ("stop_conflict", 1)),
    ([m(0), m(0, "bx", "hx", found=1)], [], {0: "conflict"}, ("stop_conflict", 0)),
    ([m(0), m(1, "b0", "other"), m(2)], done(0) + [event(1, "waived", 5, actor="a", message="m", note="n")],
     {0: "completed", 1: "waived", 2: "discovered"}, ("claim", 2)),
])
def test_states_and_decision(make, manifest, events, want, decision):
    assert states(make, manifest, events) == (want, decision)


def test_ties_go_to_the_stronger_event(make):
    e = make(EVENT, event(1, "claimed"), event(1, "completed"), event(1, "failed"))
    assert rows_of(C.latest_events(e), "event_type") == [("completed",)]


def test_registration_is_insert_only_and_keeps_texts_whole(make):
    cols = "batch_seq int, batch_id string, content_hash string, problems string"
    known = make(cols, (0, "a", "h", None), (1, "b", None, None))
    found = make(cols, (0, "a", "h", None), (0, "a", "h2", None), (1, "b", None, "x"), (2, "c", None, "p" * 5000))
    got = C.register_batches(found, known)
    assert rows_of(got, "batch_seq", "content_hash") == [(0, "h2"), (2, None)]
    assert got.where("batch_seq = 2").first()["problems"] == "p" * 5000
    long = make(cols, (3, "i" * 200 + "1", "h", None), (3, "i" * 200 + "2", "h", None))
    assert rows_of(C.register_batches(long, known), "batch_id") == [("i" * 200 + "1",), ("i" * 200 + "2",)]


def test_audit(make):
    e = make(EVENT, event(1, "claimed", 0), event(1, "silver_applied", 1), event(1, "completed", 2),
             event(2, "claimed", 0), event(2, "silver_applied", 1, run="other"), event(3, "claimed", 0),
             event(3, "failed", 1, run="other"), event(4, "waived", 0, actor="a"))
    gold = make("run_id string", ("r1",))
    got = C.audit_transitions(e, gold)
    assert rows_of(got, "batch_seq", "violation") == [
        (2, "not the owner"), (3, "needs a reason"), (3, "needs the operator"), (4, "incomplete waiver"),
        (4, "not a valid next state")]


LEDGER = ("run_id string, step_name string, source_table string, version_from bigint, version_to bigint, "
          "is_full_scan boolean, detected_at timestamp")
LOG = "run_id string, step_name string, event_type string, event_at timestamp"


def test_checkpoint_is_the_latest_success_not_the_greatest(make):
    ledger = make(LEDGER, ("r1", "f", "a", 0, 50, False, at(1)), ("r2", "f", "a", 0, 3, False, at(2)),
                  ("r3", "f", "a", 3, 9, False, at(3)), ("r4", "f", "a", 3, 9, False, at(4)))
    log = make(LOG, ("r1", "f", "succeeded", at(1, 5)), ("r2", "f", "succeeded", at(2, 5)), ("r3", "f", "failed", at(3, 5)),
               ("r4", "f", "succeeded", at(3, 59)))
    assert rows_of(C.cdf_checkpoint(ledger, log), "last_version") == [(3,)]
    assert rows_of(C.unfinished_runs(ledger, log), "run_id") == [("r3",)]
    assert rows_of(C.missing_steps(log, make("run_id string", ("r3",), ("r1",)), make("step_name string", ("f",), ("g",))),
                   "run_id", "step_name") == [("r1", "g"), ("r3", "f"), ("r3", "g")]


def test_purge_waits_for_a_full_scan(make):
    ledger = make(LEDGER, ("full", "f", "a", 0, 1, True, at(1)), ("r1", "f", "a", 0, 1, False, at(1)),
                  ("r2", "f", "a", 1, 2, False, at(5)))
    log = make(LOG, ("r2", "f", "succeeded", at(5, 5)))
    work = make("run_id string, step_name string, key int, detected_at timestamp", ("full", "f", 1, at(1)),
                ("r1", "f", 2, at(1)), ("r1", "g", 3, at(1)), ("r9", "f", 4, at(9, 60)))
    kept = C.purge_redundant_keys(work, ledger, log, F.lit(at(10)))
    assert rows_of(kept, "key") == [(1,), (3,), (4,)]
    with pytest.raises(ValueError):
        C.purge_redundant_keys(work, ledger, log, F.lit(at(10)), hours=2)


def test_latest_reconciliation(make):
    r = make("run_id string, checked_at timestamp, metric string", ("a", at(1), "x"), ("a", at(2), "y"), ("b", at(1), "z"))
    assert rows_of(C.reconciliation_latest(r), "run_id", "metric") == [("a", "y"), ("b", "z")]
