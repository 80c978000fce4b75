import datetime as dt

from conftest import rows_of

from tidemark.operators import hashes as H

SCHEMA = "k string, v string, t timestamp, _source_sequence bigint"
T = dt.datetime(2024, 1, 1, 10, 30)


def hashed(make, *rows):
    return H.row_hashes(make(SCHEMA, *rows), "k")


def one(make, row):
    return hashed(make, row).first()["row_hash"]


def test_what_changes_a_hash(make):
    base = one(make, ("a", "x", T, 1))
    assert one(make, ("a", "x", T, 99)) == base  # lineage does not count
    assert one(make, ("a", "", T, 1)) != one(make, ("a", None, T, 1))
    assert one(make, ("a", "x", T + dt.timedelta(microseconds=1), 1)) != base


def test_comparison_and_decisions(make):
    left = hashed(make, ("a", "x", T, 1), ("b", "x", T, 1), ("c", "x", T, 1), ("r", "x", T, 1), ("r", "y", T, 1))
    right = hashed(make, ("a", "x", T, 2), ("b", "y", T, 1), ("d", "x", T, 1), ("r", "x", T, 1))
    assert H.compare_hashes(left, right).first().asDict() == {
        "equal": 1, "changed": 2, "only_left": 1, "only_right": 1, "repeated_keys": 1}
    assert rows_of(H.difference_examples(left, right, 1), "status", "business_key") == [
        ("changed", "b"), ("only_left", "c"), ("only_right", "d")]
    clean = hashed(make, ("a", "x", T, 1), ("b", "x", T, 1))
    empty = clean.where("false")
    plans = [H.snapshot_decision(clean, empty, "new"), H.snapshot_decision(clean, clean, "same"),
             H.snapshot_decision(left, right, "other"), H.snapshot_decision(empty, clean, "lost")]
    assert [p.first()["decision"] for p in plans] == ["load", "unchanged", "reject", "reject"]
    both = plans[0].unionByName(plans[1])
    assert H.batch_outcome(both).first()["outcome"] == "applied"
    assert H.batch_outcome(both.unionByName(plans[2])).first()["outcome"] == "rejected"
    assert H.batch_outcome(plans[1]).first()["outcome"] == "unchanged"


def test_baseline(make):
    df = make(SCHEMA, ("a", "x", T, 1), ("b", "x", T, 1))
    later = make(SCHEMA, ("a", "x", T, 5), ("b", "z", T, 1), ("c", "x", T, 1))
    base, now = H.capture_baseline({"t": (df, "k")}, "l"), H.capture_baseline({"t": (later, "k")}, "n")
    assert rows_of(H.compare_baseline(base, now), "table", "equal", "changed", "only_left", "only_right") == [
        ("t", 1, 1, 0, 1)]
