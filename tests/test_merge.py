import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed
from tidemark.operators import merge as M

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
TARGET = ("k int, v string, _source_changed_at timestamp, _silver_run_id string, _silver_created_at timestamp, "
          "_silver_updated_at timestamp")
SOURCE = "k int, v string, _source_changed_at timestamp, _silver_run_id string"


def test_merge_updates_only_real_changes(make):
    target = make(TARGET, (1, "a", T0, "r1", T0, T0), (2, None, T0, "r1", T0, T0), (3, "c", T0, "r1", T0, T0),
                  (4, None, T0, "r1", T0, T0))
    source = make(SOURCE, (1, "a", T1, "r2"), (2, "b", T1, "r2"), (4, None, T1, "r2"), (5, "e", T1, "r2"))
    got = M.merge_upsert(target, source, "k", now=F.lit(T1), with_action=True)
    assert rows_of(got, "k", "v", "_silver_run_id", "_silver_updated_at", "_action") == [
        (1, "a", "r1", T0, "keep"), (2, "b", "r2", T1, "update"), (3, "c", "r1", T0, "keep"), (4, None, "r1", T0, "keep"),
        (5, "e", "r2", T1, "insert")]


def test_change_feed_has_both_images(make):
    before = make("k int, parent int", (1, 10), (2, 20), (3, None))
    after = make("k int, parent int", (1, 11), (3, None), (4, 40))
    assert rows_of(M.change_feed(before, after, ["k"]), "k", "parent", "_change_type") == [
        (1, 10, "update_preimage"), (1, 11, "update_postimage"), (2, 20, "delete"), (4, 40, "insert")]
    assert M.change_feed(before, before, ["k"]).isEmpty()


FACT = "k int, key bigint, is_deleted_in_source boolean"


def test_publish_replaces_flags_and_keeps(make):
    target = make(FACT, (1, 5, False), (2, 5, False), (3, 5, False), (4, 5, True))
    stage = make(FACT, (1, 6, False), (4, 6, False), (9, -1, True))
    listed = make("k int", (1,), (2,), (4,), (9,), (2,))
    assert rows_of(M.publish_by_key(target, stage, listed, "k"), "k", "key", "is_deleted_in_source") == [
        (1, 6, False), (2, 5, True), (3, 5, False), (4, 6, False), (9, -1, True)]
    counts = M.publish_counts(target, stage, listed, "k", ["key"]).first().asDict()
    assert counts == {"active_before": 3, "inserted": 1, "updated": 2, "deleted": 1, "unknown": 1}


def test_guard_differs_for_facts_and_dimensions(make):
    def counts(active, deleted):
        return make("active_before bigint, deleted bigint", (active, deleted))

    M.mass_delete_guard(counts(100, 10), "fact")
    with pytest.raises(CheckFailed):
        M.mass_delete_guard(counts(100, 11), "fact")
    M.mass_delete_guard(counts(100, 11), "fact", allow=True)
    M.mass_delete_guard(counts(0, 1), "fact")
    with pytest.raises(CheckFailed):
        M.mass_delete_guard(counts(0, 1), "dim", need_active=False)


def test_touch_delete_restore(make):
    table = make("k int, _is_deleted_in_source boolean, _source_changed_at timestamp, _silver_run_id string",
                 (1, False, T0, "r"), (2, False, T0, "r"))
    keys = make("k int", (1,))
    assert rows_of(M.touch_rows(table, keys, "k", "t"), "k", "_silver_run_id") == [(1, "t"), (2, "r")]
    gone = M.flag_deleted(table, keys, "k", F.lit(T1))
    assert rows_of(gone, "k", "_is_deleted_in_source", "_source_changed_at") == [(1, True, T1), (2, False, T0)]
    assert rows_of(M.restore_flags(gone, table, keys, "k"), *table.columns) == rows_of(table, *table.columns)
