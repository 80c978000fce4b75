import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed
from tidemark.operators import dims as D

FIRST = 20220101


def test_dim_date_rules(spark):
    d = dt.date
    dim = D.dim_date(spark, d(2023, 1, 1), d(2024, 12, 31), d(2024, 6, 29))
    assert dim.count() == 731 + 3
    assert D.calendar_problems(D.dim_calendar(dim)).first().asDict() == {
        "missing_days": 0, "repeated_days": 0, "wrong_keys": 0}
    june = dim.where("year_month_number = 202406").select("is_complete_month", "year_month_label").distinct().collect()
    assert [tuple(r) for r in june] == [(False, "Jun 2024")]
    assert rows_of(dim.where("date_key <= 0"), "date_key", "month_name") == [
        (-1, "Unknown"), (-2, "Not Applicable"), (0, "Missing")]
    for bad in ((d(2023, 1, 2), d(2024, 12, 31), d(2024, 1, 1)), (d(2023, 1, 1), d(2024, 12, 30), d(2024, 1, 1)),
                (d(1950, 1, 1), d(2024, 12, 31), d(2024, 1, 1)), (d(2023, 1, 1), d(2024, 12, 31), d(2025, 1, 1))):
        with pytest.raises(CheckFailed):
            D.dim_date(spark, *bad)


SRC = "id int, name string, home string, end date, is_deleted_in_source boolean, source_changed_date_key int"


def load(dim, source):
    return D.scd2_apply(dim, source, "id", "key", ["name"], ["home", "end"], FIRST, label="label",
                        label_of=("name", "home"))


def test_type_two(spark, make):
    first = load(None, make(SRC, (1, "A", "X", None, False, FIRST), (2, "B", "X", None, False, FIRST),
                            (3, "C", "X", None, False, FIRST), (4, "D", "X", None, False, FIRST))).cache()
    assert rows_of(first.where("key <= 0"), "key") == [(-1,), (-2,), (0,)]
    second = load(first, make(SRC, (1, "A2", "Y", None, False, 20230501), (2, "B", "Z", None, False, FIRST),
                              (4, "D", "X", None, True, 20230601), (5, "E", "X", None, False, 20230101))).cache()
    got = rows_of(second.where("key > 0"), "id", "name", "home", "valid_from_date_key", "valid_to_date_key", "is_current",
                  "is_deleted", "version_reason")
    assert got == [
        (1, "A2", "X", FIRST, 20230501, False, False, "Initial version"),
        (1, "A2", "Y", 20230501, 99991231, True, False, "Changed: home"),
        (2, "B", "Z", FIRST, 99991231, True, False, "Initial version"),
        (3, "C", "X", FIRST, 99991231, True, True, "Initial version"),
        (4, "D", "X", FIRST, 99991231, True, True, "Initial version"),
        (5, "E", "X", FIRST, 99991231, True, False, "Initial version")]
    keys = [r[0] for r in rows_of(second, "key")]
    assert len(keys) == len(set(keys)) == 9
    assert max(keys) > first.agg(F.max("key")).first()[0]  # never reused
    assert ("1 A2 (Y)",) in rows_of(second, "label") and ("1 A2 (X)",) in rows_of(second, "label")
    late = make(SRC, (1, "A2", "Q", None, False, 20230101))
    assert rows_of(D.backdated(second, late, "id", "key", ["home", "end"]), "id") == [(1,)]
    with pytest.raises(CheckFailed):
        D.assert_not_backdated(second, late, "id", "key", ["home", "end"])


def test_type_one_never_deletes_rows(spark, make):
    src = "id int, name string, is_deleted_in_source boolean"
    first = D.scd1_upsert(None, make(src, (1, "A", False), (2, "B", False)), "id", "key", ["name"], FIRST)
    second = D.scd1_upsert(first, make(src, (1, None, False), (3, "C", True)), "id", "key", ["name"], FIRST)
    assert rows_of(second.where("key > 0"), "id", "name", "is_deleted") == [
        (1, None, False), (2, "B", True), (3, "C", True)]
    with pytest.raises(CheckFailed):
        D.check_source(make(src, (1, "A", False), (1, "B", False)), "id")
    with pytest.raises(CheckFailed):
        D.check_source(make(src, (1, "A", None)), "id")
    counts = D.deletion_counts(first, make(src, (1, "A", False)), "id", "key").first()
    assert (counts["active_before"], counts["deleted"]) == (2, 1)


def test_partial_special_members_are_an_error(make):
    dim = make("key bigint, name string", (0, "Missing"), (5, "x"))
    with pytest.raises(CheckFailed):
        D.with_special_members(dim, "key")
    assert D.with_special_members(dim.where("key > 0"), "key").count() == 4


def test_versions_from_history(make):
    df = make("id int, day int, v string", (1, 20240101, "a"), (1, 20240105, "a"), (1, 20240120, "b"), (1, 20240125, "a"),
              (2, 20240103, None), (2, 20240115, "x"))
    got = D.scd2_from_history(df, "id", ["v"], "day")
    assert rows_of(got, "id", "v", "valid_from_date_key", "valid_to_date_key", "is_current") == [
        (1, "a", 20240101, 20240120, False), (1, "a", 20240125, 99991231, True), (1, "b", 20240120, 20240125, False),
        (2, "x", 20240115, 99991231, True), (2, None, 20240103, 20240115, False)]


def test_junk_is_insert_only(make):
    one = D.junk_dim(None, make("a string, b string", ("x", "y"), ("x", "y"), ("x", "z")), ["a", "b"], "key").cache()
    two = D.junk_dim(one, make("a string, b string", ("x", "z"), ("q", "z")), ["a", "b"], "key")
    before = {r[1:]: r[0] for r in rows_of(one, "key", "a", "b")}
    after = {r[1:]: r[0] for r in rows_of(two, "key", "a", "b")}
    assert {k: after[k] for k in before} == before and after[("q", "z")] == 3


def test_city_map_needs_agreement(make):
    s = "city string, state string, source_rank int"
    got = D.city_state_map(make(s, ("A", "TX", 1), ("B", "TX", 1)), make(s, ("A", "TX", 2), ("B", "CA", 2), ("C", "CA", 3)),
                           make(s, ("D", None, 3), (None, "TX", 3)))
    assert rows_of(got, "location_city", "location_state_code", "state_rank") == [("A", "TX", 1), ("C", "CA", 3)]


def test_state_reference():
    assert len(D.US_STATES) == 51


def test_as_of_by_scan_equals_the_range_join(make):
    import random

    from tidemark.operators.lookups import as_of, as_of_scan

    rng = random.Random(2)
    dim, n = [], 0
    for i in [*range(6), None]:
        at = rng.randrange(5)
        while at < 60:
            n, until = n + 1, at + rng.randrange(1, 9)
            dim.append((i, n, at, until, f"why{n}"))
            at = until + rng.choice([0, 0, 3])
    dim = make("id int, key bigint, valid_from_date_key int, valid_to_date_key int, reason string", *dim, (0, -1, 0, 99, "no"))
    facts = make("f int, ref int, day int", *[(i, rng.choice([*range(8), None]), rng.choice([*range(70), None])) for i in range(400)])
    joined = as_of(facts, dim, "id", "key", "day", "hit", reference="ref").join(dim.select(F.col("key").alias("hit"), "reason"), "hit", "left")
    scanned = as_of_scan(facts, dim, "id", "key", "day", "hit", reference="ref", carry=["reason"])
    assert rows_of(scanned, "f", "ref", "day", "hit", "reason") == rows_of(joined, "f", "ref", "day", "hit", "reason")


def test_an_id_with_100000_versions_and_facts(spark):
    from tidemark.operators.lookups import as_of_scan

    n = 100_000
    dim = spark.range(n).select(F.lit(1).alias("id"), (F.col("id") + 1).alias("key"), F.col("id").cast("int").alias("valid_from_date_key"), (F.col("id") + 1).cast("int").alias("valid_to_date_key"))
    facts = spark.range(n).select(F.col("id").alias("f"), F.lit(1).alias("ref"), F.col("id").cast("int").alias("day"))
    got = as_of_scan(facts, dim, "id", "key", "day", "hit", reference="ref")
    assert got.where("hit = f + 1").count() == n
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
