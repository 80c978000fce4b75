"""Segmented windows against brute force, with one key holding most rows."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators.segments import first_per_key, latest_per_key, numbered, ranged, segmented, spanning


def case(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else rng.choice("abc")
        rows.append((key, i, rng.choice([None, 1, 2, 3])))
    rng.shuffle(rows)
    return rows


def brute(rows):
    out, state = [], {}
    for key, t, v in sorted(rows, key=lambda r: r[1]):
        before, seen, last, total, any_value = state.get(key, (None, False, None, 0, False))
        last = v if v is not None else last
        any_value = any_value or v is not None
        total = total + (v or 0)
        out.append((key, t, v, before if seen else None, last, total if any_value else None))
        state[key] = (v, True, last, total, any_value)
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def sizes(rows, *by):
    return {tuple(r)[:-1]: r["count"] for r in rows.groupBy(*by).count().collect()}


@pytest.fixture
def many(spark):
    """As many range partitions as asked for: small ones are not joined again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_matches_brute_force_across_partitions(spark, make, many):
    for seed in range(4):
        rows = case(seed)
        df = make("k string, t int, v int", *rows)
        assert rows_of(spanning(ranged(df, ["k"], ["t"]), ["k"]), "k")[-1] == ("hot",)
        got = segmented(df, ["k"], ["t"], lag={"p": F.col("v")}, last={"l": F.col("v")}, running={"s": F.col("v")})
        assert rows_of(got, "k", "t", "v", "p", "l", "s") == brute(rows)


def test_matches_brute_force_in_one_partition(make):
    rows = case(9, 50)
    got = segmented(make("k string, t int, v int", *rows), ["k"], ["t"], lag={"p": F.col("v")}, last={"l": F.col("v")}, running={"s": F.col("v")})
    assert rows_of(got, "k", "t", "v", "p", "l", "s") == brute(rows)


def test_bursts_and_far_off_values_leave_equal_pieces(spark, many):
    """100,000 rows within an hour and one in the year 9999; 90,000 rows of one order value, told apart by the tie."""
    hour = spark.range(100_000).select(F.lit("k").alias("k"), F.col("id").alias("tie"), F.when(F.col("id") == 7, F.lit(253_370_764_800)).otherwise(F.col("id") % 3600).alias("t"))
    equal = spark.range(90_000).select(F.lit("k").alias("k"), F.lit(5).cast("bigint").alias("t"), F.col("id").alias("tie"))
    for df in (hour, equal):
        parts = sizes(ranged(df, ["k"], ["t", "tie"]), "_part")
        assert len(parts) == 7 and max(parts.values()) <= 2 * min(parts.values())
        got = segmented(df, ["k"], ["t", "tie"], running={"n": F.lit(1)})
        assert got.agg(F.max("n"), F.countDistinct("n")).first()[:] == (df.count(), df.count())


def test_null_value_is_not_a_missing_row(make, many):
    df = make("k string, t int, v int", ("a", 1, 5), ("a", 20, None), ("a", 40, 7))
    got = segmented(df, ["k"], ["t"], lag={"p": F.col("v")})
    assert rows_of(got, "t", "p") == [(1, None), (20, 5), (40, None)]


def test_no_window_sorts_a_whole_key_and_scans_are_few(make):
    """Every window over raw rows is partitioned by partition and key; the rows are read for themselves, for borders and for states."""
    df = make("k string, t int, v int", *case(1))
    plan = segmented(df, ["k"], ["t"], lag={"p": F.col("v")})._jdf.queryExecution()
    windows = [line for line in plan.toString().splitlines() if "Window [" in line and "_v_p" in line]
    assert windows and all("_part" in w for w in windows)
    assert plan.executedPlan().toString().split("== Initial Plan ==")[-1].count("FileScan") <= 3


def test_empty_input(make, many):
    df = make("k string, t int, v int", ("a", 1, 5)).where("false")
    assert segmented(df, ["k"], ["t"], lag={"p": F.col("v")}, running={"s": F.col("v")}).isEmpty()


def test_latest_and_first(spark, make):
    df = make("k string, t int, v string", ("a", 1, "x"), ("a", 3, None), ("a", 2, "z"), ("b", 5, "q"))
    assert rows_of(latest_per_key(df, ["k"], [F.col("t")]), "k", "t", "v") == [("a", 3, None), ("b", 5, "q")]
    assert rows_of(first_per_key(df, ["k"], [F.col("t")]), "k", "t", "v") == [("a", 1, "x"), ("b", 5, "q")]


def test_numbers_are_dense_unique_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "member")
    first = rows_of(numbered(df, ["member"], "key", 10), "member", "key")
    again = rows_of(numbered(df.repartition(7), ["member"], "key", 10), "member", "key")
    assert sorted(k for _, k in first) == list(range(11, 5011))
    assert first == again
