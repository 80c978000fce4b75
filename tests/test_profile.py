import random

import numpy as np
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import checks as K
from tidemark.operators import profile as P
from tidemark.operators import rules as R


def skewed(make, seed=3, n=3000):
    rng = random.Random(seed)
    values = [7.0 if rng.random() < 0.4 else rng.choice([rng.gauss(0, 1), rng.expovariate(0.001), -5.0]) for _ in range(n)]
    return values, make("x double, y double", *[(v, float(i % 10) if i % 7 else None) for i, v in enumerate(values)])


def test_exact_quantiles_with_a_heavy_value(make):
    values, df = skewed(make)
    got = {r["column"]: r["q"] for r in P.exact_quantiles(df, ["x", "y"], [0, 0.1, 0.25, 0.5, 0.9, 1]).collect()}
    assert np.allclose(got["x"], np.quantile(values, [0, 0.1, 0.25, 0.5, 0.9, 1]))
    ys = [float(i % 10) for i in range(len(values)) if i % 7]
    assert np.allclose(got["y"], np.quantile(ys, [0, 0.1, 0.25, 0.5, 0.9, 1]))


def test_exact_quantiles_whatever_the_sketches_say(make, monkeypatch):
    values, df = skewed(make, n=800)
    monkeypatch.setattr(P, "approximate_quantiles", lambda df, columns, around, error: make("column string, q array<double>", *[(c, [5000.0] * len(around)) for c in columns]))
    got = {r["column"]: r["q"] for r in P.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()}
    assert np.allclose(got["x"], np.quantile(values, [0.25, 0.5, 0.75]))


def test_exact_quantiles_of_odd_columns(make):
    df = make("a double, b double, c int, d double", (float("nan"), None, 1, 5.0), (1.0, None, None, float("inf")), (2.0, None, 3, -1.0), (float("nan"), None, 7, 0.0))
    got = {r["column"]: r["q"] for r in P.exact_quantiles(df, ["a", "b", "c", "d"], [0.25, 0.5, 1]).collect()}
    assert "b" not in got and got["c"] == [2, 3, 7] and got["d"][1] == 2.5 and got["d"][2] == float("inf")
    assert got["a"][0] == 1.75 and np.isnan(got["a"][2])


def test_rank_errors_count_ranks(make):
    df = make("x double", *[(float(i),) for i in range(101)])
    given = make("column string, q array<double>", ("x", [25.0, 60.0]))
    assert rows_of(P.rank_errors(df, given, ["x"], [0.25, 0.5]), "probability", "rank_error") == [(0.25, 0.0), (0.5, 10 / 101)]


def test_approximate_quantiles_are_within_their_error(make):
    values, df = skewed(make)
    got = P.approximate_quantiles(df, ["x"], [0.25, 0.5, 0.75], 0.01).first()["q"]
    for p, v in zip((0.25, 0.5, 0.75), got):
        below, upto = np.mean(np.array(values) < v), np.mean(np.array(values) <= v)
        assert below - 0.02 <= p <= upto + 0.02


def test_outliers_against_numpy(make):
    values, df = skewed(make)
    x = np.array(values)
    q1, q3 = np.quantile(x, [0.25, 0.75])
    r = P.profile_outliers(df, ["x"]).first()
    assert r["iqr_outliers"] == int(((x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1))).sum())
    assert r["z3_outliers"] == int((abs(x - x.mean()) > 3 * x.std(ddof=1)).sum())


def test_columns_and_categories(make):
    t = make("a string, b int, flag boolean", ("x", 1, True), ("x", None, None), ("y", 3, False))
    ids = make("id int, c string", *[(i, f"v{i % 40}") for i in range(500)])
    empty = t.where("false")
    got = P.profile_columns({"t": t, "ids": ids, "empty": empty}, limit=100)
    assert rows_of(got, "table", "column", "nulls", "distinct", "many") == sorted([
        ("t", "a", 0, 2, False), ("t", "b", 1, 2, False), ("t", "flag", 1, 2, False), ("ids", "id", 0, None, True), ("ids", "c", 0, 40, False),
        *[("empty", c, 0, 0, False) for c in ("a", "b", "flag")]], key=lambda x: tuple((v is None, str(v)) for v in x))
    assert rows_of(P.profile_categoricals({"t": t, "ids": ids}, exclude=["a"]), "table", "column", "value", "n") == [
        ("t", "flag", "false", 1), ("t", "flag", "true", 1), ("t", "flag", None, 1)]
    assert P.profile_categoricals({"ids": ids}).isEmpty()


def test_mapped_columns_are_those_of_the_tables(spark):
    from tidemark.plans.trucking import COLUMNS, columns, source

    names = {"bigint": "long", "int": "int", "string": "text", "boolean": "flag", "date": "date", "timestamp": "ts"}
    for table in COLUMNS:
        kinds = source(spark, "/root/testdata/sf0.001", table).dtypes
        assert [c for c, _ in kinds] == columns(table)
        assert all(c in columns(table, names.get(kind, "decimal")) for c, kind in kinds)


def test_tables_and_duplicates(make):
    df = make("k int, v string", (1, "x"), (1, "y"), (None, "x"), (3, "x"))
    assert P.profile_table(df, "t", "k").first().asDict() == {
        "table": "t", "rows": 4, "distinct_keys": 3, "duplicate_keys": 1, "null_keys": 1, "columns": 2, "batches": 1}
    assert P.duplicate_content(df, "k").first()[0] == 2


def test_references(make):
    child = make("p int, q string", (1, "a"), (1, None), (9, "z"), (None, "z"))
    tables = {"c": child, "P": make("k int", (1,), (1,), (2,)), "Q": make("k string", ("a",))}
    got = P.reference_checks(tables, {"c": "p", "P": "k", "Q": "k"}, [("c", "p", "P"), ("c", "q", "Q")])
    assert rows_of(got, "child", "column", "parent", "rows", "nulls", "orphans", "orphan_pct") == [
        ("c", "p", "P", 4, 1, 1, 25.0), ("c", "q", "Q", 4, 1, 2, 50.0)]


def test_references_read_each_table_once(spark):
    from tidemark.plans.contract import FOREIGN_KEYS, TABLES, key_of
    from tidemark.plans.trucking import source

    tables = {t: source(spark, "/root/testdata/sf0.001", t) for t in TABLES}
    one_each = sum(df._jdf.queryExecution().executedPlan().toString().count("FileScan") for df in tables.values())
    plan = P.reference_checks(tables, {t: key_of(t) for t in tables}, FOREIGN_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("FileScan") <= one_each


def test_rules_share_a_pass(make):
    df = make("x int", (1,), (5,), (None,))
    got = R.count_rules(df, [R.Rule("small", "fail", F.col("x") < 3), R.Rule("big", "document", F.col("x") > 4)])
    assert rows_of(got, "check_name", "failures", "severity") == [("big", 1, "document"), ("small", 1, "fail")]


def test_two_way_difference_treats_null_as_equal(make):
    a = make("x int, y string", (1, None), (2, "b"), (2, "b"))
    b = make("x int, y string", (1, None), (3, "c"))
    assert K.two_way_difference(a, b).first().asDict() == {"left_only": 1, "right_only": 1}


def test_dates_and_continuity(make):
    df = make("d string", ("2024-01-01",), ("2024-01-01",), ("2024-01-04",), (None,)).select(F.col("d").cast("date"))
    r = P.continuity(df, "d").first()
    assert (r["span_days"], r["days_present"], r["days_missing"], r["max_per_day"]) == (4, 2, 2, 2)
    r = P.profile_dates(df, ["d"], F.lit("2024-01-02").cast("date")).first()
    assert (r["distinct_dates"], r["future_dated"], r["nulls"], r["rows_per_date"]) == (2, 1, 1, 2.0)
