import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows_of

from tidemark.functions.compare import CheckFailed
from tidemark.operators import reconcile as R

MONTH = dt.date(2024, 1, 1)
GOLD = ("driver_id string, month date, trips bigint, miles bigint, gallons decimal(18,2), idle decimal(18,6), "
        "revenue decimal(18,2), deliveries bigint, on_time bigint")
BASE = ("driver_id string, month date, trips_completed int, total_miles int, total_revenue decimal(14,2), "
        "average_mpg decimal(8,2), total_fuel_gallons decimal(12,2), on_time_delivery_rate decimal(6,4), "
        "average_idle_hours decimal(8,2)")


def D(x):
    return Decimal(x) if x is not None else None


def gold(make, miles=1000):
    return make(GOLD, ("a", MONTH, 3, miles, D("100"), D("2.25"), D("9.99"), 3, 2),
                ("b", MONTH, 1, 10, D("0"), None, None, None, None))


def base(make):
    return make(BASE, ("a", MONTH, 3, 1000, D("9.99"), D("10"), D("100"), D("0.667"), D("2.3")),
                ("b", MONTH, 1, 10, None, None, D("0"), None, None))


def test_all_match_with_null_equal_to_null(make):
    got = R.verdicts(R.metric_pairs(gold(make), base(make), "driver_monthly_metrics"))
    status = dict(rows_of(got, "metric_name", "status"))
    assert status == {"trips_completed": "pass", "total_miles": "pass", "total_revenue": "pass", "total_fuel_gallons": "pass",
                      "average_mpg": "match", "average_idle_hours": "match", "on_time_delivery_rate": "match",
                      "utilization_rate": "definition-unknown"}
    R.raise_on_failure(got)


def test_one_mile_more_fails_only_miles(make):
    got = R.verdicts(R.metric_pairs(gold(make, 1001), base(make), "driver_monthly_metrics"))
    status = dict(rows_of(got, "metric_name", "status"))
    assert (status["total_miles"], status["average_mpg"], status["trips_completed"]) == ("fail", "definition-unknown", "pass")
    row = got.where("metric_name = 'total_miles'").first()
    assert (row["rows_compared"], row["rows_matched"], row["max_abs_difference"]) == (2, 1, 1)
    with pytest.raises(CheckFailed, match="total_miles"):
        R.raise_on_failure(got)


def test_rows_on_one_side_only(make):
    got = R.verdicts(R.metric_pairs(gold(make), base(make).where("driver_id = 'a'"), "driver_monthly_metrics"))
    row = got.where("metric_name = 'trips_completed'").first()
    assert (row["gold_only"], row["baseline_only"], row["status"]) == (1, 0, "fail")
