"""Rebuilding published monthly figures from the star and judging the agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.compare import CheckFailed, decimal_ratio
from tidemark.functions.dates import key_month

Tables = dict[str, DataFrame]


def _live(fact: DataFrame) -> DataFrame:
    return fact.where(~F.col("is_deleted_in_source"))


def _ids(dim: DataFrame, key: str, id_column: str, column: str) -> DataFrame:
    return dim.where(F.col(key) > 0).select(F.col(key).alias(column), id_column)


def month_trips(facts: Tables, dims: Tables) -> DataFrame:
    """Live, dated trips with the business ids of their driver and truck."""
    return (
        _live(facts["trip"]).where(F.col("dispatch_date_key") > 0)
        .join(_ids(dims["driver"], "driver_key", "driver_id", "driver_key"), "driver_key", "left")
        .join(_ids(dims["truck"], "truck_key", "truck_id", "truck_key"), "truck_key", "left")
        .select("trip_id", "driver_id", "truck_id", key_month("dispatch_date_key").alias("month"),
                "actual_distance_miles", "fuel_gallons_used", "idle_time_hours"))


def _revenue(facts: Tables, dim: DataFrame, name: str) -> DataFrame:
    key, ident = f"{name}_key", f"{name}_id"
    column = f"fulfilling_{name}_key"
    return (
        _live(facts["load_lifecycle"]).where((F.col(column) > 0) & (F.col("dispatched_date_key") > 0))
        .join(_ids(dim, key, ident, column), column)
        .groupBy(ident, key_month("dispatched_date_key").alias("month")).agg(F.sum("revenue").alias("revenue")))


def driver_months(facts: Tables, dims: Tables) -> DataFrame:
    """Gold figures per (driver_id, month)."""
    trips = month_trips(facts, dims).where(F.col("driver_id").isNotNull())
    work = trips.groupBy("driver_id", "month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum(F.col("actual_distance_miles").cast("bigint")).alias("miles"),
        F.sum("fuel_gallons_used").alias("gallons"),
        F.avg(F.col("idle_time_hours").cast("decimal(18,6)")).alias("idle"))
    deliveries = dims["delivery_status"].where(
        (F.col("delivery_status_key") > 0) & (F.col("event_type") == "Delivery")
    ).select("delivery_status_key", (F.col("arrival_status") == "On Time").alias("_on_time"))
    punctual = (
        _live(facts["delivery_event"]).join(deliveries, "delivery_status_key").select("trip_id", "_on_time")
        .join(trips.select("trip_id", "driver_id", "month"), "trip_id")
        .groupBy("driver_id", "month").agg(F.count(F.lit(1)).alias("deliveries"),
                                           F.count_if("_on_time").alias("on_time")))
    keys = ["driver_id", "month"]
    return (work.join(_revenue(facts, dims["driver"], "driver"), keys, "left").join(punctual, keys, "left"))


def truck_months(facts: Tables, dims: Tables) -> DataFrame:
    """Gold figures per (truck_id, month); maintenance is 0 where there was none."""
    trips = month_trips(facts, dims).where(F.col("truck_id").isNotNull())
    work = trips.groupBy("truck_id", "month").agg(
        F.count(F.lit(1)).alias("trips"), F.sum(F.col("actual_distance_miles").cast("bigint")).alias("miles"),
        F.sum("fuel_gallons_used").alias("gallons"))
    upkeep = (
        _live(facts["maintenance"]).where((F.col("truck_key") > 0) & (F.col("maintenance_date_key") > 0))
        .join(_ids(dims["truck"], "truck_key", "truck_id", "truck_key"), "truck_key")
        .groupBy("truck_id", key_month("maintenance_date_key").alias("month"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("labor_cost") + F.col("parts_cost")).alias("cost"),
             F.sum("downtime_hours").alias("downtime")))
    keys = ["truck_id", "month"]
    joined = work.join(_revenue(facts, dims["truck"], "truck"), keys, "left").join(upkeep, keys, "left")
    zero = F.lit(0)
    return joined.withColumns({c: F.coalesce(c, zero) for c in ("events", "cost", "downtime")})


#: metric -> (verified, gold expression, decimals of the published figure)
def _driver_metrics() -> dict[str, tuple[bool, Column]]:
    c = F.col
    mpg = decimal_ratio(c("g.miles").cast("decimal(18,6)"), c("g.gallons"))
    rate = decimal_ratio(c("g.on_time").cast("decimal(18,6)"), c("g.deliveries"))
    return {
        "trips_completed": (True, c("g.trips")),
        "total_miles": (True, c("g.miles")),
        "total_revenue": (True, F.round(c("g.revenue"), 2)),
        "total_fuel_gallons": (True, F.round(c("g.gallons"), 2)),
        "average_mpg": (False, F.round(mpg, 2)),
        "average_idle_hours": (False, F.round(c("g.idle"), 1)),
        "on_time_delivery_rate": (False, F.round(rate, 3)),
    }


def _truck_metrics() -> dict[str, tuple[bool, Column]]:
    c = F.col
    mpg = decimal_ratio(c("g.miles").cast("decimal(18,6)"), c("g.gallons"))
    return {
        "trips_completed": (True, c("g.trips")),
        "total_miles": (True, c("g.miles")),
        "total_revenue": (True, F.round(c("g.revenue"), 2)),
        "average_mpg": (False, F.round(mpg, 2)),
        "maintenance_events": (True, c("g.events")),
        "maintenance_cost": (True, F.round(c("g.cost"), 2)),
        "downtime_hours": (True, F.round(c("g.downtime"), 2)),
    }


METRICS = {"driver_monthly_metrics": ("driver_id", _driver_metrics),
           "truck_utilization_metrics": ("truck_id", _truck_metrics)}


def metric_pairs(gold: DataFrame, baseline: DataFrame, name: str) -> DataFrame:
    """One row per resource-month and metric: both values, the gold one at the published scale.

    Both sides hold one row per (id, month), so the full outer join is free of skew.
    """
    ident, metrics = METRICS[name][0], METRICS[name][1]()
    g = gold.select(ident, "month", F.struct("*").alias("g"))
    b = baseline.select(ident, "month", F.struct("*").alias("b"))
    both = g.join(b, [ident, "month"], "full_outer")
    value = "decimal(18,4)"
    items = F.array(*[F.struct(
        F.lit(metric).alias("metric_name"), F.lit(verified).alias("is_verified"),
        F.col(f"b.{metric}").cast(value).alias("baseline_value"), expr.cast(value).alias("gold_value"))
        for metric, (verified, expr) in metrics.items()])
    return both.select(
        F.lit(name).alias("baseline_name"), F.col(ident).cast("string").alias("resource_id"), "month",
        F.col("b").isNotNull().alias("in_baseline"), F.col("g").isNotNull().alias("in_gold"),
        F.explode(items).alias("_i")).select("baseline_name", "resource_id", "month", "in_baseline", "in_gold",
                                             "_i.*")


def verdicts(pairs: DataFrame) -> DataFrame:
    """Per metric: rows compared, matched, one-sided, greatest difference and status.

    A verified metric passes or fails. An unverified one matches, mismatches, or, for
    average_mpg, is definition-unknown. NULL equals NULL.
    """
    both = F.col("in_baseline") & F.col("in_gold")
    same = F.col("baseline_value").eqNullSafe(F.col("gold_value"))
    judged = pairs.groupBy("baseline_name", "metric_name", "is_verified").agg(
        F.count_if(both).alias("rows_compared"), F.count_if(both & same).alias("rows_matched"),
        F.count_if(~F.col("in_gold")).alias("baseline_only"),
        F.count_if(~F.col("in_baseline")).alias("gold_only"),
        F.max(F.when(both, F.abs(F.col("baseline_value") - F.col("gold_value")))).alias("max_abs_difference"))
    clean = ((F.col("rows_compared") == F.col("rows_matched")) & (F.col("baseline_only") == 0)
             & (F.col("gold_only") == 0))
    verified = F.col("is_verified")
    status = (F.when(clean & verified, "pass").when(clean, "match").when(verified, "fail")
              .when(F.col("metric_name") == "average_mpg", "definition-unknown").otherwise("mismatch"))
    judged = judged.withColumn("status", status)
    spark = pairs.sparkSession
    undefined = spark.createDataFrame(
        [("truck_utilization_metrics", "utilization_rate", False, None, None, None, None, None,
          "definition-unknown")],
        T.StructType([T.StructField(f.name, f.dataType) for f in judged.schema.fields]))
    return judged.unionByName(undefined)


def raise_on_failure(results: DataFrame) -> None:
    """Raise after recording, naming the failed metrics (at most the fixed metric list)."""
    failed = results.where(F.col("status") == "fail").select("baseline_name", "metric_name").collect()
    if failed:
        raise CheckFailed("verified metrics differ: " + ", ".join(sorted(f"{b}.{m}" for b, m in failed)))


def reproducibility(trips: DataFrame, baseline: DataFrame, resource: str) -> DataFrame:
    """Trips and miles per resource-month against the published ones, both directions."""
    ours = trips.where(F.col(resource).isNotNull() & F.col("dispatch_date").isNotNull()).groupBy(
        F.col(resource).alias("resource_id"), F.trunc("dispatch_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("actual_distance_miles").alias("miles"))
    theirs = baseline.select(F.col(resource).alias("resource_id"), "month",
                             F.col("trips_completed").alias("b_trips"), F.col("total_miles").alias("b_miles"))
    both = ours.join(theirs, ["resource_id", "month"], "full_outer")
    return both.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(F.col("trips") == F.col("b_trips")).alias("trips_match"),
        F.count_if(F.col("miles") == F.col("b_miles")).alias("miles_match"),
        F.count_if(F.col("trips").isNull()).alias("baseline_only"),
        F.count_if(F.col("b_trips").isNull()).alias("ours_only"),
        F.max(F.abs(F.col("miles") - F.col("b_miles"))).alias("max_miles_gap"))
