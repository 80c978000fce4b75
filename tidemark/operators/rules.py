"""Business rules as data: all rules over one frame are counted in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.profile import union_all


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str      # quarantine, fail or document
    broken: Column


def count_rules(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """(check_name, failures, severity): one aggregate over frame for all its rules."""
    wide = frame.agg(*[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(rules)])
    items = F.array(*[F.struct(F.lit(r.name).alias("check_name"), F.col(f"r{i}").alias("failures"),
                               F.lit(r.severity).alias("severity")) for i, r in enumerate(rules)])
    return wide.select(F.explode(items).alias("_i")).select("_i.*")


def cities_in_many_states(df: DataFrame) -> DataFrame:
    """Cities with more than one state, and how many."""
    return (df.groupBy("location_city").agg(F.countDistinct("location_state").alias("states"))
            .where(F.col("states") > 1))


def event_pairs(events: DataFrame) -> DataFrame:
    """Per load: its last pickup and delivery, its events and its kinds of event."""
    def last(kind: str) -> Column:
        return F.max(F.when(F.col("event_type") == kind, F.col("actual_datetime")))

    return events.groupBy("load_id").agg(
        last("Pickup").alias("picked"), last("Delivery").alias("delivered"),
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("event_type").alias("n_kinds"))


def rule_checks(t: dict[str, DataFrame]) -> DataFrame:
    """The nineteen checks of the source tables."""
    c = F.col
    trucks = t["trucks"].select("truck_id", "tank_capacity_gallons", "acquisition_mileage", "acquisition_date")
    drivers = t["drivers"].select("driver_id", "hire_date", "termination_date")
    booked = t["loads"].select("load_id", "load_date")
    # Trips counted per load first: a load with very many trips joins as one row.
    trips_per_load = t["trips"].groupBy("load_id").agg(F.count("trip_id").alias("n_trips"))
    day = c("incident_date").cast("date")
    parts = [
        count_rules(t["safety_incidents"], [
            Rule("claim = vehicle + cargo damage", "quarantine",
                 F.abs(c("claim_amount") - (c("vehicle_damage_cost") + c("cargo_damage_cost"))) > 0.01)]),
        count_rules(t["maintenance_records"].join(trucks, "truck_id", "left"), [
            Rule("maintenance total = labour + parts", "quarantine",
                 F.abs(c("total_cost") - (c("labor_cost") + c("parts_cost"))) > 0.01),
            Rule("service odometer below acquisition mileage", "quarantine",
                 c("odometer_reading") < c("acquisition_mileage")),
            Rule("maintenance before truck acquired", "quarantine",
                 c("maintenance_date") < c("acquisition_date"))]),
        count_rules(t["fuel_purchases"].join(trucks, "truck_id", "left"), [
            Rule("fuel cost = gallons x price", "quarantine",
                 F.abs(c("total_cost") - c("gallons") * c("price_per_gallon")) > 0.05),
            Rule("fuel purchase exceeds tank capacity", "quarantine",
                 c("gallons") > c("tank_capacity_gallons"))]),
        count_rules(t["trips"].join(booked, "load_id", "left"), [
            Rule("idle time exceeds trip duration", "quarantine",
                 c("idle_time_hours") > c("actual_duration_hours")),
            Rule("reported mpg disagrees with distance / gallons", "quarantine",
                 (c("fuel_gallons_used") > 0)
                 & (F.abs(c("average_mpg") - c("actual_distance_miles")
                          / F.nullif(c("fuel_gallons_used"), F.lit(0))) > 0.5)),
            Rule("trip dispatched before load booked", "quarantine", c("dispatch_date") < c("load_date"))]),
        count_rules(t["safety_incidents"].join(drivers, "driver_id"), [
            Rule("incident outside driver employment period", "quarantine",
                 (day < c("hire_date")) | (day > c("termination_date")))]),
        count_rules(t["drivers"], [
            Rule("driver terminated before hired", "fail", c("termination_date") < c("hire_date")),
            Rule("active driver has a termination date", "quarantine",
                 (c("employment_status") == "Active") & c("termination_date").isNotNull()),
            Rule("inactive driver has no termination date", "quarantine",
                 (c("employment_status") != "Active") & c("termination_date").isNull())]),
        *[count_rules(cities_in_many_states(t[name]), [
            Rule(f"{name}: city mapped to multiple states", "document", F.lit(True))])
          for name in ("safety_incidents", "fuel_purchases", "delivery_events")],
        count_rules(t["loads"].select("load_id").join(trips_per_load, "load_id", "left"), [
            Rule("load without exactly one trip", "fail", F.coalesce("n_trips", F.lit(0)) != 1)]),
        count_rules(event_pairs(t["delivery_events"]), [
            Rule("load without exactly one pickup and one delivery", "fail",
                 (c("n_kinds") != 2) | (c("n_events") != 2)),
            Rule("delivery recorded before its pickup", "fail", c("delivered") < c("picked"))]),
    ]
    return union_all(parts)
