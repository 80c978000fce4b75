"""Fact rows with resolved surrogate keys, from current-state tables and dimensions.

Each builder takes the keys to (re)build, or None for all, the current-state tables and
the dimensions, and returns the staged fact rows. Joins are on business ids; hot ids are
left to the adaptive skew join. `only` names the columns wanted: lookups that none of them
needs are left out, and so are the tables and dimensions they would read. Rows are written before a further join that shuffles
them (`Steps`), so that disk doesn't hold the shuffles of all lookups at once.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed
from tidemark.functions.dates import date_key, hours_between
from tidemark.operators.lookups import NOT_APPLICABLE, as_of, by_columns, date_role, key_or_special, special_date
from tidemark.operators.segments import latest_per_key
from tidemark.operators.transforms import incident_attributes, recorded
from tidemark.session import Steps

Tables = dict[str, DataFrame]


def _listed(rows: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    return rows if keys is None else rows.join(keys.select(key).distinct(), key, "left_semi")


def _needs(only: Collection[str] | None) -> Callable[..., bool]:
    """Whether any of the named columns is wanted."""
    return lambda *names: only is None or any(n in only for n in names)


def _picked(rows: DataFrame, only: Collection[str] | None, *columns: tuple[str, Column] | str) -> DataFrame:
    """The wanted ones of named columns, in order; a plain name is a column of rows, a pair a name with its value."""
    named = [(c, F.col(c)) if isinstance(c, str) else c for c in columns]
    return rows.select(*[value.alias(name) for name, value in named if only is None or name in only])


def _carried(rows: DataFrame, only: Collection[str] | None, lookups: dict[str, tuple[str, ...]], *columns: str) -> DataFrame:
    """The columns of rows that a fact is made of: those its lookups need (by the key they give), and the wanted ones of the others."""
    need = _needs(only)
    kept = [c for key, used in lookups.items() if need(key) for c in used]
    kept += [c for c in columns if need(c, c.removeprefix("_"))]
    return rows.select(*[c for c in rows.columns if c in kept])


def route_of_load(rows: DataFrame, silver: Tables) -> DataFrame:
    """Add route_id and load_found through load_id, where rows don't bring them; a deleted load still gives its route."""
    if "load_found" in rows.columns:
        return rows
    loads = silver["loads"]
    parents = loads.select("load_id", "route_id", F.lit(True).alias("load_found"))
    return rows.join(parents, "load_id", "left")


def _route_key(hit: str = "_route", *earlier: tuple[Column, Column]) -> Column:
    """Missing or Unknown at the first broken hop, else the route's own key.

    earlier: (reference, found) of each hop before the route, in order.
    """
    key = key_or_special(F.col("route_id"), F.col(hit))
    for reference, found in reversed(earlier):
        key = F.when(reference.isNull(), F.lit(0)).when(found.isNull(), F.lit(-1)).otherwise(key)
    return key


def fact_trip(keys: DataFrame | None, silver: Tables, dims: Tables, only: Collection[str] | None = None) -> DataFrame:
    need = _needs(only)
    rows = _carried(
        _listed(silver["trips"], keys, "trip_id").withColumn("_day", date_key("dispatch_date")), only,
        {"dispatch_date_key": ("dispatch_date", "_day"), "route_key": ("load_id", "_day"), "driver_key": ("driver_id", "_day"),
         "truck_key": ("truck_id", "_day"), "trailer_key": ("trailer_id", "_day")},
        "trip_id", "load_id", "actual_distance_miles", "actual_duration_hours", "fuel_gallons_used", "idle_time_hours",
        "is_idle_implausible", "_is_deleted_in_source")
    steps = Steps()
    if need("route_key"):
        rows = as_of(route_of_load(rows, silver), dims["route"], "route_id", "route_key", "_day", "_route")
    if need("dispatch_date_key"):
        rows = date_role(rows, dims["date"], "_day", "_date")
    for dim in ("driver", "truck", "trailer"):
        if need(f"{dim}_key"):
            rows = as_of(steps.before(rows, dims[dim]), dims[dim], f"{dim}_id", f"{dim}_key", "_day", f"_{dim}")
    return _picked(
        rows, only,
        ("dispatch_date_key", special_date(F.col("dispatch_date"), F.col("_date"))),
        ("driver_key", key_or_special(F.col("driver_id"), F.col("_driver"))),
        ("truck_key", key_or_special(F.col("truck_id"), F.col("_truck"))),
        ("trailer_key", key_or_special(F.col("trailer_id"), F.col("_trailer"))),
        ("route_key", _route_key("_route", (F.col("load_id"), F.col("load_found")))),
        "trip_id", "load_id", "actual_distance_miles", "actual_duration_hours", "fuel_gallons_used",
        "idle_time_hours", "is_idle_implausible", ("is_deleted_in_source", F.col("_is_deleted_in_source")))


def fact_delivery_event(keys: DataFrame | None, silver: Tables, dims: Tables, only: Collection[str] | None = None) -> DataFrame:
    need = _needs(only)
    rows = _listed(silver["delivery_events"], keys, "event_id")
    if need("facility_key", "route_key"):
        rows = rows.withColumn("_day", date_key(F.coalesce("actual_datetime", "scheduled_datetime")))
    if need("route_key"):
        rows = as_of(route_of_load(rows, silver), dims["route"], "route_id", "route_key", "_day", "_route")
    for role in ("scheduled", "actual"):
        if need(f"{role}_date_key"):
            rows = date_role(rows.withColumn(f"_{role}", date_key(f"{role}_datetime")), dims["date"], f"_{role}", f"_{role}_hit")
    if need("facility_key"):
        rows = as_of(rows, dims["facility"], "facility_id", "facility_key", "_day", "_facility")
    if need("delivery_status_key"):
        rows = rows.withColumns({"event_type": recorded("event_type"), "arrival_status": recorded("arrival_status")})
        rows = by_columns(rows, dims["delivery_status"], ["event_type", "arrival_status"], "delivery_status_key",
                          "_status")
    return _picked(
        rows, only,
        ("scheduled_date_key", special_date(F.col("scheduled_datetime"), F.col("_scheduled_hit"))),
        ("actual_date_key", special_date(F.col("actual_datetime"), F.col("_actual_hit"))),
        ("facility_key", key_or_special(F.col("facility_id"), F.col("_facility"))),
        ("route_key", _route_key("_route", (F.col("load_id"), F.col("load_found")))),
        ("delivery_status_key", F.coalesce("_status", F.lit(-1))),
        "event_id", "load_id", "trip_id", "scheduled_datetime", "actual_datetime", "detention_minutes",
        "billable_detention_minutes", "arrival_variance_minutes", ("is_deleted_in_source", F.col("_is_deleted_in_source")))


def fact_fuel_purchase(keys: DataFrame | None, silver: Tables, dims: Tables, only: Collection[str] | None = None) -> DataFrame:
    need = _needs(only)
    rows = _carried(
        _listed(silver["fuel_purchases"], keys, "fuel_purchase_id").withColumn("_day", date_key("purchase_date")), only,
        {"purchase_date_key": ("purchase_date", "_day"), "truck_key": ("truck_id", "_day"), "driver_key": ("driver_id", "_day"),
         "route_key": ("trip_id", "_day"), "location_key": ("location_city",)},
        "fuel_purchase_id", "trip_id", "gallons", "total_cost", "is_capacity_exceeded", "_is_deleted_in_source")
    steps = Steps()
    if need("route_key"):
        # a trip meets its load first: two numbers and an id are shuffled for it, not the purchase
        trips = route_of_load(silver["trips"].select("trip_id", "load_id", F.lit(True).alias("trip_found")), silver)
        rows = as_of(steps.before(rows, trips).join(steps.apart(trips), "trip_id", "left"), dims["route"], "route_id", "route_key", "_day", "_route")
    if need("purchase_date_key"):
        rows = date_role(rows, dims["date"], "_day", "_date")
    for dim in ("truck", "driver"):
        if need(f"{dim}_key"):
            rows = as_of(steps.before(rows, dims[dim]), dims[dim], f"{dim}_id", f"{dim}_key", "_day", f"_{dim}")
    if need("location_key"):
        rows = by_columns(rows, dims["location"], ["location_city"], "location_key", "_location")
    return _picked(
        rows, only,
        ("purchase_date_key", special_date(F.col("purchase_date"), F.col("_date"))),
        ("truck_key", key_or_special(F.col("truck_id"), F.col("_truck"))),
        ("driver_key", key_or_special(F.col("driver_id"), F.col("_driver"))),
        ("route_key", _route_key("_route", (F.col("trip_id"), F.col("trip_found")), (F.col("load_id"), F.col("load_found")))),
        ("location_key", key_or_special(F.col("location_city"), F.col("_location"))),
        "fuel_purchase_id", "trip_id", "gallons", "total_cost", "is_capacity_exceeded",
        ("is_deleted_in_source", F.col("_is_deleted_in_source")))


def fact_maintenance(keys: DataFrame | None, silver: Tables, dims: Tables, only: Collection[str] | None = None) -> DataFrame:
    need = _needs(only)
    rows = _listed(silver["maintenance_records"], keys, "maintenance_id").withColumns({
        "_day": date_key("maintenance_date"), "maintenance_type": recorded("maintenance_type"),
        "service_urgency": recorded("service_urgency")})
    if need("maintenance_date_key"):
        rows = date_role(rows, dims["date"], "_day", "_date")
    if need("truck_key"):
        rows = as_of(rows, dims["truck"], "truck_id", "truck_key", "_day", "_truck")
    if need("location_key"):
        rows = by_columns(rows, dims["location"], {"facility_location": "location_city"}, "location_key", "_location")
    if need("maintenance_class_key"):
        rows = by_columns(rows, dims["maintenance_class"], ["maintenance_type", "service_urgency"],
                          "maintenance_class_key", "_class")
    return _picked(
        rows, only,
        ("maintenance_date_key", special_date(F.col("maintenance_date"), F.col("_date"))),
        ("truck_key", key_or_special(F.col("truck_id"), F.col("_truck"))),
        ("location_key", key_or_special(F.col("facility_location"), F.col("_location"))),
        ("maintenance_class_key", F.coalesce("_class", F.lit(-1))),
        "maintenance_id", "labor_hours", "labor_cost", "parts_cost", "downtime_hours", "odometer_reading",
        ("is_deleted_in_source", F.col("_is_deleted_in_source")))


INCIDENT_CLASS = ("incident_type", "incident_category", "incident_severity", "incident_cause",
                  "preventable_status", "at_fault_status", "injury_status")


def fact_safety_incident(keys: DataFrame | None, silver: Tables, dims: Tables, only: Collection[str] | None = None) -> DataFrame:
    need = _needs(only)
    rows = incident_attributes(_listed(silver["safety_incidents"], keys, "incident_id"))
    rows = rows.withColumn("_day", date_key("incident_date"))
    if need("incident_date_key"):
        rows = date_role(rows, dims["date"], "_day", "_date")
    for dim in ("driver", "truck"):
        if need(f"{dim}_key"):
            rows = as_of(rows, dims[dim], f"{dim}_id", f"{dim}_key", "_day", f"_{dim}")
    if need("location_key"):
        rows = by_columns(rows, dims["location"], ["location_city"], "location_key", "_location")
    if need("incident_class_key"):
        rows = by_columns(rows, dims["incident_class"], INCIDENT_CLASS, "incident_class_key", "_class")
    return _picked(
        rows, only,
        ("incident_date_key", special_date(F.col("incident_date"), F.col("_date"))),
        ("driver_key", key_or_special(F.col("driver_id"), F.col("_driver"))),
        ("truck_key", key_or_special(F.col("truck_id"), F.col("_truck"))),
        ("location_key", key_or_special(F.col("location_city"), F.col("_location"))),
        ("incident_class_key", F.coalesce("_class", F.lit(-1))),
        "incident_id", "trip_id", "vehicle_damage_cost", "cargo_damage_cost",
        ("is_deleted_in_source", F.col("_is_deleted_in_source")))


# --- accumulating snapshot ------------------------------------------------------

def milestone_events(trips: DataFrame, events: DataFrame) -> DataFrame:
    """Live Pickup and Delivery events on live trips, for the trip's own load."""
    live = trips.where(~F.col("_is_deleted_in_source")).select("trip_id", "load_id")
    return (events.where(~F.col("_is_deleted_in_source") & F.col("event_type").isin("Pickup", "Delivery"))
            .join(live, ["trip_id", "load_id"], "left_semi"))


def ambiguous_milestones(trips: DataFrame, events: DataFrame) -> DataFrame:
    """Trips with two live events of a kind, and loads delivered twice: (id, problem)."""
    live = milestone_events(trips, events)
    twice = (live.groupBy("trip_id", "event_type").count().where(F.col("count") > 1)
             .select(F.col("trip_id").cast("string").alias("id"), F.lit("repeated event").alias("problem")))
    delivered = (live.where((F.col("event_type") == "Delivery") & F.col("actual_datetime").isNotNull())
                 .groupBy("load_id").count().where(F.col("count") > 1)
                 .select(F.col("load_id").cast("string").alias("id"), F.lit("delivered twice").alias("problem")))
    return twice.unionByName(delivered)


def trip_milestones(trips: DataFrame, events: DataFrame) -> DataFrame:
    """Live trips of a load with the times of their pickup and delivery."""
    live = trips.where(~F.col("_is_deleted_in_source") & F.col("load_id").isNotNull()).select(
        "load_id", "trip_id", "dispatch_date", "driver_id", "truck_id", "trailer_id")

    def at(kind: str) -> Column:
        return F.max(F.when(F.col("event_type") == kind, F.col("actual_datetime")))

    times = (events.where(~F.col("_is_deleted_in_source") & F.col("event_type").isin("Pickup", "Delivery"))
             .groupBy("trip_id", "load_id").agg(at("Pickup").alias("picked_at"), at("Delivery").alias("delivered_at")))
    return live.join(times, ["trip_id", "load_id"], "left")


def fulfilling_trips(milestones: DataFrame) -> DataFrame:
    """One trip per load: the one that delivered, else the latest dispatched, else the
    greatest id. An aggregate, so a load with very many trips needs no per-load sort."""
    return latest_per_key(milestones, ["load_id"], [
        F.col("delivered_at").isNotNull(), F.col("dispatch_date"), F.col("trip_id")])


#: What a load's row says without its trip.
BOOKED = {"booked_date_key", "customer_key", "route_key", "load_type_key", "load_id", "revenue", "fuel_surcharge",
          "accessorial_charges", "weight_lbs", "pieces", "is_deleted_in_source"}


def fact_load_lifecycle(keys: DataFrame | None, silver: Tables, dims: Tables, only: Collection[str] | None = None) -> DataFrame:
    need = _needs(only)
    rows = _listed(silver["loads"], keys, "load_id").withColumns({
        "_booked": date_key("load_date"), "booking_type": recorded("booking_type"), "load_type": recorded("load_type")})
    steps = Steps()
    if only is None or not BOOKED.issuperset(only):
        chosen = fulfilling_trips(trip_milestones(silver["trips"], silver["delivery_events"]))
        rows = rows.join(steps.apart(chosen), "load_id", "left").withColumns({
            "_dispatched": date_key("dispatch_date"), "_picked": date_key("picked_at"), "_delivered": date_key("delivered_at")})
    for role, column in (("booked", "booked_date_key"), ("dispatched", "dispatched_date_key"), ("picked", "pickup_date_key"),
                         ("delivered", "delivery_date_key")):
        if need(column):
            rows = date_role(rows, dims["date"], f"_{role}", f"_{role}_hit")
    for dim in ("customer", "route"):
        if need(f"{dim}_key"):
            rows = as_of(steps.before(rows, dims[dim]), dims[dim], f"{dim}_id", f"{dim}_key", "_booked", f"_{dim}")
    if need("load_type_key"):
        rows = by_columns(rows, dims["load_type"], ["booking_type", "load_type"], "load_type_key", "_load_type")
    for dim in ("driver", "truck", "trailer"):
        if need(f"fulfilling_{dim}_key"):
            rows = as_of(steps.before(rows, dims[dim]), dims[dim], f"{dim}_id", f"{dim}_key", "_dispatched", f"_{dim}")

    has_trip = F.col("trip_id").isNotNull()
    dispatched = special_date(F.col("dispatch_date"), F.col("_dispatched_hit"))
    back = F.coalesce(F.col("delivered_at") < F.col("picked_at"), F.lit(False))
    return _picked(
        rows, only,
        ("booked_date_key", special_date(F.col("load_date"), F.col("_booked_hit"))),
        ("dispatched_date_key", F.when(has_trip, dispatched).otherwise(F.lit(NOT_APPLICABLE))),
        ("pickup_date_key", special_date(F.col("picked_at"), F.col("_picked_hit"), NOT_APPLICABLE)),
        ("delivery_date_key", special_date(F.col("delivered_at"), F.col("_delivered_hit"), NOT_APPLICABLE)),
        ("customer_key", key_or_special(F.col("customer_id"), F.col("_customer"))),
        ("route_key", key_or_special(F.col("route_id"), F.col("_route"))),
        ("load_type_key", F.coalesce("_load_type", F.lit(-1))),
        ("fulfilling_driver_key", key_or_special(F.col("driver_id"), F.col("_driver"), possible=has_trip)),
        ("fulfilling_truck_key", key_or_special(F.col("truck_id"), F.col("_truck"), possible=has_trip)),
        ("fulfilling_trailer_key", key_or_special(F.col("trailer_id"), F.col("_trailer"), possible=has_trip)),
        "load_id", "revenue", "fuel_surcharge", "accessorial_charges", "weight_lbs", "pieces",
        ("booking_to_dispatch_days", F.datediff("dispatch_date", "load_date")),
        ("dispatch_to_pickup_hours", hours_between("dispatch_date", "picked_at")),
        ("pickup_to_delivery_hours", F.when(~back, hours_between("picked_at", "delivered_at"))),
        ("booking_to_delivery_hours", hours_between("load_date", "delivered_at")),
        ("is_timestamp_reversed", back),
        ("is_deleted_in_source", F.col("_is_deleted_in_source")))


def assert_unambiguous(trips: DataFrame, events: DataFrame) -> None:
    if not ambiguous_milestones(trips, events).isEmpty():
        raise CheckFailed("a milestone is ambiguous: repeated live events, or a load delivered twice")


#: Fact name -> (builder, key column, surrogate key columns).
FACTS = {
    "trip": (fact_trip, "trip_id",
             ("dispatch_date_key", "driver_key", "truck_key", "trailer_key", "route_key")),
    "delivery_event": (fact_delivery_event, "event_id",
                       ("scheduled_date_key", "actual_date_key", "facility_key", "route_key",
                        "delivery_status_key")),
    "fuel_purchase": (fact_fuel_purchase, "fuel_purchase_id",
                      ("purchase_date_key", "truck_key", "driver_key", "route_key", "location_key")),
    "maintenance": (fact_maintenance, "maintenance_id",
                    ("maintenance_date_key", "truck_key", "location_key", "maintenance_class_key")),
    "safety_incident": (fact_safety_incident, "incident_id",
                        ("incident_date_key", "driver_key", "truck_key", "location_key", "incident_class_key")),
    "load_lifecycle": (fact_load_lifecycle, "load_id",
                       ("booked_date_key", "dispatched_date_key", "pickup_date_key", "delivery_date_key",
                        "customer_key", "route_key", "load_type_key", "fulfilling_driver_key",
                        "fulfilling_truck_key", "fulfilling_trailer_key")),
}
