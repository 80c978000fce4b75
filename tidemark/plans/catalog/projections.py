"""Projections, filters and conformance."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import transforms as X
from tidemark.plans.contract import schema
from tidemark.plans.registry import query
from tidemark.plans.star import CUSTOMER, FACILITY, ROUTE, TRAILER, star
from tidemark.plans.trucking import source


@query("conform_schema", "load_id string, customer_id string, route_id string, load_date date, load_type string, "
                         "weight_lbs int, pieces int, revenue double, fuel_surcharge double, "
                         "accessorial_charges double, load_status string, booking_type string",
       "SELECT * EXCLUDE (_is_deleted_in_source) FROM raw_loads")
def conform_schema(spark, sf):
    """Project onto the contract's columns and types; anything missing or extra is an error."""
    return X.conform(source(spark, sf, "loads").drop("_is_deleted_in_source"), schema("loads"))


@query("dq_status", "table_name string, _dq_status string, rows bigint", """
    SELECT 'drivers' AS table_name, _dq_status, count(*) AS rows FROM silver_drivers GROUP BY 2
    UNION ALL SELECT 'trips', _dq_status, count(*) FROM silver_trips GROUP BY 2
    UNION ALL SELECT 'delivery_events', _dq_status, count(*) FROM silver_delivery_events GROUP BY 2
    UNION ALL SELECT 'fuel_purchases', _dq_status, count(*) FROM silver_fuel_purchases GROUP BY 2""")
def dq_status(spark, sf):
    s, out = star(spark, sf), None
    for name in ("drivers", "trips", "delivery_events", "fuel_purchases"):
        part = s.silver(name).groupBy("_dq_status").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("transform_drivers", "driver_id bigint, tenure_days int, age_at_hire int, _dq_status string",
       "SELECT driver_id, tenure_days, age_at_hire, _dq_status FROM silver_drivers")
def transform_drivers(spark, sf):
    return X.drivers(source(spark, sf, "drivers"))


@query("transform_age_as_of", "kind string, id bigint, age int", """
    SELECT 'truck' AS kind, truck_id AS id, 2024 - model_year AS age FROM raw_trucks
    UNION ALL SELECT 'trailer', trailer_id, 2024 - model_year FROM raw_trailers""")
def transform_age_as_of(spark, sf):
    def ages(table, kind):
        return X.age_as_of(source(spark, sf, table), "model_year", "age").select(
            F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("id"), "age")
    return ages("trucks", "truck").unionByName(ages("trailers", "trailer"))


@query("transform_route_name", "route_id bigint, route_name string", "SELECT route_id, route_name FROM silver_routes")
def transform_route_name(spark, sf):
    return X.route_name(source(spark, sf, "routes"))


@query("transform_centroid_flag", "facility_id bigint, is_centroid_coordinate flag",
       "SELECT facility_id, TRUE AS is_centroid_coordinate FROM raw_facilities")
def transform_centroid_flag(spark, sf):
    return X.centroid_flag(source(spark, sf, "facilities"))


@query("transform_idle_flag", "trip_id string, is_idle_implausible flag, _dq_status string",
       "SELECT trip_id, is_idle_implausible, _dq_status FROM silver_trips")
def transform_idle_flag(spark, sf):
    return X.idle_flag(source(spark, sf, "trips"))


@query("transform_arrival", "event_id string, arrival_variance_minutes double, arrival_status string, "
                            "billable_detention_minutes int",
       """SELECT event_id, arrival_variance_minutes, arrival_status, billable_detention_minutes
          FROM silver_delivery_events""")
def transform_arrival(spark, sf):
    return X.arrival(source(spark, sf, "delivery_events"))


@query("transform_reversed_pair", "event_id string, load_id bigint, is_timestamp_reversed flag",
       "SELECT event_id, load_id, is_timestamp_reversed FROM silver_delivery_events")
def transform_reversed_pair(spark, sf):
    return X.reversed_pair(source(spark, sf, "delivery_events"))


@query("transform_urgency", "maintenance_id bigint, service_urgency string",
       "SELECT maintenance_id, service_urgency FROM silver_maintenance_records")
def transform_urgency(spark, sf):
    return X.urgency(source(spark, sf, "maintenance_records"))


@query("transform_incident", "incident_id bigint, incident_severity string, incident_cause string, "
                             "incident_category string",
       "SELECT incident_id, incident_severity, incident_cause, incident_category FROM silver_safety_incidents")
def transform_incident(spark, sf):
    return X.incident(source(spark, sf, "safety_incidents"))


@query("transform_capacity_flag", "fuel_purchase_id string, is_capacity_exceeded flag, _dq_status string",
       "SELECT fuel_purchase_id, is_capacity_exceeded, _dq_status FROM silver_fuel_purchases")
def transform_capacity_flag(spark, sf):
    return X.capacity_flag(source(spark, sf, "fuel_purchases"), source(spark, sf, "trucks"))


_KINDS = {"credit_terms_days": "int", "contract_start_date": "date", "annual_revenue_potential": "double",
          "trailer_model_year": "int", "trailer_acquisition_date": "date", "typical_distance_miles": "int",
          "base_rate_per_mile": "double", "fuel_surcharge_rate": "double", "typical_transit_days": "int",
          "dock_doors": "int", "facility_latitude": "double", "facility_longitude": "double",
          "is_centroid_coordinate": "flag", "driver_hire_date": "date", "driver_termination_date": "date",
          "years_experience": "int", "truck_model_year": "int", "truck_acquisition_date": "date",
          "acquisition_mileage": "int", "tank_capacity_gallons": "int", "source_changed_date_key": "int",
          "is_deleted_in_source": "flag"}
_SOURCES = {
    "customer": ("customer_id bigint", CUSTOMER),
    "driver": ("driver_id bigint", ("driver_name", "driver_home_terminal", "employment_status", "driver_hire_date",
                                    "driver_termination_date", "years_experience", "source_changed_date_key")),
    "truck": ("truck_id bigint", ("unit_number", "truck_make", "truck_status", "truck_home_terminal",
                                  "truck_model_year", "truck_acquisition_date", "acquisition_mileage",
                                  "tank_capacity_gallons", "source_changed_date_key")),
    "trailer": ("trailer_id bigint", TRAILER),
    "route": ("route_id bigint", ROUTE),
    "facility": ("facility_id bigint", FACILITY),
}
for _name, (_id, _cols) in _SOURCES.items():
    @query(f"source_view_{_name}",
           ", ".join([_id, *[f"{c} {_KINDS.get(c, 'string')}" for c in (*_cols, "is_deleted_in_source")]]),
           f"SELECT * FROM src_{_name}")
    def source_view(spark, sf, name=_name):
        return star(spark, sf).dim_source(name)

_JUNK = {"load_type": "load_id bigint, booking_type string, load_type string",
         "delivery_status": "event_id string, event_type string, arrival_status string",
         "maintenance_class": "maintenance_id bigint, maintenance_type string, service_urgency string",
         "incident_class": "incident_id bigint, incident_type string, incident_category string, "
                           "incident_severity string, incident_cause string, preventable_status string, "
                           "at_fault_status string, injury_status string"}
for _name, _out in _JUNK.items():
    @query(f"source_view_{_name}", _out, f"SELECT * FROM src_{_name}")
    def junk_view(spark, sf, name=_name):
        return star(spark, sf).dim_source(name)


@query("source_view_junk", "load_type string, booking_type string, n bigint",
       "SELECT load_type, booking_type, count(*) AS n FROM src_load_type GROUP BY ALL")
def source_view_junk(spark, sf):
    return star(spark, sf).dim_source("load_type").groupBy("load_type", "booking_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("live_filter", "table_name string, live bigint, deleted bigint", """
    SELECT 'loads' AS table_name, count(*) FILTER (NOT _is_deleted_in_source) AS live,
           count(*) FILTER (_is_deleted_in_source) AS deleted FROM raw_loads
    UNION ALL SELECT 'trips', count(*) FILTER (NOT _is_deleted_in_source),
           count(*) FILTER (_is_deleted_in_source) FROM raw_trips""")
def live_filter(spark, sf):
    def row(table):
        return source(spark, sf, table).agg(
            F.count_if(~F.col("_is_deleted_in_source")).alias("live"),
            F.count_if("_is_deleted_in_source").alias("deleted")).select(F.lit(table).alias("table_name"), "*")
    return row("loads").unionByName(row("trips"))


@query("special_key_filter", "driver_key bigint, trips bigint, miles bigint", """
    SELECT driver_key, count(*) AS trips, sum(actual_distance_miles) AS miles FROM fact_trip
    WHERE driver_key > 0 AND dispatch_date_key > 0 AND NOT is_deleted_in_source GROUP BY driver_key""")
def special_key_filter(spark, sf):
    """Only rows whose driver and date are real members."""
    return (star(spark, sf).fact("trip")
            .where("driver_key > 0 AND dispatch_date_key > 0 AND NOT is_deleted_in_source")
            .groupBy("driver_key").agg(F.count(F.lit(1)).alias("trips"),
                                       F.sum("actual_distance_miles").alias("miles")))
