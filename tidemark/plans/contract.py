"""The twelve source tables: columns, types, keys and references."""

from __future__ import annotations

from pyspark.sql import types as T

# The source contract, as DDL, with each table's key and whether it changes in batches.
TABLES: dict[str, tuple[str, bool, str]] = {
    "customers": ("customer_id", True, """
        customer_id string, customer_name string, customer_type string, credit_terms_days int,
        primary_freight_type string, account_status string, contract_start_date date,
        annual_revenue_potential decimal(14,2)"""),
    "facilities": ("facility_id", False, """
        facility_id string, facility_name string, facility_type string, city string, state string,
        latitude decimal(10,6), longitude decimal(10,6), dock_doors int, operating_hours string"""),
    "drivers": ("driver_id", True, """
        driver_id string, first_name string, last_name string, hire_date date, termination_date date,
        license_number string, license_state string, date_of_birth date, home_terminal string,
        employment_status string, cdl_class string, years_experience int"""),
    "trucks": ("truck_id", True, """
        truck_id string, unit_number string, make string, model_year int, vin string, acquisition_date date,
        acquisition_mileage int, fuel_type string, tank_capacity_gallons int, status string,
        home_terminal string"""),
    "trailers": ("trailer_id", False, """
        trailer_id string, trailer_number string, trailer_type string, length_feet int, model_year int,
        vin string, acquisition_date date, status string, current_location string"""),
    "routes": ("route_id", False, """
        route_id string, origin_city string, origin_state string, destination_city string,
        destination_state string, typical_distance_miles int, base_rate_per_mile decimal(8,4),
        fuel_surcharge_rate decimal(8,4), typical_transit_days int"""),
    "loads": ("load_id", True, """
        load_id string, customer_id string, route_id string, load_date date, load_type string, weight_lbs int,
        pieces int, revenue decimal(14,2), fuel_surcharge decimal(14,2), accessorial_charges decimal(14,2),
        load_status string, booking_type string"""),
    "trips": ("trip_id", True, """
        trip_id string, load_id string, driver_id string, truck_id string, trailer_id string,
        dispatch_date date, actual_distance_miles int, actual_duration_hours decimal(10,2),
        fuel_gallons_used decimal(12,2), average_mpg decimal(8,2), idle_time_hours decimal(10,2),
        trip_status string"""),
    "fuel_purchases": ("fuel_purchase_id", True, """
        fuel_purchase_id string, trip_id string, truck_id string, driver_id string, purchase_date timestamp,
        location_city string, location_state string, gallons decimal(10,2), price_per_gallon decimal(10,3),
        total_cost decimal(14,2), fuel_card_number string"""),
    "maintenance_records": ("maintenance_id", False, """
        maintenance_id string, truck_id string, maintenance_date date, maintenance_type string,
        odometer_reading int, labor_hours decimal(8,2), labor_cost decimal(14,2), parts_cost decimal(14,2),
        total_cost decimal(14,2), facility_location string, downtime_hours decimal(10,2),
        service_description string"""),
    "delivery_events": ("event_id", True, """
        event_id string, load_id string, trip_id string, event_type string, facility_id string,
        scheduled_datetime timestamp, actual_datetime timestamp, detention_minutes int, on_time_flag boolean,
        location_city string, location_state string"""),
    "safety_incidents": ("incident_id", False, """
        incident_id string, trip_id string, truck_id string, driver_id string, incident_date timestamp,
        incident_type string, location_city string, location_state string, at_fault_flag boolean,
        injury_flag boolean, vehicle_damage_cost decimal(14,2), cargo_damage_cost decimal(14,2),
        claim_amount decimal(14,2), preventable_flag boolean, description string"""),
}
EVENT_DDL = "_operation string, _event_id string, _source_sequence bigint, _source_changed_at timestamp, _batch_id string"
AUDIT_DDL = ("_source_ingest_date string, _silver_created_at timestamp, _silver_updated_at timestamp, "
             "_silver_run_id string, _dq_status string, _is_deleted_in_source boolean, "
             "_source_changed_at timestamp, _source_batch_id string, _source_sequence bigint")

# The published monthly figures.
BASELINES = {
    "driver_monthly_metrics": """
        driver_id string, month date, trips_completed int, total_miles int, total_revenue decimal(14,2),
        average_mpg decimal(8,2), total_fuel_gallons decimal(12,2), on_time_delivery_rate decimal(6,4),
        average_idle_hours decimal(8,2)""",
    "truck_utilization_metrics": """
        truck_id string, month date, trips_completed int, total_miles int, total_revenue decimal(14,2),
        average_mpg decimal(8,2), maintenance_events int, maintenance_cost decimal(14,2),
        downtime_hours decimal(10,2), utilization_rate decimal(6,4)""",
}

# Child table, column, parent table; the parent column is the parent's key.
FOREIGN_KEYS = (
    ("loads", "customer_id", "customers"),
    ("loads", "route_id", "routes"),
    ("trips", "load_id", "loads"),
    ("trips", "driver_id", "drivers"),
    ("trips", "truck_id", "trucks"),
    ("trips", "trailer_id", "trailers"),
    ("fuel_purchases", "trip_id", "trips"),
    ("fuel_purchases", "truck_id", "trucks"),
    ("fuel_purchases", "driver_id", "drivers"),
    ("maintenance_records", "truck_id", "trucks"),
    ("delivery_events", "load_id", "loads"),
    ("delivery_events", "trip_id", "trips"),
    ("delivery_events", "facility_id", "facilities"),
    ("safety_incidents", "trip_id", "trips"),
    ("safety_incidents", "truck_id", "trucks"),
    ("safety_incidents", "driver_id", "drivers"),
)


def key_of(table: str) -> str:
    return TABLES[table][0]


def schema(table: str, change_batch: bool = False) -> T.StructType:
    """The source schema of a table, with the event columns for a change batch."""
    text = TABLES[table][2] + (f", {EVENT_DDL}" if change_batch else "")
    return T.StructType.fromDDL(text)


def change_tables() -> list[str]:
    return [name for name, (_, changes, _ddl) in TABLES.items() if changes]
