"""Dimensions, key resolution and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import date_key
from tidemark.operators import dims as D
from tidemark.operators import facts as T
from tidemark.operators import transforms as X
from tidemark.operators.facts import FACTS
from tidemark.plans import oracle_star
from tidemark.plans.loading import BATCHES, Warehouse, batch
from tidemark.plans.oracle import variant
from tidemark.plans.oracle_star import CLASS
from tidemark.plans.registry import outputs, query
from tidemark.plans.star import CUSTOMER, DIMS, DRIVER_2, FACILITY, ROUTE, TRAILER, star
from tidemark.plans.trucking import given

DATE_OUT = ("date_key int, full_date date, calendar_year int, quarter_number int, quarter_label string, "
            "month_number int, month_name string, year_month_number int, year_month_label string, "
            "day_of_month int, is_complete_month flag")


@query("dim_date", DATE_OUT, "SELECT * FROM dim_date")
def dim_date(spark, sf):
    return star(spark, sf).build_dim("date")


@query("dim_calendar", DATE_OUT, "SELECT * FROM dim_date WHERE date_key > 0")
def dim_calendar(spark, sf):
    return D.dim_calendar(star(spark, sf).build_dim("date"))


@query("special_members", "dim string, special_rows bigint, lowest bigint, highest bigint",
       " UNION ALL ".join(f"SELECT '{n}' AS dim, count(*) AS special_rows, min({k}) AS lowest, max({k}) AS highest "
                          f"FROM dim_{n} WHERE {k} <= 0" for n, (k, _) in DIMS.items()))
def special_members(spark, sf):
    """0, -1 and -2 in every dimension."""
    frames, out = star(spark, sf).dims(list(DIMS)), None
    for name, (key, _) in DIMS.items():
        row = frames[name].where(F.col(key) <= 0).agg(
            F.count(F.lit(1)).alias("special_rows"), F.min(key).alias("lowest"), F.max(key).alias("highest")
        ).select(F.lit(name).alias("dim"), "*")
        out = row if out is None else out.unionByName(row)
    return out


VALIDITY = ("valid_from_date_key int, valid_to_date_key int, is_current flag, is_deleted flag, "
            "version_reason string")

KIND = {"credit_terms_days": "int", "contract_start_date": "date", "annual_revenue_potential": "double",
        "trailer_model_year": "int", "trailer_acquisition_date": "date", "typical_distance_miles": "int",
        "base_rate_per_mile": "double", "fuel_surcharge_rate": "double", "typical_transit_days": "int",
        "dock_doors": "int", "facility_latitude": "double", "facility_longitude": "double",
        "is_centroid_coordinate": "flag"}


def _columns(names):
    return ", ".join(f"{n} {KIND.get(n, 'string')}" for n in names)


for _name, _attributes in (("customer", CUSTOMER), ("trailer", TRAILER), ("route", ROUTE), ("facility", FACILITY)):
    @query(f"scd1_upsert_{_name}", f"{_name}_key bigint, {_name}_id bigint, {_columns(_attributes)}, {VALIDITY}",
           f"SELECT * FROM dim_{_name}")
    def scd1(spark, sf, name=_name):
        return star(spark, sf).build_dim(name)


@query("scd1_upsert", f"customer_key bigint, customer_id bigint, {_columns(CUSTOMER)}, {VALIDITY}", """
    SELECT customer_key, d.customer_id,
           CASE WHEN v.customer_id IS NULL THEN d.customer_name ELSE v.customer_name END AS customer_name,
           CASE WHEN v.customer_id IS NULL THEN d.customer_type ELSE v.customer_type END AS customer_type,
           CASE WHEN v.customer_id IS NULL THEN d.primary_freight_type ELSE v.primary_freight_type END
               AS primary_freight_type,
           CASE WHEN v.customer_id IS NULL THEN d.account_status ELSE v.account_status END AS account_status,
           CASE WHEN v.customer_id IS NULL THEN d.credit_terms_days ELSE v.credit_terms_days END AS credit_terms_days,
           CASE WHEN v.customer_id IS NULL THEN d.contract_start_date ELSE v.contract_start_date END
               AS contract_start_date,
           CASE WHEN v.customer_id IS NULL THEN d.annual_revenue_potential ELSE v.annual_revenue_potential END
               AS annual_revenue_potential,
           valid_from_date_key, valid_to_date_key, is_current,
           CASE WHEN customer_key <= 0 THEN is_deleted ELSE coalesce(v.gone, TRUE) END AS is_deleted, version_reason
    FROM dim_customer AS d
    LEFT JOIN (SELECT * EXCLUDE (account_status, is_deleted_in_source),
                      CASE WHEN customer_id % 6 = 1 THEN 'Review' ELSE account_status END AS account_status,
                      is_deleted_in_source AS gone
               FROM src_customer WHERE customer_id % 31 <> 2) AS v
      ON v.customer_id = d.customer_id AND d.customer_key > 0
    UNION ALL
    SELECT (SELECT max(customer_key) FROM dim_customer)
               + row_number() OVER (ORDER BY substr(md5(concat_ws('|', CAST(id AS VARCHAR))), 1, 3), id),
           id, customer_name, customer_type, primary_freight_type, account_status, credit_terms_days,
           contract_start_date, annual_revenue_potential, (SELECT k FROM first_day_key), 99991231, TRUE, FALSE,
           'Initial version'
    FROM (SELECT customer_id + 1000000000 AS id, * FROM src_customer WHERE customer_id % 9 = 4)""")
def scd1_upsert(spark, sf):
    """The second load: changed, absent and new members against the first load's dimension."""
    s = star(spark, sf)
    source = s.dim_source("customer")
    changed = source.where(F.col("customer_id") % 31 != 2).withColumn(
        "account_status", F.when(F.col("customer_id") % 6 == 1, "Review").otherwise(F.col("account_status")))
    new = source.where(F.col("customer_id") % 9 == 4).withColumns(
        {"customer_id": F.col("customer_id") + 1_000_000_000, "is_deleted_in_source": F.lit(False)})
    return D.scd1_upsert(s.dim("customer"), changed.unionByName(new), "customer_id", "customer_key", CUSTOMER,
                         s.first_key())


@query("scd2_apply_driver",
       "driver_key bigint, driver_id bigint, driver_name string, driver_hire_date date, years_experience int, "
       "driver_home_terminal string, employment_status string, driver_termination_date date, "
       f"driver_version_label string, {VALIDITY}", "SELECT * FROM dim_driver")
def scd2_driver(spark, sf):
    """Overwrites in place, expiries with a reopened version, new members, deletions."""
    return star(spark, sf).build_dim("driver")


@query("scd2_apply_truck",
       "truck_key bigint, truck_id bigint, unit_number string, truck_make string, truck_model_year int, "
       "truck_acquisition_date date, acquisition_mileage int, tank_capacity_gallons int, truck_status string, "
       f"truck_home_terminal string, truck_version_label string, {VALIDITY}", "SELECT * FROM dim_truck")
def scd2_truck(spark, sf):
    return star(spark, sf).build_dim("truck")


@query("scd2_apply", "versions bigint, members bigint, reopened bigint, overwritten bigint, expired bigint", """
    SELECT count(*) AS versions, count(DISTINCT driver_id) AS members,
           sum(CASE WHEN version_reason LIKE 'Changed:%' THEN 1 ELSE 0 END) AS reopened,
           (SELECT sum(CAST(overwritten AS INT)) FROM driver_marked) AS overwritten,
           sum(CASE WHEN NOT is_current THEN 1 ELSE 0 END) AS expired
    FROM dim_driver WHERE driver_key > 0""")
def scd2_summary(spark, sf):
    """What the second driver load did."""
    s = star(spark, sf)
    first = s.dim("driver_first").where("driver_key > 0").select(
        "driver_key", F.struct(*DRIVER_2).alias("_was"), F.col("valid_to_date_key").alias("_to"))
    rows = s.build_dim("driver").where("driver_key > 0").join(first, "driver_key", "left")
    in_place = (F.col("_was").isNotNull() & ~F.struct(*DRIVER_2).eqNullSafe(F.col("_was"))
                & (F.col("valid_to_date_key") == F.col("_to")))
    return rows.agg(
        F.count(F.lit(1)).alias("versions"), F.countDistinct("driver_id").alias("members"),
        F.count_if(F.col("version_reason").startswith("Changed:")).alias("reopened"),
        F.count_if(in_place).alias("overwritten"), F.count_if(~F.col("is_current")).alias("expired"))


@query("scd2_from_history", "user_id bigint, event_type string, valid_from_date_key int, valid_to_date_key int, "
                            "is_current flag", """
    WITH d AS (SELECT user_id, event_type, year(ts) * 10000 + month(ts) * 100 + day(ts) AS k, ts FROM events),
    h AS (SELECT user_id, k, arg_max(event_type, ts) AS event_type FROM d GROUP BY user_id, k),
    s AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY k) AS p FROM h),
    v AS (SELECT * FROM s WHERE p IS NULL OR p <> event_type)
    SELECT user_id, event_type, k AS valid_from_date_key,
           coalesce(lead(k) OVER (PARTITION BY user_id ORDER BY k), 99991231) AS valid_to_date_key,
           lead(k) OVER (PARTITION BY user_id ORDER BY k) IS NULL AS is_current
    FROM v""")
def scd2_from_history(spark, sf):
    """Versions from a full history; busy users are split, so no window holds all their days."""
    daily = given(spark, sf, "events").groupBy("user_id", date_key("ts").alias("day")).agg(
        F.max_by("event_type", "ts").alias("event_type"))
    return D.scd2_from_history(daily, "user_id", ["event_type"], "day")


for _name, _cols in (("load_type", ("booking_type", "load_type")),
                     ("delivery_status", ("event_type", "arrival_status")),
                     ("maintenance_class", ("maintenance_type", "service_urgency")),
                     ("incident_class", tuple(CLASS))):
    @query(f"junk_dim_{_name}", f"{_name}_key bigint, {', '.join(f'{c} string' for c in _cols)}",
           f"SELECT * FROM dim_{_name}")
    def junk(spark, sf, name=_name):
        return star(spark, sf).build_dim(name)


@query("junk_dim", "maintenance_class_key bigint, maintenance_type string, service_urgency string", """
    SELECT * FROM dim_maintenance_class
    UNION ALL
    SELECT (SELECT max(maintenance_class_key) FROM dim_maintenance_class)
               + row_number() OVER (ORDER BY substr(md5(concat_ws('|', a, b)), 1, 3), a, b), a, b
    FROM (SELECT DISTINCT maintenance_type AS a, trip_status AS b
          FROM raw_maintenance_records JOIN raw_trips ON load_id = maintenance_id) AS c
    WHERE NOT EXISTS (SELECT 1 FROM dim_maintenance_class AS d
                      WHERE d.maintenance_type = a AND d.service_urgency = b)""")
def junk_dim(spark, sf):
    """Insert-only: combinations unseen so far are appended, earlier keys stay."""
    s = star(spark, sf)
    later = (s.raw("maintenance_records").select("maintenance_type", F.col("maintenance_id").alias("load_id"))
             .join(s.raw("trips").select("load_id", F.col("trip_status").alias("service_urgency")), "load_id"))
    return D.junk_dim(s.dim("maintenance_class"), later, ("maintenance_type", "service_urgency"),
                      "maintenance_class_key")


@query("city_state_map", "location_city string, location_state_code string, state_rank int",
       "SELECT * FROM city_state_map")
def city_state_map(spark, sf):
    return D.city_state_map(*star(spark, sf).city_pairs())


@query("dim_location", "location_key bigint, location_city string, location_state_code string, "
                       "location_state_name string, location_country string, state_source string",
       "SELECT * FROM dim_location")
def dim_location(spark, sf):
    return star(spark, sf).build_dim("location")


@query("ref_us_state", "state_code string, state_name string, facilities bigint", """
    SELECT f.state AS state_code, coalesce(u.state_name, 'Unknown') AS state_name, count(*) AS facilities
    FROM raw_facilities AS f LEFT JOIN us_state AS u ON u.state_code = f.state GROUP BY 1, 2""")
def ref_us_state(spark, sf):
    """The 51-row state reference applied to all facilities; other codes are Unknown."""
    facilities = star(spark, sf).raw("facilities")
    return (X.state_name(facilities, D.us_states(spark), "state", "state_name")
            .groupBy(F.col("state").alias("state_code"), "state_name").agg(F.count(F.lit(1)).alias("facilities")))


@query("resolve_keys", "customer_key_kind string, route_key_kind string, driver_key_kind string, rows bigint", """
    SELECT CASE customer_key WHEN 0 THEN 'Missing' WHEN -1 THEN 'Unknown' ELSE 'member' END AS customer_key_kind,
           CASE route_key WHEN 0 THEN 'Missing' WHEN -1 THEN 'Unknown' ELSE 'member' END AS route_key_kind,
           CASE fulfilling_driver_key WHEN 0 THEN 'Missing' WHEN -1 THEN 'Unknown' WHEN -2 THEN 'Not Applicable'
                ELSE 'member' END AS driver_key_kind,
           count(*) AS rows
    FROM fact_load_lifecycle GROUP BY ALL""")
def resolve_keys(spark, sf):
    """How often each reference resolves to a member or to one of the special members."""
    def kind(column):
        return (F.when(F.col(column) == 0, "Missing").when(F.col(column) == -1, "Unknown")
                .when(F.col(column) == -2, "Not Applicable").otherwise("member"))

    return star(spark, sf).stage("load_lifecycle").groupBy(
        kind("customer_key").alias("customer_key_kind"), kind("route_key").alias("route_key_kind"),
        kind("fulfilling_driver_key").alias("driver_key_kind")).agg(F.count(F.lit(1)).alias("rows"))


@query("fact_trip",
       "dispatch_date_key int, driver_key bigint, truck_key bigint, trailer_key bigint, route_key bigint, "
       "trip_id string, load_id bigint, actual_distance_miles int, actual_duration_hours double, "
       "fuel_gallons_used double, idle_time_hours double, is_idle_implausible flag, is_deleted_in_source flag",
       "SELECT * FROM fact_trip")
def fact_trip(spark, sf):
    return star(spark, sf).stage("trip")


@query("fact_delivery_event",
       "scheduled_date_key int, actual_date_key int, facility_key bigint, route_key bigint, "
       "delivery_status_key bigint, event_id string, load_id bigint, trip_id string, scheduled_datetime ts, "
       "actual_datetime ts, detention_minutes int, billable_detention_minutes int, "
       "arrival_variance_minutes double, is_deleted_in_source flag", "SELECT * FROM fact_delivery_event")
def fact_delivery_event(spark, sf):
    return star(spark, sf).stage("delivery_event")


@query("fact_fuel_purchase",
       "purchase_date_key int, truck_key bigint, driver_key bigint, route_key bigint, location_key bigint, "
       "fuel_purchase_id string, trip_id string, gallons double, total_cost double, is_capacity_exceeded flag, "
       "is_deleted_in_source flag", "SELECT * FROM fact_fuel_purchase")
def fact_fuel_purchase(spark, sf):
    return star(spark, sf).stage("fuel_purchase")


@query("fact_maintenance",
       "maintenance_date_key int, truck_key bigint, location_key bigint, maintenance_class_key bigint, "
       "maintenance_id bigint, labor_hours double, labor_cost double, parts_cost double, downtime_hours double, "
       "odometer_reading int, is_deleted_in_source flag", "SELECT * FROM fact_maintenance")
def fact_maintenance(spark, sf):
    return star(spark, sf).stage("maintenance")


@query("fact_safety_incident",
       "incident_date_key int, driver_key bigint, truck_key bigint, location_key bigint, incident_class_key bigint, "
       "incident_id bigint, trip_id string, vehicle_damage_cost double, cargo_damage_cost double, "
       "is_deleted_in_source flag", "SELECT * FROM fact_safety_incident")
def fact_safety_incident(spark, sf):
    return star(spark, sf).stage("safety_incident")


@query("fact_load_lifecycle",
       "booked_date_key int, dispatched_date_key int, pickup_date_key int, delivery_date_key int, "
       "customer_key bigint, route_key bigint, load_type_key bigint, fulfilling_driver_key bigint, "
       "fulfilling_truck_key bigint, fulfilling_trailer_key bigint, load_id bigint, revenue double, "
       "fuel_surcharge double, accessorial_charges double, weight_lbs int, pieces int, "
       "booking_to_dispatch_days int, dispatch_to_pickup_hours double, pickup_to_delivery_hours double, "
       "booking_to_delivery_hours double, is_timestamp_reversed flag, is_deleted_in_source flag",
       "SELECT * FROM fact_load_lifecycle")
def fact_load_lifecycle(spark, sf):
    return star(spark, sf).stage("load_lifecycle")


oracle_star.define("planted_milestones", """
    SELECT e.trip_id, e.load_id, e.actual_datetime,
           CASE WHEN e.event_type = 'Pickup' AND e.actual_datetime > e.scheduled_datetime THEN 'Delivery'
                ELSE e.event_type END AS event_type
    FROM raw_delivery_events AS e JOIN raw_trips AS t ON t.trip_id = e.trip_id AND t.load_id = e.load_id
    WHERE NOT e._is_deleted_in_source AND NOT t._is_deleted_in_source""")


@query("ambiguous_milestone_check", "problem string, ids bigint", """
    SELECT 'repeated event' AS problem, count(*) AS ids
    FROM (SELECT trip_id FROM planted_milestones GROUP BY trip_id, event_type HAVING count(*) > 1)
    UNION ALL
    SELECT 'delivered twice', count(*)
    FROM (SELECT load_id FROM planted_milestones WHERE event_type = 'Delivery' AND actual_datetime IS NOT NULL
          GROUP BY load_id HAVING count(*) > 1)""")
def ambiguous_milestone_check(spark, sf):
    """Milestones made ambiguous on purpose: late pickups recorded again as deliveries."""
    s = star(spark, sf)
    events = s.raw("delivery_events").withColumn(
        "event_type", F.when((F.col("event_type") == "Pickup") & (F.col("actual_datetime") > F.col("scheduled_datetime")),
                             "Delivery").otherwise(F.col("event_type")))
    found = T.ambiguous_milestones(s.raw("trips"), events)
    base = spark.createDataFrame([("repeated event",), ("delivered twice",)], "problem string")
    return base.join(found.groupBy("problem").agg(F.count("id").alias("n")), "problem", "left").select(
        "problem", F.coalesce("n", F.lit(0)).alias("ids"))


@query("grain_assert", "fact string, rows bigint, keys bigint", """
    SELECT 'trip' AS fact, count(*) AS rows, count(DISTINCT trip_id) AS keys FROM fact_trip
    UNION ALL SELECT 'load_lifecycle', count(*), count(DISTINCT load_id) FROM fact_load_lifecycle""")
def grain_assert(spark, sf):
    """Staged rows equal distinct keys."""
    s, out = star(spark, sf), None
    for name in ("trip", "load_lifecycle"):
        row = s.stage(name).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(T.FACTS[name][1]).alias("keys")) \
            .select(F.lit(name).alias("fact"), "*")
        out = row if out is None else out.unionByName(row)
    return out


# --- incremental loads --------------------------------------------------------------------

#: The raw tables after their batch: live rows updated or flagged deleted.
_LANDED = {f"raw_{t}": f"""
    SELECT * REPLACE ({", ".join(f"CASE WHEN NOT _is_deleted_in_source AND ({update}) AND NOT coalesce({gone}, FALSE) THEN {v} ELSE {c} END AS {c}"
                                 for c, v in values.items())},
                      _is_deleted_in_source OR coalesce({gone}, FALSE) AS _is_deleted_in_source)
    FROM raw_{t}""" for t, (update, values, gone) in BATCHES.items()}

for _fact in FACTS:
    @query(f"load_incremental_{_fact}", outputs(f"fact_{_fact}"), f"SELECT * FROM {variant(f'fact_{_fact}', '_landed', _LANDED)}")
    def load_incremental(spark, sf, fact=_fact):
        """The fact after one landed batch per source table: gate, worklist, stage, checks, publish; equal to a rebuild."""
        warehouse = Warehouse(spark, sf, [fact])
        for table in warehouse.tables:
            warehouse.land(table, batch(spark, sf, table), f"land-{table}")
        warehouse.load(fact)
        return warehouse.log.read(f"fact_{fact}")
