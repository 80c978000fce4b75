"""Measures, date roles, comparison figures, reports and requirements."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.compare import mean, ratio
from tidemark.plans.measures import DATE_ROLES, drill_across, query as measure_query
from tidemark.plans.oracle import define
from tidemark.plans.registry import query
from tidemark.plans.star import star

# Oracle relations: live fact rows with the attributes the figures read.
define("live_loads", "SELECT * FROM fact_load_lifecycle WHERE NOT is_deleted_in_source")
define("live_stops", """
    SELECT f.*, s.event_type, s.arrival_status FROM fact_delivery_event AS f
    LEFT JOIN dim_delivery_status AS s ON s.delivery_status_key = f.delivery_status_key WHERE NOT f.is_deleted_in_source""")
define("live_fuel", "SELECT * FROM fact_fuel_purchase WHERE NOT is_deleted_in_source")
define("live_fact_trips", """
    SELECT f.*, CASE WHEN f.truck_key > 0 THEN t.truck_id END AS real_truck,
           CASE WHEN f.driver_key > 0 THEN d.driver_id END AS real_driver
    FROM fact_trip AS f LEFT JOIN dim_truck AS t ON t.truck_key = f.truck_key
    LEFT JOIN dim_driver AS d ON d.driver_key = f.driver_key WHERE NOT f.is_deleted_in_source""")
define("live_maintenance", "SELECT * FROM fact_maintenance WHERE NOT is_deleted_in_source")
define("live_incidents", """
    SELECT f.*, c.preventable_status, c.at_fault_status, c.incident_category, c.incident_severity, c.incident_cause
    FROM fact_safety_incident AS f LEFT JOIN dim_incident_class AS c ON c.incident_class_key = f.incident_class_key
    WHERE NOT f.is_deleted_in_source""")


def d(x):
    return f"CAST({x} AS DOUBLE)"


def mean_sql(x):
    return f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"


def div(a, b):
    return f"{d(a)} / nullif({d(b)}, 0)"


CHARGES = "sum(revenue) + sum(fuel_surcharge) + sum(accessorial_charges)"
LOAD_SUMS = ("count(*) AS loads, sum(revenue) AS line_haul_revenue, sum(fuel_surcharge) AS fuel_surcharge, "
             f"sum(accessorial_charges) AS accessorial_charges, {CHARGES} AS total_charges")
TRIP_SUMS = ("count(*) AS trips, sum(actual_distance_miles) AS actual_miles, sum(fuel_gallons_used) AS trip_fuel_gallons, "
             "sum(idle_time_hours) AS idle_hours, count(DISTINCT dispatch_date_key) AS active_days, "
             "count(DISTINCT real_truck) AS active_trucks, count(DISTINCT real_driver) AS active_drivers")
FUEL_SUMS = ("sum(total_cost) AS fuel_cost, sum(gallons) AS gallons_purchased, "
             f"min(CASE WHEN gallons > 0 THEN {d('total_cost')} / {d('gallons')} END) AS lowest_price_paid, "
             f"max(CASE WHEN gallons > 0 THEN {d('total_cost')} / {d('gallons')} END) AS highest_price_paid")
STOP_SUMS = f"""count(*) FILTER (event_type = 'Delivery') AS delivery_events,
    count(*) FILTER (event_type = 'Delivery' AND arrival_status = 'On Time') AS on_time_deliveries,
    count(*) FILTER (event_type = 'Delivery' AND arrival_status = 'Early') AS early_deliveries,
    count(*) FILTER (event_type = 'Delivery' AND arrival_status = 'Late') AS late_deliveries,
    {mean_sql("CASE WHEN event_type = 'Delivery' THEN arrival_variance_minutes END")} AS average_arrival_variance_minutes,
    count(*) AS stop_events, {mean_sql('detention_minutes')} AS average_detention_minutes,
    sum(billable_detention_minutes) AS billable_detention_minutes,
    count(*) FILTER (billable_detention_minutes > 0) AS stops_over_free_time,
    count(*) FILTER (detention_minutes > 0) AS with_detention"""
RATES = (f"{div('on_time_deliveries', 'delivery_events')} AS on_time_rate, "
         f"{div('early_deliveries', 'delivery_events')} AS early_rate, {div('late_deliveries', 'delivery_events')} AS late_rate")

# --- the catalogue, measure group by measure group ------------------------------------------

LOAD_MEASURES = ("loads", "line_haul_revenue", "fuel_surcharge", "accessorial_charges", "total_charges",
                 "contribution_after_fuel", "line_haul_revenue_per_mile", "line_haul_revenue_per_active_truck",
                 "miles_per_active_truck", "loads_per_active_truck", "line_haul_revenue_per_load",
                 "share_of_line_haul_revenue")


def out(columns, counts=(), money=(), rates=()):
    return ", ".join([*columns, *[f"{c} bigint" for c in counts], *[f"{c} double" for c in money],
                      *[f"{c} double" for c in rates]])


@query("measures_load", out(["customer_type string"], ["loads"], LOAD_MEASURES[1:6], LOAD_MEASURES[6:]), f"""
    SELECT g.*, total_charges - f.cost AS contribution_after_fuel, {div('line_haul_revenue', 't.actual_miles')}
               AS line_haul_revenue_per_mile,
           {div('line_haul_revenue', 't.active_trucks')} AS line_haul_revenue_per_active_truck,
           {div('t.actual_miles', 't.active_trucks')} AS miles_per_active_truck,
           {div('loads', 't.active_trucks')} AS loads_per_active_truck,
           {div('line_haul_revenue', 'loads')} AS line_haul_revenue_per_load,
           {div('line_haul_revenue', '(SELECT sum(revenue) FROM live_loads)')} AS share_of_line_haul_revenue
    FROM (SELECT c.customer_type, {LOAD_SUMS} FROM live_loads AS l
          LEFT JOIN dim_customer AS c ON c.customer_key = l.customer_key GROUP BY 1) AS g,
         (SELECT {TRIP_SUMS} FROM live_fact_trips) AS t, (SELECT sum(total_cost) AS cost FROM live_fuel) AS f""")
def measures_load(spark, sf):
    """By customer type; miles, trucks and fuel do not relate to customers and stay totals."""
    return measure_query(star(spark, sf), LOAD_MEASURES, ["customer.customer_type"])


STOP_MEASURES = ("delivery_events", "on_time_deliveries", "early_deliveries", "late_deliveries", "stop_events",
                 "billable_detention_minutes", "stops_over_free_time", "on_time_rate", "early_rate", "late_rate",
                 "average_arrival_variance_minutes", "average_detention_minutes", "share_of_stops_with_detention")


@query("measures_stop", out(["facility_type string"], STOP_MEASURES[:7], (), STOP_MEASURES[7:]), f"""
    SELECT *, {RATES}, {div('with_detention', 'stop_events')} AS share_of_stops_with_detention
    FROM (SELECT facility_type, {STOP_SUMS} FROM live_stops AS s
          LEFT JOIN dim_facility AS f ON f.facility_key = s.facility_key GROUP BY 1)""")
def measures_stop(spark, sf):
    return measure_query(star(spark, sf), STOP_MEASURES, ["facility.facility_type"])


FUEL_MEASURES = ("fuel_cost", "gallons_purchased", "lowest_price_paid", "highest_price_paid", "average_price_per_gallon",
                 "share_of_fuel_spend", "fuel_cost_per_mile")


@query("measures_fuel", out(["location_city string"], (), FUEL_MEASURES[:4], FUEL_MEASURES[4:]), f"""
    SELECT *, {div('fuel_cost', 'gallons_purchased')} AS average_price_per_gallon,
           {div('fuel_cost', '(SELECT sum(total_cost) FROM live_fuel)')} AS share_of_fuel_spend,
           {div('fuel_cost', '(SELECT sum(actual_distance_miles) FROM live_fact_trips)')} AS fuel_cost_per_mile
    FROM (SELECT location_city, {FUEL_SUMS} FROM live_fuel AS f
          LEFT JOIN dim_location AS l ON l.location_key = f.location_key GROUP BY 1)""")
def measures_fuel(spark, sf):
    return measure_query(star(spark, sf), FUEL_MEASURES, ["location.location_city"])


TRIP_MEASURES = ("trips", "actual_miles", "active_days", "active_trucks", "active_drivers", "trip_fuel_gallons",
                 "idle_hours", "drivers_per_truck", "trips_per_active_truck", "gallons_per_mile")
TRIP_RATIOS = (f"{div('active_drivers', 'active_trucks')} AS drivers_per_truck, "
               f"{div('trips', 'active_trucks')} AS trips_per_active_truck")


@query("measures_trip", out(["truck_make string"], TRIP_MEASURES[:5], TRIP_MEASURES[5:7], TRIP_MEASURES[7:]), f"""
    SELECT *, {TRIP_RATIOS}, {div('trip_fuel_gallons', 'actual_miles')} AS gallons_per_mile
    FROM (SELECT d.truck_make, {TRIP_SUMS} FROM live_fact_trips AS f
          LEFT JOIN dim_truck AS d ON d.truck_key = f.truck_key GROUP BY 1)""")
def measures_trip(spark, sf):
    return measure_query(star(spark, sf), TRIP_MEASURES, ["truck.truck_make"])


@query("measures_trip_by_driver", out(["employment_status string"], TRIP_MEASURES[:5], TRIP_MEASURES[5:7],
                                      TRIP_MEASURES[7:]), f"""
    SELECT *, {TRIP_RATIOS}, NULL AS gallons_per_mile
    FROM (SELECT d.employment_status, {TRIP_SUMS} FROM live_fact_trips AS f
          LEFT JOIN dim_driver AS d ON d.driver_key = f.driver_key GROUP BY 1)""")
def measures_trip_by_driver(spark, sf):
    """Gallons per mile is blank as soon as drivers group or filter."""
    return measure_query(star(spark, sf), TRIP_MEASURES, ["driver.employment_status"])


KEEP_MEASURES = ("maintenance_events", "labor_cost", "parts_cost", "maintenance_cost", "downtime_hours",
                 "maintenance_cost_per_mile")
KEEP_SUMS = ("count(*) AS maintenance_events, sum(labor_cost) AS labor_cost, sum(parts_cost) AS parts_cost, "
             "sum(labor_cost) + sum(parts_cost) AS maintenance_cost, sum(downtime_hours) AS downtime_hours")


@query("measures_maintenance", out(["truck_status string"], KEEP_MEASURES[:1], KEEP_MEASURES[1:5], KEEP_MEASURES[5:]), f"""
    SELECT coalesce(m.truck_status, t.truck_status) AS truck_status, m.* EXCLUDE (truck_status),
           {div('maintenance_cost', 't.miles')} AS maintenance_cost_per_mile
    FROM (SELECT d.truck_status, {KEEP_SUMS} FROM live_maintenance AS f
          LEFT JOIN dim_truck AS d ON d.truck_key = f.truck_key GROUP BY 1) AS m
    FULL JOIN (SELECT d.truck_status, sum(actual_distance_miles) AS miles FROM live_fact_trips AS f
          LEFT JOIN dim_truck AS d ON d.truck_key = f.truck_key GROUP BY 1) AS t ON t.truck_status = m.truck_status""")
def measures_maintenance(spark, sf):
    return measure_query(star(spark, sf), KEEP_MEASURES, ["truck.truck_status"])


SAFE_MEASURES = ("incidents", "claim_cost", "preventable_rate", "at_fault_rate")
SAFE_SUMS = """count(*) AS incidents, sum(vehicle_damage_cost) + sum(cargo_damage_cost) AS claim_cost,
    CAST(count(*) FILTER (preventable_status = 'Preventable') AS DOUBLE)
        / nullif(count(*) FILTER (preventable_status <> 'Not Recorded'), 0) AS preventable_rate,
    CAST(count(*) FILTER (at_fault_status = 'At Fault') AS DOUBLE)
        / nullif(count(*) FILTER (at_fault_status <> 'Not Recorded'), 0) AS at_fault_rate"""


@query("measures_safety", out(["incident_category string"], SAFE_MEASURES[:1], SAFE_MEASURES[1:2], SAFE_MEASURES[2:]),
       f"SELECT incident_category, {SAFE_SUMS} FROM live_incidents GROUP BY 1")
def measures_safety(spark, sf):
    return measure_query(star(spark, sf), SAFE_MEASURES, ["incident_class.incident_category"])


@query("measures_customer", "customer_type string, average_credit_terms_days double", f"""
    SELECT customer_type, {mean_sql('credit_terms_days')} AS average_credit_terms_days FROM dim_customer
    WHERE is_current AND customer_key > 0 GROUP BY 1""")
def measures_customer(spark, sf):
    return measure_query(star(spark, sf), ["average_credit_terms_days"], ["customer.customer_type"])


BAND_SQL = """CASE WHEN arrival_variance_minutes BETWEEN -180 AND 360
                   THEN least(CAST(floor(arrival_variance_minutes / 30) * 30 AS INTEGER), 330) END"""


@query("measures_band", "band_start int, arrival_status string, deliveries_in_band bigint, share_of_deliveries_in_band double",
       f"""
    SELECT band_start, arrival_status, count(*) FILTER (event_type = 'Delivery' AND band_start IS NOT NULL) AS deliveries_in_band,
           CAST(count(*) FILTER (event_type = 'Delivery' AND band_start IS NOT NULL) AS DOUBLE)
               / (SELECT count(*) FROM live_stops WHERE event_type = 'Delivery') AS share_of_deliveries_in_band
    FROM (SELECT *, {BAND_SQL} AS band_start FROM live_stops) GROUP BY ALL""")
def measures_band(spark, sf):
    """Deliveries per variance band and status; the share's base ignores both."""
    return measure_query(star(spark, sf), ["deliveries_in_band", "share_of_deliveries_in_band"],
                         ["band.band_start", "delivery_status.arrival_status"])


_ROLES = (("stop_scheduled", "live_stops", "scheduled_date_key", "stop_events"),
          ("stop_actual", "live_stops", "actual_date_key", "stop_events"),
          ("load_dispatch", "live_loads", "dispatched_date_key", "loads"),
          ("load_booked", "live_loads", "booked_date_key", "loads"),
          ("load_pickup", "live_loads", "pickup_date_key", "loads"),
          ("load_delivery", "live_loads", "delivery_date_key", "loads"))


@query("date_role_switch", "role string, year_month_number int, n bigint, trips bigint", " UNION ALL ".join(f"""
    SELECT '{role}' AS role, coalesce(a.m, t.m) AS year_month_number, a.n, t.n AS trips
    FROM (SELECT year_month_number AS m, count(*) AS n FROM {rel} AS f
          LEFT JOIN dim_date AS x ON x.date_key = f.{key} AND x.date_key > 0 GROUP BY 1) AS a
    FULL JOIN (SELECT year_month_number AS m, count(*) AS n FROM live_fact_trips AS f
          LEFT JOIN dim_date AS x ON x.date_key = f.dispatch_date_key AND x.date_key > 0 GROUP BY 1) AS t
      ON t.m IS NOT DISTINCT FROM a.m""" for role, rel, key, _ in _ROLES))
def date_role_switch(spark, sf):
    """A role re-dates the measures of its own fact; trips stay on their dispatch date."""
    s, result = star(spark, sf), None
    for fact in ("delivery_event", "load_lifecycle"):   # each role of a fact reads the same rows
        s.hold(fact, *[key for f, key in DATE_ROLES.values() if f == fact], "is_deleted_in_source")
    s.hold("trip", "dispatch_date_key", "is_deleted_in_source")
    for role, _, _, measure in _ROLES:
        part = measure_query(s, [measure, "trips"], ["date.year_month_number"], date_role=role).select(
            F.lit(role).alias("role"), "year_month_number", F.col(measure).alias("n"), "trips")
        result = part if result is None else result.unionByName(part)
    return result


# --- comparison figures ------------------------------------------------------------------------

CHARGED = ("revenue", "fuel_surcharge", "accessorial_charges")


def live(s, fact, *columns):
    """Columns of a fact's live rows."""
    return s.fact_part(fact, *columns, "is_deleted_in_source").where(~F.col("is_deleted_in_source"))


def deliveries(s, *columns):
    """Columns of live deliveries with their status; the status dimension is a handful of combinations."""
    status = s.dim("delivery_status").where("event_type = 'Delivery'").select("delivery_status_key", "arrival_status")
    return live(s, "delivery_event", *columns, "delivery_status_key").join(status, "delivery_status_key")


def rate(condition):
    return F.count_if(condition).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))


def beside(*rows):
    """One-row frames side by side, each read as a scalar."""
    wide = rows[0]
    for row in rows[1:]:
        packed = row.select(F.struct("*").alias("p")).scalar()
        wide = wide.withColumn("_p", packed).select("*", *[F.col(f"_p.{c}").alias(c) for c in row.columns]).drop("_p")
    return wide


@query("figure_v1_totals", "delivery_events bigint, on_time_rate double, avg_arrival_variance double, total_charges double, "
                           "fuel_cost double, actual_miles bigint", f"""
    SELECT (SELECT count(*) FROM live_stops WHERE event_type = 'Delivery') AS delivery_events,
           (SELECT CAST(count(*) FILTER (arrival_status = 'On Time') AS DOUBLE) / nullif(count(*), 0) FROM live_stops
            WHERE event_type = 'Delivery') AS on_time_rate,
           (SELECT {mean_sql('arrival_variance_minutes')} FROM live_stops WHERE event_type = 'Delivery') AS avg_arrival_variance,
           (SELECT sum(revenue + fuel_surcharge + accessorial_charges) FROM live_loads) AS total_charges,
           (SELECT sum(total_cost) FROM live_fuel) AS fuel_cost,
           (SELECT sum(actual_distance_miles) FROM live_fact_trips) AS actual_miles""")
def figure_v1(spark, sf):
    s = star(spark, sf)
    return beside(
        deliveries(s, "arrival_variance_minutes").agg(
            F.count(F.lit(1)).alias("delivery_events"), rate(F.col("arrival_status") == "On Time").alias("on_time_rate"),
            mean(F.col("arrival_variance_minutes")).alias("avg_arrival_variance")),
        live(s, "load_lifecycle", *CHARGED).agg(
            F.sum(F.col("revenue") + F.col("fuel_surcharge") + F.col("accessorial_charges")).alias("total_charges")),
        live(s, "fuel_purchase", "total_cost").agg(F.sum("total_cost").alias("fuel_cost")),
        live(s, "trip", "actual_distance_miles").agg(F.sum(F.col("actual_distance_miles").cast("bigint")).alias("actual_miles")))


LANE_OUT = ("route_key bigint, route_name string, delivery_events bigint, on_time_rate double, avg_arrival_variance double, "
            "total_charges double, fuel_cost double, contribution_after_fuel double, revenue_per_mile double")
LANE_SQL = f"""
    SELECT r.route_key, r.route_name, d.delivery_events, d.on_time_rate, d.avg_arrival_variance, l.total_charges,
           f.fuel_cost, l.total_charges - f.fuel_cost AS contribution_after_fuel,
           {div('l.revenue', 't.actual_miles')} AS revenue_per_mile
    FROM dim_route AS r
    LEFT JOIN (SELECT route_key, count(*) AS delivery_events,
                      CAST(count(*) FILTER (arrival_status = 'On Time') AS DOUBLE) / nullif(count(*), 0) AS on_time_rate,
                      {mean_sql('arrival_variance_minutes')} AS avg_arrival_variance
               FROM live_stops WHERE event_type = 'Delivery' GROUP BY 1) AS d ON d.route_key = r.route_key
    LEFT JOIN (SELECT route_key, sum(revenue) AS revenue, sum(revenue + fuel_surcharge + accessorial_charges) AS total_charges
               FROM live_loads GROUP BY 1) AS l ON l.route_key = r.route_key
    LEFT JOIN (SELECT route_key, sum(total_cost) AS fuel_cost FROM live_fuel GROUP BY 1) AS f ON f.route_key = r.route_key
    LEFT JOIN (SELECT route_key, sum(actual_distance_miles) AS actual_miles FROM live_fact_trips GROUP BY 1) AS t
      ON t.route_key = r.route_key
    WHERE r.route_key > 0"""


def lanes(s):
    """Four facts aggregated to the lane, then joined on it: the flagship query."""
    charges = F.col("revenue") + F.col("fuel_surcharge") + F.col("accessorial_charges")
    joined = drill_across(
        s.dim("route").where("route_key > 0").select("route_key", "route_name"), "route_key",
        deliveries(s, "route_key", "arrival_variance_minutes").groupBy("route_key").agg(
            F.count(F.lit(1)).alias("delivery_events"), rate(F.col("arrival_status") == "On Time").alias("on_time_rate"),
            mean(F.col("arrival_variance_minutes")).alias("avg_arrival_variance")),
        live(s, "load_lifecycle", "route_key", *CHARGED).groupBy("route_key").agg(
            F.sum("revenue").alias("revenue"), F.sum(charges).alias("total_charges")),
        live(s, "fuel_purchase", "route_key", "total_cost").groupBy("route_key").agg(F.sum("total_cost").alias("fuel_cost")),
        live(s, "trip", "route_key", "actual_distance_miles").groupBy("route_key").agg(
            F.sum(F.col("actual_distance_miles").cast("bigint")).alias("actual_miles")))
    return joined.withColumns({
        "contribution_after_fuel": F.col("total_charges") - F.col("fuel_cost"),
        "revenue_per_mile": ratio(F.col("revenue"), F.col("actual_miles"))})


@query("figure_v2_by_lane", LANE_OUT, LANE_SQL)
def figure_v2(spark, sf):
    return lanes(star(spark, sf))


@query("figure_v3_base", "trips bigint, trip_fuel_gallons double, gallons_purchased double, average_price_per_gallon double, "
                         "lowest_price_paid double, highest_price_paid double, stop_events bigint, "
                         "billable_detention_minutes bigint, events_over_free_time bigint, maintenance_events bigint, "
                         "maintenance_cost double, downtime_hours double, incidents bigint, claim_cost double, "
                         "active_trucks bigint, active_drivers bigint, average_credit_terms_days double, "
                         "delivery_share_with_detention double", f"""
    SELECT t.trips, t.trip_fuel_gallons, f.gallons_purchased, {div('f.fuel_cost', 'f.gallons_purchased')} AS average_price_per_gallon,
           f.lowest_price_paid, f.highest_price_paid, s.stop_events, s.billable_detention_minutes,
           s.stops_over_free_time AS events_over_free_time, m.maintenance_events, m.maintenance_cost, m.downtime_hours,
           i.incidents, i.claim_cost, t.active_trucks, t.active_drivers,
           (SELECT {mean_sql('credit_terms_days')} FROM dim_customer WHERE is_current AND customer_key > 0) AS average_credit_terms_days,
           (SELECT CAST(count(*) FILTER (detention_minutes > 0) AS DOUBLE) / nullif(count(*), 0) FROM live_stops WHERE event_type = 'Delivery')
               AS delivery_share_with_detention
    FROM (SELECT {TRIP_SUMS} FROM live_fact_trips) AS t, (SELECT {FUEL_SUMS} FROM live_fuel) AS f,
         (SELECT {STOP_SUMS} FROM live_stops) AS s, (SELECT {KEEP_SUMS} FROM live_maintenance) AS m,
         (SELECT {SAFE_SUMS} FROM live_incidents) AS i""")
def figure_v3(spark, sf):
    """One row of totals through the measure catalogue, one scan per fact."""
    s = star(spark, sf)
    names = ["trips", "trip_fuel_gallons", "gallons_purchased", "average_price_per_gallon", "lowest_price_paid",
             "highest_price_paid", "stop_events", "billable_detention_minutes", "stops_over_free_time",
             "maintenance_events", "maintenance_cost", "downtime_hours", "incidents", "claim_cost", "active_trucks",
             "active_drivers", "average_credit_terms_days"]
    share = deliveries(s, "detention_minutes").agg(rate(F.col("detention_minutes") > 0).alias("delivery_share_with_detention"))
    return beside(measure_query(s, names).withColumnRenamed("stops_over_free_time", "events_over_free_time"), share)


@query("figure_v4_date_shift", "year_month_number int, by_scheduled bigint, by_actual bigint", """
    SELECT year_month_number, sum(s) AS by_scheduled, sum(a) AS by_actual FROM (
        SELECT scheduled_date_key // 100 AS year_month_number, 1 AS s, 0 AS a FROM live_stops WHERE event_type = 'Delivery'
        UNION ALL SELECT actual_date_key // 100, 0, 1 FROM live_stops WHERE event_type = 'Delivery') GROUP BY 1""")
def figure_v4(spark, sf):
    """Deliveries per scheduled and per actual month: they move, their total does not."""
    s, keys = star(spark, sf), ("scheduled_date_key", "actual_date_key")
    s.hold("delivery_event", *keys, "delivery_status_key", "is_deleted_in_source")
    rows = deliveries(s, *keys)

    def month(key, scheduled):
        m = (F.col(key) - F.pmod(F.col(key), F.lit(100))) / 100
        m = F.when(F.col(key) >= 0, m).otherwise(F.expr(f"{key} div 100"))
        return rows.groupBy(m.cast("int").alias("year_month_number")).agg(F.count(F.lit(1)).alias("n")).select(
            "year_month_number", (F.col("n") if scheduled else F.lit(0)).alias("s"),
            (F.lit(0) if scheduled else F.col("n")).alias("a"))

    both = month("scheduled_date_key", True).unionByName(month("actual_date_key", False))
    return both.groupBy("year_month_number").agg(F.sum("s").alias("by_scheduled"), F.sum("a").alias("by_actual"))


@query("figure_v5_active", "grain string, value string, trips bigint, active_trucks bigint, active_drivers bigint", """
    SELECT 'year' AS grain, CAST(calendar_year AS VARCHAR) AS value, count(*) AS trips,
           count(DISTINCT real_truck) AS active_trucks, count(DISTINCT real_driver) AS active_drivers
    FROM live_fact_trips AS f LEFT JOIN dim_date AS x ON x.date_key = f.dispatch_date_key AND x.date_key > 0 GROUP BY 2
    UNION ALL SELECT 'lane', route_name, count(*), count(DISTINCT real_truck), count(DISTINCT real_driver)
    FROM live_fact_trips AS f JOIN dim_route AS r ON r.route_key = f.route_key GROUP BY 2""")
def figure_v5(spark, sf):
    s, names = star(spark, sf), ["trips", "active_trucks", "active_drivers"]
    s.hold("trip", "dispatch_date_key", "route_key", "truck_key", "driver_key", "is_deleted_in_source")
    year = measure_query(s, names, ["date.calendar_year"]).select(
        F.lit("year").alias("grain"), F.col("calendar_year").cast("string").alias("value"), *names)
    lane = measure_query(s, names, ["route.route_name"]).select(
        F.lit("lane").alias("grain"), F.col("route_name").alias("value"), *names)
    return year.unionByName(lane)


# --- reports -------------------------------------------------------------------------------------

COMPLETE = "JOIN dim_date AS x ON x.date_key = s.scheduled_date_key AND x.date_key > 0 AND x.is_complete_month"


@query("report_on_time_by_lane", out(["route_name string"], STOP_MEASURES[:4], (), STOP_MEASURES[7:11]), f"""
    SELECT *, {RATES} FROM (SELECT r.route_name, {STOP_SUMS} FROM live_stops AS s {COMPLETE}
        JOIN dim_route AS r ON r.route_key = s.route_key GROUP BY 1)""")
def report_on_time(spark, sf):
    """Punctuality per lane, complete months only."""
    return measure_query(star(spark, sf), [*STOP_MEASURES[:4], *STOP_MEASURES[7:11]], ["route.route_name"],
                         [("date.is_complete_month", [True])])


@query("report_variance_histogram", "band_start int, arrival_status string, deliveries_in_band bigint", f"""
    SELECT band_start, arrival_status, count(*) FILTER (event_type = 'Delivery' AND band_start IS NOT NULL) AS deliveries_in_band
    FROM (SELECT s.*, {BAND_SQL} AS band_start FROM live_stops AS s {COMPLETE}) GROUP BY ALL""")
def report_variance_histogram(spark, sf):
    return measure_query(star(spark, sf), ["deliveries_in_band"], ["band.band_start", "delivery_status.arrival_status"],
                         [("date.is_complete_month", [True])])


LANE_TABLE = ("loads", "line_haul_revenue", "fuel_surcharge", "accessorial_charges", "total_charges", "fuel_cost",
              "contribution_after_fuel", "actual_miles", "line_haul_revenue_per_mile", "fuel_cost_per_mile")
LANE_TABLE_OUT = ("route_name string, loads bigint, line_haul_revenue double, fuel_surcharge double, "
                  "accessorial_charges double, total_charges double, fuel_cost double, contribution_after_fuel double, "
                  "actual_miles bigint, line_haul_revenue_per_mile double, fuel_cost_per_mile double")
LANE_TABLE_SQL = f"""
    SELECT n.route_name, l.* EXCLUDE (route_name), f.fuel_cost,
           CASE WHEN l.total_charges IS NOT NULL OR f.fuel_cost IS NOT NULL
                THEN coalesce(l.total_charges, 0) - coalesce(f.fuel_cost, 0) END AS contribution_after_fuel,
           t.actual_miles, {div('l.line_haul_revenue', 't.actual_miles')} AS line_haul_revenue_per_mile,
           {div('f.fuel_cost', 't.actual_miles')} AS fuel_cost_per_mile
    FROM (SELECT DISTINCT route_name FROM dim_route) AS n
    LEFT JOIN (SELECT route_name, {LOAD_SUMS} FROM live_loads JOIN dim_route USING (route_key) GROUP BY 1) AS l USING (route_name)
    LEFT JOIN (SELECT route_name, {FUEL_SUMS} FROM live_fuel JOIN dim_route USING (route_key) GROUP BY 1) AS f USING (route_name)
    LEFT JOIN (SELECT route_name, {TRIP_SUMS} FROM live_fact_trips JOIN dim_route USING (route_key) GROUP BY 1) AS t
        USING (route_name)
    WHERE l.loads IS NOT NULL OR f.fuel_cost IS NOT NULL OR t.trips IS NOT NULL"""


@query("report_contribution_by_lane", LANE_TABLE_OUT, LANE_TABLE_SQL)
def report_contribution(spark, sf):
    """The ten-column lane table."""
    return measure_query(star(spark, sf), LANE_TABLE, ["route.route_name"])


@query("report_top_lanes", "route_name string, contribution_after_fuel double", f"""
    SELECT route_name, contribution_after_fuel FROM ({LANE_TABLE_SQL})
    ORDER BY contribution_after_fuel DESC, route_name LIMIT 10""")
def report_top_lanes(spark, sf):
    """The ranked bars: the ten lanes that contribute most."""
    return (measure_query(star(spark, sf), ["contribution_after_fuel"], ["route.route_name"])
            .orderBy(F.col("contribution_after_fuel").desc_nulls_last(), "route_name").limit(10))


# --- requirements ----------------------------------------------------------------------------------

@query("req_fe1_contribution_after_fuel", LANE_TABLE_OUT, LANE_TABLE_SQL)
def req_fe1(spark, sf):
    return measure_query(star(spark, sf), LANE_TABLE, ["route.route_name"])


def _by(dim, key, column, rel, sums):
    return (f"(SELECT d.{column} AS v, {sums} FROM {rel} AS f LEFT JOIN dim_{dim} AS d ON d.{dim}_key = f.{key} GROUP BY 1)")


ASSET = ("loads", "actual_miles", "line_haul_revenue", "fuel_cost", "maintenance_cost", "fuel_cost_per_mile",
         "maintenance_cost_per_mile")


@query("req_fe2_revenue_cost_per_asset", out(["truck_id bigint"], ASSET[:2], ASSET[2:5], ASSET[5:]), f"""
    SELECT k.v AS truck_id, l.loads, t.actual_miles, l.line_haul_revenue, f.fuel_cost, m.maintenance_cost,
           {div('f.fuel_cost', 't.actual_miles')} AS fuel_cost_per_mile,
           {div('m.maintenance_cost', 't.actual_miles')} AS maintenance_cost_per_mile
    FROM (SELECT v FROM {_by('truck', 'fulfilling_truck_key', 'truck_id', 'live_loads', LOAD_SUMS)}
          UNION SELECT v FROM {_by('truck', 'truck_key', 'truck_id', 'live_fact_trips', TRIP_SUMS)}
          UNION SELECT v FROM {_by('truck', 'truck_key', 'truck_id', 'live_fuel', FUEL_SUMS)}
          UNION SELECT v FROM {_by('truck', 'truck_key', 'truck_id', 'live_maintenance', KEEP_SUMS)}) AS k
    LEFT JOIN {_by('truck', 'fulfilling_truck_key', 'truck_id', 'live_loads', LOAD_SUMS)} AS l ON l.v IS NOT DISTINCT FROM k.v
    LEFT JOIN {_by('truck', 'truck_key', 'truck_id', 'live_fact_trips', TRIP_SUMS)} AS t ON t.v IS NOT DISTINCT FROM k.v
    LEFT JOIN {_by('truck', 'truck_key', 'truck_id', 'live_fuel', FUEL_SUMS)} AS f ON f.v IS NOT DISTINCT FROM k.v
    LEFT JOIN {_by('truck', 'truck_key', 'truck_id', 'live_maintenance', KEEP_SUMS)} AS m ON m.v IS NOT DISTINCT FROM k.v""")
def req_fe2(spark, sf):
    return measure_query(star(spark, sf), ASSET, ["truck.truck_id"])


@query("req_fu1_fuel_spend", "location_city string, year_month_number int, fuel_cost double, gallons_purchased double, "
                             "average_price_per_gallon double, lowest_price_paid double, highest_price_paid double, "
                             "share_of_fuel_spend double", f"""
    WITH g AS (SELECT location_city, year_month_number, {FUEL_SUMS} FROM live_fuel AS f
               LEFT JOIN dim_location AS l ON l.location_key = f.location_key
               LEFT JOIN dim_date AS x ON x.date_key = f.purchase_date_key AND x.date_key > 0 GROUP BY 1, 2)
    SELECT *, {div('fuel_cost', 'gallons_purchased')} AS average_price_per_gallon,
           {d('fuel_cost')} / nullif({d('sum(fuel_cost) OVER (PARTITION BY year_month_number)')}, 0) AS share_of_fuel_spend FROM g""")
def req_fu1(spark, sf):
    """Spend and prices by place and month; the share is of the month's spend in all places."""
    return measure_query(star(spark, sf), ["fuel_cost", "gallons_purchased", "average_price_per_gallon",
                                           "lowest_price_paid", "highest_price_paid", "share_of_fuel_spend"],
                         ["location.location_city", "date.year_month_number"])


@query("req_dp1_on_time_by_lane", out(["route_name string"], STOP_MEASURES[:4], (), STOP_MEASURES[7:11]), f"""
    SELECT *, {RATES} FROM (SELECT r.route_name, {STOP_SUMS} FROM live_stops AS s
        JOIN dim_route AS r ON r.route_key = s.route_key GROUP BY 1)""")
def req_dp1(spark, sf):
    return measure_query(star(spark, sf), [*STOP_MEASURES[:4], *STOP_MEASURES[7:11]], ["route.route_name"])


@query("req_dp2_detention", "facility_name string, event_type string, stop_events bigint, average_detention_minutes double, "
                            "billable_detention_minutes bigint, stops_over_free_time bigint", f"""
    SELECT f.facility_name, s.event_type, {STOP_SUMS} FROM live_stops AS s
    LEFT JOIN dim_facility AS f ON f.facility_key = s.facility_key GROUP BY 1, 2""")
def req_dp2(spark, sf):
    return measure_query(star(spark, sf), ["stop_events", "average_detention_minutes", "billable_detention_minutes",
                                           "stops_over_free_time"],
                         ["facility.facility_name", "delivery_status.event_type"])


@query("req_ma1_maintenance_spend", "maintenance_type string, service_urgency string, calendar_year int, "
                                    "maintenance_events bigint, maintenance_cost double, downtime_hours double", f"""
    SELECT maintenance_type, service_urgency, calendar_year, {KEEP_SUMS} FROM live_maintenance AS m
    LEFT JOIN dim_maintenance_class AS c ON c.maintenance_class_key = m.maintenance_class_key
    LEFT JOIN dim_date AS x ON x.date_key = m.maintenance_date_key AND x.date_key > 0 GROUP BY 1, 2, 3""")
def req_ma1(spark, sf):
    return measure_query(star(spark, sf), ["maintenance_events", "maintenance_cost", "downtime_hours"],
                         ["maintenance_class.maintenance_type", "maintenance_class.service_urgency",
                          "date.calendar_year"])


@query("req_sa1_incident_patterns", "incident_category string, incident_severity string, incident_cause string, "
                                    "years_experience int, incidents bigint, claim_cost double, preventable_rate double, "
                                    "at_fault_rate double", f"""
    SELECT incident_category, incident_severity, incident_cause, years_experience, {SAFE_SUMS}
    FROM live_incidents AS i LEFT JOIN dim_driver AS d ON d.driver_key = i.driver_key GROUP BY 1, 2, 3, 4""")
def req_sa1(spark, sf):
    return measure_query(star(spark, sf), SAFE_MEASURES,
                         ["incident_class.incident_category", "incident_class.incident_severity",
                          "incident_class.incident_cause", "driver.years_experience"])


@query("req_cr1_customer_revenue", "customer_id bigint, loads bigint, line_haul_revenue double, "
                                   "line_haul_revenue_per_load double, share_of_line_haul_revenue double, "
                                   "average_credit_terms_days double", f"""
    SELECT coalesce(g.customer_id, c.customer_id) AS customer_id, loads, line_haul_revenue,
           {div('line_haul_revenue', 'loads')} AS line_haul_revenue_per_load,
           {div('line_haul_revenue', '(SELECT sum(revenue) FROM live_loads)')} AS share_of_line_haul_revenue,
           c.credit_terms_days AS average_credit_terms_days
    FROM (SELECT d.customer_id, {LOAD_SUMS} FROM live_loads AS l
          LEFT JOIN dim_customer AS d ON d.customer_key = l.customer_key GROUP BY 1) AS g
    FULL JOIN (SELECT customer_id, credit_terms_days FROM dim_customer WHERE customer_key > 0) AS c
      ON c.customer_id = g.customer_id""")
def req_cr1(spark, sf):
    return measure_query(star(spark, sf), ["loads", "line_haul_revenue", "line_haul_revenue_per_load",
                                           "share_of_line_haul_revenue", "average_credit_terms_days"],
                         ["customer.customer_id"])


@query("req_ut1_utilisation", "resource string, id bigint, trips bigint, actual_miles bigint, active_days bigint, "
                              "idle_hours double, drivers_per_truck double", f"""
    SELECT 'truck' AS resource, v AS id, trips, actual_miles, active_days, idle_hours,
           {div('active_drivers', 'active_trucks')} AS drivers_per_truck
    FROM {_by('truck', 'truck_key', 'truck_id', 'live_fact_trips', TRIP_SUMS)}
    UNION ALL SELECT 'driver', v, trips, actual_miles, active_days, idle_hours, {div('active_drivers', 'active_trucks')}
    FROM {_by('driver', 'driver_key', 'driver_id', 'live_fact_trips', TRIP_SUMS)}""")
def req_ut1(spark, sf):
    s, names = star(spark, sf), ["trips", "actual_miles", "active_days", "idle_hours", "drivers_per_truck"]
    s.hold("trip", "dispatch_date_key", "truck_key", "driver_key", "actual_distance_miles", "idle_time_hours", "is_deleted_in_source")
    parts = [measure_query(s, names, [f"{r}.{r}_id"]).select(F.lit(r).alias("resource"), F.col(f"{r}_id").alias("id"), *names)
             for r in ("truck", "driver")]
    return parts[0].unionByName(parts[1])
