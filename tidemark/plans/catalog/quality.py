"""Profiling, rules, manifests and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import checks as K
from tidemark.operators import manifests as M
from tidemark.operators import profile as P
from tidemark.operators.batches import gate_batch
from tidemark.operators.rules import cities_in_many_states, event_pairs, rule_checks
from tidemark.operators.segments import segmented
from tidemark.operators.transforms import arrival
from tidemark.plans import landing
from tidemark.plans.contract import FOREIGN_KEYS, TABLES, change_tables, key_of
from tidemark.plans.loading import AS_OF, land_snapshot
from tidemark.plans.oracle import define
from tidemark.plans.registry import query
from tidemark.plans.star import star
from tidemark.plans.trucking import columns, given, source


def n_rows():
    return F.count(F.lit(1))


FLAG = "_is_deleted_in_source"
ALL = " UNION ALL "


def sources(spark, sf):
    """The twelve mapped tables."""
    return {t: source(spark, sf, t) for t in TABLES}


@query("profile_tables", "table_name string, rows bigint, distinct_keys bigint, duplicate_keys bigint, null_keys bigint, "
                         "columns bigint, batches bigint", ALL.join(f"""
    SELECT '{t}' AS table_name, count(*) AS rows, count(DISTINCT {key_of(t)}) AS distinct_keys,
           count(*) - count(DISTINCT {key_of(t)}) AS duplicate_keys, count(*) FILTER ({key_of(t)} IS NULL) AS null_keys,
           {len(columns(t))} AS columns, count(DISTINCT {FLAG}) AS batches FROM raw_{t}""" for t in TABLES))
def profile_tables(spark, sf):
    return P.union_all([P.profile_table(df, t, key_of(t), F.col(FLAG)).withColumnRenamed("table", "table_name")
                        for t, df in sources(spark, sf).items()])


@query("profile_duplicate_content", "table_name string, repeated_rows bigint", ALL.join(f"""
    SELECT '{t}' AS table_name, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE ({key_of(t)}) FROM raw_{t})) AS repeated_rows
    FROM raw_{t}""" for t in TABLES))
def profile_duplicate_content(spark, sf):
    return P.union_all([P.duplicate_content(df, key_of(t)).select(F.lit(t).alias("table_name"), "repeated_rows")
                        for t, df in sources(spark, sf).items()])


@query("profile_columns", "table_name string, column_name string, nulls bigint, null_pct r2, distinct_values bigint, many flag", ALL.join(f"""
    SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls,
           100.0 * count(*) FILTER ({c} IS NULL) / nullif(count(*), 0) AS null_pct,
           CASE WHEN count(DISTINCT {c}) <= {P.FEW_VALUES} THEN count(DISTINCT {c}) END AS distinct_values,
           count(DISTINCT {c}) > {P.FEW_VALUES} AS many FROM raw_{t}""" for t in TABLES for c in columns(t)))
def profile_columns(spark, sf):
    """Every column of the twelve tables; distinct values are counted up to a limit."""
    return P.profile_columns(sources(spark, sf)).withColumnsRenamed(
        {"table": "table_name", "column": "column_name", "distinct": "distinct_values"})


@query("profile_categoricals", "table_name string, column_name string, value string, n bigint", ALL.join(f"""
    SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM raw_{t}
    WHERE (SELECT count(DISTINCT {c}) FROM raw_{t}) BETWEEN 2 AND 25 GROUP BY 3""" for t in TABLES for c in columns(t, "text", "flag")))
def profile_categoricals(spark, sf):
    return P.profile_categoricals(sources(spark, sf)).withColumnsRenamed({"table": "table_name", "column": "column_name"})


def _measures(t):
    return [c for c in columns(t, "int", "long", "decimal") if not c.endswith(P.ID_SUFFIXES)]


@query("profile_numeric", "table_name string, column_name string, min double, max double, mean r4, stddev r4, negatives bigint, "
                          "zeros bigint, nulls bigint, zero_pct r2", ALL.join(f"""
    SELECT '{t}' AS table_name, '{c}' AS column_name, min({c}) AS min, max({c}) AS max, avg(CAST({c} AS DOUBLE)) AS mean,
           stddev_samp(CAST({c} AS DOUBLE)) AS stddev, count(*) FILTER ({c} < 0) AS negatives,
           count(*) FILTER ({c} = 0) AS zeros, count(*) FILTER ({c} IS NULL) AS nulls,
           100.0 * count(*) FILTER ({c} = 0) / count(*) AS zero_pct FROM raw_{t}""" for t in TABLES for c in _measures(t)))
def profile_numeric(spark, sf):
    return P.union_all([P.profile_numeric(df).withColumn("table_name", F.lit(t)) for t, df in sources(spark, sf).items()]) \
        .withColumnRenamed("column", "column_name")


@query("profile_outliers", "column_name string, q1 r6, median r6, q3 r6, lower_fence r6, upper_fence r6, "
                           "iqr_outliers bigint, z3_outliers bigint, skew_indicator r4", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence,
           (SELECT count(*) FROM raw_fuel_purchases WHERE CAST({c} AS DOUBLE) < q1 - 1.5 * (q3 - q1)
                OR CAST({c} AS DOUBLE) > q3 + 1.5 * (q3 - q1)) AS iqr_outliers,
           (SELECT count(*) FROM raw_fuel_purchases WHERE sd > 0 AND abs(CAST({c} AS DOUBLE) - mean) > 3 * sd) AS z3_outliers,
           (mean - median) / nullif(sd, 0) AS skew_indicator
    FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median,
                 quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, avg(CAST({c} AS DOUBLE)) AS mean,
                 stddev_samp(CAST({c} AS DOUBLE)) AS sd FROM raw_fuel_purchases)""" for c in ("gallons", "total_cost")))
def profile_outliers(spark, sf):
    """Exact quartiles and fences of the purchase measures."""
    out = P.profile_outliers(source(spark, sf, "fuel_purchases"), ["gallons", "total_cost"])
    return out.withColumnRenamed("column", "column_name")


@query("profile_dates", "table_name string, column_name string, min ts, max ts, distinct_dates bigint, rows_per_date double, "
                        "future_dated bigint, nulls bigint", ALL.join(f"""
    SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(min({c}) AS TIMESTAMP) AS min, CAST(max({c}) AS TIMESTAMP) AS max,
           count(DISTINCT CAST({c} AS DATE)) AS distinct_dates,
           round(CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT CAST({c} AS DATE)), 0), 1) AS rows_per_date,
           count(*) FILTER (CAST({c} AS DATE) > DATE '2001-01-01') AS future_dated,
           count(*) FILTER ({c} IS NULL) AS nulls FROM raw_{t}""" for t in TABLES for c in columns(t, "date", "ts")))
def profile_dates(spark, sf):
    """Every date and timestamp of the twelve tables."""
    today = F.lit("2001-01-01").cast("date")
    return P.union_all([P.profile_dates(df, columns(t, "date", "ts"), today).withColumn("table_name", F.lit(t))
                        for t, df in sources(spark, sf).items() if columns(t, "date", "ts")]).withColumnRenamed("column", "column_name")


@query("profile_continuity", "first_day date, last_day date, span_days bigint, days_present bigint, days_missing bigint, "
                             "min_per_day bigint, avg_per_day r4, max_per_day bigint", """
    SELECT min(d) AS first_day, max(d) AS last_day, date_diff('day', min(d), max(d)) + 1 AS span_days,
           count(*) AS days_present, date_diff('day', min(d), max(d)) + 1 - count(*) AS days_missing,
           min(n) AS min_per_day, avg(CAST(n AS DOUBLE)) AS avg_per_day, max(n) AS max_per_day
    FROM (SELECT load_date AS d, count(*) AS n FROM raw_loads WHERE load_date IS NOT NULL GROUP BY 1)""")
def profile_continuity(spark, sf):
    return P.continuity(source(spark, sf, "loads"), "load_date")


@query("profile_monthly_volume", "month string, rows bigint", """
    SELECT strftime(actual_datetime, '%Y-%m') AS month, count(*) AS rows FROM raw_delivery_events
    WHERE actual_datetime IS NOT NULL GROUP BY 1""")
def profile_monthly_volume(spark, sf):
    return P.monthly_volume(source(spark, sf, "delivery_events"), "actual_datetime")


@query("profile_referential_integrity", "child string, column_name string, parent string, rows bigint, nulls bigint, "
                                        "null_pct r2, orphans bigint, orphan_pct r2", " UNION ALL ".join(f"""
    SELECT '{c}' AS child, '{k}' AS column_name, '{p}' AS parent, count(*) AS rows,
           count(*) FILTER (c.{k} IS NULL) AS nulls, 100.0 * count(*) FILTER (c.{k} IS NULL) / count(*) AS null_pct,
           count(*) FILTER (c.{k} IS NOT NULL AND p.{key_of(p)} IS NULL) AS orphans,
           100.0 * count(*) FILTER (c.{k} IS NOT NULL AND p.{key_of(p)} IS NULL) / count(*) AS orphan_pct
    FROM raw_{c} AS c LEFT JOIN raw_{p} AS p ON p.{key_of(p)} = c.{k}""" for c, k, p in FOREIGN_KEYS))
def profile_referential_integrity(spark, sf):
    """The sixteen foreign keys, NULLs apart from orphans; each table is read once."""
    tables = sources(spark, sf)
    return P.reference_checks(tables, {t: key_of(t) for t in tables}, FOREIGN_KEYS).withColumnRenamed("column", "column_name")


_MANY_STATES = """(SELECT count(*) FROM (SELECT location_city FROM raw_{t} GROUP BY 1 HAVING count(DISTINCT location_state) > 1))"""
define("event_pairs", """
    SELECT load_id, max(CASE WHEN event_type = 'Pickup' THEN actual_datetime END) AS picked,
           max(CASE WHEN event_type = 'Delivery' THEN actual_datetime END) AS delivered,
           count(*) AS n_events, count(DISTINCT event_type) AS n_kinds FROM raw_delivery_events GROUP BY load_id""")
_TRUCKS = "JOIN raw_trucks AS t ON t.truck_id = m.truck_id"


@query("rule_checks", "check_name string, failures bigint, severity string", f"""
    SELECT 'claim = vehicle + cargo damage' AS check_name, count(*) AS failures, 'quarantine' AS severity
    FROM raw_safety_incidents WHERE abs(claim_amount - (vehicle_damage_cost + cargo_damage_cost)) > 0.01
    UNION ALL SELECT 'maintenance total = labour + parts', count(*), 'quarantine' FROM raw_maintenance_records
    WHERE abs(total_cost - (labor_cost + parts_cost)) > 0.01
    UNION ALL SELECT 'fuel cost = gallons x price', count(*), 'quarantine' FROM raw_fuel_purchases
    WHERE abs(total_cost - gallons * price_per_gallon) > 0.05
    UNION ALL SELECT 'fuel purchase exceeds tank capacity', count(*), 'quarantine' FROM raw_fuel_purchases AS m {_TRUCKS}
    WHERE m.gallons > t.tank_capacity_gallons
    UNION ALL SELECT 'service odometer below acquisition mileage', count(*), 'quarantine'
    FROM raw_maintenance_records AS m {_TRUCKS} WHERE m.odometer_reading < t.acquisition_mileage
    UNION ALL SELECT 'idle time exceeds trip duration', count(*), 'quarantine' FROM raw_trips
    WHERE idle_time_hours > actual_duration_hours
    UNION ALL SELECT 'reported mpg disagrees with distance / gallons', count(*), 'quarantine' FROM raw_trips
    WHERE fuel_gallons_used > 0 AND abs(average_mpg - CAST(actual_distance_miles AS DOUBLE) / fuel_gallons_used) > 0.5
    UNION ALL SELECT 'trip dispatched before load booked', count(*), 'quarantine'
    FROM raw_trips AS t JOIN raw_loads AS l ON l.load_id = t.load_id WHERE t.dispatch_date < l.load_date
    UNION ALL SELECT 'maintenance before truck acquired', count(*), 'quarantine'
    FROM raw_maintenance_records AS m {_TRUCKS} WHERE m.maintenance_date < t.acquisition_date
    UNION ALL SELECT 'incident outside driver employment period', count(*), 'quarantine'
    FROM raw_safety_incidents AS s JOIN raw_drivers AS d ON d.driver_id = s.driver_id
    WHERE CAST(s.incident_date AS DATE) < d.hire_date OR CAST(s.incident_date AS DATE) > d.termination_date
    UNION ALL SELECT 'driver terminated before hired', count(*), 'fail' FROM raw_drivers WHERE termination_date < hire_date
    UNION ALL SELECT 'active driver has a termination date', count(*), 'quarantine' FROM raw_drivers
    WHERE employment_status = 'Active' AND termination_date IS NOT NULL
    UNION ALL SELECT 'inactive driver has no termination date', count(*), 'quarantine' FROM raw_drivers
    WHERE employment_status <> 'Active' AND termination_date IS NULL
    UNION ALL SELECT 'safety_incidents: city mapped to multiple states', {_MANY_STATES.format(t='safety_incidents')}, 'document'
    UNION ALL SELECT 'fuel_purchases: city mapped to multiple states', {_MANY_STATES.format(t='fuel_purchases')}, 'document'
    UNION ALL SELECT 'delivery_events: city mapped to multiple states', {_MANY_STATES.format(t='delivery_events')}, 'document'
    UNION ALL SELECT 'load without exactly one trip', count(*), 'fail' FROM (
        SELECT l.load_id FROM raw_loads AS l LEFT JOIN raw_trips AS t ON t.load_id = l.load_id
        GROUP BY l.load_id HAVING count(t.trip_id) <> 1)
    UNION ALL SELECT 'load without exactly one pickup and one delivery', count(*), 'fail' FROM event_pairs
    WHERE n_kinds <> 2 OR n_events <> 2
    UNION ALL SELECT 'delivery recorded before its pickup', count(*), 'fail' FROM event_pairs WHERE delivered < picked""")
def rules(spark, sf):
    """The nineteen checks; all rules over one frame share a pass."""
    names = ("safety_incidents", "maintenance_records", "fuel_purchases", "trips", "drivers", "loads", "trucks",
             "delivery_events")
    return rule_checks({n: source(spark, sf, n) for n in names})


@query("profile_free_text", "column_name string, non_null bigint, distinct_values bigint, min_len int, avg_len r4, "
                            "max_len int, top_value string, top_n bigint", """
    SELECT 'description' AS column_name, count(description) AS non_null, count(DISTINCT description) AS distinct_values,
           min(length(description)) AS min_len, avg(length(description)) AS avg_len, max(length(description)) AS max_len,
           (SELECT description FROM raw_safety_incidents GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_value,
           (SELECT count(*) FROM raw_safety_incidents GROUP BY description ORDER BY count(*) DESC LIMIT 1) AS top_n
    FROM raw_safety_incidents""")
def profile_free_text(spark, sf):
    df = source(spark, sf, "safety_incidents")
    top = P.top_values(df, "description", 1).select(F.struct("description", "n").alias("t")).scalar()
    out = P.profile_text(df, "description").withColumn("_t", top)
    return out.select(F.lit("description").alias("column_name"), "non_null", F.col("distinct").alias("distinct_values"),
                      "min_len", "avg_len", "max_len", F.col("_t.description").alias("top_value"),
                      F.col("_t.n").alias("top_n"))


@query("profile_top_values", "description string, n bigint", """
    SELECT description, count(*) AS n FROM raw_safety_incidents GROUP BY 1 ORDER BY n DESC, description LIMIT 20""")
def profile_top_values(spark, sf):
    return P.top_values(source(spark, sf, "safety_incidents"), "description")


# --- derived profiles ------------------------------------------------------------------

@query("crosstab_share", "customer_type string, booking_type string, loads bigint, pct_of_type double", """
    SELECT *, round(100.0 * loads / sum(loads) OVER (PARTITION BY customer_type), 1) AS pct_of_type
    FROM (SELECT c.customer_type, l.booking_type, count(*) AS loads
          FROM raw_loads AS l JOIN raw_customers AS c ON c.customer_id = l.customer_id GROUP BY ALL)""")
def crosstab_share(spark, sf):
    # Loads are counted per customer before they meet the customer.
    loads = source(spark, sf, "loads").groupBy("customer_id", "booking_type").agg(n_rows().alias("n"))
    cells = (loads.join(source(spark, sf, "customers").select("customer_id", "customer_type"), "customer_id")
             .groupBy("customer_type", "booking_type").agg(F.sum("n").alias("loads")))
    totals = cells.groupBy(F.col("customer_type").alias("_t")).agg(F.sum("loads").alias("total"))
    return cells.join(totals, F.col("customer_type").eqNullSafe(F.col("_t"))).withColumn(
        "pct_of_type", F.round(100.0 * F.col("loads") / F.col("total"), 1))


@query("values_used_per_member", "booking_types_used bigint, customers bigint", """
    SELECT booking_types_used, count(*) AS customers FROM (
        SELECT c.customer_id, count(DISTINCT l.booking_type) AS booking_types_used
        FROM raw_loads AS l JOIN raw_customers AS c ON c.customer_id = l.customer_id GROUP BY 1) GROUP BY 1""")
def values_used_per_member(spark, sf):
    used = source(spark, sf, "loads").groupBy("customer_id").agg(F.countDistinct("booking_type").alias("booking_types_used"))
    return (used.join(source(spark, sf, "customers"), "customer_id", "left_semi")
            .groupBy("booking_types_used").agg(n_rows().alias("customers")))


def _fills(spark, sf):
    """Purchases counted per truck and gallons, with the truck's tank: few rows even for a hot truck."""
    fills = source(spark, sf, "fuel_purchases").groupBy("truck_id", "gallons").agg(n_rows().alias("n"))
    return fills.join(source(spark, sf, "trucks").select("truck_id", "tank_capacity_gallons"), "truck_id")


@query("impossible_fills", "impossible_fills bigint", f"""
    SELECT count(*) AS impossible_fills FROM raw_fuel_purchases AS m {_TRUCKS} WHERE m.gallons > t.tank_capacity_gallons""")
def impossible_fills(spark, sf):
    return _fills(spark, sf).where(F.col("gallons") > F.col("tank_capacity_gallons")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("impossible_fills"))


_MINUTES = "((epoch_us(actual_datetime) - epoch_us(scheduled_datetime)) / 60000000.0)"


def _minutes():
    return (F.unix_micros("actual_datetime") - F.unix_micros("scheduled_datetime")).cast("double") / 60000000.0


@query("detention_vs_variance_gap", "events bigint, exact_match bigint, avg_gap r2", f"""
    SELECT count(*) AS events, count(*) FILTER (detention_minutes = {_MINUTES}) AS exact_match,
           avg(abs(detention_minutes - {_MINUTES})) AS avg_gap FROM raw_delivery_events""")
def detention_vs_variance_gap(spark, sf):
    d = F.col("detention_minutes").cast("double")
    return source(spark, sf, "delivery_events").agg(
        n_rows().alias("events"), F.count_if(d == _minutes()).alias("exact_match"),
        F.avg(F.abs(d - _minutes())).alias("avg_gap"))


@query("corr_independence", "correlation r4", f"""
    SELECT corr(CAST(detention_minutes AS DOUBLE), {_MINUTES}) AS correlation FROM raw_delivery_events""")
def corr_independence(spark, sf):
    return source(spark, sf, "delivery_events").agg(
        F.corr(F.col("detention_minutes").cast("double"), _minutes()).alias("correlation"))


@query("flag_profile", "on_time_flag flag, events bigint, avg_variance r2, min_variance r2, max_variance r2, "
                       "avg_detention r2", f"""
    SELECT on_time_flag, count(*) AS events, avg({_MINUTES}) AS avg_variance, min({_MINUTES}) AS min_variance,
           max({_MINUTES}) AS max_variance, avg(detention_minutes) AS avg_detention
    FROM raw_delivery_events GROUP BY on_time_flag""")
def flag_profile(spark, sf):
    return source(spark, sf, "delivery_events").groupBy("on_time_flag").agg(
        n_rows().alias("events"), F.avg(_minutes()).alias("avg_variance"), F.min(_minutes()).alias("min_variance"),
        F.max(_minutes()).alias("max_variance"), F.avg("detention_minutes").alias("avg_detention"))


@query("billable_summary", "events bigint, over_free_time bigint, billable_minutes bigint", """
    SELECT count(*) AS events, count(*) FILTER (detention_minutes > 120) AS over_free_time,
           sum(greatest(detention_minutes - 120, 0)) AS billable_minutes FROM raw_delivery_events""")
def billable_summary(spark, sf):
    d = F.col("detention_minutes")
    return source(spark, sf, "delivery_events").agg(
        n_rows().alias("events"), F.count_if(d > 120).alias("over_free_time"),
        F.sum(F.greatest(d - 120, F.lit(0))).alias("billable_minutes"))


@query("city_multi_state", "table_name string, location_city string, states bigint", " UNION ALL ".join(f"""
    SELECT '{t}' AS table_name, location_city, count(DISTINCT location_state) AS states FROM raw_{t}
    GROUP BY location_city HAVING count(DISTINCT location_state) > 1"""
                                                   for t in ("safety_incidents", "fuel_purchases", "delivery_events")))
def city_multi_state(spark, sf):
    return P.union_all([cities_in_many_states(source(spark, sf, t)).select(F.lit(t).alias("table_name"), "*")
                        for t in ("safety_incidents", "fuel_purchases", "delivery_events")])


@query("impossible_by_duration", "duration_hrs int, trips bigint, impossible bigint", """
    SELECT CAST(round(actual_duration_hours) AS INTEGER) AS duration_hrs, count(*) AS trips,
           count(*) FILTER (idle_time_hours > actual_duration_hours) AS impossible FROM raw_trips GROUP BY 1""")
def impossible_by_duration(spark, sf):
    return source(spark, sf, "trips").groupBy(F.round("actual_duration_hours").alias("duration_hrs")).agg(
        n_rows().alias("trips"), F.count_if(F.col("idle_time_hours") > F.col("actual_duration_hours")).alias("impossible"))


@query("plausible_swap", "plausible_swap bigint", """
    SELECT count(*) AS plausible_swap FROM event_pairs AS e JOIN raw_trips AS t ON t.load_id = e.load_id
    WHERE e.delivered < e.picked AND (epoch_us(e.picked) - epoch_us(e.delivered)) / 3600000000.0
          BETWEEN CAST(t.actual_duration_hours AS DOUBLE) * 0.8 AND CAST(t.actual_duration_hours AS DOUBLE) * 1.2""")
def plausible_swap(spark, sf):
    """Reversed loads whose gap is about the trip's duration."""
    pairs = event_pairs(source(spark, sf, "delivery_events")).where("delivered < picked")
    gap = (F.unix_micros("picked") - F.unix_micros("delivered")).cast("double") / 3600000000.0
    hours = F.col("actual_duration_hours").cast("double")
    return (pairs.join(source(spark, sf, "trips"), "load_id").where(gap.between(hours * 0.8, hours * 1.2))
            .agg(n_rows().alias("plausible_swap")))


@query("reversal_stats", "affected_loads bigint, avg_reversal_hrs r4, worst_reversal_hrs r4", """
    SELECT count(*) AS affected_loads, avg((epoch_us(picked) - epoch_us(delivered)) / 3600000000.0) AS avg_reversal_hrs,
           max((epoch_us(picked) - epoch_us(delivered)) / 3600000000.0) AS worst_reversal_hrs
    FROM event_pairs WHERE delivered < picked""")
def reversal_stats(spark, sf):
    gap = (F.unix_micros("picked") - F.unix_micros("delivered")).cast("double") / 3600000000.0
    return event_pairs(source(spark, sf, "delivery_events")).where("delivered < picked").agg(
        n_rows().alias("affected_loads"), F.avg(gap).alias("avg_reversal_hrs"), F.max(gap).alias("worst_reversal_hrs"))


@query("impossible_by_tank", "tank int, purchases bigint, impossible bigint, pct r2, min_fill double, avg_fill r4, "
                             "largest_fill double", f"""
    SELECT t.tank_capacity_gallons AS tank, count(*) AS purchases,
           count(*) FILTER (m.gallons > t.tank_capacity_gallons) AS impossible,
           100.0 * count(*) FILTER (m.gallons > t.tank_capacity_gallons) / count(*) AS pct, min(m.gallons) AS min_fill,
           avg(CAST(m.gallons AS DOUBLE)) AS avg_fill, max(m.gallons) AS largest_fill
    FROM raw_fuel_purchases AS m {_TRUCKS} GROUP BY 1""")
def impossible_by_tank(spark, sf):
    n, g = F.col("n"), F.col("gallons").cast("double")
    over = F.sum(F.when(F.col("gallons") > F.col("tank_capacity_gallons"), n).otherwise(0))
    return _fills(spark, sf).groupBy(F.col("tank_capacity_gallons").alias("tank")).agg(
        F.sum(n).alias("purchases"), over.alias("impossible"), (100.0 * over / F.sum(n)).alias("pct"),
        F.min("gallons").alias("min_fill"), (F.sum(g * n) / F.sum(n)).alias("avg_fill"),
        F.max("gallons").alias("largest_fill"))


@query("seasonality_daily", "month_of_year int, avg_loads_per_day r4, deviation r4, min_day bigint, max_day bigint", """
    SELECT month(load_date) AS month_of_year, avg(CAST(n AS DOUBLE)) AS avg_loads_per_day,
           stddev_samp(CAST(n AS DOUBLE)) AS deviation, min(n) AS min_day, max(n) AS max_day
    FROM (SELECT load_date, count(*) AS n FROM raw_loads GROUP BY 1) GROUP BY 1""")
def seasonality_daily(spark, sf):
    n = F.col("n").cast("double")
    return P.daily_counts(source(spark, sf, "loads"), "load_date").groupBy(F.month("day").alias("month_of_year")).agg(
        F.avg(n).alias("avg_loads_per_day"), F.stddev(n).alias("deviation"), F.min("n").alias("min_day"),
        F.max("n").alias("max_day"))


@query("service_interval_buckets", "miles_bucket int, events bigint, emergencies bigint, emergency_pct r2", """
    SELECT CAST(floor(m / 10000.0) * 10000 AS INTEGER) AS miles_bucket, count(*) AS events,
           count(*) FILTER (service_urgency = 'Emergency') AS emergencies,
           100.0 * count(*) FILTER (service_urgency = 'Emergency') / count(*) AS emergency_pct
    FROM (SELECT service_urgency, odometer_reading - lag(odometer_reading) OVER (
              PARTITION BY truck_id ORDER BY maintenance_date, maintenance_id) AS m
          FROM silver_maintenance_records WHERE truck_id IS NOT NULL) WHERE m > 0 GROUP BY 1""")
def service_interval_buckets(spark, sf):
    """Emergency share by miles since the last service of the truck."""
    rows = star(spark, sf).current("maintenance_records").where("truck_id IS NOT NULL").select(
        "truck_id", "maintenance_date", "maintenance_id", "odometer_reading", "service_urgency")
    rows = segmented(rows, ["truck_id"], ["maintenance_date", "maintenance_id"],
                     lag={"before": F.col("odometer_reading")})
    miles = F.col("odometer_reading") - F.col("before")
    urgent = F.count_if(F.col("service_urgency") == "Emergency")
    return rows.where(miles > 0).groupBy((F.floor(miles / 10000) * 10000).alias("miles_bucket")).agg(
        n_rows().alias("events"), urgent.alias("emergencies"), (100.0 * urgent / n_rows()).alias("emergency_pct"))


@query("urgency_costs", "service_urgency string, events bigint, avg_cost r4, avg_labor_hours r4, avg_downtime r4, "
                        "avg_parts r4", """
    SELECT service_urgency, count(*) AS events, avg(CAST(total_cost AS DOUBLE)) AS avg_cost,
           avg(CAST(labor_hours AS DOUBLE)) AS avg_labor_hours, avg(CAST(downtime_hours AS DOUBLE)) AS avg_downtime,
           avg(CAST(parts_cost AS DOUBLE)) AS avg_parts FROM silver_maintenance_records GROUP BY 1""")
def urgency_costs(spark, sf):
    def mean(c):
        return F.avg(F.col(c).cast("double"))
    return star(spark, sf).current("maintenance_records").groupBy("service_urgency").agg(
        n_rows().alias("events"), mean("total_cost").alias("avg_cost"), mean("labor_hours").alias("avg_labor_hours"),
        mean("downtime_hours").alias("avg_downtime"), mean("parts_cost").alias("avg_parts"))


@query("odometer_buckets", "odometer_bucket int, events bigint, emergency_pct r2, avg_cost r4", """
    SELECT CAST(floor(odometer_reading / 100000.0) * 100000 AS INTEGER) AS odometer_bucket, count(*) AS events,
           100.0 * count(*) FILTER (service_urgency = 'Emergency') / count(*) AS emergency_pct,
           avg(CAST(total_cost AS DOUBLE)) AS avg_cost FROM silver_maintenance_records GROUP BY 1""")
def odometer_buckets(spark, sf):
    urgent = F.count_if(F.col("service_urgency") == "Emergency")
    return star(spark, sf).current("maintenance_records").groupBy(
        (F.floor(F.col("odometer_reading") / 100000) * 100000).alias("odometer_bucket")).agg(
        n_rows().alias("events"), (100.0 * urgent / n_rows()).alias("emergency_pct"),
        F.avg(F.col("total_cost").cast("double")).alias("avg_cost"))


@query("cost_by_model_year", "model_year int, events bigint, avg_cost r4, avg_downtime r4", f"""
    SELECT t.model_year, count(*) AS events, avg(CAST(m.total_cost AS DOUBLE)) AS avg_cost,
           avg(CAST(m.downtime_hours AS DOUBLE)) AS avg_downtime
    FROM raw_maintenance_records AS m {_TRUCKS} GROUP BY 1""")
def cost_by_model_year(spark, sf):
    # Totals per truck first, so a truck with very many services joins as one row.
    per_truck = source(spark, sf, "maintenance_records").groupBy("truck_id").agg(
        n_rows().alias("n"), F.sum("total_cost").alias("cost"), F.sum("downtime_hours").alias("down"))
    years = source(spark, sf, "trucks").select("truck_id", "model_year")
    n = F.sum("n")
    return per_truck.join(years, "truck_id").groupBy("model_year").agg(
        n.alias("events"), (F.sum("cost").cast("double") / n).alias("avg_cost"),
        (F.sum("down").cast("double") / n).alias("avg_downtime"))


# --- manifests, files and gates -----------------------------------------------------------

def judged(spark, sf):
    return M.problems(M.parse(landing.manifests(spark, sf)), list(TABLES), change_tables())


@query("validate_manifest", "seq bigint, problems string, is_valid flag",
       "SELECT seq, coalesce(problems, '') AS problems, problems IS NULL AS is_valid FROM landed_manifests")
def validate_manifest(spark, sf):
    """Every manifest against the whole rule list, content hash recomputed."""
    return judged(spark, sf).select(F.col("folder_seq").alias("seq"), F.array_join("problems", "; ").alias("problems"),
                                    "is_valid")


@query("validate_layout_files", "problem string, files bigint", """
    SELECT CASE seq % 6 WHEN 1 THEN 'missing file' WHEN 2 THEN 'size' WHEN 3 THEN 'sha256' WHEN 4 THEN 'not read' END
               AS problem, count(*) AS files
    FROM landed_manifests WHERE seq % 20 <> 3 AND seq % 6 BETWEEN 1 AND 4 GROUP BY 1
    UNION ALL SELECT 'extra file', count(*) FROM landed_manifests WHERE seq % 20 <> 3 AND seq % 6 = 5""")
def validate_layout_files(spark, sf):
    """What the manifests list against what a listing found, with planted differences."""
    listed = M.manifest_files(M.parse(landing.manifests(spark, sf)))
    kind = F.regexp_extract("folder", r"(\d+)$", 1).cast("bigint") % 6
    found = listed.where(kind != 1).select(
        "folder", "path", F.when(kind == 2, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"),
        F.when(kind == 3, F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"),
        (kind != 4).alias("complete"))
    extra = listed.where(kind == 5).select("folder", F.concat("path", F.lit(".copy")).alias("path"), "bytes", "sha256",
                                           F.lit(True).alias("complete"))
    return M.file_problems(listed, found.unionByName(extra)).groupBy("problem").agg(n_rows().alias("files"))


@query("validate_frame", "table_name string, problem string, n bigint", """
    SELECT 'loads' AS table_name, 'row_count' AS problem, 1 AS n
    UNION ALL SELECT 'loads', 'null_keys', count(*) FROM raw_loads WHERE load_id % 100 = 1
    UNION ALL SELECT 'loads', 'repeated_keys', count(*) FROM raw_loads WHERE load_id % 100 = 3""")
def validate_frame(spark, sf):
    """Planted: one row too many declared less, NULL keys, repeated keys."""
    loads = source(spark, sf, "loads")
    key = F.col("load_id")
    frame = loads.where(key % 100 != 3).withColumn("load_id", F.when(key % 100 != 1, key)).unionByName(
        loads.where(key % 100 == 3)).unionByName(loads.where(key % 100 == 3))
    declared = frame.agg((n_rows() - 1).alias("n")).scalar()
    return M.frame_problems(frame, "loads", "load_id", frame.schema.simpleString(), declared) \
        .withColumnRenamed("table", "table_name")


# What the planted damage breaks, besides what can't be judged behind it.
_BROKEN = (("*", "batch_layout"), ("facilities", "files"), ("routes", "files"), ("routes", "readable"), ("trailers", "schema_vs_contract"),
           ("trucks", "schema_vs_bronze"), ("loads", "count_vs_manifest"), ("trips", "count_vs_source"), ("fuel_purchases", "count_vs_silver"),
           ("fuel_purchases", "keys_vs_silver"), ("maintenance_records", "key_not_null"), ("maintenance_records", "keys_vs_silver"),
           ("delivery_events", "key_unique"), ("delivery_events", "count_vs_source"), ("delivery_events", "count_vs_silver"))


def _values(rows):
    return ", ".join(str(r) if len(r) > 1 else f"('{r[0]}')" for r in rows)


@query("gate_checks", "as_of string, table_name string, check_name string, ok flag", f"""
    SELECT '{AS_OF}' AS as_of, t AS table_name, c AS check_name, (t, c) NOT IN (VALUES {_values(_BROKEN)}) AS ok
    FROM (SELECT * FROM (VALUES {_values([(t,) for t in TABLES])}) AS x(t), (VALUES {_values([(c,) for c in M.GATE_CHECKS[2:]])}) AS y(c)
          UNION ALL VALUES ('*', 'manifest'), ('*', 'batch_layout'))
    WHERE t <> 'routes' OR c IN ('files', 'readable')
    UNION ALL SELECT 'another day', '*', 'manifest', FALSE""")
def gate_checks(spark, sf):
    """The twelve checks of a landed snapshot of the twelve tables, each of which fails somewhere."""
    folder, tables = land_snapshot(spark, sf)
    judged = {day: gate_batch(spark, folder, tables, change_tables(), day) for day in (AS_OF, "another day")}
    return P.union_all([df.withColumnRenamed("table", "table_name").withColumn("as_of", F.lit(day)) for day, df in judged.items()])


def _contracted(spark, sf, table):
    return source(spark, sf, table).withColumn("_source_changed_at", F.col("load_date").cast("timestamp"))


@query("fingerprint_compare", "table_name string, rows_a bigint, rows_b bigint", """
    SELECT 'loads' AS table_name, count(*) AS rows_a, count(*) FILTER (load_id % 10 <> 0) AS rows_b FROM raw_loads""")
def fingerprint_compare(spark, sf):
    """A copy that lags behind is stale; an equal one is not listed."""
    loads = _contracted(spark, sf, "loads")
    a = K.fingerprint(loads, "loads").unionByName(K.fingerprint(loads, "loads_again"))
    b = K.fingerprint(loads.where("load_id % 10 <> 0"), "loads").unionByName(K.fingerprint(loads, "loads_again"))
    return K.stale_copies(a, b).withColumnRenamed("table", "table_name")


@query("silver_contract_check", "table_name string, rows bigint, keys bigint, null_contract bigint, live bigint, "
                                "expected_live bigint, ok flag", """
    SELECT 'loads' AS table_name, count(*) AS rows, count(DISTINCT load_id) AS keys, 0 AS null_contract,
           count(*) FILTER (NOT _is_deleted_in_source) AS live, count(*) FILTER (NOT _is_deleted_in_source) AS expected_live,
           TRUE AS ok FROM raw_loads""")
def silver_contract_check(spark, sf):
    loads = _contracted(spark, sf, "loads")
    expected = given(spark, sf, "orders").agg(F.count_if(F.col("o_orderkey") % 97 != 0)).scalar()
    return K.silver_contract(loads, "loads", "load_id", expected).withColumnRenamed("table", "table_name")


@query("arrival_reconcile", "arrival_status string, on_time_flag flag, events bigint, billable bigint", """
    SELECT arrival_status, on_time_flag, count(*) AS events, sum(billable_detention_minutes) AS billable
    FROM silver_delivery_events GROUP BY ALL""")
def arrival_reconcile(spark, sf):
    return arrival(source(spark, sf, "delivery_events")).groupBy("arrival_status", "on_time_flag").agg(
        n_rows().alias("events"), F.sum("billable_detention_minutes").alias("billable"))
