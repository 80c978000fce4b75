"""Aggregations and window computations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.facts import fulfilling_trips, trip_milestones
from tidemark.operators.history import versions
from tidemark.operators.control import cdf_checkpoint, first_registrations, latest_events
from tidemark.operators.profile import approximate_quantiles, exact_quantiles, rank_errors
from tidemark.operators.segments import latest_per_key, segmented
from tidemark.plans import landing
from tidemark.plans.measures import variance_band
from tidemark.plans.registry import query
from tidemark.plans.star import star
from tidemark.plans.trucking import given, source




def n_rows():
    return F.count(F.lit(1))


@query("agg_group_sum_count_avg", "load_type string, n bigint, total double, average r4, lowest double, highest double", """
    SELECT load_type, count(*) AS n, sum(revenue) AS total, avg(CAST(revenue AS DOUBLE)) AS average,
           min(revenue) AS lowest, max(revenue) AS highest FROM raw_loads GROUP BY load_type""")
def agg_group(spark, sf):
    return source(spark, sf, "loads").groupBy("load_type").agg(
        n_rows().alias("n"), F.sum("revenue").alias("total"), F.avg(F.col("revenue").cast("double")).alias("average"),
        F.min("revenue").alias("lowest"), F.max("revenue").alias("highest"))


@query("agg_count_distinct", "load_type string, customers bigint, routes bigint", """
    SELECT load_type, count(DISTINCT customer_id) AS customers, count(DISTINCT route_id) AS routes
    FROM raw_loads GROUP BY load_type""")
def agg_count_distinct(spark, sf):
    return source(spark, sf, "loads").groupBy("load_type").agg(
        F.countDistinct("customer_id").alias("customers"), F.countDistinct("route_id").alias("routes"))


@query("agg_conditional", "load_id bigint, late bigint, early bigint, last_pickup ts, last_delivery ts", """
    SELECT load_id, count(*) FILTER (arrival_status = 'Late') AS late, count(*) FILTER (arrival_status = 'Early') AS early,
           max(CASE WHEN event_type = 'Pickup' THEN actual_datetime END) AS last_pickup,
           max(CASE WHEN event_type = 'Delivery' THEN actual_datetime END) AS last_delivery
    FROM silver_delivery_events WHERE load_id IS NOT NULL GROUP BY load_id""")
def agg_conditional(spark, sf):
    from tidemark.operators.transforms import arrival

    events = arrival(source(spark, sf, "delivery_events")).where("load_id IS NOT NULL")
    return events.groupBy("load_id").agg(
        F.count_if(F.col("arrival_status") == "Late").alias("late"),
        F.count_if(F.col("arrival_status") == "Early").alias("early"),
        F.max(F.when(F.col("event_type") == "Pickup", F.col("actual_datetime"))).alias("last_pickup"),
        F.max(F.when(F.col("event_type") == "Delivery", F.col("actual_datetime"))).alias("last_delivery"))


@query("agg_distinct_filtered", "route_key bigint, drivers bigint, trucks bigint", """
    SELECT f.route_key, count(DISTINCT CASE WHEN d.driver_key > 0 THEN d.driver_id END) AS drivers,
           count(DISTINCT CASE WHEN t.truck_key > 0 THEN t.truck_id END) AS trucks
    FROM fact_trip AS f LEFT JOIN dim_driver AS d ON d.driver_key = f.driver_key
    LEFT JOIN dim_truck AS t ON t.truck_key = f.truck_key GROUP BY f.route_key""")
def agg_distinct_filtered(spark, sf):
    """Versions of a member count once, special members not at all."""
    s = star(spark, sf)
    real = lambda name: s.dim(name).where(F.col(f"{name}_key") > 0).select(f"{name}_key", f"{name}_id")
    return (s.fact("trip").join(real("driver"), "driver_key", "left").join(real("truck"), "truck_key", "left")
            .groupBy("route_key").agg(F.countDistinct("driver_id").alias("drivers"),
                                      F.countDistinct("truck_id").alias("trucks")))


@query("agg_having", "load_id bigint, trips bigint", """
    SELECT load_id, count(*) AS trips FROM raw_trips WHERE load_id IS NOT NULL GROUP BY load_id HAVING count(*) > 1""")
def agg_having(spark, sf):
    return (source(spark, sf, "trips").where("load_id IS NOT NULL").groupBy("load_id").agg(n_rows().alias("trips"))
            .where(F.col("trips") > 1))


@query("agg_global_single_row", "n bigint, drivers bigint, miles bigint, gallons double, idle double, undated bigint", """
    SELECT count(*) AS n, count(DISTINCT driver_id) AS drivers, sum(actual_distance_miles) AS miles,
           sum(fuel_gallons_used) AS gallons, sum(idle_time_hours) AS idle,
           count(*) FILTER (dispatch_date IS NULL) AS undated FROM raw_trips""")
def agg_global(spark, sf):
    return source(spark, sf, "trips").agg(
        n_rows().alias("n"), F.countDistinct("driver_id").alias("drivers"), F.sum("actual_distance_miles").alias("miles"),
        F.sum("fuel_gallons_used").alias("gallons"), F.sum("idle_time_hours").alias("idle"),
        F.count_if(F.col("dispatch_date").isNull()).alias("undated"))


@query("agg_ratio_of_sums", "truck_id bigint, price double, miles_per_gallon double", """
    SELECT truck_id, CAST(sum(total_cost) AS DOUBLE) / nullif(CAST(sum(gallons) AS DOUBLE), 0) AS price,
           CAST(count(*) AS DOUBLE) / nullif(CAST(sum(CASE WHEN gallons > 40 THEN gallons ELSE 0 END) AS DOUBLE), 0)
               AS miles_per_gallon
    FROM raw_fuel_purchases GROUP BY truck_id""")
def agg_ratio(spark, sf):
    """Total over total, NULL where the total below is zero."""
    from tidemark.functions.compare import ratio

    big = F.sum(F.when(F.col("gallons") > 40, F.col("gallons")).otherwise(0)).cast("double")
    return source(spark, sf, "fuel_purchases").groupBy("truck_id").agg(
        ratio(F.sum("total_cost").cast("double"), F.sum("gallons").cast("double")).alias("price"),
        ratio(n_rows().cast("double"), big).alias("miles_per_gallon"))


@query("agg_stddev_corr", "n bigint, sd r4, r r6", """
    SELECT count(*) AS n, stddev_samp(CAST(total_cost AS DOUBLE)) AS sd,
           corr(CAST(gallons AS DOUBLE), CAST(total_cost AS DOUBLE)) AS r FROM raw_fuel_purchases""")
def agg_stddev_corr(spark, sf):
    cost, gallons = F.col("total_cost").cast("double"), F.col("gallons").cast("double")
    return source(spark, sf, "fuel_purchases").agg(
        n_rows().alias("n"), F.stddev(cost).alias("sd"), F.corr(gallons, cost).alias("r"))


@query("agg_quantiles", "column_name string, q1 r4, median r4, q3 r4", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
           quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3
    FROM raw_loads""" for c in ("revenue", "fuel_surcharge", "weight_lbs")))
def agg_quantiles(spark, sf):
    """Exact quartiles from running counts, no column collected anywhere."""
    q = exact_quantiles(source(spark, sf, "loads"), ["revenue", "fuel_surcharge", "weight_lbs"], [0.25, 0.5, 0.75])
    return q.select(F.col("column").alias("column_name"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                    F.col("q")[2].alias("q3"))


@query("agg_quantiles_approx", "column_name string, probability r4, rows bigint, within flag", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, {p} AS probability, count({c}) AS rows, TRUE AS within FROM raw_loads"""
                                                                                      for c in ("revenue", "fuel_surcharge", "weight_lbs") for p in (0.25, 0.5, 0.75)))
def agg_quantiles_approx(spark, sf):
    """The sketched form, one pass; the ranks of its values are counted and must be within one percent."""
    loads, columns, quarters = source(spark, sf, "loads"), ["revenue", "fuel_surcharge", "weight_lbs"], [0.25, 0.5, 0.75]
    off = rank_errors(loads, approximate_quantiles(loads, columns, quarters), columns, quarters)
    counts = loads.agg(*[F.count(c).alias(c) for c in columns]).select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in columns])).alias("c"))
    return off.join(F.broadcast(counts.select("c.*")), "column").select(
        F.col("column").alias("column_name"), "probability", "rows", (F.col("rank_error") <= 0.01).alias("within"))


@query("agg_histogram_bucket", "kind string, bucket int, n bigint", """
    SELECT 'revenue' AS kind, CAST(floor(CAST(revenue AS DOUBLE) / 50000) * 50000 AS INTEGER) AS bucket, count(*) AS n
    FROM raw_loads GROUP BY 2
    UNION ALL
    SELECT 'variance', b.start, count(*) FROM (SELECT unnest(generate_series(-180, 330, 30)) AS start) AS b
    JOIN silver_delivery_events AS e ON e.arrival_variance_minutes >= b.start
         AND (e.arrival_variance_minutes < b.start + 30 OR (b.start = 330 AND e.arrival_variance_minutes <= 360))
    GROUP BY 2""")
def agg_histogram(spark, sf):
    """Floor buckets, and fixed bands with the last one closed."""
    from tidemark.operators.transforms import arrival

    revenue = source(spark, sf, "loads").groupBy(
        (F.floor(F.col("revenue").cast("double") / 50000) * 50000).alias("bucket")).agg(n_rows().alias("n")).select(
        F.lit("revenue").alias("kind"), F.col("bucket").cast("int").alias("bucket"), "n")
    events = arrival(source(spark, sf, "delivery_events"))
    bands = events.groupBy(variance_band(F.col("arrival_variance_minutes")).alias("bucket")).agg(
        n_rows().alias("n")).where("bucket IS NOT NULL").select(F.lit("variance").alias("kind"), "bucket", "n")
    return revenue.unionByName(bands)


@query("agg_string_agg", "load_type string, statuses string", """
    SELECT load_type, string_agg(DISTINCT load_status, ', ' ORDER BY load_status) AS statuses
    FROM raw_loads GROUP BY load_type""")
def agg_string_agg(spark, sf):
    """A sorted list of names; the names are a short domain, collected once each."""
    names = source(spark, sf, "loads").select("load_type", "load_status").distinct()
    return names.groupBy("load_type").agg(
        F.array_join(F.array_sort(F.collect_list("load_status")), ", ").alias("statuses"))


@query("agg_share_of_total", "customer_id bigint, revenue double, share r8", """
    SELECT customer_id, sum(revenue) AS revenue,
           CAST(sum(revenue) AS DOUBLE) / CAST((SELECT sum(revenue) FROM raw_loads) AS DOUBLE) AS share
    FROM raw_loads GROUP BY customer_id""")
def agg_share(spark, sf):
    """The total is a scalar subquery; no window gathers all groups in one task."""
    loads = source(spark, sf, "loads")
    total = loads.agg(F.sum("revenue")).scalar()
    return loads.groupBy("customer_id").agg(F.sum("revenue").alias("revenue")).withColumn(
        "share", F.col("revenue").cast("double") / total.cast("double"))


@query("agg_nested", "month int, mean r4, deviation r4, busiest bigint", """
    SELECT month(d) AS month, avg(CAST(n AS DOUBLE)) AS mean, stddev_samp(CAST(n AS DOUBLE)) AS deviation, max(n) AS busiest
    FROM (SELECT load_date AS d, count(*) AS n FROM raw_loads GROUP BY 1) GROUP BY 1""")
def agg_nested(spark, sf):
    daily = source(spark, sf, "loads").groupBy("load_date").agg(n_rows().alias("n"))
    n = F.col("n").cast("double")
    return daily.groupBy(F.month("load_date").alias("month")).agg(
        F.avg(n).alias("mean"), F.stddev(n).alias("deviation"), F.max("n").alias("busiest"))


# --- windows ---------------------------------------------------------------------------



@query("win_row_number_latest", "user_id bigint, event_type string, day date", """
    SELECT user_id, event_type, CAST(seen_at AS DATE) AS day FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seen_at DESC) AS rn FROM user_days) WHERE rn = 1""")
def win_latest(spark, sf):
    """The newest row per key, as an aggregate."""
    latest = latest_per_key(landing.user_history(spark, sf), ["user_id"], [F.col("_ingested_at"), F.col("_ingest_date")])
    return latest.withColumn("day", F.col("_ingested_at").cast("date"))


@query("win_lag_version", "event_id bigint, user_id bigint, previous_type string, previous_at ts", """
    SELECT event_id, user_id, lag(event_type) OVER w AS previous_type, lag(ts) OVER w AS previous_at
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_lag_version(spark, sf):
    """The previous row of the same key, exact across the pieces of a split key."""
    events = given(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    rows = segmented(events, ["user_id"], ["ts", "event_id"], lag={"p": F.struct("event_type", "ts")})
    return rows.select("event_id", "user_id", F.col("p.event_type").alias("previous_type"),
                       F.col("p.ts").alias("previous_at"))


@query("win_last_ignore_nulls", "event_id bigint, user_id bigint, last_signup ts", """
    SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN ts END IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_signup
    FROM events""")
def win_last_ignore_nulls(spark, sf):
    events = given(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return segmented(events, ["user_id"], ["ts", "event_id"],
                     last={"last_signup": F.when(F.col("event_type") == "signup", F.col("ts"))})


@query("win_gaps_islands", "user_id bigint, day date, starts flag, island bigint", """
    WITH f AS (SELECT seen_at, max(CASE WHEN mode = 'full' THEN 1 ELSE 0 END) AS f FROM user_days GROUP BY seen_at),
    o AS (SELECT seen_at, sum(f) OVER (ORDER BY seen_at) AS upto, sum(f) OVER (ORDER BY seen_at) - f AS before FROM f),
    h AS (SELECT u.*, o.upto, o.before FROM user_days AS u JOIN o USING (seen_at)),
    p AS (SELECT *, lag(event_type) OVER w AS pt, lag(upto) OVER w AS pu FROM h
          WINDOW w AS (PARTITION BY user_id ORDER BY seen_at)),
    s AS (SELECT *, pt IS NULL OR pt <> event_type OR before > pu AS starts FROM p)
    SELECT user_id, CAST(seen_at AS DATE) AS day, starts,
           sum(CAST(starts AS INT)) OVER (PARTITION BY user_id ORDER BY seen_at) AS island FROM s""")
def win_gaps_islands(spark, sf):
    """Runs broken by a change of value or by a complete snapshot without the key."""
    rows = versions(landing.user_history(spark, sf), "user_id")
    rows = segmented(rows, ["user_id"], ["_ingested_at"], running={"island": F.col("starts").cast("int")})
    return rows.select("user_id", F.col("_ingested_at").cast("date").alias("day"), "starts", "island")


@query("win_row_number_priority", "load_id bigint, trip_id string", "SELECT load_id, trip_id FROM fulfilling")
def win_priority(spark, sf):
    """One fulfilling trip per load: delivered first, then latest dispatch, then greatest id."""
    return fulfilling_trips(trip_milestones(source(spark, sf, "trips"), source(spark, sf, "delivery_events")))


@query("win_latest_event_tiebreak", "batch_seq int, event_type string, event_at ts", """
    SELECT batch_seq, event_type, event_at FROM (
        SELECT *, row_number() OVER (PARTITION BY batch_seq ORDER BY event_at DESC,
            CASE event_type WHEN 'waived' THEN 1 WHEN 'completed' THEN 2 WHEN 'rejected' THEN 3 WHEN 'failed' THEN 4
                 WHEN 'silver_applied' THEN 5 ELSE 6 END) AS rn FROM batch_events) WHERE rn = 1""")
def win_latest_event(spark, sf):
    return latest_events(landing.batch_events(spark, sf))


@query("win_checkpoint_latest", "step_name string, source_table string, last_version bigint", """
    SELECT step_name, source_table, version_to AS last_version FROM (
        SELECT *, row_number() OVER (PARTITION BY step_name, source_table ORDER BY detected_at DESC, version_to DESC) AS rn
        FROM ledger AS b WHERE EXISTS (SELECT 1 FROM run_log AS r WHERE r.run_id = b.run_id
            AND r.step_name = b.step_name AND r.event_type = 'succeeded' AND r.event_at >= b.detected_at)) WHERE rn = 1""")
def win_checkpoint(spark, sf):
    return cdf_checkpoint(landing.ledger(spark, sf), landing.run_log(spark, sf))


@query("win_lag_difference", "maintenance_id bigint, truck_id bigint, miles_since_last int", """
    SELECT maintenance_id, truck_id, odometer_reading - lag(odometer_reading) OVER (
        PARTITION BY truck_id ORDER BY maintenance_date, maintenance_id) AS miles_since_last
    FROM raw_maintenance_records WHERE truck_id IS NOT NULL""")
def win_lag_difference(spark, sf):
    """Miles since the previous service of the same truck."""
    rows = source(spark, sf, "maintenance_records").where("truck_id IS NOT NULL")
    rows = segmented(rows.select("maintenance_id", "truck_id", "maintenance_date", "odometer_reading"), ["truck_id"],
                     ["maintenance_date", "maintenance_id"], lag={"before": F.col("odometer_reading")})
    return rows.withColumn("miles_since_last", F.col("odometer_reading") - F.col("before"))


@query("win_share", "load_type string, load_status string, n bigint, pct r2", """
    SELECT *, 100.0 * n / sum(n) OVER (PARTITION BY load_type) AS pct
    FROM (SELECT load_type, load_status, count(*) AS n FROM raw_loads GROUP BY ALL)""")
def win_share(spark, sf):
    """Share within a group: the counts are aggregated once more, not the rows."""
    counts = source(spark, sf, "loads").groupBy("load_type", "load_status").agg(n_rows().alias("n"))
    totals = counts.groupBy("load_type").agg(F.sum("n").alias("total"))
    return counts.join(totals, "load_type").withColumn("pct", 100.0 * F.col("n") / F.col("total"))


@query("win_first_registration", "batch_seq int, batch_id string, content_hash string", """
    SELECT batch_seq, batch_id, content_hash FROM (
        SELECT *, row_number() OVER (PARTITION BY batch_seq ORDER BY discovered_at, batch_id) AS rn FROM registry)
    WHERE rn = 1""")
def win_first_registration(spark, sf):
    return first_registrations(landing.registry(spark, sf))
