"""Joins, set operations, sort and limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.compare import differs
from tidemark.functions.dates import date_key
from tidemark.operators import facts as T
from tidemark.operators.checks import two_way_difference
from tidemark.operators.control import first_registrations, repeated_ids
from tidemark.operators.hashes import difference_examples, row_hashes
from tidemark.operators.history import load_batches
from tidemark.operators.lookups import as_of_scan, by_columns
from tidemark.operators.segments import segmented
from tidemark.plans import landing
from tidemark.plans.measures import drill_across
from tidemark.plans.oracle_star import CLASS, dk
from tidemark.plans.registry import query
from tidemark.plans.star import star
from tidemark.plans.trucking import given, source

def n_rows():
    return F.count(F.lit(1))


@query("join_inner_equi", "trip_id string, load_id bigint, driver_id bigint", """
    SELECT t.trip_id, t.load_id, t.driver_id
    FROM raw_loads AS k JOIN raw_trips AS t ON t.load_id = k.load_id WHERE k._is_deleted_in_source""")
def join_inner_equi(spark, sf):
    """A worklist (the deleted loads) against the trips."""
    worklist = source(spark, sf, "loads").where("_is_deleted_in_source").select("load_id")
    return worklist.join(source(spark, sf, "trips"), "load_id").select("trip_id", "load_id", "driver_id")


@query("join_left_lookup", "load_id bigint, customer_id bigint, customer_name string, found flag", """
    SELECT l.load_id, l.customer_id, c.customer_name, c.customer_id IS NOT NULL AS found
    FROM raw_loads AS l LEFT JOIN raw_customers AS c ON c.customer_id = l.customer_id""")
def join_left_lookup(spark, sf):
    """Misses stay, marked."""
    customers = source(spark, sf, "customers").select("customer_id", "customer_name", F.lit(True).alias("hit"))
    return source(spark, sf, "loads").join(customers, "customer_id", "left").withColumn("found", F.col("hit").isNotNull())


@query("join_full_outer_compare", "customer_id bigint, in_before flag, in_after flag, same_status flag", """
    SELECT coalesce(b.customer_id, a.customer_id) AS customer_id, b.customer_id IS NOT NULL AS in_before,
           a.customer_id IS NOT NULL AS in_after, b.account_status IS NOT DISTINCT FROM a.account_status AS same_status
    FROM raw_customers AS b FULL JOIN customers_after AS a ON a.customer_id = b.customer_id""")
def join_full_outer_compare(spark, sf):
    before, after = landing.customer_versions(spark, sf)
    b = before.select("customer_id", F.struct("account_status").alias("b"))
    a = after.select("customer_id", F.struct("account_status").alias("a"))
    return b.join(a, "customer_id", "full_outer").select(
        "customer_id", F.col("b").isNotNull().alias("in_before"), F.col("a").isNotNull().alias("in_after"),
        F.col("b.account_status").eqNullSafe(F.col("a.account_status")).alias("same_status"))


@query("join_semi", "load_id bigint", """
    SELECT load_id FROM raw_loads AS l WHERE EXISTS (
        SELECT 1 FROM raw_trips AS t WHERE t.load_id = l.load_id AND NOT t._is_deleted_in_source)""")
def join_semi(spark, sf):
    live = source(spark, sf, "trips").where(~F.col("_is_deleted_in_source"))
    return source(spark, sf, "loads").join(live, "load_id", "left_semi")


@query("join_anti", "load_id bigint", """
    SELECT load_id FROM raw_loads AS l WHERE NOT EXISTS (SELECT 1 FROM raw_trips AS t WHERE t.load_id = l.load_id)""")
def join_anti(spark, sf):
    return source(spark, sf, "loads").join(source(spark, sf, "trips"), "load_id", "left_anti")


@query("join_scd2_asof", "trip_id string, driver_key bigint, version_reason string", f"""
    SELECT t.trip_id, d.driver_key, d.version_reason
    FROM (SELECT *, {dk('dispatch_date')} AS day FROM raw_trips) AS t
    LEFT JOIN dim_driver AS d ON d.driver_id = t.driver_id AND d.driver_key > 0
        AND t.day >= d.valid_from_date_key AND t.day < d.valid_to_date_key""")
def join_scd2_asof(spark, sf):
    """The version valid at the trip's date, carried forward along the days of its driver."""
    dim = star(spark, sf).dim("driver")
    trips = source(spark, sf, "trips").select("trip_id", "driver_id", date_key("dispatch_date").alias("day"))
    return as_of_scan(trips, dim, "driver_id", "driver_key", "day", "driver_key", carry=["version_reason"])




@query("join_theta_range", "user_id bigint, day date, missed_before bigint, missed_after bigint", """
    WITH h AS (SELECT *, lag(seen_at) OVER (PARTITION BY user_id ORDER BY seen_at) AS p,
                      lead(seen_at) OVER (PARTITION BY user_id ORDER BY seen_at) AS n FROM user_days),
    s AS (SELECT DISTINCT seen_at AS snap FROM user_days WHERE mode = 'full')
    SELECT user_id, CAST(seen_at AS DATE) AS day,
           (SELECT count(*) FROM s WHERE snap > p AND snap < seen_at) AS missed_before,
           CASE WHEN n IS NULL THEN (SELECT count(*) FROM s WHERE snap > seen_at) ELSE 0 END AS missed_after
    FROM h""")
def join_theta_range(spark, sf):
    """Complete snapshots strictly between a row and the one before, or after the last row.

    Counted as differences of snapshot ordinals, without any range join.
    """
    history = landing.user_history(spark, sf)
    loads = load_batches(history)
    total = loads.agg(F.max("full_upto")).scalar()
    rows = history.join(loads, "_ingested_at")
    rows = segmented(rows, ["user_id"], ["_ingested_at"], lag={"before": F.col("full_upto")})
    last = rows.groupBy("user_id").agg(F.max("_ingested_at").alias("last_at"))
    return rows.join(last, "user_id").select(
        "user_id", F.col("_ingested_at").cast("date").alias("day"),
        F.coalesce(F.col("full_before") - F.col("before"), F.lit(0)).alias("missed_before"),
        F.when(F.col("_ingested_at") == F.col("last_at"), total - F.col("full_upto")).otherwise(0)
        .alias("missed_after"))


@query("join_broadcast", "n_name string, suppliers bigint, lines bigint", """
    SELECT n_name, count(DISTINCT s_suppkey) AS suppliers, count(*) AS lines
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name""")
def join_broadcast(spark, sf):
    """Spark broadcasts the small sides by the bytes it estimates; none is hinted."""
    suppliers = given(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nations = given(spark, sf, "nation").select("n_nationkey", "n_name")
    # Counted per supplier first: a supplier half the lines share joins as one row.
    lines = given(spark, sf, "lineitem").groupBy("l_suppkey").agg(n_rows().alias("n"))
    return (lines.join(suppliers, F.col("s_suppkey") == F.col("l_suppkey"))
            .join(nations, F.col("n_nationkey") == F.col("s_nationkey"))
            .groupBy("n_name").agg(F.countDistinct("s_suppkey").alias("suppliers"), F.sum("n").alias("lines")))


@query("join_cross_scalar", "load_id bigint, revenue double, average r4", """
    SELECT load_id, revenue, (SELECT avg(CAST(revenue AS DOUBLE)) FROM raw_loads) AS average
    FROM raw_loads WHERE revenue > (SELECT avg(CAST(revenue AS DOUBLE)) FROM raw_loads)""")
def join_cross_scalar(spark, sf):
    """Every row beside a one-row aggregate: a scalar subquery, not a join."""
    loads = source(spark, sf, "loads")
    average = loads.agg(F.avg(F.col("revenue").cast("double"))).scalar()
    return loads.where(F.col("revenue").cast("double") > average).withColumn("average", average)


@query("join_self_inequality", "batch_seq int, duplicate_of_seq int, clash_seq int", """
    WITH r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_seq ORDER BY discovered_at, batch_id) AS rn
                              FROM registry) WHERE rn = 1)
    SELECT l.batch_seq,
           (SELECT min(e.batch_seq) FROM r AS e WHERE e.batch_seq < l.batch_seq AND e.batch_id = l.batch_id
               AND e.content_hash = l.content_hash AND l.is_valid) AS duplicate_of_seq,
           (SELECT min(e.batch_seq) FROM r AS e WHERE e.batch_seq < l.batch_seq AND e.batch_id = l.batch_id
               AND coalesce(e.content_hash, '') <> coalesce(l.content_hash, '')) AS clash_seq
    FROM r AS l""")
def join_self_inequality(spark, sf):
    """Earlier uses of a batch id, from minima per id and content instead of row pairs."""
    return repeated_ids(first_registrations(landing.registry(spark, sf)))


@query("join_multi_hop", "reason string, purchases bigint", """
    SELECT CASE WHEN p.trip_id IS NULL THEN 'no trip' WHEN t.trip_id IS NULL THEN 'unknown trip'
                WHEN t.load_id IS NULL THEN 'no load' WHEN l.load_id IS NULL THEN 'unknown load'
                WHEN l.route_id IS NULL THEN 'no route' WHEN r.route_id IS NULL THEN 'unknown route'
                ELSE 'route' END AS reason, count(*) AS purchases
    FROM raw_fuel_purchases AS p LEFT JOIN raw_trips AS t ON t.trip_id = p.trip_id
    LEFT JOIN raw_loads AS l ON l.load_id = t.load_id LEFT JOIN raw_routes AS r ON r.route_id = l.route_id
    GROUP BY 1""")
def join_multi_hop(spark, sf):
    """Purchase to trip to load to route, with the hop that breaks."""
    def found(table, key, *extra):
        return source(spark, sf, table).select(key, *extra, F.lit(True).alias(f"has_{table}"))

    rows = (source(spark, sf, "fuel_purchases").select("trip_id")
            .join(found("trips", "trip_id", "load_id"), "trip_id", "left")
            .join(found("loads", "load_id", "route_id"), "load_id", "left")
            .join(found("routes", "route_id"), "route_id", "left"))
    reason = (F.when(F.col("trip_id").isNull(), "no trip").when(F.col("has_trips").isNull(), "unknown trip")
              .when(F.col("load_id").isNull(), "no load").when(F.col("has_loads").isNull(), "unknown load")
              .when(F.col("route_id").isNull(), "no route").when(F.col("has_routes").isNull(), "unknown route")
              .otherwise("route"))
    return rows.groupBy(reason.alias("reason")).agg(n_rows().alias("purchases"))


@query("join_composite", "incident_id bigint, incident_class_key bigint", f"""
    SELECT v.incident_id, coalesce(d.incident_class_key, -1) AS incident_class_key
    FROM src_incident_class AS v LEFT JOIN dim_incident_class AS d
      ON {' AND '.join(f'd.{c} = v.{c}' for c in CLASS)} AND d.incident_class_key > 0""")
def join_composite(spark, sf):
    """A lookup on seven attributes."""
    s = star(spark, sf)
    rows = by_columns(s.dim_source("incident_class"), s.dim("incident_class"), T.INCIDENT_CLASS,
                      "incident_class_key", "_class")
    return rows.withColumn("incident_class_key", F.coalesce("_class", F.lit(-1)))


@query("join_role_playing", "booked_month int, dispatched_month int, pickup_month int, delivery_month int, loads bigint", """
    SELECT b.year_month_number AS booked_month, x.year_month_number AS dispatched_month,
           p.year_month_number AS pickup_month, v.year_month_number AS delivery_month, count(*) AS loads
    FROM fact_load_lifecycle AS f
    LEFT JOIN dim_date AS b ON b.date_key = f.booked_date_key LEFT JOIN dim_date AS x ON x.date_key = f.dispatched_date_key
    LEFT JOIN dim_date AS p ON p.date_key = f.pickup_date_key LEFT JOIN dim_date AS v ON v.date_key = f.delivery_date_key
    GROUP BY ALL""")
def join_role_playing(spark, sf):
    """One date dimension in four roles."""
    s = star(spark, sf)
    rows, dates = s.fact("load_lifecycle"), s.dim("date")
    for role in ("booked", "dispatched", "pickup", "delivery"):
        named = dates.select(F.col("date_key").alias(f"{role}_date_key"), F.col("year_month_number").alias(f"{role}_month"))
        rows = rows.join(named, f"{role}_date_key", "left")
    return rows.groupBy("booked_month", "dispatched_month", "pickup_month", "delivery_month").agg(n_rows().alias("loads"))


@query("join_drill_across", "route_key bigint, route_name string, loads bigint, trips bigint, purchases bigint", """
    SELECT r.route_key, r.route_name, l.n AS loads, t.n AS trips, f.n AS purchases
    FROM dim_route AS r
    LEFT JOIN (SELECT route_key, count(*) AS n FROM fact_load_lifecycle GROUP BY 1) AS l USING (route_key)
    LEFT JOIN (SELECT route_key, count(*) AS n FROM fact_trip GROUP BY 1) AS t USING (route_key)
    LEFT JOIN (SELECT route_key, count(*) AS n FROM fact_fuel_purchase GROUP BY 1) AS f USING (route_key)
    WHERE r.route_key > 0""")
def join_drill_across(spark, sf):
    """Three facts counted by route, then joined on the route."""
    s = star(spark, sf)
    facts = {f: s.fact_part(f, "route_key") for f in ("load_lifecycle", "trip", "fuel_purchase")}
    spine = s.dim("route").where("route_key > 0").select("route_key", "route_name")
    return drill_across(spine, "route_key", *[
        facts[f].groupBy("route_key").agg(n_rows().alias(name))
        for f, name in (("load_lifecycle", "loads"), ("trip", "trips"), ("fuel_purchase", "purchases"))])


# --- sort and limit -------------------------------------------------------------------

@query("topk_order_limit", "route_id bigint, revenue double", """
    SELECT route_id, sum(revenue) AS revenue FROM raw_loads WHERE route_id IS NOT NULL GROUP BY route_id
    ORDER BY sum(revenue) DESC, route_id LIMIT 10""")
def topk_order_limit(spark, sf):
    """The ten lanes with the most revenue; a distributed top-k."""
    return (source(spark, sf, "loads").where(F.col("route_id").isNotNull()).groupBy("route_id")
            .agg(F.sum("revenue").alias("revenue")).orderBy(F.col("revenue").desc(), "route_id").limit(10))


@query("top1_by_priority", "decision string, load_id bigint", """
    SELECT decision, load_id FROM (
        SELECT 1 AS priority, 'restore' AS decision, load_id FROM raw_loads WHERE _is_deleted_in_source
        UNION ALL SELECT 2, 'assign customer', load_id FROM raw_loads WHERE customer_id IS NULL)
    ORDER BY priority, load_id LIMIT 1""")
def top1_by_priority(spark, sf):
    """One decision out of all candidates."""
    loads = source(spark, sf, "loads")
    candidates = loads.where("_is_deleted_in_source").select(F.lit(1).alias("p"), F.lit("restore").alias("decision"), "load_id") \
        .unionByName(loads.where("customer_id IS NULL").select(F.lit(2).alias("p"), F.lit("assign customer").alias("decision"), "load_id"))
    return candidates.orderBy("p", "load_id").limit(1)


@query("sample_examples", "status string, business_key string", """
    SELECT status, business_key FROM (
        SELECT *, row_number() OVER (PARTITION BY status ORDER BY business_key) AS rn FROM (
            SELECT CASE WHEN a.customer_id IS NULL THEN 'only_left' WHEN b.customer_id IS NULL THEN 'only_right'
                        ELSE 'changed' END AS status,
                   CAST(coalesce(b.customer_id, a.customer_id) AS VARCHAR) AS business_key
            FROM raw_customers AS b FULL JOIN customers_after AS a ON a.customer_id = b.customer_id
            WHERE a.customer_id IS NULL OR b.customer_id IS NULL OR a.account_status <> b.account_status)) WHERE rn <= 5""")
def sample_examples(spark, sf):
    """Up to five example keys of each kind of difference."""
    before, after = landing.customer_versions(spark, sf)
    return difference_examples(row_hashes(before, "customer_id"), row_hashes(after, "customer_id"))


@query("sort_within_partitions", "unsorted bigint, rows bigint",
       "SELECT 0 AS unsorted, count(*) AS rows FROM raw_loads")
def sort_within_partitions(spark, sf):
    """Rows of each partition in key order: none lies before its predecessor in the partition."""
    from pyspark.sql import Window

    loads = source(spark, sf, "loads").select("load_id").repartitionByRange("load_id").sortWithinPartitions("load_id")
    placed = loads.select("load_id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"))
    before = F.lag("load_id").over(Window.partitionBy("p").orderBy("i"))
    return placed.withColumn("before", before).agg(
        F.count_if(F.col("before") > F.col("load_id")).alias("unsorted"), n_rows().alias("rows"))


# --- set operations ----------------------------------------------------------------------

@query("set_union_all", "kind string, id string", """
    SELECT 'load' AS kind, CAST(load_id AS VARCHAR) AS id FROM raw_loads
    UNION ALL SELECT 'trip', trip_id FROM raw_trips UNION ALL SELECT 'trip load', CAST(load_id AS VARCHAR) FROM raw_trips""")
def set_union_all(spark, sf):
    trips = source(spark, sf, "trips")
    return (source(spark, sf, "loads").select(F.lit("load").alias("kind"), F.col("load_id").cast("string").alias("id"))
            .unionByName(trips.select(F.lit("trip").alias("kind"), F.col("trip_id").alias("id")))
            .unionByName(trips.select(F.lit("trip load").alias("kind"), F.col("load_id").cast("string").alias("id"))))


@query("set_union_distinct", "location_city string", "SELECT location_city FROM event_cities")
def set_union_distinct(spark, sf):
    return star(spark, sf).event_cities()


@query("set_except_both_ways", "left_only bigint, right_only bigint", """
    SELECT (SELECT count(*) FROM (SELECT * FROM raw_customers EXCEPT SELECT * FROM customers_after)) AS left_only,
           (SELECT count(*) FROM (SELECT * FROM customers_after EXCEPT SELECT * FROM raw_customers)) AS right_only""")
def set_except_both_ways(spark, sf):
    """Symmetric difference in one shuffle."""
    return two_way_difference(*landing.customer_versions(spark, sf))


@query("set_except_null_safe_change", "customer_id bigint, changed flag", """
    SELECT b.customer_id, EXISTS (SELECT b.customer_type, b.account_status EXCEPT
                                  SELECT a.customer_type, a.account_status) AS changed
    FROM raw_customers AS b JOIN customers_after AS a ON a.customer_id = b.customer_id""")
def set_except_null_safe_change(spark, sf):
    """Row differs, with NULL equal to NULL."""
    before, after = landing.customer_versions(spark, sf)
    cols = ["customer_type", "account_status"]
    b = before.select("customer_id", *[F.col(c).alias(f"b_{c}") for c in cols])
    a = after.select("customer_id", *[F.col(c).alias(f"a_{c}") for c in cols])
    return b.join(a, "customer_id").withColumn("changed", differs(
        [F.col(f"b_{c}") for c in cols], [F.col(f"a_{c}") for c in cols]))


@query("set_distinct", ", ".join(f"{c} string" for c in CLASS), f"SELECT DISTINCT {', '.join(CLASS)} FROM src_incident_class")
def set_distinct(spark, sf):
    return star(spark, sf).dim_source("incident_class").select(*T.INCIDENT_CLASS).distinct()


