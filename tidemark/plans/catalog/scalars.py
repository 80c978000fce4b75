"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.compare import differs, ratio
from tidemark.functions.dates import date_key, hours_between, key_date, key_month, month_name
from tidemark.functions.hashing import row_hash
from tidemark.operators.manifests import folder_name, parse
from tidemark.plans import landing
from tidemark.plans.oracle_star import dk, hours
from tidemark.plans.registry import query
from tidemark.plans.trucking import given, source


@query("fn_string", "customer_id bigint, label string, first_word string, suffix string, name_length int, head string, "
                    "folder string, has_marker flag", """
    SELECT customer_id, trim(coalesce(customer_type, '') || ' ' || account_status) AS label,
           string_split(primary_freight_type, ' ')[1] AS first_word,
           regexp_extract(customer_name, 'Customer#(.+)$', 1) AS suffix, length(customer_name) AS name_length,
           left(customer_name, 4) AS head, printf('batch_seq=%06d', customer_id) AS folder,
           contains(lower(customer_name), '00001') AS has_marker
    FROM raw_customers""")
def fn_string(spark, sf):
    return source(spark, sf, "customers").select(
        "customer_id", F.trim(F.concat_ws(" ", "customer_type", "account_status")).alias("label"),
        F.split("primary_freight_type", " ")[0].alias("first_word"),
        F.regexp_extract("customer_name", "Customer#(.+)$", 1).alias("suffix"),
        F.length("customer_name").alias("name_length"), F.left("customer_name", F.lit(4)).alias("head"),
        folder_name(F.col("customer_id")).alias("folder"),
        F.lower("customer_name").contains("00001").alias("has_marker"))


@query("fn_date_key", "load_id bigint, k int, day date, month date, quarter int, month_end date, month_name string, "
                      "due date", f"""
    SELECT load_id, {dk('load_date')} AS k, load_date AS day, date_trunc('month', load_date) AS month,
           quarter(load_date) AS quarter, last_day(load_date) AS month_end, monthname(load_date) AS month_name,
           load_date + 30 AS due
    FROM raw_loads""")
def fn_date_key(spark, sf):
    rows = source(spark, sf, "loads").withColumn("k", date_key("load_date"))
    return rows.select("load_id", "k", key_date("k").alias("day"), key_month("k").alias("month"),
                       F.quarter("load_date").alias("quarter"), F.last_day("load_date").alias("month_end"),
                       month_name("load_date").alias("month_name"), F.date_add("load_date", 30).alias("due"))


@query("fn_date_diff", "event_id string, days int, hours double, minutes double", f"""
    SELECT event_id, date_diff('day', CAST(scheduled_datetime AS DATE), CAST(actual_datetime AS DATE)) AS days,
           {hours('scheduled_datetime', 'actual_datetime')} AS hours,
           (epoch_us(actual_datetime) - epoch_us(scheduled_datetime)) / 60000000.0 AS minutes
    FROM raw_delivery_events""")
def fn_date_diff(spark, sf):
    events = source(spark, sf, "delivery_events")
    gap = F.unix_micros("actual_datetime") - F.unix_micros("scheduled_datetime")
    return events.select("event_id", F.datediff("actual_datetime", "scheduled_datetime").alias("days"),
                         hours_between("scheduled_datetime", "actual_datetime").alias("hours"),
                         (gap.cast("double") / 60000000.0).alias("minutes"))


@query("fn_math", "load_id bigint, rounded double, magnitude double, bucket bigint, floored_at_zero double, "
                  "remainder bigint, per_piece r8, per_nothing r8", """
    SELECT load_id, round(revenue, 1) AS rounded, abs(fuel_surcharge - accessorial_charges) AS magnitude,
           CAST(floor(CAST(revenue AS DOUBLE) / 1000) AS BIGINT) AS bucket,
           greatest(fuel_surcharge - 100, 0) AS floored_at_zero, load_id % 7 AS remainder,
           CAST(revenue AS DOUBLE) / nullif(pieces, 0) AS per_piece,
           CAST(revenue AS DOUBLE) / nullif(pieces - pieces, 0) AS per_nothing
    FROM raw_loads""")
def fn_math(spark, sf):
    revenue = F.col("revenue")
    return source(spark, sf, "loads").select(
        "load_id", F.round(revenue, 1).alias("rounded"),
        F.abs(F.col("fuel_surcharge") - F.col("accessorial_charges")).alias("magnitude"),
        F.floor(revenue.cast("double") / 1000).alias("bucket"),
        F.greatest(F.col("fuel_surcharge") - 100, F.lit(0)).alias("floored_at_zero"),
        (F.col("load_id") % 7).alias("remainder"),
        ratio(revenue.cast("double"), F.col("pieces")).alias("per_piece"),
        ratio(revenue.cast("double"), F.col("pieces") - F.col("pieces")).alias("per_nothing"))


@query("fn_conditional", "load_id bigint, customer bigint, kind string, settled flag, has_unknown flag, same flag", """
    SELECT load_id, coalesce(customer_id, 0) AS customer,
           CASE WHEN booking_type IS NULL THEN 'Not Recorded' WHEN booking_type = 'Spot' THEN 'Open market'
                ELSE booking_type END AS kind,
           load_status IN ('F', 'P') AS settled, -5 IN (route_id, customer_id) AS has_unknown,
           booking_type IS NOT DISTINCT FROM load_status AS same
    FROM (SELECT * REPLACE (coalesce(route_id, 0) AS route_id, customer_id AS customer_id) FROM raw_loads)""".replace(
        "-5 IN (route_id, customer_id)", "-5 IN (route_id, coalesce(customer_id, 0))"))
def fn_conditional(spark, sf):
    customer, route = F.coalesce("customer_id", F.lit(0)), F.coalesce("route_id", F.lit(0))
    return source(spark, sf, "loads").select(
        "load_id", customer.alias("customer"),
        F.when(F.col("booking_type").isNull(), "Not Recorded").when(F.col("booking_type") == "Spot", "Open market")
        .otherwise(F.col("booking_type")).alias("kind"),
        F.col("load_status").isin("F", "P").alias("settled"),
        F.array_contains(F.array(route, customer), -5).alias("has_unknown"),
        (~differs([F.col("booking_type")], [F.col("load_status")])).alias("same"))


HASHED = ("customer_id", "customer_type", "contract_start_date", "annual_revenue_potential", "_is_deleted_in_source")


def row_text_sql(columns) -> str:
    """The SQL of hashing.row_text."""
    return "concat_ws(',', " + ", ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns) + ")"


@query("fn_hash_json", "customer_id bigint, row_hash string", f"""
    SELECT customer_id, sha256({row_text_sql(HASHED)}) AS row_hash FROM raw_customers""")
def fn_hash_json(spark, sf):
    """SHA-256 of a rendering that keeps nulls."""
    return source(spark, sf, "customers").select("customer_id", row_hash(HASHED).alias("row_hash"))


@query("fn_cast", "maintenance_id bigint, id_text string, hours int, cost double, flag_text string, flag_int int", """
    SELECT maintenance_id, CAST(maintenance_id AS VARCHAR) AS id_text, CAST(trunc(labor_hours) AS INTEGER) AS hours,
           CAST(parts_cost AS DECIMAL(18,4)) AS cost, CAST(_is_deleted_in_source AS VARCHAR) AS flag_text,
           CAST(_is_deleted_in_source AS INTEGER) AS flag_int
    FROM raw_maintenance_records""")
def fn_cast(spark, sf):
    c = F.col
    return source(spark, sf, "maintenance_records").select(
        "maintenance_id", c("maintenance_id").cast("string").alias("id_text"), c("labor_hours").cast("int").alias("hours"),
        c("parts_cost").cast("decimal(18,4)").alias("cost"), c("_is_deleted_in_source").cast("string").alias("flag_text"),
        c("_is_deleted_in_source").cast("int").alias("flag_int"))


@query("fn_epoch", "user_id bigint, latest_micros bigint", """
    SELECT user_id, epoch_us(max(ts)) AS latest_micros FROM events GROUP BY user_id""")
def fn_epoch(spark, sf):
    return given(spark, sf, "events").groupBy("user_id").agg(
        F.unix_micros(F.max(F.col("ts").cast("timestamp"))).alias("latest_micros"))


@query("fn_json_parse", "seq bigint, is_object flag, mode string, business_date date, valid_date flag, valid_hash flag", """
    SELECT seq, seq % 20 <> 3 AS is_object,
           CASE WHEN seq % 20 = 3 THEN NULL WHEN seq = 0 THEN 'INITIAL_SNAPSHOT' ELSE 'CHANGE_BATCH' END AS mode,
           CASE WHEN seq % 20 <> 3 AND seq > 0 THEN day END AS business_date,
           seq % 20 <> 3 AND seq > 0 AS valid_date, seq % 20 NOT IN (3, 5) AS valid_hash
    FROM landed_manifests""")
def fn_json_parse(spark, sf):
    """Typed fields and their validity out of manifest text."""
    p = parse(landing.manifests(spark, sf))
    day = F.try_to_date("business_date", "yyyy-MM-dd")
    return p.select(F.col("folder_seq").alias("seq"), F.coalesce("is_object", F.lit(False)).alias("is_object"), "mode",
                    day.alias("business_date"), day.isNotNull().alias("valid_date"),
                    F.coalesce(F.col("content_hash").rlike("^[0-9a-f]{64}$"), F.lit(False)).alias("valid_hash"))


@query("fn_generate_series", "day date, loads bigint", """
    SELECT s.day, count(l.load_id) AS loads
    FROM (SELECT CAST(unnest(generate_series(CAST((SELECT min(load_date) FROM raw_loads) AS TIMESTAMP),
                                             CAST((SELECT max(load_date) FROM raw_loads) AS TIMESTAMP),
                                             INTERVAL 1 DAY)) AS DATE) AS day) AS s
    LEFT JOIN raw_loads AS l ON l.load_date = s.day GROUP BY s.day""")
def fn_generate_series(spark, sf):
    """Every day between the first and last load, also those without any."""
    loads = source(spark, sf, "loads").groupBy(F.col("load_date").alias("day")).agg(F.count("load_id").alias("n"))
    span = loads.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.join(loads, "day", "left").withColumn("loads", F.coalesce("n", F.lit(0)))
