"""Oracle relations for current state, dimensions and facts, in DuckDB SQL.

Written from the rules, not from the Spark code: set-oriented SQL with windows and joins
where the Spark side aggregates, so that an error in one is not repeated in the other.
"""

from __future__ import annotations

from tidemark.operators.dims import US_STATES
from tidemark.plans.oracle import define


def dk(x: str) -> str:
    """Date key of a date expression, 0 for NULL."""
    return f"coalesce(year({x}) * 10000 + month({x}) * 100 + day({x}), 0)"


def number(ids: list[str]) -> str:
    text = ", ".join(f"CAST({c} AS VARCHAR)" for c in ids)
    return f"row_number() OVER (ORDER BY substr(md5(concat_ws('|', {text})), 1, 3), {', '.join(ids)})"


def hours(start: str, end: str) -> str:
    """Hours from start to end, half away from zero at two decimals, in whole-number arithmetic."""
    us = f"(epoch_us(CAST({end} AS TIMESTAMP)) - epoch_us(CAST({start} AS TIMESTAMP)))"
    return f"(sign({us}) * ((abs({us}) + 18000000) // 36000000) / 100.0)"


SPECIALS = "(VALUES (0, 'Missing'), (-1, 'Unknown'), (-2, 'Not Applicable')) AS s(k, t)"


def specials(key: str, texts: list[str]) -> str:
    cols = ", ".join(f"t AS {c}" for c in texts)
    return (f" UNION ALL BY NAME SELECT k AS {key}, {cols}{', ' if cols else ''}0 AS valid_from_date_key, "
            f"99991231 AS valid_to_date_key, TRUE AS is_current, FALSE AS is_deleted, "
            f"'Special member' AS version_reason FROM {SPECIALS}")


def junk_specials(key: str, texts: list[str]) -> str:
    return f" UNION ALL BY NAME SELECT k AS {key}, {', '.join(f't AS {c}' for c in texts)} FROM {SPECIALS}"


def rec(c: str) -> str:
    return f"coalesce({c}, 'Not Recorded') AS {c}"


# --- current state ----------------------------------------------------------------

define("silver_drivers", """
    SELECT *, date_diff('day', hire_date, coalesce(termination_date, DATE '2024-12-31')) AS tenure_days,
           year(hire_date) - year(date_of_birth) AS age_at_hire,
           CASE WHEN termination_date < hire_date THEN 'flagged' ELSE 'valid' END AS _dq_status
    FROM raw_drivers""")
define("silver_drivers_later", "SELECT * FROM raw_drivers_later")
define("silver_routes", "SELECT *, origin_city || ' → ' || destination_city AS route_name FROM raw_routes")
define("silver_trips", """
    SELECT *, idle_time_hours > actual_duration_hours AS is_idle_implausible,
           CASE WHEN idle_time_hours > actual_duration_hours THEN 'flagged' ELSE 'valid' END AS _dq_status
    FROM raw_trips""")
_GAP = "(epoch_us(actual_datetime) - epoch_us(scheduled_datetime))"
define("silver_delivery_events", f"""
    SELECT e.*, r.is_timestamp_reversed,
           CASE WHEN r.is_timestamp_reversed THEN 'flagged' ELSE 'valid' END AS _dq_status
    FROM (SELECT *,
                 CAST(sign({_GAP}) * ((abs({_GAP}) + 3000000) // 6000000) / 10.0 AS DECIMAL(10,1))
                     AS arrival_variance_minutes,
                 CASE WHEN {_GAP} <= -7200000000 THEN 'Early' WHEN {_GAP} >= 7200000000 THEN 'Late'
                      ELSE 'On Time' END AS arrival_status,
                 greatest(coalesce(detention_minutes, 0) - 120, 0) AS billable_detention_minutes
          FROM raw_delivery_events) AS e
    LEFT JOIN (SELECT load_id,
                      coalesce(max(CASE WHEN event_type = 'Delivery' THEN actual_datetime END)
                               < max(CASE WHEN event_type = 'Pickup' THEN actual_datetime END), FALSE)
                          AS is_timestamp_reversed
               FROM raw_delivery_events WHERE NOT _is_deleted_in_source AND load_id IS NOT NULL
               GROUP BY load_id) AS r ON r.load_id = e.load_id""")
define("silver_maintenance_records", """
    SELECT * EXCLUDE (service_description), string_split(service_description, ' ')[1] AS service_urgency
    FROM raw_maintenance_records""")
define("silver_safety_incidents", """
    SELECT * EXCLUDE (description, location_state), string_split(description, ' ')[1] AS incident_severity,
           regexp_extract(description, 'involving (.+)$', 1) AS incident_cause,
           CASE WHEN incident_type IN ('Accident', 'Moving Violation') THEN 'Safety'
                WHEN incident_type = 'DOT Violation' THEN 'Regulatory'
                WHEN incident_type = 'Equipment Damage' THEN 'Asset'
                WHEN incident_type = 'Customer Complaint' THEN 'Service' ELSE 'Other' END AS incident_category
    FROM raw_safety_incidents""")
define("silver_fuel_purchases", """
    SELECT p.* EXCLUDE (location_state), coalesce(p.gallons > t.tank_capacity_gallons, FALSE) AS is_capacity_exceeded,
           CASE WHEN p.gallons > t.tank_capacity_gallons THEN 'flagged' ELSE 'valid' END AS _dq_status
    FROM raw_fuel_purchases AS p LEFT JOIN raw_trucks AS t ON t.truck_id = p.truck_id""")
define("us_state", "SELECT * FROM (VALUES " + ", ".join(
    f"('{code}', '{name}')" for code, name in US_STATES.items()) + ") AS v(state_code, state_name)")

# --- dimension sources -------------------------------------------------------------

define("src_customer", f"""
    SELECT customer_id, {rec('customer_name')}, {rec('customer_type')}, {rec('primary_freight_type')},
           {rec('account_status')}, credit_terms_days, contract_start_date, annual_revenue_potential,
           _is_deleted_in_source AS is_deleted_in_source
    FROM raw_customers""")
define("src_trailer", f"""
    SELECT trailer_id, {rec('trailer_number')}, {rec('trailer_type')}, model_year AS trailer_model_year,
           acquisition_date AS trailer_acquisition_date, _is_deleted_in_source AS is_deleted_in_source
    FROM raw_trailers""")
define("src_route", f"""
    SELECT r.route_id, {rec('route_name')}, {rec('origin_city')}, r.origin_state AS origin_state_code,
           coalesce(o.state_name, 'Unknown') AS origin_state_name, {rec('destination_city')},
           r.destination_state AS destination_state_code,
           coalesce(d.state_name, 'Unknown') AS destination_state_name, typical_distance_miles,
           base_rate_per_mile, fuel_surcharge_rate, typical_transit_days,
           r._is_deleted_in_source AS is_deleted_in_source
    FROM silver_routes AS r LEFT JOIN us_state AS o ON o.state_code = r.origin_state
    LEFT JOIN us_state AS d ON d.state_code = r.destination_state""")
define("src_facility", f"""
    SELECT f.facility_id, {rec('facility_name')}, {rec('facility_type')},
           coalesce(f.city, 'Not Recorded') AS facility_city, f.state AS facility_state_code,
           coalesce(u.state_name, 'Unknown') AS facility_state_name, {rec('operating_hours')}, f.dock_doors,
           f.latitude AS facility_latitude, f.longitude AS facility_longitude, TRUE AS is_centroid_coordinate,
           f._is_deleted_in_source AS is_deleted_in_source
    FROM raw_facilities AS f LEFT JOIN us_state AS u ON u.state_code = f.state""")
for _suffix in ("", "_later"):
    define(f"src_driver{_suffix}", f"""
        SELECT driver_id,
               CASE WHEN first_name IS NULL AND last_name IS NULL THEN 'Not Recorded'
                    ELSE trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) END AS driver_name,
               coalesce(home_terminal, 'Not Recorded') AS driver_home_terminal, {rec('employment_status')},
               hire_date AS driver_hire_date, termination_date AS driver_termination_date, years_experience,
               _is_deleted_in_source AS is_deleted_in_source, {dk('_source_changed_at')} AS source_changed_date_key
        FROM raw_drivers{_suffix}""")
    define(f"src_truck{_suffix}", f"""
        SELECT truck_id, {rec('unit_number')}, coalesce(make, 'Not Recorded') AS truck_make,
               coalesce(status, 'Not Recorded') AS truck_status,
               coalesce(home_terminal, 'Not Recorded') AS truck_home_terminal, model_year AS truck_model_year,
               acquisition_date AS truck_acquisition_date, acquisition_mileage, tank_capacity_gallons,
               _is_deleted_in_source AS is_deleted_in_source, {dk('_source_changed_at')} AS source_changed_date_key
        FROM raw_trucks{_suffix}""")
define("src_load_type", f"SELECT load_id, {rec('booking_type')}, {rec('load_type')} FROM raw_loads")
define("src_delivery_status", f"SELECT event_id, {rec('event_type')}, {rec('arrival_status')} "
                              "FROM silver_delivery_events")
define("src_maintenance_class", f"SELECT maintenance_id, {rec('maintenance_type')}, {rec('service_urgency')} "
                                "FROM silver_maintenance_records")
define("src_incident_class", f"""
    SELECT incident_id, {rec('incident_type')}, {rec('incident_category')}, {rec('incident_severity')},
           CASE incident_cause WHEN 'equipment' THEN 'Equipment' WHEN 'other driver' THEN 'Other Driver'
                WHEN 'traffic' THEN 'Traffic' WHEN 'weather' THEN 'Weather'
                ELSE coalesce(incident_cause, 'Not Recorded') END AS incident_cause,
           CASE preventable_flag WHEN TRUE THEN 'Preventable' WHEN FALSE THEN 'Not Preventable'
                ELSE 'Not Recorded' END AS preventable_status,
           CASE at_fault_flag WHEN TRUE THEN 'At Fault' WHEN FALSE THEN 'Not At Fault'
                ELSE 'Not Recorded' END AS at_fault_status,
           CASE injury_flag WHEN TRUE THEN 'Injury' WHEN FALSE THEN 'No Injury' ELSE 'Not Recorded' END
               AS injury_status
    FROM silver_safety_incidents""")

# --- dimensions ----------------------------------------------------------------------

define("bounds", """
    SELECT make_date(CAST(year(a.lo) AS INTEGER), 1, 1) AS first_day,
           make_date(CAST(year(b.hi) AS INTEGER), 12, 31) AS last_day, b.hi AS complete_through
    FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo FROM orders) AS a,
         (SELECT max(CAST(l_shipdate AS DATE)) AS hi FROM lineitem) AS b""")
define("first_day_key", f"SELECT {dk('first_day')} AS k FROM bounds")
define("dim_date", f"""
    SELECT {dk('d')} AS date_key, d AS full_date, year(d) AS calendar_year, quarter(d) AS quarter_number,
           'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_label, month(d) AS month_number,
           monthname(d) AS month_name, year(d) * 100 + month(d) AS year_month_number,
           left(monthname(d), 3) || ' ' || CAST(year(d) AS VARCHAR) AS year_month_label,
           day(d) AS day_of_month, last_day(d) <= (SELECT complete_through FROM bounds) AS is_complete_month
    FROM (SELECT CAST(unnest(generate_series(CAST((SELECT first_day FROM bounds) AS TIMESTAMP),
                                             CAST((SELECT last_day FROM bounds) AS TIMESTAMP),
                                             INTERVAL 1 DAY)) AS DATE) AS d)
    UNION ALL BY NAME
    SELECT k AS date_key, t AS quarter_label, t AS month_name, t AS year_month_label, FALSE AS is_complete_month
    FROM {SPECIALS}""")


def _scd1(name: str, attributes: str, texts: list[str]) -> None:
    define(f"dim_{name}", f"""
        SELECT {number([f'{name}_id'])} AS {name}_key, {name}_id, {attributes},
               (SELECT k FROM first_day_key) AS valid_from_date_key, 99991231 AS valid_to_date_key,
               TRUE AS is_current, is_deleted_in_source AS is_deleted, 'Initial version' AS version_reason
        FROM src_{name}{specials(f'{name}_key', texts)}""")


_scd1("customer", "customer_name, customer_type, primary_freight_type, account_status, credit_terms_days, "
      "contract_start_date, annual_revenue_potential",
      ["customer_name", "customer_type", "primary_freight_type", "account_status"])
_scd1("trailer", "trailer_number, trailer_type, trailer_model_year, trailer_acquisition_date",
      ["trailer_number", "trailer_type"])
_scd1("route", "route_name, origin_city, origin_state_code, origin_state_name, destination_city, "
      "destination_state_code, destination_state_name, typical_distance_miles, base_rate_per_mile, "
      "fuel_surcharge_rate, typical_transit_days",
      ["route_name", "origin_city", "origin_state_name", "destination_city", "destination_state_name"])
_scd1("facility", "facility_name, facility_type, facility_city, facility_state_code, facility_state_name, "
      "operating_hours, dock_doors, facility_latitude, facility_longitude, is_centroid_coordinate",
      ["facility_name", "facility_type", "facility_city", "facility_state_name", "operating_hours"])


TEXT = {"driver_name", "driver_home_terminal", "employment_status", "unit_number", "truck_make", "truck_status",
        "truck_home_terminal"}


def _scd2(name: str, type1: list[str], type2: list[str], why: dict[str, str], label_name: str) -> None:
    ident, key, label = f"{name}_id", f"{name}_key", f"{name}_version_label"

    def labelled(p: str) -> str:
        parts = ", ', ', ".join(f"{p}{c}" for c in label_name.split(",")[1:])
        return f"concat(CAST({p}{ident} AS VARCHAR), ' ', {p}{label_name.split(',')[0]}, ' (', {parts}, ')') AS {label}"

    cols = ", ".join([*type1, *type2])
    texts = [c for c in [*type1, *type2] if c in TEXT] + [label]
    define(f"dim_{name}_first", f"""
        SELECT row_number() OVER (ORDER BY substr(md5(concat_ws('|', CAST({ident} AS VARCHAR),
                                  CAST((SELECT k FROM first_day_key) AS VARCHAR))), 1, 3), {ident}) AS {key},
               {ident}, {cols}, {labelled('')}, (SELECT k FROM first_day_key) AS valid_from_date_key,
               99991231 AS valid_to_date_key, TRUE AS is_current, is_deleted_in_source AS is_deleted,
               'Initial version' AS version_reason
        FROM src_{name}{specials(key, texts)}""")
    diff = " OR ".join(f"d.{c} IS DISTINCT FROM v.{c}" for c in type2)
    define(f"{name}_marked", f"""
        SELECT d.{key}, d.{ident}, v.{ident} IS NOT NULL AS present,
               coalesce(v.{ident} IS NOT NULL AND d.is_current AND ({diff})
                        AND d.valid_from_date_key < v.source_changed_date_key, FALSE) AS expires,
               coalesce(v.{ident} IS NOT NULL AND d.is_current AND ({diff})
                        AND d.valid_from_date_key = v.source_changed_date_key, FALSE) AS overwritten,
               v.source_changed_date_key, v.is_deleted_in_source,
               {', '.join(f'd.{c} AS old_{c}, v.{c} AS new_{c}' for c in [*type1, *type2])},
               d.valid_from_date_key, d.valid_to_date_key, d.is_current, d.version_reason
        FROM dim_{name}_first AS d LEFT JOIN src_{name}_later AS v ON v.{ident} = d.{ident}
        WHERE d.{key} > 0""")
    reason = " || ".join(f"CASE WHEN old_{c} IS DISTINCT FROM new_{c} THEN ' {why[c]}' ELSE '' END" for c in type2)
    define(f"{name}_new", f"""
        SELECT {ident}, {', '.join(f'new_{c} AS {c}' for c in [*type1, *type2])},
               source_changed_date_key AS valid_from_date_key, is_deleted_in_source AS is_deleted,
               'Changed:' || {reason} AS version_reason
        FROM {name}_marked WHERE expires
        UNION ALL
        SELECT {ident}, {cols}, (SELECT k FROM first_day_key), is_deleted_in_source, 'Initial version'
        FROM src_{name}_later AS v
        WHERE NOT EXISTS (SELECT 1 FROM dim_{name}_first AS d WHERE d.{ident} = v.{ident})""")
    define(f"dim_{name}", f"""
        SELECT {key}, {ident}, {cols}, {labelled('')}, valid_from_date_key, valid_to_date_key, is_current,
               is_deleted, version_reason
        FROM (SELECT {key}, {ident},
                     {', '.join(f'CASE WHEN present THEN new_{c} ELSE old_{c} END AS {c}' for c in type1)},
                     {', '.join(f'CASE WHEN overwritten THEN new_{c} ELSE old_{c} END AS {c}' for c in type2)},
                     valid_from_date_key,
                     CASE WHEN expires THEN source_changed_date_key ELSE valid_to_date_key END AS valid_to_date_key,
                     is_current AND NOT expires AS is_current,
                     coalesce(is_deleted_in_source, TRUE) AS is_deleted, version_reason
              FROM {name}_marked)
        UNION ALL BY NAME
        SELECT (SELECT max({key}) FROM dim_{name}_first) + {number([ident, 'valid_from_date_key'])} AS {key},
               {ident}, {cols}, {labelled('')}, valid_from_date_key, 99991231 AS valid_to_date_key,
               TRUE AS is_current, is_deleted, version_reason
        FROM {name}_new{specials(key, texts)}""")


_scd2("driver", ["driver_name", "driver_hire_date", "years_experience"],
      ["driver_home_terminal", "employment_status", "driver_termination_date"],
      {"driver_home_terminal": "home_terminal", "employment_status": "employment_status",
       "driver_termination_date": "termination_date"}, "driver_name,driver_home_terminal,employment_status")
_scd2("truck", ["unit_number", "truck_make", "truck_model_year", "truck_acquisition_date", "acquisition_mileage",
                "tank_capacity_gallons"], ["truck_status", "truck_home_terminal"],
      {"truck_status": "status", "truck_home_terminal": "home_terminal"},
      "unit_number,truck_home_terminal,truck_status")


def _junk(name: str, columns: list[str]) -> None:
    define(f"dim_{name}", f"""
        SELECT {number(columns)} AS {name}_key, {', '.join(columns)}
        FROM (SELECT DISTINCT {', '.join(columns)} FROM src_{name}){junk_specials(f'{name}_key', columns)}""")


CLASS = ["incident_type", "incident_category", "incident_severity", "incident_cause", "preventable_status",
         "at_fault_status", "injury_status"]
_junk("load_type", ["booking_type", "load_type"])
_junk("delivery_status", ["event_type", "arrival_status"])
_junk("maintenance_class", ["maintenance_type", "service_urgency"])
_junk("incident_class", CLASS)
define("city_pairs", """
    SELECT city, state, 1 AS rank FROM raw_facilities
    UNION ALL SELECT origin_city, origin_state, 2 FROM raw_routes
    UNION ALL SELECT destination_city, destination_state, 2 FROM raw_routes
    UNION ALL SELECT location_city, location_state, 3 FROM raw_delivery_events""")
define("city_state_map", """
    SELECT city AS location_city, min(state) AS location_state_code, min(rank) AS state_rank
    FROM city_pairs WHERE city IS NOT NULL AND state IS NOT NULL
    GROUP BY city HAVING count(DISTINCT state) = 1""")
define("event_cities", """
    SELECT location_city FROM raw_fuel_purchases WHERE location_city IS NOT NULL
    UNION SELECT location_city FROM raw_safety_incidents WHERE location_city IS NOT NULL
    UNION SELECT facility_location FROM raw_maintenance_records WHERE facility_location IS NOT NULL""")
define("located_cities", """
    SELECT location_city, location_state_code, coalesce(state_name, 'Unknown') AS location_state_name, state_rank
    FROM event_cities JOIN city_state_map USING (location_city)
    LEFT JOIN us_state ON state_code = location_state_code""")
define("dim_location", f"""
    SELECT {number(['location_city'])} AS location_key, location_city, location_state_code, location_state_name,
           'United States' AS location_country,
           CASE state_rank WHEN 1 THEN 'silver_facilities' WHEN 2 THEN 'silver_routes'
                ELSE 'silver_delivery_events' END AS state_source
    FROM located_cities{junk_specials('location_key', ['location_city', 'location_state_name', 'location_country',
                                                       'state_source'])}""")

# --- facts ------------------------------------------------------------------------------


def _asof(dim: str, ref: str, day: str, alias: str) -> str:
    return (f"LEFT JOIN dim_{dim} AS {alias} ON {alias}.{dim}_id = {ref} AND {alias}.{dim}_key > 0 "
            f"AND {day} >= {alias}.valid_from_date_key AND {day} < {alias}.valid_to_date_key")


def _date(alias: str, day: str) -> str:
    return f"LEFT JOIN dim_date AS {alias} ON {alias}.date_key = {day} AND {alias}.date_key > 0"


def _key(ref: str, key: str) -> str:
    return f"CASE WHEN {ref} IS NULL THEN 0 ELSE coalesce({key}, -1) END"


def _datekey(value: str, alias: str, missing: int = 0) -> str:
    return f"CASE WHEN {value} IS NULL THEN {missing} ELSE coalesce({alias}.date_key, -1) END"


define("fact_trip", f"""
    SELECT {_datekey('s.dispatch_date', 'dd')} AS dispatch_date_key, {_key('s.driver_id', 'dr.driver_key')} AS driver_key,
           {_key('s.truck_id', 'tk.truck_key')} AS truck_key, {_key('s.trailer_id', 'tl.trailer_key')} AS trailer_key,
           CASE WHEN s.load_id IS NULL THEN 0 WHEN l.load_id IS NULL THEN -1
                ELSE {_key('l.route_id', 'rt.route_key')} END AS route_key,
           s.trip_id, s.load_id, s.actual_distance_miles, s.actual_duration_hours, s.fuel_gallons_used,
           s.idle_time_hours, s.is_idle_implausible, s._is_deleted_in_source AS is_deleted_in_source
    FROM (SELECT *, {dk('dispatch_date')} AS day FROM silver_trips) AS s
    LEFT JOIN raw_loads AS l ON l.load_id = s.load_id
    {_date('dd', 's.day')} {_asof('driver', 's.driver_id', 's.day', 'dr')}
    {_asof('truck', 's.truck_id', 's.day', 'tk')} {_asof('trailer', 's.trailer_id', 's.day', 'tl')}
    {_asof('route', 'l.route_id', 's.day', 'rt')}""")
define("fact_delivery_event", f"""
    SELECT {_datekey('s.scheduled_datetime', 'sd')} AS scheduled_date_key,
           {_datekey('s.actual_datetime', 'ad')} AS actual_date_key,
           {_key('s.facility_id', 'fc.facility_key')} AS facility_key,
           CASE WHEN s.load_id IS NULL THEN 0 WHEN l.load_id IS NULL THEN -1
                ELSE {_key('l.route_id', 'rt.route_key')} END AS route_key,
           coalesce(ds.delivery_status_key, -1) AS delivery_status_key, s.event_id, s.load_id, s.trip_id,
           s.scheduled_datetime, s.actual_datetime, s.detention_minutes, s.billable_detention_minutes,
           s.arrival_variance_minutes, s._is_deleted_in_source AS is_deleted_in_source
    FROM (SELECT *, {dk('scheduled_datetime')} AS sday, {dk('actual_datetime')} AS aday,
                 {dk('coalesce(actual_datetime, scheduled_datetime)')} AS day FROM silver_delivery_events) AS s
    LEFT JOIN raw_loads AS l ON l.load_id = s.load_id
    {_date('sd', 's.sday')} {_date('ad', 's.aday')} {_asof('facility', 's.facility_id', 's.day', 'fc')}
    {_asof('route', 'l.route_id', 's.day', 'rt')}
    LEFT JOIN dim_delivery_status AS ds ON ds.event_type = s.event_type AND ds.arrival_status = s.arrival_status
        AND ds.delivery_status_key > 0""")
define("fact_fuel_purchase", f"""
    SELECT {_datekey('s.purchase_date', 'dd')} AS purchase_date_key, {_key('s.truck_id', 'tk.truck_key')} AS truck_key,
           {_key('s.driver_id', 'dr.driver_key')} AS driver_key,
           CASE WHEN s.trip_id IS NULL THEN 0 WHEN t.trip_id IS NULL THEN -1 WHEN t.load_id IS NULL THEN 0
                WHEN l.load_id IS NULL THEN -1 ELSE {_key('l.route_id', 'rt.route_key')} END AS route_key,
           {_key('s.location_city', 'lc.location_key')} AS location_key, s.fuel_purchase_id, s.trip_id, s.gallons,
           s.total_cost, s.is_capacity_exceeded, s._is_deleted_in_source AS is_deleted_in_source
    FROM (SELECT *, {dk('purchase_date')} AS day FROM silver_fuel_purchases) AS s
    LEFT JOIN raw_trips AS t ON t.trip_id = s.trip_id LEFT JOIN raw_loads AS l ON l.load_id = t.load_id
    {_date('dd', 's.day')} {_asof('truck', 's.truck_id', 's.day', 'tk')}
    {_asof('driver', 's.driver_id', 's.day', 'dr')} {_asof('route', 'l.route_id', 's.day', 'rt')}
    LEFT JOIN dim_location AS lc ON lc.location_city = s.location_city AND lc.location_key > 0""")
define("fact_maintenance", f"""
    SELECT {_datekey('s.maintenance_date', 'dd')} AS maintenance_date_key,
           {_key('s.truck_id', 'tk.truck_key')} AS truck_key,
           {_key('s.facility_location', 'lc.location_key')} AS location_key,
           coalesce(mc.maintenance_class_key, -1) AS maintenance_class_key, s.maintenance_id, s.labor_hours,
           s.labor_cost, s.parts_cost, s.downtime_hours, s.odometer_reading,
           s._is_deleted_in_source AS is_deleted_in_source
    FROM (SELECT *, {dk('maintenance_date')} AS day FROM silver_maintenance_records) AS s
    {_date('dd', 's.day')} {_asof('truck', 's.truck_id', 's.day', 'tk')}
    LEFT JOIN dim_location AS lc ON lc.location_city = s.facility_location AND lc.location_key > 0
    LEFT JOIN dim_maintenance_class AS mc ON mc.maintenance_type = s.maintenance_type
        AND mc.service_urgency = s.service_urgency AND mc.maintenance_class_key > 0""")
define("fact_safety_incident", f"""
    SELECT {_datekey('s.incident_date', 'dd')} AS incident_date_key, {_key('s.driver_id', 'dr.driver_key')} AS driver_key,
           {_key('s.truck_id', 'tk.truck_key')} AS truck_key, {_key('s.location_city', 'lc.location_key')} AS location_key,
           coalesce(ic.incident_class_key, -1) AS incident_class_key, s.incident_id, s.trip_id,
           s.vehicle_damage_cost, s.cargo_damage_cost, s._is_deleted_in_source AS is_deleted_in_source
    FROM (SELECT *, {dk('incident_date')} AS day FROM silver_safety_incidents) AS s
    JOIN src_incident_class AS v ON v.incident_id = s.incident_id
    {_date('dd', 's.day')} {_asof('driver', 's.driver_id', 's.day', 'dr')}
    {_asof('truck', 's.truck_id', 's.day', 'tk')}
    LEFT JOIN dim_location AS lc ON lc.location_city = s.location_city AND lc.location_key > 0
    LEFT JOIN dim_incident_class AS ic ON {' AND '.join(f'ic.{c} = v.{c}' for c in CLASS)}
        AND ic.incident_class_key > 0""")
define("live_trips", "SELECT * FROM raw_trips WHERE NOT _is_deleted_in_source AND load_id IS NOT NULL")
define("live_milestones", """
    SELECT e.* FROM raw_delivery_events AS e
    JOIN live_trips AS t ON t.trip_id = e.trip_id AND t.load_id = e.load_id
    WHERE NOT e._is_deleted_in_source AND e.event_type IN ('Pickup', 'Delivery')""")
define("fulfilling", """
    SELECT load_id, trip_id FROM (
        SELECT t.load_id, t.trip_id, row_number() OVER (
            PARTITION BY t.load_id
            ORDER BY CASE WHEN d.trip_id IS NOT NULL THEN 0 ELSE 1 END, t.dispatch_date DESC NULLS LAST,
                     t.trip_id DESC) AS rn
        FROM live_trips AS t
        LEFT JOIN live_milestones AS d ON d.trip_id = t.trip_id AND d.event_type = 'Delivery'
            AND d.actual_datetime IS NOT NULL) WHERE rn = 1""")
define("fact_load_lifecycle", f"""
    SELECT {_datekey('s.load_date', 'bd')} AS booked_date_key,
           CASE WHEN s.trip_id IS NULL THEN -2 ELSE {_datekey('s.dispatch_date', 'xd')} END AS dispatched_date_key,
           {_datekey('s.picked_at', 'pd', -2)} AS pickup_date_key,
           {_datekey('s.delivered_at', 'vd', -2)} AS delivery_date_key,
           {_key('s.customer_id', 'cu.customer_key')} AS customer_key, {_key('s.route_id', 'rt.route_key')} AS route_key,
           coalesce(lt.load_type_key, -1) AS load_type_key,
           CASE WHEN s.trip_id IS NULL THEN -2 ELSE {_key('s.driver_id', 'dr.driver_key')} END AS fulfilling_driver_key,
           CASE WHEN s.trip_id IS NULL THEN -2 ELSE {_key('s.truck_id', 'tk.truck_key')} END AS fulfilling_truck_key,
           CASE WHEN s.trip_id IS NULL THEN -2 ELSE {_key('s.trailer_id', 'tl.trailer_key')} END
               AS fulfilling_trailer_key,
           s.load_id, s.revenue, s.fuel_surcharge, s.accessorial_charges, s.weight_lbs, s.pieces,
           date_diff('day', s.load_date, s.dispatch_date) AS booking_to_dispatch_days,
           {hours('s.dispatch_date', 's.picked_at')} AS dispatch_to_pickup_hours,
           CASE WHEN s.delivered_at < s.picked_at THEN NULL ELSE {hours('s.picked_at', 's.delivered_at')} END
               AS pickup_to_delivery_hours,
           {hours('s.load_date', 's.delivered_at')} AS booking_to_delivery_hours,
           coalesce(s.delivered_at < s.picked_at, FALSE) AS is_timestamp_reversed,
           s._is_deleted_in_source AS is_deleted_in_source
    FROM (SELECT l.*, v.booking_type AS booking, v.load_type AS kind, t.trip_id, t.dispatch_date, t.driver_id,
                 t.truck_id, t.trailer_id, pk.actual_datetime AS picked_at, dv.actual_datetime AS delivered_at,
                 {dk('l.load_date')} AS bday, {dk('t.dispatch_date')} AS xday,
                 {dk('pk.actual_datetime')} AS pday, {dk('dv.actual_datetime')} AS vday
          FROM raw_loads AS l JOIN src_load_type AS v ON v.load_id = l.load_id
          LEFT JOIN fulfilling AS f ON f.load_id = l.load_id
          LEFT JOIN live_trips AS t ON t.trip_id = f.trip_id
          LEFT JOIN live_milestones AS pk ON pk.trip_id = f.trip_id AND pk.event_type = 'Pickup'
          LEFT JOIN live_milestones AS dv ON dv.trip_id = f.trip_id AND dv.event_type = 'Delivery') AS s
    {_date('bd', 's.bday')} {_date('xd', 's.xday')} {_date('pd', 's.pday')} {_date('vd', 's.vday')}
    {_asof('customer', 's.customer_id', 's.bday', 'cu')} {_asof('route', 's.route_id', 's.bday', 'rt')}
    LEFT JOIN dim_load_type AS lt ON lt.booking_type = s.booking AND lt.load_type = s.kind AND lt.load_type_key > 0
    {_asof('driver', 's.driver_id', 's.xday', 'dr')} {_asof('truck', 's.truck_id', 's.xday', 'tk')}
    {_asof('trailer', 's.trailer_id', 's.xday', 'tl')}""")
