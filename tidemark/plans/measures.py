"""The measure catalogue and the drill-across query over it.

A base measure is one aggregate over one fact; a derived measure combines others. A query
aggregates each fact on its own to the requested dimension attributes and joins only the
aggregates, so facts never multiply each other. An attribute of a dimension a fact does not
relate to neither groups nor filters that fact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.compare import mean, ratio
from tidemark.plans.star import DIMS, Star

#: fact -> dimension -> the fact's key column.
RELATIONS = {
    "trip": {"date": "dispatch_date_key", "driver": "driver_key", "truck": "truck_key", "trailer": "trailer_key",
             "route": "route_key"},
    "delivery_event": {"date": "scheduled_date_key", "facility": "facility_key", "route": "route_key",
                       "delivery_status": "delivery_status_key"},
    "fuel_purchase": {"date": "purchase_date_key", "truck": "truck_key", "driver": "driver_key",
                      "route": "route_key", "location": "location_key"},
    "maintenance": {"date": "maintenance_date_key", "truck": "truck_key", "location": "location_key",
                    "maintenance_class": "maintenance_class_key"},
    "safety_incident": {"date": "incident_date_key", "driver": "driver_key", "truck": "truck_key",
                        "location": "location_key", "incident_class": "incident_class_key"},
    "load_lifecycle": {"date": "dispatched_date_key", "customer": "customer_key", "route": "route_key",
                       "load_type": "load_type_key", "driver": "fulfilling_driver_key",
                       "truck": "fulfilling_truck_key", "trailer": "fulfilling_trailer_key"},
    "customer": {"customer": "customer_key"},
}
#: Alternative date roles; each re-dates the measures of one fact only.
DATE_ROLES = {
    "stop_scheduled": ("delivery_event", "scheduled_date_key"),
    "stop_actual": ("delivery_event", "actual_date_key"),
    "load_dispatch": ("load_lifecycle", "dispatched_date_key"),
    "load_booked": ("load_lifecycle", "booked_date_key"),
    "load_pickup": ("load_lifecycle", "pickup_date_key"),
    "load_delivery": ("load_lifecycle", "delivery_date_key"),
}


@dataclass(frozen=True)
class Base:
    """One aggregate over the live rows of a fact; needs lists attributes it reads, reads the fact's own columns."""
    fact: str
    total: Callable[[], Column]
    needs: tuple[str, ...] = ()
    ignores: tuple[str, ...] = ()   # dimensions, or attributes, whose grouping and filters it drops
    reads: tuple[str, ...] = ()


@dataclass(frozen=True)
class Derived:
    of: tuple[str, ...]
    combine: Callable[..., Column]
    blank_by: str | None = None     # NULL when this dimension groups or filters the query


def _c(name: str) -> Column:
    return F.col(name)


def _total(*parts: Column) -> Column:
    """A sum in which a missing part counts as zero, missing when all parts are."""
    zero = F.lit(0)
    out = F.coalesce(parts[0], zero)
    for p in parts[1:]:
        out = out + F.coalesce(p, zero)
    return F.when(F.coalesce(*parts).isNotNull(), out)


def _less(a: Column, b: Column) -> Column:
    zero = F.lit(0)
    return F.when(F.coalesce(a, b).isNotNull(), F.coalesce(a, zero) - F.coalesce(b, zero))


def _count() -> Callable[[], Column]:
    return lambda: F.count(F.lit(1))


def _price() -> Column:
    cost, gallons = _c("total_cost").cast("double"), _c("gallons").cast("double")
    return F.when(gallons > 0, cost / F.nullif(gallons, F.lit(0.0)))


_DELIVERY = ("delivery_status.event_type", "delivery_status.arrival_status")
_CLASS = ("incident_class.preventable_status", "incident_class.at_fault_status")


def _status(value: str) -> Base:
    return Base("delivery_event", lambda: F.count_if(
        (_c("event_type") == "Delivery") & (_c("arrival_status") == value)), _DELIVERY)


def _active(dim: str) -> Base:
    return Base("trip", lambda: F.countDistinct(F.when(_c(f"{dim}_key") > 0, _c(f"{dim}_id"))), (f"{dim}.{dim}_id",))


def _share_recorded(column: str, value: str) -> tuple[Base, Base]:
    return (Base("safety_incident", lambda: F.count_if(_c(column) == value), _CLASS),
            Base("safety_incident", lambda: F.count_if(_c(column) != "Not Recorded"), _CLASS))


_preventable, _preventable_known = _share_recorded("preventable_status", "Preventable")
_fault, _fault_known = _share_recorded("at_fault_status", "At Fault")

MEASURES: dict[str, Base | Derived] = {
    # loads
    "loads": Base("load_lifecycle", _count()),
    "line_haul_revenue": Base("load_lifecycle", lambda: F.sum("revenue"), reads=("revenue",)),
    "fuel_surcharge": Base("load_lifecycle", lambda: F.sum("fuel_surcharge"), reads=("fuel_surcharge",)),
    "accessorial_charges": Base("load_lifecycle", lambda: F.sum("accessorial_charges"), reads=("accessorial_charges",)),
    "total_charges": Derived(("line_haul_revenue", "fuel_surcharge", "accessorial_charges"), _total),
    "contribution_after_fuel": Derived(("total_charges", "fuel_cost"), _less),
    "line_haul_revenue_per_mile": Derived(("line_haul_revenue", "actual_miles"), ratio),
    "line_haul_revenue_per_active_truck": Derived(("line_haul_revenue", "active_trucks"), ratio),
    "miles_per_active_truck": Derived(("actual_miles", "active_trucks"), ratio),
    "loads_per_active_truck": Derived(("loads", "active_trucks"), ratio),
    "line_haul_revenue_per_load": Derived(("line_haul_revenue", "loads"), ratio),
    "_revenue_all_customers": Base("load_lifecycle", lambda: F.sum("revenue"), ignores=("customer",), reads=("revenue",)),
    "share_of_line_haul_revenue": Derived(("line_haul_revenue", "_revenue_all_customers"), ratio),
    # stops
    "delivery_events": Base("delivery_event", lambda: F.count_if(_c("event_type") == "Delivery"), _DELIVERY),
    "on_time_deliveries": _status("On Time"),
    "early_deliveries": _status("Early"),
    "late_deliveries": _status("Late"),
    "on_time_rate": Derived(("on_time_deliveries", "delivery_events"), ratio),
    "early_rate": Derived(("early_deliveries", "delivery_events"), ratio),
    "late_rate": Derived(("late_deliveries", "delivery_events"), ratio),
    "average_arrival_variance_minutes": Base("delivery_event", lambda: mean(
        F.when(_c("event_type") == "Delivery", _c("arrival_variance_minutes"))), _DELIVERY, reads=("arrival_variance_minutes",)),
    "stop_events": Base("delivery_event", _count()),
    "average_detention_minutes": Base("delivery_event", lambda: mean(_c("detention_minutes")), reads=("detention_minutes",)),
    "billable_detention_minutes": Base("delivery_event",
                                       lambda: F.sum(_c("billable_detention_minutes").cast("bigint")), reads=("billable_detention_minutes",)),
    "stops_over_free_time": Base("delivery_event", lambda: F.count_if(_c("billable_detention_minutes") > 0), reads=("billable_detention_minutes",)),
    "_stops_with_detention": Base("delivery_event", lambda: F.count_if(_c("detention_minutes") > 0), reads=("detention_minutes",)),
    "share_of_stops_with_detention": Derived(("_stops_with_detention", "stop_events"), ratio),
    # fuel
    "fuel_cost": Base("fuel_purchase", lambda: F.sum("total_cost"), reads=("total_cost",)),
    "gallons_purchased": Base("fuel_purchase", lambda: F.sum("gallons"), reads=("gallons",)),
    "average_price_per_gallon": Derived(("fuel_cost", "gallons_purchased"), ratio),
    "lowest_price_paid": Base("fuel_purchase", lambda: F.min(_price()), reads=("total_cost", "gallons")),
    "highest_price_paid": Base("fuel_purchase", lambda: F.max(_price()), reads=("total_cost", "gallons")),
    "_fuel_all_locations": Base("fuel_purchase", lambda: F.sum("total_cost"), ignores=("location",), reads=("total_cost",)),
    "share_of_fuel_spend": Derived(("fuel_cost", "_fuel_all_locations"), ratio),
    "fuel_cost_per_mile": Derived(("fuel_cost", "actual_miles"), ratio),
    # trips
    "trips": Base("trip", _count()),
    "actual_miles": Base("trip", lambda: F.sum(_c("actual_distance_miles").cast("bigint")), reads=("actual_distance_miles",)),
    "trip_fuel_gallons": Base("trip", lambda: F.sum("fuel_gallons_used"), reads=("fuel_gallons_used",)),
    "idle_hours": Base("trip", lambda: F.sum("idle_time_hours"), reads=("idle_time_hours",)),
    "active_days": Base("trip", lambda: F.countDistinct("dispatch_date_key"), reads=("dispatch_date_key",)),
    "active_trucks": _active("truck"),
    "active_drivers": _active("driver"),
    "drivers_per_truck": Derived(("active_drivers", "active_trucks"), ratio),
    "trips_per_active_truck": Derived(("trips", "active_trucks"), ratio),
    "gallons_per_mile": Derived(("trip_fuel_gallons", "actual_miles"), ratio, blank_by="driver"),
    # maintenance
    "maintenance_events": Base("maintenance", _count()),
    "labor_cost": Base("maintenance", lambda: F.sum("labor_cost"), reads=("labor_cost",)),
    "parts_cost": Base("maintenance", lambda: F.sum("parts_cost"), reads=("parts_cost",)),
    "maintenance_cost": Derived(("labor_cost", "parts_cost"), _total),
    "downtime_hours": Base("maintenance", lambda: F.sum("downtime_hours"), reads=("downtime_hours",)),
    "maintenance_cost_per_mile": Derived(("maintenance_cost", "actual_miles"), ratio),
    # safety
    "incidents": Base("safety_incident", _count()),
    "claim_cost": Base("safety_incident", lambda: F.sum("vehicle_damage_cost") + F.sum("cargo_damage_cost"), reads=("vehicle_damage_cost", "cargo_damage_cost")),
    "_preventable": _preventable,
    "_preventable_known": _preventable_known,
    "preventable_rate": Derived(("_preventable", "_preventable_known"), ratio),
    "_at_fault": _fault,
    "_at_fault_known": _fault_known,
    "at_fault_rate": Derived(("_at_fault", "_at_fault_known"), ratio),
    # customers
    "average_credit_terms_days": Base("customer", lambda: mean(_c("credit_terms_days")), reads=("credit_terms_days",)),
    # bands
    "deliveries_in_band": Base("delivery_event", lambda: F.count_if(
        (_c("event_type") == "Delivery") & _c("band_start").isNotNull()), _DELIVERY, reads=("arrival_variance_minutes",)),
    "_deliveries_any_status": Base("delivery_event", lambda: F.count_if(_c("event_type") == "Delivery"), _DELIVERY,
                                   ignores=("delivery_status.arrival_status", "band.band_start")),
    "share_of_deliveries_in_band": Derived(("deliveries_in_band", "_deliveries_any_status"), ratio),
}

# Thirty-minute bands from -180 to 360 minutes, the last one closed.
BAND_FROM, BAND_TO, BAND_WIDTH = -180, 360, 30


def variance_band(variance: Column) -> Column:
    """The start of the band a variance falls in; NULL outside all bands."""
    start = (F.floor(variance / BAND_WIDTH) * BAND_WIDTH).cast("int")
    inside = (variance >= BAND_FROM) & (variance <= BAND_TO)
    return F.when(inside, F.least(start, F.lit(BAND_TO - BAND_WIDTH)))


def _split(attribute: str) -> tuple[str, str]:
    dim, column = attribute.split(".")
    return dim, column


class _Scope:
    """The rows of one fact with the attributes a set of measures, groups and filters needs."""

    def __init__(self, star: Star, fact: str, date_role: str | None):
        self.star, self.fact = star, fact
        self.keys = dict(RELATIONS[fact])
        if date_role and DATE_ROLES[date_role][0] == fact:
            self.keys["date"] = DATE_ROLES[date_role][1]

    def relates(self, attribute: str) -> bool:
        dim, _ = _split(attribute)
        return dim in self.keys or (dim == "band" and self.fact == "delivery_event")

    def columns(self, names: Sequence[str], attributes: Sequence[str]) -> list[str]:
        """The fact's columns that measures and attributes read."""
        dims = {_split(a)[0] for a in attributes}
        own = {self.keys[d] for d in dims - {"band"}} | ({"arrival_variance_minutes"} if "band" in dims else set())
        return sorted(own.union(*[MEASURES[n].reads for n in names], ["is_deleted_in_source"]))

    def rows(self, names: Sequence[str], attributes: Sequence[str], filters: Sequence[tuple[str, Sequence]]) -> DataFrame:
        if self.fact == "customer":
            df = self.star.dim("customer").where(F.col("is_current") & (F.col("customer_key") > 0))
        else:
            needed = self.columns(names, [*attributes, *[a for a, _ in filters]])
            df = self.star.fact_part(self.fact, *needed).where(~F.col("is_deleted_in_source"))
        wanted: dict[str, set[str]] = {}
        for attribute in [*attributes, *[a for a, _ in filters]]:
            dim, column = _split(attribute)
            wanted.setdefault(dim, set()).add(column)
        if "band" in wanted:
            df = df.withColumn("band_start", variance_band(F.col("arrival_variance_minutes")))
        for dim in sorted(wanted.keys() - {"band"}):
            columns = sorted(wanted[dim] - set(df.columns))
            if not columns:
                continue
            members = self.star.dim(dim)
            if dim == "date":   # the calendar, so a special date has no attributes
                members = members.where(F.col("date_key") > 0)
            key = DIMS[dim][0]
            members = members.select(F.col(key).alias(f"_{dim}"), *columns)
            df = df.join(members, F.col(self.keys[dim]) == F.col(f"_{dim}"), "left").drop(f"_{dim}")
        for attribute, values in filters:
            df = df.where(F.col(_split(attribute)[1]).isin(*values))
        return df


def _bases(names: Sequence[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        measure = MEASURES[name]
        inner = [name] if isinstance(measure, Base) else _bases(measure.of)
        out += [n for n in inner if n not in out]
    return out


def _value(name: str, blank: set[str]) -> Column:
    measure = MEASURES[name]
    if isinstance(measure, Base):
        return F.col(f"m_{name}")
    if measure.blank_by in blank:
        return F.lit(None).cast("double")
    return measure.combine(*[_value(n, blank) for n in measure.of])


def query(star: Star, measures: Sequence[str], group_by: Sequence[str] = (),
          filters: Sequence[tuple[str, Sequence]] = (), date_role: str | None = None) -> DataFrame:
    """Measures by dimension attributes ("route.route_name"), filtered, under one date role.

    Ratios divide totals and are NULL on zero. Combinations nobody has a row for are absent.
    """
    columns = [_split(g)[1] for g in group_by]
    plans: dict[tuple, list[str]] = {}
    for name in _bases(measures):
        base = MEASURES[name]
        scope = _Scope(star, base.fact, date_role)

        def kept(attribute: str, base=base, scope=scope) -> bool:
            return (scope.relates(attribute) and attribute not in base.ignores
                    and _split(attribute)[0] not in base.ignores)

        groups = tuple(g for g in group_by if kept(g))
        active = tuple((a, tuple(v)) for a, v in filters if kept(a))
        plans.setdefault((base.fact, groups, active), []).append(name)

    # a fact that several plans read is computed once
    read: dict[str, list[set[str]]] = {}
    for (fact, groups, active), names in plans.items():
        needs = [n for m in names for n in MEASURES[m].needs]
        read.setdefault(fact, []).append({*_Scope(star, fact, date_role).columns(names, [*groups, *needs, *[a for a, _ in active]])})
    for fact, sets in read.items():
        if len(sets) > 1 and fact != "customer":
            star.hold(fact, *sorted(set().union(*sets)))

    full, partial = [], []
    for (fact, groups, active), names in plans.items():
        needs = sorted({n for m in names for n in MEASURES[m].needs})
        rows = _Scope(star, fact, date_role).rows(names, [*groups, *needs], active)
        keys = [_split(g)[1] for g in groups]
        totals = rows.groupBy(*keys).agg(*[MEASURES[n].total().alias(f"m_{n}") for n in names])
        (full if list(groups) == list(group_by) else partial).append((keys, names, totals))

    # Aggregates over all requested attributes are stacked and folded, which treats a NULL
    # attribute as a value; each measure has one row per group, so max just picks it.
    stacked = None
    for _, _, totals in full:
        stacked = totals if stacked is None else stacked.unionByName(totals, allowMissingColumns=True)
    picked = [n for _, names, _ in full for n in names]
    out = stacked.groupBy(*columns).agg(*[F.max(f"m_{n}").alias(f"m_{n}") for n in picked])
    for keys, names, totals in partial:
        if keys:
            side = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[f"m_{n}" for n in names])
            on = F.lit(True)
            for k in keys:
                on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
            out = out.join(side, on, "left").drop(*[f"_k_{k}" for k in keys])
        else:   # a grand total: one row, read as a scalar
            packed = totals.select(F.struct(*[f"m_{n}" for n in names]).alias("t")).scalar()
            out = out.withColumn("_t", packed).select("*", *[F.col(f"_t.m_{n}") for n in names]).drop("_t")
    blank = {_split(a)[0] for a in [*group_by, *[a for a, _ in filters]]}
    return out.select(*columns, *[_value(m, blank).alias(m) for m in measures])


def drill_across(spine: DataFrame, key: str, *aggregates: DataFrame) -> DataFrame:
    """Aggregates of several facts on one shared key, joined to the dimension, never to each other."""
    out = spine
    for part in aggregates:
        out = out.join(part, key, "left")
    return out
