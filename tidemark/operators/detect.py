"""Which fact keys a run must rebuild: changed rows, their children, and gold that needs healing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]


def _children(table: DataFrame, parents: DataFrame, link: str, key: str) -> DataFrame:
    """Keys of the rows whose link is among the parents' ids."""
    changed = parents.select(link).where(F.col(link).isNotNull()).distinct()
    return table.join(changed, link, "left_semi").select(key)


def _keys(key: str, *frames: DataFrame) -> DataFrame:
    out = frames[0].select(key)
    for other in frames[1:]:
        out = out.unionByName(other.select(key))
    return out.where(F.col(key).isNotNull()).distinct()


def affected_trips(changes: Tables, silver: Tables) -> DataFrame:
    """Changed trips, and the trips of changed loads."""
    return _keys("trip_id", changes["trips"], _children(silver["trips"], changes["loads"], "load_id", "trip_id"))


def affected_delivery_events(changes: Tables, silver: Tables) -> DataFrame:
    """Changed events, and the events of changed loads."""
    return _keys("event_id", changes["delivery_events"],
                 _children(silver["delivery_events"], changes["loads"], "load_id", "event_id"))


def affected_fuel_purchases(changes: Tables, silver: Tables) -> DataFrame:
    """Changed purchases, and the purchases of changed trips and of the trips of changed loads."""
    return _keys("fuel_purchase_id", changes["fuel_purchases"],
                 _children(silver["fuel_purchases"], affected_trips(changes, silver), "trip_id",
                           "fuel_purchase_id"))


def affected_maintenance(changes: Tables, silver: Tables) -> DataFrame:
    return _keys("maintenance_id", changes["maintenance_records"])


def affected_safety_incidents(changes: Tables, silver: Tables) -> DataFrame:
    return _keys("incident_id", changes["safety_incidents"])


def affected_loads(changes: Tables, silver: Tables) -> DataFrame:
    """Changed loads and the loads named by changed trips and events.

    The change rows hold pre-images too, so a load that lost a trip or event is named.
    """
    return _keys("load_id", changes["loads"], changes["trips"], changes["delivery_events"])


def full_reconcile_keys(silver: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """Every key of both sides, so that a key gone from silver still reaches the loader."""
    return _keys(key, silver, gold)


# --- healing ------------------------------------------------------------------

@dataclass(frozen=True)
class KeyLink:
    """One surrogate key of a fact and the dimension it points into."""
    column: str
    dim: str
    dim_key: str
    dim_id: str | None = None       # business id, for versioned dimensions
    date_column: str | None = None  # the fact date its version is taken at


def heal_unknown(fact: DataFrame, key: str, key_columns: Sequence[str]) -> DataFrame:
    """Active rows with a failed lookup: the dimension row may have arrived since."""
    failed = F.array_contains(F.array(*[F.col(c).cast("bigint") for c in key_columns]), -1)
    return fact.where(~F.col("is_deleted_in_source") & failed).select(key)


def heal_wrong_version(fact: DataFrame, dim: DataFrame, key: str, link: KeyLink) -> DataFrame:
    """Rows whose member has another version valid at the fact's own date."""
    versions = dim.where(F.col(link.dim_key) > 0)
    pointed = versions.select(F.col(link.dim_key).alias("_key"), F.col(link.dim_id).alias("_id"))
    valid = versions.select(F.col(link.dim_id).alias("_vid"), F.col(link.dim_key).alias("_valid_key"),
                            "valid_from_date_key", "valid_to_date_key")
    rows = fact.where(F.col(link.column) > 0).select(key, link.column, link.date_column)
    day = F.col(link.date_column)
    return (
        rows.join(pointed, F.col(link.column) == F.col("_key"))
        .join(valid, (F.col("_vid") == F.col("_id")) & (day >= F.col("valid_from_date_key"))
              & (day < F.col("valid_to_date_key")))
        .where(F.col("_valid_key") != F.col(link.column)).select(key))


def heal_orphans(fact: DataFrame, dims: Tables, key: str, links: Sequence[KeyLink]) -> DataFrame:
    """Rows with a key no dimension row has: one anti join per key column."""
    out = None
    for link in links:
        known = dims[link.dim].select(F.col(link.dim_key).alias(link.column))
        lost = fact.select(key, link.column).join(known, link.column, "left_anti").select(key)
        out = lost if out is None else out.unionByName(lost)
    return out.distinct()


def heal_keys(fact: DataFrame, dims: Tables, key: str, key_columns: Sequence[str],
              links: Sequence[KeyLink]) -> DataFrame:
    """All keys of a fact that need reprocessing although no source row changed."""
    found = heal_unknown(fact, key, key_columns).unionByName(heal_orphans(fact, dims, key, links))
    for link in links:
        if link.dim_id:
            found = found.unionByName(heal_wrong_version(fact, dims[link.dim], key, link))
    return found.distinct()


_DRIVER = KeyLink("driver_key", "driver", "driver_key", "driver_id")


def _versioned(name: str, date_column: str, column: str | None = None) -> KeyLink:
    return KeyLink(column or f"{name}_key", name, f"{name}_key", f"{name}_id", date_column)


def _plain(name: str, column: str | None = None) -> KeyLink:
    return KeyLink(column or f"{name}_key", name, f"{name}_key")


#: Driver and truck are the versioned dimensions; every key can be orphaned.
LINKS = {
    "trip": (_versioned("driver", "dispatch_date_key"), _versioned("truck", "dispatch_date_key"),
             _plain("trailer"), _plain("route")),
    "delivery_event": (_plain("facility"), _plain("route"), _plain("delivery_status")),
    "fuel_purchase": (_versioned("truck", "purchase_date_key"), _versioned("driver", "purchase_date_key"),
                      _plain("route"), _plain("location")),
    "maintenance": (_versioned("truck", "maintenance_date_key"), _plain("location"),
                    _plain("maintenance_class")),
    "safety_incident": (_versioned("driver", "incident_date_key"), _versioned("truck", "incident_date_key"),
                        _plain("location"), _plain("incident_class")),
    "load_lifecycle": (_plain("customer"), _plain("route"), _plain("load_type"),
                       _versioned("driver", "dispatched_date_key", "fulfilling_driver_key"),
                       _versioned("truck", "dispatched_date_key", "fulfilling_truck_key"),
                       _plain("trailer", "fulfilling_trailer_key")),
}

AFFECTED = {
    "trip": affected_trips,
    "delivery_event": affected_delivery_events,
    "fuel_purchase": affected_fuel_purchases,
    "maintenance": affected_maintenance,
    "safety_incident": affected_safety_incidents,
    "load_lifecycle": affected_loads,
}

#: What AFFECTED reads of the changes of a table beside its key, by fact.
CARRIES = {"load_lifecycle": {"trips": ("load_id",), "delivery_events": ("load_id",)}}

#: The current-state tables whose changes a fact listens to.
READS = {
    "trip": ("trips", "loads"),
    "delivery_event": ("delivery_events", "loads"),
    "fuel_purchase": ("fuel_purchases", "trips", "loads"),
    "maintenance": ("maintenance_records",),
    "safety_incident": ("safety_incidents",),
    "load_lifecycle": ("loads", "trips", "delivery_events"),
}


def change_windows(wanted: DataFrame, checkpoints: DataFrame, current: DataFrame) -> DataFrame:
    """What each (step_name, source_table) must read: a version window, or everything and why.

    wanted (step_name, source_table), checkpoints (+ last_version), current (source_table,
    version, oldest_version). A window is (version_from, version_to].
    """
    rows = wanted.join(checkpoints, ["step_name", "source_table"], "left").join(current, "source_table", "left")
    since, until = F.col("last_version"), F.col("version")
    reason = (F.when(since.isNull(), "no checkpoint")
              .when(since > until, "table version reset")
              .when((since < until) & (since + 1 < F.col("oldest_version")), "window no longer readable"))
    return rows.select(
        "step_name", "source_table", since.alias("version_from"), until.alias("version_to"),
        reason.isNotNull().alias("is_full_scan"), reason.alias("reason"),
        (reason.isNull() & (since == until)).alias("is_empty"))
