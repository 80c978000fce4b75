"""Key resolution and the change scenarios of a fact: parent change, healing, version split, orphan, pre-image."""

import datetime as dt

import pytest
from conftest import rows_of

from tidemark.functions.compare import CheckFailed
from tidemark.operators import detect as X
from tidemark.operators import facts as T
from tidemark.operators.lookups import assert_grain
from tidemark.operators.merge import change_feed

OPEN = 99991231


def day(text):
    return dt.date.fromisoformat(text)


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def world(make):
    dims = {
        "date": make("date_key int", *[(20220101 + i,) for i in range(31)], (0,), (-1,), (-2,)),
        "driver": make("driver_key bigint, driver_id string, valid_from_date_key int, valid_to_date_key int",
                       (1, "D1", 20220101, 20220115), (2, "D1", 20220115, OPEN), (0, None, 0, OPEN), (-1, None, 0, OPEN)),
        "truck": make("truck_key bigint, truck_id string, valid_from_date_key int, valid_to_date_key int",
                      (7, "T1", 20220101, OPEN), (0, None, 0, OPEN)),
        "trailer": make("trailer_key bigint, trailer_id string, valid_from_date_key int, valid_to_date_key int",
                        (8, "R1", 20220101, OPEN)),
        "route": make("route_key bigint, route_id string, valid_from_date_key int, valid_to_date_key int",
                      (9, "A", 20220101, OPEN), (10, "B", 20220101, OPEN)),
        "customer": make("customer_key bigint, customer_id string, valid_from_date_key int, valid_to_date_key int",
                         (3, "C1", 20220101, OPEN)),
        "load_type": make("load_type_key bigint, booking_type string, load_type string", (4, "Spot", "Dry")),
    }
    trip = ("trip_id string, load_id string, driver_id string, truck_id string, trailer_id string, dispatch_date date, "
            "actual_distance_miles int, actual_duration_hours int, fuel_gallons_used int, idle_time_hours int, "
            "is_idle_implausible boolean, _is_deleted_in_source boolean")

    def trips(*rows):
        return make(trip, *[(*r, 100, 5, 10, 1, None, False) for r in rows])

    loads = make("load_id string, route_id string, _is_deleted_in_source boolean", ("L1", "A", False), ("L2", "B", True),
                 ("L3", None, False), ("L4", "gone", False))
    return dims, trips, loads


KEYS = ("trip_id", "dispatch_date_key", "driver_key", "truck_key", "trailer_key", "route_key")


def test_fact_trip_keys(world):
    dims, trips, loads = world
    fact = T.fact_trip(None, {"loads": loads, "trips": trips(
        ("t1", "L1", "D1", "T1", "R1", day("2022-01-14")),   # half-open: still the first version
        ("t2", "L2", "D1", None, "R1", day("2022-01-15")),   # second version; a deleted load gives its route
        ("t3", None, None, "T9", None, day("2022-01-02")),
        ("t4", "LX", "D9", "T1", "R1", None),                # no date: members become Unknown
        ("t5", "L3", "D1", "T1", "R1", day("2021-12-31")),   # before the calendar
        ("t6", "L4", "D1", "T1", "R1", day("2022-01-20")))}, dims)
    assert rows_of(fact, *KEYS) == [
        ("t1", 20220114, 1, 7, 8, 9), ("t2", 20220115, 2, 0, 8, 10), ("t3", 20220102, 0, -1, 0, 0),
        ("t4", 0, -1, -1, -1, -1), ("t5", -1, -1, -1, -1, 0), ("t6", 20220120, 2, 7, 8, -1)]
    assert_grain(fact, "trip_id", "fact_trip")
    overlap = dict(dims, truck=dims["truck"].union(dims["truck"]))
    with pytest.raises(CheckFailed):
        assert_grain(T.fact_trip(None, {"loads": loads, "trips": trips(("t1", "L1", "D1", "T1", "R1", day("2022-01-14")))},
                                 overlap), "trip_id", "fact_trip")


def test_only_listed_keys(world, make):
    dims, trips, loads = world
    silver = {"loads": loads, "trips": trips(("t1", "L1", "D1", "T1", "R1", day("2022-01-14")),
                                             ("t2", "L2", "D1", None, "R1", day("2022-01-15")))}
    assert rows_of(T.fact_trip(make("trip_id string", ("t2",), ("t2",), ("zz",)), silver, dims), "trip_id") == [("t2",)]


def test_healing(world, make):
    dims, trips, loads = world
    fact = make("trip_id string, dispatch_date_key int, driver_key bigint, truck_key bigint, trailer_key bigint, "
                "route_key bigint, is_deleted_in_source boolean",
                ("ok", 20220110, 1, 7, 8, 9, False), ("wrong", 20220120, 1, 7, 8, 9, False),
                ("unknown", 20220110, -1, 7, 8, 9, False), ("deleted", 20220110, -1, 7, 8, 9, True),
                ("orphan", 20220110, 1, 77, 8, 9, False), ("special", 20220110, 0, 0, 8, 9, False))
    links = X.LINKS["trip"]
    assert rows_of(X.heal_unknown(fact, "trip_id", T.FACTS["trip"][2]), "trip_id") == [("unknown",)]
    assert rows_of(X.heal_wrong_version(fact, dims["driver"], "trip_id", links[0]), "trip_id") == [("wrong",)]
    assert rows_of(X.heal_orphans(fact, dims, "trip_id", links), "trip_id") == [("orphan",)]
    assert rows_of(X.heal_keys(fact, dims, "trip_id", T.FACTS["trip"][2], links), "trip_id") == [
        ("orphan",), ("unknown",), ("wrong",)]


def test_affected_keys(make):
    loads = (make("load_id string, route_id string", ("L1", "A"), ("L2", "A")),
             make("load_id string, route_id string", ("L1", "B"), ("L2", "A")))
    trips = (make("trip_id string, load_id string", ("t1", "L1"), ("t2", "L2"), ("t3", "L9")),
             make("trip_id string, load_id string", ("t1", "L1"), ("t2", "L3"), ("t3", "L9")))
    events = (make("event_id string, load_id string", ("e1", "L1"), ("e2", None)),) * 2
    changes = {"loads": change_feed(*loads, ["load_id"]), "trips": change_feed(*trips, ["trip_id"]),
               "delivery_events": change_feed(*events, ["event_id"])}
    changes["fuel_purchases"] = make("fuel_purchase_id string, trip_id string, _change_type string", ("f9", "t9", "insert"))
    silver = {"trips": trips[1], "delivery_events": events[1],
              "fuel_purchases": make("fuel_purchase_id string, trip_id string", ("f1", "t1"), ("f2", "t2"), ("f3", "t3"))}
    assert rows_of(X.affected_trips(changes, silver), "trip_id") == [("t1",), ("t2",)]
    assert rows_of(X.affected_delivery_events(changes, silver), "event_id") == [("e1",)]
    assert rows_of(X.affected_fuel_purchases(changes, silver), "fuel_purchase_id") == [("f1",), ("f2",), ("f9",)]
    # The pre-image names L2, the load the trip left.
    assert rows_of(X.affected_loads(changes, silver), "load_id") == [("L1",), ("L2",), ("L3",)]
    both = X.full_reconcile_keys(trips[1], make("trip_id string", ("t1",), ("lost",)), "trip_id")
    assert rows_of(both, "trip_id") == [("lost",), ("t1",), ("t2",), ("t3",)]


def lifecycle(world, make, events):
    dims, trips, _ = world
    loads = make("load_id string, customer_id string, route_id string, load_date date, booking_type string, "
                 "load_type string, weight_lbs int, pieces int, revenue int, fuel_surcharge int, accessorial_charges int, "
                 "_is_deleted_in_source boolean",
                 ("L1", "C1", "A", day("2022-01-05"), "Spot", "Dry", 1, 1, 1, 1, 1, False),
                 ("L2", None, "B", day("2022-01-05"), None, "Dry", 1, 1, 1, 1, 1, True))
    t = trips(("t1", "L1", "D1", "T1", "R1", day("2022-01-10")), ("t2", "L1", "D1", "T1", "R1", day("2022-01-20")))
    e = make("event_id string, trip_id string, load_id string, event_type string, actual_datetime timestamp, "
             "_is_deleted_in_source boolean", *events)
    return T.fact_load_lifecycle(None, {"loads": loads, "trips": t, "delivery_events": e}, dims), t, e


LIFE = ("load_id", "dispatched_date_key", "pickup_date_key", "delivery_date_key", "customer_key", "route_key",
        "load_type_key", "fulfilling_driver_key")


def test_lifecycle_prefers_the_delivering_trip(world, make):
    fact, _, _ = lifecycle(world, make, [
        ("p", "t1", "L1", "Pickup", at("2022-01-10 12:00:00"), False),
        ("d", "t1", "L1", "Delivery", at("2022-01-11 00:30:00"), False)])
    assert rows_of(fact, *LIFE) == [("L1", 20220110, 20220110, 20220111, 3, 9, 4, 1), ("L2", -2, -2, -2, 0, 10, -1, -2)]
    one = fact.where("load_id = 'L1'").first()
    assert (one["booking_to_dispatch_days"], float(one["dispatch_to_pickup_hours"]),
            float(one["pickup_to_delivery_hours"])) == (5, 12.0, 12.5)


def test_lifecycle_latest_trip_and_reversal(world, make):
    fact, trips, events = lifecycle(world, make, [
        ("p", "t2", "L1", "Pickup", at("2022-01-21 12:00:00"), False),
        ("d", "t2", "L1", "Delivery", at("2022-01-21 06:00:00"), True),
        ("x", "t1", "L1", "Pickup", at("2022-01-11 12:00:00"), False)])
    assert rows_of(fact, *LIFE)[0] == ("L1", 20220120, 20220121, -2, 3, 9, 4, 2)
    T.assert_unambiguous(trips, events)
    fact, trips, events = lifecycle(world, make, [
        ("p", "t2", "L1", "Pickup", at("2022-01-21 12:00:00"), False),
        ("d", "t2", "L1", "Delivery", at("2022-01-21 06:00:00"), False)])
    one = fact.where("load_id = 'L1'").first()
    assert one["is_timestamp_reversed"] and one["pickup_to_delivery_hours"] is None
    _, trips, events = lifecycle(world, make, [
        ("a", "t1", "L1", "Delivery", at("2022-01-21 12:00:00"), False),
        ("b", "t2", "L1", "Delivery", at("2022-01-21 06:00:00"), False)])
    with pytest.raises(CheckFailed):
        T.assert_unambiguous(trips, events)


def test_change_windows(make):
    wanted = make("step_name string, source_table string", ("f", "a"), ("f", "b"), ("f", "c"), ("f", "d"), ("f", "e"))
    points = make("step_name string, source_table string, last_version bigint", ("f", "a", 5), ("f", "b", 9), ("f", "c", 1),
                  ("f", "d", 4))
    current = make("source_table string, version bigint, oldest_version bigint", ("a", 8, 0), ("b", 7, 0), ("c", 6, 4),
                   ("d", 4, 0), ("e", 1, 0))
    got = X.change_windows(wanted, points, current)
    assert rows_of(got, "source_table", "is_full_scan", "reason", "is_empty") == [
        ("a", False, None, False), ("b", True, "table version reset", False),
        ("c", True, "window no longer readable", False), ("d", False, None, True), ("e", True, "no checkpoint", False)]
