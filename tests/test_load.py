"""The incremental load of facts over a warehouse of the smallest given tables."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.functions.compare import CheckFailed
from tidemark.plans import loading
from tidemark.plans.loading import Warehouse, batch

SF = "/root/testdata/sf0.001"


def rebuilt(house, fact):
    """The fact from nothing, over the warehouse's own current-state tables."""
    silver = {t: house.log.read(f"silver_{t}") for t in house.tables}
    return house.star.stage(fact, None, silver)


@pytest.fixture(scope="module")
def landed(spark):
    house = Warehouse(spark, SF, ["trip", "delivery_event"])
    for table in house.tables:
        house.land(table, batch(spark, SF, table), f"land-{table}")
    return house


def test_load_equals_a_rebuild(landed):
    before = {f: landed.log.layout(f"fact_{f}").version for f in ("trip", "delivery_event")}
    for fact in before:
        counts = landed.load(fact)
        assert counts["updated"] > 0 and counts["deleted"] > 0
        fresh, loaded = rebuilt(landed, fact), landed.log.read(f"fact_{fact}")
        assert rows_of(loaded, *fresh.columns) == rows_of(fresh, *fresh.columns)
        feed = landed.log.changes(f"fact_{fact}", before[fact])
        assert 0 < feed.count() < loaded.count()
    succeeded = landed.log.read("run_log").where("event_type = 'succeeded'")
    assert rows_of(succeeded, "step_name") == [("delivery_event",), ("trip",)]


def test_nothing_changed_changes_nothing(landed):
    landed.load("trip", "run-2")
    version = landed.log.layout("fact_trip").version
    assert landed.log.changes("fact_trip", version - 1).isEmpty()
    ledger = landed.log.read("ledger").where("run_id = 'run-2' AND source_table = 'silver_trips'").first()
    assert ledger["version_from"] == ledger["version_to"] and not ledger["is_full_scan"]


def test_a_mass_delete_publishes_nothing(spark):
    house = Warehouse(spark, SF, ["trip"])
    house.land("trips", batch(spark, SF, "trips", deleted="driver_id % 3 = 0"), "land-trips")
    before = house.log.layout("fact_trip")
    with pytest.raises(CheckFailed, match="would be deleted"):
        house.load("trip")
    assert house.log.layout("fact_trip") == before and house.log.read("ledger").where("run_id = 'run-1'").isEmpty()
    assert rows_of(house.log.read("run_log"), "step_name", "event_type") == [("trip", "failed")]
    house.load("trip", "run-2", allow_mass_delete=True)
    fresh = rebuilt(house, "trip")
    assert rows_of(house.log.read("fact_trip"), *fresh.columns) == rows_of(fresh, *fresh.columns)


def test_a_batch_that_breaks_a_rule_lands_nothing(spark):
    house = Warehouse(spark, SF, ["maintenance"])
    events = batch(spark, SF, "maintenance_records")
    before = house.log.layout("raw_maintenance_records")
    with pytest.raises(CheckFailed, match="sequence_not_contiguous"):
        house.land("maintenance_records", events.withColumn("_source_sequence", F.col("_source_sequence") + 1), "land")
    with pytest.raises(CheckFailed, match="needs_live_key"):
        house.land("maintenance_records", events.withColumn("maintenance_id", -F.col("maintenance_id")), "land")
    assert house.log.layout("raw_maintenance_records") == before


def test_files_of_a_landed_snapshot_do_not_grow_with_their_table(spark, monkeypatch):
    monkeypatch.setattr(loading, "FILE_ROWS", 500, raising=False)
    folder, tables = loading.land_snapshot(spark, SF)
    for table in ("delivery_events", "loads", "trips"):
        files = spark.read.parquet(f"{folder}/{table}").groupBy(F.input_file_name().alias("file")).count()
        assert files.agg(F.max("count")).first()[0] <= 500
    landed = spark.read.parquet(f"{folder}/delivery_events")
    assert tables["delivery_events"].source_rows == landed.distinct().count() < landed.count()
