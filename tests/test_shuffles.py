"""What the big steps shuffle: narrow rows, whatever the rows they leave look like."""

import re
import time

from conftest import rows_of

from tidemark.operators import transforms as X
from tidemark.operators.facts import FACTS
from tidemark.operators.merge import change_feed
from tidemark.plans import trucking
from tidemark.plans.catalog.changes import _changes
from tidemark.plans.catalog.figures import lanes
from tidemark.plans.catalog.reconciliation import _keys, check_keys_event, check_lifecycle_oracle, reconcile_verdict
from tidemark.plans.measures import query as measure_query
from tidemark.plans.star import Star, star as shared
from tidemark.session import Steps, tune
from tidemark.sources.sinks import exists

SF = "/root/testdata/sf0.001"


def on_disk(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_shuffle_files_go_with_their_execution(spark, tmp_path):
    tune(spark)
    before = on_disk(spark)
    for n in range(4):
        spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(4, "k").write.parquet(str(tmp_path / str(n)))
    for _ in range(50):     # they are deleted by a thread of their own
        if on_disk(spark) <= before:
            break
        time.sleep(0.2)
    assert on_disk(spark) <= before
    twice = spark.range(1000).selectExpr("id", "id % 7 AS k").repartition(4, "k")
    assert sorted(twice.collect()) == sorted(twice.collect())


def test_rows_are_written_before_a_join_that_shuffles_them(spark, monkeypatch):
    rows, steps = spark.range(100).selectExpr("id", "id % 7 AS k"), Steps()
    few, many = spark.range(5), spark.range(10_000_000)
    assert steps.before(rows, few) is rows
    one = steps.before(rows, many)
    two = steps.before(one.withColumn("k", one.k + 1), many)
    assert sorted(two.collect()) == [(i, i % 7 + 1) for i in range(100)]
    assert not exists(spark, one.scratch) and exists(spark, two.scratch)
    steps.end()
    assert not exists(spark, two.scratch)


def test_large_lookups_give_the_same_fact(spark):
    """The written form of each fact's rows against the one that joins all lookups in one go."""
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for fact, (_, key, keys) in FACTS.items():
        told = rows_of(Star(spark, SF).stage(fact), key, *keys)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
        try:
            assert rows_of(Star(spark, SF).stage(fact), key, *keys) == told
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_a_check_publishes_the_fact_before_it_meets_its_source(spark):
    s = Star(spark, SF)
    assert _keys(s, "trip").inputFiles() and s._holding("trip", FACTS["trip"][2]) is not None


def shuffled(df, capsys):
    """The names of the columns of each exchange in a plan."""
    df.explain("formatted")
    found = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", capsys.readouterr().out)
    return [{c.split("#")[0].strip() for c in columns.split(", ")} for columns in found]


def test_delivery_events_are_spelled_out_after_the_shuffles(spark, capsys):
    for df in (trucking.source(spark, SF, "delivery_events"), Star(spark, SF).silver("delivery_events")):
        exchanges = shuffled(df, capsys)
        assert exchanges and not [e for e in exchanges if e & {"event_id", "trip_id", "location_city", "event_type"}]


def test_delivery_events_equal_the_oracles_form(spark):
    told = spark.sql(trucking.source_sql(trucking.SPARK)["delivery_events"], lineitem=trucking.given(spark, SF, "lineitem"))
    new = trucking.source(spark, SF, "delivery_events")
    assert new.columns == told.columns and rows_of(new, *told.columns) == rows_of(told, *told.columns)
    told, new = X.delivery_events(told), Star(spark, SF).silver("delivery_events")
    assert new.columns == told.columns and rows_of(new, *told.columns) == rows_of(told, *told.columns)


def test_narrow_feed_sees_a_change_of_any_column(make):
    schema = "k int, parent string, a int, b int, c string"
    before = make(schema, (1, "p", 5, None, "x"), (2, "p", 1, 1, None), (3, None, 1, 1, "x"), (4, "p", 1, 1, "x"), (5, "p", 7, 7, ""))
    after = make(schema, (1, "p", None, 5, "x"), (2, "q", 1, 1, None), (3, None, 1, 1, "x"), (5, "p", 7, 7, None), (6, "r", 1, 1, "x"))
    feed = change_feed(before, after, ["k"], ["parent"])
    assert feed.columns == ["k", "parent", "_change_type"]
    assert rows_of(feed, *feed.columns) == rows_of(change_feed(before, after, ["k"]), *feed.columns)
    assert {r["k"] for r in feed.collect()} == {1, 2, 4, 5, 6}


def test_affected_keys_ask_for_keys_and_links_alone(spark):
    feeds = _changes(spark, SF, "load_lifecycle")
    assert {t: feed.columns for t, feed in feeds.items()} == {
        "loads": ["load_id", "_change_type"], "trips": ["trip_id", "load_id", "_change_type"],
        "delivery_events": ["event_id", "load_id", "_change_type"]}


def test_purchases_are_spelled_out_after_the_shuffles(spark, capsys):
    star = Star(spark, SF)
    told, new = X.capacity_flag(trucking.source(spark, SF, "fuel_purchases"), star.raw("trucks")), star.silver("fuel_purchases")
    assert sorted(new.columns) == sorted(told.columns) and rows_of(new, *told.columns) == rows_of(told, *told.columns)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        exchanges = shuffled(Star(spark, SF).silver("fuel_purchases"), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert exchanges and not [e for e in exchanges if e & {"fuel_purchase_id", "trip_id", "location_city"}]


def test_dimensions_take_columns_without_the_joins_of_others(spark, capsys):
    star = Star(spark, SF)
    for table, columns, kept in (("delivery_events", ("location_city", "location_state"), 0), ("fuel_purchases", ("location_city",), 0),
                                 ("delivery_events", ("event_type", "arrival_status"), 2)):
        light = star.part(table, *columns)
        exchanges = shuffled(light, capsys)
        assert len(exchanges) <= kept and not [e for e in exchanges if e & {"event_id", "trip_id", "is_timestamp_reversed"}]
        assert rows_of(light, *columns) == rows_of(star.silver(table), *columns)
    star.dim("location")
    assert not {"silver_delivery_events", "silver_fuel_purchases"} & {*star._frames}
    assert rows_of(star.part("delivery_events", "event_id"), "event_id") == rows_of(star.current("delivery_events"), "event_id")


def test_parts_of_facts_equal_the_facts(spark):
    whole, parts = Star(spark, SF), Star(spark, SF)
    for name in FACTS:
        fact = whole.fact(name)
        key, keys = FACTS[name][1], FACTS[name][2]
        rest = [c for c in fact.columns if c not in keys]
        for columns in ((key, keys[0]), (key, *keys[1:4:2]), rest):
            assert rows_of(parts.fact_part(name, *columns), *columns) == rows_of(fact, *columns), (name, columns)
    assert not {f"fact_{n}" for n in FACTS} & {*parts._frames}
    parts.hold("trip", "trip_id", "route_key")
    assert rows_of(parts.fact_part("trip", "route_key"), "route_key") == rows_of(whole.fact("trip"), "route_key")
    assert shuffles_nothing(parts.fact_part("trip", "route_key"))


def shuffles_nothing(df):
    return "hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_figures_take_columns_of_facts_without_the_joins_of_others(spark, capsys):
    star = Star(spark, SF)
    assert lanes(star).count() > 0
    measure_query(star, ["contribution_after_fuel", "fuel_cost_per_mile"], ["route.route_name"]).count()
    assert not [label for label in star._frames if label.startswith("fact_")]
    assert not {"silver_trips", "silver_loads", "silver_delivery_events", "silver_fuel_purchases"} & {*star._frames}
    assert shuffles_nothing(star.fact_part("load_lifecycle", "booked_date_key", "revenue"))
    wide = {"trip_id", "event_id", "driver_id", "truck_id", "trailer_id", "actual_duration_hours"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        exchanges = shuffled(star.fact_part("trip", "route_key", "actual_distance_miles"), capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert exchanges and not [e for e in exchanges if e & wide]


def test_checks_and_delivery_events_publish_no_whole_tables(spark, capsys):
    star = Star(spark, SF)
    events = star.stage("delivery_event")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        route = star.fact_part("delivery_event", "event_id", "route_key").select("route_key")
        exchanges = shuffled(route, capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert events.count() == star.silver("delivery_events").count()
    assert not [e for e in exchanges if e & {"event_id", "trip_id", "location_city", "detention_minutes"}]
    own = f"{SF}/."     # the star of no other test
    for check in (check_keys_event, check_lifecycle_oracle, reconcile_verdict):
        assert check(spark, own).count() > 0
    frames = {*shared(spark, own)._frames}
    assert not {"silver_delivery_events", "silver_trips", "silver_loads", "fact_trip", "fact_delivery_event", "fact_load_lifecycle"} & frames
