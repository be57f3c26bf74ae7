from datetime import datetime, timezone

from helpers import alerts, readings

from fleetpulse.functions import schemas
from fleetpulse.operators import aggregates, constraints
from fleetpulse.sinks.tables import BatchTable
from fleetpulse.sources.seeds import seed_alerts, seed_vehicles
from fleetpulse.streaming import jobs

CLOCK = datetime(2024, 6, 1, tzinfo=timezone.utc)


def test_split_storable(spark):
    rows = alerts(spark, [("a", "V001", 0, "HIGH"), ("b", None, 0, None), ("c", "V001", 0, "X" * 21)])
    out = constraints.split_storable(rows, constraints.ALERT_REQUIRED, constraints.ALERT_LENGTHS)
    assert [r.alert_id for r in out.valid.collect()] == ["a"]
    assert {r.alert_id: r.reason for r in out.rejected.collect()} == {
        "b": "vehicle_id is null; severity is null",
        "c": "severity is longer than 20",
    }


def test_repeated_keys(spark):
    rows = alerts(spark, [("a", "V001", n, "HIGH") for n in range(3)] + [("b", "V001", 9, "HIGH")])
    assert [tuple(r) for r in constraints.repeated_keys(rows, "alert_id").collect()] == [("a", 3)]


def test_windows_without_a_value_are_not_stored(spark, tmp_path):
    windows = aggregates.tumbling_aggregates(readings(spark, [("V001-FL", 0, None, 1.0), ("V002-FL", 0, 5.0, 1.0)]))
    table = BatchTable(spark, str(tmp_path / "t"), schemas.STORED_AGGREGATE)
    jobs.store_aggregates(windows, 0, table, clock=CLOCK)
    assert [(r.id, r.sensor_id) for r in table.read().collect()] == [(1, "V002-FL")]


def test_seeds_are_inserted_once(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), schemas.STORED_ALERT)
    for batch in range(2):
        jobs.store_alerts(seed_alerts(spark, CLOCK), batch, table, ("timestamp",), clock=CLOCK)
    got = table.read().selectExpr("id", "alert_id", "unix_seconds(created_at) - unix_seconds(timestamp) age").collect()
    assert sorted(map(tuple, got)) == [(1, "sample_alert_1", 600), (2, "sample_alert_2", 300)]
    assert seed_vehicles(spark).count() == 5


def test_windows_by_arrival_time(spark):
    source = readings(spark, [("V001-FL", 0, 1.0, 2.0)] * 4).drop("ts")
    batch = aggregates.tumbling_aggregates(aggregates.with_ingest_time(source), "ingest_ts")
    assert [r.record_count for r in batch.collect()] == [4]
