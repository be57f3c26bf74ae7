"""Summaries of merged days, and tables of current values by bucket."""

import re
from datetime import datetime, timezone

import pytest
from helpers import START, alerts, vehicles
from pyspark.sql import functions as F

from fleetpulse.functions import schemas
from fleetpulse.operators import merge, serving
from fleetpulse.operators.summaries import Summaries
from fleetpulse.sinks import packing
from fleetpulse.sinks.buckets import BucketTable
from fleetpulse.sinks.tables import BatchTable
from fleetpulse.streaming import jobs

CLOCK = datetime(2024, 6, 1, tzinfo=timezone.utc)
DAY = 86_400


def stored_alerts(spark, rows):
    return alerts(spark, rows).selectExpr("CAST(NULL AS BIGINT) id", "*", "false is_resolved", "timestamp created_at")


def windows(spark, rows):
    """(vehicle, second) -> stored aggregates."""
    frame = spark.createDataFrame(rows, "vehicle_id string, second long")
    start = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("second"))
    filled = {f.name: F.lit(None).cast(f.dataType) for f in schemas.STORED_AGGREGATE.fields if f.name != "vehicle_id"}
    return frame.withColumns(filled | {"window_start": start, "window_end": start}).select(*schemas.STORED_AGGREGATE.names)


@pytest.fixture
def summaries(spark, tmp_path):
    tables = [BatchTable(spark, str(tmp_path / n), s, day_of=d) for n, s, d in (
        ("alerts", schemas.STORED_ALERT, "timestamp"), ("windows", schemas.STORED_AGGREGATE, "window_start"))]
    return Summaries(spark, str(tmp_path / "sums"), *tables)


def totals(summaries):
    got = summaries.dashboard(CLOCK)
    full = serving.dashboard_summary(summaries.alerts.read(), summaries.aggregates.read(), clock=CLOCK)
    assert got.collect() == full.collect()
    return tuple(got.first())[:4]


def test_totals_equal_a_full_scan_at_every_step(spark, summaries):
    assert totals(summaries) == (0, 0, 0, 0)
    run = 0
    for batch in range(6):
        day = batch // 2 * DAY
        summaries.alerts.append(stored_alerts(spark, [(f"a{batch}", "V001", day, "CRITICAL"), (f"b{batch}", "V001", day + 1, "WARNING"), (f"c{batch}", "V001", 0, "HIGH")]), batch)
        names = [f"V{n:03}" for n in range(batch * 2, batch * 2 + 5)] + [None]
        summaries.aggregates.append(windows(spark, [(v, day if n else 0) for n, v in enumerate(names)]), batch)
        if batch in (1, 3, 4):
            for table in (summaries.alerts, summaries.aggregates):
                packing.pack(table.layout, least=1)
        if batch in (1, 4):
            for _ in range(2):
                summaries.refresh(run)
            run += 1
        if batch in (1, 3, 5):
            assert totals(summaries) == (3 * batch + 3, batch * 2 + 5, batch + 1, batch + 1)
    numbers = [r.number for r in summaries.dictionary.read().collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))


def test_history_is_not_opened_again(spark, summaries):
    for batch in range(4):
        summaries.alerts.append(stored_alerts(spark, [(f"a{batch}", "V001", batch, "WARNING")]), batch)
    packing.pack(summaries.alerts.layout, least=1)
    summaries.refresh(0)
    assert summaries.counts.read().count() == 1
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = summaries.alert_totals()._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"Location: \w+\(.*?\)\[(.*?)\].*?ReadSchema: (struct<.*?>)", text)
    packed = [columns for place, columns in scans if "alerts-packed" in place]
    assert packed and set(packed) == {"struct<>"}
    assert any("severity" in columns for place, columns in scans if place.endswith("alerts"))


def test_an_upsert_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "v"), schemas.VEHICLE, "vehicle_id", buckets=16)
    table.update(vehicles(spark, [(f"V{n:03}", f"o{n}@x", "") for n in range(400)]), lambda _, batch: batch)

    def stamps():
        return {p.parent.name: p.name for p in (tmp_path / "v").rglob("*.parquet")}

    before = stamps()
    change = spark.createDataFrame([("V007", "new@x", "d@x"), ("V900", "n@x", "e@x")], "vehicle_id string, owner_email string, driver_email string")
    touched = table.update(change, lambda old, new: merge.upsert(old, new, "vehicle_id", ["owner_email", "driver_email"], clock=CLOCK))
    after = stamps()
    assert 1 <= len(touched) <= 2 and len(before) == 16 == len(after)
    assert {b for b in after if after[b] != before[b]} == {f"bucket={b}" for b in touched}
    rows = {r.vehicle_id: r for r in table.read().collect()}
    assert len(rows) == 401 and rows["V007"].owner_email == "new@x" and rows["V008"].owner_email == "o8@x"
    assert rows["V007"].created_at == START and rows["V900"].created_at == CLOCK.replace(tzinfo=None)
    assert [r.owner_email for r in table.read("V007").collect()] == ["new@x"]
    assert table.update(change.limit(0), lambda old, new: old) == []


def test_newest_rows_follow_late_and_repeated_batches(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), schemas.METRIC, "vehicle_id", buckets=4)
    schema = "vehicle_id string, sensor_id string, second long"
    batches = [[("V1", "V1-FL", n) for n in range(0, 60, 3)], [("V1", "V1-FR", n) for n in (1, 58, 59)] + [("V2", "s", 5)], [("V1", "V1-RL", 56)], [("V1", "V1-FR", n) for n in (1, 58, 59)]]
    seen = []
    for number, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, schema).selectExpr(
            "vehicle_id", "sensor_id", "timestamp_seconds(1704067200 + second) AS timestamp", "1D pressure_kpa", "2D temperature_c")
        frame.write.mode("append").parquet(str(tmp_path / "in"))
        jobs.start_latest(spark.readStream.schema(schemas.METRIC).parquet(str(tmp_path / "in")), table, str(tmp_path / "cp"), ["sensor_id"]).awaitTermination()
        seen = sorted(set(seen) | set(rows))
        for vehicle in ("V1", "V2"):
            expected = sorted(((-s, n) for v, n, s in seen if v == vehicle))[:10]
            got = table.read(vehicle).selectExpr("1704067200 - unix_seconds(timestamp) AS s", "sensor_id").collect()
            assert sorted(map(tuple, got)) == expected
