"""Windows by arrival that the clock closes."""

import time
from datetime import timedelta

import pytest
from helpers import START, readings
from pyspark.sql import functions as F

from fleetpulse.functions import schemas
from fleetpulse.operators import aggregates
from fleetpulse.sinks.tables import BatchTable
from fleetpulse.sources.clock import clock_ticks, recorded_ticks
from fleetpulse.streaming import jobs


@pytest.fixture
def job(spark, tmp_path):
    """A table, and a function that lets readings or ticks come in and runs the job on them."""
    table = BatchTable(spark, str(tmp_path / "t"), schemas.STORED_AGGREGATE, day_of="window_start")
    schema = readings(spark, [("V001-FL", 0, 1.0, 2.0)]).schema

    def run(rows=(), tick=None):
        spark.createDataFrame([(START + timedelta(seconds=tick),)] if tick is not None else [], "tick timestamp").write.mode("append").parquet(str(tmp_path / "ticks"))
        (readings(spark, rows) if rows else spark.createDataFrame([], schema)).write.mode("append").parquet(str(tmp_path / "in"))
        jobs.start_clock_windows(
            spark.readStream.schema(schema).parquet(str(tmp_path / "in")), recorded_ticks(spark, str(tmp_path / "ticks")), table,
            str(tmp_path / "cp"), time_col="ts", exact_scale=2,
        ).awaitTermination()
        found = table.read().selectExpr("unix_seconds(window_start) - 1704067200 s", "sensor_id", "avg_pressure p", "record_count n")
        return sorted(map(tuple, found.collect()))

    return run


def test_a_quiet_sensor_is_written_without_a_later_reading(job):
    assert job([("V001-FL", 5, 10.0, 1.0), ("V001-FL", 50, 20.0, 1.0), ("V002-FL", 59, 7.0, 1.0)]) == []
    assert job(tick=59.9) == []
    closed = [(0, "V001-FL", 15.0, 2), (0, "V002-FL", 7.0, 1)]
    assert job(tick=60) == closed
    assert job(tick=300) == closed
    assert job([("V001-FL", 301, 3.0, 1.0)]) == closed
    assert job(tick=360) == [*closed, (300, "V001-FL", 3.0, 1)]


def test_ticks_make_no_windows_and_readings_without_keys_stay(spark, job):
    assert job(tick=1000) == []
    rows = readings(spark, [("V001-FL", 5, 10.0, 1.0)]).withColumns({"sensor_id": F.lit(None).cast("string"), "vehicle_id": F.lit(None).cast("string")})
    ticks = spark.createDataFrame([(START + timedelta(seconds=n),) for n in range(0, 300, 20)], "tick timestamp")
    found = aggregates.clock_windows(rows, ticks, "ts").collect()
    assert [(r.sensor_id, r.avg_pressure, r.record_count) for r in found] == [(None, 10.0, 1)]


def test_the_real_clock_closes_the_last_window(spark, tmp_path):
    """Nothing arrives after the first files, yet every reading ends up in a written window."""
    source = readings(spark, [("V001-FL", n, 1.0, 2.0) for n in range(7)]).drop("ts")
    source.write.parquet(str(tmp_path / "in"))
    table = BatchTable(spark, str(tmp_path / "t"), schemas.STORED_AGGREGATE, day_of="window_start")
    query = jobs.start_clock_windows(
        spark.readStream.schema(source.schema).parquet(str(tmp_path / "in")), clock_ticks(spark), table, str(tmp_path / "cp"),
        jobs.every("1 second"), length="2 seconds",
    )
    try:
        until = time.time() + 90
        while time.time() < until and (table.read().agg(F.sum("record_count")).first()[0] or 0) < 7:
            time.sleep(0.5)
    finally:
        query.stop()
    assert table.read().agg(F.sum("record_count")).first()[0] == 7
