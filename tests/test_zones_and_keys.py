"""Times in any session zone, and readings that lack a key."""

import pytest
from helpers import START_MS
from pyspark.sql import functions as F

from fleetpulse.functions import schemas
from fleetpulse.functions.text import iso_timestamp
from fleetpulse.functions.times import parse_timestamp_text
from fleetpulse.operators import parse, rules
from fleetpulse.sinks.tables import BatchTable
from fleetpulse.sources.topics import ARRIVAL, read_topic_files
from fleetpulse.streaming import jobs


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_published_times_come_back_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(START_MS * 1000 + n,) for n in (0, 500_000, 123_456, 10**13)], "us long")
        back = rows.select("us", F.unix_micros(parse_timestamp_text(iso_timestamp(F.timestamp_micros("us")))).alias("again"))
        assert all(r.us == r.again for r in back.collect())
        texts = ["2024-01-01T00:00:00Z", "2024-01-01 02:00:00+02:00", "2024-01-01", " 2024-01-01 00:00 ", "2024-01-01T00:00:00.", "soon", "2024-13-01", "", None]
        got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.unix_millis(parse_timestamp_text(F.col("t")))).collect()
        assert [r[0] for r in got] == [START_MS] * 5 + [None] * 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def message(sensor='"V1-FL"', vehicle='"V1"', time=START_MS, pressure=100.0):
    return f'{{"sensor_id":{sensor},"vehicle_id":{vehicle},"timestamp":{time},"pressure_kpa":{pressure},"temperature_c":70.0}}'


def test_readings_without_a_key_are_kept_apart(spark, tmp_path):
    texts = [message(), message(sensor="null"), message(vehicle="null"), message(time="null"), "{bad"]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.parquet(str(tmp_path / "topic"))
    table = BatchTable(spark, str(tmp_path / "alerts"), schemas.STORED_ALERT, day_of="timestamp")
    jobs.start_json_alerts(
        read_topic_files(spark, str(tmp_path / "topic"), positions=True), rules.TIERED, table, lambda batch, n: None,
        str(tmp_path / "cp"), ARRIVAL, judge=parse.judge_strict,
    ).awaitTermination()
    assert table.read().count() == 1
    kept = {r.value: r.reason for r in jobs.quarantine_table(table).read().collect()}
    assert set(kept) == set(texts[1:])
    assert [kept[t] for t in texts[1:4]] == ["no sensor_id or vehicle_id or ts_ms"] * 3
