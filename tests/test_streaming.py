"""Streams over ordered files, one file per micro-batch."""

import json
import time

import pytest
from helpers import alerts, readings, vehicles, write_ordered
from pyspark.sql import functions as F

from fleetpulse.functions import schemas
from fleetpulse.operators import parse, rules, serving
from fleetpulse.operators.aggregates import tumbling_aggregates, window_label
from fleetpulse.sinks.tables import BatchTable
from fleetpulse.sinks.topics import as_messages, write_topic_files
from fleetpulse.sources.topics import ARRIVAL, read_topic_files
from fleetpulse.streaming import jobs

# seconds after start (pressure), one list per file
LATE = [[(1, 1), (59, 2)], [(64, 3), (30, 4)], [(66, 5), (59.999, 6)], [(10, 7), (130, 8)], [(20, 9), (131, 10)]]
SCHEMA = "sensor_id string, vehicle_id string, ts_ms long, pressure_kpa double, temperature_c double"


def stream(spark, folder):
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return parse.with_event_time(raw)


def late_files(spark, folder):
    frames = [readings(spark, [("V001-FL", s, float(p), 70.0) for s, p in rows]).drop("ts") for rows in LATE]
    return write_ordered(frames, folder)


def windows(rows):
    return sorted((r.s, r.total, r.record_count) for r in rows.selectExpr(
        "unix_seconds(window_start) - 1704067200 s", "avg_pressure * record_count total", "record_count").collect())


def test_late_rows_and_open_windows(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "windows"), schemas.STORED_AGGREGATE)
    query = jobs.start_aggregates(stream(spark, late_files(spark, tmp_path / "in")), table, str(tmp_path / "cp"), exact_scale=2)
    query.awaitTermination()
    assert windows(table.read()) == [(0, 20.0, 5), (60, 8.0, 2)]
    assert jobs.late_rows(query) >= 1


def test_restart_continues_and_does_not_repeat(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "windows"), schemas.STORED_AGGREGATE)
    frames = [readings(spark, [("V001-FL", s, 10.0, 70.0) for s in span]).drop("ts") for span in (range(0, 80, 10), range(80, 200, 10))]
    folder = write_ordered(frames[:1], tmp_path / "in")
    jobs.start_aggregates(stream(spark, folder), table, str(tmp_path / "cp")).awaitTermination()
    before = windows(table.read())
    import os
    import shutil

    part = tmp_path / "more"
    frames[1].coalesce(1).write.parquet(str(part))
    target = f"{folder}/0001.parquet"
    shutil.copy(next(part.glob("*.parquet")), target)
    os.utime(target, (1_000_100, 1_000_100))
    jobs.start_aggregates(stream(spark, folder), table, str(tmp_path / "cp")).awaitTermination()
    assert before == [(0, 60.0, 6)]
    assert windows(table.read()) == [(0, 60.0, 6), (60, 60.0, 6), (120, 60.0, 6)]
    assert table.read().filter("created_at IS NULL").count() == 0


def test_batch_aggregate_equals_brute_force(spark):
    nan = float("nan")
    rows = [("V001-FL", 0, 200.0, 70.0), ("V001-FL", 59.999, 100.5, None), ("V001-FL", 60, nan, 71.0), ("V002-FL", 1, None, None)]
    out = {(r.sensor_id, r.window_size): r for r in tumbling_aggregates(readings(spark, rows)).filter("record_count <> 1 or sensor_id = 'V002-FL'").collect()}
    first = out[("V001-FL", "1m")]
    assert (first.avg_pressure, first.min_pressure, first.max_pressure, first.avg_temperature, first.record_count) == (150.25, 100.5, 200.0, 70.0, 2)
    empty = out[("V002-FL", "1m")]
    assert (empty.avg_pressure, empty.max_temperature, empty.record_count) == (None, None, 1)
    nan_window = tumbling_aggregates(readings(spark, rows)).filter("min_temperature = 71.0").first()
    assert (nan_window.avg_pressure, nan_window.max_pressure, nan_window.record_count) == (None, None, 1)


def test_window_label():
    assert window_label("1 minute") == "1m" and window_label("30 seconds") == "30s" and window_label("2 hours") == "2h"


def test_split_of_a_stream_does_not_change_exact_averages(spark, tmp_path):
    rows = [("V001-FL", n * 0.5, 150 + (n * 37 % 20001) / 100, 65 + (n * 13 % 1301) / 100) for n in range(600)]
    frames = [readings(spark, rows[n : n + 100]).drop("ts") for n in range(0, 600, 100)]
    table = BatchTable(spark, str(tmp_path / "windows"), schemas.STORED_AGGREGATE)
    jobs.start_aggregates(stream(spark, write_ordered(frames, tmp_path / "in")), table, str(tmp_path / "cp"), exact_scale=2).awaitTermination()
    batch = tumbling_aggregates(readings(spark, rows), exact_scale=2).filter("unix_seconds(window_end) <= 1704067200 + 294")
    assert sorted(map(tuple, table.read().select(*serving.AGGREGATE_COLUMNS).collect())) == sorted(map(tuple, batch.collect()))


def test_repeats_across_batches_are_dropped(spark, tmp_path):
    frames = [
        alerts(spark, [("a", "V001", 0, "HIGH"), ("a", "V001", 0, "HIGH"), ("b", "V001", 1, "HIGH")]),
        alerts(spark, [("b", "V001", 1, "HIGH"), ("c", "V001", 2, "HIGH")]),
    ]
    folder = write_ordered(frames, tmp_path / "in")
    source = spark.readStream.schema(schemas.ALERT).option("maxFilesPerTrigger", 1).parquet(folder)
    table = BatchTable(spark, str(tmp_path / "out"), schemas.ALERT)
    jobs.start_distinct(source, table, str(tmp_path / "cp"), ("timestamp",)).awaitTermination()
    assert sorted(r.alert_id for r in table.read().collect()) == ["a", "b", "c"]


def test_first_alerts_are_kept_however_late(spark, tmp_path):
    seconds = [("a", 100), ("b", 200), ("late", 50), ("b", 200), ("d", 300)]
    folder = write_ordered([alerts(spark, [(i, "V001", s, "HIGH")]) for i, s in seconds], tmp_path / "in")
    source = spark.readStream.schema(schemas.ALERT).option("maxFilesPerTrigger", 1).parquet(folder)
    table = BatchTable(spark, str(tmp_path / "out"), schemas.ALERT)
    query = jobs.start_distinct(source, table, str(tmp_path / "cp"), ("timestamp",))
    query.awaitTermination()
    assert sorted(r.alert_id for r in table.read().collect()) == ["a", "b", "d", "late"]
    assert query.lastProgress["batchId"] >= 3


def test_alerts_that_the_table_refuses_are_kept_apart(spark, tmp_path):
    batch = alerts(spark, [("a", "V001", 0, "HIGH"), ("b", "V001", 1, "S" * 21), ("c", "V001", 2, None)])
    batch = batch.unionByName(alerts(spark, [("d", "V001", 3, "HIGH")]).withColumn("timestamp", F.lit(None).cast("timestamp")))
    table = BatchTable(spark, str(tmp_path / "alerts"), schemas.STORED_ALERT, day_of="timestamp")
    for batch_id in range(3):
        jobs.store_alerts(batch, batch_id, table, ("timestamp",), ids_carry_time=True)
    assert [r.alert_id for r in table.read().collect()] == ["a"]
    first = jobs.rejected_table(table).read().filter("alert_id IS NOT NULL").select("alert_id", "reason").distinct().collect()
    assert sorted(map(tuple, first)) == [("b", "severity is longer than 20"), ("c", "severity is null"), ("d", "timestamp is null")]


def test_alert_job_fans_out_and_insert_ignores(spark, tmp_path):
    one = readings(spark, [("V001-FL", 0, 170.0, 70.0), ("V001-FR", 0, 250.0, 99.0), ("V001-RL", 0, 250.0, 70.0)]).drop("ts")
    two = readings(spark, [("V001-FL", 0, 170.0, 70.0), ("V001-RR", 1, 190.0, 70.0)]).drop("ts")
    table = BatchTable(spark, str(tmp_path / "alerts"), schemas.STORED_ALERT, day_of="timestamp")
    topic = str(tmp_path / "topic")
    jobs.start_alerts(
        stream(spark, write_ordered([one, two], tmp_path / "in")), rules.TIERED, table,
        lambda batch, n: write_topic_files(batch, topic, n), str(tmp_path / "cp"), ("ts_ms",), serial=True,
    ).awaitTermination()
    stored = table.read().collect()
    assert sorted(r.sensor_id for r in stored) == ["V001-FL", "V001-FR", "V001-RR"]
    assert sorted(r.id for r in stored) == [1, 2, 3]
    sent = [json.loads(r.value) for r in spark.read.parquet(topic).collect()]
    assert sorted(m["sensor_id"] for m in sent) == ["V001-FL", "V001-FL", "V001-FR", "V001-RR"]
    assert set(sent[0]) == set(schemas.ALERT.names)
    assert {m["timestamp"] for m in sent} == {"2024-01-01T00:00:00", "2024-01-01T00:00:01"}


def test_notifier_rereads_contacts(spark, tmp_path):
    frames = [as_messages(alerts(spark, [(f"a{n}", "V001", n, "HIGH")])).select("value") for n in range(2)]
    folder = write_ordered(frames, tmp_path / "topic")
    calls = []

    def contacts():
        calls.append(1)
        return vehicles(spark, [("V001", f"owner{len(calls)}@example.com", "d@example.com")])

    outbox = BatchTable(spark, str(tmp_path / "outbox"), schemas.NOTIFICATION)
    source = read_topic_files(spark, folder, files_per_trigger=1)
    jobs.start_notifications(source, contacts, outbox, str(tmp_path / "cp")).awaitTermination()
    got = {r.alert_id: r for r in outbox.read().collect()}
    assert len(calls) == 2
    assert {r.recipients[1] for r in got.values()} == {"owner1@example.com", "owner2@example.com"}
    assert "Time:       2024-01-01T00:00:01" in got["a1"].body


def test_ingest_job_from_text_files(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    (folder / "0.json").write_text('{"tire_id":"a","pressure":1.5,"temperature":2.5,"timestamp":"1704067200.5"}\n{bad\n')
    table = BatchTable(spark, str(tmp_path / "out"), schemas.TIRE_DATA)
    jobs.start_ingest(read_topic_files(spark, str(folder), text=True), table, str(tmp_path / "cp")).awaitTermination()
    assert [(r.tire_id, r.pressure) for r in table.read().collect()] == [("a", 1.5)]
    assert [tuple(r) for r in jobs.quarantine_table(table).read().collect()] == [("{bad", "malformed")]


def test_tail_prints(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    (folder / "0.json").write_text('{"a":1}\n')
    jobs.start_tail(read_topic_files(spark, str(folder), text=True), str(tmp_path / "cp")).awaitTermination()
    assert read_topic_files(spark, str(folder), streaming=False, text=True).count() == 1


def message(sensor, ms, pressure, temperature=70.0):
    reading = {"sensor_id": sensor, "vehicle_id": "V001", "timestamp": ms, "pressure_kpa": pressure, "temperature_c": temperature}
    return json.dumps(reading)


def topic_files(spark, folder, *files):
    return write_ordered([spark.createDataFrame([(v,) for v in values], "value string") for values in files], folder)


def test_the_first_arrival_of_a_repeat_is_stored(spark, tmp_path):
    # By text the repeat would sort first: HIGH before MEDIUM, 150 before 199.
    same_file = [message("V001-FL", 1_704_067_200_000, 199.0), message("V001-FL", 1_704_067_200_000, 150.0)]
    later = [message("V001-FL", 1_704_067_200_000, 100.0), "{bad", message("V001-FR", 1_704_067_200_000, 150.0)]
    folder = topic_files(spark, tmp_path / "topic", same_file, later)
    table = BatchTable(spark, str(tmp_path / "alerts"), schemas.STORED_ALERT, day_of="timestamp")
    sent = str(tmp_path / "sent")
    for files_per_trigger in (1, None):  # a restart finds nothing new
        jobs.start_json_alerts(
            read_topic_files(spark, folder, files_per_trigger=files_per_trigger, positions=True), rules.TIERED, table,
            lambda batch, n: write_topic_files(batch, sent, n, rule_set=rules.TIERED), str(tmp_path / "cp"), ARRIVAL,
        ).awaitTermination()
    stored = {r.sensor_id: (r.severity, r.triggering_value) for r in table.read().collect()}
    assert stored == {"V001-FL": ("MEDIUM", 199.0), "V001-FR": ("HIGH", 150.0)}
    assert [tuple(r) for r in jobs.quarantine_table(table).read().collect()] == [("{bad", "malformed")]
    assert spark.read.parquet(sent).count() == 4


@pytest.mark.parametrize("rule_set, extra", [(rules.CASE, []), (rules.MULTI, ["processed_at"])])
def test_payload_of_the_rule_set(spark, tmp_path, rule_set, extra):
    folder = topic_files(spark, tmp_path / "topic", [message("V001-FL", 1_704_067_200_500, 150.0)])
    table = BatchTable(spark, str(tmp_path / "alerts"), schemas.STORED_ALERT, day_of="timestamp")
    sent = str(tmp_path / "sent")
    jobs.start_json_alerts(
        read_topic_files(spark, folder, positions=True), rule_set, table,
        lambda batch, n: write_topic_files(batch, sent, n, rule_set=rule_set), str(tmp_path / "cp"), ARRIVAL, stamp=bool(extra),
    ).awaitTermination()
    sent_message = json.loads(spark.read.parquet(sent).first().value)
    assert sent_message["timestamp"] == 1_704_067_200_500
    assert list(sent_message) == schemas.ALERT.names + extra


def test_json_windows_late_rows_and_quarantine(spark, tmp_path):
    start = 1_704_067_200_000
    first = [message("V001-FL", start, 200.0), message("V001-FL", start + 70_000, 210.0), "[1,2]"]
    # A batch judges lateness by the watermark of the one before.
    late_row = [message("V001-FL", start + 10_000, 100.0)]
    folder = topic_files(spark, tmp_path / "topic", first, [message("V001-FL", start + 200_000, 220.0)], late_row)
    table = BatchTable(spark, str(tmp_path / "windows"), schemas.STORED_AGGREGATE, day_of="window_start")
    source = read_topic_files(spark, folder, files_per_trigger=1)
    late = jobs.LateRows()
    spark.streams.addListener(late)
    try:
        query = jobs.start_json_windows(source, table, str(tmp_path / "cp"), exact_scale=2)
        query.awaitTermination()
        jobs.start_quarantine(source, table, str(tmp_path / "cp-bad")).awaitTermination()
        for _ in range(50):
            if late.dropped[str(query.id)]:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    assert windows(table.read()) == [(0, 200.0, 1), (60, 210.0, 1)]
    assert late.dropped[str(query.id)] == jobs.late_rows(query) == 1
    assert [tuple(r) for r in jobs.quarantine_table(table).read().collect()] == [("[1,2]", "malformed")]


def test_every_message_is_stored_or_kept_apart(spark, tmp_path):
    good = [json.dumps({"tire_id": f"t{n}", "pressure": 1.0, "temperature": 2.0, "timestamp": 1_704_067_200 + n}) for n in range(5)]
    bad = ["{bad", "", "[]", '{"tire_id":null,"timestamp":1}', '{"tire_id":"x","timestamp":"soon"}']
    folder = topic_files(spark, tmp_path / "topic", good + bad + [None])
    table = BatchTable(spark, str(tmp_path / "out"), schemas.TIRE_DATA, day_of="timestamp")
    jobs.start_ingest(read_topic_files(spark, folder), table, str(tmp_path / "cp")).awaitTermination()
    kept = jobs.quarantine_table(table).read()
    assert table.read().count() == 5 and kept.count() == 6
    assert {r.value for r in kept.collect()} == {*bad, None}


def test_a_job_that_runs_on(spark, tmp_path):
    assert jobs.every("5 seconds") == {"processingTime": "5 seconds"}
    folder = topic_files(spark, tmp_path / "topic", ['{"tire_id":"a","pressure":1,"temperature":2,"timestamp":1}'])
    table = BatchTable(spark, str(tmp_path / "out"), schemas.TIRE_DATA)
    query = jobs.start_ingest(read_topic_files(spark, folder), table, str(tmp_path / "cp"), jobs.every("100 milliseconds"))
    try:
        query.processAllAvailable()
        assert query.isActive and table.read().count() == 1
    finally:
        query.stop()
