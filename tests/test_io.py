"""Adapters whose servers are not at hand: options, statements, shapes."""

import json
from types import SimpleNamespace

import pytest
from helpers import alerts

from fleetpulse.session import scratch_path
from fleetpulse.sinks import jdbc
from fleetpulse.sinks.topics import as_messages, kafka_sink_options, write_topic_files
from fleetpulse.sources import tables, topics


def test_kafka_options():
    assert topics.kafka_source_options("h:1", topics.RAW_TOPIC) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "tire.raw",
        "startingOffsets": "earliest",
    }
    options = topics.kafka_source_options("h:1", topics.ALERT_TOPIC, topics.LATEST, "notifier", 500)
    assert options["startingOffsets"] == "latest"
    assert options["groupIdPrefix"] == "notifier" and options["maxOffsetsPerTrigger"] == "500"
    assert kafka_sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    assert kafka_sink_options("h:1", "t", batched=True)["kafka.linger.ms"] == "5"


def test_kafka_without_its_connector_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic(spark, "h:1", "t", streaming=False)


def test_jdbc_options_and_statements():
    options = tables.jdbc_source_options("jdbc:x", "tire_alerts", ("id", "1", "1000", 8), user="u")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["user"] == "u"
    assert jdbc.jdbc_sink_options("jdbc:x", "t", jdbc.ALERT_BATCH)["batchsize"] == "100"
    assert jdbc.AGGREGATE_BATCH == 1000
    assert (
        jdbc.insert_ignore_statement("t", "s", ["a", "b"], "a")
        == "INSERT INTO t (a, b) SELECT a, b FROM s ON CONFLICT (a) DO NOTHING"
    )
    assert jdbc.upsert_statement("t", "s", ["a", "b"], "a", ["b"]).endswith("DO UPDATE SET b = EXCLUDED.b")


def test_messages_have_no_key_and_keep_nulls(spark, tmp_path):
    rows = alerts(spark, [("a", "V001", 0, None)])
    row = as_messages(rows).first()
    assert row.key is None
    value = json.loads(row.value)
    assert value["severity"] is None and value["timestamp"] == "2024-01-01T00:00:00"
    path = str(tmp_path / "topic")
    for _ in range(2):
        write_topic_files(rows, path, 0)
    assert topics.read_topic_files(spark, path, streaming=False).count() == 1


def session_like(master, folder):
    conf = SimpleNamespace(get=lambda name, default: folder if name == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_folder_follows_the_session():
    shared = session_like("spark://h:1", "hdfs://n/shared/")
    path = scratch_path(shared, "x")
    assert path.startswith("hdfs://n/shared/fleetpulse/x-") and path != scratch_path(shared, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session_like("spark://h:1", None), "x")
    assert "fleetpulse" in scratch_path(session_like("local[2]", None), "x")


def test_text_files_have_no_positions(spark):
    with pytest.raises(ValueError, match="positions"):
        topics.read_topic_files(spark, "x", text=True, positions=True)
