"""Topic output: JSON values, to a broker or to files laid out like a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.text import iso_timestamp
from fleetpulse.operators.rules import RuleSet

# Producer batching.
PRODUCER_OPTIONS = {"kafka.batch.size": "16384", "kafka.linger.ms": "5"}


def as_messages(rows: DataFrame) -> DataFrame:
    """``key, value`` rows; the value is a JSON object of every column.

    No key is set. Timestamps become ISO-8601 text.
    """
    fields = [
        iso_timestamp(F.col(name)).alias(name) if kind == "timestamp" else F.col(name) for name, kind in rows.dtypes
    ]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return rows.select(F.lit(None).cast("string").alias("key"), value.alias("value"))


def alert_messages(alerts: DataFrame, rule_set: RuleSet) -> DataFrame:
    """Alerts as the rule set publishes them: event time as ISO text or as epoch milliseconds."""
    if rule_set.epoch_time:
        alerts = alerts.withColumn("timestamp", F.unix_millis("timestamp"))
    return as_messages(alerts)


def kafka_sink_options(servers: str, topic: str, batched: bool = False) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    return options | PRODUCER_OPTIONS if batched else options


def write_kafka(
    rows: DataFrame, servers: str, topic: str, batched: bool = False, rule_set: RuleSet | None = None
) -> None:
    """Publishes a batch (inside ``foreachBatch`` or on its own)."""
    _messages(rows, rule_set).write.format("kafka").options(**kafka_sink_options(servers, topic, batched)).save()


def write_topic_files(
    rows: DataFrame, path: str, batch_id: int, writer: str = "main", rule_set: RuleSet | None = None
) -> None:
    """Publishes a batch to a folder that stands in for a topic."""
    _messages(rows, rule_set).write.mode("overwrite").parquet(f"{path}/writer={writer}/batch_id={batch_id}")


def _messages(rows: DataFrame, rule_set: RuleSet | None) -> DataFrame:
    return as_messages(rows) if rule_set is None else alert_messages(rows, rule_set)
