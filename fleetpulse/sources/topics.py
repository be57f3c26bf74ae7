"""Topic input: a broker, or folders of message files laid out like a topic.

Both give the same shape: a string column ``value`` holding one JSON object,
and with ``positions`` the columns of ``ARRIVAL``, by which messages came in.
Parsing carries them along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Topic names.
RAW_TOPIC, ALERT_TOPIC, INGEST_TOPIC = "tire.raw", "tire.alerts", "tire_data"
EARLIEST, LATEST = "earliest", "latest"

ARRIVAL = ("topic_time", "topic_partition", "topic_offset")


def kafka_source_options(
    servers: str, topic: str, offsets: str = EARLIEST, group: str | None = None, per_trigger: int | None = None
) -> dict[str, str]:
    """Spark keeps offsets in the checkpoint; the group only names the reader."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": offsets}
    if group:
        options["groupIdPrefix"] = group
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    offsets: str = EARLIEST,
    group: str | None = None,
    streaming: bool = True,
    per_trigger: int | None = None,
    positions: bool = False,
) -> DataFrame:
    """Messages of a topic; a batch read goes from ``offsets`` to the end."""
    reader = spark.readStream if streaming else spark.read
    options = kafka_source_options(servers, topic, offsets, group, per_trigger)
    messages = reader.format("kafka").options(**options).load()
    position = [
        "timestamp AS topic_time",
        "CAST(partition AS STRING) AS topic_partition",
        "offset AS topic_offset",
    ]
    return messages.selectExpr("CAST(value AS STRING) AS value", *(position if positions else []))


def read_topic_files(
    spark: SparkSession,
    path: str,
    streaming: bool = True,
    files_per_trigger: int | None = None,
    text: bool = False,
    positions: bool = False,
) -> DataFrame:
    """Messages from Parquet (column ``value``) or text files, one per row.

    A Parquet file counts as a partition: its time, its path and the row's
    place in it are the position. Text files know no places.
    """
    if text and positions:
        raise ValueError("text files have no row positions; use Parquet files")
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if text:
        return reader.text(path)
    messages = reader.schema("value string").parquet(path)
    position = [
        "_metadata.file_modification_time AS topic_time",
        "_metadata.file_path AS topic_partition",
        "_metadata.row_index AS topic_offset",
    ]
    return messages.selectExpr("value", *position) if positions else messages
