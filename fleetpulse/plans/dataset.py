"""Telemetry derived from the given tables, for the registered queries.

Readings come from every row of ``events``: 2 Hz event time by ``event_id``,
five vehicles with four sensors each (so keys are hot by design), and integer
arithmetic with one final division so any engine gets the same doubles.
Contacts come from every ``customer``, contact changes from every ``supplier``.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.operators.aggregates import tumbling_aggregates
from fleetpulse.operators.rules import TIERED, apply_rules
from fleetpulse.sources.tables import read_parquet, stream_parquet

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
START_MS = 1_704_067_200_000
REGISTERED_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
CLOCK = datetime(2024, 6, 1, 12, 0, tzinfo=timezone.utc)
MEASURE_DECIMALS = 2
RESOLUTION_DELAY = timedelta(seconds=2)
PARTS = 4
LATE_BY = 2


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/events.parquet", EVENTS)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as one micro-batch, so file order cannot make rows late."""
    return stream_parquet(spark, f"{sf_dir}/events.parquet", EVENTS)


def derive_readings(rows: DataFrame) -> DataFrame:
    """Events to readings (with the fixture columns kept)."""
    staged = rows.selectExpr(
        "event_id",
        f"{_vehicle_id('(1 + user_id % 5)')} AS vehicle_id",
        "CASE event_id % 4 WHEN 0 THEN 'FL' WHEN 1 THEN 'FR' WHEN 2 THEN 'RL' ELSE 'RR' END AS tire_position",
        f"{START_MS} + event_id * 500 AS ts_ms",
        "CAST(round(value * 100) AS BIGINT) AS v",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    return staged.selectExpr(
        "event_id",
        "concat(vehicle_id, '-', tire_position) AS sensor_id",
        "vehicle_id",
        "tire_position",
        "ts_ms",
        "timestamp_millis(ts_ms) AS ts",
        "CAST(CASE WHEN k < 30 THEN 15000 + (v * 37) % 20001 ELSE 20000 + (v * 37) % 8001 END AS DOUBLE) / 100D"
        " AS pressure_kpa",
        "CAST(CASE WHEN k < 30 THEN 7500 + (v * 13) % 2001 ELSE 6500 + (v * 13) % 1301 END AS DOUBLE) / 100D"
        " AS temperature_c",
        "CAST(280 + event_id % 61 AS DOUBLE) / 100D AS battery_voltage",
        "CAST(60 + v % 61 AS DOUBLE) AS pressure_psi",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_readings(events(spark, sf_dir))


def once(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows with the given columns computed once.

    Filters cannot be pushed through a generator, so a condition on a derived
    column does not derive it again.
    """
    return rows.select(F.inline(F.array(F.struct(*columns))))


def raw_messages(rows: DataFrame) -> DataFrame:
    """Readings as JSON text with faults planted by ``event_id % 101``."""
    head = """'{"sensor_id":"', sensor_id, '","vehicle_id":"', vehicle_id, '","timestamp":', ts_ms"""
    temperature = """',"temperature_c":', temperature_c"""
    return rows.selectExpr(
        "event_id",
        f"""CASE event_id % 101
          WHEN 0 THEN '{{bad'
          WHEN 1 THEN concat({head}, {temperature}, '}}')
          WHEN 2 THEN concat({head}, ',"pressure_kpa":"', pressure_kpa, '"', {temperature}, '}}')
          WHEN 3 THEN concat({head}, ',"pressure_kpa":null', {temperature}, '}}')
          WHEN 4 THEN '[1,2]'
          ELSE concat({head}, ',"pressure_kpa":', pressure_kpa, {temperature}, ',"battery_voltage":', battery_voltage, '}}')
        END AS value""",
    )


def arriving_parts(rows: DataFrame) -> list[DataFrame]:
    """The rows in the order of arrival: spans of ``event_id``, with some rows ``LATE_BY`` parts late."""
    size = rows.agg(F.coalesce(F.max("event_id"), F.lit(0)) + 1).first()[0]
    event_id = F.col("event_id")

    def span(n: int) -> Column:
        return (event_id >= -(-n * size // PARTS)) & (event_id < -(-(n + 1) * size // PARTS))

    late = (event_id % 97 == 5) & (event_id < -(-(PARTS - LATE_BY) * size // PARTS))
    return [rows.filter((span(n) & ~late) | (span(n - LATE_BY) & late)) for n in range(PARTS)]


def with_arrival(rows: DataFrame) -> DataFrame:
    """Readings with the time they came in, up to six seconds after the event."""
    delay = F.make_dt_interval(secs=(F.col("event_id") % 7).cast("decimal(18,6)"))
    return rows.withColumn("arrival", F.col("ts") + delay)


def arrivals(rows: DataFrame) -> tuple[list[DataFrame], list[datetime]]:
    """Readings in ``PARTS`` spans of arrival, and the clock after each span; after the last, the last window's end has passed."""
    first, last = (rows.agg(F.unix_millis(f("arrival"))).first()[0] or START_MS for f in (F.min, F.max))
    marks = [first + (last + 1 - first) * n // PARTS for n in range(PARTS)] + [last + 1]
    at = F.unix_millis("arrival")
    spans = [rows.filter((at >= low) & (at < high)) for low, high in zip(marks, marks[1:])]
    clock = [*marks[1:PARTS], last + 60_000]
    return spans, [datetime.fromtimestamp(ms / 1000, timezone.utc) for ms in clock]


def with_repeats(rows: DataFrame) -> DataFrame:
    """Some readings are followed by a repeat with the same time and a very low pressure."""
    copies = F.explode(F.expr("CASE WHEN event_id % 50 = 7 THEN array(0, 1) ELSE array(0) END"))
    pressure = F.expr("CASE WHEN copy = 1 THEN 150D ELSE pressure_kpa END")
    return rows.withColumn("copy", copies).withColumn("pressure_kpa", pressure).drop("copy")


def faulty_alerts(rows: DataFrame) -> DataFrame:
    """Tiered alerts, some without a severity and some with too long a type."""
    alerts = tiered_alerts(rows, carry=("event_id",))
    return alerts.withColumns(
        {
            "severity": F.expr("CASE WHEN event_id % 10 <> 3 THEN severity END"),
            "alert_type": F.expr("CASE WHEN event_id % 10 = 7 THEN repeat(alert_type, 5) ELSE alert_type END"),
        }
    )


def measured(rows: DataFrame) -> DataFrame:
    """What the alert rules read."""
    return once(rows, "event_id", "sensor_id", "vehicle_id", "ts_ms", "pressure_kpa", "temperature_c")


def legacy_readings(rows: DataFrame) -> DataFrame:
    legacy = rows.withColumn("timestamp", F.col("ts_ms"))
    return once(legacy, "vehicle_id", "tire_position", "pressure_psi", "temperature_c", "timestamp")


def tire_data_messages(rows: DataFrame) -> DataFrame:
    """Ingest messages; every second one carries its time as text."""
    return rows.withColumn("seconds", F.expr("CAST(ts_ms / 1000 AS DECIMAL(20, 1))")).selectExpr(
        """concat('{"tire_id":"', sensor_id, '","pressure":', pressure_kpa, ',"temperature":', temperature_c,
             ',"timestamp":', CASE WHEN event_id % 2 = 0 THEN concat(seconds) ELSE concat('"', seconds, '"') END, '}')
           AS value"""
    )


def faulty_tire_data(rows: DataFrame) -> DataFrame:
    """Ingest messages of which some cannot be read."""
    return rows.selectExpr(
        """CASE event_id % 53
             WHEN 0 THEN '{bad'
             WHEN 1 THEN concat('{"pressure":', pressure_kpa, ',"timestamp":', ts_ms, '}')
             WHEN 2 THEN concat('{"tire_id":"', sensor_id, '","timestamp":"soon"}')
             ELSE concat('{"tire_id":"', sensor_id, '","pressure":', pressure_kpa, ',"timestamp":', event_id, '}')
           END AS value"""
    )


def tiered_alerts(rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return apply_rules(measured(rows), TIERED, carry=carry)


def alert_table(rows: DataFrame) -> DataFrame:
    """Tiered alerts with the columns a stored alert has."""
    alerts = tiered_alerts(rows, carry=("event_id",))
    return (
        alerts.withColumn("is_resolved", F.col("event_id") % 3 == 0)
        .withColumn("created_at", F.col("timestamp") + F.lit(RESOLUTION_DELAY))
        .drop("event_id")
    )


def aggregate_table(rows: DataFrame) -> DataFrame:
    return tumbling_aggregates(rows, exact_scale=MEASURE_DECIMALS)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One vehicle per customer, from V002 on; some without an owner address."""
    return read_parquet(spark, f"{sf_dir}/customer.parquet").selectExpr(
        f"{_vehicle_id('(c_custkey + 2)')} AS vehicle_id",
        "CASE WHEN c_acctbal < 0 THEN '' ELSE concat('owner', c_custkey, '@example.com') END AS owner_email",
        "concat(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'owner' ELSE 'driver' END, c_custkey, '@example.com')"
        " AS driver_email",
        f"timestamp_seconds({int(REGISTERED_AT.timestamp())}) AS created_at",
    )


def contact_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier takes over one vehicle: known ones change, others are new."""
    return read_parquet(spark, f"{sf_dir}/supplier.parquet").selectExpr(
        f"{_vehicle_id('(s_suppkey * 20 + 1)')} AS vehicle_id",
        "concat('fleet', s_suppkey, '@example.com') AS owner_email",
        "concat('desk', s_suppkey, '@example.com') AS driver_email",
    )


def _vehicle_id(number: str) -> str:
    digits = f"CAST({number} AS STRING)"
    return f"concat('V', CASE WHEN {number} < 1000 THEN lpad({digits}, 3, '0') ELSE {digits} END)"
