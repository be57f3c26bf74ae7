"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each runs over whole tables. Times are returned without zone.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions import schemas
from fleetpulse.functions.text import iso_timestamp
from fleetpulse.functions.times import day_before, event_time_whole_seconds, naive
from fleetpulse.operators import aggregates, constraints, merge, notify, parse, rules, serving
from fleetpulse.operators.summaries import Summaries
from fleetpulse.plans import dataset as data
from fleetpulse.session import scratch_path, use_utc
from fleetpulse.sinks import packing
from fleetpulse.sinks.buckets import BucketTable
from fleetpulse.sinks.tables import BatchTable, VersionedTable, append_rows
from fleetpulse.sinks.topics import alert_messages, as_messages, write_topic_files
from fleetpulse.sources.clock import recorded_ticks
from fleetpulse.sources.topics import ARRIVAL, read_topic_files
from fleetpulse.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(plan: Query) -> Query:
    """Registers a plan under its function name."""

    @wraps(plan)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _zoneless(plan(use_utc(spark), sf_dir))

    CATALOG[plan.__name__] = run
    return run


# Aggregates


@query
def tumble_agg_1m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.aggregate_table(data.readings(spark, sf_dir))


@query
def tumble_agg_1m_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = BatchTable(spark, scratch_path(spark, "windows"), schemas.STORED_AGGREGATE)
    stream = data.derive_readings(data.events_stream(spark, sf_dir))
    jobs.start_aggregates(
        stream, table, scratch_path(spark, "windows-checkpoint"), exact_scale=data.MEASURE_DECIMALS
    ).awaitTermination()
    return table.read().select(*serving.AGGREGATE_COLUMNS)


@query
def tumble_agg_ingest_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrived = data.with_arrival(data.readings(spark, sf_dir))
    return aggregates.tumbling_aggregates(arrived, "arrival", exact_scale=data.MEASURE_DECIMALS)


@query
def tumble_agg_clock_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by arrival, closed by the clock: after the last reading only the clock goes on, and the last windows are written."""
    table = _aggregate_table(spark)
    topic, ticks, checkpoint = (scratch_path(spark, n) for n in ("arrived", "ticks", "clock-checkpoint"))
    arrived = data.with_arrival(data.readings(spark, sf_dir))
    spans, clock = data.arrivals(arrived)
    for number, now in enumerate(clock):
        spans[number].write.mode("append").parquet(topic)
        for at in [now] if number + 1 < len(clock) else [None, now]:
            spark.createDataFrame([(at,)] if at else [], "tick timestamp").write.mode("append").parquet(ticks)
            jobs.start_clock_windows(
                spark.readStream.schema(arrived.schema).parquet(topic), recorded_ticks(spark, ticks), table, checkpoint,
                time_col="arrival", exact_scale=data.MEASURE_DECIMALS,
            ).awaitTermination()
    return table.read().select(*serving.AGGREGATE_COLUMNS)


@query
def aggregates_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored with ids and whole-second bounds; the first batch is replayed."""
    table = _aggregate_table(spark)
    rows = data.aggregate_table(data.readings(spark, sf_dir))
    for name in ("window_start", "window_end"):
        rows = rows.withColumn(name, event_time_whole_seconds(F.unix_millis(name)))
    for _ in range(2):
        jobs.store_aggregates(rows, 0, table, clock=data.CLOCK)
    return table.read()


@query
def windows_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to windows; those without a value for every column stay out."""
    return _json_windows(spark, sf_dir).valid


@query
def windows_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_windows(spark, sf_dir).rejected.select("sensor_id", "window_start", "record_count", "reason")


@query
def short_windows_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows so short that many hold no readable pressure, refused by the table."""
    table = _aggregate_table(spark)
    readings = parse.with_event_time(parse.parse_strict(_messages(spark, sf_dir)).valid)
    windows = aggregates.tumbling_aggregates(readings, length="10 seconds", exact_scale=data.MEASURE_DECIMALS)
    jobs.store_aggregates(windows, 0, table, clock=data.CLOCK, serial=False)
    return jobs.rejected_table(table).read().select("sensor_id", "window_start", "record_count", "reason")


@query
def windows_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that arrive in parts, some behind the watermark; the job is started again for every part."""
    table = _aggregate_table(spark)
    topic, checkpoint = scratch_path(spark, "raw-topic"), scratch_path(spark, "windows-checkpoint")
    for part in data.arriving_parts(data.readings(spark, sf_dir)):
        data.raw_messages(part).select("value").write.mode("append").parquet(topic)
        jobs.start_json_windows(
            read_topic_files(spark, topic), table, checkpoint, exact_scale=data.MEASURE_DECIMALS
        ).awaitTermination()
    return table.read().select(*serving.AGGREGATE_COLUMNS)


# Alert rules


@query
def alerts_tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = data.tiered_alerts(data.readings(spark, sf_dir))
    return alerts.withColumn("iso_time", iso_timestamp(F.col("timestamp")))


@query
def alerts_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(data.measured(data.readings(spark, sf_dir)), rules.MULTI, clock=data.CLOCK, stamp=True)


@query
def alerts_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(data.measured(data.readings(spark, sf_dir)), rules.CASE)


@query
def alerts_legacy_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.legacy_alerts(data.legacy_readings(data.readings(spark, sf_dir)))


@query
def alerts_legacy_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.legacy_checks(data.legacy_readings(data.readings(spark, sf_dir)))


@query
def reading_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.label(data.readings(spark, sf_dir)).select(
        "sensor_id", "ts_ms", "pressure_kpa", "temperature_c", "label"
    )


@query
def smoke_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.smoke_classes(_messages(spark, sf_dir)).select("event_id", "value", "class")


@query
def alerts_legacy_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy messages in, legacy alert messages out."""
    readings = data.legacy_readings(data.readings(spark, sf_dir))
    messages = as_messages(readings).select("value")
    return as_messages(rules.legacy_alerts(parse.parse_legacy(messages))).select("value")


# Parsing


@query
def parse_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_strict(_messages(spark, sf_dir)).valid


@query
def parse_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.with_event_time(parse.parse_tolerant(_messages(spark, sf_dir)).valid)


@query
def parse_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_strict(_messages(spark, sf_dir)).quarantine


@query
def parse_tolerant_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_tolerant(_messages(spark, sf_dir)).quarantine


@query
def parse_sql_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_sql_table(_messages(spark, sf_dir))


@query
def alerts_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(parse.parse_tolerant(_messages(spark, sf_dir)).valid, rules.TIERED)


# Sinks


@query
def alert_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = as_messages(data.tiered_alerts(data.readings(spark, sf_dir)))
    return parse.parse_alert_messages(messages.select("value"))


@query
def alert_payload_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time as epoch milliseconds."""
    alerts = rules.apply_rules(data.measured(data.readings(spark, sf_dir)), rules.CASE)
    return alert_messages(alerts, rules.CASE).select("value")


@query
def alert_payload_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time as epoch milliseconds, and when the alert was made."""
    readings = data.measured(data.readings(spark, sf_dir))
    alerts = rules.apply_rules(readings, rules.MULTI, clock=data.CLOCK, stamp=True)
    return alert_messages(alerts, rules.MULTI).select("value")


@query
def alerts_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that the table refuses, kept with the reason."""
    table = _alert_table(spark)
    jobs.store_alerts(
        data.faulty_alerts(data.readings(spark, sf_dir)), 0, table, ("event_id",), ids_carry_time=True, serial=False
    )
    return jobs.rejected_table(table).read().select("alert_id", "alert_type", "severity", "reason")


@query
def alerts_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in parts, with repeats of which the first arrival counts."""
    return _json_alerts(spark, sf_dir).read().select(*serving.ALERT_COLUMNS)


@query
def alerts_json_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.quarantine_table(_json_alerts(spark, sf_dir)).read()


@query
def alerts_from_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published alerts read back with real timestamps."""
    messages = as_messages(data.tiered_alerts(data.readings(spark, sf_dir)))
    return parse.typed_alerts(parse.parse_alert_messages(messages.select("value")))


@query
def alerts_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats inside a batch, ids known from an earlier batch, a replayed batch."""
    table = _alert_table(spark)
    rows = data.readings(spark, sf_dir)
    sent = data.tiered_alerts(rows).withColumn("arrival", F.lit(0))
    again = sent.withColumn("arrival", F.lit(1)).withColumn("description", F.lit("sent again"))
    repeated = sent.unionByName(again)
    other = rules.apply_rules(data.measured(rows), rules.MULTI)
    jobs.store_alerts(repeated, 0, table, ("arrival",), clock=data.CLOCK)
    for _ in range(2):
        jobs.store_alerts(other, 1, table, ("description",), clock=data.CLOCK, ids_carry_time=True)
    return table.read()


@query
def alerts_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, topic = _alert_table(spark), scratch_path(spark, "alert-topic")
    alerts = data.tiered_alerts(data.readings(spark, sf_dir))
    jobs.fan_out(
        alerts, 0, table, lambda batch, n: write_topic_files(batch, topic, n), ("alert_id",), clock=data.CLOCK,
        ids_carry_time=True, serial=False,
    )
    return _both_branches(spark, table, topic)


@query
def alerts_stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, topic = _alert_table(spark), scratch_path(spark, "alert-topic")
    jobs.start_alerts(
        data.measured(data.derive_readings(data.events_stream(spark, sf_dir))),
        rules.TIERED,
        table,
        lambda batch, n: write_topic_files(batch, topic, n),
        scratch_path(spark, "alerts-checkpoint"),
        arrival=("event_id",),
    ).awaitTermination()
    return _both_branches(spark, table, topic)


@query
def alerts_stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every alert arrives again one micro-batch later, with other text; the stream keeps the first."""
    table = BatchTable(spark, scratch_path(spark, "distinct-alerts"), schemas.ALERT)
    topic, checkpoint = scratch_path(spark, "alerts-in"), scratch_path(spark, "distinct-checkpoint")
    parts = data.arriving_parts(data.readings(spark, sf_dir))
    for number in range(len(parts) + 1):
        for copy, sent in enumerate((number, number - 1)):
            if 0 <= sent < len(parts):
                again = data.tiered_alerts(parts[sent]).withColumn("copy", F.lit(copy))
                text = F.when(F.col("copy") == 1, F.lit("sent again")).otherwise(F.col("description"))
                again.withColumn("description", text).write.mode("append").parquet(topic)
        alerts = spark.readStream.schema(again.schema).parquet(topic)
        jobs.start_distinct(alerts, table, checkpoint, ("copy",)).awaitTermination()
    return table.read()


@query
def alerts_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches stored in between two merges of their files; what the merges replaced is gone."""
    table = _alert_table(spark)
    alerts = data.tiered_alerts(data.readings(spark, sf_dir), carry=("event_id",))
    stored = merge.with_alert_defaults(alerts, data.CLOCK).withColumn("id", F.lit(None).cast("bigint"))
    for part in range(6):
        table.append(stored.filter(F.col("event_id") % 6 == part), part)
        if part in (2, 4):
            packing.pack(table.layout, least=2)
            packing.expire(table.layout, grace=0, now=time.time() + 1)
    return table.read().select(*serving.ALERT_COLUMNS)


@query
def vehicles_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = VersionedTable(spark, scratch_path(spark, "vehicles"), schemas.VEHICLE)
    table.replace(data.vehicles(spark, sf_dir))
    changes = data.contact_changes(spark, sf_dir)
    table.replace(
        merge.upsert(table.read(), changes, "vehicle_id", ["owner_email", "driver_email"], clock=data.CLOCK)
    )
    return table.read()


@query
def tire_data_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = scratch_path(spark, "tire-data-topic")
    data.tire_data_messages(data.readings(spark, sf_dir)).write.parquet(topic)
    table = BatchTable(spark, scratch_path(spark, "tire-data"), schemas.TIRE_DATA, day_of="timestamp")
    jobs.start_ingest(
        read_topic_files(spark, topic), table, scratch_path(spark, "tire-data-checkpoint")
    ).awaitTermination()
    return table.read()


@query
def ingest_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest messages that cannot be read, kept with the reason."""
    topic = scratch_path(spark, "tire-data-topic")
    data.faulty_tire_data(data.readings(spark, sf_dir)).write.parquet(topic)
    table = BatchTable(spark, scratch_path(spark, "tire-data"), schemas.TIRE_DATA, day_of="timestamp")
    jobs.start_ingest(
        read_topic_files(spark, topic), table, scratch_path(spark, "tire-data-checkpoint")
    ).awaitTermination()
    return jobs.quarantine_table(table).read()


@query
def tire_data_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct inserts, the time left out for hot tires, then the full scan."""
    table = BatchTable(spark, scratch_path(spark, "tire-data-api"), schemas.TIRE_DATA)
    rows = data.readings(spark, sf_dir).select(
        F.col("sensor_id").alias("tire_id"),
        F.col("pressure_kpa").alias("pressure"),
        F.col("temperature_c").alias("temperature"),
        F.when(F.col("temperature_c") <= 80, F.col("ts")).alias("timestamp"),
    )
    append_rows(table, rows, 0, clock=data.CLOCK)
    return table.read()


# Serving


@query
def latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_alerts(data.alert_table(data.readings(spark, sf_dir)))


@query
def latest_aggregations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_aggregations(data.aggregate_table(data.readings(spark, sf_dir)))


@query
def stored_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _alert_table(spark)
    alerts = data.tiered_alerts(data.readings(spark, sf_dir))
    jobs.store_alerts(alerts, 0, table, ("alert_id",), clock=data.CLOCK, ids_carry_time=True)
    return serving.alert_response(serving.latest_alerts(table.newest(serving.LATEST_LIMIT)))


@query
def stored_latest_aggregations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _aggregate_table(spark)
    jobs.store_aggregates(data.aggregate_table(data.readings(spark, sf_dir)), 0, table, clock=data.CLOCK)
    return serving.aggregate_response(serving.latest_aggregations(table.newest(serving.LATEST_LIMIT, slack=1)))


@query
def stored_recent_aggregations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last hour up to the newest window, from the days that can hold it."""
    table = _aggregate_table(spark)
    jobs.store_aggregates(data.aggregate_table(data.readings(spark, sf_dir)), 0, table, clock=data.CLOCK, serial=False)
    newest = table.newest(1).agg(F.unix_seconds(F.max("window_start"))).first()[0]
    as_of = datetime.fromtimestamp(newest, timezone.utc)
    recent = table.read(since=day_before(as_of, timedelta(hours=1)))
    return serving.recent_aggregations(recent, as_of).select(*serving.AGGREGATE_COLUMNS)


@query
def stored_dashboard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals from the summaries of merged days and the batches behind them."""
    alerts, windows = _alert_table(spark), _aggregate_table(spark)
    summaries = Summaries(spark, scratch_path(spark, "summaries"), alerts, windows)
    parts = data.arriving_parts(data.readings(spark, sf_dir))
    stored = data.aggregate_table(data.readings(spark, sf_dir)).withColumns({"id": _no_id(), "created_at": F.lit(data.CLOCK)})
    for number, part in enumerate(parts):
        alerts.append(data.alert_table(part).withColumn("id", _no_id()), number)
        windows.append(stored.filter(F.pmod(F.xxhash64("sensor_id", "window_start"), F.lit(len(parts))) == number), number)
        if number in (1, 2):
            for table in (alerts, windows):
                packing.pack(table.layout, least=1)
            summaries.refresh(number)
    return summaries.dashboard(clock=data.CLOCK)


@query
def stored_current_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open alerts of the stored table; the flag is filtered in the scan."""
    table = _alert_table(spark)
    table.append(data.alert_table(data.readings(spark, sf_dir)).withColumn("id", _no_id()), 0)
    return serving.current_alerts(table.read().drop("id"))


@query
def stored_high_alerts_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly alarm over the stored table; alerts are stored at most a day after their time, so older days stay closed."""
    table = _alert_table(spark)
    rows = data.readings(spark, sf_dir)
    table.append(data.alert_table(rows).withColumn("id", _no_id()), 0)
    newest = rows.agg(F.unix_micros(F.max("ts"))).first()[0]
    as_of = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=newest)
    recent = table.read(since=day_before(as_of, timedelta(days=1, hours=1)))
    return serving.high_alerts_since(recent, as_of)


@query
def vehicle_latest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest metrics of every vehicle, kept batch by batch, with late rows."""
    table = BucketTable(spark, scratch_path(spark, "latest"), schemas.METRIC, "vehicle_id")
    topic, checkpoint = scratch_path(spark, "metrics"), scratch_path(spark, "latest-checkpoint")
    for part in data.arriving_parts(data.readings(spark, sf_dir)):
        metrics = part.withColumn("timestamp", F.col("ts")).select(*schemas.METRIC.names)
        metrics.write.mode("append").parquet(topic)
        jobs.start_latest(spark.readStream.schema(schemas.METRIC).parquet(topic), table, checkpoint, ["sensor_id"]).awaitTermination()
    return serving.latest_per_vehicle(table.read(), ["sensor_id"])


@query
def vehicles_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``vehicles_upsert``, but only the buckets of changed vehicles are rewritten."""
    table = BucketTable(spark, scratch_path(spark, "vehicle-buckets"), schemas.VEHICLE, "vehicle_id")
    table.update(data.vehicles(spark, sf_dir), lambda _, batch: batch)
    changed = ["owner_email", "driver_email"]
    for _ in range(2):
        table.update(
            data.contact_changes(spark, sf_dir),
            lambda existing, batch: merge.upsert(existing, batch, "vehicle_id", changed, clock=data.CLOCK),
        )
    return table.read()


@query
def vehicle_latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_per_vehicle(
        data.readings(spark, sf_dir).select(
            "vehicle_id", "sensor_id", F.col("ts").alias("timestamp"), "pressure_kpa", "temperature_c"
        ),
        ties=["sensor_id"],
    )


@query
def vehicle_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_per_vehicle(data.alert_table(data.readings(spark, sf_dir)), ties=["alert_id"])


@query
def one_vehicle_latest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_of_vehicle(data.alert_table(data.readings(spark, sf_dir)), "V003", ties=["alert_id"])


@query
def current_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.current_alerts(data.alert_table(data.readings(spark, sf_dir)))


@query
def recent_aggregations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.readings(spark, sf_dir)
    return serving.recent_aggregations(data.aggregate_table(rows), serving.newest(rows, "ts"))


@query
def dashboard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.readings(spark, sf_dir)
    return serving.dashboard_summary(data.alert_table(rows), data.aggregate_table(rows), clock=data.CLOCK)


@query
def alert_severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.severity_counts(data.alert_table(data.readings(spark, sf_dir)))


@query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.readings(spark, sf_dir)
    return serving.table_counts(data.alert_table(rows), data.aggregate_table(rows), as_int=True)


@query
def high_alerts_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.readings(spark, sf_dir)
    return serving.high_alerts_since(data.alert_table(rows), serving.newest(rows, "ts"))


@query
def panel_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.panel_series(data.aggregate_table(data.readings(spark, sf_dir)))


@query
def panel_alert_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.alert_distribution(data.alert_table(data.readings(spark, sf_dir)))


@query
def panel_active_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.active_vehicles(data.aggregate_table(data.readings(spark, sf_dir)))


# Notifications


@query
def notifications_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = BatchTable(spark, scratch_path(spark, "outbox"), schemas.NOTIFICATION)
    alerts = data.tiered_alerts(data.readings(spark, sf_dir))
    outbox.append(notify.notifications(alerts, data.vehicles(spark, sf_dir)), batch_id=0)
    return outbox.read().withColumn("recipients", F.concat_ws(", ", "recipients"))


@query
def notifications_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the alert topic; the payload's own time text goes into the body."""
    topic = scratch_path(spark, "alert-topic")
    as_messages(data.tiered_alerts(data.readings(spark, sf_dir))).write.parquet(topic)
    outbox = BatchTable(spark, scratch_path(spark, "outbox"), schemas.NOTIFICATION)
    jobs.start_notifications(
        read_topic_files(spark, topic),
        lambda: data.vehicles(spark, sf_dir),
        outbox,
        scratch_path(spark, "outbox-checkpoint"),
    ).awaitTermination()
    return outbox.read().withColumn("recipients", F.concat_ws(", ", "recipients"))


@query
def notifications_unroutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = data.tiered_alerts(data.readings(spark, sf_dir))
    return notify.unroutable(alerts, data.vehicles(spark, sf_dir)).select(
        "alert_id", "vehicle_id", "alert_type", "severity"
    )


def _no_id() -> Column:
    return F.lit(None).cast("bigint")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.raw_messages(data.readings(spark, sf_dir))


def _alert_table(spark: SparkSession) -> BatchTable:
    return BatchTable(spark, scratch_path(spark, "alerts"), schemas.STORED_ALERT, day_of="timestamp")


def _aggregate_table(spark: SparkSession) -> BatchTable:
    return BatchTable(spark, scratch_path(spark, "aggregates"), schemas.STORED_AGGREGATE, day_of="window_start")


def _json_windows(spark: SparkSession, sf_dir: str) -> constraints.Split:
    readings = parse.with_event_time(parse.parse_strict(_messages(spark, sf_dir)).valid)
    windows = aggregates.tumbling_aggregates(readings, exact_scale=data.MEASURE_DECIMALS)
    return constraints.split_storable(windows, constraints.AGGREGATE_REQUIRED, constraints.AGGREGATE_LENGTHS)


def _json_alerts(spark: SparkSession, sf_dir: str) -> BatchTable:
    table = _alert_table(spark)
    topic, published = scratch_path(spark, "raw-topic"), scratch_path(spark, "alert-topic")
    checkpoint = scratch_path(spark, "alerts-checkpoint")
    for part in data.arriving_parts(data.readings(spark, sf_dir)):
        data.raw_messages(data.with_repeats(part)).select("value").write.mode("append").parquet(topic)
        jobs.start_json_alerts(
            read_topic_files(spark, topic, positions=True),
            rules.TIERED,
            table,
            lambda batch, n: write_topic_files(batch, published, n, rule_set=rules.TIERED),
            checkpoint,
            ARRIVAL,
        ).awaitTermination()
    return table


def _both_branches(spark: SparkSession, table: BatchTable, topic: str) -> DataFrame:
    """Which alerts reached the table and which the topic."""
    published = parse.parse_alert_messages(
        spark.read.schema("value string").parquet(topic).select("value")
    )
    stored = table.read().select("alert_id", "severity", F.lit(1).alias("t"), F.lit(0).alias("p"))
    return (
        stored.unionByName(published.select("alert_id", "severity", F.lit(0).alias("t"), F.lit(1).alias("p")))
        .groupBy("alert_id", "severity")
        .agg(F.sum("t").alias("in_table"), F.sum("p").alias("in_topic"))
    )


def _zoneless(rows: DataFrame) -> DataFrame:
    return rows.select(*[naive(F.col(c)).alias(c) if kind == "timestamp" else F.col(c) for c, kind in rows.dtypes])
