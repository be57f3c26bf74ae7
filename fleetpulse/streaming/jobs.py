"""Long-running jobs: the batch transforms behind Structured Streaming.

Each job keeps its offsets and state in a checkpoint and writes through an
idempotent per-batch append, so a restart repeats a batch without repeating
rows. ``writer`` must be unique per checkpoint.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fleetpulse.functions import schemas
from fleetpulse.functions.times import Clock, at, utc_day
from fleetpulse.operators import parse
from fleetpulse.operators.aggregates import (
    WATERMARK_DELAY,
    WINDOW,
    clock_windows,
    tumbling_aggregates,
    with_ingest_time,
    with_watermark,
)
from fleetpulse.operators.constraints import AGGREGATE_LENGTHS, AGGREGATE_REQUIRED, ALERT_LENGTHS, ALERT_REQUIRED, split_storable
from fleetpulse.operators.merge import insert_ignore, with_alert_defaults, with_serial_id
from fleetpulse.operators.notify import notifications
from fleetpulse.operators.rules import RuleSet, apply_rules
from fleetpulse.operators.serving import ALERT_COLUMNS, latest_per_vehicle, newest_rows
from fleetpulse.sinks.buckets import BucketTable
from fleetpulse.sinks.keys import KeyIndex
from fleetpulse.sinks.tables import BatchTable

AVAILABLE_NOW: dict = {"availableNow": True}

Publish = Callable[[DataFrame, int], None]
Judge = Callable[[DataFrame], DataFrame]


def every(interval: str) -> dict:
    """Trigger for a continuously running job, such as ``5 seconds``."""
    return {"processingTime": interval}


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows kept while they are read more than once, unless they are kept already.

    Without it a second read repeats the plan behind them, in a stateful
    stream the state update as well.
    """
    if rows.is_cached:
        yield rows
        return
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def rejected_table(table: BatchTable) -> BatchTable:
    """Where rows that a table does not take are kept, with the reason."""
    fields = [f for f in table.schema.fields if f.name not in ("id", "is_resolved", "created_at")]
    schema = T.StructType([*fields, T.StructField("reason", T.StringType())])
    return BatchTable(table.spark, f"{table.path}-rejected", schema)


def quarantine_table(table: BatchTable) -> BatchTable:
    """Where messages meant for a table are kept that could not be read, with the reason."""
    return BatchTable(table.spark, f"{table.path}-quarantine", schemas.QUARANTINE)


def store_alerts(
    alerts: DataFrame,
    batch_id: int,
    table: BatchTable,
    arrival: tuple[str, ...],
    writer: str = "main",
    clock: Clock = None,
    ids_carry_time: bool = False,
    serial: bool = True,
) -> None:
    """Insert-ignore of one batch into the alert table.

    ``arrival`` names the columns that say which repeat came first. The batch's own folder is left out of the stored keys, or a replay would
    reject its own rows. ``ids_carry_time`` says that equal ids imply equal
    event times, as for rule-made ids; then only the stored days that the
    batch touches are opened. Otherwise ids are looked up in the table's key
    index, which opens only the buckets that hold ids like the batch's; a table
    that has an index goes on keeping it. ``serial`` numbers the rows. Alerts without a
    required value, or with too long a text, go to ``rejected_table``.
    """
    with held(alerts):
        split = split_storable(alerts, ALERT_REQUIRED, ALERT_LENGTHS)
        rejected_table(table).append(split.rejected, batch_id, writer)
        keys = known_keys(table)
        indexed = keys.exists()
        if ids_carry_time and not indexed:
            days = None
            if table.day_of is not None:
                day = utc_day(F.col(table.day_of))
                known = split.valid.select(day.alias("day")).filter(F.col("day").isin(table.stored_days()))
                days = [row.day for row in known.distinct().collect()]
            stored = table.read(without=(writer, batch_id), days=days)
        else:
            if not indexed:
                _index_stored(table, keys, writer, batch_id)
            stored = keys.among(split.valid, without=(writer, batch_id))
        fresh = with_alert_defaults(insert_ignore(split.valid, stored, arrival), clock)
        with held(fresh):
            _append_numbered(fresh, ["timestamp", "alert_id"], table, batch_id, writer, serial)
            if indexed or not ids_carry_time:
                keys.add(fresh, batch_id, writer)


def known_keys(table: BatchTable) -> KeyIndex:
    """The alert ids that a table holds, by hash bucket."""
    return KeyIndex(table.spark, f"{table.path}-keys")


def _index_stored(table: BatchTable, keys: KeyIndex, writer: str, batch_id: int) -> None:
    """Starts the index of a table that may hold rows already; its one full read."""
    keys.add(table.read(without=(writer, batch_id)).select("alert_id"), -1, "before")


def store_aggregates(
    rows: DataFrame,
    batch_id: int,
    table: BatchTable,
    writer: str = "aggregates",
    clock: Clock = None,
    serial: bool = True,
) -> None:
    """Plain append of one batch of windows; a replay replaces the batch.

    Windows that lack a required value go to ``rejected_table``, as a NOT NULL
    column demands.
    """
    with held(rows):
        split = split_storable(rows, AGGREGATE_REQUIRED, AGGREGATE_LENGTHS)
        rejected_table(table).append(split.rejected, batch_id, writer)
        stamped = split.valid.withColumn("created_at", at(clock))
        _append_numbered(stamped, ["window_start", "sensor_id", "vehicle_id"], table, batch_id, writer, serial)


_ID_RECORD = T.StructType([T.StructField(n, T.LongType()) for n in ("_batch", "start", "last")])


def _append_numbered(
    rows: DataFrame, order: list[str], table: BatchTable, batch_id: int, writer: str, serial: bool
) -> None:
    """Appends a batch, with serial ids if wanted.

    A record keeps the ids that a batch took. A writer has two records, of its
    newest batch and the one before: the next batch goes on from the highest
    of them, and a replay starts from its own, so its rows keep their ids.
    Neither the table nor older records are read. One writer numbers at a time.
    """
    if not serial:
        table.append(rows.withColumn("id", F.lit(None).cast("bigint")), batch_id, writer)
        return
    records = BatchTable(table.spark, f"{table.path}-ids", _ID_RECORD)
    slot = batch_id % 2
    known = records.layout.read()
    taken = [] if known is None else known.select("writer", "_batch", "start", "last").collect()
    own = [r.start for r in taken if (r.writer, r._batch) == (writer, batch_id)]
    start = own[0] if own else max((r.last for r in taken), default=0)
    numbered = with_serial_id(rows, order, start=start)
    record = numbered.agg(F.lit(start).alias("start"), F.coalesce(F.max("id"), F.lit(start)).alias("last"))
    records.append(record.withColumn("_batch", F.lit(batch_id)), slot, writer)
    table.append(numbered, batch_id, writer, clustered=True)


def fan_out(
    alerts: DataFrame,
    batch_id: int,
    table: BatchTable,
    publish: Publish,
    arrival: tuple[str, ...],
    writer: str = "main",
    clock: Clock = None,
    ids_carry_time: bool = False,
    serial: bool = True,
) -> None:
    """One batch of alerts to the table first, then to the topic.

    The topic gets every alert, repeats included; readers go by ``alert_id``.
    """
    with held(alerts):
        store_alerts(alerts, batch_id, table, arrival, writer, clock, ids_carry_time, serial)
        publish(alerts.select([name for name in (*ALERT_COLUMNS, "processed_at") if name in alerts.columns]), batch_id)


def start_alerts(
    readings: DataFrame,
    rule_set: RuleSet,
    table: BatchTable,
    publish: Publish,
    checkpoint: str,
    arrival: tuple[str, ...],
    trigger: dict = AVAILABLE_NOW,
    writer: str = "alerts",
    clock: Clock = None,
    serial: bool = False,
    stamp: bool = False,
) -> StreamingQuery:
    """Readings stream to alerts, stored and published.

    ``arrival`` names columns of the readings that say which came first. Serial
    ids are off here and ``alert_id`` is the key. ``stamp`` publishes
    ``processed_at`` as well.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        fan_out(batch, batch_id, table, publish, arrival, writer, clock, ids_carry_time=True, serial=serial)

    return _start(apply_rules(readings, rule_set, clock, stamp, carry=arrival), write, checkpoint, trigger)


def start_json_alerts(
    messages: DataFrame,
    rule_set: RuleSet,
    table: BatchTable,
    publish: Publish,
    checkpoint: str,
    arrival: tuple[str, ...],
    judge: Judge = parse.judge_tolerant,
    trigger: dict = AVAILABLE_NOW,
    writer: str = "alerts",
    clock: Clock = None,
    stamp: bool = False,
) -> StreamingQuery:
    """Topic messages to alerts, stored and published.

    What cannot be read, or names no sensor, vehicle or time, goes to ``quarantine_table``.
    """

    def store(readings: DataFrame, batch_id: int) -> None:
        alerts = apply_rules(readings, rule_set, clock, stamp, carry=arrival)
        fan_out(alerts, batch_id, table, publish, arrival, writer, clock, ids_carry_time=True, serial=False)

    return _start_judged(messages, parse.keyed(judge), store, quarantine_table(table), checkpoint, trigger, writer)


def start_json_windows(
    messages: DataFrame,
    table: BatchTable,
    checkpoint: str,
    judge: Judge = parse.judge_strict,
    trigger: dict = AVAILABLE_NOW,
    writer: str = "aggregates",
    exact_scale: int | None = None,
    clock: Clock = None,
) -> StreamingQuery:
    """Topic messages to closed windows by event time.

    A stateful stream has one output: ``start_quarantine`` keeps the messages
    that cannot be read.
    """
    readings = parse.with_event_time(parse.split(judge(messages)).valid)
    return start_aggregates(readings, table, checkpoint, trigger, writer, exact_scale=exact_scale, clock=clock)


def start_quarantine(
    messages: DataFrame,
    table: BatchTable,
    checkpoint: str,
    judge: Judge = parse.judge_strict,
    trigger: dict = AVAILABLE_NOW,
    writer: str = "quarantine",
) -> StreamingQuery:
    """Messages that cannot be read, or have no time, to ``quarantine_table`` of the table they were meant for."""
    timed = parse.keyed(judge, ("ts_ms",))
    return start_append(parse.split(timed(messages)).quarantine, quarantine_table(table), checkpoint, trigger, writer)


def store_distinct(
    alerts: DataFrame, batch_id: int, table: BatchTable, arrival: tuple[str, ...], writer: str = "distinct"
) -> None:
    """Insert-ignore of one batch by alert id, however late an alert is; without an id it is refused.

    Only the key buckets that the batch's ids fall into are opened.
    """
    with held(alerts):
        keys = known_keys(table)
        if not keys.exists():
            _index_stored(table, keys, writer, batch_id)
        fresh = insert_ignore(alerts, keys.among(alerts, without=(writer, batch_id)), arrival)
        with held(fresh):
            table.append(fresh, batch_id, writer)
            keys.add(fresh, batch_id, writer)


def start_distinct(
    alerts: DataFrame,
    table: BatchTable,
    checkpoint: str,
    arrival: tuple[str, ...],
    trigger: dict = AVAILABLE_NOW,
    writer: str = "distinct",
) -> StreamingQuery:
    """Alerts stream to a table that holds each alert id once. No lateness limit."""
    return _start(
        alerts, lambda batch, batch_id: store_distinct(batch, batch_id, table, arrival, writer), checkpoint, trigger
    )


def start_append(
    rows: DataFrame, table: BatchTable, checkpoint: str, trigger: dict = AVAILABLE_NOW, writer: str = "main"
) -> StreamingQuery:
    """Any append-mode stream to a table."""
    return _start(rows, lambda batch, batch_id: table.append(batch, batch_id, writer), checkpoint, trigger)


def start_aggregates(
    readings: DataFrame,
    table: BatchTable,
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
    writer: str = "aggregates",
    time_col: str = "ts",
    length: str = WINDOW,
    delay: str = WATERMARK_DELAY,
    exact_scale: int | None = None,
    clock: Clock = None,
) -> StreamingQuery:
    """Readings stream to closed windows, each written once."""
    closed = tumbling_aggregates(with_watermark(readings, time_col, delay), time_col, length, exact_scale)

    def write(batch: DataFrame, batch_id: int) -> None:
        store_aggregates(batch, batch_id, table, writer, clock, serial=False)

    return _start(closed, write, checkpoint, trigger)


def start_clock_windows(
    readings: DataFrame,
    ticks: DataFrame,
    table: BatchTable,
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
    writer: str = "aggregates",
    time_col: str | None = None,
    length: str = WINDOW,
    exact_scale: int | None = None,
    clock: Clock = None,
) -> StreamingQuery:
    """Readings stream to windows by arrival, closed by the clock; a quiet sensor's last window is written too.

    ``ticks`` is ``sources.clock.clock_ticks`` in a running job. Without
    ``time_col`` readings are stamped as they arrive.
    """
    stamped = with_ingest_time(readings) if time_col is None else readings
    closed = clock_windows(stamped, ticks, time_col or "ingest_ts", length, exact_scale)

    def write(batch: DataFrame, batch_id: int) -> None:
        store_aggregates(batch, batch_id, table, writer, clock, serial=False)

    return _start(closed, write, checkpoint, trigger)


def start_latest(
    rows: DataFrame, table: BucketTable, checkpoint: str, ties: list[str], trigger: dict = AVAILABLE_NOW
) -> StreamingQuery:
    """Keeps the newest rows of every vehicle; a batch rewrites only the buckets of its vehicles.

    Each batch is cut to the newest rows of a vehicle before it meets them.
    """

    def write(batch: DataFrame, _: int) -> None:
        with held(latest_per_vehicle(batch, ties).drop("rank")) as newest:
            table.update(newest, newest_rows(ties))

    return _start(rows, write, checkpoint, trigger)


def start_notifications(
    messages: DataFrame,
    read_vehicles: Callable[[], DataFrame],
    outbox: BatchTable,
    checkpoint: str,
    trigger: dict = AVAILABLE_NOW,
    writer: str = "notifier",
) -> StreamingQuery:
    """Alert topic to the outbox; contacts are read anew for every batch."""

    def store(alerts: DataFrame, batch_id: int) -> None:
        outbox.append(notifications(alerts, read_vehicles()), batch_id, writer)

    return _start_judged(
        messages, parse.judge_alert_messages, store, quarantine_table(outbox), checkpoint, trigger, writer
    )


def start_ingest(
    messages: DataFrame, table: BatchTable, checkpoint: str, trigger: dict = AVAILABLE_NOW, writer: str = "ingest"
) -> StreamingQuery:
    """Ingest topic to its table."""

    def store(rows: DataFrame, batch_id: int) -> None:
        table.append(rows, batch_id, writer)

    return _start_judged(messages, parse.judge_tire_data, store, quarantine_table(table), checkpoint, trigger, writer)


def start_tail(messages: DataFrame, checkpoint: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Prints a topic as it arrives."""
    return (
        messages.writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


class LateRows(StreamingQueryListener):
    """Rows dropped behind the watermark, by query id, over the whole life of the queries.

    Register it with ``spark.streams.addListener`` before the queries start.
    """

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        rows = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        self.dropped[str(event.progress.id)] += rows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark in the query's kept progress reports (the newest ones of a long job)."""
    return sum(
        int(operator["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def _start_judged(
    messages: DataFrame,
    judge: Judge,
    store: Callable[[DataFrame, int], None],
    quarantine: BatchTable,
    checkpoint: str,
    trigger: dict,
    writer: str,
) -> StreamingQuery:
    """Each batch is parsed once and parted: unreadable messages to the quarantine, the rest to ``store``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with held(judge(batch)) as judged:
            parts = parse.split(judged)
            quarantine.append(parts.quarantine, batch_id, writer)
            store(parts.valid, batch_id)

    return _start(messages, write, checkpoint, trigger)


def _start(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict
) -> StreamingQuery:
    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
