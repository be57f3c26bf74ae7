"""Read-side questions: latest rows, views, summaries, panels.

Every notion of "now" is an argument. Single-row results are combined by
scalar subqueries, top-k uses Spark's own top-k plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions.times import Clock, at, before

# Default page sizes and the severities the summary counts.
LATEST_LIMIT = 20
PER_VEHICLE_LIMIT = 10
CRITICAL, WARNING = "CRITICAL", "WARNING"

ALERT_COLUMNS = [
    "alert_id",
    "sensor_id",
    "vehicle_id",
    "timestamp",
    "alert_type",
    "severity",
    "description",
    "triggering_value",
]
AGGREGATE_COLUMNS = [
    "sensor_id",
    "vehicle_id",
    "window_start",
    "window_end",
    "window_size",
    "avg_pressure",
    "avg_temperature",
    "min_pressure",
    "max_pressure",
    "min_temperature",
    "max_temperature",
    "record_count",
]
ALERT_TIES = ["alert_id"]
AGGREGATE_TIES = ["sensor_id", "vehicle_id"]


def latest_alerts(alerts: DataFrame, limit: int = LATEST_LIMIT) -> DataFrame:
    """Newest alerts first, ties by alert id."""
    return alerts.orderBy(F.desc("timestamp"), *ALERT_TIES).limit(limit)


def latest_aggregations(aggregates: DataFrame, limit: int = LATEST_LIMIT) -> DataFrame:
    """Newest windows first, ties by sensor and vehicle."""
    return aggregates.orderBy(F.desc("window_end"), *AGGREGATE_TIES).limit(limit)


def alert_response(alerts: DataFrame) -> DataFrame:
    """Stored alerts in the order of the response contract."""
    return alerts.select(*ALERT_COLUMNS, "id", "is_resolved", "created_at")


def aggregate_response(aggregates: DataFrame) -> DataFrame:
    """Stored aggregates in the order of the response contract."""
    return aggregates.select(*AGGREGATE_COLUMNS, "id", "created_at")


def latest_of_vehicle(rows: DataFrame, vehicle_id: str, ties: list[str], limit: int = PER_VEHICLE_LIMIT) -> DataFrame:
    """Newest rows of one vehicle."""
    return rows.filter(F.col("vehicle_id") == vehicle_id).orderBy(F.desc("timestamp"), *ties).limit(limit)


def latest_per_vehicle(rows: DataFrame, ties: list[str], limit: int = PER_VEHICLE_LIMIT) -> DataFrame:
    """Newest rows of every vehicle.

    Spark limits each group before the shuffle (WindowGroupLimit), so a hot
    vehicle sends ``limit`` rows per task, not its whole history.
    """
    newest = Window.partitionBy("vehicle_id").orderBy(F.desc("timestamp"), *ties)
    return rows.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= limit)


def newest_rows(ties: list[str], limit: int = PER_VEHICLE_LIMIT):
    """A merge of stored newest rows with a batch, for ``BucketTable.update``: the newest of both, each row once.

    Late rows find their place, and a replayed batch changes nothing.
    """

    def merged(existing: DataFrame, batch: DataFrame) -> DataFrame:
        both = existing.unionByName(batch.select(*existing.columns)).dropDuplicates(["vehicle_id", "timestamp", *ties])
        return latest_per_vehicle(both, ties, limit).drop("rank")

    return merged


def unresolved(alerts: DataFrame) -> DataFrame:
    """Open alerts; an unknown flag is not open."""
    return alerts.filter(~F.col("is_resolved"))


def current_alerts(alerts: DataFrame) -> DataFrame:
    """View: open alerts, newest first."""
    return unresolved(alerts).orderBy(F.desc("timestamp"), *ALERT_TIES)


def recent_aggregations(aggregates: DataFrame, as_of: Clock, interval: str = "1 hour") -> DataFrame:
    """View: windows that started within the interval, newest first."""
    return aggregates.filter(F.col("window_start") >= before(as_of, interval)).orderBy(
        F.desc("window_start"), *AGGREGATE_TIES
    )


def dashboard_summary(
    alerts: DataFrame, aggregates: DataFrame, clock: Clock = None, active_since: Clock = None
) -> DataFrame:
    """One row: alert totals and the number of vehicles with aggregates.

    Without ``active_since`` vehicles of all history count.
    """
    active = aggregates
    if active_since is not None:
        active = active.filter(F.col("window_start") >= at(active_since))
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts_history"),
        _count_severity(CRITICAL).alias("critical_alerts_total"),
        _count_severity(WARNING).alias("warning_alerts_total"),
    ).select(
        "total_alerts_history",
        active_vehicles(active).scalar().alias("active_vehicles_24h"),
        "critical_alerts_total",
        "warning_alerts_total",
        at(clock).alias("last_updated"),
    )


def severity_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per severity actually present."""
    return alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("alerts"))


def active_vehicles(rows: DataFrame) -> DataFrame:
    """Exact number of distinct vehicles."""
    return rows.agg(F.count_distinct("vehicle_id").alias("active_vehicles"))


def table_counts(alerts: DataFrame, aggregates: DataFrame, as_int: bool = False) -> DataFrame:
    """Row counts of both tables, one row; ``as_int`` for tables that never pass 2^31 - 1 rows."""
    kind = "int" if as_int else "bigint"
    return alerts.agg(F.count(F.lit(1)).cast(kind).alias("alert_count")).select(
        "alert_count",
        aggregates.agg(F.count(F.lit(1)).cast(kind)).scalar().alias("agg_count"),
    )


def high_alerts_since(alerts: DataFrame, as_of: Clock, interval: str = "1 hour") -> DataFrame:
    """HIGH alerts created within the interval, and whether to raise the alarm."""
    recent = alerts.filter((F.col("severity") == "HIGH") & (F.col("created_at") > before(as_of, interval)))
    return recent.agg(F.count(F.lit(1)).alias("high_alerts")).withColumn("raise_alert", F.col("high_alerts") > 0)


def alert_distribution(alerts: DataFrame) -> DataFrame:
    """Alerts per type."""
    return alerts.groupBy("alert_type").agg(F.count(F.lit(1)).alias("alerts"))


def panel_series(aggregates: DataFrame, sensor_id: str | None = None) -> DataFrame:
    """Pressure and temperature over time, per sensor, ready to draw."""
    chosen = aggregates if sensor_id is None else aggregates.filter(F.col("sensor_id") == sensor_id)
    return chosen.select(
        F.col("window_start").alias("time"), "sensor_id", "vehicle_id", "avg_pressure", "avg_temperature"
    ).orderBy("time", *AGGREGATE_TIES)


def newest(rows: DataFrame, time_col: str) -> Column:
    """Latest time in the rows, as a scalar subquery usable as ``as_of``."""
    return rows.agg(F.max(time_col)).scalar()


def _count_severity(name: str) -> Column:
    return F.count_if(F.col("severity") == name)
