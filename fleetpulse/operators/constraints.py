"""Table constraints as splits and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text lengths the tables allow.
ALERT_LENGTHS = {"alert_id": 255, "sensor_id": 100, "vehicle_id": 100, "alert_type": 50, "severity": 20}
AGGREGATE_LENGTHS = {"sensor_id": 100, "vehicle_id": 100, "window_size": 10}
VEHICLE_LENGTHS = {"vehicle_id": 100, "owner_email": 255, "driver_email": 255}

# Columns that must hold a value.
ALERT_REQUIRED = ("alert_id", "sensor_id", "vehicle_id", "timestamp", "alert_type", "severity")
AGGREGATE_REQUIRED = (
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
)


@dataclass(frozen=True)
class Split:
    """Rows a table takes, and the rest with the columns at fault."""

    valid: DataFrame
    rejected: DataFrame


def split_storable(rows: DataFrame, required: Sequence[str], lengths: Mapping[str, int] | None = None) -> Split:
    """Rows with every required value, and texts no longer than allowed."""
    faults = [f"CASE WHEN `{name}` IS NULL THEN '{name} is null' END" for name in required]
    for name, limit in (lengths or {}).items():
        faults.append(f"CASE WHEN length(`{name}`) > {limit} THEN '{name} is longer than {limit}' END")
    judged = rows.withColumn("reason", F.expr(f"concat_ws('; ', {', '.join(faults)})"))
    return Split(valid=judged.filter("reason = ''").drop("reason"), rejected=judged.filter("reason <> ''"))


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
