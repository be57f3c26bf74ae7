"""One-minute tumbling aggregates per sensor.

The group key holds the window, and Spark pre-aggregates on the map side, so a
sensor with a third of all rows ships at most one row per window and task. One
shuffle in all; the same function runs on a batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Window length, its label, and the watermark delay.
WINDOW = "1 minute"
WINDOW_LABEL = "1m"
WATERMARK_DELAY = "5 seconds"

_UNIT_LETTERS = {"second": "s", "minute": "m", "hour": "h", "day": "d"}


def window_label(length: str) -> str:
    """``1 minute`` -> ``1m``."""
    count, unit = length.split()
    return f"{count}{_UNIT_LETTERS[unit.rstrip('s')]}"


def tumbling_aggregates(
    readings: DataFrame,
    time_col: str = "ts",
    length: str = WINDOW,
    exact_scale: int | None = None,
    counted: Column | None = None,
) -> DataFrame:
    """Average, minimum, maximum of both measures and the row count.

    NULL and NaN measures are skipped; ``record_count`` counts every row.
    A plain average of doubles depends on the order of addition. When the
    measures carry a known number of decimals, ``exact_scale`` sums them as
    integers instead: the same result for any partitioning or batch split.
    ``counted`` is null for rows that are no readings.
    """
    p, t = (F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("pressure_kpa", "temperature_c"))
    grouped = readings.filter(F.col(time_col).isNotNull()).groupBy(
        "sensor_id", "vehicle_id", F.window(time_col, length).alias("_w")
    )
    return grouped.agg(
        _mean(p, exact_scale).alias("avg_pressure"),
        _mean(t, exact_scale).alias("avg_temperature"),
        F.min(p).alias("min_pressure"),
        F.max(p).alias("max_pressure"),
        F.min(t).alias("min_temperature"),
        F.max(t).alias("max_temperature"),
        F.count(F.lit(1) if counted is None else counted).alias("record_count"),
    ).select(
        "sensor_id",
        "vehicle_id",
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        F.lit(window_label(length)).alias("window_size"),
        "avg_pressure",
        "avg_temperature",
        "min_pressure",
        "max_pressure",
        "min_temperature",
        "max_temperature",
        "record_count",
    )


def with_watermark(readings: DataFrame, time_col: str = "ts", delay: str = WATERMARK_DELAY) -> DataFrame:
    """Bounded lateness; on a stream, later rows are dropped."""
    return readings.withWatermark(time_col, delay)


def with_ingest_time(readings: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """Arrival stamp, for windows by processing time."""
    return readings.withColumn(name, F.current_timestamp())


def clock_windows(
    readings: DataFrame, ticks: DataFrame, time_col: str = "ingest_ts", length: str = WINDOW, exact_scale: int | None = None
) -> DataFrame:
    """Windows by arrival time that the clock closes, though no reading follows.

    The watermark stands behind the union of readings and ``ticks`` (one column
    ``tick``), so a tick moves it as an arrival does. Ticks go through the
    aggregation, as a filter before it would be pushed below the watermark:
    one group a window, which counts no reading and is left out. A reading must
    not arrive with a time before a tick that was read earlier.
    """
    marked = readings.withColumn("_tick", F.lit(False))
    clock = ticks.select(F.col("tick").alias(time_col), F.lit(True).alias("_tick"))
    both = marked.unionByName(clock, allowMissingColumns=True).withWatermark(time_col, "0 seconds")
    windows = tumbling_aggregates(both, time_col, length, exact_scale, counted=F.when(~F.col("_tick"), 1))
    return windows.filter("record_count > 0")


def _mean(measure: Column, exact_scale: int | None) -> Column:
    if exact_scale is None:
        return F.avg(measure)
    unit = 10**exact_scale
    units = F.round(measure * F.lit(float(unit))).try_cast("bigint")
    return F.sum(units).cast("double") / F.lit(float(unit)) / F.count(units)
