"""Small hand-made inputs."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

START = datetime(2024, 1, 1)
START_MS = 1_704_067_200_000


def readings(spark, rows):
    """(sensor, second, pressure, temperature) -> readings with event time."""
    data = [(s, s.split("-")[0], START_MS + int(sec * 1000), p, t) for s, sec, p, t in rows]
    schema = "sensor_id string, vehicle_id string, ts_ms long, pressure_kpa double, temperature_c double"
    return spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_millis("ts_ms"))


def alerts(spark, rows):
    """(alert_id, vehicle, second, severity) -> alerts."""
    data = [(a, f"{v}-FL", v, START + timedelta(seconds=s), "LOW_PRESSURE", sev, "d", 1.0) for a, v, s, sev in rows]
    schema = (
        "alert_id string, sensor_id string, vehicle_id string, timestamp timestamp, alert_type string, "
        "severity string, description string, triggering_value double"
    )
    return spark.createDataFrame(data, schema)


def vehicles(spark, rows):
    """(vehicle, owner, driver) -> contacts."""
    frame = spark.createDataFrame(rows, "vehicle_id string, owner_email string, driver_email string")
    return frame.withColumn("created_at", F.lit(START).cast("timestamp"))


def write_ordered(frames, folder):
    """One file per frame, with increasing modification times."""
    import os
    import shutil
    from pathlib import Path

    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    for n, frame in enumerate(frames):
        part = folder.parent / f"{folder.name}-part-{n}"
        frame.coalesce(1).write.parquet(str(part))
        source = next(part.glob("*.parquet"))
        target = folder / f"{n:04d}.parquet"
        shutil.copy(source, target)
        os.utime(target, (1_000_000 + n * 10, 1_000_000 + n * 10))
    return str(folder)
