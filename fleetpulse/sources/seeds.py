"""Sample rows for empty tables, with times relative to a clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions import schemas
from fleetpulse.functions.times import Clock, before

# The sample alerts; how long before the clock each was raised.
_ALERTS = [
    ("sample_alert_1", "V001-FL", "V001", "10 minutes", "LOW_PRESSURE", "HIGH",
     "Pressure 175.5 kPa is below threshold 180 kPa", 175.5),
    ("sample_alert_2", "V002-RR", "V002", "5 minutes", "HIGH_TEMPERATURE", "MEDIUM",
     "Temperature 82.3°C is above threshold 80°C", 82.3),
]
_VEHICLES = 5


def seed_alerts(spark: SparkSession, clock: Clock = None) -> DataFrame:
    """Two sample alerts."""
    names = [*schemas.ALERT.names]
    rows = spark.createDataFrame([(a[0], a[1], a[2], a[3], *a[4:]) for a in _ALERTS], names)
    raised = F.coalesce(*[F.when(F.col("timestamp") == a[3], before(clock, a[3])) for a in _ALERTS])
    return rows.withColumn("timestamp", raised)


def seed_vehicles(spark: SparkSession) -> DataFrame:
    """Contacts of the first vehicles."""
    return spark.range(1, _VEHICLES + 1).selectExpr(
        "concat('V', lpad(CAST(id AS STRING), 3, '0')) AS vehicle_id",
        "concat('owner', id, '@example.com') AS owner_email",
        "concat('driver', id, '@example.com') AS driver_email",
    )
