"""Owner and driver notifications.

Contacts are unique per vehicle. They are broadcast only if their measured
size allows; otherwise a hot vehicle's alerts are split over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.text import iso_timestamp, or_none_text
from fleetpulse.operators.lookup import lookup_join

# Message layout.
INDENT = " " * 8
HEADING = "TIRE ALERT NOTIFICATION"
RULER = "======================="
FOOTER = "Please check the dashboard for more details."


def contactable(vehicles: DataFrame) -> DataFrame:
    """Vehicles with an owner address."""
    return vehicles.filter(F.col("owner_email").isNotNull() & (F.col("owner_email") != ""))


def recipients(owner: Column, driver: Column) -> Column:
    """Distinct owner and driver addresses in sorted order."""
    return F.when(driver.isNull() | (owner == driver), F.array(owner)).otherwise(
        F.array(F.least(owner, driver), F.greatest(owner, driver))
    )


def subject() -> Column:
    return F.concat(
        F.lit("["),
        or_none_text(F.col("severity")),
        F.lit("] Tire Alert for Vehicle "),
        or_none_text(F.col("vehicle_id")),
        F.lit(": "),
        or_none_text(F.col("alert_type")),
    )


def body(time_text: Column) -> Column:
    lines = [
        F.lit(HEADING),
        F.lit(RULER),
        F.lit(""),
        F.concat(F.lit("Vehicle ID: "), or_none_text(F.col("vehicle_id"))),
        F.concat(F.lit("Alert Type: "), or_none_text(F.col("alert_type"))),
        F.concat(F.lit("Severity:   "), or_none_text(F.col("severity"))),
        F.concat(F.lit("Time:       "), or_none_text(time_text)),
        F.lit(""),
        F.lit("Description:"),
        or_none_text(F.col("description")),
        F.lit(""),
        F.lit(FOOTER),
        F.lit(""),
    ]
    return F.concat_ws("\n", F.lit(""), *[F.concat(F.lit(INDENT), line) for line in lines])


def notifications(alerts: DataFrame, vehicles: DataFrame, **sizes: int) -> DataFrame:
    """One message per alert of a vehicle that has contacts.

    ``timestamp`` may be a timestamp or the ISO text of an alert message.
    ``sizes`` overrides the limits of the lookup join.
    """
    time_text = F.col("timestamp")
    if dict(alerts.dtypes)["timestamp"] != "string":
        time_text = iso_timestamp(time_text)
    contacts = contactable(vehicles).select("vehicle_id", "owner_email", "driver_email")
    return lookup_join(alerts, contacts, "vehicle_id", "alert_id", **sizes).select(
        "alert_id",
        "vehicle_id",
        recipients(F.col("owner_email"), F.col("driver_email")).alias("recipients"),
        subject().alias("subject"),
        body(time_text).alias("body"),
    )


def unroutable(alerts: DataFrame, vehicles: DataFrame, **sizes: int) -> DataFrame:
    """Alerts whose vehicle is unknown or has no owner address."""
    known = contactable(vehicles).select("vehicle_id")
    return lookup_join(alerts, known, "vehicle_id", "alert_id", how="left_anti", **sizes)
