"""Declared schemas. Nothing in the library infers one."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _DBL, _LONG, _TS, _BOOL = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Message on the raw topic. Epoch milliseconds travel as a JSON number, which
# may be written with an exponent, so it is parsed as a double first.
RAW_STRICT = _struct(
    ("sensor_id", _STR),
    ("vehicle_id", _STR),
    ("timestamp", _DBL),
    ("pressure_kpa", _DBL),
    ("temperature_c", _DBL),
    ("battery_voltage", _DBL),
)

# Same message with measures kept as text, for numeric strings.
RAW_TOLERANT = _struct(
    ("sensor_id", _STR),
    ("vehicle_id", _STR),
    ("timestamp", _DBL),
    ("pressure_kpa", _STR),
    ("temperature_c", _STR),
    ("battery_voltage", _STR),
)

REQUIRED_FIELDS = ("sensor_id", "vehicle_id", "timestamp", "pressure_kpa", "temperature_c")

READING = _struct(
    ("sensor_id", _STR),
    ("vehicle_id", _STR),
    ("ts_ms", _LONG),
    ("pressure_kpa", _DBL),
    ("temperature_c", _DBL),
    ("battery_voltage", _DBL),
)

LEGACY_READING = _struct(
    ("vehicle_id", _STR),
    ("tire_position", _STR),
    ("pressure_psi", _DBL),
    ("temperature_c", _DBL),
    ("timestamp", _LONG),
)

ALERT = _struct(
    ("alert_id", _STR),
    ("sensor_id", _STR),
    ("vehicle_id", _STR),
    ("timestamp", _TS),
    ("alert_type", _STR),
    ("severity", _STR),
    ("description", _STR),
    ("triggering_value", _DBL),
)

# Alert row as stored: the columns the table fills in by default come last.
STORED_ALERT = T.StructType(
    [T.StructField("id", _LONG), *ALERT.fields, T.StructField("is_resolved", _BOOL), T.StructField("created_at", _TS)]
)

# Alert message on the alert topic; the time is ISO-8601 text.
ALERT_MESSAGE = T.StructType(
    [T.StructField(f.name, _STR if f.name == "timestamp" else f.dataType) for f in ALERT.fields]
)

AGGREGATE = _struct(
    ("sensor_id", _STR),
    ("vehicle_id", _STR),
    ("window_start", _TS),
    ("window_end", _TS),
    ("window_size", _STR),
    ("avg_pressure", _DBL),
    ("avg_temperature", _DBL),
    ("min_pressure", _DBL),
    ("max_pressure", _DBL),
    ("min_temperature", _DBL),
    ("max_temperature", _DBL),
    ("record_count", _LONG),
)

STORED_AGGREGATE = T.StructType([T.StructField("id", _LONG), *AGGREGATE.fields, T.StructField("created_at", _TS)])

VEHICLE = _struct(("vehicle_id", _STR), ("owner_email", _STR), ("driver_email", _STR), ("created_at", _TS))

METRIC = _struct(("vehicle_id", _STR), ("sensor_id", _STR), ("timestamp", _TS), ("pressure_kpa", _DBL), ("temperature_c", _DBL))

TIRE_DATA = _struct(("tire_id", _STR), ("pressure", _DBL), ("temperature", _DBL), ("timestamp", _TS))

# Ingest message: the epoch-seconds time may be a number or text.
TIRE_DATA_MESSAGE = _struct(("tire_id", _STR), ("pressure", _DBL), ("temperature", _DBL), ("timestamp", _STR))

NOTIFICATION = T.StructType(
    [
        T.StructField("alert_id", _STR),
        T.StructField("vehicle_id", _STR),
        T.StructField("recipients", T.ArrayType(_STR)),
        T.StructField("subject", _STR),
        T.StructField("body", _STR),
    ]
)

# Messages that could not be read.
QUARANTINE = _struct(("value", _STR), ("reason", _STR))

TOPIC = _struct(("key", _STR), ("value", _STR))
