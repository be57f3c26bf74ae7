"""JSON messages to readings, with a quarantine for what cannot be read.

A message is wrapped in brackets and parsed as an array of one object. That
reads the whole text: anything after the closing brace makes it malformed.
The parse sits in a generator, which filters cannot be pushed through, so it
runs once per message however many columns and conditions use its result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions import schemas
from fleetpulse.functions.times import event_time, from_epoch_seconds, parse_timestamp_text

_STRICT_JSON = {"allowSingleQuotes": "false"}

_QUOTED_WORDS = ('"NaN"', '"Infinity"', '"-Infinity"')

READING_KEYS = ("sensor_id", "vehicle_id", "ts_ms")
MALFORMED = "malformed"
MISSING_FIELD = "missing_field"
BAD_VALUE = "bad_value"


@dataclass(frozen=True)
class Parsed:
    """Readable rows, and the rest as ``value`` plus ``reason``."""

    valid: DataFrame
    quarantine: DataFrame


def with_object(
    messages: DataFrame, value: str, schema: T.StructType, convert: Callable[[Column], list[Column]] | None = None
) -> DataFrame:
    """Adds the fields of the single JSON object in ``value`` as columns.

    ``_object`` is true where there is one, and NULL, like the fields, where
    there is not. ``convert`` maps the parsed struct to the wanted columns.
    """
    parsed = F.from_json(_bracketed(F.col(value)), T.ArrayType(schema), _STRICT_JSON)

    def fields(items: Column) -> Column:
        o = F.get(items, F.lit(0))
        columns = convert(o) if convert else [o.getField(name).alias(name) for name in schema.names]
        return F.when((F.size(items) == 1) & o.isNotNull(), F.struct(F.lit(True).alias("_object"), *columns))

    return messages.select("*", F.inline(F.transform(F.array(parsed), fields)))


def json_fields(value: Column) -> Column:
    """The object's fields as text, present-but-null ones included."""
    return _only(F.from_json(_bracketed(value), T.ArrayType(T.MapType(T.StringType(), T.StringType())), _STRICT_JSON))


def has_fields(value: Column, names: Iterable[str]) -> Column:
    """True if every name is a key of the object; NULL if it is no object."""
    wanted = [F.lit(name) for name in names]
    return F.size(F.array_intersect(F.map_keys(json_fields(value)), F.array(*wanted))) == len(wanted)


def judge_strict(messages: DataFrame, value: str = "value") -> DataFrame:
    """Every message with its reading, and the reason why it is not one (NULL if it is).

    A reading has the five required keys; a null or non-numeric measure passes
    as NULL. Keys are listed (a second parse) only for messages in which some
    required field came out NULL.
    """
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in schemas.REQUIRED_FIELDS])
    named = F.coalesce(has_fields(F.col(value), schemas.REQUIRED_FIELDS), F.lit(False))
    reason = F.when(complete, F.lit(None)).when(F.col("_object").isNull(), MALFORMED).when(~named, MISSING_FIELD)
    return _judged(messages, value, with_object(messages, value, schemas.RAW_STRICT), reason, _reading_columns())


def judge_tolerant(messages: DataFrame, value: str = "value") -> DataFrame:
    """As ``judge_strict``, but a reading has numbers or numeric text as measures."""
    readable = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in schemas.REQUIRED_FIELDS])
    reason = F.when(F.col("_object").isNull(), MALFORMED).when(~readable, BAD_VALUE)
    staged = with_object(messages, value, schemas.RAW_TOLERANT, convert=_tolerant)
    return _judged(messages, value, staged, reason, _reading_columns())


def judge_tire_data(messages: DataFrame, value: str = "value") -> DataFrame:
    """Ingest messages (epoch-seconds time, number or text), judged."""
    staged = with_object(messages, value, schemas.TIRE_DATA_MESSAGE).withColumn(
        "timestamp", from_epoch_seconds(F.col("timestamp"))
    )
    usable = F.col("tire_id").isNotNull() & F.col("timestamp").isNotNull()
    reason = F.when(F.col("_object").isNull(), MALFORMED).when(~usable, BAD_VALUE)
    return _judged(messages, value, staged, reason, schemas.TIRE_DATA_MESSAGE.names)


def keyed(judge: Callable[[DataFrame], DataFrame], names: Sequence[str] = READING_KEYS) -> Callable[[DataFrame], DataFrame]:
    """The judge, refusing readings that lack a key as well, so that no later step drops them in silence."""

    def judged(messages: DataFrame) -> DataFrame:
        rows = judge(messages)
        lacking = F.expr(" OR ".join(f"{name} IS NULL" for name in names))
        return rows.withColumn("reason", F.coalesce(F.col("reason"), F.when(lacking, F.lit(f"no {' or '.join(names)}"))))

    return judged


def judge_alert_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Alert topic messages, judged; the time stays the text that was published."""
    reason = F.when(F.col("_object").isNull(), MALFORMED)
    staged = with_object(messages, value, schemas.ALERT_MESSAGE)
    return _judged(messages, value, staged, reason, schemas.ALERT_MESSAGE.names)


def split(judged: DataFrame) -> Parsed:
    """Judged messages as readable rows and a quarantine that keeps the columns carried along."""
    carried = judged.columns[: judged.columns.index("value")]
    return Parsed(
        valid=judged.filter("reason IS NULL").drop("value", "reason"),
        quarantine=judged.filter("reason IS NOT NULL").select(*carried, "value", "reason"),
    )


def parse_strict(messages: DataFrame, value: str = "value") -> Parsed:
    """Readings whose five required keys are present."""
    return split(judge_strict(messages, value))


def parse_tolerant(messages: DataFrame, value: str = "value") -> Parsed:
    """Readings whose measures are numbers or numeric text."""
    return split(judge_tolerant(messages, value))


def parse_sql_table(messages: DataFrame, value: str = "value") -> DataFrame:
    """Declared-schema JSON scan: every object is a row, absent fields NULL."""
    objects = with_object(messages, value, schemas.RAW_STRICT).filter(F.col("_object"))
    return objects.select(*_carried(messages, value), *_reading_columns())


def parse_legacy(messages: DataFrame, value: str = "value") -> DataFrame:
    """psi readings of the older sensors."""
    return _plain(messages, value, schemas.LEGACY_READING)


def parse_alert_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Alert topic messages; the time stays the text that was published."""
    return split(judge_alert_messages(messages, value)).valid


def typed_alerts(alert_messages: DataFrame) -> DataFrame:
    """Published alerts with their time text read back as a timestamp."""
    return alert_messages.withColumn("timestamp", parse_timestamp_text(F.col("timestamp")))


def parse_tire_data(messages: DataFrame, value: str = "value") -> DataFrame:
    """Ingest messages that can be read."""
    return split(judge_tire_data(messages, value)).valid


def with_event_time(readings: DataFrame, ms: str = "ts_ms", ts: str = "ts") -> DataFrame:
    """Adds the computed event-time column."""
    return readings.withColumn(ts, event_time(F.col(ms)))


def _bracketed(value: Column) -> Column:
    return F.concat(F.lit("["), value.cast("string"), F.lit("]"))


def _only(items: Column) -> Column:
    return F.when(F.size(items) == 1, F.get(items, F.lit(0)))


def _plain(messages: DataFrame, value: str, schema: T.StructType) -> DataFrame:
    objects = with_object(messages, value, schema).filter(F.col("_object"))
    return objects.select(*_carried(messages, value), *schema.names)


def _judged(
    messages: DataFrame, value: str, staged: DataFrame, reason: Column, columns: list[Column | str]
) -> DataFrame:
    carried = _carried(messages, value)
    return staged.select(*carried, F.col(value).alias("value"), reason.alias("reason"), *columns)


def _carried(messages: DataFrame, value: str) -> list[str]:
    return [name for name in messages.columns if name != value]


def _reading_columns() -> list[Column | str]:
    millis = F.col("timestamp").try_cast("bigint").alias("ts_ms")
    return ["sensor_id", "vehicle_id", millis, "pressure_kpa", "temperature_c", "battery_voltage"]


def _tolerant(o: Column) -> list[Column]:
    measures = ("pressure_kpa", "temperature_c", "battery_voltage")
    fields = [(name, o.getField(name)) for name in schemas.RAW_TOLERANT.names]
    return [(_number(field) if name in measures else field).alias(name) for name, field in fields]


def _number(text: Column) -> Column:
    # A cast would also take the Java suffixes of 1.5d and 1.5f. The bare words
    # NaN and Infinity arrive in quotes when read as text.
    suffixed = F.lower(text).rlike(r"[0-9.][df]\s*$")
    return F.when(text.isin(*_QUOTED_WORDS), F.btrim(text, F.lit('"')).try_cast("double")).when(
        ~suffixed, text.try_cast("double")
    )
