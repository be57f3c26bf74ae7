"""Threshold alerts.

A rule set is data: measures, limits, severities and texts. Applying one is a
filter and a projection in one codegen stage; there is no shuffle and no state,
so a hot sensor costs nothing beyond its own rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.schemas import RAW_STRICT
from fleetpulse.functions.text import one_decimal
from fleetpulse.functions.times import Clock, at, event_time
from fleetpulse.operators.parse import json_fields, with_object

BELOW, ABOVE = "below", "above"

# Alert types, severities, id codes, measure names and units.
LOW_PRESSURE, HIGH_PRESSURE, HIGH_TEMPERATURE = "LOW_PRESSURE", "HIGH_PRESSURE", "HIGH_TEMPERATURE"
HIGH, MEDIUM = "HIGH", "MEDIUM"
CODES = {LOW_PRESSURE: "LP", HIGH_PRESSURE: "HP", HIGH_TEMPERATURE: "HT"}
MEASURE_TEXT = {"pressure_kpa": ("Pressure", " kPa"), "temperature_c": ("Temperature", "°C")}


@dataclass(frozen=True)
class Rule:
    """Alert when ``measure`` is strictly beyond ``limit`` on the given side.

    ``severe_limit`` raises the severity to HIGH when passed as well.
    """

    alert_type: str
    measure: str
    side: str
    limit: float
    severity: str
    severe_limit: float | None = None

    def hit(self) -> str:
        return beyond(self.measure, self.side, self.limit)

    def lead(self) -> str:
        return f"{MEASURE_TEXT[self.measure][0]} "

    def tail(self, limit_text: str) -> str:
        unit = MEASURE_TEXT[self.measure][1]
        return f"{unit} is {self.side} threshold {limit_text}{unit}"


@dataclass(frozen=True)
class RuleSet:
    """Ordered rules plus how to emit them.

    ``emit`` is ``first`` (first hit wins) or ``all`` (one alert per hit).
    ``needs`` lists measures without which a reading raises nothing.
    ``epoch_time`` publishes the event time as epoch milliseconds.
    """

    name: str
    rules: Sequence[Rule]
    emit: str = "first"
    needs: Sequence[str] = ()
    id_with_code: bool = True
    rounded_text: bool = True
    float_limits: bool = False
    epoch_time: bool = False

    def limit_text(self, rule: Rule) -> str:
        return str(float(rule.limit)) if self.float_limits else f"{rule.limit:g}"

    def any_hit(self) -> str:
        return " OR ".join(f"({rule.hit()})" for rule in self.rules)

    def first_hit(self, outcome: Callable[[int, Rule], str]) -> Column:
        """Outcome of the first rule that hits."""
        branches = [f"WHEN {rule.hit()} THEN {outcome(n, rule)}" for n, rule in enumerate(self.rules)]
        return F.expr(f"CASE {' '.join(branches)} END")

    def by_rule(self, text: Callable[[Rule], str]) -> Column:
        """Constant text looked up by rule number; keeps the generated code small."""
        return F.get(F.lit([text(rule) for rule in self.rules]), F.col("_rule"))

    def severities(self) -> Column:
        raised = [
            f"(_rule = {n} AND {beyond('_value', rule.side, rule.severe_limit)})"
            for n, rule in enumerate(self.rules)
            if rule.severe_limit is not None
        ]
        usual = self.by_rule(lambda rule: rule.severity)
        return F.when(F.expr(" OR ".join(raised)), F.lit(HIGH)).otherwise(usual) if raised else usual


# The four deployed sets of limits.
TIERED = RuleSet(
    "tiered",
    (
        Rule(LOW_PRESSURE, "pressure_kpa", BELOW, 200, MEDIUM, severe_limit=180),
        Rule(HIGH_TEMPERATURE, "temperature_c", ABOVE, 90, MEDIUM, severe_limit=95),
    ),
    needs=("pressure_kpa", "temperature_c"),
)
_WIDE = (
    Rule(LOW_PRESSURE, "pressure_kpa", BELOW, 180, HIGH),
    Rule(HIGH_PRESSURE, "pressure_kpa", ABOVE, 300, HIGH),
    Rule(HIGH_TEMPERATURE, "temperature_c", ABOVE, 80, MEDIUM),
)
MULTI = RuleSet(
    "multi", _WIDE, emit="all", needs=("pressure_kpa", "temperature_c"), float_limits=True, epoch_time=True
)
CASE = RuleSet("case", _WIDE, id_with_code=False, rounded_text=False, epoch_time=True)
LEGACY_PSI_LIMIT, LEGACY_TEMPERATURE_LIMIT = 90, 80


def beyond(measure: str, side: str, limit: float) -> str:
    """Strict comparison, as SQL, in which NaN is beyond nothing.

    Spark orders NaN above every number. The upper bound by infinity keeps
    NaN out and, unlike ``isnan``, can still be pushed into a Parquet scan.
    """
    if side == BELOW:
        return f"{measure} < {float(limit)}D"
    return f"{measure} > {float(limit)}D AND {measure} <= DOUBLE('Infinity')"


def apply_rules(
    readings: DataFrame, rule_set: RuleSet, clock: Clock = None, stamp: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Alerts raised by readings (``sensor_id, vehicle_id, ts_ms`` + measures).

    ``stamp`` adds ``processed_at`` from the clock. ``carry`` names input
    columns to keep.
    """
    present = [f"{name} IS NOT NULL" for name in (*rule_set.needs, "sensor_id", "vehicle_id", "ts_ms")]
    wanted = readings.filter(" AND ".join([*present, f"({rule_set.any_hit()})"]))

    kept = ["sensor_id", "vehicle_id", "ts_ms", *carry]
    if rule_set.emit == "all":
        outcomes = ", ".join(
            f"CASE WHEN {rule.hit()} THEN struct({n} AS rule, {rule.measure} AS value) END"
            for n, rule in enumerate(rule_set.rules)
        )
        found = (
            wanted.selectExpr(*kept, f"explode(array({outcomes})) AS _hit")
            .filter("_hit IS NOT NULL")
            .selectExpr(*kept, "_hit.rule AS _rule", "_hit.value AS _value")
        )
    else:
        found = wanted.select(
            *kept,
            rule_set.first_hit(lambda n, rule: str(n)).alias("_rule"),
            rule_set.first_hit(lambda n, rule: rule.measure).alias("_value"),
        )

    shown = one_decimal("_value") if rule_set.rounded_text else F.expr("CAST(_value AS STRING)")
    millis = F.expr("CAST(ts_ms AS STRING)")
    if rule_set.id_with_code:
        code = rule_set.by_rule(lambda rule: CODES[rule.alert_type])
        alert_id = F.concat_ws("-", "sensor_id", code, millis)
    else:
        alert_id = F.concat("sensor_id", F.lit("_"), millis)
    lead = rule_set.by_rule(Rule.lead)
    tail = rule_set.by_rule(lambda rule: rule.tail(rule_set.limit_text(rule)))
    return found.select(
        alert_id.alias("alert_id"),
        "sensor_id",
        "vehicle_id",
        event_time(F.col("ts_ms")).alias("timestamp"),
        rule_set.by_rule(lambda rule: rule.alert_type).alias("alert_type"),
        rule_set.severities().alias("severity"),
        F.concat(lead, shown, tail).alias("description"),
        F.col("_value").alias("triggering_value"),
        *([at(clock).alias("processed_at")] if stamp else []),
        *carry,
    )


def legacy_hit() -> str:
    """Low psi, or a known psi and a hot tire."""
    low = beyond("pressure_psi", BELOW, LEGACY_PSI_LIMIT)
    hot = beyond("temperature_c", ABOVE, LEGACY_TEMPERATURE_LIMIT)
    return f"{low} OR (pressure_psi IS NOT NULL AND {hot})"


def legacy_alerts(readings: DataFrame) -> DataFrame:
    """Full legacy payload."""
    return readings.filter(legacy_hit()).select(
        "vehicle_id", "tire_position", "pressure_psi", "temperature_c", F.lit(True).alias("alert"), "timestamp"
    )


def legacy_checks(readings: DataFrame) -> DataFrame:
    """Short legacy payload."""
    return readings.filter(legacy_hit()).select("vehicle_id", F.lit("Check tire").alias("alert"))


def label(readings: DataFrame) -> DataFrame:
    """Every reading as ALERT or NORMAL under the wide limits."""
    return readings.withColumn("label", F.expr(f"CASE WHEN {CASE.any_hit()} THEN 'ALERT' ELSE 'NORMAL' END"))


def smoke_classes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages that a quick check passes through, with what it would log.

    A missing measure counts as 0. That makes a missing pressure look low, and
    reporting it then fails, so such a message is dropped. A missing
    temperature never alerts. An explicit null or text measure that gets
    compared drops the message.
    """
    low_rule, hot_rule = _WIDE[0], _WIDE[2]
    # Keys are listed (a second parse) only where a NULL leaves it open
    # whether the field is there.
    classed = (
        with_object(messages, value, RAW_STRICT)
        .withColumn("_keys", F.map_keys(json_fields(F.col(value))))
        .withColumn("class", F.expr(f"CASE WHEN {low_rule.hit()} THEN 'LOW PRESSURE' WHEN {hot_rule.hit()} THEN 'HIGH TEMP' END"))
    )
    named = "CASE WHEN sensor_id IS NOT NULL THEN TRUE ELSE array_contains(_keys, 'sensor_id') END"
    measured = "CASE WHEN temperature_c IS NOT NULL THEN TRUE ELSE NOT array_contains(_keys, 'temperature_c') END"
    return classed.filter(
        f"""pressure_kpa IS NOT NULL
        AND CASE WHEN {low_rule.hit()} THEN TRUE ELSE {measured} END
        AND CASE WHEN class IS NULL THEN TRUE ELSE {named} END"""
    ).select(*messages.columns, "class")
