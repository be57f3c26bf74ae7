"""Rules against a plain restatement of each, on boundary values."""

import itertools
import math

import pytest
from helpers import START_MS, readings

from fleetpulse.functions.times import at
from fleetpulse.operators import rules

PRESSURES = [150.0, 179.99, 180.0, 199.99, 200.0, 250.0, 300.0, 300.01, None, float("nan"), float("inf")]
TEMPERATURES = [70.0, 80.0, 80.01, 90.0, 90.01, 95.0, 95.01, None, float("nan"), float("inf")]


@pytest.fixture(scope="module")
def grid(spark):
    rows = [(f"V001-{n}", n, p, t) for n, (p, t) in enumerate(itertools.product(PRESSURES, TEMPERATURES))]
    return rows, readings(spark, rows).cache()


def got(df):
    return sorted((r.sensor_id, r.alert_id, r.alert_type, r.severity, r.description, r.triggering_value) for r in df.collect())


def tiered(s, ms, p, t):
    if p is None or t is None:
        return []
    if p < 200:
        return [(s, f"{s}-LP-{ms}", "LOW_PRESSURE", "HIGH" if p < 180 else "MEDIUM", f"Pressure {p:.1f} kPa is below threshold 200 kPa", p)]
    if t > 90:
        return [(s, f"{s}-HT-{ms}", "HIGH_TEMPERATURE", "HIGH" if t > 95 else "MEDIUM", f"Temperature {t:.1f}°C is above threshold 90°C", t)]
    return []


def multi(s, ms, p, t):
    if p is None or t is None:
        return []
    out = []
    if p < 180:
        out.append((s, f"{s}-LP-{ms}", "LOW_PRESSURE", "HIGH", f"Pressure {p:.1f} kPa is below threshold 180.0 kPa", p))
    if p > 300:
        out.append((s, f"{s}-HP-{ms}", "HIGH_PRESSURE", "HIGH", f"Pressure {p:.1f} kPa is above threshold 300.0 kPa", p))
    if t > 80:
        out.append((s, f"{s}-HT-{ms}", "HIGH_TEMPERATURE", "MEDIUM", f"Temperature {t:.1f}°C is above threshold 80.0°C", t))
    return out


def case(s, ms, p, t):
    def text(x):
        return "Infinity" if math.isinf(x) else str(x)

    if p is not None and p < 180:
        return [(s, f"{s}_{ms}", "LOW_PRESSURE", "HIGH", f"Pressure {text(p)} kPa is below threshold 180 kPa", p)]
    if p is not None and p > 300:
        return [(s, f"{s}_{ms}", "HIGH_PRESSURE", "HIGH", f"Pressure {text(p)} kPa is above threshold 300 kPa", p)]
    if t is not None and t > 80:
        return [(s, f"{s}_{ms}", "HIGH_TEMPERATURE", "MEDIUM", f"Temperature {text(t)}°C is above threshold 80°C", t)]
    return []


@pytest.mark.parametrize("rule_set,expected", [(rules.TIERED, tiered), (rules.MULTI, multi), (rules.CASE, case)], ids=lambda x: getattr(x, "name", ""))
def test_rule_sets(grid, rule_set, expected):
    rows, frame = grid
    want = sorted(a for s, sec, p, t in rows for a in expected(s, START_MS + sec * 1000, p, t))
    assert got(rules.apply_rules(frame, rule_set)) == want


def test_case_fires_on_temperature_without_pressure(spark):
    frame = readings(spark, [("V001-FL", 0, None, 85.0)])
    assert [r.alert_type for r in rules.apply_rules(frame, rules.CASE).collect()] == ["HIGH_TEMPERATURE"]
    assert rules.apply_rules(frame, rules.TIERED).count() == 0
    assert rules.apply_rules(frame, rules.MULTI).count() == 0


def test_ids_of_one_reading_differ(spark):
    frame = readings(spark, [("V001-FL", 0, 170.0, 99.0)])
    ids = [r.alert_id for r in rules.apply_rules(frame, rules.MULTI).collect()]
    assert sorted(ids) == [f"V001-FL-HT-{START_MS}", f"V001-FL-LP-{START_MS}"]


def test_stamp_uses_the_clock(spark):
    from datetime import datetime

    clock = datetime(2024, 3, 1, 8, 30)
    frame = rules.apply_rules(readings(spark, [("V001-FL", 0, 170.0, 70.0)]), rules.MULTI, clock=clock, stamp=True)
    assert frame.filter(frame.processed_at == at(clock)).count() == 1


def test_label(grid):
    rows, frame = grid
    got_labels = {r.sensor_id: r.label for r in rules.label(frame).collect()}
    for s, _, p, t in rows:
        hit = (p is not None and (p < 180 or p > 300)) or (t is not None and t > 80)
        assert got_labels[s] == ("ALERT" if hit else "NORMAL")


def test_legacy(spark):
    data = [("V1", "FL", 89.9, 70.0), ("V1", "FR", 90.0, 80.0), ("V1", "RL", 90.0, 80.1), ("V1", "RR", None, 99.0), ("V2", "FL", 80.0, None)]
    frame = spark.createDataFrame(
        [(v, p, psi, t, 1) for v, p, psi, t in data],
        "vehicle_id string, tire_position string, pressure_psi double, temperature_c double, timestamp long",
    )
    assert sorted((r.vehicle_id, r.tire_position) for r in rules.legacy_alerts(frame).collect()) == [("V1", "FL"), ("V1", "RL"), ("V2", "FL")]
    assert [tuple(r) for r in rules.legacy_checks(frame).orderBy("vehicle_id").collect()] == [("V1", "Check tire"), ("V1", "Check tire"), ("V2", "Check tire")]
