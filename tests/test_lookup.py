from collections import Counter

import pytest
from helpers import alerts, vehicles
from pyspark.sql import functions as F

from fleetpulse.operators import notify
from fleetpulse.operators.lookup import hot_keys, lookup_join, text_bytes

# A third of all alerts belongs to one vehicle.
ROWS = [(f"a{n}", "V001" if n % 3 == 0 else f"V{n % 40:03d}", n, "HIGH") for n in range(900)] + [("x", None, 1, "HIGH")]
KNOWN = [(f"V{n:03d}", f"o{n}@example.com", f"d{n}@example.com") for n in range(0, 30)]
SALTED = {"max_broadcast_bytes": 0, "rows_per_task": 50}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_equals_broadcast(spark, how):
    facts, table = alerts(spark, ROWS), vehicles(spark, KNOWN).drop("created_at")
    plain = lookup_join(facts, table, "vehicle_id", "alert_id", how)
    salted = lookup_join(facts, table, "vehicle_id", "alert_id", how, **SALTED)
    names = sorted(plain.columns)
    assert sorted(salted.columns) == names
    assert Counter(plain.select(names).collect()) == Counter(salted.select(names).collect())
    assert plain.count() > 0


def test_hot_key_is_split_and_cold_ones_are_not(spark):
    parts = {r.vehicle_id: r["_parts"] for r in hot_keys(alerts(spark, ROWS), "vehicle_id", 50).collect()}
    assert parts == {"V001": 7}
    joined = lookup_join(alerts(spark, ROWS), vehicles(spark, KNOWN), "vehicle_id", "alert_id", **SALTED)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_broadcast_only_when_measured_small(spark):
    facts, table = alerts(spark, ROWS), vehicles(spark, KNOWN).drop("created_at")
    size = text_bytes(table)
    assert size == sum(64 + sum(len(x) for x in row) for row in KNOWN)
    small = lookup_join(facts, table, "vehicle_id", "alert_id", max_broadcast_bytes=size)
    large = lookup_join(facts, table, "vehicle_id", "alert_id", max_broadcast_bytes=size - 1)
    assert "_salt" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()


def test_messages(spark):
    rows = alerts(spark, [("a1", "V001", 0, "HIGH"), ("a2", "V002", 1, "MEDIUM"), ("a3", "V003", 2, None), ("a4", "V009", 3, "HIGH"), ("a5", "V004", 4, "HIGH")])
    contacts = vehicles(
        spark,
        [("V001", "a@example.com", "a@example.com"), ("V002", "z@example.com", "b@example.com"), ("V003", "o@example.com", None), ("V004", "", "d@example.com")],
    )
    out = {r.alert_id: r for r in notify.notifications(rows, contacts).collect()}
    assert {k: list(r.recipients) for k, r in out.items()} == {
        "a1": ["a@example.com"],
        "a2": ["b@example.com", "z@example.com"],
        "a3": ["o@example.com"],
    }
    assert out["a1"].subject == "[HIGH] Tire Alert for Vehicle V001: LOW_PRESSURE"
    assert out["a3"].subject.startswith("[None] ")
    pad = " " * 8
    lines = [
        "", "TIRE ALERT NOTIFICATION", "=======================", "", "Vehicle ID: V001", "Alert Type: LOW_PRESSURE",
        "Severity:   HIGH", "Time:       2024-01-01T00:00:00", "", "Description:", "d", "",
        "Please check the dashboard for more details.", "",
    ]
    assert out["a1"].body == "\n".join([lines[0]] + [pad + line for line in lines[1:]])
    assert sorted(r.alert_id for r in notify.unroutable(rows, contacts).collect()) == ["a4", "a5"]


def test_every_alert_is_sent_or_unroutable(spark):
    facts, table = alerts(spark, ROWS), vehicles(spark, KNOWN)
    for sizes in ({}, SALTED):
        sent = notify.notifications(facts, table, **sizes).select("alert_id")
        lost = notify.unroutable(facts, table, **sizes).select("alert_id")
        both = sent.union(lost).groupBy("alert_id").agg(F.count(F.lit(1)).alias("n"))
        assert both.count() == len(ROWS) and both.filter("n <> 1").count() == 0
