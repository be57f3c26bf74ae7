from datetime import datetime, timezone

from helpers import START, alerts, readings
from pyspark.sql import functions as F

from fleetpulse.operators import serving
from fleetpulse.operators.aggregates import tumbling_aggregates

AS_OF = datetime(2024, 1, 1, 2, 0, tzinfo=timezone.utc)


def test_latest_breaks_ties_by_id(spark):
    rows = alerts(spark, [("b", "V001", 5, "HIGH"), ("a", "V001", 5, "HIGH"), ("c", "V002", 9, "HIGH"), ("d", "V002", 1, "HIGH")])
    assert [r.alert_id for r in serving.latest_alerts(rows, 3).collect()] == ["c", "a", "b"]
    assert [r.alert_id for r in serving.latest_of_vehicle(rows, "V001", ["alert_id"], 1).collect()] == ["a"]


def test_latest_per_vehicle_equals_one_by_one(spark):
    rows = alerts(spark, [(f"a{n}", f"V{n % 3 if n % 2 else 0:03d}", n // 2, "HIGH") for n in range(200)])
    fleet = serving.latest_per_vehicle(rows, ["alert_id"], 7).collect()
    for vehicle in ("V000", "V001", "V002"):
        one = [r.alert_id for r in serving.latest_of_vehicle(rows, vehicle, ["alert_id"], 7).collect()]
        assert [r.alert_id for r in sorted(fleet, key=lambda r: r.rank) if r.vehicle_id == vehicle] == one


def test_open_alerts_skip_unknown_flag(spark):
    rows = alerts(spark, [("a", "V001", 1, "HIGH"), ("b", "V001", 2, "HIGH"), ("c", "V001", 3, "HIGH")])
    flagged = rows.withColumn("is_resolved", F.when(F.col("alert_id") == "a", False).when(F.col("alert_id") == "b", True))
    assert [r.alert_id for r in serving.current_alerts(flagged).collect()] == ["a"]


def test_time_limits_inclusive_and_exclusive(spark):
    windows = tumbling_aggregates(readings(spark, [("V001-FL", s, 1.0, 1.0) for s in (3540, 3600, 7000)]))
    recent = serving.recent_aggregations(windows, AS_OF).select(F.unix_seconds("window_start").alias("s")).collect()
    assert [r.s - 1704067200 for r in recent] == [6960, 3600]
    rows = alerts(spark, [("a", "V001", 0, "HIGH"), ("b", "V001", 0, "HIGH"), ("c", "V001", 0, "MEDIUM")])
    made = rows.withColumn("created_at", F.when(F.col("alert_id") == "a", F.lit(START)).otherwise(F.lit(datetime(2024, 1, 1, 1, 0, 1))).cast("timestamp"))
    assert tuple(serving.high_alerts_since(made, AS_OF).first()) == (1, True)
    at_limit = rows.withColumn("created_at", F.lit(datetime(2024, 1, 1, 1, 0)).cast("timestamp"))
    assert tuple(serving.high_alerts_since(at_limit, AS_OF).first()) == (0, False)


def test_summary_all_history_or_since(spark):
    rows = alerts(spark, [("a", "V001", 0, "HIGH"), ("b", "V001", 0, "CRITICAL"), ("c", "V001", 0, "WARNING"), ("d", "V001", 0, "WARNING")])
    windows = tumbling_aggregates(readings(spark, [("V001-FL", 0, 1.0, 1.0), ("V002-FL", 7200, 1.0, 1.0), ("V002-FR", 7200, 1.0, 1.0)]))
    every = serving.dashboard_summary(rows, windows, clock=AS_OF).first()
    assert (every.total_alerts_history, every.active_vehicles_24h, every.critical_alerts_total, every.warning_alerts_total) == (4, 2, 1, 2)
    since = serving.dashboard_summary(rows, windows, clock=AS_OF, active_since=datetime(2024, 1, 1, 1)).first()
    assert since.active_vehicles_24h == 1
    assert {r.severity: r.alerts for r in serving.severity_counts(rows).collect()} == {"HIGH": 1, "CRITICAL": 1, "WARNING": 2}
    assert tuple(serving.table_counts(rows, windows).first()) == (4, 3)


def test_empty_tables(spark):
    none = alerts(spark, [("a", "V001", 0, "HIGH")]).limit(0)
    windows = tumbling_aggregates(readings(spark, [("V001-FL", 0, 1.0, 1.0)])).limit(0)
    row = serving.dashboard_summary(none, windows, clock=AS_OF).first()
    assert (row.total_alerts_history, row.active_vehicles_24h) == (0, 0)
    assert tuple(serving.high_alerts_since(none.withColumn("created_at", F.col("timestamp")), AS_OF).first()) == (0, False)


def test_series_of_one_sensor(spark):
    windows = tumbling_aggregates(readings(spark, [("V001-FL", 0, 1.0, 2.0), ("V001-FL", 60, 3.0, 4.0), ("V001-FR", 0, 5.0, 6.0)]))
    got = [(r.avg_pressure, r.avg_temperature) for r in serving.panel_series(windows, "V001-FL").collect()]
    assert got == [(1.0, 2.0), (3.0, 4.0)]
    assert serving.panel_series(windows).count() == 3
