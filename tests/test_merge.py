from datetime import datetime, timezone

import pytest
from helpers import START, alerts, vehicles
from pyspark.sql import functions as F

from fleetpulse.functions import schemas
from fleetpulse.operators import merge
from fleetpulse.sinks.tables import BatchTable, LostRace, VersionedTable, append_rows
from fleetpulse.streaming import jobs

CLOCK = datetime(2024, 6, 1, tzinfo=timezone.utc)


@pytest.fixture
def table(spark, tmp_path):
    return BatchTable(spark, str(tmp_path / "alerts"), schemas.STORED_ALERT, day_of="timestamp")


def test_first_arrival_wins_even_for_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("alert_id"),
        (F.lit(5000) - F.col("id")).alias("arrival"),
    )
    stored = spark.createDataFrame([("k1",), ("k2",)], "alert_id string")
    out = merge.insert_ignore(rows, stored, arrival=["arrival"])
    assert out.count() == 1 + 2000 - 2
    assert out.filter("alert_id = 'hot'").first().arrival == 5000 - 2997


def test_null_key_is_refused(spark):
    rows = alerts(spark, [("a", "V001", 0, "HIGH"), (None, "V001", 1, "HIGH")])
    assert [r.alert_id for r in merge.insert_ignore(rows, rows.limit(0), ["timestamp"]).collect()] == ["a"]


def test_replay_and_conflicts(spark, table):
    first = alerts(spark, [("a", "V001", 0, "HIGH"), ("b", "V001", 1, "HIGH"), ("a", "V001", 0, "MEDIUM")])
    second = alerts(spark, [("b", "V002", 1, "LOW"), ("c", "V002", 86_400 * 2, "HIGH")])
    for n, rows in [(0, first), (1, second), (1, second), (0, first), (1, second)]:
        jobs.store_alerts(rows, n, table, clock=CLOCK, arrival=("severity",), ids_carry_time=True)
        got = {r.alert_id: (r.id, r.vehicle_id, r.severity, r.is_resolved) for r in table.read().collect()}
    assert {k: v[1:] for k, v in got.items()} == {
        "a": ("V001", "HIGH", False),
        "b": ("V001", "HIGH", False),
        "c": ("V002", "HIGH", False),
    }
    assert len({v[0] for v in got.values()}) == 3


def test_days_prune_but_keep_the_answer(spark, table):
    rows = alerts(spark, [(f"a{d}", "V001", 86_400 * d, "HIGH") for d in range(5)])
    jobs.store_alerts(rows, 0, table, ("timestamp",), clock=CLOCK)
    again = alerts(spark, [("a3", "V001", 86_400 * 3, "HIGH"), ("a9", "V001", 86_400 * 9, "HIGH")])
    jobs.store_alerts(again, 1, table, ("timestamp",), clock=CLOCK, ids_carry_time=True)
    assert sorted(r.alert_id for r in table.read().collect()) == ["a0", "a1", "a2", "a3", "a4", "a9"]
    day = datetime(2024, 1, 4).date()
    assert [r.alert_id for r in table.read(days=(day, day)).collect()] == ["a3"]


def test_a_batch_opens_only_its_days(spark, table):
    rows = alerts(spark, [(f"a{d}", "V001", 86_400 * d, "HIGH") for d in range(6)])
    jobs.store_alerts(rows, 0, table, ("timestamp",), clock=CLOCK)
    assert len(table.stored_days()) == 6
    day = datetime(2024, 1, 5).date()
    files = table.read(days=[day]).inputFiles()
    assert files and all("day=2024-01-05" in f for f in files)
    recent = table.read(since=day)
    assert {f.split("day=")[1][:10] for f in recent.inputFiles()} == {"2024-01-05", "2024-01-06"}
    assert "PartitionFilters: [isnotnull(day" in recent._jdf.queryExecution().executedPlan().toString()


def test_newest_days_hold_the_newest_rows(spark, table):
    rows = alerts(spark, [(f"a{n}", "V001", 43_200 * n, "HIGH") for n in range(20)])
    jobs.store_alerts(rows, 0, table, ("timestamp",), clock=CLOCK, serial=False)
    for limit in (1, 2, 3, 7, 20, 50):
        wanted = sorted((f"a{n}" for n in range(20)), key=lambda a: -int(a[1:]))[:limit]
        few = table.newest(limit)
        assert [r.alert_id for r in few.orderBy(F.desc("timestamp")).limit(limit).collect()] == wanted
    assert len(table.newest(2).inputFiles()) < len(table.read().inputFiles())
    assert table.newest(1, slack=1).count() > table.newest(1).count()


def test_a_replay_keeps_its_ids(spark, table):
    first = alerts(spark, [("a", "V001", 0, "HIGH"), ("b", "V001", 1, "HIGH")])
    second = alerts(spark, [("c", "V001", 2, "HIGH")])
    for n, rows in [(0, first), (1, second), (0, first), (1, second)]:
        jobs.store_alerts(rows, n, table, ("timestamp",), clock=CLOCK, ids_carry_time=True)
    assert {r.alert_id: r.id for r in table.read().collect()} == {"a": 1, "b": 2, "c": 3}


def test_serial_ids_are_dense_and_ordered(spark):
    rows = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("k"))
    out = merge.with_serial_id(rows, ["k"], start=10).collect()
    assert sorted((r.id, r.k) for r in out) == [(11 + k, k) for k in range(5000)]


def test_upsert_keeps_created_at(spark):
    old = vehicles(spark, [("V001", "a", "b"), ("V002", "c", "d")])
    new = spark.createDataFrame([("V002", "x", "y"), ("V003", "p", "q")], "vehicle_id string, owner_email string, driver_email string")
    out = merge.upsert(old, new, "vehicle_id", ["owner_email", "driver_email"], clock=CLOCK)
    got = {r.vehicle_id: (r.owner_email, r.driver_email, r.created_at) for r in out.collect()}
    then, now = START, CLOCK.replace(tzinfo=None)
    assert {k: v[:2] for k, v in got.items()} == {"V001": ("a", "b"), "V002": ("x", "y"), "V003": ("p", "q")}
    assert out.filter(F.col("created_at") == F.lit(then).cast("timestamp")).count() == 2
    assert out.filter(F.col("created_at") == F.lit(now).cast("timestamp")).count() == 1


@pytest.mark.parametrize("rows", [[("V1", "a", "b"), ("V1", "c", "d")], [(None, "a", "b")]])
def test_upsert_refuses_bad_keys(spark, rows):
    new = spark.createDataFrame(rows, "vehicle_id string, owner_email string, driver_email string")
    with pytest.raises(Exception, match="key repeated or missing"):
        merge.upsert(vehicles(spark, [("V1", "o", "d")]), new, "vehicle_id", ["owner_email", "driver_email"], CLOCK).collect()


def test_versioned_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "vehicles"), schemas.VEHICLE)
    assert table.read().count() == 0
    table.replace(vehicles(spark, [("V001", "a", "b")]))
    # A half-written next version is not seen, and is written anew.
    vehicles(spark, [("junk", "a", "b")]).write.parquet(f"{table.path}/data/version=1")
    assert [r.vehicle_id for r in table.read().collect()] == ["V001"]
    assert table.replace(table.read().withColumn("owner_email", F.lit("z"))) == 1
    assert [(r.vehicle_id, r.owner_email) for r in table.read().collect()] == [("V001", "z")]


def test_two_writers_of_one_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "vehicles"), schemas.VEHICLE)
    for folder, name in [("version=0-b", "B"), ("version=0-a", "A")]:
        vehicles(spark, [(name, "o", "d")]).write.parquet(f"{table.path}/data/{folder}")
    table._commit(0, "version=0-b")
    with pytest.raises(LostRace):
        table._commit(0, "version=0-a")
    assert [r.vehicle_id for r in table.read().collect()] == ["B"]
    assert table.replace(vehicles(spark, [("C", "o", "d")])) == 1


def test_append_rows_fills_missing_time(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "tire_data"), schemas.TIRE_DATA)
    rows = spark.createDataFrame([("t", 1.0, 2.0, None), ("u", 1.0, 2.0, START)], schemas.TIRE_DATA)
    append_rows(table, rows, 0, clock=CLOCK)
    append_rows(table, rows, 0, clock=CLOCK)
    got = {r.tire_id: r.ms for r in table.read().selectExpr("tire_id", "unix_millis(timestamp) ms").collect()}
    assert got["t"] == int(CLOCK.timestamp() * 1000) and len(got) == 2
    assert table.read().count() == 2


def test_a_batch_writes_few_files_and_splits_a_hot_day(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), schemas.TIRE_DATA, day_of="timestamp")
    rows = spark.range(0, 6000, numPartitions=8).selectExpr(
        "CAST(id AS STRING) AS tire_id",
        "CAST(id AS DOUBLE) AS pressure",
        "1D AS temperature",
        "timestamp_seconds(1704067200 + 86400 * CASE WHEN id % 3 = 0 THEN 0 ELSE id % 31 END) AS timestamp",
    )
    table.append(rows, 0)
    files = list((tmp_path / "t").glob("**/*.parquet"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= 31 + partitions
    assert table.read().count() == 6000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.append(rows, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [f for f in (tmp_path / "t").glob("**/*.parquet") if "day=2024-01-01" in str(f)]
    assert len(hot) >= 3
    assert table.read().count() == 6000
