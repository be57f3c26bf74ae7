"""Merged batches, key buckets and id records."""

from datetime import datetime, timedelta

import pytest
from helpers import START, alerts
from pyspark.sql import functions as F

from fleetpulse.functions import schemas
from fleetpulse.sinks import packing
from fleetpulse.sinks.keys import KeyIndex
from fleetpulse.sinks.tables import BatchTable
from fleetpulse.streaming import jobs

DAY = 86_400
CLOCK = datetime(2024, 6, 1)


def files(table, folder=""):
    """Data files below a folder."""
    import pathlib

    return len([p for p in pathlib.Path(table.path + folder).rglob("*.parquet")])


def content(table):
    return sorted(tuple(r) for r in table.read().collect())


@pytest.fixture(params=["timestamp", None])
def many(spark, tmp_path, request):
    """Batches over three days and of rows without a time, as a stream with a short trigger leaves them: 1,000 by day, 60 without days."""
    schema = schemas.TIRE_DATA
    table = BatchTable(spark, str(tmp_path / "t"), schema, day_of=request.param)
    rows = spark.range(1000 if request.param else 60).selectExpr(
        "concat('T', id) tire_id", "CAST(id AS DOUBLE) pressure", "1D temperature",
        f"CASE WHEN id % 50 <> 7 THEN timestamp_seconds({int(START.timestamp())} + id % 3 * {DAY}) END AS timestamp", "id",
    )
    placed = rows.withColumns({"writer": F.lit("main"), "batch_id": F.col("id"), "day": F.col("timestamp").cast("date")}).drop("id")
    folders = ["writer", "batch_id"] if request.param is None else ["day", "writer", "batch_id"]
    placed = placed.drop("day") if request.param is None else placed
    placed.coalesce(4).write.partitionBy(*folders).parquet(table.path)
    return table


def test_a_thousand_batches_leave_few_files(many):
    before, reader = content(many), many.read()
    size = len(before)
    assert size == files(many) == (1000 if many.day_of else 60)
    assert packing.pack(many.layout) == (4 if many.day_of else 1)
    assert content(many) == before
    assert sorted(tuple(r) for r in reader.collect()) == before  # planned before the merge, read after it
    assert packing.expire(many.layout, grace=3600) == 0
    packing.expire(many.layout, grace=-5)
    assert content(many) == before
    assert files(many) == 1 and files(many, "-packed") <= 8
    for batch in range(size, size + 12):
        many.append(many.read().limit(1), batch)
    assert len(content(many)) == size + 12
    packing.pack(many.layout)
    packing.expire(many.layout, grace=-5)
    assert len(content(many)) == size + 12 and files(many) + files(many, "-packed") <= 12
    if many.day_of:
        assert many.stored_days() == [(START + timedelta(days=n)).date() for n in range(3)]
        one = many.read(days=many.stored_days()[:1])
        assert 300 < one.count() < 1012 - 600


def test_a_replay_of_the_newest_batch_replaces_it_after_a_merge(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), schemas.ALERT, day_of="timestamp")
    for batch in range(5):
        table.append(alerts(spark, [(f"a{batch}", "V001", batch, "HIGH")]), batch)
    assert packing.pack(table.layout, least=2) == 1
    assert packing.pack(table.layout, least=2) == 0
    table.append(alerts(spark, [("a4", "V001", 4, "HIGH")]), 4)
    assert [r[0] for r in content(table)] == [f"a{n}" for n in range(5)]
    assert table.read(without=("main", 4)).count() == 4


def test_an_empty_batch_leaves_no_folder(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), schemas.STORED_ALERT, day_of="timestamp")
    rows = alerts(spark, [("a", "V001", 1, "HIGH")])
    for batch in range(4):
        jobs.store_alerts(rows, batch, table, ("timestamp",), clock=CLOCK)
    rejected = jobs.rejected_table(table)
    assert files(rejected) == 0 and rejected.read().count() == 0
    assert files(BatchTable(spark, f"{table.path}-ids", schemas.ALERT)) == 2
    assert [r.id for r in table.read().collect()] == [1]


def test_ids_go_on_across_writers_and_replays(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), schemas.STORED_ALERT, day_of="timestamp")
    sent = {n: alerts(spark, [(f"b{n}-{k}", "V001", 10 * n + k, "HIGH") for k in range(3)]) for n in range(5)}
    for n in (0, 1, 2, 2, 3):
        jobs.store_alerts(sent[n], n, table, ("timestamp",), writer="one", clock=CLOCK)
    jobs.store_alerts(sent[4], 0, table, ("timestamp",), writer="two", clock=CLOCK)
    got = {r.alert_id: r.id for r in table.read().collect()}
    assert got == {f"b{n}-{k}": 3 * n + k + 1 for n in range(5) for k in range(3)}


def test_a_batch_opens_the_buckets_of_its_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), buckets=64)
    keys = spark.range(20_000).selectExpr("concat('k', id) alert_id")
    index.add(keys, 0, "w")
    asked = spark.createDataFrame([("k5",), ("k7",), ("new",), (None,)], "alert_id string")
    found = index.among(asked)
    assert sorted(r[0] for r in found.collect()) == ["k5", "k7"]
    stored = index.layout.read()
    opened = index.layout.read([f"bucket={b.b}" for b in asked.filter("alert_id IS NOT NULL").select(index.bucket().alias("b")).distinct().collect()])
    count = lambda rows: rows.select(F.input_file_name()).distinct().count()
    assert count(stored) == 64 and count(opened) <= 3
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and "EqualTo(alert_id,k5)" in text
    assert index.among(asked, without=("w", 0)).count() == 0
    assert index.among(keys).count() == 20_000


def test_ids_without_time_are_known_however_late(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), schemas.STORED_ALERT, day_of="timestamp")
    table.append(alerts(spark, [("old", "V001", 0, "HIGH")]).selectExpr("CAST(NULL AS BIGINT) id", "*", "false is_resolved", "timestamp created_at"), 0, "before-the-index")
    days = [alerts(spark, [(a, "V001", s, "HIGH") for a, s in rows]) for rows in (
        [("a", 0), ("b", 1)], [("a", 40 * DAY), ("c", 2)], [("old", 90 * DAY), ("b", 1), ("d", 5)], [("d", 9)])]
    for n, rows in enumerate(days):
        for _ in range(2):
            jobs.store_alerts(rows, n, table, ("timestamp",), clock=CLOCK, serial=False)
    assert sorted(r.alert_id for r in table.read().collect()) == ["a", "b", "c", "d", "old"]
    # Rules whose ids carry the time keep an index that is there, so that both ways know of each other.
    jobs.store_alerts(alerts(spark, [("e", "V001", 3, "HIGH")]), 9, table, ("timestamp",), ids_carry_time=True, serial=False)
    jobs.store_alerts(alerts(spark, [("e", "V001", 50 * DAY, "HIGH")]), 10, table, ("timestamp",), serial=False)
    assert table.read().filter("alert_id = 'e'").count() == 1
    assert packing.pack(jobs.known_keys(table).layout, least=2) >= 0
    jobs.store_alerts(alerts(spark, [("a", "V001", 70 * DAY, "HIGH")]), 11, table, ("timestamp",), serial=False)
    assert table.read().count() == 6
