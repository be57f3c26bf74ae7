import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetpulse.functions.text import iso_timestamp, one_decimal
from fleetpulse.functions.times import event_time_whole_seconds, from_epoch_seconds, parse_timestamp_text, utc_day


def test_one_decimal_equals_exact_rounding(spark):
    rng = random.Random(7)
    values = [n / 100 for n in range(0, 40001)]
    values += [-v for v in values[1:5000:7]]
    values += [n / 20 for n in range(-400, 400)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(5000)]
    values += [rng.uniform(0, 1e13) for _ in range(2000)]
    values += [n / 20 + d for n in range(0, 2000) for d in (1e-13, -1e-13)]
    values += [-0.0, 1e14, 123456789012345680.0, float("inf"), float("-inf"), float("nan")]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", one_decimal("x").alias("t"))
    wrong = [(r.x, r.t, f"{r.x:.1f}") for r in rows.collect() if r.t != f"{r.x:.1f}"]
    assert wrong == []


def test_one_decimal_of_null(spark):
    nothing = spark.createDataFrame([(None,)], "x double")
    assert nothing.select(one_decimal("x").alias("t")).first().t is None


def test_iso_timestamp_omits_zero_fraction(spark):
    rows = spark.createDataFrame([(1704067200000,), (1704067200500,), (1704067199001,)], "ms long")
    texts = [r.t for r in rows.select(iso_timestamp(F.timestamp_millis("ms")).alias("t")).collect()]
    assert texts == ["2024-01-01T00:00:00", "2024-01-01T00:00:00.500000", "2023-12-31T23:59:59.001000"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_text_and_day_in_any_session_zone(spark, zone):
    millis = [1704067200000, 1704067199999, -1, 0, 1710054000500, 4102444799001]
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.createDataFrame([(m,) for m in millis], "ms long").withColumn("ts", F.timestamp_millis("ms"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = rows.select("ms", iso_timestamp(F.col("ts")).alias("t"), utc_day(F.col("ts")).cast("string").alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for r in found:
        exact = datetime(1970, 1, 1) + timedelta(milliseconds=r.ms)
        assert (r.t, r.d) == (exact.isoformat(), exact.date().isoformat())


def test_time_conversions(spark):
    row = spark.createDataFrame([(1704067200999, "1704067200.25", "2024-01-01T00:00:01")], "ms long, s string, t string")
    out = row.select(
        event_time_whole_seconds(F.col("ms")).alias("whole"),
        F.unix_millis(from_epoch_seconds(F.col("s"))).alias("ms"),
        from_epoch_seconds(F.lit("soon")).alias("bad"),
        F.unix_millis(parse_timestamp_text(F.col("t"))).alias("text"),
        parse_timestamp_text(F.lit("soon")).alias("bad_text"),
    ).select(F.unix_millis("whole").alias("whole"), "ms", "bad", "text", "bad_text")
    assert tuple(out.first()) == (1704067200000, 1704067200250, None, 1704067201000, None)
