"""The clock as a stream, for windows that close though nothing arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def clock_ticks(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """One column ``tick``: the time, every second."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).option("numPartitions", 1).load()
    return ticks.select(F.col("timestamp").alias("tick"))


def recorded_ticks(spark: SparkSession, path: str) -> DataFrame:
    """Ticks from Parquet files, as another process or a test wrote them."""
    return spark.readStream.schema("tick timestamp").parquet(path)
