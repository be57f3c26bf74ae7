"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as a stream.

    ``path`` may be a folder or one file. A stream source wants a folder, but
    takes any path that is a pattern, so the last letter becomes a pattern.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def jdbc_source_options(
    url: str, table: str, split: tuple[str, str, str, int] | None = None, fetch: int = 10_000, **properties: str
) -> dict[str, str]:
    """``split`` is (column, lowest, highest, partitions) for a parallel scan."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch), **properties}
    if split is not None:
        column, low, high, partitions = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, table: str, split: tuple[str, str, str, int] | None = None, **properties: str
) -> DataFrame:
    """Database table scan; filters and columns are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_source_options(url, table, split, **properties)).load()
