"""A table of current values by key, of which an update rewrites the touched buckets only.

Rows lie in folders by a hash of the key. An update reads the buckets that its
keys fall into, writes the merged rows to the scratch folder, and lets Spark
replace just those folders. One writer updates at a time; a repeated update
must give the same rows, as ``merge.upsert`` and ``newest_rows`` do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.sinks.tables import materialize

BUCKETS = 32
Merge = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class BucketTable:
    """``buckets`` is fixed for the life of a table."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def read(self, key: str | None = None) -> DataFrame:
        """All rows, or those of one key, for which one folder is opened."""
        rows = self._scan()
        if key is not None:
            number = self.spark.range(1).select(F.lit(key).alias(self.key)).select(self.bucket()).first()[0]
            rows = rows.filter((F.col("bucket") == number) & (F.col(self.key) == key))
        return rows.select(*self.schema.names)

    def update(self, batch: DataFrame, merged: Merge) -> list[int]:
        """Replaces the touched buckets by ``merged(their rows, batch)``; returns their numbers."""
        touched = sorted(r.bucket for r in batch.select(self.bucket().alias("bucket")).distinct().collect())  # at most ``buckets``
        if not touched:
            return []
        existing = self._scan().filter(F.col("bucket").isin(touched)).select(*self.schema.names)
        out = merged(existing, batch).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        settled = materialize(out.withColumn("bucket", self.bucket()), "buckets")
        settled.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)
        return touched

    def _scan(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise
