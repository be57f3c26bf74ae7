"""The stored values of a unique key, so that an insert need not read the table.

Keys lie in hash buckets, one folder each. A batch opens only the buckets that
its keys fall into, and there, if it is small, only row groups whose Bloom
filter may hold one of them. However late a key comes again, it is known.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.sinks.packing import Layout

BUCKETS = 32
PUSHED_KEYS = 64


@dataclass(frozen=True)
class KeyIndex:
    """Keys of a table by bucket, writer and batch. ``buckets`` is fixed for the life of an index."""

    spark: SparkSession
    path: str
    key: str = "alert_id"
    buckets: int = BUCKETS

    @property
    def layout(self) -> Layout:
        parts = (T.StructField("bucket", T.IntegerType()),)
        return Layout(self.spark, self.path, T.StructType([T.StructField(self.key, T.StringType())]), parts)

    def exists(self) -> bool:
        return self.layout.exists(self.path)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def add(self, rows: DataFrame, batch_id: int, writer: str) -> None:
        """Keys of one batch; a replay writes the same ones again."""
        keys = rows.select(F.col(self.key).cast("string").alias(self.key)).withColumn("bucket", self.bucket())
        placed = keys.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id)})
        placed.repartition("bucket").sortWithinPartitions("bucket", self.key).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).option(f"parquet.bloom.filter.enabled#{self.key}", "true").partitionBy("bucket", "writer", "batch_id").parquet(self.path)

    def among(self, rows: DataFrame, without: tuple[str, int] | None = None) -> DataFrame:
        """Stored keys out of the buckets of the rows' keys, without those of one batch."""
        keys = rows.select(self.key).filter(F.col(self.key).isNotNull())
        wanted = [r.bucket for r in keys.select(self.bucket().alias("bucket")).distinct().collect()]  # at most ``buckets``
        stored = self.layout.read([f"bucket={b}" for b in sorted(wanted)])
        if stored is None:
            return self.spark.createDataFrame([], self.layout.schema)
        if without is not None:
            stored = stored.filter((F.col("writer") != without[0]) | F.col("batch_id").isNull() | (F.col("batch_id") != without[1]))
        few = [r[0] for r in keys.distinct().limit(PUSHED_KEYS + 1).collect()]
        if 0 < len(few) <= PUSHED_KEYS:
            stored = stored.filter(reduce(or_, [F.col(self.key) == k for k in few]))
        return stored.select(self.key)
