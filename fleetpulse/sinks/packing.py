"""Merging the small files of many batches while readers go on.

A table of batches has a folder for each part (a day, a key bucket, or none),
writer and batch. ``pack`` copies all but the newest batch of each writer into
a neighbouring folder, under the number of the last batch that the copy holds;
Spark moves a finished part into place at once. Readers take the copy with the
highest number and the batches behind it, so a batch is seen once before,
during and after. ``expire`` removes what copies have replaced, once no reader
that began earlier can still need it.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRACE_SECONDS = 3_600.0


@dataclass(frozen=True)
class Layout:
    """Where a table of batches lies: its columns, and the columns whose values name the folders above writer and batch."""

    spark: SparkSession
    path: str
    schema: T.StructType
    parts: tuple[T.StructField, ...] = ()

    @property
    def packed_path(self) -> str:
        return f"{self.path}-packed"

    def read(self, folders: Sequence[str] | None = None) -> DataFrame | None:
        """Rows with their part, writer and batch_id (null in a packed copy); ``folders`` name the parts to open.

        None if there is no such folder.
        """
        fresh, packed = self.fresh(folders), self.packed(folders)
        if packed is None:
            return fresh
        packed = packed.drop("through").withColumn("batch_id", F.lit(None).cast("bigint"))
        return packed if fresh is None else packed.unionByName(fresh)

    def packed(self, folders: Sequence[str] | None = None) -> DataFrame | None:
        """Rows of the newest copies, with their part, writer and through (the last batch that the copy holds)."""
        packed = self._scan(self.packed_path, "through", folders)
        if packed is None:
            return None
        newest = F.broadcast(self._newest(packed))
        current = packed.alias("rows").join(newest, self._same_group() & (F.col("rows.through") == F.col("newest.covered")))
        return current.select("rows.*")

    def copies(self) -> DataFrame | None:
        """The newest copies: part, writer and through, a row each, from the folders' names."""
        packed = self._scan(self.packed_path, "through", None)
        return None if packed is None else self._newest(packed).withColumnRenamed("covered", "through")

    def folder(self, *values: object) -> str:
        """Folder of one writer's rows in the part of these values, the writer last."""
        names = [*(f.name for f in self.parts), "writer"]
        return "/".join(f"{n}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for n, v in zip(names, values))

    def fresh(self, folders: Sequence[str] | None = None) -> DataFrame | None:
        """Rows of the batches that no copy holds, with their part, writer and batch_id."""
        fresh, packed = self._scan(self.path, "batch_id", folders), self._scan(self.packed_path, "through", folders)
        if fresh is None or packed is None:
            return fresh
        newest = F.broadcast(self._newest(packed))
        return fresh.alias("rows").join(newest, self._same_group() & (F.col("rows.batch_id") <= F.col("newest.covered")), "left_anti")

    def _newest(self, packed: DataFrame) -> DataFrame:
        """The last batch that copies hold, by part and writer: a row for each."""
        keys = [*(f.name for f in self.parts), "writer"]
        return packed.groupBy(*keys).agg(F.max("through").alias("covered")).alias("newest")

    def _same_group(self) -> Column:
        same = F.col("rows.writer") == F.col("newest.writer")
        for field in self.parts:
            same &= F.col(f"rows.{field.name}").eqNullSafe(F.col(f"newest.{field.name}"))
        return same

    def _scan(self, root: str, last: str, folders: Sequence[str] | None) -> DataFrame | None:
        fields = [*self.schema.fields, *self.parts, T.StructField("writer", T.StringType()), T.StructField(last, T.LongType())]
        reader = self.spark.read.schema(T.StructType(fields))
        wanted = [root] if folders is None else [f"{root}/{f}" for f in folders if self.exists(f"{root}/{f}")]
        if not wanted:
            return None
        try:
            return reader.option("basePath", root).parquet(*wanted)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def exists(self, path: str) -> bool:
        return self._files(path)[0].exists(self._files(path)[1])

    def listed(self, path: str) -> list:
        """Entries of a folder; none if it is not there."""
        files, place = self._files(path)
        return list(files.listStatus(place)) if files.exists(place) else []

    def remove(self, path: str) -> None:
        files, place = self._files(path)
        files.delete(place, True)

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), place


def pack(table: Layout, least: int = 8) -> int:
    """Merges the settled batches of each part and writer that has ``least`` of them; returns how many groups it merged.

    The newest batch of a writer stays apart, as a replay may write it again.
    Adaptive execution sizes the files. Running it again after a crash writes
    the same copies.
    """
    rows = table.read()
    if rows is None:
        return 0
    parts = [f.name for f in table.parts]
    rows = rows.select(*table.schema.names, *parts, "writer", "batch_id")
    last = rows.groupBy("writer").agg(F.max("batch_id").alias("last"))
    settled = rows.alias("rows").join(F.broadcast(last.alias("last")), F.col("rows.writer") == F.col("last.writer"))
    settled = settled.filter("batch_id IS NULL OR batch_id < last").select("rows.*", (F.col("last") - 1).alias("through"))
    counts = settled.groupBy(*parts, "writer").agg(F.count_distinct("batch_id").alias("batches"))
    ripe = counts.filter(F.col("batches") >= least).select(*[F.col(n).alias(f"_{n}") for n in parts], F.col("writer").alias("_writer"))
    ripe.persist()
    groups = ripe.count()
    if groups:
        same = F.col("writer") == F.col("_writer")
        for name in parts:
            same &= F.col(name).eqNullSafe(F.col(f"_{name}"))
        merged = settled.join(F.broadcast(ripe), same, "left_semi").select(*table.schema.names, *parts, "writer", "through")
        keys = [*parts, "writer", "through"]
        merged.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *keys
        ).parquet(table.packed_path)
    ripe.unpersist()
    return groups


def expire(table: Layout, grace: float = GRACE_SECONDS, now: float | None = None) -> int:
    """Removes batches and copies that a copy older than ``grace`` seconds replaces; returns the folders removed.

    Readers that started before the copy was written must be done by then.
    """
    before = ((time.time() if now is None else now) - grace) * 1000
    removed = 0
    for group in _groups(table, len(table.parts)):
        copies = {_number(e): e.getModificationTime() for e in table.listed(f"{table.packed_path}/{group}") if _number(e) is not None}
        settled = [n for n, written in copies.items() if written <= before]
        if not settled:
            continue
        covered = max(settled)
        for entry in [*table.listed(f"{table.path}/{group}"), *table.listed(f"{table.packed_path}/{group}")]:
            number, is_copy = _number(entry), entry.getPath().getName().startswith("through=")
            if number is not None and (number < covered if is_copy else number <= covered):
                table.remove(entry.getPath().toString())
                removed += 1
    return removed


def _groups(table: Layout, depth: int) -> list[str]:
    """Folders of parts and writers that have copies, below the packed folder."""
    found = [""]
    for _ in range(depth + 1):
        found = [f"{f}/{e.getPath().getName()}".lstrip("/") for f in found for e in table.listed(f"{table.packed_path}/{f}")
                 if "=" in e.getPath().getName()]
    return found


def _number(entry) -> int | None:
    name, _, value = entry.getPath().getName().partition("=")
    return int(value) if name in ("through", "batch_id") else None
