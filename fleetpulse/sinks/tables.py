"""Parquet tables: per-batch append, versioned replace, written intermediates."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.times import Clock, at, utc_day
from fleetpulse.session import scratch_path
from fleetpulse.sinks.packing import Layout


def materialize(rows: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared scratch folder and reads them back.

    Cuts lineage in a way that outlives lost executors, and fixes values such
    as partition ids that a recomputation could change.
    """
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@dataclass(frozen=True)
class BatchTable:
    """Append-only table with one folder per writer and batch.

    A replayed batch replaces its own folder, so appending is idempotent. With
    ``day_of`` the day comes first in the layout, so that a reader opens and
    lists only the days it asks for. There a replay replaces the days it holds,
    which are the same ones, as a stream repeats the same input. Many small
    batches are merged with ``packing.pack(table.layout)``.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    day_of: str | None = None

    @property
    def layout(self) -> Layout:
        parts = () if self.day_of is None else (T.StructField("day", T.DateType()),)
        return Layout(self.spark, self.path, self.schema, parts)

    def append(self, rows: DataFrame, batch_id: int, writer: str = "main", clustered: bool = False) -> None:
        """Writes one batch; one without rows leaves no folder.

        Unless ``clustered`` (already in day order), rows are ranged by day and
        a hash: a task then writes few days, and a hot day has many tasks.
        """
        out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        folders = ["writer", "batch_id"]
        if self.day_of is not None:
            folders.insert(0, "day")
            out = out.withColumn("day", utc_day(F.col(self.day_of)))
            if not clustered:
                out = out.repartitionByRange("day", F.xxhash64(*self.schema.names))
        placed = out.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id)})
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(self.path)

    def read(
        self,
        without: tuple[str, int] | None = None,
        days: Iterable[date] | None = None,
        since: date | None = None,
    ) -> DataFrame:
        """All rows, or less.

        ``without`` leaves one (writer, batch) out. ``days`` and ``since`` open
        just those day folders; rows without a time are in none of them.
        """
        folders = None
        if days is not None or since is not None:
            wanted = None if days is None else set(days)
            kept = [d for d in self.stored_days() if (wanted is None or d in wanted) and (since is None or d >= since)]
            folders = [f"day={d}" for d in kept]
        rows = self.layout.read(folders)
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        if without is not None:
            own = (F.col("writer") == without[0]) & F.col("batch_id").eqNullSafe(F.lit(without[1]))
            rows = rows.filter(~own)
        if since is not None:
            rows = rows.filter(F.col("day") >= F.lit(since))
        return rows.select(*self.schema.names)

    def newest(self, rows: int, slack: int = 0) -> DataFrame:
        """The newest days that together hold ``rows`` rows, found from the newest back.

        ``slack`` adds days before them, for an order by another time that is at
        most so many days off ``day_of``. Rows without a time come in when the
        dated ones are too few.
        """
        days = sorted(self.stored_days(), reverse=True)
        taken = 1
        while taken <= len(days):
            since = days[taken - 1]
            if self.read(since=since).limit(rows).count() >= rows:
                return self.read(since=since - timedelta(days=slack))
            taken *= 2
        return self.read()

    def stored_days(self) -> list[date]:
        """Days that have a folder: one listing of the table's top level, and of its packed copies'."""
        layout = self.layout
        entries = [*layout.listed(layout.path), *layout.listed(layout.packed_path)]
        found = (re.fullmatch(r"day=(\d{4}-\d\d-\d\d)", entry.getPath().getName()) for entry in entries)
        return sorted({date.fromisoformat(match[1]) for match in found if match})


class LostRace(RuntimeError):
    """Another writer committed this version first: read again and repeat."""


@dataclass(frozen=True)
class VersionedTable:
    """Table replaced as a whole: write a new version, then commit its number.

    The commit is one small appended file. Readers follow the highest number
    committed, so a half-written version is never seen and the version being
    read is never overwritten. Each attempt has a folder of its own; if two
    writers commit the same number, the earlier commit file counts and the later
    writer gets ``LostRace``.
    """

    spark: SparkSession
    path: str
    schema: T.StructType

    def version(self) -> int | None:
        """Highest committed version (a single value)."""
        current = self._committed()
        return None if current is None else current.version

    def read(self) -> DataFrame:
        current = self._committed()
        if current is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{current.folder}")

    def replace(self, rows: DataFrame) -> int:
        current = self.version()
        number = 0 if current is None else current + 1
        folder = f"version={number}-{uuid.uuid4().hex}"
        out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        out.write.parquet(f"{self.path}/data/{folder}")
        self._commit(number, folder)
        return number

    def _commit(self, number: int, folder: str) -> None:
        record = self.spark.range(number, number + 1, numPartitions=1).select(
            F.col("id").alias("version"), F.lit(folder).alias("folder")
        )
        record.write.mode("append").parquet(f"{self.path}/commits")
        if self._committed(number).folder != folder:
            raise LostRace(f"version {number} of {self.path} was committed by another writer")

    def _committed(self, number: int | None = None) -> Row | None:
        """The commit that counts, of the given version or of the highest one."""
        try:
            commits = self.spark.read.schema("version bigint, folder string").parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        if number is not None:
            commits = commits.filter(F.col("version") == number)
        written = F.col("_metadata.file_modification_time")
        return commits.select("version", "folder", written.alias("at")).orderBy(F.desc("version"), "at", "folder").first()


def append_rows(
    table: BatchTable, rows: DataFrame, batch_id: int, time_col: str = "timestamp", clock: Clock = None, writer: str = "api"
) -> None:
    """Direct insert; a missing time becomes the clock's."""
    table.append(rows.withColumn(time_col, F.coalesce(F.col(time_col), at(clock))), batch_id, writer)
