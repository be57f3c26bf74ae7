"""Totals over stored history without reading it again.

A summary belongs to one merged copy of one day and writer: how many rows it
holds by severity, and which vehicles, as bitmaps over a dictionary that numbers
them. Batches behind the copies are read as they are, so totals are exact, late
rows included, and history costs a few rows a day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.functions.times import Clock, at
from fleetpulse.operators.merge import with_serial_id
from fleetpulse.operators.serving import CRITICAL, WARNING
from fleetpulse.sinks.packing import Layout
from fleetpulse.sinks.tables import BatchTable

_GROUP = [T.StructField("day", T.DateType()), T.StructField("writer", T.StringType()), T.StructField("through", T.LongType())]
_COUNTS = ("total", "critical", "warning")
COUNT_SUMMARY = T.StructType([*_GROUP, *[T.StructField(n, T.LongType()) for n in _COUNTS]])
VEHICLE_SUMMARY = T.StructType([*_GROUP, T.StructField("slot", T.LongType()), T.StructField("bits", T.BinaryType())])
NUMBERED = T.StructType([T.StructField("vehicle_id", T.StringType()), T.StructField("number", T.LongType())])


@dataclass(frozen=True)
class Summaries:
    """Summaries of an alert table and an aggregate table that are stored by day. One process refreshes them at a time."""

    spark: SparkSession
    path: str
    alerts: BatchTable
    aggregates: BatchTable

    @property
    def counts(self) -> BatchTable:
        return BatchTable(self.spark, f"{self.path}/alert-counts", COUNT_SUMMARY)

    @property
    def vehicles(self) -> BatchTable:
        return BatchTable(self.spark, f"{self.path}/vehicle-bits", VEHICLE_SUMMARY)

    @property
    def dictionary(self) -> BatchTable:
        return BatchTable(self.spark, f"{self.path}/vehicle-numbers", NUMBERED)

    def refresh(self, run: int) -> None:
        """Summarises the merged copies that have no summary; ``run`` numbers the refreshes, and a repeated one replaces itself.

        Only those copies' columns in question are read.
        """
        packed = _pending(self.alerts.layout, self.counts.read(without=("main", run)))
        if packed is not None:
            self.counts.append(packed.groupBy("day", "writer", "through").agg(*_severities()), run)
        packed = _pending(self.aggregates.layout, self.vehicles.read(without=("main", run)))
        if packed is not None:
            held = packed.select("day", "writer", "through", "vehicle_id").distinct()
            numbers = self._number(held, run)
            numbered = held.join(numbers, "vehicle_id")
            self.vehicles.append(_bitmaps(numbered, "day", "writer", "through"), run)

    def _number(self, held: DataFrame, run: int) -> DataFrame:
        """Numbers of all vehicles, new ones included; a vehicle keeps its number."""
        known = self.dictionary.read(without=("main", run))
        start = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        new = held.select("vehicle_id").filter(F.col("vehicle_id").isNotNull()).distinct().join(known, "vehicle_id", "left_anti")
        self.dictionary.append(with_serial_id(new, ["vehicle_id"], start=start, name="number"), run)
        return self.dictionary.read()

    def alert_totals(self) -> DataFrame:
        """One row: total, critical, warning."""
        stored = _current(self.counts.read(), self.alerts.layout).select(*_COUNTS)
        rest = self._rest(self.alerts, self.counts)
        if rest is not None:
            stored = stored.unionByName(rest.agg(*_severities()))
        return stored.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _COUNTS])

    def active_vehicles(self) -> DataFrame:
        """Exact number of distinct vehicles in the aggregates, one row."""
        numbers = self.dictionary.read()
        bits = _current(self.vehicles.read(), self.aggregates.layout).select("slot", "bits")
        unknown = None
        rest = self._rest(self.aggregates, self.vehicles)
        if rest is not None:
            held = rest.select("vehicle_id").filter(F.col("vehicle_id").isNotNull()).distinct()
            bits = bits.unionByName(_bitmaps(held.join(numbers, "vehicle_id")))
            unknown = held.join(numbers, "vehicle_id", "left_anti").agg(F.count(F.lit(1))).scalar()
        merged = bits.groupBy("slot").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("held"))
        total = merged.agg(F.coalesce(F.sum("held"), F.lit(0)).alias("held"))
        return total.select((F.col("held") + (F.lit(0) if unknown is None else unknown)).cast("bigint").alias("active_vehicles"))

    def dashboard(self, clock: Clock = None) -> DataFrame:
        """As ``serving.dashboard_summary`` over all history."""
        return self.alert_totals().select(
            F.col("total").alias("total_alerts_history"),
            self.active_vehicles().scalar().alias("active_vehicles_24h"),
            F.col("critical").alias("critical_alerts_total"),
            F.col("warning").alias("warning_alerts_total"),
            at(clock).alias("last_updated"),
        )

    @staticmethod
    def _rest(table: BatchTable, summaries: BatchTable) -> DataFrame | None:
        """Rows that no summary covers: batches behind the copies, and copies not summarised yet."""
        names = table.schema.names
        parts = [table.layout.fresh(), _pending(table.layout, summaries.read())]
        found = [p.select(*names) for p in parts if p is not None]
        return None if not found else found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _severities() -> list[Column]:
    counts = [F.count_if(F.col("severity") == name) for name in (CRITICAL, WARNING)]
    return [c.alias(n) for n, c in zip(_COUNTS, [F.count(F.lit(1)), *counts])]


def _bitmaps(numbered: DataFrame, *keys: str) -> DataFrame:
    """``slot, bits`` for each key: one bit a vehicle."""
    slot = F.bitmap_bucket_number("number").alias("slot")
    return numbered.groupBy(*keys, slot).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def _covered(summaries: DataFrame) -> DataFrame:
    """Copies that have a summary, a row each."""
    return F.broadcast(summaries.select(*[F.col(f.name).alias(f"_{f.name}") for f in _GROUP]).distinct())


def _same() -> Column:
    return F.col("day").eqNullSafe(F.col("_day")) & (F.col("writer") == F.col("_writer")) & (F.col("through") == F.col("_through"))


def _pending(layout: Layout, summaries: DataFrame) -> DataFrame | None:
    """Rows of the copies that have no summary; only their folders are opened."""
    copies = layout.copies()
    if copies is None:
        return None
    found = copies.join(_covered(summaries), _same(), "left_anti").select("day", "writer").collect()  # days not yet summarised
    return layout.packed([layout.folder(r.day, r.writer) for r in found]) if found else None


def _current(summaries: DataFrame, layout: Layout) -> DataFrame:
    """Summaries of the copies that are the newest of their day and writer."""
    copies = layout.copies()
    return summaries.limit(0) if copies is None else summaries.join(_covered(copies), _same(), "left_semi")
