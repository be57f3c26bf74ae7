"""Insert-ignore, upsert and serial ids.

Hot keys: repeats of one key are cut to one row per task before any shuffle,
and after that every key is unique on both sides of a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions.times import Clock, at
from fleetpulse.sinks.tables import materialize


def first_per_key(rows: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """The earliest row of each key; Spark keeps one per task before shuffling."""
    order = Window.partitionBy(key).orderBy(*arrival)
    return rows.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") == 1).drop("_nth")


def insert_ignore(new: DataFrame, stored: DataFrame, arrival: Sequence[str], key: str = "alert_id") -> DataFrame:
    """Rows of ``new`` that a unique key lets in; a NULL key is refused.

    ``arrival`` names the columns by which repeats of a key within ``new`` came
    in, such as a topic position; the first one wins.
    """
    keyed = new.filter(F.col(key).isNotNull())
    first = first_per_key(keyed, key, arrival)
    return first.join(stored.select(key), key, "left_anti").select(*new.columns)


def upsert(existing: DataFrame, batch: DataFrame, key: str, updated: Sequence[str], clock: Clock = None) -> DataFrame:
    """Existing rows with ``updated`` columns replaced, plus new keys.

    ``created_at`` of an existing row is kept. A key repeated inside the batch
    is an error, as it is for a database.
    """
    one_each = (
        batch.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.first(name).alias(f"_new_{name}") for name in updated])
        .withColumn(
            "_n",
            F.when((F.col("_n") == 1) & F.col(key).isNotNull(), F.col("_n")).otherwise(
                F.raise_error(
                    F.concat(F.lit("key repeated or missing in one upsert batch: "), F.coalesce(F.col(key), F.lit("NULL")))
                ).cast("bigint")
            ),
        )
    )
    arrived = F.col("_n").isNotNull()
    columns: list[Column] = []
    for name in existing.columns:
        if name == "created_at":
            columns.append(
                F.when(F.col("_known").isNotNull(), F.col(name)).otherwise(at(clock)).alias(name)
            )
        elif name in updated:
            columns.append(F.when(arrived, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return existing.withColumn("_known", F.lit(True)).join(one_each, key, "full_outer").select(*columns)


def with_serial_id(rows: DataFrame, order: Sequence[str], start: Column | int = 0, name: str = "id") -> DataFrame:
    """Gap-free ids in the given order, without ranking everything in one task.

    A distributed sort is written once with each row's partition and position
    in it. An id is the position plus the sizes of the partitions before, and
    only those sizes (one row per partition) meet in one place. ``order`` must
    be unique per row.
    """
    position_bits = 33  # layout of monotonically_increasing_id
    sorted_once = materialize(
        rows.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "serial-order"
    )
    placed = sorted_once.withColumn("_part", F.shiftright("_place", position_bits))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_place").bitwiseAND(F.lit((1 << position_bits) - 1)) + 1
    first_id = start if isinstance(start, Column) else F.lit(start)
    return placed.join(F.broadcast(offsets), "_part").select(
        (first_id + F.col("_offset") + position).cast("bigint").alias(name), *rows.columns
    )


def with_alert_defaults(alerts: DataFrame, clock: Clock = None) -> DataFrame:
    """Columns the table fills in: not resolved, created now."""
    return alerts.withColumn("is_resolved", F.lit(False)).withColumn("created_at", at(clock))
