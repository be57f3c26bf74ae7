"""Joins of a large, possibly skewed side with a table of unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
ROWS_PER_TASK = 1_000_000
_ROW_OVERHEAD = 64


def text_bytes(rows: DataFrame) -> int:
    """Exact size of a table of short columns: one small aggregate, one row back."""
    size = F.lit(_ROW_OVERHEAD)
    for name in rows.columns:
        size = size + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return rows.agg(F.sum(size)).first()[0] or 0


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``facts`` joined (inner, left, semi or anti) with unique-key ``table``.

    The table is measured and broadcast only if it fits. Otherwise both sides
    are shuffled, and a key with more than ``rows_per_task`` facts is split
    into as many salted parts as it needs, by a hash of ``spread_by``; the
    table's row for it is repeated once per part. At most total rows /
    ``rows_per_task`` keys can be that hot, so their list stays small.
    """
    if text_bytes(table) <= max_broadcast_bytes:
        return facts.join(F.broadcast(table), key, how)
    parts = hot_keys(facts, key, rows_per_task)
    salted_facts = (
        facts.join(F.broadcast(parts), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.coalesce(F.col("_parts"), F.lit(1))))
        .drop("_parts")
    )
    salted_table = (
        table.join(F.broadcast(parts), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
        .drop("_parts")
    )
    return salted_facts.join(salted_table, [key, "_salt"], how).drop("_salt")


def hot_keys(facts: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """Keys with more rows than one task should take, and the parts to make."""
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter((F.col("_n") > rows_per_task) & F.col(key).isNotNull()).select(
        key, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("bigint").alias("_parts")
    )
