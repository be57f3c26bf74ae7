"""Database output through Spark's JDBC writer.

The writer knows no conflict clause. Inserts that must respect a unique key go
to a staging table, and the database then runs the statement built here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Rows per statement batch.
ALERT_BATCH, AGGREGATE_BATCH = 100, 1000


def write_jdbc(rows: DataFrame, url: str, table: str, batch_size: int, **properties: str) -> None:
    """Plain append in batches."""
    rows.write.format("jdbc").options(**jdbc_sink_options(url, table, batch_size, **properties)).mode("append").save()


def jdbc_sink_options(url: str, table: str, batch_size: int, **properties: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **properties}


def insert_ignore_statement(table: str, staging: str, columns: Sequence[str], key: str) -> str:
    """Moves staged rows, skipping keys the table already holds."""
    names = ", ".join(columns)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON CONFLICT ({key}) DO NOTHING"


def upsert_statement(table: str, staging: str, columns: Sequence[str], key: str, updated: Sequence[str]) -> str:
    """Moves staged rows, replacing ``updated`` columns of known keys."""
    names = ", ".join(columns)
    changes = ", ".join(f"{name} = EXCLUDED.{name}" for name in updated)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON CONFLICT ({key}) DO UPDATE SET {changes}"
