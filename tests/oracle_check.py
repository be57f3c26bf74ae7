"""Compares a Spark result with DuckDB's, both as sorted rows."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=_key)


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(r[i] for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


def assert_same(df, con, sql):
    spark_names, ours = spark_rows(df)
    names, theirs = duck_rows(con, sql)
    assert spark_names == names
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert [type(x) for x in a] == [type(x) for x in b], (a, b)
        same = all(x == y or (isinstance(x, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b))
        assert same, (a, b)
