"""Comparison of a query with its SQL counterpart in DuckDB."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when columns and rows agree, in any order; otherwise what differs."""
    answer = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(answer.columns):
        return f"columns {names} and {sorted(answer.columns)}"
    ours = Counter(tuple(row[name] for name in names) for row in df.collect())
    place = [answer.columns.index(name) for name in names]
    theirs = Counter(tuple(row[i] for i in place) for row in answer.fetchall())
    if ours == theirs:
        return ""
    only_ours, only_theirs = list((ours - theirs).items()), list((theirs - ours).items())
    return (
        f"{ours.total()} and {theirs.total()} rows over {names}; only Spark "
        f"{len(only_ours)}: {only_ours[:2]}; only SQL {len(only_theirs)}: {only_theirs[:2]}"
    )
