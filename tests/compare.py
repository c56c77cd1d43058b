"""Run a registered query and its SQL, compare rows regardless of order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return (2, repr(round(float(value), 9) + 0.0))
    return (3, str(value))


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    got_columns, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_columns, want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return [f"columns {got_columns} != {want_columns}"]
    if got != want:
        only_got = [r for r in got if r not in set(want)][:2]
        only_want = [r for r in want if r not in set(got)][:2]
        return [f"rows {len(got)} vs {len(want)}; only spark {only_got}; only sql {only_want}"]
    return []
