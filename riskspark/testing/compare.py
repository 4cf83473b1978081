"""Compare a Spark DataFrame with a DuckDB oracle statement on the same parquet tables.

Mirrors the driver's check: row count, column names (sorted), and an
order-insensitive comparison of values (floats at a relative 1e-9).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@dataclass
class Outcome:
    name: str
    rows_spark: int
    rows_oracle: int
    columns_match: bool
    values_match: bool
    detail: str = ""

    @property
    def ok(self) -> bool:
        return self.rows_spark == self.rows_oracle and self.columns_match and self.values_match


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, round(v, 9) if abs(v) < 1e12 else float(f"{v:.12g}"))
    if isinstance(v, (list, tuple)):
        return (2, tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return (3, tuple(sorted((str(k), _norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return (3, tuple(sorted((k, _norm(x)) for k, x in v.asDict().items())))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, v)


def _rows_spark(df, cols):
    return [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def _rows_duck(con, sql, cols):
    rel = con.sql(sql)
    names = rel.columns
    idx = [names.index(c) for c in cols]
    return [tuple(_norm(row[i]) for i in idx) for row in rel.fetchall()], names


def compare(name: str, df, con, sql: str) -> Outcome:
    spark_cols = sorted(df.columns)
    rows_s = _rows_spark(df, spark_cols)
    try:
        rows_o, oracle_cols = _rows_duck(con, sql, spark_cols)
    except (ValueError, KeyError):
        oracle_cols = con.sql(sql).columns
        return Outcome(name, len(rows_s), -1, False, False,
                       f"columns spark={spark_cols} oracle={sorted(oracle_cols)}")
    cols_ok = sorted(oracle_cols) == spark_cols
    a, b = sorted(rows_s, key=repr), sorted(rows_o, key=repr)
    same = a == b
    detail = ""
    if not same:
        sa, sb = set(a), set(b)
        detail = f"spark-only={list(sa - sb)[:3]} oracle-only={list(sb - sa)[:3]}"
    return Outcome(name, len(rows_s), len(rows_o), cols_ok, same, detail)
