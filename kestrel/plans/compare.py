"""Spark-vs-DuckDB comparison used by the tests (row count, columns, values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

from ..sources.tables import TABLES, table_path


def duckdb_result(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    return cols, rel.fetchall()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "NaN"
        r = round(f, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, int):
        return float(v) if abs(v) < 2**53 else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _sort_key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def normalise(cols: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=_sort_key)


def compare(spark_df, sql: str, sf_dir: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    d_cols, d_rows = duckdb_result(sql, sf_dir)
    sc, sr = normalise(s_cols, s_rows)
    dc, dr = normalise(d_cols, d_rows)
    first_diff = None
    if sr != dr:
        for a, b in zip(sr, dr):
            if a != b:
                first_diff = (a, b)
                break
    return {
        "rows_spark": len(sr), "rows_oracle": len(dr),
        "columns_match": sc == dc, "columns_spark": sc, "columns_oracle": dc,
        "values_match": sr == dr, "first_diff": first_diff,
    }
