"""Order-insensitive comparison of a Spark result with its DuckDB oracle (for tests and checks)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):  # numpy scalars
        return _norm(v.item())
    return v


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of_spark(df: DataFrame):
    cols = sorted(df.columns)
    order = [df.columns.index(c) for c in cols]
    return cols, Counter(tuple(_norm(r[i]) for i in order) for r in df.collect())


def rows_of_duckdb(con, sql: str):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    order = [names.index(c) for c in cols]
    return cols, Counter(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())


def compare(df: DataFrame, con, sql: str) -> dict:
    s_cols, s_rows = rows_of_spark(df)
    o_cols, o_rows = rows_of_duckdb(con, sql)
    out = {"spark_rows": sum(s_rows.values()), "oracle_rows": sum(o_rows.values()),
           "columns_match": s_cols == o_cols, "values_match": s_cols == o_cols and s_rows == o_rows}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
    elif not out["values_match"]:
        out["only_spark"] = list((s_rows - o_rows).items())[:3]
        out["only_oracle"] = list((o_rows - s_rows).items())[:3]
    return out
